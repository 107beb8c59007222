import random
import re
import base64

import pytest

from tests.llm.samples import EDGES, text
from tidemart.llm.quality_rules import judge


def brute(t):
    t = t or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines, seen = [], 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            seen += line in lines
            lines.append(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    hit = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            hit.update(range(i, i + 8))
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), seen, len(hit), n < 20 or 100 * len(hit) > 30 * n)


def test_counts_equal_brute_force(docs):
    rows = []
    for i in range(40):
        r = random.Random(i)
        t = text(i, r.randrange(0, 60))
        part = text(i + 100, 12)
        pieces = [t, part, "é#*日本 <x> &\u00a0|", part, "line\r", "line", " line", "", "line", part + "\n" + part]
        r.shuffle(pieces)
        rows.append((i, r.choice(["\n", " ", "\n\n", "\t"]).join(pieces)))
    rows += [e for e in EDGES if e[0] != 906]
    got = judge(docs(*rows).repartition(3)).collect()
    mine = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got), key=repr)
    assert mine == sorted(((d, *brute(t)) for d, t in rows), key=repr)
    assert all(not r.kept for r in got if r.base_failed)


def test_bands(docs):
    plain = text(1, 2000)
    noise = " ".join(base64.b85encode(random.Random(i).randbytes(30)).decode() for i in range(300))
    rows = [(1, plain), (2, noise), (3, "abc def " * 4000), (4, plain + noise), (5, plain + " " + " ".join(["zug", "zag"] * 4000)),
            (6, text(2, 25)), (7, text(3, 200))]
    got = {r.doc_id: r.reason for r in judge(docs(*rows)).collect()}
    assert got[1] is None and got[6] is None and got[7] is None
    assert got[2] == "incompressible" and got[4] == "incompressible"
    assert got[3] == "base" and got[5] == "base"


def test_empty_table(docs):
    assert judge(docs((1, "a")).where("false")).count() == 0


def test_repetition_that_the_base_rules_miss(docs):
    # every window differs by a number, yet nearly nothing is new
    t = " ".join(f"aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa{i % 10}{i // 10 % 10}" for i in range(100))
    assert judge(docs((1, t))).first().reason == "repetitive"


def test_junk_in_the_rest_is_judged_like_junk_in_a_chunk(docs):
    plain = text(1, 4000)
    junk = " " + ("z" * 59 + " ") * 60
    rest, before = plain[:16_400] + junk[:3_600], plain[:12_288] + junk[:3_600] + plain[12_288:16_400]
    assert len(rest) == len(before) == 20_000
    got = {r.doc_id: r.reason for r in judge(docs((1, rest), (2, before), (3, plain[:20_000]))).collect()}
    assert got == {1: "repetitive", 2: "repetitive", 3: None}


@pytest.mark.parametrize("n", [0, 1])
def test_long_text(docs, n):
    t = text(5, 60_000)
    assert judge(docs((n, t))).first().n_words == 60_000
