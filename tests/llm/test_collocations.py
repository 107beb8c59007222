"""Tiled counting against plain counting of every phrase."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.samples import EDGES, text
from tidemart.llm import collocations as c

LOWER = {k: k + 32 for k in range(65, 91)}


def brute(rows, least, top):
    counts, total = {}, Counter()
    for _, t, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (t or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        held = Counter()
        for p, a in candidates.items():
            if len(p) == 3:
                for part in (p[:2], p[1:]):
                    held[part] = max(held[part], a)
        rows_of = []
        for p, a in candidates.items():
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            if not 100 * held[p] >= 50 * a or not held[p]:
                rows_of.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows_of)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def found(docs, **params):
    return sorted(map(tuple, c.phrases(docs, c.PhraseParams(**params)).collect()))


def corpus():
    r = random.Random(4)
    rows = [(i, text(i % 40, r.randrange(40)), r.choice(["en", "de", None, "und"])) for i in range(150)]
    marks = [" ", " ", " ", ", ", ".", "\n", "\t", "  ", "\x0b"]
    for i in range(120):
        words = [r.choice("the of House a b RIVER ñ É".split()) for _ in range(r.randrange(40))]
        rows.append((1000 + i, "".join(w + r.choice(marks) for w in words), r.choice(["en", "fr"])))
    return rows + [(2000, "x y z " * 30, "xx"), (2001, "a-b c'd a-b c'd, " * 12, "yy"), (2002, "same " * 50, "same")]


@pytest.mark.parametrize(("least", "top", "more"), [
    (10, 2000, {}), (2, 7, {"tile": 4, "chunk_bytes": 500}), (3, 2000, {"tile": 2, "chunk_bytes": 3000, "sent": 0}), (1, 50, {"sent": 0})])
def test_equals_plain_counting(docs, least, top, more):
    rows = [(i, t, None) for i, t in EDGES] + corpus()
    assert found(docs(*rows), least=least, top=top, **more) == brute(rows, least, top)


def test_tiles_count_what_a_counter_counts():
    r = np.random.Generator(np.random.PCG64(2))
    first = np.concatenate([r.integers(0, 6, 5000), r.integers(0, 90_000, 800)])
    second = np.concatenate([r.integers(0, 6, 5000), r.integers(0, 90_000, 800)])
    for tile in (1, 8, 1024):
        pair, n = c.count_pairs(first, second, tile)
        assert Counter(dict(zip(pair.tolist(), n.tolist()))) == Counter((first << 32 | second).tolist())
        assert len(set(pair.tolist())) == len(pair)


def test_scores_beyond_64_bits(spark):
    big = spark.createDataFrame([(4_000_000_000_000, 4_000_000_000_001, 4_500_000_000_000)], "a long, l long, r long")
    a, left, right = big.first()
    assert big.select(c._score("a", "l", "r").alias("s")).first().s == 1_000_000 * a * a // (left * right)


def test_ids_rank_by_frequency(spark, monkeypatch):
    monkeypatch.setattr(c, "NUMBERED", 3)
    counts = spark.createDataFrame([("en", f"w{i}", 5000 // (i + 1)) for i in range(60)] + [("de", "x", 9)], "lang string, word string, n long")
    rows = c.ranked(counts, "word").where("lang = 'en'").orderBy("id").collect()
    assert [r.id for r in rows] == list(range(60))
    assert all(a.n >= b.n for a, b in zip(rows, rows[1:]))


def test_empty_tables(docs):
    assert found(docs((1, "a b c")).limit(0)) == []
    assert found(docs((1, None), (2, "")), least=1) == []
