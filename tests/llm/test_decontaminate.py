import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.samples import EDGES, text
from tidemart.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(rows, items):
    out = []
    for doc, t in rows:
        own, hit, found = words(t), set(), set()
        for item, it in items:
            theirs = words(it)
            n = min(13, len(theirs))
            windows = {tuple(theirs[i : i + n]) for i in range(len(theirs) - n + 1)} if n else set()
            for i in range(len(own) - n + 1 if n else 0):
                if tuple(own[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found.add(str(item) if item is not None else "null")
        out.append((doc, len(own), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(own)))
    return sorted(out, key=repr)


def sample():
    r = random.Random(8)
    items = [(i, text(500 + i, n)) for i, n in enumerate((30, 13, 12, 5, 1, 40, 14, 25))] + [(10, None), (11, "?!"), (None, text(520, 20)), (2, text(521, 15))]
    items.append((12, items[0][1].upper()))
    rows = []
    for i in range(60):
        t = text(i, r.randrange(0, 150)).split()
        for _ in range(r.randrange(3)):
            w = words(r.choice(items)[1] or "")
            a = r.randrange(max(1, len(w)))
            at = r.randrange(len(t) + 1)
            t[at:at] = w[a : a + r.randrange(1, 40)]
        rows.append((i, r.choice([" ", ", ", "\n", "! "]).join(t)))
    return rows + [r for r in EDGES if r[0] != 906], items


def result(df):
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    rows = df.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated").collect()
    return sorted((tuple(r) for r in rows), key=repr)


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS window", "'x' AS items")


@pytest.mark.parametrize("block", [2_000_000, 900])
def test_equals_brute_force(docs, spark, monkeypatch, block):
    monkeypatch.setattr(D, "BLOCK_CHARS", block)
    rows, items = sample()
    rows += rows[:3]
    assert result(D.find(docs(*rows).repartition(4), bench(spark, items))) == brute(rows, items)


def test_spans_are_offsets_of_the_original(docs, spark):
    t = "Ünter – " + text(1, 5) + "! Seven, BLUE;doors  opEn wide é " + text(2, 5)
    row = D.find(docs((1, t)), bench(spark, [(1, "seven blue doors open wide É"), (2, "seven blue doors open wide é")])).first()
    assert [t[s.start : s.end] for s in row.spans] == ["Seven, BLUE;doors  opEn wide é"]
    assert row["items"] == ["2"]


def test_keep_clean(docs, spark):
    passage = text(9, 20)
    df = docs((1, passage), (2, text(3, 30)), (None, passage), (4, None), (5, text(4, 400) + passage), (1, text(6, 30)))
    kept = D.keep_clean(df, bench(spark, [(1, passage)]))
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4, 5]


def test_empty_tables(docs, spark):
    none = bench(spark, [(1, "a")]).where("false")
    assert D.find(docs((1, "a b")), none).first().contaminated is False
    assert D.find(docs((1, "a")).where("false"), none).count() == 0
