"""Block-Max MaxScore against scoring every document, over shards and blocks of all sizes."""

import math
import random
import re

import numpy as np
import pytest

from tests.llm.samples import EDGES, text
from tidemart.llm import lexical_search as s

TERM = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")


def terms(t):
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in TERM.findall(t or "")]


def brute(docs, items, k=50):
    counts = [(d, [w for w in terms(t)]) for d, t in docs]
    n_docs, n_terms = sum(bool(w) for _, w in counts), sum(len(w) for _, w in counts)
    df = {}
    for _, w in counts:
        for term in set(w):
            df[term] = df.get(term, 0) + 1
    out = []
    for item, t in set(items):
        found = []
        for d, w in counts:
            m = 50 + 50 * len(w) * n_docs // max(n_terms, 1)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[q] + 1))) * (10**9 * tf // (1000 * tf + 20 * m))
                for q in set(terms(t)) if (tf := w.count(q)))
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item, i + 1, d, -score) for i, (score, _, _, d) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def found(docs, asked, **params):
    return sorted(map(tuple, s.search_documents(docs, asked, s.SearchParams(**params)).collect()), key=repr)


def corpus(n):
    r = random.Random(n)
    rows = [(r.randrange(n) if i % 7 else None, text(r.randrange(n // 3), r.randrange(1, 60))) for i in range(n)]
    return rows + [(10_000 + i, "river stone river " * r.randrange(1, 9)) for i in range(40)]  # many ties


@pytest.mark.parametrize(("block", "shard_bytes", "items", "k"), [(128, 32 << 20, 500, 50), (3, 4000, 2, 5), (1, 1, 1, 1)])
def test_equals_brute_force(spark, docs, block, shard_bytes, items, k):
    rows = [(i, t) for i, t in EDGES if i != 906] + corpus(120)
    asked = [(1, "river STONE light"), (2, "the quiet house7, House7 é 東京 garden3"), (3, None), (4, "nothing-here"), (5, ""),
             (6, "one"), (7, text(3, 30)), (7, text(3, 30)), (None, "road5 small")]
    questions = spark.createDataFrame(asked, "item_id long, text string").selectExpr("*", "'x' AS term", "1 AS part")
    got = found(docs(*rows), questions, block=block, shard_bytes=shard_bytes, items=items, k=k)
    assert got == brute(rows, asked, k)


def test_thresholds_reject_blocks_before_they_are_read():
    """One long low-bound list and one short high-bound one: most blocks of the long list stay packed."""
    n_docs, m = 4000, np.full(4000, 100, np.int64)
    row = lambda doc, tf, block=16: type("Row", (), _packed(np.asarray(doc), np.asarray(tf), block))
    low = s.TermList(row(np.arange(4000), np.ones(4000, int)), 10, lambda n: np.full(len(n), 100), m)
    high = s.TermList(row(np.arange(0, 4000, 200), np.full(20, 5)), 5000, lambda n: np.full(len(n), 100), m)
    doc, score = s.best_documents([low, high], n_docs, 5, np.arange(n_docs), stride=500)
    whole = np.zeros(n_docs, np.int64)
    for one in (low, high):
        some = s.TermList.between(one, 0, n_docs) if one is high else (np.arange(4000), 10 * s.gain(np.ones(4000, int), m))
        whole[some[0]] += some[1]
    best = np.lexsort((np.arange(n_docs), -whole))[:5]
    assert sorted(zip(doc.tolist(), score.tolist())) == sorted(zip(best.tolist(), whole[best].tolist()))
    # two strides (63 blocks) pass before five documents hold both terms; then a block for each of 15 candidates
    assert len(low.known) <= 63 + 15 < len(low.last) / 3


def _packed(doc, tf, block):
    opens = np.arange(len(doc)) % block == 0
    gap = np.where(opens, doc, doc - np.concatenate([[0], doc[:-1]]))
    data, ends = s.to_bytes(np.stack([gap, tf], axis=1).ravel())
    lasts = np.flatnonzero(np.append(opens[1:], True))
    b, best, least = s.frontier(np.cumsum(opens) - 1, tf, np.full(len(doc), 7))
    head = np.stack([doc[lasts], ends[2 * lasts + 1], np.bincount(b)], axis=1).astype(np.uint32)
    return {"blocks": head.tobytes(), "impacts": np.stack([best, least], 1).astype(np.uint32).tobytes(), "postings": data.tobytes()}


def test_variable_bytes_and_frontier():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2**21, 2**28 - 1, 2**28, 2**31 - 1])
    data, ends = s.to_bytes(values)
    assert s.from_bytes(data).tolist() == values.tolist() and ends[-1] == len(data)
    r = np.random.Generator(np.random.PCG64(1))
    block, tf, n = r.integers(0, 5, 200), r.integers(1, 9, 200), r.integers(1, 30, 200)
    b, t, m = s.frontier(np.sort(block), tf, n)
    for k in range(5):
        mine = [(x, y) for z, x, y in zip(np.sort(block), tf, n) if z == k]
        best = {(x, y) for x, y in mine if not any((u >= x and v <= y) and (u, v) != (x, y) for u, v in mine)}
        assert {(x, y) for z, x, y in zip(b, t, m) if z == k} == best


def test_many_terms_are_joined_by_a_shuffle(spark, docs, monkeypatch):
    monkeypatch.setattr(s, "SENT_TERMS", 0)
    rows, asked = corpus(60), [(1, "river stone"), (2, "bridge3 night")]
    assert found(docs(*rows), spark.createDataFrame(asked, "item_id long, text string"), k=9) == brute(rows, asked, 9)


def test_empty_tables(spark, docs):
    items = spark.createDataFrame([(1, "river")], "item_id long, text string")
    assert found(docs((1, "river")).limit(0), items) == []
    assert found(docs((1, None), (2, "")), items) == []
    assert found(docs((1, "river")), items.limit(0)) == []
