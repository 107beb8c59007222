import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from tests.llm.samples import EDGES, edited, text
from tidemart.llm import jaccard_join as J
from tidemart.llm.grams import shingle_sets
from tidemart.session import path_exists


def shingles(t):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    """Sorted (doc_id, n_shingles, component_id) by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * len(sets[i] | sets[j]):
                label = [label[j] if x == label[i] else x for x in label]
    least = {}
    for (d, _), x in zip(rows, label):
        least[x] = min((v for v in (least.get(x), d) if v is not None), default=None)
    return sorted(((d, len(s), least[x]) for (d, _), s, x in zip(rows, sets, label)), key=repr)


def joined(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def corpus():
    rows, n = [], 0
    for seed, size in enumerate((6, 9, 14, 30, 60, 120, 300)):
        base = text(seed, size)
        for k in range(6):
            rows.append((n := n + 1, edited(base, 100 * seed + k, k // 2 * max(1, size // 60))))
        rows.append((n := n + 1, base.upper()))
    passage = text(77, 60)
    for k in range(40):  # a passage that many share, in documents of little else and of much else
        rows.append((n := n + 1, passage + " " + text(1000 + k, 8 + 4 * (k % 20))))
    family = text(78, 90)
    for k in range(60):  # near copies, not all similar to one another
        rows.append((n := n + 1, edited(family, 2000 + k, 1 + k % 5)))
    random.Random(1).shuffle(rows)
    return rows


def test_equals_brute_force(docs):
    rows = corpus() + [(d, t) for d, t in EDGES if d != 906]
    assert joined(J.jaccard_join(docs(*rows).repartition(5))) == brute(rows)


def degrees(rows):
    """Sorted (doc_id, n_links): other sets that link with a document's, by comparing all pairs."""
    sets = {shingles(t) for _, t in rows} - {frozenset()}
    linked = {s: sum(s is not o and 100 * len(s & o) >= 75 * len(s | o) for o in sets) for s in sets}
    return sorted(((d, linked.get(shingles(t), 0)) for d, t in rows), key=repr)


@pytest.mark.parametrize("block", [16, 256])
def test_link_counts_equal_brute_force(docs, monkeypatch, block):
    monkeypatch.setattr(J, "BLOCK", block)
    family = text(79, 120)
    rows = corpus() + [(5000 + k, edited(family, 3000 + k, 1 + k % 3)) for k in range(80)]
    rows += [(d, t) for d, t in EDGES if d != 906]
    got = [(r.doc_id, r.n_links) for r in J.jaccard_join(docs(*rows).repartition(5)).collect()]
    assert sorted(got, key=repr) == degrees(rows)


def test_edge_cases(docs):
    got = {r.doc_id: r for r in J.jaccard_join(docs(*EDGES)).collect()}
    assert got[900].n_shingles == got[901].n_shingles == got[902].n_shingles == 0
    assert got[900].component_id == 900 and got[901].component_id == 901
    assert got[905].component_id == 903 and got[None].component_id is None
    assert J.jaccard_join(docs(*EDGES)).count() == len(EDGES)
    assert J.jaccard_join(docs((1, "a")).where("false")).count() == 0


def test_keep_one_keeps_columns_and_one_of_each_group(docs):
    base = text(5, 50)
    rows = [(3, base), (1, edited(base, 1, 1)), (2, base), (2, base), (7, text(9, 40)), (8, None), (9, "")]
    df = docs(*rows)
    kept = J.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 7, 8, 9]


@pytest.mark.parametrize("size", [3, 4, 7, 20, 64, 65, 200, 513])
def test_similar_sets_share_enough_signatures(size):
    rng = np.random.default_rng(size)
    frequent = np.zeros(0, np.uint64)
    for trial in range(60):
        one = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
        other = one.copy()
        for _ in range(int(rng.integers(0, size // 3 + 1))):  # drop or exchange features while still linked
            changed = np.delete(other, rng.integers(len(other)))
            if rng.random() < 0.5:
                changed = np.unique(np.append(changed, rng.integers(0, 2**63, dtype=np.uint64)))
            if J._linked(one, changed, 75):
                other = changed
        if trial % 2:
            frequent = np.sort(rng.choice(one, len(one) * 3 // 4, replace=False))
        sigs, own, low = J.signatures_of(np.concatenate([one, other]), np.array([0, len(one), len(one) + len(other)]), frequent, 75)
        common = set(sigs[own == 0].tolist()) & set(sigs[own == 1].tolist())
        if not np.array_equal(one, other):
            assert len(common) >= (1 if low.any() else J.SPARE + 1)


@pytest.mark.parametrize("cut", [1, 2, 3, 7, 1000])
def test_groups_do_not_depend_on_batches(cut):
    rng = np.random.default_rng(3)
    sig = np.sort(np.concatenate([rng.integers(0, 40, 150), np.full(70, 41), np.full(17, 45), np.full(16, 46)]))
    c = rng.integers(0, 500, len(sig)) * 2
    order = np.lexsort((c, sig))
    rows = pa.table({"sig": sig[order], "c": c[order]})
    pairs, big = {}, set()
    for out in J._grouped(iter(rows.to_batches(max_chunksize=cut))):
        for r in out.to_pylist():
            if r["big"]:
                big.add((r["x"], r["y"]))
            else:
                pair = min(r["x"], r["y"]), max(r["x"], r["y"])
                pairs[pair] = pairs.get(pair, 0) + r["shared"]
    members = {}
    for s, x in zip(sig[order].tolist(), c[order].tolist()):
        members.setdefault(s, set()).add(x)
    expected = {}
    for own in members.values():
        if len(own) <= J.SMALL_GROUP:
            for a in own:
                for b in own:
                    if a < b:
                        expected[a, b] = expected.get((a, b), 0) + 1
    assert big == {(s, x) for s, own in members.items() if len(own) > J.SMALL_GROUP for x in own}
    assert all(pairs.get(p, 0) >= n for p, n in expected.items())
    extra = {p for p in pairs if p not in expected}
    large = [own for own in members.values() if len(own) > J.SMALL_GROUP]
    assert all(any(p[0] in own and p[1] in own for own in large) for p in extra)


def test_block_links_connect_what_links():
    base = [f"f{i}" for i in range(60)]
    rng = random.Random(2)
    texts = [" ".join(w if rng.random() > 0.02 * (k % 4) else f"z{rng.random()}" for w in base) for k in range(30)]
    sets = [shingle_sets(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))[0] for t in texts]
    pdf = pd.DataFrame({"key": [bytes([k]) for k in range(30)], "component": [bytes([k]) for k in range(30)],
                        "features": [s.tobytes() for s in sets]})
    label = list(range(30))
    for a, b in J._block_links(pdf, 75).itertuples(index=False):
        label = [label[a[0]] if x == label[b[0]] else x for x in label]
    expected = brute(list(enumerate(texts)))
    groups = {d: x for d, _, x in expected}
    assert all((label[i] == label[j]) == (groups[i] == groups[j]) for i in range(30) for j in range(30))


def test_pairs_of_signatures_are_gone_before_sets_come(spark, docs, monkeypatch):
    """The table of all signature pairs and that of the sets are never on disk together."""
    seen, sets = [], J._sets

    def spied(documents, wanted, params, scratch):
        seen.extend(path_exists(spark, f"{scratch.base}/{name}") for name in ("found", "pairs", "groups"))
        return sets(documents, wanted, params, scratch)

    monkeypatch.setattr(J, "_sets", spied)
    rows = [(k, edited(text(5, 80), k, 1)) for k in range(20)]
    assert joined(J.jaccard_join(docs(*rows))) == brute(rows)
    assert seen == [False, True, True]
