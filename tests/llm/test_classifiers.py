"""Held-out accuracy and edge cases of the two classifiers."""

import random
from zlib import crc32

import numpy as np
import pytest

from tests.llm.samples import EDGES, text
from tidemart.llm import quality_pu as Q
from tidemart.llm import toxicity as T

INSULTS = ["grobbler", "snarkhole", "vilewort", "murgtrash"]


def toxic_sample(n=600):
    rows, labels = [], []
    for i in range(n):
        r = random.Random(i)
        words = text(i, r.randrange(20, 120)).split()
        if i % 3 == 0:
            for _ in range(max(2, len(words) // 15)):
                words.insert(r.randrange(len(words)), r.choice(INSULTS) + r.choice(["", "s", "ish", f"{r.randrange(99)}x"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 3 == 0)))
    return rows, labels


def labelled(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "'x' AS text", "'x' AS curve")


def test_toxicity_on_held_out_rows(docs, spark):
    rows, labels = toxic_sample()
    df, own = docs(*rows), labelled(spark, labels)
    got = {r.doc_id: r for r in T.score(df, T.fit(df, own)).collect()}
    held = [i for i, _ in rows if crc32(str(i).encode()) % 5 == 0]
    right = [got[i].predicted == int(i % 3 == 0) for i in held]
    assert np.mean(right) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    # labels of the held-out fold change nothing
    other = labelled(spark, [(i, q, 1 - t if crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels])
    again = {r.doc_id: r.score for r in T.score(df, T.fit(df, other)).collect()}
    assert all(abs(again[i] - got[i].score) < 1e-9 for i in again)
    kept = T.keep_civil(df, own)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {i for i in got if got[i].predicted == 0}


def test_toxicity_edge_cases(docs, spark):
    rows, labels = toxic_sample(150)
    df = docs(*rows, *EDGES)
    model = T.fit(df, labelled(spark, [*labels, (1, 1, None), (None, 1, 1), (2, 1, 0), (2, 1, 0), (77777, 1, 1)]))
    got = T.score(df, model).collect()
    assert len(got) == 150 + len(EDGES) and all(r.score is not None for r in got)
    empty = labelled(spark, labels).where("false")
    assert {r.predicted for r in T.score(df, T.fit(df, empty)).collect()} == {0}
    assert T.score(df.where("false"), T.fit(df.where("false"), empty)).count() == 0
    assert T.keep_civil(df, empty).count() == 150 + len(EDGES)


def test_toxicity_with_more_grams_than_a_task_holds(docs, spark):
    """Grams beyond the limit are looked up by a join: no score changes, and no row goes."""
    rows, labels = toxic_sample(300)
    df, own = docs(*rows, *EDGES).repartition(3), labelled(spark, labels)
    whole = sorted(T.score(df, T.fit(df, own)).collect(), key=str)
    for limit in (0, 300):
        params = T.ToxicityParams(model_grams=limit)
        model = T.fit(df, own, params)
        assert len(model.ratios.common.grams) <= limit < model.ratios.grams.count()
        got = sorted(T.score(df, model).collect(), key=str)
        assert [(r.doc_id, r.predicted) for r in got] == [(r.doc_id, r.predicted) for r in whole]
        for name in ("score", "mean_ratio"):
            assert np.allclose([r[name] for r in got], [r[name] for r in whole], rtol=0, atol=1e-4)
    kept = T.keep_civil(df, own, params)
    assert kept.columns == df.columns
    assert sorted(kept.collect(), key=str) == sorted(T.keep_civil(df, own).collect(), key=str)


def test_toxicity_prior_does_not_depend_on_the_number_of_labels(spark):
    """Scores of the curve's rows average to their toxic share, also where one class has very many labels."""
    n = 130_000  # some 98,000 of them ordinary labels outside the held-out fold
    rows = spark.range(n).selectExpr(
        "id AS doc_id", "cast(id % 17 = 0 AS int) AS toxic", "1 AS quality",
        "concat_ws(' ', concat('river', id % 7), concat('stone', id % 11), IF(xxhash64(id) % 10 < IF(id % 17 = 0, 4, -7),"
        " concat('grobbler', id % 5), concat('garden', id % 13)), 'quiet') AS text")
    model = T.fit(rows.select("doc_id", "text"), rows.select("doc_id", "quality", "toxic"))
    curve = rows.where("crc32(cast(cast(doc_id AS string) AS binary)) % 5 != 0 AND pmod(xxhash64('curve', doc_id), 1000) < 250")
    mean = T.score(curve, model).join(curve.select("doc_id", "toxic"), "doc_id").selectExpr("avg(score)", "avg(toxic)").first()
    assert abs(mean[0] / mean[1] - 1) < 0.02


def test_toxicity_model_leaves_out_the_rarest_grams_only(spark):
    counts = spark.createDataFrame([(i, 1 + i // 50, i % 2) for i in range(400)], "gram long, ordinary long, toxic long")
    assert T._commonest(counts, 400).count() == 400
    left = [r.ordinary + r.toxic for r in T._commonest(counts, 100).collect()]
    assert 0 < len(left) <= 100 and min(left) >= 7


def test_ratio_model_is_a_pair_of_distributions():
    """Over all bytes after a context, each class's probabilities sum to one."""
    data = np.frombuffer(b"abra cadabra abba bad cab ab a", np.uint8)
    gram, _, _ = T.byte_grams(data, np.array([0, len(data)]))
    grams, counts = np.unique(gram, return_counts=True)
    both = np.stack([counts, np.maximum(counts - 1, 0)], axis=1).astype(float)
    model = T.RatioModel(grams, both, 0.75)
    every = np.arange(256)
    # a context seen in both classes: sums of the two classes' probabilities are equal, so ratios average out
    context = int(model.contexts[0])
    ratio = model.gram_ratios((context << 8) + every)
    assert np.isfinite(ratio).all() and ratio.min() <= 0 <= ratio.max()


def test_byte_grams_stay_inside_words():
    data = np.frombuffer("ab  é\nabcdefgh".encode(), np.uint8)
    gram, word, n = T.byte_grams(data, np.array([0, 4, len(data)]))
    assert n == 3
    shown = [int(g).to_bytes(6, "big").lstrip(b"\0") for g in gram]
    assert [s for s, w in zip(shown, word) if w == 0] == [b" a", b" ab", b" ab "]
    assert [s for s, w in zip(shown, word) if w == 1] == [b" \xc3", b" \xc3\xa9", b" \xc3\xa9 "]
    assert [s for s, w in zip(shown, word) if w == 2][-2:] == [b"cdefgh", b"defgh "]


def quality_sample(n=2400):
    rows = []
    for i in range(n):
        r = random.Random(i)
        words = text(i, r.randrange(40, 200)).split()
        bad = i % 5 == 0
        if bad and i % 2:
            words = [w + r.choice(["%%%", "$$$", "###"]) for w in words]
        elif bad:
            words = [w for w in words[:8] for _ in range(12)]
        rows.append((i, " ".join(words), bad))
    return rows


def test_quality_on_held_out_rows(docs, spark):
    rows = quality_sample()
    df = docs(*[r[:2] for r in rows])
    own = labelled(spark, [(i, int(not bad), 0) for i, _, bad in rows if i % 3])
    model, prior = Q.fit(df, own)
    assert 0.65 < prior < 0.95
    got = {r.doc_id: r.score for r in Q.score(df, model).collect()}
    held = [(i, bad) for i, _, bad in rows if crc32(str(i).encode()) % 4 == 2]
    assert np.mean([(got[i] >= 0.7) != bad for i, bad in held]) > 0.95


def test_quality_edge_cases(docs, spark):
    df = docs(*[r[:2] for r in quality_sample(60)], *EDGES)
    none = labelled(spark, [(1, 1, 1)]).where("false")
    got = Q.score(df, Q.fit(df, none)[0]).collect()
    assert len(got) == 60 + len(EDGES) and {r.score for r in got} == {0.5}
    some = labelled(spark, [(i, None if i % 7 == 0 else 1, 0) for i in range(60)] + [(3, 0, 0), (None, 1, 0)])
    assert all(0 <= r.score <= 1 for r in Q.score(df, Q.fit(df, some)[0]).collect())
    assert Q.score(df.where("false"), Q.fit(df.where("false"), none)[0]).count() == 0


@pytest.mark.parametrize("t", ["", "one", "a a a a a b", "X! Y! Z! | | | %%%"])
def test_quality_features_are_finite_and_slice_independent(t):
    raw = t.encode()
    data = np.frombuffer(raw + b"other words here" + raw, np.uint8)
    ends = np.array([0, len(raw), len(raw) + 16, len(data)])
    x = Q.features(data, ends)
    assert x.shape == (3, Q.N_FEATURES) and np.isfinite(x).all()
    assert (x[0] == x[2]).all()
