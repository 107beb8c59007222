"""Quality by positive-unlabelled learning with a non-negative risk estimate.

Trusted positives are labelled rows of quality 1; the unlabelled side is web text as it comes, which
holds good and bad alike. With the class prior p, the risk of a scorer is
    p * E_pos[loss(+)] + max(0, E_unl[loss(-)] - p * E_pos[loss(-)])
whose second term, the risk on negatives, is kept from falling below zero. The prior is estimated
from how the scores of the two samples compare: the least ratio, over thresholds, of the unlabelled
share above it to the positive share above it (with a margin for sampling error). The scorer is
additive: each of some twenty surface rates of the text falls into one of its quantile bins, which
have a weight each. Rates that junk dominates only in places are also taken over the worst block of
64 words, so that a long text cannot hide them.

Defined cases: null and empty texts are scored, as texts with no words. Repeated label rows: good
only if all say so. Null labels teach nothing. Without positives every score is 0.5. Empty tables:
no rows. Only doc_id, text and quality are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import remainder, slices, to_batch
from tidemart.llm.textstats import SYMBOL, TextCounts, sums

BLOCK = 64
N_FEATURES = 19


@dataclass(frozen=True)
class QualityParams:
    #: rows of each sample, about (chosen by hash): all that training ever holds
    positives: int = 16_000
    unlabelled: int = 32_000
    bins: int = 12
    steps: int = 400
    rate: float = 0.05


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows of N_FEATURES surface rates for the texts of a slice."""
    t = TextCounts(data, offsets)
    n = np.maximum(t.n_words, 1)
    size = np.maximum(np.diff(offsets), 1)
    upper = (data >= 0x41) & (data <= 0x5A)
    lower = (data >= 0x61) & (data <= 0x7A)
    digit = (data >= 0x30) & (data <= 0x39)
    chars = sums((data & 0xC0) != 0x80, t.starts, t.ends)
    symbols = sums(SYMBOL[data], t.starts, t.ends)
    caps = sums(upper, t.starts, t.ends) > np.maximum(1, sums(lower, t.starts, t.ends))
    twice = np.zeros(len(t.hashes), bool)
    twice[1:] = (t.hashes[1:] == t.hashes[:-1]) & (t.doc[1:] == t.doc[:-1])
    again = t.repeated_words(8)
    order = np.lexsort((t.hashes, t.doc))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (t.hashes[order][1:] != t.hashes[order][:-1]) | (t.doc[order][1:] != t.doc[order][:-1])
    distinct = np.bincount(t.doc[order], fresh, t.n_docs)
    bang = sums(data == 0x21, t.starts, t.ends)
    marks = t.bytes_where((data == 0x2E) | (data == 0x2C))
    lines = t.bytes_where(data == 0x0A) + 1
    # worst blocks of BLOCK words
    begins = np.concatenate([[0], np.cumsum(np.bincount(t.doc, minlength=t.n_docs))])
    place = np.arange(len(t.doc)) - begins[t.doc]
    edge = (place % BLOCK == 0).cumsum() - 1
    owner = t.doc[place % BLOCK == 0]
    held = np.maximum(np.bincount(edge, minlength=len(owner)), 16)

    def worst(values: np.ndarray) -> np.ndarray:
        out = np.zeros(t.n_docs)
        np.maximum.at(out, owner, np.bincount(edge, values, len(owner)) / held)
        return out

    columns = [
        np.log1p(t.n_words), t.bytes_where(SYMBOL[data]) / n, t.per_doc(caps) / n,
        t.n_dup_lines() / lines, t.per_doc(again) / n, t.per_doc(twice) / n,
        t.per_doc(chars) / n, t.per_doc(np.minimum(bang, 1)) / n, t.bytes_where(digit) / size, marks / n,
        distinct / n ** 0.75, t.bytes_where(upper) / size, t.n_words / lines, t.bytes_where(data >= 0x80) / size,
        worst(np.minimum(symbols, 1)), worst(caps), worst(twice), worst(again), worst(np.minimum(bang, 1)),
    ]
    return np.stack(columns, axis=1).astype(np.float64)


class Binned:
    """Weights per quantile bin of each feature."""

    def __init__(self, x: np.ndarray, bins: int):
        # quantiles of each feature; a value that many texts share (zero, mostly) gets its own bin
        self.edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0) for column in x.T]
        self.edges = [np.unique(np.concatenate([e, np.nextafter(e[:1], np.inf), np.quantile(c, [0.98, 0.995])])) if len(e) else e for e, c in zip(self.edges, x.T)]
        sizes = [len(e) + 1 for e in self.edges]
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.weights, self.bias = np.zeros(self.starts[-1]), 0.0

    def places(self, x: np.ndarray) -> np.ndarray:
        cut = [np.searchsorted(e, x[:, j], side="right") + self.starts[j] for j, e in enumerate(self.edges)]
        return np.stack(cut, axis=1) if cut else np.zeros((len(x), 0), np.int64)

    def logits(self, at: np.ndarray) -> np.ndarray:
        return self.weights[at].sum(axis=1) + self.bias


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(model: Binned, pos: np.ndarray, unl: np.ndarray, prior: float | None, steps: int, rate: float) -> None:
    """Adam on the non-negative risk; without a prior, on telling the two samples apart."""
    size = len(model.weights)
    first, second = np.zeros(size + 1), np.zeros(size + 1)

    def scatter(at, slope):
        out = np.bincount(at.ravel(), np.repeat(slope, at.shape[1]), size)
        return np.append(out, slope.sum())

    for step in range(1, steps + 1):
        p, u = _sigmoid(model.logits(pos)), _sigmoid(model.logits(unl))
        up = scatter(pos, (p - 1) / len(pos))       # slope of E_pos loss(+)
        down_u = scatter(unl, u / len(unl))         # slope of E_unl loss(-)
        down_p = scatter(pos, p / len(pos))         # slope of E_pos loss(-)
        if prior is None:
            slope = up + down_u
        else:
            negative = -np.log(np.maximum(1 - u, 1e-13)).mean() + prior * np.log(np.maximum(1 - p, 1e-13)).mean()
            # below zero the estimate is overfitted: step back instead
            slope = prior * up + (down_u - prior * down_p) if negative >= 0 else prior * down_p - down_u
        slope[:-1] += 1e-4 * model.weights
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        model.weights -= move[:-1]
        model.bias -= move[-1]


def estimate_prior(pos: np.ndarray, unl: np.ndarray) -> float:
    """Least ratio of shares above a threshold, unlabelled over positive, from held-out scores."""
    if not len(pos) or not len(unl):
        return 0.5  # nothing to tell it by
    cuts = np.quantile(pos, np.linspace(0.01, 0.7, 70))
    above_p = np.array([(pos >= c).mean() for c in cuts])
    above_u = np.array([(unl >= c).mean() for c in cuts])
    slack = np.sqrt(np.log(40) / (2 * len(unl))) + np.sqrt(np.log(40) / (2 * len(pos)))
    best = int(np.argmin((above_u + slack) / above_p))
    return float(np.clip(above_u[best] / above_p[best], 0.02, 0.98))


def learn(pos: np.ndarray, unl: np.ndarray, params: QualityParams = QualityParams()) -> tuple[Binned, float]:
    """(model, class prior) from feature rows of trusted positives and of unlabelled texts."""
    model = Binned(np.concatenate([pos, unl]), params.bins)
    if len(pos) < 2 or len(unl) < 2:
        return model, 0.5
    at_p, at_u = model.places(pos), model.places(unl)
    # the prior from scores of rows that a trial scorer has not seen, either half in turn
    shuffle = np.random.Generator(np.random.PCG64(7)).permutation
    halves_p, halves_u = np.array_split(shuffle(len(pos)), 2), np.array_split(shuffle(len(unl)), 2)
    priors = []
    for k in (0, 1):
        trial = Binned(np.concatenate([pos, unl]), params.bins)
        train(trial, at_p[halves_p[k]], at_u[halves_u[k]], None, params.steps // 2, params.rate)
        priors.append(estimate_prior(trial.logits(at_p[halves_p[1 - k]]), trial.logits(at_u[halves_u[1 - k]])))
    prior = float(np.mean(priors))
    model.bias = float(np.log(prior / (1 - prior)))
    train(model, at_p, at_u, prior, params.steps, params.rate)
    return model, prior


def _feature_rows(texts: DataFrame) -> DataFrame:
    def run(batches):
        schema = pa.schema([("side", pa.int32()), ("x", pa.list_(pa.float64()))])
        for rows, data, offsets in slices(batches):
            x = features(data, offsets)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, N_FEATURES), pa.int32()), pa.array(x.ravel()))
            yield to_batch(schema, rows.column("side"), flat)

    return texts.select("side", "text").mapInArrow(run, "side int, x array<double>")


def _draw(seed: str, share: float):
    """A hash of the id as a number from 0 to 1, below ``share``."""
    return F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) / float(1 << 30) < min(1.0, share)


def fit(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> tuple[Binned, float]:
    """(model, class prior). Both samples come from outside the held-out fold; features are worked out
    by Spark, and the driver holds params.positives + params.unlabelled rows of them, about."""
    own = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (remainder("doc_id", 4) != 2))
        .groupBy("doc_id").agg(F.min("quality").alias("quality")).where(F.col("quality") == 1).select("doc_id")
    )
    trusted = own.where(_draw("trusted", params.positives / max(own.count(), 1)))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    web = texts.where((remainder("doc_id", 4) != 2) & _draw("web", params.unlabelled / max(docs.count(), 1)))
    rows = _feature_rows(
        texts.join(F.broadcast(trusted), "doc_id").select("text", F.lit(1).alias("side"))
        .unionAll(web.select("text", F.lit(0).alias("side")))
    ).toPandas()
    # an order that no partitioning decides: sums of weights come out the same on every run
    x = np.stack(rows["x"].to_list()) if len(rows) else np.zeros((0, N_FEATURES))
    side = rows["side"].to_numpy(int)
    order = np.lexsort((*x.T[::-1], side))
    x, side = x[order], side[order]
    return learn(x[side == 1], x[side == 0], params)


def score(docs: DataFrame, model: Binned) -> DataFrame:
    """(doc_id, score) for every row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        m = sent.value
        for rows, data, offsets in slices(batches):
            p = _sigmoid(m.logits(m.places(features(data, offsets))))
            yield to_batch(schema, rows.column("doc_id").cast(pa.int64()), p)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
