"""Toxicity by class-conditional Kneser-Ney models over the bytes of words.

Two models, toxic and ordinary, give each word (lower-cased, between spaces) a probability, byte by
byte with up to ORDER - 1 bytes of context that never leave the word. The highest order is counted
for each class; all lower orders are Kneser-Ney continuation counts of both classes together, so an
expression too rare to judge is smoothed towards the same distribution in both and says nothing.
A word's evidence is what its log-likelihood ratio exceeds `margin` by, so that the slight leanings of
ordinary words (a language more common in one class, say) do not add up. A text's evidence is the
mean over all its words (length-normalised), turned into a probability by a logistic curve that is
fitted on labelled rows kept out of the counts. All labelled rows outside the held-out fold take part,
in the shares the classes have, so that the prior behind a score does not depend on the table's size.

All grams take part. Up to `model_grams` of them are a model that every task holds. Beyond, the model is
a pair of tables worked out by Spark; tasks hold its commonest grams, and each slice of texts gets the
others it needs by a join.

Defined cases: null and empty texts score as texts without evidence. Repeated label
rows: toxic if any says so; null labels and rows without text teach nothing. Without both labels
the score is the share of toxic rows (0 if there are none). An empty table gives no rows. Only
doc_id, text and the label columns are read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.common import give_back, lean, lowered, remainder, slices, text_bytes, to_batch
from tidemart.llm.grams import SPACE, runs
from tidemart.session import Scratch

ORDER = 6  # bytes of a full gram: six fit a 48-bit code
#: labels of up to so many documents are sent to all tasks; beyond, texts and labels are shuffled
BROADCAST_LABELS = 1 << 20
#: steps of a unit of evidence in which the curve's rows are counted
STEPS = 4096
_COUNTS = pa.schema([("toxic", pa.int32()), ("gram", pa.int64()), ("n", pa.int64())])


@dataclass(frozen=True)
class ToxicityParams:
    #: grams that every task holds; if there are more, the rarest are looked up by a join
    model_grams: int = 1 << 21
    #: share of the labelled rows kept out of the counts to fit the curve
    curve_share: float = 0.25
    discount: float = 0.75
    margin: float = 4.0


def byte_grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(gram at each byte of each word and at its closing space, word number, words).

    A gram is the byte with the up to ORDER - 1 before it, from the space that opens the word,
    packed into an integer.
    """
    starts, ends, _ = runs(~SPACE[data], offsets)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    size = ends - starts + 1  # with the closing space
    word = np.repeat(np.arange(len(starts)), size)
    place = np.arange(len(word)) - np.repeat(np.cumsum(size) - size, size)
    at = starts[word] + place
    value = np.full(len(word), 0x20, np.int64)
    inside = place < size[word] - 1
    value[inside] = data[at[inside]]
    gram = value.copy()
    for back in range(1, ORDER):
        here = place >= back
        gram[here] |= value[np.flatnonzero(here) - back] << (8 * back)
        opens = place == back - 1
        gram[opens] |= 0x20 << (8 * back)
    return gram, word, len(starts)


def _split(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(context, lower-order gram) of grams; a gram of one byte is its own lower order."""
    context = gram >> 8
    top = np.zeros(len(gram), np.int64)
    for k in range(1, ORDER):
        top = np.where(gram >> (8 * k) > 0, k, top)
    return context, gram & ((np.int64(1) << (8 * top)) - 1)


class RatioModel:
    """log P(byte | context, toxic) - log P(byte | context, ordinary) for seen grams and contexts."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, discount: float):
        """grams ascending and distinct; counts[:, 0] ordinary, counts[:, 1] toxic."""
        lower = self._continuation(grams, discount)
        context, _ = _split(grams)
        self.grams = grams
        self.contexts, at = np.unique(context, return_inverse=True)
        logs, rest = [], []
        for k in (0, 1):
            total = np.bincount(at, counts[:, k], len(self.contexts))
            kinds = np.bincount(at, counts[:, k] > 0, len(self.contexts))
            spare = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
            own = np.where(total[at] > 0, np.maximum(counts[:, k] - discount, 0) / np.maximum(total[at], 1), 0.0)
            logs.append(np.log(own + spare[at] * lower))
            rest.append(np.log(spare))
        self.ratio = (logs[1] - logs[0]).astype(np.float32)
        self.unseen = (rest[1] - rest[0]).astype(np.float32)

    @staticmethod
    def _continuation(grams: np.ndarray, discount: float) -> np.ndarray:
        """Shared lower-order probability of each gram's byte after its context less one byte."""
        chain = [grams]
        while (chain[-1] > 0xFF).any():
            chain.append(np.unique(_split(chain[-1])[1]))
        below, known = np.full(len(chain[-1]), 1 / 257), chain[-1]
        for level in range(len(chain) - 1, 0, -1):
            own = chain[level]
            lower = below[np.searchsorted(known, _split(own)[1])] if level < len(chain) - 1 else np.full(len(own), 1 / 257)
            kinds = np.bincount(np.searchsorted(own, _split(chain[level - 1])[1]), minlength=len(own)).astype(float)
            contexts, at = np.unique(_split(own)[0], return_inverse=True)
            total = np.bincount(at, kinds, len(contexts))
            different = np.bincount(at, minlength=len(contexts))
            share = np.maximum(kinds - discount, 0) / total[at] + discount * different[at] / total[at] * lower
            below, known = share, own
        return below[np.searchsorted(known, _split(grams)[1])]

    def gram_ratios(self, gram: np.ndarray) -> np.ndarray:
        """What each gram adds to its word's log-likelihood ratio; 0 after an unseen context."""
        if not len(self.grams):
            return np.zeros(len(gram))
        spot = np.minimum(np.searchsorted(self.grams, gram), len(self.grams) - 1)
        seen = self.grams[spot] == gram
        out = np.where(seen, self.ratio[spot], np.float32(0))
        context = gram[~seen] >> 8
        spot = np.minimum(np.searchsorted(self.contexts, context), len(self.contexts) - 1)
        out[~seen] = np.where(self.contexts[spot] == context, self.unseen[spot], 0)
        return out


class KnownRatios:
    """Ratios of some grams, ascending; the others have to be looked up elsewhere."""

    def __init__(self, grams: np.ndarray, ratio: np.ndarray):
        self.grams, self.ratio = grams, ratio

    def find(self, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ratio, is it known) of each gram."""
        if not len(self.grams):
            return np.zeros(len(gram), np.float32), np.zeros(len(gram), bool)
        spot = np.minimum(np.searchsorted(self.grams, gram), len(self.grams) - 1)
        known = self.grams[spot] == gram
        return np.where(known, self.ratio[spot], np.float32(0)), known

    def gram_ratios(self, gram: np.ndarray) -> np.ndarray:
        return self.find(gram)[0]


@dataclass
class SpreadRatios:
    """The model as tables: ratios of all seen grams and of unseen bytes after all seen contexts."""

    common: KnownRatios  # held by every task
    grams: DataFrame  # gram, ratio
    contexts: DataFrame  # context, unseen


def evidence(model: RatioModel | KnownRatios, data: np.ndarray, offsets: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray]:
    """(square root of the mean excess ratio over words, mean ratio over words) of each text."""
    n_docs = len(offsets) - 1
    _, _, doc = runs(~SPACE[data], offsets)
    if not len(doc):
        return np.zeros(n_docs), np.zeros(n_docs)
    gram, word, n = byte_grams(data, offsets)
    # a slice repeats most of its grams: look each up once
    some, at = np.unique(gram, return_inverse=True)
    each = model.gram_ratios(some)
    ratio = np.bincount(word, each[at], n)
    words = np.maximum(np.bincount(doc, minlength=n_docs), 1)
    excess = np.bincount(doc, np.maximum(ratio - margin, 0), n_docs) / words
    return np.sqrt(excess), np.bincount(doc, ratio, n_docs) / words


def fit_curve(x: np.ndarray, y: np.ndarray, rows: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve by Newton's method, lightly pulled towards flat.

    Each point stands for so many ``rows``.
    """
    if not len(y) or y.min() == y.max():
        share = y.mean() if len(y) else 0.0  # 0 or 1
        return 0.0, float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    centre = np.average(x, weights=rows)
    scale = max(np.sqrt(np.average((x - centre) ** 2, weights=rows)), 1e-9)
    z = np.stack([(x - centre) / scale, np.ones(len(x))], axis=1)
    beta, pull = np.zeros(2), np.array([1e-2, 1e-6])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        slope = z.T @ (rows * (y - p)) - pull * beta
        curve = (z * (rows * p * (1 - p))[:, None]).T @ z + np.diag(pull + 1e-9)
        step = np.clip(np.linalg.solve(curve, slope), -2, 2)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0] / scale), float(beta[1] - beta[0] * centre / scale)


@dataclass
class ToxicityModel:
    ratios: RatioModel | SpreadRatios
    slope: float
    offset: float
    margin: float


def _taught(docs: DataFrame, labels: DataFrame, params: ToxicityParams) -> tuple[DataFrame, DataFrame]:
    """(text, toxic) of all labelled rows outside the held-out fold: those to count, those for the curve."""
    curve = F.pmod(F.xxhash64(F.lit("curve"), "doc_id"), F.lit(1000)) < int(1000 * params.curve_share)
    learnt = F.col("doc_id").isNotNull() & (remainder("doc_id", 5) != 0)
    own = (
        labels.where(learnt & F.col("toxic").isNotNull())
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).where(F.col("toxic").isin(0, 1))
    )
    if own.count() <= BROADCAST_LABELS:
        own = F.broadcast(own)
    texts = docs.where(learnt & F.col("text").isNotNull()).select("doc_id", "text")
    # each text is on one side only, so it is shuffled once at most
    counted, kept = (
        texts.where(side).join(own, "doc_id").select("text", "toxic") for side in (~curve, curve))
    return counted, kept


def _commonest(counts: DataFrame, limit: int) -> DataFrame:
    """``counts`` (gram, ordinary, toxic), without the rarest grams if there are more than ``limit``."""
    level = F.floor(16 * F.log2(F.col("ordinary") + F.col("toxic")))
    levels = counts.groupBy(level.alias("level")).agg(F.count("*").alias("n")).orderBy(F.desc("level")).collect()
    total = 0
    for r in levels:
        total += r["n"]
        if total > limit:
            return counts.where(level > r["level"])
    return counts


def _lower(gram: Column) -> Column:
    """``_split(gram)[1]`` as a column."""
    out = F.lit(0).cast("long")
    for k in range(1, ORDER):
        out = F.when(F.shiftright(gram, 8 * k) > 0, gram.bitwiseAND(F.lit((1 << 8 * k) - 1).cast("long"))).otherwise(out)
    return out


def _spread(counts: DataFrame, params: ToxicityParams, scratch: Scratch) -> SpreadRatios:
    """``RatioModel`` over any number of grams, by aggregates and joins.

    A context has at most 257 grams and a lower-order gram at most 256 above it, so no key is hot.
    """
    gram, off = F.col("gram"), params.discount
    context = F.shiftright(gram, 8).alias("context")
    chain = [counts.select("gram")]
    while chain[-1].agg(F.max("gram")).first()[0] > 0xFF:
        below = chain[-1].groupBy(_lower(gram).alias("gram")).agg(F.count("*").alias("kinds"))
        chain.append(scratch.keep(below, f"order-{ORDER - len(chain)}"))
    shares = None
    for own in reversed(chain[1:]):
        after = own.groupBy(context).agg(F.sum("kinds").alias("total"), F.count("*").alias("different"))
        own = own.select("gram", "kinds", context, _lower(gram).alias("lower")).join(after, "context")
        own = own.withColumn("share", F.lit(1 / 257)) if shares is None else own.join(shares, "lower")
        share = F.greatest(F.col("kinds") - off, F.lit(0.0)) / F.col("total") + (
            off * F.col("different") / F.col("total") * F.col("share"))
        shares = own.select(gram.alias("lower"), share.alias("share"))
    totals = [F.sum(k).alias(f"{k}_n") for k in ("ordinary", "toxic")]
    kinds = [F.count_if(F.col(k) > 0).alias(f"{k}_kinds") for k in ("ordinary", "toxic")]
    spare = {
        k: F.when(F.col(f"{k}_n") > 0, off * F.col(f"{k}_kinds") / F.col(f"{k}_n")).otherwise(1.0) for k in ("ordinary", "toxic")}
    contexts = scratch.keep(
        counts.groupBy(context).agg(*totals, *kinds)
        .withColumn("unseen", (F.log(spare["toxic"]) - F.log(spare["ordinary"])).cast("float")), "contexts")

    def log_share(k: str) -> Column:
        own = F.when(F.col(f"{k}_n") > 0, F.greatest(F.col(k) - off, F.lit(0.0)) / F.col(f"{k}_n")).otherwise(0.0)
        return F.log(own + spare[k] * F.col("share"))

    grams = scratch.keep(
        counts.select("gram", "ordinary", "toxic", context, _lower(gram).alias("lower"))
        .join(contexts, "context").join(shares, "lower")
        .select("gram", "ordinary", "toxic", (log_share("toxic") - log_share("ordinary")).cast("float").alias("ratio")),
        "ratios")
    some = _commonest(grams, params.model_grams).select("gram", "ratio").toArrow().sort_by("gram")
    common = KnownRatios(some.column("gram").to_numpy().astype(np.int64), some.column("ratio").to_numpy().astype(np.float32))
    return SpreadRatios(common, grams.select("gram", "ratio"), contexts.select("context", "unseen"))


def _by_slices(
    rows: DataFrame, ratios: SpreadRatios, margin: float, schema: str, scratch: Scratch,
    give: Callable[[pa.Table, np.ndarray, np.ndarray], pa.Table],
) -> DataFrame:
    """``give``(rows, evidence, mean ratio) for slices of ``rows``, each with the ratios of its own grams.

    Slices are numbered and kept, as texts and their grams have to meet again.
    """
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast(ratios.common)

    def number(batches):
        for part, _, _ in slices(batches):
            own = np.full(part.num_rows, uuid.uuid4().int >> 65)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(own)], [*part.schema.names, "slice"])

    def rare(batches):
        made = pa.schema([("slice", pa.int64()), ("gram", pa.int64())])
        for batch in batches:
            own = batch.column("slice").to_numpy()
            for k in np.unique(own):
                for _, data, offsets in slices([batch.filter(pa.array(own == k))], lower=True):
                    gram = np.unique(byte_grams(data, offsets)[0])
                    gram = gram[~sent.value.find(gram)[1]]
                    yield to_batch(made, np.full(len(gram), k), gram)

    def judge(left: pa.Table, right: pa.Table) -> pa.Table:
        grams, first = np.unique(right.column("gram").to_numpy(), return_index=True)
        own = KnownRatios(grams, right.column("value").to_numpy()[first])

        class Both:
            @staticmethod
            def gram_ratios(gram):
                value, known = sent.value.find(gram)
                return np.where(known, value, own.gram_ratios(gram))

        left = left.drop_columns(["slice"])
        data, offsets = text_bytes(lowered(left.column("text")))
        return give(left, *evidence(Both, data, offsets, margin))

    kept = scratch.keep(
        rows.mapInArrow(lean(number), T.StructType([*rows.schema.fields, T.StructField("slice", T.LongType())])), "slices")
    wanted = kept.select("slice", "text").mapInArrow(lean(rare), "slice long, gram long")
    values = (
        wanted.join(ratios.grams, "gram", "left")
        .join(ratios.contexts, F.shiftright("gram", 8) == F.col("context"), "left")
        .select("slice", "gram", F.coalesce("ratio", "unseen", F.lit(0).cast("float")).alias("value"))
    )
    return kept.groupBy("slice").cogroup(values.groupBy("slice")).applyInArrow(judge, schema)


def _count(batches, size=1 << 20):
    """Gram counts of each class, summed within a task before they are shuffled."""
    held = {0: (np.zeros(0, np.int64), np.zeros(0, np.int64)), 1: (np.zeros(0, np.int64), np.zeros(0, np.int64))}

    def out(k):
        grams, counts = held[k]
        return to_batch(_COUNTS, np.full(len(grams), k), grams, counts)

    for batch in batches:
        toxic = batch.column("toxic").to_numpy()
        for k in (0, 1):
            for _, data, offsets in slices([batch.filter(pa.array(toxic == k))], lower=True):
                gram, _, _ = byte_grams(data, offsets)
                some, n = np.unique(gram, return_counts=True)
                grams, at = np.unique(np.concatenate([held[k][0], some]), return_inverse=True)
                held[k] = grams, np.bincount(at, np.concatenate([held[k][1], n]), len(grams)).astype(np.int64)
            if len(held[k][0]) > size:
                yield out(k)
                held[k] = np.zeros(0, np.int64), np.zeros(0, np.int64)
    yield out(0)
    yield out(1)


def fit(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> ToxicityModel:
    """Counts are gathered by Spark over all labelled rows; the driver gets one row per distinct gram (at
    most params.model_grams, the commonest) and, for the curve, the number of rows at each step of evidence."""
    spark = docs.sparkSession
    counted, kept = _taught(docs, labels, params)
    with Scratch(spark, "toxicity") as scratch:
        every = scratch.keep(
            counted.mapInArrow(lean(_count), "toxic int, gram long, n long")
            .groupBy("gram").agg(
                F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("ordinary"),
                F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"),
            ), "grams")
        if every.count() <= params.model_grams:
            # as Arrow: rows as Python objects would take many times as much of the driver's memory
            counts = every.select("gram", "ordinary", "toxic").toArrow().sort_by("gram")
            both = np.stack([counts.column(c).to_numpy().astype(float) for c in ("ordinary", "toxic")], axis=1)
            model = RatioModel(counts.column("gram").to_numpy().astype(np.int64), both, params.discount)
            del counts, both
        else:
            model = _spread(every, params, Scratch(spark, "toxicity-model"))
        give_back()

        def points_of(toxic, x):
            schema = pa.schema([("toxic", pa.int32()), ("step", pa.int64())])
            return to_batch(schema, toxic, np.rint(x * STEPS).astype(np.int64))

        if isinstance(model, SpreadRatios):
            points = _by_slices(
                kept, model, params.margin, "toxic int, step long", scratch,
                lambda rows, x, _: pa.Table.from_batches([points_of(rows.column("toxic").combine_chunks(), x)]))
        else:
            sent = spark.sparkContext.broadcast(model)

            def run(batches):
                for rows, data, offsets in slices(batches, lower=True):
                    x = evidence(sent.value, data, offsets, params.margin)[0]
                    yield points_of(rows.column("toxic"), x)

            points = kept.mapInArrow(lean(run), "toxic int, step long")
        seen = (
            points.groupBy("step", "toxic").agg(F.count("*").alias("n"))
            .toArrow().sort_by([("step", "ascending"), ("toxic", "ascending")])
        )
    steps, toxic, n = (seen.column(c).to_numpy().astype(float) for c in ("step", "toxic", "n"))
    slope, offset = fit_curve(steps / STEPS, toxic, n)
    return ToxicityModel(model, slope, offset, params.margin)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, score, predicted, mean_ratio) for every row of ``docs``."""
    spark, slope, offset, margin = docs.sparkSession, model.slope, model.offset, model.margin
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32()), ("mean_ratio", pa.float64())])
    ddl = "doc_id long, score double, predicted int, mean_ratio double"
    docs = docs.select("doc_id", "text")

    def scored(ids, x, mean):
        p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -30, 30)))
        return ids.cast(pa.int64()), p, (p >= 0.5).astype(np.int32), mean

    if isinstance(model.ratios, SpreadRatios):
        with Scratch(spark, "toxicity-slices") as scratch:
            found = _by_slices(
                docs, model.ratios, margin, ddl, scratch, lambda rows, x, mean: pa.Table.from_batches(
                    [to_batch(schema, *scored(rows.column("doc_id").combine_chunks(), x, mean))]))
            return Scratch(spark, "toxicity-found").keep(found, "found")
    sent = spark.sparkContext.broadcast(model.ratios)

    def run(batches):
        for rows, data, offsets in slices(batches, lower=True):
            yield to_batch(schema, *scored(rows.column("doc_id"), *evidence(sent.value, data, offsets, margin)))

    return docs.mapInArrow(lean(run), ddl)


def keep_civil(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns.

    Rows pass through as Arrow batches: a task holds one batch and one slice of work.
    """
    spark, model = docs.sparkSession, fit(docs, labels, params)
    slope, offset, margin = model.slope, model.offset, model.margin
    if isinstance(model.ratios, SpreadRatios):
        with Scratch(spark, "toxicity-slices") as scratch:
            found = _by_slices(
                docs, model.ratios, margin, docs.schema, scratch, lambda rows, x, _: rows.filter(pa.array(slope * x + offset < 0)))
            return Scratch(spark, "toxicity-found").keep(found, "found")
    sent = spark.sparkContext.broadcast(model.ratios)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            texts = pa.RecordBatch.from_arrays([batch.column(at)], ["text"])
            for_all = [
                slope * evidence(sent.value, data, offsets, margin)[0] + offset < 0
                for _, data, offsets in slices([texts], lower=True)
            ]
            if for_all:
                yield batch.filter(pa.array(np.concatenate(for_all), pa.bool_()))

    return docs.mapInArrow(lean(run), docs.schema)
