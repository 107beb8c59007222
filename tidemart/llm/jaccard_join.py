"""Exact Jaccard similarity join of documents on word shingles, by PartEnum signatures.

A document's set: its distinct 5-word shingles (words: runs without ASCII white space, A-Z
lower-cased); with fewer words the whole sequence is one shingle; without words the set is empty
and linked with nothing. Two documents link when intersection / union >= threshold.

How links are found
    Documents with equal sets form a class; only classes are compared. Sizes fall into bands
    (2^(b-1), 2^b]. For each band of the larger set, the feature domain is cut into partitions by
    hash. Two sets of sizes x, y that link differ in at most (x + y)(1 - t)/(1 + t) features, so at
    most that many partitions differ. A set enumerates, in one order of the partitions that holds
    for all sets, the contents of its first k + 1 non-empty partitions, k being that bound for its
    largest possible partner; by the pigeonhole principle two sets that link share one of these
    signatures. (PartEnum with subsets of one partition; only as many as the bound needs.) With SPARE
    more, they share SPARE + 1, and a pair that shares fewer is no candidate.
    Partitions of frequent shingles come last in the order, so that passages which many documents
    share become signatures only of documents that consist of little else. Which shingles count as
    frequent changes the work, never the result.
Candidates
    Groups of up to SMALL_GROUP classes with one signature give their pairs, and a pair is compared if it
    meets in SPARE + 1 of them (or in a larger group, which is treated by itself). In a larger
    group each class is compared with the group's least PIVOTS classes, which settles most components;
    then every pair of its classes is compared, block by block, so no group is ever held by one task.
    A block gives the number of links of each class, and of the links themselves only those that
    join components.
Defined cases
    Null text: as empty. Null ids: kept, with the component of their text; a component's id is its
    least non-null doc_id. Repeated rows: one output row each. An empty table: no rows. Only
    doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import lean, release, slices, to_batch
from tidemart.llm.components import components
from tidemart.llm.grams import mix, shingle_sets
from tidemart.session import Scratch, remove_path

SMALL_GROUP, PIVOTS = 16, 4
#: signatures beyond the bound; all that link share one more than this
SPARE = 7
#: a shingle of at least this many classes is put last; at most so many are sent to executors
FREQUENT, FREQUENT_KEPT = 12, 1 << 18
#: words of the bitmap that marks candidate classes before their sets are shuffled: 2^24 bits
BITMAP_WORDS = 1 << 18
BLOCK = 256
EVEN = ~np.uint64(1)

_KEYED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("key", pa.binary())])
_COUNTED = pa.schema([("shingle", pa.int64()), ("n", pa.int64())])
_SIGNED = pa.schema([("sig", pa.int64()), ("c", pa.int64())])
_SETS = pa.schema([("key", pa.binary()), ("c", pa.int64()), ("features", pa.binary())])
_FOUND = pa.schema([("big", pa.bool_()), ("x", pa.int64()), ("y", pa.int64()), ("shared", pa.int32())])


@dataclass(frozen=True)
class JoinParams:
    words: int = 5
    percent: int = 75  # Jaccard threshold


def _keys(found: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each set (zero for empty sets)."""
    sums = np.zeros((2, len(found) + 1), np.uint64)
    np.cumsum(mix(found ^ np.uint64(0x51ED270B35C7A1F3)), out=sums[0, 1:])
    np.cumsum(mix(found + np.uint64(0x2545F4914F6CDD1D)), out=sums[1, 1:])
    own = sums[:, offsets[1:]] - sums[:, offsets[:-1]]
    return mix(own[0]), mix(own[1])


def _binary(a: np.ndarray, b: np.ndarray, empty: np.ndarray) -> pa.Array:
    raw = np.stack([a, b], axis=1).astype(">u8").tobytes()
    return pa.array([None if e else raw[16 * i : 16 * i + 16] for i, e in enumerate(empty)], pa.binary())


def _classes_of(batches: Iterator[pa.RecordBatch], words: int):
    """Slices with their sets and keys, for the passes over the documents."""
    for rows, data, offsets in slices(batches):
        found, at = shingle_sets(data, offsets, words)
        yield rows, found, at, *_keys(found, at)


def _fresh(c: np.ndarray, sizes: np.ndarray, seen: set[int]) -> np.ndarray:
    """Which documents are the first of their class in this task (so far as `seen` remembers)."""
    if len(seen) > 1 << 18:
        seen.clear()
    out = np.zeros(len(c), bool)
    for i, k in enumerate(c.tolist()):
        if sizes[i] and k not in seen:
            seen.add(k)
            out[i] = True
    return out


def _c(key: str) -> Column:
    """The first half of a key as an even number, by which signatures name classes."""
    return F.conv(F.hex(F.substring(key, 1, 8)), 16, -10).cast("long").bitwiseAND(F.lit(-2))


def keyed(docs: DataFrame, params: JoinParams) -> DataFrame:
    """(doc_id, n_shingles, key) of each document; key is null for empty sets."""

    def run(batches):
        for rows, _, at, a, b in _classes_of(batches, params.words):
            sizes = np.diff(at)
            yield to_batch(_KEYED, rows.column("doc_id").cast(pa.int64()), sizes, _binary(a, b, sizes == 0))

    return docs.select("doc_id", "text").mapInArrow(lean(run), "doc_id long, n_shingles long, key binary")


def frequent_shingles(docs: DataFrame, params: JoinParams) -> np.ndarray:
    """Ascending hashes of shingles that many classes hold.

    Every shingle of every document is counted, in chunks of a task; what a chunk holds only once
    is not passed on, which can only leave a shingle in the ordinary order.
    """

    def run(batches):
        held, n, seen = [], 0, set()

        def counted():
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= 2
            return to_batch(_COUNTED, values[often].view(np.int64), counts[often])

        for _, found, at, a, _ in _classes_of(batches, params.words):
            fresh = _fresh(a, np.diff(at), seen)
            held.append(found[np.repeat(fresh, np.diff(at))])
            n += len(held[-1])
            if n > 1 << 21:
                yield counted()
                held, n = [], 0
        if held:
            yield counted()

    top = (
        docs.select("text").mapInArrow(lean(run), "shingle long, n long")
        .groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT)
        .orderBy(F.desc("n"), "shingle").limit(FREQUENT_KEPT)
    )
    found = top.select("shingle").toPandas()["shingle"].to_numpy(dtype=np.int64)
    return np.sort(found.view(np.uint64))


def signatures_of(
    found: np.ndarray, at: np.ndarray, frequent: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signature, position of its set, has the set too few partitions for SPARE) for many sets."""
    sizes = np.diff(at)
    band = np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64)
    top = np.int64(1) << band
    largest = sizes * 100 // percent
    hot = np.zeros(len(found), bool)
    if len(frequent):
        spot = np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)
        hot = frequent[spot] == found
    owner = np.repeat(np.arange(len(sizes)), sizes)
    spread, content = mix(found ^ np.uint64(0xA0761D6478BD642F)), mix(found)
    sigs, owners, scant = [], [], []
    for up in (0, 1):
        # own band: partners up to the band's end; next band: partners beyond it
        member = (largest > sizes) & ((largest > top) if up else np.ones(len(sizes), bool))
        partner = largest if up else np.minimum(largest, top)
        allowed = (sizes + partner) * (100 - percent) // (100 + percent)
        parts = ((top << up) * 55 // 100 + 64).astype(np.uint64)
        use = member[owner]
        if not use.any():
            continue
        own = owner[use]
        part = (spread[use] >> np.uint64(32)) * parts[own] >> np.uint64(32)
        order = np.lexsort((part, hot[use], own))
        own, part, late, value = own[order], part[order], hot[use][order], content[use][order]
        begin = np.ones(len(own), bool)
        begin[1:] = (own[1:] != own[:-1]) | (part[1:] != part[:-1]) | (late[1:] != late[:-1])
        begin = np.flatnonzero(begin)
        total = np.add.reduceat(value, begin)
        own, part, late = own[begin], part[begin], late[begin]
        first = np.ones(len(own), bool)
        first[1:] = own[1:] != own[:-1]
        first = np.flatnonzero(first)
        held = np.diff(np.append(first, len(own)))
        rank = np.arange(len(own)) - np.repeat(first, held)
        kept = rank <= allowed[own] + SPARE
        low = np.repeat(held <= allowed[own[first]] + SPARE, held)
        instance = (band[own] + up).astype(np.uint64)
        sig = mix(total + mix((part << np.uint64(8) | instance << np.uint64(1)) + late.astype(np.uint64)))
        sigs.append(sig[kept])
        owners.append(own[kept])
        scant.append(low[kept])
        # sets with no more non-empty partitions than may differ could agree on empty ones only
        few = np.flatnonzero(held <= allowed[own[first]])
        sigs.append(mix(instance[first][few] + np.uint64(0x8EBC6AF09C88C6E3)))
        owners.append(own[first][few])
        scant.append(np.ones(len(few), bool))
    if not sigs:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool)
    return np.concatenate(sigs), np.concatenate(owners), np.concatenate(scant)


def signatures(docs: DataFrame, frequent, params: JoinParams) -> DataFrame:
    """(sig, c): signatures of the classes; a class may come from several tasks.

    The last bit of c tells that the class has too few partitions for SPARE signatures more.
    """

    def run(batches):
        seen: set[int] = set()
        for _, found, at, a, _ in _classes_of(batches, params.words):
            sizes = np.diff(at)
            fresh = _fresh(a, sizes, seen)
            some = found[np.repeat(fresh, sizes)]
            ends = np.concatenate([[0], np.cumsum(sizes[fresh])])
            sig, own, low = signatures_of(some, ends, frequent.value, params.percent)
            yield to_batch(_SIGNED, sig.view(np.int64), (a[fresh][own] & EVEN).view(np.int64) | low)

    return docs.select("text").mapInArrow(lean(run), "sig long, c long")


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (sig, c): pairs of small groups, pairs with the least few (pivots)
    of large ones, and the rows of large groups. Holds one batch and at most SMALL_GROUP rows before it."""
    tail = np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = None  # (sig, pivots) of a large group that the last batch did not end

    def found(sig, c, inside, last):
        fresh = np.ones(len(sig), bool)
        fresh[1:] = (sig[1:] != sig[:-1]) | (c[1:] != c[:-1])
        sig, c = sig[fresh], c[fresh]
        if not len(sig):
            return None, sig, c, inside
        start = np.ones(len(sig), bool)
        start[1:] = sig[1:] != sig[:-1]
        start = np.flatnonzero(start)
        size = np.diff(np.append(start, len(sig)))
        large = np.repeat(size > SMALL_GROUP, size)
        pivots = [np.repeat(c[np.minimum(start + p, len(c) - 1)], size) for p in range(PIVOTS)]
        if inside is not None and sig[0] == inside[0]:
            large[: size[0]] = True
            for pivot, before in zip(pivots, inside[1]):
                pivot[: size[0]] = before
        keep = len(sig)
        if not last:
            if large[-1]:
                inside = (sig[-1], [pivot[-1] for pivot in pivots])
                # its last row stays to be told from a repeat at the next batch's start
            else:
                keep = int(start[-1])
        x, y, big, shared = [], [], [], []
        every = np.arange(len(sig))
        for step in range(1, SMALL_GROUP):
            left = every[: max(0, keep - step)]
            pair = left[(sig[left] == sig[left + step]) & ~large[left]] if len(left) else left
            if not len(pair):
                break
            x.append(c[pair])
            y.append(c[pair + step])
            big.append(np.zeros(len(pair), bool))
            shared.append(1 + SPARE * ((c[pair] | c[pair + step]) & 1))
        for pivot in pivots:
            far = np.flatnonzero(large[:keep] & (c[:keep] != pivot[:keep]))
            x.append(pivot[far])
            y.append(c[far])
            big.append(np.zeros(len(far), bool))
            shared.append(np.full(len(far), 1 + SPARE))
        whole = np.flatnonzero(large[:keep])
        x.append(sig[whole])
        y.append(c[whole])
        big.append(np.ones(len(whole), bool))
        shared.append(np.zeros(len(whole), np.int64))
        left, right = np.concatenate(x), np.concatenate(y) & ~1
        out = to_batch(_FOUND, np.concatenate(big), np.where(np.concatenate(big), left, left & ~1), right,
                       np.concatenate(shared).astype(np.int32))
        return out, sig[keep:], c[keep:], inside

    for batch in batches:
        sig = np.concatenate([tail[0], batch.column("sig").to_numpy()])
        c = np.concatenate([tail[1], batch.column("c").to_numpy()])
        out, *tail, inside = found(sig, c, inside, False)
        if out is not None:
            yield out
    out, *_ = found(*tail, inside, True)
    if out is not None:
        yield out


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if min(len(a), len(b)) * 100 < max(len(a), len(b)) * percent:
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def _verified(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])
    for batch in batches:
        one, two = batch.column("features_x"), batch.column("features_y")
        good = [
            _linked(np.frombuffer(one[i].as_buffer(), np.uint64), np.frombuffer(two[i].as_buffer(), np.uint64), percent)
            for i in range(batch.num_rows)
        ]
        rows = batch.filter(pa.array(good, pa.bool_()))
        yield to_batch(schema, rows.column("key_x"), rows.column("key_y"))


def _overlaps(sets: list[np.ndarray], left: slice, right: slice) -> np.ndarray:
    """Number of features that each set of ``left`` shares with each of ``right``."""
    names, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    every = np.arange(len(sets))
    common = np.zeros((len(every[left]), len(every[right])), np.float32)
    width = 4096
    cuts = np.searchsorted(column, np.arange(0, len(names) + width, width))
    for i, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])):
        dense = np.zeros((len(sets), width), np.float32)
        dense[row[lo:hi], column[lo:hi] - i * width] = 1
        common += dense[left] @ dense[right].T
    return np.rint(common).astype(np.int64)


def _compared(pdf: pd.DataFrame, percent: int, within: bool) -> pd.DataFrame:
    """(a, b, n) from the rows of a block, or of two, told apart by ``side``, of which all pairs across
    are compared: (class, null, its links), and (a, b, 0) for links that join components, as a spanning forest."""
    pdf = pdf.drop_duplicates("key")
    if not within:
        pdf = pdf.sort_values("side", kind="stable")
    n = len(pdf)
    split = n if within else int((pdf["side"] == 0).sum())
    left, right = slice(0, split), slice(0 if within else split, n)
    keys, labels = pdf["key"].tolist(), pd.factorize(pdf["component"])[0]
    out: list[tuple[bytes, bytes | None, int]] = []
    if len(keys[left]) and len(keys[right]):
        sets = [np.frombuffer(f, np.uint64) for f in pdf["features"]]
        sizes = np.array([len(s) for s in sets])
        common = _overlaps(sets, left, right)
        good = 100 * common >= percent * (sizes[left, None] + sizes[None, right] - common)
        if within:
            np.fill_diagonal(good, False)
        counts = good.sum(axis=1) if within else np.concatenate([good.sum(axis=1), good.sum(axis=0)])
        out += [(k, None, int(c)) for k, c in zip(keys, counts) if c]
        for i, j in zip(*np.nonzero(good & (labels[left, None] != labels[None, right]))):
            j += right.start
            if labels[i] != labels[j]:
                out.append((keys[i], keys[j], 0))
                labels[labels == labels[j]] = labels[i]
    return pd.DataFrame(out, columns=["a", "b", "n"]).astype({"a": object, "b": object, "n": "int64"})


def _block_links(pdf: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links that join the components of the rows of one block, as a spanning forest."""
    found = _compared(pdf, percent, True)
    return found.loc[found["b"].notna(), ["a", "b"]]


def _sets(docs: DataFrame, wanted: DataFrame, params: JoinParams, scratch: Scratch) -> DataFrame:
    """(key, c, features), one row for each class whose c is in ``wanted``.

    A bitmap of 2^24 bits, at most 2^18 rows of one word, keeps most other sets from the shuffle.
    """

    def run(batches):
        seen: set[int] = set()
        for _, found, at, a, b in _classes_of(batches, params.words):
            fresh = np.flatnonzero(_fresh(a, np.diff(at), seen))
            key = np.stack([a, b], axis=1).astype(">u8").tobytes()
            yield to_batch(
                _SETS, [key[16 * i : 16 * i + 16] for i in fresh], (a[fresh] & EVEN).view(np.int64),
                [found[at[i] : at[i + 1]].tobytes() for i in fresh],
            )

    word = lambda c: F.shiftrightunsigned(c, 6).bitwiseAND(F.lit(BITMAP_WORDS - 1))
    bit = lambda c: F.expr("shiftleft(1L, cast(c & 63 as int))")
    marks = wanted.groupBy(word(F.col("c")).alias("word")).agg(F.bit_or(bit("c")).alias("bits"))
    sets = docs.select("text").mapInArrow(lean(run), "key binary, c long, features binary")
    likely = (
        sets.withColumn("word", word(F.col("c")))
        .join(F.broadcast(marks), "word")
        .where(F.col("bits").bitwiseAND(bit("c")) != 0)
        .select("key", "c", "features")
    )
    # dealt once by c: both what follows and the join that drops the bitmap's misses use that
    exact = likely.repartition("c").join(wanted.select("c").distinct(), "c", "left_semi")
    return scratch.keep(exact.groupBy("c", "key").agg(F.first("features").alias("features")), "sets")


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    side = lambda s: sets.select(
        F.col("c").alias(s), F.col("key").alias(f"key_{s}"), F.col("features").alias(f"features_{s}"))
    return pairs.join(side("x"), "x").join(side("y"), "y").mapInArrow(
        lambda batches: _verified(batches, percent), "a binary, b binary")


def _between_blocks(
    groups: DataFrame, sets: DataFrame, component: DataFrame, params: JoinParams, scratch: Scratch
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What _compared gives for all classes that share a large signature group (sig, c), the home
    of each class (key, home) and the pairs of homes that were compared (h1, h2).

    Copies of one text share many groups. So that two classes meet once and not once a group, each
    class has one home, its largest group; homes that meet in some group are compared, in blocks
    of about BLOCK classes to a side. A class links with classes of homes that its own has not met
    only if they share small groups, as two that share a large one have homes that meet in it.
    """
    rows = (
        groups.join(sets.select("c", "key"), "c")
        .join(component.select(F.col("node").alias("key"), "component"), "key", "left")
        .select("sig", "key", F.coalesce("component", "key").alias("component"))
    )
    sized = rows.groupBy("sig").agg(F.count("*").alias("n"))
    rows = scratch.keep(rows.join(sized, "sig"), "large")
    homes = scratch.keep(
        rows.groupBy("key").agg(
            F.max_by("sig", F.struct("n", "sig")).alias("home"), F.first("component").alias("component")),
        "homes")
    blocks = homes.groupBy("home").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    seen = rows.join(homes.select("key", "home"), "key").select("sig", "home").distinct()
    met = (
        seen.withColumnRenamed("home", "h1").join(seen.withColumnRenamed("home", "h2"), "sig")
        .where(F.col("h1") <= F.col("h2")).select("h1", "h2").distinct()
        .join(blocks.select(F.col("home").alias("h1"), F.col("blocks").alias("b1")), "h1")
        .join(blocks.select(F.col("home").alias("h2"), F.col("blocks").alias("b2")), "h2")
    )
    met = scratch.keep(met, "met")
    own = lambda n: F.pmod(F.xxhash64("key"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    one = met.join(homes.withColumnRenamed("home", "h1"), "h1").withColumn("i", own("b1")).withColumn("j", each("b2"))
    two = (
        met.where(F.col("h1") != F.col("h2")).join(homes.withColumnRenamed("home", "h2"), "h2")
        .withColumn("j", own("b2")).withColumn("i", each("b1"))
    )
    same = F.col("h1") == F.col("h2")
    dealt = one.select(
        "h1", "h2", F.when(same, F.least("i", "j")).otherwise(F.col("i")).alias("i"),
        F.when(same, F.greatest("i", "j")).otherwise(F.col("j")).alias("j"),
        (same & (F.col("i") > F.col("j"))).cast("int").alias("side"), "key", "component",
    ).unionAll(two.select("h1", "h2", "i", "j", F.lit(1).alias("side"), "key", "component"))

    def compared(block, pdf):
        h1, h2, i, j = block
        return _compared(pdf, params.percent, h1 == h2 and i == j)

    found = (
        dealt.join(sets.select("key", "features"), "key").groupBy("h1", "h2", "i", "j")
        .applyInPandas(compared, "a binary, b binary, n long")
    )
    return found, homes.select("key", "home"), met.select("h1", "h2")


def jaccard_join(docs: DataFrame, params: JoinParams = JoinParams()) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links), one row per row of ``docs`` (doc_id, text).

    component_id is the least doc_id reachable by links; n_links is the number of other classes that
    the document's class links with (documents with equal sets count once).
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    rows = scratch.keep(keyed(docs, params), "keyed")
    frequent = spark.sparkContext.broadcast(frequent_shingles(docs, params))
    found = scratch.keep(
        signatures(docs, frequent, params).repartition("sig").sortWithinPartitions("sig", "c")
        .mapInArrow(lean(_grouped), "big boolean, x long, y long, shared int"),
        "found",
    )
    pairs = (
        found.where(~F.col("big")).select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"), "shared")
        .groupBy("x", "y").agg(F.sum("shared").alias("shared")).where(F.col("shared") > SPARE)
    )
    release(spark)
    # sets of too different sizes cannot link; a c may stand for several classes, however unlikely
    sizes = rows.where(F.col("key").isNotNull()).groupBy(_c("key").alias("c")).agg(
        F.min("n_shingles").alias("lo"), F.max("n_shingles").alias("hi"))
    for side in ("x", "y"):
        pairs = pairs.join(sizes.select(F.col("c").alias(side), F.col("lo").alias(f"lo_{side}"), F.col("hi").alias(f"hi_{side}")), side)
    able = (F.col("hi_x") * 100 >= F.col("lo_y") * params.percent) & (F.col("hi_y") * 100 >= F.col("lo_x") * params.percent)
    pairs = scratch.keep(pairs.where(able).select("x", "y"), "pairs")
    groups = scratch.keep(found.where("big").select(F.col("x").alias("sig"), F.col("y").alias("c")), "groups")
    # what is left of it by now is these two; it goes before the sets, the largest table, come
    remove_path(spark, f"{scratch.base}/found")
    wanted = pairs.select(F.col("x").alias("c")).unionAll(pairs.select(F.col("y").alias("c")))
    wanted = wanted.unionAll(groups.select("c")).distinct()
    sets = _sets(docs, wanted, params, scratch)
    release(spark)
    links = scratch.keep(_verify(pairs, sets, params.percent), "links")
    release(spark)
    component = components(links, scratch, "first")
    compared, homes, met = _between_blocks(groups, sets, component, params, scratch)
    compared = scratch.keep(compared, "compared")
    more = compared.where(F.col("b").isNotNull()).select("a", "b")
    # links found between components join these; nothing inside them needs another look
    own = component.withColumnRenamed("component", "was")
    of = lambda side: own.select(F.col("node").alias(side), F.col("was").alias(f"of_{side}"))
    between = more.join(of("a"), "a", "left").join(of("b"), "b", "left").select(
        F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    joined = components(between, scratch, "second").select(F.col("node").alias("was"), F.col("component").alias("now"))
    moved = own.join(joined, "was", "left").select("node", F.coalesce("now", "was").alias("component"))
    # classes that only these links tie to others are components of their own so far
    single = joined.join(own.select("was").distinct(), "was", "left_anti")
    component = moved.unionAll(single.select(F.col("was").alias("node"), F.col("now").alias("component")))
    # links of classes whose homes were compared are counted there already
    home = lambda side: homes.select(F.col("key").alias(side), F.col("home").alias(f"home_{side}"))
    apart = (
        links.join(home("a"), "a", "left").join(home("b"), "b", "left")
        .select("a", "b", F.least("home_a", "home_b").alias("h1"), F.greatest("home_a", "home_b").alias("h2"),
                (F.col("home_a").isNotNull() & F.col("home_b").isNotNull()).alias("both"))
        .join(met.withColumn("both", F.lit(True)), ["h1", "h2", "both"], "left_anti")
    )
    counted = apart.select(F.explode(F.array("a", "b")).alias("key"), F.lit(1).cast("long").alias("n")).unionAll(
        compared.where(F.col("b").isNull()).select("a", "n"))
    degree = counted.groupBy("key").agg(F.sum("n").alias("n_links"))
    classes = (
        rows.where(F.col("key").isNotNull()).groupBy("key").agg(F.min("doc_id").alias("least"))
        .join(component.withColumnRenamed("node", "key"), "key", "left")
        .join(degree, "key", "left")
        .select("key", "least", F.coalesce("component", "key").alias("component"),
                F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))
    )
    smallest = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    named = scratch.keep(classes.join(smallest, "component").select("key", "component_id", "n_links"), "named")
    for spent in ("groups", "pairs", "sets", "links", "compared", "large", "homes", "met"):
        remove_path(spark, f"{scratch.base}/{spent}")
    frequent.unpersist()
    with_set, without = rows.where(F.col("key").isNotNull()), rows.where(F.col("key").isNull())
    return with_set.join(named, "key").select("doc_id", "n_shingles", "component_id", "n_links").unionAll(
        without.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    )


def keep_one(docs: DataFrame, params: JoinParams = JoinParams()) -> DataFrame:
    """``docs`` with one row of each component: the one whose doc_id is the component's id.

    Rows without words link with nothing and stay. Rows that repeat both id and text stay once.
    """
    chosen = (
        jaccard_join(docs, params).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("doc_id").agg(F.count("*").alias("copies"))
        .select(F.col("doc_id").alias("chosen_id"), "copies")
    )
    kept = docs.join(chosen, docs["doc_id"].eqNullSafe(chosen["chosen_id"]))
    once = kept.where(chosen["copies"] == 1).select(*[docs[c] for c in docs.columns])
    again = kept.where(chosen["copies"] > 1).select(*[docs[c] for c in docs.columns])
    return once.unionAll(again.dropDuplicates(["doc_id", "text"]))
