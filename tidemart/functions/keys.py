"""Surrogate keys and content fingerprints."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_TOKEN = "_dbt_utils_surrogate_key_null_"  # fixed value: public key convention


def surrogate_key(*cols: Column) -> Column:
    """md5 over the columns as text, with a token in place of nulls."""
    return F.md5(
        F.concat_ws("-", *[F.coalesce(c.cast("string"), F.lit(NULL_TOKEN)) for c in cols])
    )


def row_hash(columns: list[str], seed: int = 0) -> Column:
    """Hash of a row that a value moved to another column, null or not, changes.

    Spark's own hash passes over nulls, so each value goes in with a mark that it is there.
    """
    parts = [x for c in columns for x in (F.col(f"`{c}`").isNotNull(), F.col(f"`{c}`"))]
    return F.xxhash64(F.lit(seed), *parts)


def batch_digest(df: DataFrame) -> DataFrame:
    """One row (rows, digest): an order-blind digest of the whole content, 32 hex digits.

    Rows are hashed and added up twice, independently, which runs in parallel and combines
    before the shuffle, where a digest of the raw bytes would be one task's work. Column names
    are part of the digest, their order is not.
    """
    columns = sorted(df.columns)
    one, two = row_hash(columns), row_hash(columns, 1)
    total = lambda h: F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)).cast("string")
    content = F.concat_ws(":", F.lit("\x1f".join(columns)), F.count("*"), total(one), total(two),
                          F.coalesce(F.bit_xor(F.xxhash64(one, two)), F.lit(0)))
    return df.agg(F.count("*").alias("rows"), F.md5(content).alias("digest"))


#: row digests that one node of a digest tree takes in, about
LEAF_ROWS = 4096


def row_digests(df: DataFrame) -> DataFrame:
    """(d, n): the SHA-256 of each distinct row as bytes, and the number of its copies."""
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)]), {"ignoreNullFields": "false"})
    return df.select(F.unhex(F.sha2(row, 256)).alias("d")).groupBy("d").agg(F.count("*").alias("n"))


def _depth(rows: int) -> int:
    """Levels of ranges below the root of a digest tree."""
    depth = 0
    while rows > LEAF_ROWS * 16**depth:
        depth += 1
    return depth


def tree_digest(df: DataFrame, expected: int | None = None) -> tuple[int, str]:
    """(rows, digest): an order-blind cryptographic digest of the whole content, 64 hex digits.

    A row's digest is the SHA-256 of its values by column name, nulls written out. Rows are counted per
    digest, dealt to ranges of it and put in order there; a range's digest is that of its list, and ranges
    are put together by sixteens up to one root. The same for every order of rows and columns and
    every partitioning; a repeated row, a value in another column and a renamed column change it. No task
    holds more than about LEAF_ROWS digests, and equal rows travel as one, as 32 bytes and a count.

    The tree's depth follows from the number of rows. ``expected`` spares counting them first: they are
    counted in the tree, and only where their number gives another depth is the tree built again.
    """
    columns = sorted(df.columns)
    depth = _depth(df.count() if expected is None else expected)
    rows, root = _tree(df, depth)
    if _depth(rows) != depth:
        rows, root = _tree(df, _depth(rows))
    content = "\x1f".join([*columns, str(rows), root])
    return rows, hashlib.sha256(content.encode()).hexdigest()


def _tree(df: DataFrame, depth: int) -> tuple[int, str]:
    """(rows, root) of a digest tree."""
    # hexadecimal text would be twice as long: bytes sort the same way and are spelled out in their range
    prefix = F.substring(F.lower(F.hex(F.substring("d", 1, (depth + 1) // 2))), 1, depth)
    # dealt by their range first: gathered before the shuffle, lists would be sorted and copied twice
    nodes = row_digests(df).select(
        prefix.alias("p"), F.concat("d", F.col("n").cast("string").cast("binary")).alias("e")).repartition("p")
    nodes = nodes.withColumn("n", F.substring("e", 33, 20).cast("string").cast("long"))
    for level in range(depth, -1, -1):
        entries = F.array_sort(F.collect_list("e"))
        if level == depth:
            entries = F.transform(entries, lambda e: F.concat_ws(
                ":", F.lower(F.hex(F.substring(e, 1, 32))), F.substring(e, 33, 20).cast("string")))
        nodes = nodes.groupBy("p").agg(F.sha2(F.concat_ws(",", entries), 256).alias("e"), F.sum("n").alias("n"))
        nodes = nodes.select(
            F.substring("p", 1, level - 1 if level else 0).alias("p"), F.concat_ws(":", "p", "e").alias("e"), "n")
    root = nodes.first()
    return (root["n"], root["e"]) if root else (0, "")
