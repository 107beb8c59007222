"""Reading raw feeds and clean entities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemart.contracts import CORRUPT, FEEDS
from tidemart.session import PACKED, path_exists


def read_csv_feed(spark: SparkSession, path: str, source: str) -> DataFrame:
    """One feed with its declared schema.

    The header has to name the columns in the declared order, otherwise the read fails;
    a row that does not parse keeps its text in ``_corrupt_record``.
    """
    schema = StructType(FEEDS[source].struct.fields + [StructField(CORRUPT, StringType())])
    return (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .schema(schema)
        .csv(path)
    )


def parse_csv_feed(
    spark: SparkSession, path: str, source: str, store: str
) -> tuple[DataFrame, DataFrame]:
    """(rows that parsed, rows that did not, with their text) of a CSV feed.

    The parsed feed is stored at ``store`` first: read lazily, a CSV scan converts only the
    columns a query uses, and which rows count as broken would change from query to query.
    """
    read_csv_feed(spark, path, source).write.mode("overwrite").option("compression", PACKED).parquet(store)
    parsed = spark.read.parquet(store)
    good = parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, parsed.filter(F.col(CORRUPT).isNotNull())


def read_csv_verbatim(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, as landed."""
    return spark.read.option("header", True).csv(path)


def split_typed(df: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """(rows in the declared types, rows that hold a value its type cannot take, as landed).

    A text that is there but reads as nothing is broken, as in a CSV parsed with its schema;
    it must not pass for a missing value. Columns beyond the declared ones stay.
    """
    types = {f.name: f.dataType for f in FEEDS[source].struct.fields if f.name in df.columns}
    broken = reduce(
        lambda a, b: a | b,
        [F.col(c).isNotNull() & F.col(c).try_cast(t).isNull() for c, t in types.items()],
        F.lit(False),
    )
    cast = [F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns]
    return df.filter(~broken).select(*cast), df.filter(broken)


def missing_columns(df: DataFrame, source: str) -> list[str]:
    """Required columns the feed lacks; any of them rejects the whole file."""
    return sorted(set(FEEDS[source].required) - set(df.columns))


def read_parquet_entity(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/{name}")


def load_entity(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Entity from the first form that exists: folder, Parquet file, CSV file (rows that read
    in the declared types)."""
    stem = f"{base.rstrip('/')}/{name}"
    if path_exists(spark, stem):
        return spark.read.parquet(stem)
    if path_exists(spark, f"{stem}.parquet"):
        return spark.read.parquet(f"{stem}.parquet")
    if path_exists(spark, f"{stem}.csv"):
        if name not in FEEDS:  # no declared types to read it by
            return spark.read.option("header", True).option("inferSchema", True).csv(f"{stem}.csv")
        df = read_csv_verbatim(spark, f"{stem}.csv")
        return split_typed(df, name)[0]
    raise FileNotFoundError(f"no folder, .parquet or .csv for {stem}")


def discover(spark: SparkSession, raw_dir: str) -> dict[str, str]:
    """Known feed name -> CSV path, for the files that exist."""
    paths = {name: f"{raw_dir.rstrip('/')}/{name}.csv" for name in FEEDS}
    return {name: p for name, p in paths.items() if path_exists(spark, p)}
