"""Name -> query, and the form results are handed out in."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.plans.warehouse import Warehouse

QUERIES: dict[str, Callable[[Warehouse], DataFrame]] = {}


def query(name: str):
    def register(fn: Callable[[Warehouse], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        return fn

    return register


def publish(df: DataFrame) -> DataFrame:
    """Plain output types: whole numbers as bigint, other numbers as double, local timestamps."""

    def plain(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            return c.cast("bigint").alias(field.name)
        if isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            return c.cast("double").alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return c.cast("timestamp_ntz").alias(field.name)
        return c

    return df.select(*[plain(f) for f in df.schema.fields])


def ask(name: str, warehouse) -> DataFrame:
    """Result of a query on a warehouse, or on built marts for the questions they answer."""
    return publish(QUERIES[name](warehouse))


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return ask(name, Warehouse.over_tables(spark, sf_dir))
