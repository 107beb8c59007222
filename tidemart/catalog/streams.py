"""Streams over the event table."""

from pyspark.sql import functions as F

from tidemart.catalog.registry import query
from tidemart.operators.incremental import read_bucketed
from tidemart.session import scratch_dir
from tidemart.streaming import streams as st


def events(w):
    schema = w.table("events").schema
    stream = st.file_stream(w.spark, w.sf_dir, schema, names="events.parquet")
    return stream.withColumn("value", F.col("value").cast("decimal(18,2)"))


@query("st01_file_ingest")
def _(w):
    """Run twice on the same folder: each event arrives once."""
    base = scratch_dir(w.spark, "ingest")
    for _ in range(2):
        st.ingest_new_files(events(w), f"{base}/events", f"{base}/checkpoint")
    return w.spark.read.parquet(f"{base}/events").groupBy("event_type").agg(
        F.count("*").alias("events_n"), F.sum("value").alias("total")
    )


@query("st02_stream_dedup")
def _(w):
    """Every event sent twice, kept once."""
    base = scratch_dir(w.spark, "dedup")
    twice = events(w).unionByName(events(w))
    kept = st.dedup_stream(twice, ["event_id"], "ts")
    st.append_closed(kept, f"{base}/events", f"{base}/checkpoint")
    return w.spark.read.parquet(f"{base}/events").select("event_id", "ts", "event_type", "value")


@query("st02_stream_dedup_however_late")
def _(w):
    """Nine of ten events arrive first; then the others, twice, up to months late, with copies of the first."""
    base = scratch_dir(w.spark, "dedup")
    rows = w.table("events").withColumn("value", F.col("value").cast("decimal(18,2)"))
    late = rows.where("event_id % 10 = 0")
    for arrival in (rows.where("event_id % 10 <> 0"), late.unionAll(late), rows.where("event_id % 7 = 0")):
        arrival.write.mode("append").parquet(f"{base}/in")
        st.dedup_into(
            w.spark, lambda: st.file_stream(w.spark, f"{base}/in", rows.schema), ["event_id"], "ts",
            f"{base}/events", f"{base}/checkpoint")
    return w.spark.read.parquet(f"{base}/events").select("event_id", "ts", "event_type", "value")


@query("st03_daily_rollup_closed_days")
def _(w):
    base = scratch_dir(w.spark, "rollup")
    rollup = st.daily_rollup(events(w), "ts", "value")
    st.append_closed(rollup, f"{base}/days", f"{base}/checkpoint")
    return w.spark.read.parquet(f"{base}/days")


@query("st04_stream_upsert")
def _(w):
    """The open days too: updates replace the day's row in the mart."""
    base = scratch_dir(w.spark, "mart")
    rollup = st.daily_rollup(events(w), "ts", "value")
    st.upsert_updates(w.spark, rollup, ["day"], f"{base}/days", f"{base}/checkpoint")
    return read_bucketed(w.spark, f"{base}/days")
