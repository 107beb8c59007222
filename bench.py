"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default: all cores) choose data
and cores. Three groups of figures, whole results produced in each:

* ``<query>``         the query straight from the raw tables, all layers derived on the way
* ``build_all``       feeds to clean, staging, star schema, marts, model tests, all written
* ``marts_<query>``   the question asked of the marts built before
"""

from __future__ import annotations

import json
import os
import time

from tidemart.catalog import QUERIES, ask
from tidemart.catalog.quality import SEGMENTS
from tidemart.plans.flows import run_all
from tidemart.plans.warehouse import Marts, Warehouse
from tidemart.session import build_session, scratch_dir
from tidemart.sources.crosswalk import LATEST

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
QUESTIONS = [n for n in QUERIES if n[0] in "qk" and n[1:3].isdigit()]
OPERATORS = [
    "w01_dedup_latest", "w02_customer_order_sequence", "a10_fact_orders",
    "a02_scd2_two_snapshots", "s05_upsert", "dq10_standard_suite", "dq13_quality_gate",
]


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]",
        **{"spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false",
           "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(label: str, action):
        start = time.perf_counter()
        out = action()
        times[label] = round(time.perf_counter() - start, 3)
        return out

    warehouse = Warehouse.over_tables(spark, SF_DIR)
    drain(ask("q08_cancellation_rate", warehouse))  # warm up the session
    for name in QUESTIONS + OPERATORS:
        timed(name, lambda n=name: drain(ask(n, warehouse)))

    def build():
        base = scratch_dir(spark, "bench")
        models, tests, checks = run_all(
            spark, warehouse.raw, base, "2002-01-01 00:00:00", LATEST, SEGMENTS
        )
        drain(tests)
        drain(checks)
        return models

    marts = Marts(timed("build_all", build))
    for name in QUESTIONS:
        if not name.startswith("k07"):  # k07 reads the raw feeds
            timed(f"marts_{name}", lambda n=name: drain(ask(n, marts)))
    print(
        json.dumps(
            {
                "metric": "total time of headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
