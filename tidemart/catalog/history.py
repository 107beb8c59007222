"""Type 2 history of sellers."""

from pyspark.sql import functions as F

from tidemart.catalog.registry import query
from tidemart.operators.scd2 import first_versions, read_history, scd2, take_snapshot
from tidemart.plans.flows import SELLER_CHECKS, seller_history
from tidemart.session import scratch_dir

FIRST, SECOND, THIRD = "1996-01-01 00:00:00", "1998-01-01 00:00:00", "1999-01-01 00:00:00"


def edge_id(sellers, agg):
    return sellers.agg(agg("seller_id")).scalar()


def changed_sellers(sellers):
    """The lowest id moves, is rated up (to 5 at most) and changes its type."""
    hit = F.col("seller_id") == edge_id(sellers, F.min)
    rated = F.least(F.lit(5).cast("decimal(3,1)"), F.col("seller_rating") + F.lit("0.4").cast("decimal(2,1)"))
    return sellers.withColumns(
        {
            "seller_rating": F.when(hit, rated).otherwise(F.col("seller_rating")).cast("decimal(3,1)"),
            "seller_city": F.when(hit, "Pune").otherwise(F.col("seller_city")),
            "business_type": F.when(hit, "Brand Store").otherwise(F.col("business_type")),
        }
    )


def two_snapshots(w):
    """History after the change above and the loss of the highest id."""
    before = w.stg_sellers
    after = changed_sellers(before).filter(F.col("seller_id") != edge_id(before, F.max))
    history = first_versions(before, F.lit(FIRST))
    return scd2(history, after, "seller_id", SELLER_CHECKS, F.lit(SECOND))


query("a02_scd2_two_snapshots")(two_snapshots)
query("a04_demo_change")(lambda w: changed_sellers(w.stg_sellers))


@query("a02_scd2_persisted")
def _(w):
    """The same through the stored form, plus a third snapshot that undoes the change."""
    base = scratch_dir(w.spark, "sellers_history")
    before = w.stg_sellers
    after = changed_sellers(before).filter(F.col("seller_id") != edge_id(before, F.max))
    for sellers, stamp in ((before, FIRST), (after, SECOND), (before, THIRD), (before, THIRD)):
        take_snapshot(w.spark, base, sellers, "seller_id", SELLER_CHECKS, stamp)
    return read_history(w.spark, base)


query("a03_dim_seller_history")(lambda w: seller_history(two_snapshots(w)))
