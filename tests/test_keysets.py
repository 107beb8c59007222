"""Keys that are sent to all tasks instead of shuffling the rows that look for them."""

from pyspark.sql import functions as F

from tidemart.operators import checks as c
from tidemart.operators import keysets
from tidemart.plans import flows
from tidemart.session import scratch_dir

KEYS = (-130, -65, -64, -1, 0, 1, 63, 64, 127, 2**40, 2**63 - 1, -(2**63))


def test_packed_keys_are_exact(spark, rows, monkeypatch):
    keys = rows("k long", *[(k,) for k in KEYS], (0,), (None,))
    near = {n for k in KEYS for n in (k - 1, k, k + 1) if -(2**63) <= n < 2**63}
    df = rows("x long, n int", *[(n, 1) for n in near], (63, 2), (None, 1))
    want = sorted([(k, 1) for k in KEYS] + [(63, 2)])
    for most in (keysets.SENT_KEYS, 0):  # sent, and joined
        monkeypatch.setattr(keysets, "SENT_KEYS", most)
        assert sorted(tuple(r) for r in keysets.of_keys(df, "x", keys, "k").collect()) == want
    assert keysets.packed(rows("k long", *[(k,) for k in range(128)]), "k").count() == 2


def test_rows_are_not_shuffled_for_many_neighbouring_keys(spark, rows, plan, monkeypatch):
    """Whole numbers without a parent: 150 keys are 3 words; as text they are 150."""
    monkeypatch.setattr(c, "SENT_KEYS", 10)
    ids = [(i, str(i)) for i in range(-50, 100)]
    tables = {
        "payments": rows("order_id long, payment_sequential int", *[(i, 1) for i, _ in ids], (1000, 1), (None, 1)),
        "returns": rows("return_id string, order_id string", *[(t, t) for _, t in ids]),
        "orders": rows("order_id long, customer_id long, order_purchase_ts string", (1000, 1, None)),
    }
    rules = c.standard_suite(tables, {"order_status": (), "payment_status": ()})
    findings = flows.kept_findings(c.find(tables, rules), scratch_dir(spark, "findings"))
    sent = c.sendable(findings)
    assert {rules[i].table for i in sent} == {"payments", "orders"}
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(key, "-1")
    try:
        flagged = flows.quarantined_rows(tables, "payments", rules, findings, sent)
        assert "SortMergeJoin" not in plan(flagged) and "hashpartitioning(order_id" not in plan(flagged)
        assert sorted(r.order_id for r in flagged.collect()) == [i for i, _ in ids]
        joined = flows.quarantined_rows(tables, "payments", rules, findings)
        assert sorted(map(str, joined.collect())) == sorted(map(str, flagged.collect()))
        texts = flows.quarantined_rows(tables, "returns", rules, findings, sent)
        assert texts.count() == 150 and texts.where(F.size("quarantine_reasons") != 1).isEmpty()
    finally:
        for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(key)
