"""Each data test on a clean frame and on one with a planted violation."""

import datetime as dt

from riskweave.operators import quality as dq

ACC = "account_id string, plan_name string, mrr double"
EV = "event_id string, account_id string"
WEEK = "account_id string, week_start date"


def test_not_null_unique_accepted(spark):
    acc = spark.createDataFrame(
        [("a", "starter", 1.0), ("b", "growth", 2.0), ("b", "legacy", 3.0), (None, "enterprise", 4.0),
         ("c", None, 5.0)], ACC)
    assert dq.not_null(acc, "account_id").count() == 1
    assert [tuple(r) for r in dq.unique(acc, "account_id").collect()] == [("b", 2)]
    bad = dq.accepted_values(acc, "plan_name", ["starter", "growth", "enterprise"]).collect()
    assert [tuple(r) for r in bad] == [("legacy", 1)]  # NULL passes


def test_relationships_and_combination(spark):
    acc = spark.createDataFrame([("a", "starter", 1.0)], ACC)
    ev = spark.createDataFrame([("e1", "a"), ("e2", "zz"), ("e3", None)], EV)
    assert [r.event_id for r in dq.relationships(ev, "account_id", acc, "account_id").collect()] == ["e2"]
    d = dt.date(2001, 11, 5)
    wk = spark.createDataFrame([("a", d), ("a", d), ("b", d)], WEEK)
    assert dq.unique_combination(wk, ["account_id", "week_start"]).count() == 1


def test_suite_counts_planted_violations(spark):
    acc = spark.createDataFrame(
        [("a", "starter", 1.0), ("a", "starter", 1.0), ("b", "gold", 2.0), (None, "growth", 1.0)], ACC)
    ev = spark.createDataFrame([("e1", "a"), ("e2", "orphan")], EV)
    spec = {
        "acc": dq.TableTests(not_null=["account_id"], unique=["account_id"],
                             accepted={"plan_name": ["starter", "growth", "enterprise"]}),
        "ev": dq.TableTests(not_null=["event_id"], relationships={"account_id": ("acc", "account_id")}),
    }
    out = {(r.table_name, r.test_name): (r.failures, r.passed)
           for r in dq.run_suite({"acc": acc, "ev": ev}, spec).collect()}
    assert out[("acc", "not_null")] == (1, False)
    assert out[("acc", "unique")] == (1, False)
    assert out[("acc", "accepted_values")] == (1, False)
    assert out[("ev", "not_null")] == (0, True)
    assert out[("ev", "relationships")] == (1, False)


def test_declared_suite_has_79_tests():
    kinds = {}
    for c in dq.checks():
        kinds[c.test] = kinds.get(c.test, 0) + 1
    assert kinds == {"not_null": 54, "unique": 11, "accepted_values": 10, "relationships": 3,
                     "unique_combination": 1}


def test_event_id_uniqueness_is_measured_on_fixture(spark):
    """The key is not unique by construction; the test must measure it (here against SQL)."""
    import duckdb

    from riskweave.oracle import with_raw
    from riskweave.registry import _staged

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("supplier", "lineitem", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    want = con.execute(with_raw(
        "SELECT count(*) FROM (SELECT event_id FROM stg_product_events GROUP BY 1 HAVING count(*) > 1)"
    )).fetchone()[0]
    ev = _staged(spark, sf)["product_events"]
    assert dq.unique(ev, "event_id").count() == want


def test_nulls_are_counted_without_a_shuffle_of_keys(spark):
    df = spark.createDataFrame([("a", None), ("a", "x"), (None, None), (None, "y")], "k string, v string")
    declared = {"t": dq.TableTests(not_null=["k", "v"], unique=["k"])}
    got = {(r.test_name, r.column_name): r.failures for r in dq.run_suite({"t": df}, declared).collect()}
    assert got == {("not_null", "k"): 2, ("not_null", "v"): 2, ("unique", "k"): 1}
    plan = dq.run_suite({"t": df}, declared)._jdf.queryExecution().executedPlan().toString()
    # the keys' aggregate carries their count alone
    keyed = [x for x in plan.splitlines() if "Aggregate(keys=[k#" in x or "Aggregate(keys=[unique_field" in x]
    assert keyed and not any("count_if" in x or "isnull" in x for x in keyed)
