"""Driver contract: entry() runs; every oracle key is a query; a spot check vs DuckDB."""

import sys
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from riskweave import oracle, registry  # noqa: E402
from tools.check_oracle import rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_entry_flagship(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:3] == ["account_id", "scored_week", "plan_name"]
    scores = [r.risk_score for r in rows]
    assert scores == sorted(scores, reverse=True)


def test_oracle_keys_are_registered():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    rows_only = set(registry.queries()) - set(oracle.oracle_sql())
    assert rows_only == {"ml_train_score", "ml_importance", "classification_report"}


def test_spot_check_against_duckdb(spark):
    con = duckdb.connect()
    for t in ("supplier", "lineitem", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name in ("risk_scores", "activity_weekly", "billing_signals", "propensity"):
        df = entry.queries()[name](spark, SF)
        res = con.execute(entry.oracle_sql()[name])
        dcols = [d[0] for d in res.description]
        assert sorted(df.columns) == sorted(dcols), name
        assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(dcols, res.fetchall()), name
