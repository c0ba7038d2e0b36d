"""Entry 1 - the weekly build: staging -> activity -> signals -> features -> scores.

Returns lazy DataFrames; nothing executes until a sink or an action runs. Shared
inputs (staged tables) are plain lazy views, so Catalyst prunes columns per consumer.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from riskweave.config import Settings
from riskweave.operators import activity as act
from riskweave.operators import features as feat
from riskweave.operators import scoring, signals
from riskweave.sources.staging import stage_all


@dataclass
class WeeklyBuild:
    staged: dict[str, DataFrame]
    activity: DataFrame
    support: DataFrame
    billing: DataFrame
    features: DataFrame
    scores: DataFrame


def build(
    raw: dict[str, DataFrame],
    s: Settings,
    stamp: bool = True,
    accounts: DataFrame | None = None,
) -> WeeklyBuild:
    """accounts: staged accounts to use instead of raw["accounts"]; in multi-run mode
    they may already carry the run column (per-run account state), otherwise every run
    sees the same accounts."""
    st = stage_all(raw)
    if accounts is not None:
        st["accounts"] = accounts
    if s.run_col and s.run_col not in st["accounts"].columns:
        st["accounts"] = s.tag_runs(st["accounts"])
    accounts, events = st["accounts"], st["product_events"]
    activity = act.activity_weekly(accounts, events, s, stamp=stamp)
    support = signals.support_signals(accounts, st["support_tickets"], s)
    billing = signals.billing_signals(accounts, st["billing_events"], events, s)
    features = feat.churn_features(activity, support, billing, s)
    scores = scoring.risk_scores(features, s, stamp=stamp)
    return WeeklyBuild(st, activity, support, billing, features, scores)


def run_weekly(
    raw: dict[str, DataFrame],
    s: Settings,
    root: str,
    accounts: DataFrame | None = None,
    predict: Callable[[DataFrame], DataFrame] | None = None,
) -> dict[str, str]:
    """Entry 1 + 2 as a job: write every model in dependency order under `root`.

    Each model is written and read back before its consumers run (a written table in
    the shared folder cuts the lineage, and a lost executor recomputes one model, not
    the chain). Activity is upserted by week partition, the snapshot is applied to the
    stored history, the rest are full rebuilds. predict(features) gives the prediction
    table's rows (a fitted model's scores; default: the propensity); the side-by-side mart
    reads that table. The declared data tests run last, over the written models.
    Returns model name -> path.
    """
    import datetime as dt

    from riskweave.operators import alerts as al
    from riskweave.operators import compare as cmp
    from riskweave.operators.history import SNAPSHOT_COLUMNS
    from riskweave.operators.quality import run_suite
    from riskweave.sinks.tables import apply_snapshot, path_exists, upsert

    spark = raw["accounts"].sparkSession
    as_of = s.as_of or dt.datetime.now(dt.timezone.utc).date()
    s = replace(s, as_of=as_of)
    root = root.rstrip("/")
    paths = {
        "int_account_activity_weekly": f"{root}/intermediate/int_account_activity_weekly",
        "int_account_support_signals": f"{root}/intermediate/int_account_support_signals",
        "int_account_billing_signals": f"{root}/intermediate/int_account_billing_signals",
        "int_churn_features": f"{root}/intermediate/int_churn_features",
        "mart_churn_risk_scores": f"{root}/marts/mart_churn_risk_scores",
        "snp_churn_risk_scores": f"{root}/snapshots/snp_churn_risk_scores",
        "mart_churn_alerts": f"{root}/marts/mart_churn_alerts",
        "ml_predictions": f"{root}/ml_output/ml_predictions",
        "mart_churn_risk_scores_ml": f"{root}/marts/mart_churn_risk_scores_ml",
        "data_tests": f"{root}/data_tests",
    }

    def rebuild(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(paths[name])
        return spark.read.parquet(paths[name])

    st = stage_all(raw)
    if accounts is not None:
        st["accounts"] = accounts
    acc, events = st["accounts"], st["product_events"]
    incremental = path_exists(spark, paths["int_account_activity_weekly"])
    monday = as_of - dt.timedelta(days=as_of.weekday())
    weeks = [monday - dt.timedelta(days=7 * n) for n in range(s.spine_weeks)]
    activity = upsert(
        act.activity_weekly(acc, events, s, incremental=incremental),
        paths["int_account_activity_weekly"], ["account_id", "week_start"], "week_start",
        touched=weeks,
    )
    support = rebuild(signals.support_signals(acc, st["support_tickets"], s), "int_account_support_signals")
    billing = rebuild(
        signals.billing_signals(acc, st["billing_events"], events, s), "int_account_billing_signals"
    )
    features = rebuild(feat.churn_features(activity, support, billing, s), "int_churn_features")
    scores = rebuild(scoring.risk_scores(features, s), "mart_churn_risk_scores")
    ts = s.run_ts or dt.datetime.combine(as_of, dt.time())
    snapshot = apply_snapshot(
        spark, paths["snp_churn_risk_scores"], scores.select(*SNAPSHOT_COLUMNS), ts
    )
    alerts = rebuild(al.churn_alerts(scores, snapshot, s), "mart_churn_alerts")
    predictions = rebuild(
        predict(features) if predict else cmp.propensity_predictions(features, s), "ml_predictions"
    )
    mart_ml = rebuild(cmp.rule_vs_ml(scores, predictions), "mart_churn_risk_scores_ml")
    tables = {f"stg_{k}": v for k, v in st.items()} | {
        "int_account_activity_weekly": activity, "int_account_support_signals": support,
        "int_account_billing_signals": billing, "int_churn_features": features,
        "mart_churn_risk_scores": scores, "snp_churn_risk_scores": snapshot,
        "mart_churn_alerts": alerts, "mart_churn_risk_scores_ml": mart_ml,
    }
    rebuild(run_suite(tables), "data_tests")
    return paths
