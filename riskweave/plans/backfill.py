"""Entry 2 - score history: weekly score runs -> SCD2 history -> alerts.

A backfill scores several as_of dates in ONE plan (multi-run mode): the run date is a
column, complete weeks of events are aggregated once over the union of the spines, and
only each bounded run's partial current week is aggregated on its own. Dated sources
are bounded above for past runs (they must not see later events); the last run is the
live one and keeps `s.bound_future` as given, so the newest snapshot equals the scores
the alerts of that day read. Event scans: one pass over (runs' span + spine) weeks
instead of one spine per run.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.config import Settings
from riskweave.operators.history import SNAPSHOT_COLUMNS, scd2_apply, scd2_from_log
from riskweave.plans.weekly import build

RUN = "run_as_of"
AccountsFor = Callable[[dt.date], DataFrame]


def snapshot_ts(as_of: dt.date) -> dt.datetime:
    """A run on `as_of` is stamped at midnight of that day."""
    return dt.datetime.combine(as_of, dt.time())


def run_settings(s: Settings, as_ofs: Sequence[dt.date]) -> Settings:
    last = max(as_ofs)
    bounded = [d for d in as_ofs if d != last] + ([last] if s.bound_future else [])
    return Settings.runs(as_ofs, bounded=bounded, run_col=RUN, base=s)


def accounts_by_run(accounts: DataFrame, changed: DataFrame, as_ofs: Sequence[dt.date]) -> DataFrame:
    """Account states of every run from one scan of the accounts, keyed by (run_as_of, account_id).

    changed: (run_as_of, account_id, any account columns), one row per run and account that
    differed from today, with the values of that run; other accounts and columns keep today's."""
    values = [c for c in changed.columns if c not in (RUN, "account_id")]
    runs = accounts.withColumn(RUN, F.explode(F.array(*[F.lit(d) for d in sorted(as_ofs)])))
    then = changed.select(RUN, "account_id", F.struct(*values).alias("then"))
    state = {c: F.when(F.col("then").isNotNull(), F.col("then")[c]).otherwise(F.col(c)) for c in values}
    columns = [state[c].alias(c) if c in state else c for c in runs.columns]
    return runs.join(then, [RUN, "account_id"], "left").select(*columns)


def scores_by_run(
    raw: dict[str, DataFrame],
    s: Settings,
    as_ofs: Sequence[dt.date],
    accounts_for: AccountsFor | DataFrame | None = None,
) -> DataFrame:
    """Scores of every run in one plan, keyed by (run_as_of, account_id).

    accounts_for: staged account states of all runs (accounts_by_run), or a function that
    gives those as of a day; default is the same accounts for every run."""
    sr = run_settings(s, as_ofs)
    accounts = accounts_for if isinstance(accounts_for, DataFrame) else None
    if accounts is None and accounts_for is not None:
        accounts = reduce(
            DataFrame.unionByName,
            [accounts_for(d).withColumn(RUN, F.lit(d)) for d in sorted(as_ofs)],
        )
    return build(raw, sr, stamp=False, accounts=accounts).scores


def score_log(raw, s, as_ofs, accounts_for=None) -> DataFrame:
    sc = scores_by_run(raw, s, as_ofs, accounts_for)
    return sc.select(*SNAPSHOT_COLUMNS, F.col(RUN).cast("timestamp_ntz").alias("snapshot_ts"))


def _runs_frame(spark, as_ofs) -> DataFrame:
    return spark.createDataFrame([(snapshot_ts(d),) for d in as_ofs], "snapshot_ts timestamp_ntz")


def history_from_scores(scores: DataFrame, as_ofs: Sequence[dt.date]) -> DataFrame:
    """SCD2 history from a scores_by_run frame (lag/lead over the score log)."""
    log = scores.select(*SNAPSHOT_COLUMNS, F.col(RUN).cast("timestamp_ntz").alias("snapshot_ts"))
    return scd2_from_log(log, runs=_runs_frame(scores.sparkSession, as_ofs))


def live_scores(scores: DataFrame, as_ofs: Sequence[dt.date]) -> DataFrame:
    """The last (live) run of a scores_by_run frame: the current week's scores."""
    return scores.where(F.col(RUN) == F.lit(max(as_ofs))).drop(RUN)


def history_batch(raw, s, as_ofs, accounts_for=None) -> DataFrame:
    """SCD2 history of a backfill in one pass (lag/lead over the score log)."""
    return history_from_scores(scores_by_run(raw, s, as_ofs, accounts_for), as_ofs)


def history_fold(
    raw,
    s: Settings,
    as_ofs: Sequence[dt.date],
    accounts_for: AccountsFor | DataFrame | None = None,
    cut: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """SCD2 history built run by run with scd2_apply, as the weekly job does.

    `cut` materialises the run scores once and each intermediate history (e.g.
    DataFrame.checkpoint) so the lineage stays one run deep."""
    scores = scores_by_run(raw, s, as_ofs, accounts_for)
    if cut is not None:
        scores = cut(scores)
    hist = None
    for day in sorted(as_ofs):
        run = scores.where(F.col(RUN) == F.lit(day)).select(*SNAPSHOT_COLUMNS)
        hist = scd2_apply(hist, run, snapshot_ts(day))
        if cut is not None:
            hist = cut(hist)
    return hist
