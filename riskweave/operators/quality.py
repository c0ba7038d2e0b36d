"""Data tests as Spark queries (DQ1-6).

Each test returns its violating rows (the dbt convention: a test fails when its query
returns rows). The suite runner folds every test into one (table, test, column,
failures, passed) frame; a table's not_null tests share one pass without a shuffle, its
keys are shuffled with a count and nothing else, and accepted_values tests group only the
rows that violate them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.sources import schemas as SC


# --- single tests: violating rows --------------------------------------------------


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def unique(df: DataFrame, col: str) -> DataFrame:
    """Values seen more than once; NULLs are ignored."""
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(F.col(col).alias("unique_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Unaccepted values with their counts; NULL passes."""
    return (
        df.where(~F.col(col).isin(list(values)))
        .groupBy(F.col(col).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def relationships(child: DataFrame, col: str, parent: DataFrame, field_: str) -> DataFrame:
    """Child rows whose key has no parent row; NULL keys pass (anti join, no distinct)."""
    p = parent.select(F.col(field_).alias("__parent_key"))
    return child.where(F.col(col).isNotNull()).join(
        p, F.col(col) == F.col("__parent_key"), "left_anti"
    )


def orphan_count(child: DataFrame, col: str, parent: DataFrame, field_: str) -> DataFrame:
    """Number of orphan child rows, skew-proof: child rows are first counted per key
    (partial aggregation before the shuffle), so a key holding a third of the rows
    reaches the anti join as one row, and only distinct keys meet the parent."""
    per_key = (
        child.where(F.col(col).isNotNull())
        .groupBy(F.col(col).alias("__k"))
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    p = parent.select(F.col(field_).alias("__parent_key"))
    orphans = per_key.join(p, F.col("__k") == F.col("__parent_key"), "left_anti")
    return orphans.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("failures"))


def unique_combination(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return (
        df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)
    )


# --- declared suite ----------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    table: str
    test: str  # not_null | unique | accepted_values | relationships | unique_combination
    columns: tuple[str, ...]
    values: tuple = ()
    parent: tuple[str, str] | None = None  # (table, field) for relationships

    @property
    def column(self) -> str:
        return ",".join(self.columns)


@dataclass
class TableTests:
    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    accepted: Mapping[str, Sequence[str]] = field(default_factory=dict)
    relationships: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    unique_combination: Sequence[Sequence[str]] = ()


TIERS = ["HIGH", "MEDIUM", "LOW"]

# FIXED VALUES: the declared data tests per model
DECLARED: dict[str, TableTests] = {
    "stg_accounts": TableTests(
        not_null=["account_id", "account_name", "plan_name", "mrr", "seats_contracted",
                  "renewal_date", "is_active", "created_at"],
        unique=["account_id"],
        accepted={"plan_name": SC.PLAN_NAMES},
    ),
    "stg_product_events": TableTests(
        not_null=["event_id", "account_id", "user_id", "session_id", "feature_name", "event_ts"],
        unique=["event_id"],
        relationships={"account_id": ("stg_accounts", "account_id")},
    ),
    "stg_billing_events": TableTests(
        not_null=["event_id", "account_id", "event_type", "event_ts"],
        unique=["event_id"],
        accepted={"event_type": SC.BILLING_EVENT_TYPES},
        relationships={"account_id": ("stg_accounts", "account_id")},
    ),
    "stg_support_tickets": TableTests(
        not_null=["ticket_id", "account_id", "severity", "status", "created_at"],
        unique=["ticket_id"],
        accepted={"severity": SC.SEVERITIES, "status": SC.TICKET_STATUSES},
        relationships={"account_id": ("stg_accounts", "account_id")},
    ),
    "int_account_activity_weekly": TableTests(
        not_null=["account_id", "week_start", "wau", "updated_at"],
        unique_combination=[("account_id", "week_start")],
    ),
    "int_churn_features": TableTests(not_null=["account_id", "feature_week"], unique=["account_id"]),
    "int_account_support_signals": TableTests(
        not_null=["account_id", "open_tickets_count", "p1_p2_tickets_30d"], unique=["account_id"]
    ),
    "int_account_billing_signals": TableTests(
        not_null=["account_id", "had_payment_failure_30d", "had_downgrade_90d"],
        unique=["account_id"],
    ),
    "mart_churn_risk_scores": TableTests(
        not_null=["account_id", "scored_week", "risk_score", "risk_tier", "scored_at"],
        unique=["account_id"],
        accepted={"risk_tier": TIERS},
    ),
    "mart_churn_risk_scores_ml": TableTests(
        not_null=["account_id", "risk_score_ml", "risk_tier_ml", "churn_probability",
                  "tier_agreement"],
        unique=["account_id"],
        accepted={
            "risk_tier_ml": TIERS,
            "tier_agreement": ["AGREE", "ML_HIGHER", "ML_LOWER", "DIFFER"],
        },
    ),
    "mart_churn_alerts": TableTests(
        not_null=["account_id", "alert_priority", "top_risk_driver", "consecutive_high_weeks",
                  "alerted_at"],
        unique=["account_id"],
        accepted={"top_risk_driver": ["usage", "commercial", "support"],
                  "risk_tier": ["HIGH", "MEDIUM"]},
    ),
    "snp_churn_risk_scores": TableTests(
        not_null=["account_id", "risk_tier", "dbt_scd_id", "dbt_valid_from"],
        unique=["dbt_scd_id"],
        accepted={"risk_tier": TIERS},
    ),
}


def checks(declared: Mapping[str, TableTests] = DECLARED) -> list[Check]:
    out: list[Check] = []
    for table, t in declared.items():
        out += [Check(table, "not_null", (c,)) for c in t.not_null]
        out += [Check(table, "unique", (c,)) for c in t.unique]
        out += [Check(table, "accepted_values", (c,), tuple(v)) for c, v in t.accepted.items()]
        out += [Check(table, "relationships", (c,), parent=p) for c, p in t.relationships.items()]
        out += [Check(table, "unique_combination", tuple(cs)) for cs in t.unique_combination]
    return out


def _row(table: str, test: str, column: str, failures: Column) -> list[Column]:
    return [
        F.lit(table).alias("table_name"),
        F.lit(test).alias("test_name"),
        F.lit(column).alias("column_name"),
        failures.cast("bigint").alias("failures"),
    ]


def _nulls(table: str, df: DataFrame, tests: list[Check]) -> DataFrame:
    """The not_null tests of one table in one pass, unpivoted to rows: one row per task is all
    that is shuffled."""
    wide = df.agg(*(F.count_if(F.col(c.columns[0]).isNull()).alias(f"f{i}") for i, c in enumerate(tests)))
    entries = F.array(
        *[
            F.struct(
                F.lit(c.test).alias("test_name"),
                F.lit(c.column).alias("column_name"),
                F.col(f"f{i}").cast("bigint").alias("failures"),
            )
            for i, c in enumerate(tests)
        ]
    )
    return wide.select(F.inline(entries)).select(
        F.lit(table).alias("table_name"), "test_name", "column_name", "failures"
    )


def needed_tables(tests: tuple[str, ...] = (), declared: Mapping[str, TableTests] = DECLARED) -> set[str]:
    """Tables that the given kinds of test (none: all) read."""
    asked = [c for c in checks(declared) if not tests or c.test in tests]
    return {c.table for c in asked} | {c.parent[0] for c in asked if c.parent}


def run_suite(
    tables: Mapping[str, DataFrame], declared: Mapping[str, TableTests] = DECLARED, tests: tuple[str, ...] = ()
) -> DataFrame:
    """DQ6: one row per declared test (of the given kinds) whose table is present in `tables`."""
    parts: list[DataFrame] = []
    by_table: dict[str, list[Check]] = {}
    for c in checks(declared):
        if tests and c.test not in tests:
            continue
        if c.table in tables and (c.parent is None or c.parent[0] in tables):
            by_table.setdefault(c.table, []).append(c)
    for table, cs in by_table.items():
        df = tables[table]
        if nulls := [c for c in cs if c.test == "not_null"]:
            parts.append(_nulls(table, df, nulls))
        for c in cs:
            if c.test in ("unique", "unique_combination"):
                v = unique(df, c.columns[0]) if c.test == "unique" else unique_combination(df, c.columns)
            elif c.test == "accepted_values":
                # only unaccepted rows are grouped, so no row is copied per tested column
                v = accepted_values(df, c.columns[0], c.values)
            elif c.test == "relationships":
                ptable, pfield = c.parent
                n = orphan_count(df, c.columns[0], tables[ptable], pfield)
                parts.append(n.select(*_row(table, c.test, c.column, F.col("failures"))))
                continue
            else:
                continue
            parts.append(v.agg(*_row(table, c.test, c.column, F.count(F.lit(1)))))
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("passed", F.col("failures") == 0)
