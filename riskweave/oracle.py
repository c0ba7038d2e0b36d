"""DuckDB SQL twins of the registered Spark queries (the correctness oracle).

Each query is independent SQL over the driver's tables (supplier, lineitem, orders
pre-registered as views). The fixture derivation and the scoring rules are restated
in plain SQL with their own literals; only the list of declared data tests is shared with Python.
"""

from __future__ import annotations

import datetime as dt

# FIXED VALUES, stated here on their own so that a wrong one in the code under test shows
T = dt.date(2001, 11, 7)
E = dt.date(2001, 11, 11)
PLANS = ("starter", "growth", "enterprise")
EVENT_TYPES = {
    "1-URGENT": "payment_failure",
    "2-HIGH": "downgrade",
    "3-MEDIUM": "upgrade",
    "4-NOT SPECIFIED": "renewal",
    "5-LOW": "cancellation",
}
SEVERITIES = {"1-URGENT": "P1", "2-HIGH": "P2", "3-MEDIUM": "P3", "4-NOT SPECIFIED": "P4", "5-LOW": "P4"}
STATUSES = {"O": "open", "F": "resolved", "P": "closed"}


def _d(x: dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


def _in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _case(col: str, mapping: dict) -> str:
    arms = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {arms} END"


def raw_ctes(inactive: tuple[str, ...] = ()) -> str:
    """Fixture world in SQL: raw accounts / events / billing / tickets."""
    extra = f" AND CAST(s_suppkey AS VARCHAR) NOT IN ({_in(inactive)})" if inactive else ""
    plans = PLANS
    return f"""
raw_accounts AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS account_id, s_name AS account_name,
         CASE s_suppkey % 3 WHEN 0 THEN '{plans[0]}' WHEN 1 THEN '{plans[1]}' ELSE '{plans[2]}' END AS plan_name,
         abs(s_acctbal) AS mrr,
         CAST((s_suppkey % 13) * 3 AS INTEGER) AS seats_contracted,
         {_d(T)} + CAST((s_suppkey * 37) % 150 - 10 AS INTEGER) AS renewal_date,
         (s_suppkey % 10 <> 9{extra}) AS is_active,
         CAST({_d(T)} - CAST(s_suppkey % 700 AS INTEGER) AS TIMESTAMP) AS created_at
  FROM supplier
),
li_folded AS (
  SELECT *, folded + CASE WHEN cohort = 0
          OR (cohort = 1 AND folded < 40)
          OR (cohort = 2 AND folded < 28 AND l_partkey % 4 <> 0)
          OR (cohort = 3 AND folded >= 28 AND l_partkey % 3 <> 0)
          OR (cohort IN (4, 5) AND l_partkey % 8 <> 0) THEN 364 ELSE 0 END AS back
  FROM (SELECT *, datediff('day', l_shipdate, {_d(E)}) % 364 AS folded, l_suppkey % 10 AS cohort FROM lineitem)
),
raw_product_events AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS event_id,
         CAST(l_suppkey AS VARCHAR) AS account_id,
         CAST(l_partkey % 40 AS VARCHAR) AS user_id,
         CAST(l_orderkey AS VARCHAR) AS session_id,
         l_returnflag || l_linestatus || CAST(l_linenumber % 2 AS VARCHAR) AS feature_name,
         CAST({_d(E)} - CAST(back AS INTEGER) AS TIMESTAMP) + (l_orderkey % 24) * INTERVAL 1 HOUR AS event_ts
  FROM li_folded
),
orders_folded AS (
  SELECT *,
         CAST({_d(T)} - CAST(datediff('day', o_orderdate, {_d(T)}) % 364
              + greatest(o_orderkey % 8 - 1, 0) * 364 AS INTEGER) AS TIMESTAMP)
           + (o_orderkey % 24) * INTERVAL 1 HOUR AS ts,
         CAST(o_custkey % (SELECT count(*) FROM supplier) AS VARCHAR) AS acct
  FROM orders
),
raw_billing_events AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS event_id, acct AS account_id,
         {_case('o_orderpriority', EVENT_TYPES)} AS event_type,
         o_totalprice AS amount, ts AS event_ts
  FROM orders_folded WHERE o_orderkey % 8 <> 0
),
raw_support_tickets AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS ticket_id, acct AS account_id,
         {_case('o_orderpriority', SEVERITIES)} AS severity,
         {_case('o_orderstatus', STATUSES)} AS status,
         ts AS created_at,
         CASE WHEN o_orderstatus <> 'O' THEN ts + ((o_orderkey % 21) - 2) * INTERVAL 1 DAY END AS resolved_at
  FROM orders_folded WHERE o_orderkey % 8 = 0
),
stg_accounts AS (
  SELECT CAST(account_id AS VARCHAR) AS account_id, CAST(account_name AS VARCHAR) AS account_name,
         CAST(plan_name AS VARCHAR) AS plan_name, CAST(mrr AS DOUBLE) AS mrr,
         CAST(seats_contracted AS INTEGER) AS seats_contracted, CAST(renewal_date AS DATE) AS renewal_date,
         CAST(is_active AS BOOLEAN) AS is_active, CAST(created_at AS TIMESTAMP) AS created_at
  FROM raw_accounts
),
stg_product_events AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(account_id AS VARCHAR) AS account_id,
         CAST(user_id AS VARCHAR) AS user_id, CAST(session_id AS VARCHAR) AS session_id,
         CAST(feature_name AS VARCHAR) AS feature_name, CAST(event_ts AS TIMESTAMP) AS event_ts
  FROM raw_product_events
),
stg_billing_events AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(account_id AS VARCHAR) AS account_id,
         CAST(event_type AS VARCHAR) AS event_type, CAST(amount AS DOUBLE) AS amount,
         CAST(event_ts AS TIMESTAMP) AS event_ts
  FROM raw_billing_events
),
stg_support_tickets AS (
  SELECT CAST(ticket_id AS VARCHAR) AS ticket_id, CAST(account_id AS VARCHAR) AS account_id,
         CAST(severity AS VARCHAR) AS severity, CAST(status AS VARCHAR) AS status,
         CAST(created_at AS TIMESTAMP) AS created_at, CAST(resolved_at AS TIMESTAMP) AS resolved_at
  FROM raw_support_tickets
)"""


def model_ctes(as_of: dt.date, sfx: str = "", bound: bool = False, acc: str = "stg_accounts") -> str:
    """Activity -> signals -> features -> scores for one as_of, CTE names suffixed."""
    a = _d(as_of)
    mon = f"CAST(date_trunc('week', {a}) AS DATE)"
    up = f"CAST({a} + 1 AS TIMESTAMP)"
    ev_bound = f" AND event_ts < {up}" if bound else ""
    tk_bound = f" AND created_at < {up}" if bound else ""
    bl_bound = f" WHERE event_ts < {up}" if bound else ""
    d30 = f"CAST({a} - 30 AS TIMESTAMP)"
    d90 = f"CAST({a} - 90 AS TIMESTAMP)"
    return f"""
spine{sfx} AS (
  SELECT account_id, seats_contracted, mrr, plan_name, renewal_date,
         CAST({mon} - CAST(g.n * 7 AS INTEGER) AS DATE) AS week_start
  FROM {acc} CROSS JOIN generate_series(0, 11) AS g(n)
  WHERE is_active
),
usage{sfx} AS (
  SELECT account_id, CAST(date_trunc('week', event_ts) AS DATE) AS week_start,
         count(DISTINCT user_id) AS wau, count(DISTINCT session_id) AS session_count,
         count(*) AS event_count, count(DISTINCT feature_name) AS distinct_features_used,
         max(event_ts) AS last_event_ts
  FROM stg_product_events
  WHERE TRUE{ev_bound}
  GROUP BY ALL
),
dense{sfx} AS (
  SELECT s.account_id, s.week_start, CAST(s.week_start + 6 AS DATE) AS week_end,
         coalesce(u.wau, 0) AS wau, coalesce(u.session_count, 0) AS session_count,
         coalesce(u.event_count, 0) AS event_count,
         coalesce(u.distinct_features_used, 0) AS distinct_features_used,
         u.last_event_ts, s.seats_contracted,
         CASE WHEN s.seats_contracted > 0 THEN round(coalesce(u.wau, 0) / s.seats_contracted, 4) END AS active_user_ratio,
         datediff('day', u.last_event_ts, CAST(s.week_start + 6 AS DATE)) AS days_since_last_event,
         s.mrr, s.plan_name, s.renewal_date,
         datediff('day', CAST(s.week_start + 6 AS DATE), s.renewal_date) AS days_to_renewal
  FROM spine{sfx} s LEFT JOIN usage{sfx} u USING (account_id, week_start)
),
activity{sfx} AS (
  SELECT *,
         CASE WHEN wau_rolling_prev_4w <> 0
              THEN round((wau_rolling_4w - wau_rolling_prev_4w) / wau_rolling_prev_4w, 4) END AS usage_trend_pct
  FROM (
    SELECT *,
           avg(wau) OVER (PARTITION BY account_id ORDER BY week_start ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS wau_rolling_4w,
           avg(wau) OVER (PARTITION BY account_id ORDER BY week_start ROWS BETWEEN 7 PRECEDING AND 4 PRECEDING) AS wau_rolling_prev_4w,
           wau - lag(wau) OVER (PARTITION BY account_id ORDER BY week_start) AS wau_wow_delta
    FROM dense{sfx})
),
tickets_agg{sfx} AS (
  SELECT account_id,
         count(*) FILTER (WHERE status = 'open') AS open_tickets_count,
         count(*) FILTER (WHERE severity IN ('P1', 'P2') AND created_at >= {d30}) AS p1_p2_tickets_30d,
         avg(CASE WHEN resolved_at IS NOT NULL THEN datediff('day', created_at, resolved_at) END) AS avg_ticket_resolution_days
  FROM stg_support_tickets WHERE TRUE{tk_bound} GROUP BY account_id
),
support{sfx} AS (
  SELECT a.account_id, t.avg_ticket_resolution_days,
         coalesce(t.open_tickets_count, 0) AS open_tickets_count,
         coalesce(t.p1_p2_tickets_30d, 0) AS p1_p2_tickets_30d
  FROM {acc} a LEFT JOIN tickets_agg{sfx} t USING (account_id)
),
users30{sfx} AS (
  SELECT account_id, count(DISTINCT user_id) AS active_users_30d
  FROM stg_product_events WHERE event_ts >= {d30}{ev_bound} GROUP BY account_id
),
billing_agg{sfx} AS (
  SELECT account_id,
         bool_or(event_type = 'payment_failure' AND event_ts >= {d30}) AS had_payment_failure_30d,
         bool_or(event_type = 'downgrade' AND event_ts >= {d90}) AS had_downgrade_90d
  FROM stg_billing_events{bl_bound} GROUP BY account_id
),
billing{sfx} AS (
  SELECT a.account_id,
         coalesce(b.had_payment_failure_30d, false) AS had_payment_failure_30d,
         coalesce(b.had_downgrade_90d, false) AS had_downgrade_90d,
         CASE WHEN a.seats_contracted > 0 THEN round(CAST(coalesce(u.active_users_30d, 0) AS DOUBLE) / a.seats_contracted, 4) END AS seat_contracted_ratio
  FROM {acc} a LEFT JOIN billing_agg{sfx} b USING (account_id) LEFT JOIN users30{sfx} u USING (account_id)
),
features{sfx} AS (
  SELECT x.account_id, x.week_start AS feature_week, x.wau, x.wau_rolling_4w, x.wau_rolling_prev_4w,
         x.wau_wow_delta, x.usage_trend_pct, x.active_user_ratio, x.distinct_features_used,
         x.days_since_last_event, x.mrr, x.plan_name, x.renewal_date, x.days_to_renewal,
         x.seats_contracted, b.seat_contracted_ratio, b.had_payment_failure_30d, b.had_downgrade_90d,
         s.open_tickets_count, s.p1_p2_tickets_30d, s.avg_ticket_resolution_days,
         x.days_to_renewal BETWEEN 0 AND 90 AS is_in_renewal_window,
         x.wau = 0 AS is_zero_usage_week,
         x.active_user_ratio < 0.25 AS is_low_utilization
  FROM activity{sfx} x
  LEFT JOIN support{sfx} s USING (account_id)
  LEFT JOIN billing{sfx} b USING (account_id)
  WHERE x.week_start = {mon}
),
{score_ctes(sfx)}"""


# FIXED VALUES: the bands of the rule model
def score_ctes(sfx: str = "") -> str:
    """Features -> subscores -> components -> scores."""
    return f"""subscores{sfx} AS (
  SELECT *,
         CASE WHEN usage_trend_pct IS NULL THEN 50 WHEN usage_trend_pct <= -0.50 THEN 100 WHEN usage_trend_pct <= -0.25 THEN 75 WHEN usage_trend_pct <= -0.10 THEN 50 WHEN usage_trend_pct <= 0.05 THEN 25 ELSE 0 END AS usage_trend_score,
         CASE WHEN is_zero_usage_week THEN 100 WHEN active_user_ratio < 0.10 THEN 90 WHEN active_user_ratio < 0.25 THEN 65 WHEN active_user_ratio < 0.50 THEN 35 WHEN active_user_ratio < 0.75 THEN 15 ELSE 0 END AS active_user_score,
         CASE WHEN distinct_features_used = 0 THEN 100 WHEN distinct_features_used = 1 THEN 70 WHEN distinct_features_used <= 3 THEN 40 WHEN distinct_features_used <= 6 THEN 20 ELSE 0 END AS feature_breadth_score,
         CASE WHEN days_since_last_event IS NULL THEN 100 WHEN days_since_last_event >= 28 THEN 90 WHEN days_since_last_event >= 14 THEN 60 WHEN days_since_last_event >= 7 THEN 30 ELSE 0 END AS recency_score,
         CASE WHEN days_to_renewal < 0 THEN 0 WHEN days_to_renewal <= 14 THEN 90 WHEN days_to_renewal <= 30 THEN 70 WHEN days_to_renewal <= 60 THEN 45 WHEN days_to_renewal <= 90 THEN 25 ELSE 0 END AS renewal_urgency_score,
         CASE WHEN seat_contracted_ratio < 0.25 THEN 90 WHEN seat_contracted_ratio < 0.50 THEN 60 WHEN seat_contracted_ratio < 0.75 THEN 30 ELSE 0 END AS seat_utilization_score,
         CASE WHEN had_payment_failure_30d THEN 80 ELSE 0 END AS payment_failure_score,
         CASE WHEN had_downgrade_90d THEN 60 ELSE 0 END AS downgrade_score,
         CASE WHEN p1_p2_tickets_30d >= 3 THEN 90 WHEN p1_p2_tickets_30d = 2 THEN 65 WHEN p1_p2_tickets_30d = 1 THEN 35 ELSE 0 END AS critical_ticket_score,
         CASE WHEN open_tickets_count >= 5 THEN 70 WHEN open_tickets_count >= 3 THEN 45 WHEN open_tickets_count >= 1 THEN 20 ELSE 0 END AS open_ticket_score,
         CASE WHEN avg_ticket_resolution_days IS NULL THEN 0 WHEN avg_ticket_resolution_days > 14 THEN 70 WHEN avg_ticket_resolution_days > 7 THEN 40 ELSE 0 END AS resolution_time_score
  FROM features{sfx}
),
components{sfx} AS (
  SELECT *,
         round((usage_trend_score + active_user_score + feature_breadth_score + recency_score) / 4.0, 2) AS usage_score,
         round((renewal_urgency_score + seat_utilization_score + payment_failure_score + downgrade_score) / 4.0, 2) AS commercial_score,
         round((critical_ticket_score + open_ticket_score + resolution_time_score) / 3.0, 2) AS support_score
  FROM subscores{sfx}
),
scores{sfx} AS (
  SELECT account_id, feature_week AS scored_week, plan_name, mrr, renewal_date, days_to_renewal,
         is_in_renewal_window, usage_score, commercial_score, support_score, wau, usage_trend_pct,
         active_user_ratio, distinct_features_used, days_since_last_event, had_payment_failure_30d,
         p1_p2_tickets_30d, rs AS risk_score,
         CASE WHEN rs >= 70 THEN 'HIGH' WHEN rs >= 40 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier
  FROM (SELECT *, round(usage_score * 0.45 + commercial_score * 0.30 + support_score * 0.25, 2) AS rs
        FROM components{sfx})
)"""


def with_model(body: str, as_of: dt.date = T) -> str:
    return f"WITH {raw_ctes()},{model_ctes(as_of)}\n{body}"


def with_raw(body: str) -> str:
    return f"WITH {raw_ctes()}\n{body}"


ACTIVITY_COLS = (
    "account_id, week_start, week_end, wau, session_count, event_count, distinct_features_used, "
    "last_event_ts, seats_contracted, active_user_ratio, days_since_last_event, mrr, plan_name, "
    "renewal_date, days_to_renewal, wau_rolling_4w, wau_rolling_prev_4w, wau_wow_delta, usage_trend_pct"
)

CORE = {
    "stg_accounts": with_raw("SELECT * FROM stg_accounts"),
    "stg_product_events": with_raw("SELECT * FROM stg_product_events"),
    "stg_billing_events": with_raw("SELECT * FROM stg_billing_events"),
    "stg_support_tickets": with_raw("SELECT * FROM stg_support_tickets"),
    "week_spine": with_model("SELECT account_id, week_start FROM spine"),
    "weekly_usage": with_raw(
        """SELECT account_id, CAST(date_trunc('week', event_ts) AS DATE) AS week_start,
         count(DISTINCT user_id) AS wau, count(DISTINCT session_id) AS session_count,
         count(*) AS event_count, count(DISTINCT feature_name) AS distinct_features_used,
         max(event_ts) AS last_event_ts
  FROM stg_product_events GROUP BY ALL"""
    ),
    "weekly_usage_lookback": with_raw(
        f"""SELECT account_id, CAST(date_trunc('week', event_ts) AS DATE) AS week_start,
         count(DISTINCT user_id) AS wau, count(DISTINCT session_id) AS session_count,
         count(*) AS event_count, count(DISTINCT feature_name) AS distinct_features_used,
         max(event_ts) AS last_event_ts
  FROM stg_product_events
  WHERE event_ts >= CAST(CAST(date_trunc('week', {_d(T)}) AS DATE) - 91 AS TIMESTAMP)
  GROUP BY ALL"""
    ),
    "activity_weekly": with_model(f"SELECT {ACTIVITY_COLS} FROM activity"),
    "rolling_wau": with_model(
        "SELECT account_id, week_start, wau, wau_rolling_4w, wau_rolling_prev_4w FROM activity"
    ),
    "wow_delta": with_model("SELECT account_id, week_start, wau, wau_wow_delta FROM activity"),
    "usage_trend": with_model(
        f"""SELECT account_id, week_start, wau_rolling_4w, wau_rolling_prev_4w, usage_trend_pct
  FROM activity WHERE week_start = CAST(date_trunc('week', {_d(T)}) AS DATE)"""
    ),
    "support_signals": with_model("SELECT * FROM support"),
    "billing_signals": with_model("SELECT * FROM billing"),
    "active_users_30d": with_model("SELECT * FROM users30"),
    "features_current": with_model("SELECT * FROM features"),
    "usage_components": with_model(
        "SELECT account_id, usage_trend_score, active_user_score, feature_breadth_score, recency_score FROM subscores"
    ),
    "commercial_components": with_model(
        "SELECT account_id, renewal_urgency_score, seat_utilization_score, payment_failure_score, downgrade_score FROM subscores"
    ),
    "support_components": with_model(
        "SELECT account_id, critical_ticket_score, open_ticket_score, resolution_time_score FROM subscores"
    ),
    "component_scores": with_model(
        "SELECT account_id, usage_score, commercial_score, support_score FROM components"
    ),
    "risk_scores": with_model("SELECT * FROM scores"),
    "tier_counts": with_model(
        """SELECT t.risk_tier, coalesce(c.n, 0) AS n_accounts
  FROM (VALUES ('HIGH'), ('MEDIUM'), ('LOW')) t(risk_tier)
  LEFT JOIN (SELECT risk_tier, count(*) AS n FROM scores GROUP BY risk_tier) c USING (risk_tier)"""
    ),
}


# --- history, alerts ----------------------------------------------------------------

HISTORY_DAYS = [T - dt.timedelta(days=d) for d in (21, 14, 7, 0)]
FLIP_ACCOUNT = "12"
SNAP_COLS = (
    "account_id, scored_week, plan_name, mrr, risk_tier, risk_score, usage_score, "
    "commercial_score, support_score"
)


def _ts(x: dt.date) -> str:
    return f"TIMESTAMP '{x.isoformat()} 00:00:00'"


def history_ctes() -> str:
    """Four weekly runs (the last one live), the score log and its SCD2 versions,
    computed as islands of unchanged consecutive snapshots."""
    parts = [
        f"""stg_accounts_flip AS (
  SELECT * REPLACE (CASE WHEN account_id = '{FLIP_ACCOUNT}' THEN false ELSE is_active END AS is_active)
  FROM stg_accounts)"""
    ]
    logs = []
    for i, day in enumerate(HISTORY_DAYS):
        live = i == len(HISTORY_DAYS) - 1
        acc = "stg_accounts_flip" if i == 2 else "stg_accounts"
        parts.append(model_ctes(day, f"_h{i}", bound=not live, acc=acc).strip().rstrip(","))
        logs.append(f"SELECT {SNAP_COLS}, {_ts(day)} AS snapshot_ts FROM scores_h{i}")
    union = "\n  UNION ALL ".join(logs)
    parts.append(
        f"""score_log AS (
  {union}
),
runs AS (
  SELECT snapshot_ts, lag(snapshot_ts) OVER (ORDER BY snapshot_ts) AS prev_run,
         lead(snapshot_ts) OVER (ORDER BY snapshot_ts) AS next_run
  FROM (SELECT DISTINCT snapshot_ts FROM score_log)
),
seq AS (
  SELECT l.*, r.prev_run, r.next_run,
         lag(l.snapshot_ts) OVER w AS lag_ts, lead(l.snapshot_ts) OVER w AS lead_ts,
         lag(l.risk_tier) OVER w AS p_tier, lag(l.risk_score) OVER w AS p_score
  FROM score_log l JOIN runs r USING (snapshot_ts)
  WINDOW w AS (PARTITION BY account_id ORDER BY snapshot_ts)
),
islands AS (
  SELECT *, sum(CASE WHEN lag_ts IS NULL OR lag_ts <> prev_run
                          OR p_tier IS DISTINCT FROM risk_tier OR p_score IS DISTINCT FROM risk_score
                     THEN 1 ELSE 0 END) OVER (PARTITION BY account_id ORDER BY snapshot_ts) AS island
  FROM seq
),
version_span AS (
  SELECT account_id, island, min(snapshot_ts) AS first_ts, max(snapshot_ts) AS last_ts
  FROM islands GROUP BY account_id, island
),
snapshot AS (
  SELECT f.account_id, f.scored_week, f.plan_name, f.mrr, f.risk_tier, f.risk_score, f.usage_score,
         f.commercial_score, f.support_score,
         md5(f.account_id || '|' || CAST(v.first_ts AS VARCHAR)) AS dbt_scd_id,
         v.first_ts AS dbt_valid_from,
         CASE WHEN e.lead_ts = e.next_run THEN e.lead_ts ELSE e.next_run END AS dbt_valid_to
  FROM version_span v
  JOIN islands f ON f.account_id = v.account_id AND f.snapshot_ts = v.first_ts
  JOIN islands e ON e.account_id = v.account_id AND e.snapshot_ts = v.last_ts
),
alert_hist AS (
  SELECT account_id,
         min(CASE WHEN risk_tier = 'HIGH' THEN dbt_valid_from END) AS first_alerted_at,
         max(CASE WHEN risk_tier = 'HIGH' AND dbt_valid_to IS NULL
                  THEN datediff('week', CAST(dbt_valid_from AS DATE), {_d(T)}) + 1 ELSE 0 END) AS consecutive_high_weeks
  FROM snapshot GROUP BY account_id
),
alerts AS (
  SELECT s.account_id, s.scored_week, s.plan_name, s.mrr, s.renewal_date, s.days_to_renewal,
         s.is_in_renewal_window, s.risk_score, s.risk_tier, s.usage_score, s.commercial_score,
         s.support_score, s.wau, s.usage_trend_pct, s.active_user_ratio, s.distinct_features_used,
         s.days_since_last_event, s.had_payment_failure_30d, s.p1_p2_tickets_30d, h.first_alerted_at,
         CASE WHEN s.risk_tier = 'HIGH' AND s.days_to_renewal <= 14 THEN 1
              WHEN s.risk_tier = 'HIGH' AND s.days_to_renewal <= 30 THEN 2
              WHEN s.risk_tier = 'HIGH' THEN 3
              WHEN s.risk_tier = 'MEDIUM' AND s.is_in_renewal_window THEN 4 END AS alert_priority,
         CASE greatest(s.usage_score, s.commercial_score, s.support_score)
              WHEN s.usage_score THEN 'usage' WHEN s.commercial_score THEN 'commercial'
              ELSE 'support' END AS top_risk_driver,
         coalesce(h.consecutive_high_weeks, 0) AS consecutive_high_weeks
  FROM scores s LEFT JOIN alert_hist h USING (account_id)
  WHERE s.risk_tier = 'HIGH' OR (s.risk_tier = 'MEDIUM' AND s.is_in_renewal_window)
)"""
    )
    return ",\n".join(parts)


def with_history(body: str) -> str:
    return f"WITH {raw_ctes()},{model_ctes(T)},\n{history_ctes()}\n{body}"


HISTORY = {
    "scd2_history": with_history("SELECT * FROM snapshot"),
    "scd2_apply": with_history("SELECT * FROM snapshot"),
    "alert_history": with_history("SELECT * FROM alert_hist"),
    "tier_transitions": with_history(
        """SELECT account_id, from_tier, risk_tier AS to_tier, dbt_valid_from AS changed_at,
         prev_valid_to <> dbt_valid_from AS after_gap
  FROM (SELECT *, lag(risk_tier) OVER w AS from_tier, lag(dbt_valid_to) OVER w AS prev_valid_to
        FROM snapshot WINDOW w AS (PARTITION BY account_id ORDER BY dbt_valid_from))
  WHERE from_tier IS NOT NULL AND from_tier <> risk_tier"""
    ),
    "high_streak": with_history(
        f"""SELECT c.account_id,
         CASE WHEN c.risk_tier = 'HIGH' THEN (
           SELECT max(v.dbt_valid_from) FROM entries v
           WHERE v.account_id = c.account_id AND v.dbt_valid_from <= c.dbt_valid_from) END AS high_since,
         CASE WHEN c.risk_tier = 'HIGH' THEN datediff('week', CAST((
           SELECT max(v.dbt_valid_from) FROM entries v
           WHERE v.account_id = c.account_id AND v.dbt_valid_from <= c.dbt_valid_from) AS DATE), {_d(T)}) + 1
           ELSE 0 END AS high_streak_weeks
  FROM snapshot c
  WHERE c.dbt_valid_to IS NULL"""
    ).replace(
        "\nSELECT c.account_id",
        """,
entries AS (
  SELECT s.* FROM snapshot s
  WHERE s.risk_tier = 'HIGH' AND NOT EXISTS (
    SELECT 1 FROM snapshot p WHERE p.account_id = s.account_id AND p.risk_tier = 'HIGH'
      AND p.dbt_valid_to = s.dbt_valid_from)
)
SELECT c.account_id""",
        1,
    ),
    "alerts": with_history("SELECT * FROM alerts"),
    "alert_priority_counts": with_history(
        "SELECT alert_priority, count(*) AS n_alerts, sum(mrr) AS mrr_at_risk FROM alerts GROUP BY ALL"
    ),
    "top_risk_driver": with_history(
        "SELECT top_risk_driver, count(*) AS n_alerts FROM alerts GROUP BY ALL"
    ),
}


# --- rule vs ML (propensity as the ML probability) ------------------------------------

PREP_FEATURES = (
    "wau_rolling_4w", "usage_trend_pct", "active_user_ratio", "distinct_features_used",
    "days_since_last_event", "is_zero_usage_week", "is_low_utilization", "days_to_renewal",
    "seat_contracted_ratio", "had_payment_failure_30d", "had_downgrade_90d",
    "is_in_renewal_window", "p1_p2_tickets_30d", "open_tickets_count",
    "avg_ticket_resolution_days",
)
PREP_FILL = {"usage_trend_pct": "0.0", "days_since_last_event": "30.0",
             "avg_ticket_resolution_days": "0.0", "active_user_ratio": "0.0",
             "wau_rolling_4w": "0.0"}


def _clip(x: str, lo: str, hi: str) -> str:
    return f"greatest({lo}, least({hi}, {x}))"


def _propensity_expr() -> str:
    usage = (
        f"0.30 * {_clip('days_since_last_event / 60.0', '0.0', '1.0')}"
        " + 0.25 * (1.0 - greatest(0.0, least(1.0, active_user_ratio)))"
        f" + 0.20 * (-{_clip('usage_trend_pct', '-1.0', '0.0')})"
        " + 0.15 * is_zero_usage_week"
        " + 0.10 * CAST(distinct_features_used < 2 AS DOUBLE)"
    )
    commercial = (
        f"(0.35 * {_clip(_clip('days_to_renewal', '0.0', '90.0') + ' / 90.0', '0.0', '1.0')}"
        f" + 0.30 * (1.0 - {_clip('seat_contracted_ratio', '0.0', '1.0')})"
        " + 0.25 * had_payment_failure_30d + 0.10 * had_downgrade_90d)"
        f" * (1.0 - {_clip('days_to_renewal', '0.0', '365.0')} / 365.0 * 0.3)"
    )
    support = (
        f"0.50 * {_clip('p1_p2_tickets_30d / 4.0', '0.0', '1.0')}"
        f" + 0.30 * {_clip('open_tickets_count / 6.0', '0.0', '1.0')}"
        f" + 0.20 * {_clip('avg_ticket_resolution_days / 14.0', '0.0', '1.0')}"
    )
    return f"0.45 * ({usage}) + 0.30 * ({commercial}) + 0.25 * ({support})"


def ml_ctes() -> str:
    prep_cols = ",\n         ".join(
        f"coalesce(CAST({c} AS DOUBLE), {PREP_FILL.get(c, '0.0')}) AS {c}" for c in PREP_FEATURES
    )
    usage = (
        f"0.30 * {_clip('days_since_last_event / 60.0', '0.0', '1.0')}"
        " + 0.25 * (1.0 - greatest(0.0, least(1.0, active_user_ratio)))"
        f" + 0.20 * (-{_clip('usage_trend_pct', '-1.0', '0.0')})"
        " + 0.15 * is_zero_usage_week"
        " + 0.10 * CAST(distinct_features_used < 2 AS DOUBLE)"
    )
    commercial = (
        f"(0.35 * {_clip(_clip('days_to_renewal', '0.0', '90.0') + ' / 90.0', '0.0', '1.0')}"
        f" + 0.30 * (1.0 - {_clip('seat_contracted_ratio', '0.0', '1.0')})"
        " + 0.25 * had_payment_failure_30d + 0.10 * had_downgrade_90d)"
        f" * (1.0 - {_clip('days_to_renewal', '0.0', '365.0')} / 365.0 * 0.3)"
    )
    support = (
        f"0.50 * {_clip('p1_p2_tickets_30d / 4.0', '0.0', '1.0')}"
        f" + 0.30 * {_clip('open_tickets_count / 6.0', '0.0', '1.0')}"
        f" + 0.20 * {_clip('avg_ticket_resolution_days / 14.0', '0.0', '1.0')}"
    )
    feats = ", ".join(PREP_FEATURES)
    return f"""
features_all AS (
  SELECT x.account_id, x.week_start AS feature_week, x.wau_rolling_4w, x.usage_trend_pct,
         x.active_user_ratio, x.distinct_features_used, x.days_since_last_event,
         x.wau = 0 AS is_zero_usage_week, x.active_user_ratio < 0.25 AS is_low_utilization,
         x.days_to_renewal, b.seat_contracted_ratio, b.had_payment_failure_30d, b.had_downgrade_90d,
         x.days_to_renewal BETWEEN 0 AND 90 AS is_in_renewal_window,
         s.p1_p2_tickets_30d, s.open_tickets_count, s.avg_ticket_resolution_days
  FROM activity x LEFT JOIN support s USING (account_id) LEFT JOIN billing b USING (account_id)
),
prepared AS (
  SELECT account_id, feature_week,
         {prep_cols}
  FROM features
),
prepared_all AS (
  SELECT account_id, feature_week,
         {prep_cols}
  FROM features_all
),
propensity AS (
  SELECT *, CAST(p > 0.45 AS INTEGER) AS weak_label
  FROM (SELECT *, 0.45 * ({usage}) + 0.30 * ({commercial}) + 0.25 * ({support}) AS p FROM prepared)
),
propensity_all AS (
  SELECT *, CAST(p > 0.45 AS INTEGER) AS weak_label
  FROM (SELECT *, 0.45 * ({usage}) + 0.30 * ({commercial}) + 0.25 * ({support}) AS p FROM prepared_all)
),
predictions AS (
  SELECT account_id, feature_week, {feats},
         rs AS risk_score_ml,
         CASE WHEN rs > -1 AND rs <= 40 THEN 'LOW' WHEN rs > 40 AND rs <= 70 THEN 'MEDIUM'
              WHEN rs > 70 AND rs <= 101 THEN 'HIGH' END AS risk_tier_ml,
         round_even(prob * 10000, 0) / 10000 AS churn_probability,
         'weak_label_propensity' AS model_name, CAST(NULL AS DOUBLE) AS cv_auc
  FROM (SELECT *, round_even(prob * 100.0 * 100, 0) / 100 AS rs
        FROM (SELECT *, greatest(0.0, least(1.0, p)) AS prob FROM propensity))
),
rule_ml AS (
  SELECT r.account_id, r.scored_week, r.plan_name, r.mrr, r.renewal_date, r.days_to_renewal,
         r.is_in_renewal_window, m.risk_score_ml, m.risk_tier_ml, m.churn_probability,
         m.model_name, m.cv_auc, r.risk_score AS risk_score_rule, r.risk_tier AS risk_tier_rule,
         r.usage_score, r.commercial_score, r.support_score, r.wau, r.usage_trend_pct,
         r.active_user_ratio, r.distinct_features_used, r.days_since_last_event,
         r.had_payment_failure_30d, r.p1_p2_tickets_30d,
         round(m.risk_score_ml - r.risk_score, 2) AS score_delta,
         CASE WHEN m.risk_tier_ml = r.risk_tier THEN 'AGREE'
              WHEN m.risk_tier_ml = 'HIGH' AND r.risk_tier <> 'HIGH' THEN 'ML_HIGHER'
              WHEN r.risk_tier = 'HIGH' AND m.risk_tier_ml <> 'HIGH' THEN 'ML_LOWER'
              ELSE 'DIFFER' END AS tier_agreement
  FROM scores r JOIN predictions m USING (account_id)
),
cmp AS (
  SELECT r.account_id, r.plan_name, r.mrr, round(r.risk_score, 1) AS score_rule, r.risk_tier AS tier_rule,
         round(m.risk_score_ml, 1) AS score_ml, m.risk_tier_ml AS tier_ml,
         round(m.churn_probability, 3) AS churn_prob, round(m.risk_score_ml - r.risk_score, 1) AS delta,
         r.usage_score, r.commercial_score, r.support_score
  FROM scores r JOIN predictions m USING (account_id)
)"""


def with_ml(body: str) -> str:
    return f"WITH {raw_ctes()},{model_ctes(T)},{ml_ctes()}\n{body}"


def _cancelled(account: str, day: str) -> str:
    """Cancellations of the account within 90 days of the day."""
    return f"""SELECT 1 FROM stg_billing_events b WHERE b.account_id = {account} AND b.event_type = 'cancellation'
    AND CAST(b.event_ts AS DATE) BETWEEN {day} AND {day} + 90"""


ML = {
    "prepared_features": with_ml("SELECT * FROM prepared"),
    "propensity": with_ml(
        "SELECT account_id, feature_week, p AS propensity, weak_label FROM propensity"
    ),
    "ml_tier_cut": with_ml(
        "SELECT account_id, risk_score_ml, risk_tier_ml, churn_probability FROM predictions"
    ),
    "rule_vs_ml": with_ml("SELECT * FROM rule_ml"),
    "compare_frame": with_ml("SELECT * FROM cmp"),
    "compare_summary": with_ml(
        """SELECT count(*) AS n_accounts, count(*) FILTER (WHERE tier_rule = tier_ml) AS n_agree,
         avg(CAST(tier_rule = tier_ml AS DOUBLE)) AS agreement_rate, avg(delta) AS mean_delta,
         corr(score_rule, score_ml) AS score_corr,
         count(*) FILTER (WHERE tier_rule = 'HIGH') AS n_rule_high,
         sum(CASE WHEN tier_rule = 'HIGH' THEN mrr ELSE 0.0 END) AS mrr_rule_high,
         count(*) FILTER (WHERE tier_ml = 'HIGH') AS n_ml_high,
         sum(CASE WHEN tier_ml = 'HIGH' THEN mrr ELSE 0.0 END) AS mrr_ml_high
  FROM cmp"""
    ),
    "cancel_label": with_ml(
        f"""SELECT f.account_id, f.week_start AS feature_week,
         CASE WHEN EXISTS (SELECT 1 FROM stg_billing_events b
                           WHERE b.account_id = f.account_id AND b.event_type = 'cancellation'
                             AND CAST(b.event_ts AS DATE) BETWEEN f.week_start AND f.week_start + 90)
              THEN 1 ELSE 0 END AS label
  FROM activity f"""
    ),
    "label_balance": with_ml(
        f"""SELECT sum(label) AS n_positive, count(*) FILTER (WHERE label = 0) AS n_negative,
         count(*) AS n_rows, avg(CAST(label AS DOUBLE)) AS positive_rate
  FROM (SELECT CAST(EXISTS ({_cancelled('f.account_id', 'f.week_start')}) AS INTEGER) AS label FROM activity f)"""
    ),
    "tier_disagreements": with_ml(
        """SELECT account_id, tier_rule, tier_ml,
         CASE WHEN tier_ml = 'HIGH' AND tier_rule <> 'HIGH' THEN 'upgraded'
              WHEN tier_rule = 'HIGH' AND tier_ml <> 'HIGH' THEN 'downgraded'
              ELSE 'differ' END AS direction, score_rule, score_ml
  FROM cmp WHERE tier_rule <> tier_ml"""
    ),
}


# --- reporting frames -------------------------------------------------------------------


def pyround(x: str, n: int) -> str:
    """SQL of round-half-even on the exact binary value (tie broken by the product error)."""
    s = f"{float(10 ** n)!r}"
    p = f"(({x}) * {s})"
    c = f"(({x}) * 134217729.0)"
    hi = f"({c} - ({c} - ({x})))"
    lo = f"(({x}) - {hi})"
    err = f"(({hi} * {s} - {p}) + {lo} * {s})"
    tie = f"({p} - floor({p}) = 0.5)"
    return (
        f"(CASE WHEN {tie} AND {err} > 0 THEN CAST(ceil({p}) AS DOUBLE)"
        f" WHEN {tie} AND {err} < 0 THEN CAST(floor({p}) AS DOUBLE)"
        f" ELSE round_even({p}, 0) END / {s})"
    )


DIGEST_LABEL_SQL = (
    "CASE alert_priority WHEN 1 THEN ':rotating_light: CRITICAL' WHEN 2 THEN ':warning: URGENT' "
    "WHEN 3 THEN ':red_circle: HIGH' WHEN 4 THEN ':large_yellow_circle: WATCH' "
    "ELSE 'Priority ' || CAST(alert_priority AS VARCHAR) END"
)
SHORT_LABEL_SQL = (
    "CASE alert_priority WHEN 1 THEN 'CRITICAL' WHEN 2 THEN 'URGENT' WHEN 3 THEN 'HIGH' "
    "WHEN 4 THEN 'WATCH' ELSE 'Priority ' || CAST(alert_priority AS VARCHAR) END"
)

REPORTS = {
    "kpis": with_history(
        """SELECT max(s.scored_week) AS scored_week, count(a.account_id) AS alert_count,
         coalesce(sum(CASE WHEN a.account_id IS NOT NULL THEN s.mrr END), 0.0) AS mrr_at_risk,
         count(*) FILTER (WHERE s.risk_tier = 'HIGH') AS high_count,
         count(*) FILTER (WHERE s.risk_tier = 'MEDIUM') AS medium_count,
         count(*) FILTER (WHERE s.risk_tier = 'LOW') AS low_count,
         coalesce(avg(s.risk_score), 0.0) AS avg_score, count(*) AS total_count
  FROM scores s LEFT JOIN alerts a USING (account_id)"""
    ),
    "priority_queue": with_history(
        f"""SELECT s.account_id, a.alert_priority, {SHORT_LABEL_SQL} AS priority_label, s.plan_name, s.mrr,
         s.days_to_renewal, s.risk_score, s.risk_tier, a.top_risk_driver, s.usage_score,
         s.commercial_score, s.support_score, s.usage_trend_pct, s.active_user_ratio,
         a.consecutive_high_weeks, a.first_alerted_at
  FROM scores s JOIN alerts a USING (account_id)"""
    ),
    "bubble_points": with_model(
        f"""SELECT account_id, days_to_renewal AS days, {pyround('risk_score', 1)} AS score,
         risk_tier AS tier, mrr, least(greatest({pyround('sqrt(mrr / 400.0)', 1)}, 4.0), 22.0) AS radius
  FROM scores"""
    ),
    "component_share": with_model(
        """SELECT account_id,
         usage_score / greatest(usage_score + commercial_score + support_score, 1.0) * 100.0 AS usage_share,
         commercial_score / greatest(usage_score + commercial_score + support_score, 1.0) * 100.0 AS commercial_share,
         support_score / greatest(usage_score + commercial_score + support_score, 1.0) * 100.0 AS support_share
  FROM scores"""
    ),
    "display_buckets": with_model(
        f"""SELECT account_id,
         CASE WHEN mrr >= 1000 THEN '$' || printf('%.1f', {pyround('mrr / 1000.0', 1)}) || 'K'
              ELSE '$' || CAST(mrr AS VARCHAR) END AS mrr_text,
         CASE WHEN usage_trend_pct IS NULL THEN 'muted' WHEN usage_trend_pct * 100.0 > 0 THEN 'trend-up'
              WHEN usage_trend_pct * 100.0 < -10 THEN 'trend-down' ELSE 'muted' END AS trend_class,
         CASE WHEN usage_trend_pct IS NULL THEN '—'
              ELSE (CASE WHEN usage_trend_pct * 100.0 > 0 THEN '↑' ELSE '↓' END) || ' '
                   || printf('%.0f', {pyround('abs(usage_trend_pct * 100.0)', 0)}) || '%' END AS trend_text,
         CASE WHEN active_user_ratio IS NULL THEN 'muted' WHEN active_user_ratio * 100.0 >= 60 THEN 'trend-up'
              WHEN active_user_ratio * 100.0 < 25 THEN 'trend-down' ELSE 'muted-light' END AS util_class,
         CASE WHEN active_user_ratio IS NULL THEN '—'
              ELSE printf('%.0f', {pyround('active_user_ratio * 100.0', 0)}) || '%' END AS util_text,
         days_to_renewal <= 30 AS renewal_urgent
  FROM scores"""
    ),
    "digest_lines": with_history(
        f"""SELECT alert_priority, account_id, risk_score,
         '  • *' || account_id || '* (' || plan_name || ', $' || format('{{:,.0f}}', {pyround('mrr', 0)})
         || ' MRR) — ' || CAST(days_to_renewal AS VARCHAR) || 'd to renewal | score '
         || printf('%.0f', {pyround('risk_score', 0)}) || ' | driver: ' || top_risk_driver
         || ' | usage ' || CASE WHEN usage_trend_pct IS NULL THEN 'n/a'
                                ELSE printf('%+.0f', {pyround('usage_trend_pct * 100.0', 0)}) || '%' END
         || ', util ' || CASE WHEN active_user_ratio IS NULL THEN 'n/a'
                              ELSE printf('%.0f', {pyround('active_user_ratio * 100.0', 0)}) || '%' END
         || CASE WHEN had_payment_failure_30d OR p1_p2_tickets_30d > 0
                 THEN ' | ' || concat_ws(', ', CASE WHEN had_payment_failure_30d THEN 'payment fail' END,
                                          CASE WHEN p1_p2_tickets_30d > 0
                                               THEN CAST(p1_p2_tickets_30d AS VARCHAR) || ' P1/P2 tickets' END)
                 ELSE '' END AS line
  FROM alerts"""
    ),
    "digest_groups": with_history(
        f"""SELECT alert_priority, {DIGEST_LABEL_SQL} AS priority_label, n_accounts,
         '*' || ({DIGEST_LABEL_SQL}) || '* (' || CAST(n_accounts AS VARCHAR) || ' account'
         || CASE WHEN n_accounts > 1 THEN 's' ELSE '' END || ')' AS header
  FROM (SELECT alert_priority, count(*) AS n_accounts FROM alerts GROUP BY alert_priority)"""
    ),
    "digest_summary": with_history(
        f"""SELECT n_alerts,
         CASE WHEN n_alerts = 0 THEN ':white_check_mark: *Churn Alert Digest — ' || CAST({_d(T)} AS VARCHAR)
                                     || '*' || chr(10) || 'No accounts require attention this week.'
              ELSE '*' || CAST(n_alerts AS VARCHAR) || ' account(s)* require CSM attention this week.' END AS text,
         '⚠️ Churn Alert Digest — ' || CAST({_d(T)} AS VARCHAR) AS title
  FROM (SELECT count(*) AS n_alerts FROM alerts)"""
    ),
}


# --- sinks and streaming ---------------------------------------------------------------

PREV = T - dt.timedelta(days=7)


def _two_runs(acc2: str) -> str:
    flip = f"""stg_accounts_flip AS (
  SELECT * REPLACE (CASE WHEN account_id = '{FLIP_ACCOUNT}' THEN false ELSE is_active END AS is_active)
  FROM stg_accounts)"""
    r1 = model_ctes(PREV, "_r1", bound=True).strip().rstrip(",")
    r2 = model_ctes(T, "_r2", bound=False, acc=acc2).strip().rstrip(",")
    return f"WITH {raw_ctes()},\n{flip},\n{r1},\n{r2}\n"


SINKS = {
    "upsert_activity": _two_runs("stg_accounts_flip")
    + f"""SELECT {ACTIVITY_COLS} FROM activity_r2
UNION ALL
SELECT {ACTIVITY_COLS} FROM activity_r1 a
WHERE NOT EXISTS (SELECT 1 FROM activity_r2 b WHERE b.account_id = a.account_id AND b.week_start = a.week_start)""",
    "schema_sync": _two_runs("stg_accounts")
    + f"""SELECT {ACTIVITY_COLS} FROM activity_r2
UNION ALL
SELECT {ACTIVITY_COLS.replace("usage_trend_pct", "CAST(NULL AS DOUBLE) AS usage_trend_pct")} FROM activity_r1 a
WHERE NOT EXISTS (SELECT 1 FROM activity_r2 b WHERE b.account_id = a.account_id AND b.week_start = a.week_start)""",
    "schema_widening": _two_runs("stg_accounts")
    + f"""SELECT {ACTIVITY_COLS} FROM activity_r2
UNION ALL
SELECT {ACTIVITY_COLS} FROM activity_r1 a
WHERE NOT EXISTS (SELECT 1 FROM activity_r2 b WHERE b.account_id = a.account_id AND b.week_start = a.week_start)""",
    "activity_stream": CORE["weekly_usage"],
    "activity_stream_windowed": with_raw("""SELECT account_id, CAST(date_trunc('week', event_ts) AS DATE) AS week_start,
         count(*) AS event_count, max(event_ts) AS last_event_ts FROM stg_product_events GROUP BY ALL"""),
    "weekly_usage_sketch": with_raw("""SELECT plan_name, CAST(date_trunc('month', week_start) AS DATE) AS month, count(*) AS n_account_weeks,
         sum(n)::BIGINT AS event_count, max(last) AS last_event_ts, true AS users_near, true AS sessions_near
  FROM (SELECT account_id, CAST(date_trunc('week', event_ts) AS DATE) AS week_start, count(*) AS n, max(event_ts) AS last
        FROM stg_product_events GROUP BY ALL) JOIN stg_accounts USING (account_id) GROUP BY ALL"""),
}


# --- data tests ---------------------------------------------------------------------------


def _dq_select(c) -> str:
    tbl, col = c.table, c.column
    head = f"SELECT '{tbl}' AS table_name, '{c.test}' AS test_name, '{col}' AS column_name, "
    if c.test == "not_null":
        return head + f"count(*) FILTER (WHERE {col} IS NULL) AS failures FROM {tbl}"
    if c.test == "accepted_values":
        return head + f"count(DISTINCT {col}) FILTER (WHERE {col} NOT IN ({_in(c.values)})) AS failures FROM {tbl}"
    if c.test == "unique":
        return head + (
            f"(SELECT count(*) FROM (SELECT {col} FROM {tbl} WHERE {col} IS NOT NULL "
            f"GROUP BY {col} HAVING count(*) > 1)) AS failures"
        )
    if c.test == "unique_combination":
        return head + (
            f"(SELECT count(*) FROM (SELECT {col} FROM {tbl} GROUP BY {col} HAVING count(*) > 1)) AS failures"
        )
    ptable, pfield = c.parent
    return head + (
        f"(SELECT count(*) FROM {tbl} x WHERE x.{col} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM {ptable} p WHERE p.{pfield} = x.{col})) AS failures"
    )


def dq_sql(tests: tuple[str, ...] = ()) -> str:
    from riskweave.operators.quality import checks

    stamp = "TIMESTAMP '2001-11-07 00:00:00'"
    models = f"""int_account_activity_weekly AS (SELECT *, {stamp} AS updated_at FROM activity),
int_churn_features AS (SELECT * FROM features),
int_account_support_signals AS (SELECT * FROM support),
int_account_billing_signals AS (SELECT * FROM billing),
mart_churn_risk_scores AS (SELECT *, {stamp} AS scored_at FROM scores),
mart_churn_risk_scores_ml AS (SELECT *, {stamp} AS scored_at FROM rule_ml),
mart_churn_alerts AS (SELECT *, {stamp} AS alerted_at FROM alerts),
snp_churn_risk_scores AS (SELECT * FROM snapshot)"""
    sel = [_dq_select(c) for c in checks() if not tests or c.test in tests]
    body = "\nUNION ALL\n".join(sel)
    return (
        f"WITH {raw_ctes()},{model_ctes(T)},\n{history_ctes()},{ml_ctes()},\n{models}\n"
        f"SELECT *, failures = 0 AS passed FROM (\n{body})"
    )


DQ = {
    "dq_not_null": dq_sql(("not_null",)),
    "dq_unique": dq_sql(("unique",)),
    "dq_accepted_values": dq_sql(("accepted_values",)),
    "dq_relationships": dq_sql(("relationships",)),
    "dq_unique_combination": dq_sql(("unique_combination",)),
    "dq_suite": dq_sql(),
}


# --- point-in-time training snapshots ----------------------------------------------------

TRAINING_DAYS = [T - dt.timedelta(days=7 * k) for k in range(12)]


def training_sql() -> str:
    parts, sel = [], []
    for i, day in enumerate(sorted(TRAINING_DAYS)):
        parts.append(model_ctes(day, f"_t{i}", bound=day != T).strip().rstrip(","))
        sel.append(f"SELECT {_d(day)} AS run_as_of, * FROM features_t{i}")
    prep_cols = ",\n         ".join(
        f"coalesce(CAST({c} AS DOUBLE), {PREP_FILL.get(c, '0.0')}) AS {c}" for c in PREP_FEATURES
    )
    union = "\n  UNION ALL ".join(sel)
    return (
        f"WITH {raw_ctes()},\n" + ",\n".join(parts) + f""",
snapshots AS (
  {union}
),
prepared_runs AS (
  SELECT run_as_of, account_id, feature_week,
         {prep_cols}
  FROM snapshots
)
SELECT *, CAST(propensity > 0.45 AS INTEGER) AS weak_label
FROM (SELECT *, {_propensity_expr()} AS propensity FROM prepared_runs)"""
    )


def _labelled() -> str:
    """The training snapshots with the cancellation label, as the last CTE of a query."""
    sql = training_sql()
    head, tail = sql.rsplit("SELECT *, CAST(propensity > 0.45", 1)
    return head.rstrip() + f""",
trained AS (
  SELECT f.account_id, f.feature_week,
         CASE WHEN EXISTS (SELECT 1 FROM stg_billing_events b
                           WHERE b.account_id = f.account_id AND b.event_type = 'cancellation'
                             AND CAST(b.event_ts AS DATE) BETWEEN f.feature_week AND f.feature_week + 90)
              THEN 1 ELSE 0 END AS label
  FROM prepared_runs f)
"""


ML_PARTS = {
    "class_weights": _labelled() + """SELECT label, count(*) AS n_rows,
  (SELECT count(*) FROM trained)::DOUBLE / (2.0 * count(*)) AS class_weight FROM trained GROUP BY label""",
    "fold_sizes": _labelled() + """, accounts AS (
  SELECT account_id, max(label) AS s, ('0x' || substr(md5(account_id || '|42'), 1, 8))::BIGINT AS h
  FROM trained GROUP BY account_id),
folds AS (
  SELECT account_id, (row_number() OVER (PARTITION BY s ORDER BY h, account_id) - 1) % 5 AS fold FROM accounts)
SELECT CAST(fold AS INTEGER) AS fold, count(*) AS n_rows, sum(label) AS n_positive, count(DISTINCT account_id) AS n_accounts
FROM trained JOIN folds USING (account_id) GROUP BY fold""",
    "rule_classification_report": with_model("""SELECT * FROM (
  WITH seen AS (
    SELECT CAST(risk_tier = 'HIGH' AS INTEGER) AS p,
           CAST(EXISTS (SELECT 1 FROM stg_billing_events b
                        WHERE b.account_id = s.account_id AND b.event_type = 'cancellation'
                          AND CAST(b.event_ts AS DATE) BETWEEN s.scored_week AND s.scored_week + 90) AS INTEGER) AS y
    FROM scores s),
  c AS (
    SELECT k, CASE k WHEN 0 THEN 'Retained' ELSE 'Churned' END AS label,
           count(*) FILTER (WHERE y = k AND p = k)::DOUBLE AS tp, count(*) FILTER (WHERE p = k)::DOUBLE AS said,
           count(*) FILTER (WHERE y = k)::DOUBLE AS support
    FROM seen CROSS JOIN (VALUES (0), (1)) AS v(k) GROUP BY k),
  r AS (
    SELECT label, support, CASE WHEN said > 0 THEN tp / said ELSE 0.0 END AS precision,
           CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM c),
  f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM r)
  SELECT label, precision, recall, f1, support FROM f
  UNION ALL SELECT 'accuracy', NULL, NULL, avg(CAST(y = p AS DOUBLE)), count(*)::DOUBLE FROM seen
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM f
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                   sum(f1 * support) / sum(support), sum(support) FROM f)"""),
    "predictions_table": with_ml("SELECT r.*, (SELECT count(*) FROM predictions) AS n_predictions FROM rule_ml r"),
    "ml_mart_ranked": with_ml("""SELECT risk_tier_ml, row_number() OVER (PARTITION BY risk_tier_ml
  ORDER BY risk_score_ml DESC, account_id) AS rank, account_id, risk_score_ml FROM rule_ml"""),
    "risk_scores_ranked": with_model("""SELECT risk_tier, row_number() OVER (PARTITION BY risk_tier
  ORDER BY risk_score DESC, account_id) AS rank, account_id, risk_score FROM scores"""),
    "alerts_ranked": with_history("""SELECT alert_priority, row_number() OVER (PARTITION BY alert_priority
  ORDER BY risk_score DESC, account_id) AS rank, account_id, risk_score FROM alerts"""),
    "snapshot_table": HISTORY["scd2_history"],
    "snapshot_rerun": HISTORY["scd2_history"],
    "seed_accounts": with_raw("SELECT * FROM raw_accounts"),
    "catalog_layers": with_model("""SELECT f.account_id, f.feature_week, f.open_tickets_count, a.plan_name
  FROM features f JOIN stg_accounts a USING (account_id)"""),
    "json_records": with_model("""SELECT '{"account_id":"' || account_id || '","plan_name":"' || plan_name
  || '","risk_tier":"' || risk_tier || '"}' AS json FROM scores"""),
}


# --- order statistics, ranking measures, runs ---------------------------------------------

RULE_INPUTS = (
    "usage_trend_pct active_user_ratio wau distinct_features_used days_since_last_event days_to_renewal "
    "seat_contracted_ratio had_payment_failure_30d had_downgrade_90d p1_p2_tickets_30d open_tickets_count "
    "avg_ticket_resolution_days"
).split()
IN_ORDER = "SELECT *, row_number() OVER (ORDER BY risk_score DESC, account_id) AS rank FROM scores"
LABELLED_SCORES = f"SELECT risk_score AS score, EXISTS ({_cancelled('s.account_id', 's.scored_week')}) AS y FROM scores s"
YEAR_DAYS = [T - dt.timedelta(days=7 * k) for k in range(52)]


def _permutation_sql() -> str:
    swapped = ", ".join(f"CASE WHEN d.perm = '{c}' THEN d.{c} ELSE b.{c} END AS {c}" for c in RULE_INPUTS)
    names = ", ".join(f"('{c}')" for c in RULE_INPUTS)
    inner = f"""features_p AS (
  SELECT '' AS perm, account_id, feature_week, {", ".join(RULE_INPUTS)}, wau = 0 AS is_zero_usage_week FROM features
  UNION ALL
  SELECT *, wau = 0 FROM (
    SELECT d.perm, b.account_id, b.feature_week, {swapped}
    FROM (SELECT *, row_number() OVER (ORDER BY account_id) AS place FROM features) b
    JOIN (SELECT f.*, perm, row_number() OVER (PARTITION BY perm ORDER BY md5(account_id || '|' || perm || '|42'), account_id) AS place
          FROM features f, (VALUES {names}) AS c(perm)) d USING (place))
),
{score_ctes("_p").split("\nscores_p AS (")[0].rstrip().rstrip(",")},
judged AS (
  SELECT perm, round(usage_score * 0.45 + commercial_score * 0.30 + support_score * 0.25, 2) AS score,
         EXISTS ({_cancelled('c.account_id', 'c.feature_week')}) AS y FROM components_p c
),
seen AS (SELECT perm, score, count(*) FILTER (WHERE y) AS pos, count(*) FILTER (WHERE NOT y) AS neg FROM judged GROUP BY 1, 2),
below AS (
  SELECT *, coalesce(sum(neg) OVER (PARTITION BY perm ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS under
  FROM seen),
aucs AS (SELECT perm, sum(pos * (2 * under + neg))::DOUBLE / (2.0 * sum(pos) * sum(neg)) AS auc FROM below GROUP BY perm),
drops AS (SELECT perm AS feature, auc, (SELECT auc FROM aucs WHERE perm = '') - auc AS auc_drop FROM aucs WHERE perm <> '')
SELECT feature, auc, auc_drop, row_number() OVER (ORDER BY round(auc_drop, 12) DESC, feature) AS rank FROM drops"""
    return f"WITH {raw_ctes()},{model_ctes(T)},\n{inner}"


def _active_users_by_run_sql() -> str:
    runs = ", ".join(f"({_d(d)}, {str(d != T).lower()})" for d in YEAR_DAYS)
    return with_raw(f"""SELECT run_as_of, account_id, count(DISTINCT user_id) AS active_users_30d
  FROM (VALUES {runs}) AS r(run_as_of, bounded)
  JOIN stg_product_events e ON e.event_ts >= CAST(run_as_of - 30 AS TIMESTAMP) AND (NOT bounded OR e.event_ts < CAST(run_as_of + 1 AS TIMESTAMP))
  GROUP BY ALL""")


PLACES = {
    "scores_global_rank": with_model(f"SELECT rank, account_id, risk_tier, risk_score FROM ({IN_ORDER})"),
    "scores_page": with_model(f"SELECT rank, account_id, risk_score FROM ({IN_ORDER}) WHERE rank BETWEEN 11 AND 20"),
    "scores_quantiles": with_model(f"""SELECT per_mille, rank, account_id, risk_score
  FROM ({IN_ORDER}) JOIN (SELECT unnest(range(0, 1001, 100))::INTEGER AS per_mille)
  ON rank = greatest(1, (per_mille * (SELECT count(*) FROM scores) + 999) // 1000)"""),
    "alerts_global_rank": with_history("""SELECT row_number() OVER (ORDER BY alert_priority, risk_score DESC, account_id) AS rank,
  account_id, alert_priority, risk_score FROM alerts"""),
    "ml_mart_global_rank": with_ml("""SELECT row_number() OVER (ORDER BY risk_score_ml DESC, account_id) AS rank,
  account_id, risk_tier_ml, risk_score_ml FROM rule_ml"""),
    "rule_auc": with_model(f"""SELECT sum(pos) AS n_positive, sum(neg) AS n_negative,
         sum(pos * (2 * under + neg))::DOUBLE / (2.0 * sum(pos) * sum(neg)) AS auc
  FROM (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS under
        FROM (SELECT score, count(*) FILTER (WHERE y) AS pos, count(*) FILTER (WHERE NOT y) AS neg
              FROM ({LABELLED_SCORES}) GROUP BY score))"""),
    "rule_pr_curve": with_model(f"""SELECT *, row_number() OVER (ORDER BY f1 DESC, threshold DESC) = 1 AS best FROM (
  SELECT threshold, n_flagged, true_positives, true_positives / n_flagged AS precision, true_positives / p AS recall,
         true_positives * 2.0 / (n_flagged + p) AS f1
  FROM (SELECT DISTINCT score AS threshold, count(*) OVER (ORDER BY score DESC) AS n_flagged,
               count(*) FILTER (WHERE y) OVER (ORDER BY score DESC) AS true_positives, count(*) FILTER (WHERE y) OVER () AS p
        FROM ({LABELLED_SCORES})))"""),
    "rule_permutation_importance": _permutation_sql(),
    "active_users_by_run": _active_users_by_run_sql(),
    "lr_optimality": _labelled() + f"""SELECT term, (SELECT count(*) FROM trained) AS n_rows, 0.0::DOUBLE AS gradient
FROM (VALUES {", ".join(f"('{c}')" for c in (*PREP_FEATURES, "intercept"))}) AS t(term)""",
    "training_auc": _labelled() + """SELECT count(*) FILTER (WHERE label = 1) AS n_positive, count(*) FILTER (WHERE label = 0) AS n_negative,
  true AS agrees FROM trained""",
    "model_round_trip": _labelled() + "SELECT count(*) AS n_rows, 0::BIGINT AS n_different FROM trained",
}


def oracle_sql() -> dict[str, str]:
    return {**CORE, **HISTORY, **ML, **REPORTS, **SINKS, **DQ, **ML_PARTS, **PLACES, "training_snapshots": training_sql()}
