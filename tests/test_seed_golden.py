"""Golden case on a few of the published seed rows, read through the typed CSV loader.

Expected values are worked out by hand for as_of = 2026-06-29 (a Monday; week end
2026-07-05). No product events: every usage band sits at its zero-usage value.
"""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskweave.config import Settings
from riskweave.operators import alerts as al
from riskweave.operators.history import scd2_apply
from riskweave.plans.weekly import build
from riskweave.sources.seeds import read_seed_csv

# FIXED VALUES: rows of the published seed files (subset)
ACCOUNTS = """account_id,account_name,plan_name,mrr,seats_contracted,renewal_date,is_active,created_at
acc_001,Acme Corp,enterprise,4800,50,2026-07-09,true,2024-03-17 00:00:00
acc_003,Coastal Retail,starter,400,8,2026-07-17,true,2025-12-06 00:00:00
acc_006,Finova,starter,350,6,2026-09-14,true,2025-05-17 00:00:00
"""
BILLING = """event_id,account_id,event_type,amount,event_ts
bill_0001,acc_003,payment_failure,400,2026-06-17 10:00:00
bill_0002,acc_003,payment_failure,400,2026-06-24 10:00:00
bill_0004,acc_001,downgrade,-1200,2026-05-15 10:00:00
"""
TICKETS = """ticket_id,account_id,severity,status,created_at,resolved_at
tkt_0001,acc_006,P1,open,2026-06-15 09:00:00,
tkt_0002,acc_006,P1,open,2026-06-19 09:00:00,
tkt_0003,acc_006,P1,open,2026-06-19 09:00:00,
tkt_0004,acc_006,P2,open,2026-06-16 09:00:00,
tkt_0005,acc_006,P2,open,2026-06-13 09:00:00,
tkt_0006,acc_006,P1,resolved,2026-05-20 09:00:00,2026-05-13 14:00:00
tkt_0007,acc_001,P1,open,2026-06-21 09:00:00,
tkt_0008,acc_001,P2,resolved,2026-06-07 09:00:00,2026-06-02 14:00:00
tkt_0010,acc_003,P1,open,2026-06-24 09:00:00,
tkt_0011,acc_003,P2,open,2026-06-11 09:00:00,
"""
EVENTS = "event_id,account_id,user_id,session_id,feature_name,event_ts\n"

AS_OF = dt.date(2026, 6, 29)


@pytest.fixture(scope="module")
def golden(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("seeds")
    files = {"accounts": ACCOUNTS, "billing_events": BILLING, "support_tickets": TICKETS,
             "product_events": EVENTS}
    raw = {}
    for name, text in files.items():
        p = d / f"{name}.csv"
        p.write_text(text)
        raw[name] = read_seed_csv(spark, str(p), name)
    return build(raw, Settings(as_of=AS_OF), stamp=False)


def test_blank_cells_read_as_null(golden):
    t = golden.staged["support_tickets"]
    assert t.where(F.col("resolved_at").isNull()).count() == 8


def test_support_signals(golden):
    got = {r.account_id: r for r in golden.support.collect()}
    assert (got["acc_006"].open_tickets_count, got["acc_006"].p1_p2_tickets_30d) == (5, 5)
    assert got["acc_006"].avg_ticket_resolution_days == -7.0  # resolved before it opened
    assert (got["acc_001"].open_tickets_count, got["acc_001"].p1_p2_tickets_30d) == (1, 2)
    assert got["acc_001"].avg_ticket_resolution_days == -5.0
    assert got["acc_003"].avg_ticket_resolution_days is None


def test_billing_signals(golden):
    got = {r.account_id: r for r in golden.billing.collect()}
    assert got["acc_003"].had_payment_failure_30d and not got["acc_003"].had_downgrade_90d
    assert got["acc_001"].had_downgrade_90d and not got["acc_001"].had_payment_failure_30d
    assert got["acc_006"].seat_contracted_ratio == 0.0


def test_scores(golden):
    got = {r.account_id: r for r in golden.scores.collect()}
    want = {
        "acc_006": (87.5, 28.75, 53.33, 61.33, "MEDIUM", 71),
        "acc_001": (87.5, 60.0, 28.33, 64.46, "MEDIUM", 4),
        "acc_003": (87.5, 65.0, 28.33, 65.96, "MEDIUM", 12),
    }
    for k, (u, c, s, score, tier, days) in want.items():
        r = got[k]
        assert (r.usage_score, r.commercial_score, r.support_score) == (u, c, s)
        assert (r.risk_score, r.risk_tier, r.days_to_renewal) == (score, tier, days)
        assert r.usage_trend_pct is None and r.days_since_last_event is None
        assert r.scored_week == AS_OF


def test_alerts_on_first_snapshot(golden, spark):
    s = Settings(as_of=AS_OF)
    hist = scd2_apply(None, golden.scores.select(
        "account_id", "scored_week", "plan_name", "mrr", "risk_tier", "risk_score",
        "usage_score", "commercial_score", "support_score"), dt.datetime(2026, 6, 29))
    got = {r.account_id: r for r in al.churn_alerts(golden.scores, hist, s, stamp=False).collect()}
    assert set(got) == {"acc_001", "acc_003", "acc_006"}
    assert all(r.alert_priority == 4 and r.top_risk_driver == "usage" for r in got.values())
    assert all(r.consecutive_high_weeks == 0 and r.first_alerted_at is None for r in got.values())
