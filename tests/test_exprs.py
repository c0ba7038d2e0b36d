"""Column helpers against their definitions (DuckDB rounding, Python rounding, bands)."""

import random

import duckdb
from pyspark.sql import functions as F

from riskweave.functions import bands as B
from riskweave.functions.exprs import band, day_diff, py_round, round_half_up, week_diff, week_start


def _values(spark, xs, expr):
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_round_half_up_matches_duckdb_round(spark):
    rng = random.Random(7)
    xs = [rng.randint(-100000, 100000) / 1000 for _ in range(400)]
    xs += [1.005, 2.675, -2.675, 0.125, -0.125, 62.445, 0.0, 70.0, 39.995]
    got = _values(spark, xs, lambda c: round_half_up(c, 2))
    duck = [duckdb.execute("SELECT round(?::DOUBLE, 2)", [x]).fetchone()[0] for x in xs]
    assert got == duck


def test_round_half_up_keeps_null(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert df.select(round_half_up("x", 2)).first()[0] is None


def test_py_round_matches_python(spark):
    rng = random.Random(11)
    xs = [rng.randint(0, 1000000) / 100 for _ in range(300)]  # two-decimal values: many ties
    xs += [0.5, 1.5, 2.5, -0.5, -2.5, 62.45, 62.25, 1.15, 2.675, 1234.5, 0.05]
    xs += [rng.uniform(-50, 50) for _ in range(200)]
    for n in (0, 1):
        got = _values(spark, xs, lambda c: py_round(c, n))
        want = [float(round(x, n)) for x in xs]
        assert got == want, [(x, g, w) for x, g, w in zip(xs, got, want) if g != w][:5]


def _py_band(x, rules, when_null=None, default=0):
    if x is None:
        return when_null if when_null is not None else default
    ops = {"<": x.__lt__, "<=": x.__le__, ">": x.__gt__, ">=": x.__ge__, "==": x.__eq__}
    for op, t, v in rules:
        if ops[op](t):
            return v
    return default


def _edges(rules):
    out = {None}
    for _, t, _ in rules:
        out |= {t - 0.01, t, t + 0.01}
    return sorted(out, key=lambda v: (v is not None, v if v is not None else 0))


def test_every_band_at_and_around_its_edges(spark):
    cases = [
        (B.USAGE_TREND, B.USAGE_TREND_NULL),
        (B.ACTIVE_USER, None),
        (B.FEATURE_BREADTH, None),
        (B.RECENCY, B.RECENCY_NULL),
        (B.RENEWAL_URGENCY, None),
        (B.SEAT_UTILIZATION, None),
        (B.CRITICAL_TICKETS, None),
        (B.OPEN_TICKETS, None),
        (B.RESOLUTION_DAYS, B.RESOLUTION_NULL),
    ]
    for rules, null in cases:
        xs = _edges(rules)
        df = spark.createDataFrame([(None if x is None else float(x),) for x in xs], "x double")
        got = [r[0] for r in df.select(band("x", rules, when_null=null)).collect()]
        want = [_py_band(x, rules, null) for x in xs]
        assert got == want, rules


def test_day_and_week_differences(spark):
    import datetime as dt

    rows = [
        (dt.datetime(2001, 1, 1, 23, 0), dt.datetime(2001, 1, 2, 1, 0)),  # 1 calendar day
        (dt.datetime(2001, 1, 10, 0, 0), dt.datetime(2001, 1, 3, 0, 0)),  # negative
    ]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    got = df.select(day_diff("a", "b")).collect()
    assert [r[0] for r in got] == [1, -7]
    d = spark.createDataFrame([(dt.date(2001, 10, 17), dt.date(2001, 11, 7))], "a date, b date")
    assert d.select(week_diff("a", "b")).first()[0] == 3
    w = spark.createDataFrame([(dt.datetime(2001, 11, 11, 23, 0),)], "t timestamp_ntz")
    assert w.select(week_start("t")).first()[0] == dt.date(2001, 11, 5)
