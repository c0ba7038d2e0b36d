"""Column helpers. All return pyspark Columns (JVM-side, whole-stage codegen)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_half_up(x, n: int, nonneg: bool = False) -> Column:
    """Round half away from zero on the scaled double: sign(x) * floor(|x| * 10^n + 0.5) / 10^n.

    Spark's round() rounds the decimal text of a double, which disagrees with
    engines that round the scaled double (1.005 -> 1.01 vs 1.0). This form agrees
    with the latter, which is what the scoring SQL was written against. NULL stays NULL.
    """
    x = _c(x)
    scale = float(10**n)
    if nonneg:
        # inputs known to be >= 0 (scores): one reference to x, so nested roundings
        # inlined by the optimizer grow linearly instead of doubling per level
        return F.floor(x * scale + 0.5) / scale
    return F.signum(x) * F.floor(F.abs(x) * scale + 0.5) / scale


def round_scaled_even(x, n: int) -> Column:
    """numpy-style round: rint(x * 10^n) / 10^n (half-to-even on the scaled double)."""
    scale = float(10**n)
    return F.rint(_c(x) * scale) / scale


def py_round(x, n: int) -> Column:
    """Python's round(x, n) / format(x, '.nf') on a double: half-to-even on the exact
    binary value. p = x * 10^n is rounded half-even; when p lands exactly on a tie the
    rounding error of the product (Dekker two-product, exact for 10^n < 2^26) says on
    which side the exact value lies."""
    x = _c(x)
    s = float(10**n)
    p = x * s
    c = x * 134217729.0  # Veltkamp split 2^27 + 1
    hi = c - (c - x)
    lo = x - hi
    err = (hi * s - p) + lo * s
    tie = (p - F.floor(p)) == 0.5
    k = (
        F.when(tie & (err > 0), F.ceil(p).cast("double"))
        .when(tie & (err < 0), F.floor(p).cast("double"))
        .otherwise(F.rint(p))
    )
    return k / s


def clamp(x, lo, hi) -> Column:
    return F.greatest(F.lit(lo), F.least(F.lit(hi), _c(x)))


def day_diff(start, end) -> Column:
    """Calendar days from start to end (end - start), bigint; NULL if either is NULL."""
    return F.datediff(_c(end), _c(start)).cast("bigint")


def week_diff(start, end) -> Column:
    """Whole elapsed weeks from start to end, truncated toward zero, bigint."""
    return F.timestamp_diff("WEEK", _c(start), _c(end)).cast("bigint")


def week_start(ts) -> Column:
    """Monday of the week containing ts, as DATE."""
    return F.trunc(_c(ts).cast("date"), "week")


_OPS = {
    "<": lambda x, t: x < t,
    "<=": lambda x, t: x <= t,
    ">": lambda x, t: x > t,
    ">=": lambda x, t: x >= t,
    "==": lambda x, t: x == t,
}


def band(
    x,
    rules: Sequence[tuple[str, float, int]],
    *,
    when_null: int | None = None,
    default: int = 0,
    lo: int | None = 0,
    hi: int | None = 100,
    pre: Sequence[tuple[Column, int]] = (),
) -> Column:
    """Searched CASE: first matching rule wins, NULL comparisons never match.

    rules     [(op, threshold, score)], evaluated in order
    when_null score when x is NULL (checked first); None lets NULL fall to default
    pre       extra (condition, score) branches evaluated before the rules
    lo / hi   clamp bounds (None = no clamp)
    """
    x = _c(x)
    expr = None

    def add(cond, val):
        nonlocal expr
        expr = F.when(cond, F.lit(val)) if expr is None else expr.when(cond, F.lit(val))

    if when_null is not None:
        add(x.isNull(), when_null)
    for cond, val in pre:
        add(cond, val)
    for op, threshold, val in rules:
        add(_OPS[op](x, F.lit(threshold)), val)
    out = F.lit(default) if expr is None else expr.otherwise(F.lit(default))
    if lo is not None and hi is not None:
        out = F.greatest(F.lit(lo), F.least(F.lit(hi), out))
    return out
