from riskweave.functions.exprs import (
    band,
    clamp,
    day_diff,
    round_half_up,
    week_diff,
    week_start,
)

__all__ = [
    "band",
    "clamp",
    "day_diff",
    "round_half_up",
    "week_diff",
    "week_start",
]
