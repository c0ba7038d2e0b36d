"""Score band tables of the rule model.

FIXED VALUES - these thresholds and points must equal the published scoring
rules for results to match. Each rule is (operator, threshold, points); the first
matching rule wins, a NULL input never matches a rule.
"""

# usage component
USAGE_TREND_NULL = 50
USAGE_TREND = [("<=", -0.50, 100), ("<=", -0.25, 75), ("<=", -0.10, 50), ("<=", 0.05, 25)]
ACTIVE_USER_ZERO_WEEK = 100
ACTIVE_USER = [("<", 0.10, 90), ("<", 0.25, 65), ("<", 0.50, 35), ("<", 0.75, 15)]
FEATURE_BREADTH = [("==", 0, 100), ("==", 1, 70), ("<=", 3, 40), ("<=", 6, 20)]
RECENCY_NULL = 100
RECENCY = [(">=", 28, 90), (">=", 14, 60), (">=", 7, 30)]

# commercial component
RENEWAL_URGENCY = [("<", 0, 0), ("<=", 14, 90), ("<=", 30, 70), ("<=", 60, 45), ("<=", 90, 25)]
SEAT_UTILIZATION = [("<", 0.25, 90), ("<", 0.50, 60), ("<", 0.75, 30)]
PAYMENT_FAILURE_POINTS = 80
DOWNGRADE_POINTS = 60

# support component
CRITICAL_TICKETS = [(">=", 3, 90), ("==", 2, 65), ("==", 1, 35)]
OPEN_TICKETS = [(">=", 5, 70), (">=", 3, 45), (">=", 1, 20)]
RESOLUTION_NULL = 0
RESOLUTION_DAYS = [(">", 14, 70), (">", 7, 40)]

# tiers (rule model: closed below) and alert routing
TIERS = ["HIGH", "MEDIUM", "LOW"]
ALERT_PRIORITY_LABELS = {1: "CRITICAL", 2: "URGENT", 3: "HIGH", 4: "WATCH"}
ALERT_PRIORITY_DAYS = (14, 30)
