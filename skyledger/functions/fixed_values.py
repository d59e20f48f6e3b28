"""Labels, thresholds, weights and texts that results must reproduce exactly."""

# Ordered bands, first match wins, NULL falls to the last label.
AGE_BANDS = [(25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54")]
AGE_REST = "55+"
DISTANCE_BANDS = [(500, "short"), (2000, "medium")]
DISTANCE_REST = "long"
DELAY_BANDS = [(180, "major"), (60, "significant"), (15, "minor")]
DELAY_REST = "on_time"

# Review and sentiment labels.
PROMOTER_MIN_RATING = 4
DETRACTOR_MAX_RATING = 2
POSITIVE_ABOVE = 0.15
NEGATIVE_BELOW = -0.15

# Categories tested by rules.
BUSINESS_FARE_CLASS = "Business"
CANCELLED_STATUS = "Cancelled"
STRATEGIC_ROUTE_TYPES = ["International", "longhaul"]
OPEN_TICKET_STATUSES = ["open", "in_progress"]
BUSINESS_SEGMENTS = ["business", "premium"]
HUB_AIRPORT = "ABJ"
NO_TIER = "non_member"
ROUTE_ARROW = " → "

# Route cost and margin shares of fare revenue.
ROUTE_COST_SHARE = 0.62
ROUTE_MARGIN_SHARE = 0.38

# Churn signals.
CHURN_WINDOW_MONTHS = 9
CHURN_DROP_RATIO = 0.60
CHURN_OPEN_TICKETS = 2
CHURN_LOW_RATING = 2
CHURN_RATING_WHEN_UNRATED = 5
AT_RISK_SCORE = 2
AT_RISK_ROWS = 20
STRONG_LOAD_FACTOR = 0.75

# Flight estimates used when a feed carries no money columns.
FARE_BY_ROUTE_TYPE = {"Domestic": 90, "Regional": 200, "International": 600}
FARE_FOR_OTHER_ROUTES = 150
ASSUMED_LOAD = 0.78
FUEL_SHARE_OF_COST = 0.42
REVENUE_FACTOR = 1.0
COST_FACTOR = 0.65

# Fixed value: fare assumed for accrual when bookings carry no price column.
ACCRUAL_DEFAULT_PRICE = 100

# Sentences of the executive summary (printf formats).
ADVICE_RETENTION = "Rétention — %d clients à risque, %.1f$ menacés"
ADVICE_ROUTES = "Routes — %d routes performantes à développer"
ADVICE_UPSELL = "Upsell — attach rate actuel %s%% vs 15-20%% benchmark"
