"""Names and business constants shared by every layer."""

# --- Fixed values: they must equal the established reports' labels and rules ---

# Order status labels and the delivery-days rule that separates them.
COMPLETED = "Completed"
DELAYED = "Delayed"
ON_TIME_MAX_DAYS = 26

# Forecast model labels and the wide-frame column that holds each prediction.
RANDOM_FOREST = "Random Forest"
NAIVE = "Naive Forecast"
SEASONAL_NAIVE = "Seasonal Naive"
MODEL_COLUMNS = {
    RANDOM_FOREST: "Forecast_Demand",
    NAIVE: "Naive_Forecast",
    SEASONAL_NAIVE: "Seasonal_Naive_Forecast",
}
EVALUATION_SCOPE = "Final test / rolling one-month-ahead"

# Feature windows, in months.
LAGS = (1, 2, 3, 6, 12)
ROLLING_WINDOWS = (3, 6)

# Evaluation layout.
TEST_MONTHS = 6
CV_FOLDS = 3
REPEATED_BIAS_MIN = 5

# Customer momentum bands (percent growth) and labels.
MOMENTUM_HIGH = 10
MOMENTUM_LOW = -10
MOMENTUM_LABELS = {
    "new": "New or Returning",
    "lost": "No Orders in Latest Year",
    "high": "High Growth",
    "risk": "At Risk",
    "stable": "Stable",
}

# Market opportunity bands (percent growth) and labels.
MARKET_HIGH = 5
MARKET_FLAT = 0
MARKET_LABELS = {
    "none": "No Active Customers",
    "high": "High Growth Market",
    "expand": "Expansion Opportunity",
    "defend": "Defend and Grow",
    "stable": "Stable Growth",
}

# Forecast review labels.
DIRECTION_LABELS = {"over": "Overforecast", "under": "Underforecast", "exact": "Exact"}
REVIEW_REASONS = {
    "over": "Overforecast in at least 5 of 6 months",
    "under": "Underforecast in at least 5 of 6 months",
}
LEGACY_EXCEPTION_TOLERANCE = 0.05

# --- End of fixed values ---

SERIES_KEYS = ["Product_ID", "Region_ID"]
CELL_KEYS = ["Month", "Product_ID", "Region_ID"]
LAG_COLUMNS = [f"Demand_Lag_{n}" for n in LAGS]
ROLLING_COLUMNS = [f"Demand_Rolling_Mean_{n}" for n in ROLLING_WINDOWS]
HISTORY_COLUMNS = LAG_COLUMNS + ROLLING_COLUMNS
MODEL_FEATURES = HISTORY_COLUMNS + ["Month_Number", "Quarter", "Time_Index"]
