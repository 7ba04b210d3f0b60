"""Settings of the forecasting pipeline."""

from __future__ import annotations

# They have to equal the studied application's for its results to be reproduced.
HORIZON_WEEKS = 8
DAYS_PER_WEEK = 7
HORIZON_DAYS = HORIZON_WEEKS * DAYS_PER_WEEK
TEST_SHARE = 0.2
META_SHARE = 0.2
LAGS = (1, 7, 30)
ROLLING_WINDOWS = (7, 30)
LOOKBACK = 30
LOOKBACK_GRID = (21, 30)
LOOKBACK_MARGIN = 10
MIN_TRAIN_ROWS = 50
MIN_TUNING_ROWS = 100
MIN_META_ROWS = 10
MIN_BASE_MODELS = 2
RIDGE_ALPHA = 1.0
DEFAULT_TRAIN_SIZE = 1429
DEFAULT_TEST_SIZE = 358
ARIMA_ORDER = (2, 1, 2)
SEASON = 7
ARIMA_P_GRID = (0, 1, 2)
ARIMA_D_GRID = (0, 1)
ARIMA_Q_GRID = (0, 1, 2)
SEASONALITY_MODES = ("additive", "multiplicative")
YEARLY_OPTIONS = (True, False)
TREE_COUNT = 100
TREE_DEPTH = 6
TREE_STEP = 0.1
TREE_ROW_SHARE = 0.8
TREE_COLUMN_SHARE = 0.8
TREE_SEED = 42
TREE_DEPTH_GRID = (4, 6, 8)
TREE_STEP_GRID = (0.05, 0.1, 0.15)
TREE_COUNT_GRID = (100, 200)
TREE_ROW_SHARE_GRID = (0.8, 0.9)

ARIMA = "ARIMA"
TREES = "XGBoost"
LOOKBACK_MODEL = "LSTM"
TREND = "Prophet"
STACKED = "StackedEnsemble"
# Ties between models go to the earlier name.
MODEL_ORDER = (ARIMA, TREES, LOOKBACK_MODEL, TREND, STACKED)
# Column order of the stacking matrix.
BASE_MODELS = (TREES, TREND, ARIMA, LOOKBACK_MODEL)

CALENDAR_FEATURES = (
    "day_of_week",
    "month",
    "day_of_month",
    "week_of_year",
    "year",
    "is_weekend",
    "is_holiday",
    "day_of_week_sin",
    "day_of_week_cos",
    "month_sin",
    "month_cos",
)
# End of the fixed values.

LAG_FEATURES = tuple(f"lag_{k}" for k in LAGS)
ROLLING_FEATURES = tuple(
    f"rolling_{stat}_{window}"
    for window in ROLLING_WINDOWS
    for stat in ("mean", "std", "min", "max")
)
FEATURES = CALENDAR_FEATURES + LAG_FEATURES + ROLLING_FEATURES
BASE_COLUMNS = ("ds", "state", "total", "category")
