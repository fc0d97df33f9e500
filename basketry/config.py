"""Job configuration as frozen dataclasses (defaults mirror the reference's
configuration file) and the fixed values results depend on."""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values that results must agree on (kept verbatim, in natural order).
# ---------------------------------------------------------------------------
# Column names of an order line.
COL_INVOICE = "InvoiceNo"
COL_STOCK_CODE = "StockCode"
COL_DESCRIPTION = "Description"
COL_QUANTITY = "Quantity"
COL_INVOICE_DATE = "InvoiceDate"
COL_PRICE = "UnitPrice"
COL_CUSTOMER_ID = "CustomerID"
COL_COUNTRY = "Country"
COL_REVENUE = "Revenue"
COL_SOURCE_TAG = "_source_sheet"

RAW_COLUMNS = [
    COL_INVOICE,
    COL_STOCK_CODE,
    COL_DESCRIPTION,
    COL_QUANTITY,
    COL_INVOICE_DATE,
    COL_PRICE,
    COL_CUSTOMER_ID,
    COL_COUNTRY,
]

CANCELLATION_PREFIX = "C"
OUTLIER_QUANTILE = 0.99
WRITE_BATCH_ROWS = 10_000

# Segmentation.
N_CLUSTERS = 4
RANDOM_STATE = 42
N_INIT = 10
# Date texts accepted besides ISO, tried in this order.
DATE_FORMATS = ("M/d/yyyy H:mm", "M/d/yyyy H:mm:ss", "d-MMM-yyyy H:mm", "M/d/yyyy", "d-MMM-yyyy")
RFM_FEATURE_COLUMNS = ["Recency", "Log_Frequency", "Log_Monetary"]
SEGMENT_LABELS = {
    0: "Champions",
    1: "Loyal Customers",
    2: "At Risk",
    3: "Lost / Inactive",
}

# Churn.
CHURN_TEST_SIZE = 0.2
CHURN_N_ESTIMATORS = 300
CHURN_MAX_DEPTH = 5
CHURN_LEARNING_RATE = 0.05
CHURN_SUBSAMPLE = 0.8
CHURN_COLSAMPLE_BYTREE = 0.8
CHURN_THRESHOLD_DAYS = 90

# Leak-free feature list (default) and the configured 16-column list.
CHURN_FEATURE_COLUMNS = [
    "Frequency",
    "Monetary",
    "AOV",
    "SpendStd",
    "UniqueSKUs",
    "RepeatSKURatio",
    "TotalItems",
    "AvgGap",
    "StdGap",
    "WeekendRatio",
    "PreferredDayOfWeek",
    "ActiveMonths",
    "DaysSinceFirstPurchase",
    "ReturnRate",
]
CHURN_FEATURE_COLUMNS_CONFIGURED = [
    "Recency",
    "Frequency",
    "Monetary",
    "AOV",
    "SpendStd",
    "UniqueSKUs",
    "RepeatSKURatio",
    "TotalItems",
    "AvgGap",
    "StdGap",
    "WeekendRatio",
    "PreferredDayOfWeek",
    "ActiveMonths",
    "DaysSinceFirstPurchase",
    "ReturnRate",
    "Segment",
]

# Risk tiers: right-closed bins (0, 0.3] (0.3, 0.6] (0.6, 1].
CHURN_RISK_BINS = [0.0, 0.3, 0.6, 1.0]
CHURN_RISK_LABELS = ["Low", "Medium", "High"]

# Columns the final feature matrix must carry.
REQUIRED_FEATURE_COLUMNS = [
    "Recency",
    "Frequency",
    "Monetary",
    "Log_Frequency",
    "Log_Monetary",
    "AOV",
    "SpendStd",
    "UniqueSKUs",
    "TotalItems",
    "RepeatSKURatio",
    "AvgGap",
    "StdGap",
    "WeekendRatio",
    "PreferredDayOfWeek",
    "ReturnRate",
    "CohortMonth",
    "ActiveMonths",
    "DaysSinceFirstPurchase",
]

# Range rules of scoring requests: field -> (operator, bound).
SEGMENT_REQUEST_RULES = [
    ("recency", "ge", 0),
    ("frequency", "ge", 1),
    ("monetary", "gt", 0),
]
CHURN_REQUEST_RULES = [
    ("recency", "ge", 0),
    ("frequency", "ge", 1),
    ("monetary", "gt", 0),
    ("aov", "gt", 0),
    ("spend_std", "ge", 0),
    ("unique_skus", "ge", 1),
    ("total_items", "ge", 1),
    ("repeat_sku_ratio", "ge", 0),
    ("repeat_sku_ratio", "le", 1),
    ("avg_gap", "ge", 0),
    ("std_gap", "ge", 0),
    ("weekend_ratio", "ge", 0),
    ("weekend_ratio", "le", 1),
    ("preferred_day_of_week", "ge", 0),
    ("preferred_day_of_week", "le", 6),
    ("active_months", "ge", 1),
    ("days_since_first_purchase", "ge", 0),
    ("return_rate", "ge", 0),
    ("return_rate", "le", 1),
    ("segment", "ge", 0),
]


@dataclass(frozen=True)
class ETLConfig:
    date_column: str = COL_INVOICE_DATE
    customer_id_column: str = COL_CUSTOMER_ID
    invoice_column: str = COL_INVOICE
    quantity_column: str = COL_QUANTITY
    price_column: str = COL_PRICE
    stock_code_column: str = COL_STOCK_CODE
    description_column: str = COL_DESCRIPTION
    country_column: str = COL_COUNTRY
    cancellation_prefix: str = CANCELLATION_PREFIX
    outlier_quantile: float = OUTLIER_QUANTILE
    # Exact (linear-interpolated) quantiles by default; a relative error
    # switches to percentile_approx for very large inputs.
    outlier_relative_error: float | None = None
    clean_table: str = "cleaned_transactions"
    raw_table: str = "raw_transactions"


@dataclass(frozen=True)
class FeatureConfig:
    features_table: str = "customer_features"
    churn_threshold_days: int = CHURN_THRESHOLD_DAYS
    return_rate_level: str = "line"  # "line" (reference) or "order"


@dataclass(frozen=True)
class SegmentationConfig:
    n_clusters: int = N_CLUSTERS
    random_state: int = RANDOM_STATE
    n_init: int = N_INIT
    rfm_columns: tuple = tuple(RFM_FEATURE_COLUMNS)
    max_iter: int = 300
    results_table: str = "segment_results"


@dataclass(frozen=True)
class ChurnConfig:
    test_size: float = CHURN_TEST_SIZE
    random_state: int = RANDOM_STATE
    n_estimators: int = CHURN_N_ESTIMATORS
    max_depth: int = CHURN_MAX_DEPTH
    learning_rate: float = CHURN_LEARNING_RATE
    subsample: float = CHURN_SUBSAMPLE
    colsample_bytree: float = CHURN_COLSAMPLE_BYTREE
    max_bins: int = 32  # split candidates per feature, from a quantile sketch
    threshold_days: int = CHURN_THRESHOLD_DAYS
    feature_columns: tuple = tuple(CHURN_FEATURE_COLUMNS)
    cv_folds: int = 5
    predictions_table: str = "churn_predictions"
    extra: dict = field(default_factory=dict)
