"""Fixed values of the data contract."""

# They must equal the contract of the stored tables.
EVENT_TYPES = ("view", "cart", "remove_from_cart", "purchase")

# Canonical event identity, also the canonical sort order.
EVENT_KEY = (
    "user_session",
    "source_event_time",
    "event_type",
    "product_id",
    "user_id",
)

# Columns a silver row must have.
REQUIRED_COLUMNS = (
    "source_event_time",
    "category_id",
    "event_type",
    "product_id",
    "user_id",
    "user_session",
)

# Model inputs in serving order.
NUMERIC_FEATURES = (
    "total_views",
    "total_carts",
    "net_cart_count",
    "cart_to_view_ratio",
    "unique_categories",
    "unique_products",
    "session_duration_sec",
    "price",
)
CATEGORICAL_FEATURES = ("category_id", "category_code", "brand", "event_type")
LABEL = "label"

# Vocabulary tokens and their codes.
MISSING_TOKEN = "__MISSING__"
UNKNOWN_TOKEN = "__UNK__"
MISSING_CODE = 0
UNKNOWN_CODE = 1
FIRST_VALUE_CODE = 2

# Split names and shares of the time-ordered session index.
SPLITS = ("train", "val", "test")
TRAIN_SHARE = 0.8
TRAIN_VAL_SHARE = 0.9

# Defaults of the prediction contract and of the stream rules.
HORIZON_SECONDS = 600
SESSION_CUTOFF = "2019-10-16T00:00:00"
STATE_TTL_SECONDS = 1800
LATE_THRESHOLD_SECONDS = 60
FALLBACK_PROBABILITY = 0.5
CONTRACT_VERSION = "v1"
MIN_PR_AUC = 0.5
SAMPLE_ROWS = 500
RETRAIN_DAYS = 7

# Month windows of the named ingest profiles, inclusive.
WINDOW_PROFILES = {
    "training": ("2019-10", "2019-10"),
    "dev_smoke": ("2019-10", "2019-10"),
    "replay": ("2019-11", "2019-11"),
    "all": None,
}

MICROS = 1_000_000
