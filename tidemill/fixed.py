"""Patterns, thresholds, labels and formats that results depend on."""

# Patterns
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
URL_PAGE_PATTERN = r"^/([^/]+)/\d+$"
URL_ITEM_PATTERN = r"/(\d+)$"
WORD_BREAK_PATTERN = r"[^\p{L}\p{N}]+"

# Formats
LOGIN_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"

# Engagement segments
HIGH_MIN_VIEWS, HIGH_MAX_DAYS = 50, 3
MEDIUM_MIN_VIEWS, MEDIUM_MAX_VIEWS, MEDIUM_MAX_DAYS = 10, 49, 7
HIGH, MEDIUM, LOW = "high_engagement", "medium_engagement", "low_engagement"

# Login alerts
ALERT_TYPE = "SUSPICIOUS_MULTI_DEVICE"
ALERT_MIN_LOGINS, ALERT_MIN_DEVICES = 5, 2
ALERT_WINDOW = "1 minute"
LOGIN_WATERMARK = "5 seconds"

# Recommender
ALS_RANK, ALS_ITERATIONS, ALS_REG, ALS_SEED = 10, 10, 0.1, 42
ALS_TRAIN_PERCENT = 80
ALS_MODEL_VERSION = "als_v1"
RECOMMENDATIONS_PER_USER = 10

# Vector search
EMBEDDING_SIZE = 384
SIMILAR_DEFAULT = 5

# Keyword search: the usual BM25 constants
BM25_K1, BM25_B = 1.2, 0.75

# Metric alerts
LAG_BOUND = 5000

# Segment export
CSV_SEGMENT_HEADER = [
    "user_id",
    "email",
    "full_name",
    "total_pageviews",
    "active_days",
    "last_active_date",
    "days_since_last_active",
    "engagement_segment",
]
