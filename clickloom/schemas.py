"""Table schemas and the fixed values of the data model."""

from pyspark.sql import types as T


def _table(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


_LONG, _INT, _STR = T.LongType(), T.IntegerType(), T.StringType()

# ---- Fixed values: table columns, parameter names, bins and defaults of the data model ----

USER_VISIT_ACTION = _table(
    ("date", _STR),
    ("user_id", _LONG),
    ("session_id", _STR),
    ("page_id", _LONG),
    ("action_time", _STR),
    ("search_keyword", _STR),
    ("click_category_id", _STR),
    ("click_product_id", _STR),
    ("order_category_ids", _STR),
    ("order_product_ids", _STR),
    ("pay_category_ids", _STR),
    ("pay_product_ids", _STR),
    ("city_id", _LONG),
)

USER_INFO = _table(
    ("user_id", _LONG),
    ("username", _STR),
    ("name", _STR),
    ("age", _INT),
    ("professional", _STR),
    ("city", _STR),
    ("sex", _STR),
)

PRODUCT_INFO = _table(
    ("product_id", _LONG),
    ("product_name", _STR),
    ("extend_info", _STR),
)

TASK = _table(
    ("task_id", _LONG),
    ("task_name", _STR),
    ("create_time", _STR),
    ("start_time", _STR),
    ("finish_time", _STR),
    ("task_type", _STR),
    ("task_status", _STR),
    ("task_param", _STR),
)

AD_USER_CLICK_COUNT = _table(
    ("date", _STR),
    ("user_id", _LONG),
    ("ad_id", _LONG),
    ("click_count", _LONG),
)

AD_CLICK_TREND = _table(
    ("date", _STR),
    ("hour", _STR),
    ("minute", _STR),
    ("ad_id", _LONG),
    ("click_count", _LONG),
)

# The trend by arrival: the greatest ``latest`` of a minute and ad counts.
AD_CLICK_WINDOW_TREND = _table(
    ("date", _STR),
    ("hour", _STR),
    ("minute", _STR),
    ("ad_id", _LONG),
    ("latest", _table(("as_of", _LONG), ("click_count", _LONG))),
)

AD_BLACKLIST = _table(("user_id", _LONG))

SESSION_DETAIL_COLUMNS = (
    "user_id",
    "session_id",
    "page_id",
    "action_time",
    "search_keyword",
    "click_category_id",
    "click_product_id",
    "order_category_ids",
    "order_product_ids",
    "pay_category_ids",
    "pay_product_ids",
)

# JSON keys of a task's parameters; each holds an array whose first element is the value.
TASK_PARAM_KEYS = (
    "startDate",
    "endDate",
    "startAge",
    "endAge",
    "professionals",
    "cities",
    "sex",
    "keywords",
    "categoryIds",
)

# Visit length in whole seconds, both ends inclusive; None = no upper end.
# 0 s and 181-600 s belong to no bin but count as sessions.
VISIT_LENGTH_BINS = (
    ("1s_3s", 1, 3),
    ("4s_6s", 4, 6),
    ("7s_9s", 7, 9),
    ("10s_30s", 10, 30),
    ("30s_60s", 31, 60),
    ("1m_3m", 61, 180),
    ("10m_30m", 601, 1800),
    ("30m", 1801, None),
)

# Number of actions of a session, both ends inclusive; None = no upper end.
STEP_LENGTH_BINS = (
    ("1_3", 1, 3),
    ("4_6", 4, 6),
    ("7_9", 7, 9),
    ("10_30", 10, 30),
    ("30_60", 31, 60),
    ("60", 61, None),
)

SAMPLE_TOTAL = 100  # sessions drawn per task
TOP_CATEGORIES = 10
BLACKLIST_THRESHOLD = 100  # clicks of one user on one ad in one day, inclusive
BATCH_SECONDS = 5
TREND_WINDOW_MINUTES = 60
TREND_SLIDE_SECONDS = 10

# ---- End of fixed values ----

VISIT_COLUMNS = tuple(f"visit_length_{name}" for name, _, _ in VISIT_LENGTH_BINS)
STEP_COLUMNS = tuple(f"step_length_{name}" for name, _, _ in STEP_LENGTH_BINS)
STAT_COLUMNS = ("session_count", *VISIT_COLUMNS, *STEP_COLUMNS)
