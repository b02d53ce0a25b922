"""Date and time expressions.

Times are read and written in the session time zone; the jobs here run with
``spark.sql.session.timeZone=UTC``.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- Fixed values: text formats of the data model ----
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIME_PARSE_FORMAT = "yyyy-MM-dd H:mm:ss"  # also accepts an unpadded hour
DATE_FORMAT = "yyyy-MM-dd"
DAY_KEY_FORMAT = "yyyyMMdd"
MINUTE_KEY_FORMAT = "yyyyMMddHHmm"
DATE_HOUR_FORMAT = "yyyy-MM-dd_HH"
# ---- End of fixed values ----


def parse_time(c: Column) -> Column:
    """``yyyy-MM-dd H:mm:ss`` text to timestamp; null when it cannot be read."""
    return F.try_to_timestamp(c, F.lit(TIME_PARSE_FORMAT))


def as_timestamp(df: DataFrame, name: str) -> Column:
    """The column as timestamp: parsed when stored as text, unchanged when stored as a time."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return parse_time(F.col(name))
    return F.col(name).cast("timestamp")


def format_time(c: Column) -> Column:
    return F.date_format(c, TIME_FORMAT)


def format_date(c: Column) -> Column:
    return F.date_format(c, DATE_FORMAT)


def day_key(c: Column) -> Column:
    return F.date_format(c, DAY_KEY_FORMAT)


def parse_day_key(c: Column) -> Column:
    """``yyyyMMdd`` text to date; null when it cannot be read."""
    return F.try_to_timestamp(c, F.lit(DAY_KEY_FORMAT)).cast("date")


def minute_key(c: Column) -> Column:
    return F.date_format(c, MINUTE_KEY_FORMAT)


def date_hour(c: Column) -> Column:
    return F.date_format(c, DATE_HOUR_FORMAT)


def split_minute_key(c: Column) -> tuple[Column, Column, Column]:
    """``yyyyMMddHHmm`` text to date ``yyyy-MM-dd``, hour ``HH`` and minute ``mm``."""
    return (
        format_date(parse_day_key(F.substring(c, 1, 8))),
        F.substring(c, 9, 2),
        F.substr(c, F.lit(11)),
    )


def is_before(a: Column, b: Column) -> Column:
    """Time text ``a`` strictly before ``b``; false when either cannot be read."""
    return F.coalesce(parse_time(a) < parse_time(b), F.lit(False))


def is_after(a: Column, b: Column) -> Column:
    """Time text ``a`` strictly after ``b``; false when either cannot be read."""
    return is_before(b, a)


def seconds_between(a: Column, b: Column) -> Column:
    """``a - b`` in whole seconds for two time texts; 0 when either cannot be read."""
    return F.coalesce(
        F.unix_timestamp(parse_time(a)) - F.unix_timestamp(parse_time(b)), F.lit(0).cast("bigint")
    )


def today() -> Column:
    return format_date(F.current_date())


def yesterday() -> Column:
    return format_date(F.date_sub(F.current_date(), 1))
