"""Text expressions. All are built-in, so they stay inside the JVM."""

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_empty(c: Column) -> Column:
    """True for null and for the empty string; never null."""
    return F.coalesce(c, F.lit("")) == F.lit("")


def is_not_empty(c: Column) -> Column:
    """Opposite of :func:`is_empty`."""
    return ~is_empty(c)


def trim_comma(c: Column) -> Column:
    """Remove at most one comma at each end."""
    return F.regexp_replace(c, r"^,|,\z", "")


def pad_two(c: Column) -> Column:
    """Text of length two stays; anything else gets one ``0`` in front."""
    return F.when(F.length(c) == 2, c).otherwise(F.concat(F.lit("0"), c))


def split_list(c: Column) -> Column:
    """Comma list to ``array<string>`` without empty elements; null stays null."""
    return F.array_remove(F.split(c, ","), "")


def lists_overlap(c: Column, wanted: Sequence[str]) -> Column:
    """True when the comma list ``c`` holds any of ``wanted``; false for null.

    Most values are single elements; only those with a comma are split.
    """
    # no element of a list is empty or has a comma
    wanted = [w for w in wanted if w and "," not in w]
    if not wanted:
        return F.lit(False)
    in_list = F.arrays_overlap(split_list(c), F.array(*[F.lit(w) for w in wanted]))
    return F.coalesce(c.isin(wanted) | (c.contains(",") & in_list), F.lit(False))


def packed_get(c: Column, field: str) -> Column:
    """Value of ``field`` in a ``k=v|k=v`` record.

    The first part that is exactly a name and a value counts; trailing ``=`` are not
    part of it. ``a=`` and ``a=b=c`` have no value, ``a=b=`` has ``b``.
    """
    part = rf"(?:^|[|]){re.escape(field)}=([^=|]+)=*(?=[|]|\z)"
    return F.nullif(F.regexp_extract(c, part, 1), F.lit(""))


def packed_set(c: Column, field: str, value: Column | str) -> Column:
    """Replace the value of the first part named ``field``; other parts and their order stay.

    Trailing empty parts are dropped.
    """
    value = F.lit(value) if isinstance(value, str) else value
    record = F.regexp_replace(c, r"[|]+\z", "")
    # what comes before the part, and what comes after it
    split = rf"(?s)^((?:[^|]*[|])*?){re.escape(field)}(?:=[^|]*)?((?:[|].*)?)\z"
    replaced = F.concat(
        F.regexp_extract(record, split, 1),
        F.lit(f"{field}="),
        value,
        F.regexp_extract(record, split, 2),
    )
    return F.when(F.regexp_like(record, F.lit(split)), replaced).otherwise(record)
