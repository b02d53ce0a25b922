"""Category touches, counts and the top list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions import is_not_empty, split_list
from clickloom.operators.joins import keep_or_drop
from clickloom.schemas import TOP_CATEGORIES

_FIELDS = ("click_category_id", "order_category_ids", "pay_category_ids")
_KINDS = ("click", "order", "pay")
_COUNTS = ("click_count", "order_count", "pay_count")


def actions_with_category(actions: DataFrame) -> DataFrame:
    """Actions with a click, order or pay category."""
    present: Column = F.lit(False)
    for name in _FIELDS:
        present = present | F.col(name).isNotNull()
    return actions.where(present)


def category_touches(actions: DataFrame, *keep: str) -> DataFrame:
    """One row per category an action touches: ``kind`` is click, order or pay.

    The click is a single value, order and pay are comma lists; empty elements are
    dropped and repeats stay. Ids of the same number are one category: ``007`` is ``7``.
    ``keep`` names action columns to carry along.
    """
    click, order, pay = (F.col(name) for name in _FIELDS)
    by_kind = actions_with_category(actions).select(
        *keep,
        F.stack(
            F.lit(3), F.lit("click"), click, F.lit("order"), order, F.lit("pay"), pay
        ).alias("kind", "_ids"),
    )
    ids = F.when(F.col("kind") == "click", F.array("_ids")).otherwise(split_list(F.col("_ids")))
    return (
        by_kind.where(is_not_empty(F.col("_ids")))
        .select(*keep, "kind", F.explode(ids).alias("category_id"))
        .withColumn("category_id", _same_number("category_id"))
    )


def _same_number(category: str) -> Column:
    """The id as its number is written; an id that is no number stays as it is."""
    return F.coalesce(F.col(category).try_cast("bigint").cast("string"), F.col(category))


def click_count_by_category(actions: DataFrame) -> DataFrame:
    """Actions per clicked category."""
    return _counted(actions.where(is_not_empty(F.col("click_category_id"))).select(
        F.col("click_category_id").alias("category_id")
    ), "click_count")


def order_count_by_category(actions: DataFrame) -> DataFrame:
    """Elements of the order lists per category."""
    return _counted(_elements(actions, "order_category_ids"), "order_count")


def pay_count_by_category(actions: DataFrame) -> DataFrame:
    """Elements of the pay lists per category."""
    return _counted(_elements(actions, "pay_category_ids"), "pay_count")


def _elements(actions: DataFrame, name: str) -> DataFrame:
    return actions.where(F.col(name).isNotNull()).select(
        F.explode(split_list(F.col(name))).alias("category_id")
    )


def _counted(ids: DataFrame, name: str) -> DataFrame:
    same = _same_number("category_id").alias("category_id")
    return ids.groupBy(same).agg(F.count(F.lit(1)).alias(name))


def filtered_session_actions(
    actions: DataFrame, sessions: DataFrame, salts: int = 1
) -> DataFrame:
    """Actions that belong to the given sessions; a hot session is split."""
    return keep_or_drop(actions, sessions, "session_id", "left_semi", salts)


def session_category_counts(actions: DataFrame) -> DataFrame:
    """Click, order and pay counts per session and category.

    This comes before any join by session: the partial aggregation shrinks a hot session
    to one row per category in each map task, and its categories go to different reducers.
    """
    return (
        category_touches(actions, "session_id")
        .groupBy("session_id", "category_id")
        .agg(
            *[
                F.count_if(F.col("kind") == kind).alias(name)
                for kind, name in zip(_KINDS, _COUNTS, strict=True)
            ]
        )
    )


def distinct_categories(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """Categories touched by the given sessions."""
    pairs = category_touches(actions, "session_id").select("session_id", "category_id").distinct()
    own = pairs.join(sessions.select("session_id"), "session_id", "left_semi")
    return own.select("category_id").distinct()


def category_counts(
    actions: DataFrame, sessions: DataFrame, count_scope: str = "all"
) -> DataFrame:
    """Click, order and pay counts of the categories the given sessions touch.

    ``count_scope="all"`` counts over all ``actions``, ``"filtered"`` over those of the
    given sessions. Either way the actions are read once: their counts per session and
    category are marked by a join with the session ids and added up per category.
    """
    per_session = session_category_counts(actions)
    ids = sessions.select("session_id")
    sums = [F.sum(name).alias(name) for name in _COUNTS]
    if count_scope == "filtered":
        own = per_session.join(ids, "session_id", "left_semi")
        return own.groupBy("category_id").agg(*sums)
    if count_scope != "all":
        raise ValueError("count_scope is 'all' or 'filtered'")
    given = (
        ids.where(F.col("session_id").isNotNull()).distinct().withColumn("_given", F.lit(True))
    )
    return (
        per_session.join(given, "session_id", "left")
        .groupBy("category_id")
        .agg(*sums, F.bool_or("_given").alias("_given"))
        .where("_given")
        .drop("_given")
    )


def _order() -> list[Column]:
    return [
        F.desc("click_count"),
        F.desc("order_count"),
        F.desc("pay_count"),
        F.asc("category_id"),
    ]


def _numbered(counts: DataFrame) -> DataFrame:
    number = F.col("category_id").try_cast("bigint")
    wrong = F.raise_error(F.concat(F.lit("category id is no number: "), F.col("category_id")))
    return counts.withColumn(
        "category_id",
        F.when(number.isNull() & F.col("category_id").isNotNull(), wrong).otherwise(number),
    )


def category_sort(counts: DataFrame) -> DataFrame:
    """By click, order and pay count, all descending; ties by category id, a number.

    An id that is no number is an error that names it, not a row without a category.
    """
    return _numbered(counts).orderBy(*_order())


def top_categories(counts: DataFrame, task_id: int, n: int = TOP_CATEGORIES) -> DataFrame:
    """The first ``n`` of :func:`category_sort`."""
    return (
        category_sort(counts)
        .limit(n)
        .select(
            F.lit(task_id).cast("bigint").alias("task_id"),
            "category_id",
            "click_count",
            "order_count",
            "pay_count",
        )
    )
