"""Page one-step conversion, an extension: of the visits to a page, the share that goes on.

A step is a visit to a page followed by the session's next visit. Visits of a session are in
order of time, those of one time in order of page. Rows without session, time or page are no
visits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom.functions import as_timestamp, ratio_half_up


def page_steps(actions: DataFrame) -> DataFrame:
    """``page_id, next_page_id, step_count``; the last visit of a session has no next page.

    Visits follow each other within a minute of a session first, so a hot session is as many
    groups as it has minutes. The first and last visit of each minute, two rows per session and
    minute, then give the steps between minutes. Both parts use the same exchange of visits.
    """
    visits = actions.select(
        "session_id", as_timestamp(actions, "action_time").alias("at"), "page_id"
    ).dropna()
    visits = visits.withColumn("minute", F.date_trunc("minute", "at"))
    group = ("session_id", "minute")
    in_minute = W.partitionBy(*group).orderBy("at", "page_id")
    visits = visits.withColumns(
        {
            "next_page_id": F.lead("page_id").over(in_minute),
            "is_first": F.lag("page_id").over(in_minute).isNull(),
        }
    )
    is_last = F.col("next_page_id").isNull()
    inside = visits.where(~is_last).select("page_id", "next_page_id")

    # among first and last visits, a last one is followed by the first of the next minute
    in_session = W.partitionBy("session_id").orderBy("minute", "at", "page_id", is_last)
    ends = visits.where(F.col("is_first") | is_last).select(
        "page_id", F.lead("page_id").over(in_session).alias("after"), is_last.alias("is_last")
    )
    between = ends.where("is_last").select("page_id", F.col("after").alias("next_page_id"))
    steps = inside.unionByName(between)
    return steps.groupBy("page_id", "next_page_id").agg(F.count(F.lit(1)).alias("step_count"))


def page_conversion(actions: DataFrame, flow: Sequence[int]) -> DataFrame:
    """One row per step of ``flow``: visits to its page, how many went on, and the share.

    ``step, page_id, next_page_id, visit_count, step_count, conversion``; steps are numbered
    from 1 and a page nobody visited has no conversion. ``conversion`` has four decimals.
    """
    if len(flow) < 2:
        raise ValueError("a flow has two pages or more")
    pages = F.lit([int(page) for page in flow]).cast("array<bigint>")
    step = (F.col("id") + 1).cast("int")
    wanted = actions.sparkSession.range(len(flow) - 1).select(
        step.alias("step"),
        F.element_at(pages, step).alias("from_page"),
        F.element_at(pages, step + 1).alias("to_page"),
    )
    counts = page_steps(actions).where(F.col("page_id").isin(list(flow[:-1])))
    joined = wanted.join(counts, F.col("page_id") == F.col("from_page"), "left")
    zero = F.lit(0).cast("bigint")
    on = F.col("next_page_id") == F.col("to_page")
    totals = joined.groupBy("step", "from_page", "to_page").agg(
        F.coalesce(F.sum("step_count"), zero).alias("visit_count"),
        F.coalesce(F.sum(F.when(on, F.col("step_count"))), zero).alias("step_count"),
    )
    return totals.select(
        "step",
        F.col("from_page").alias("page_id"),
        F.col("to_page").alias("next_page_id"),
        "visit_count",
        "step_count",
        ratio_half_up(F.col("step_count"), F.col("visit_count"), 4).alias("conversion"),
    )
