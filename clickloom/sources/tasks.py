"""Stored analysis tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.params import TaskParams, field_of_key
from clickloom.schemas import TASK_PARAM_KEYS

_BROKEN = "_broken"
_PARAM_SCHEMA = T.StructType(
    [T.StructField(key, T.ArrayType(T.StringType()), True) for key in TASK_PARAM_KEYS]
    + [T.StructField(_BROKEN, T.StringType(), True)]
)


class MalformedTask(ValueError):
    """The parameters of a task cannot be read."""


def task_by_id(tasks: DataFrame, task_id: int) -> DataFrame:
    return tasks.where(F.col("task_id") == task_id)


def parse_task_params(tasks: DataFrame) -> DataFrame:
    """One text column per parameter: the first element of its JSON array.

    Null when the key is missing or its array is empty. ``malformed`` is true when the
    parameters are no JSON object, or one of them is no array: such a task must not run,
    as a parameter that cannot be read looks like one that was not given.
    """
    text = F.col("task_param")
    parsed = tasks.select(
        "task_id",
        text,
        F.from_json(text, _PARAM_SCHEMA, {"columnNameOfCorruptRecord": _BROKEN}).alias("p"),
    )
    broken = F.col(f"p.{_BROKEN}").isNotNull() | F.coalesce(
        ~F.ltrim(text).startswith("{"), F.lit(False)
    )
    return parsed.select(
        "task_id",
        *[
            F.try_element_at(F.col(f"p.{key}"), F.lit(1)).alias(field_of_key(key))
            for key in TASK_PARAM_KEYS
        ],
        broken.alias("malformed"),
    )


def load_task(tasks: DataFrame, task_id: int) -> TaskParams:
    """The parameters of one task, read to the driver: one row by key.

    Raises :class:`MalformedTask` for parameters that cannot be read, or ages that are no
    numbers. A task without parameters (null) has no criteria.
    """
    row = parse_task_params(task_by_id(tasks, task_id)).first()
    if row is None:
        raise LookupError(f"no task {task_id}")
    values = row.asDict()
    if values.pop("malformed"):
        raise MalformedTask(f"the parameters of task {task_id} are no JSON object of arrays")
    try:
        return TaskParams.from_values(**values)
    except ValueError as error:
        raise MalformedTask(f"task {task_id}: {error}") from error
