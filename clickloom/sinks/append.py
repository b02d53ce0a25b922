"""Result tables of tasks: replaced per task as Parquet, appended to in databases."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from clickloom.sources.jdbc import jdbc_options

# Takes the rows of a result, the name of its table and the id of the task.
ResultWriter = Callable[[DataFrame, str, int | None], None]


def append_table(rows: DataFrame, path: str) -> None:
    """Append to a Parquet table. Running a task twice appends its rows twice."""
    rows.write.mode("append").parquet(path)


def replace_task(rows: DataFrame, path: str, task_id: int | None) -> None:
    """Write what a task has in a Parquet table that is partitioned by ``task_id``.

    What an earlier run of the task wrote is replaced, also by nothing.
    """
    name = "__HIVE_DEFAULT_PARTITION__" if task_id is None else task_id
    rows.drop("task_id").write.mode("overwrite").parquet(f"{path}/task_id={name}")


def append_jdbc(
    rows: DataFrame, url: str, table: str, connections: int | None = None, **extra: str
) -> None:
    """Append to a database table over at most ``connections`` connections at a time."""
    options = jdbc_options(url, table, **extra)
    if connections is not None:
        options["numPartitions"] = str(connections)
    rows.write.format("jdbc").options(**options).mode("append").save()


def parquet_results(folder: str) -> ResultWriter:
    """Results as Parquet tables below ``folder``; a task that runs again replaces its own."""
    return lambda rows, table, task_id: replace_task(rows, f"{folder}/{table}", task_id)


def jdbc_results(url: str, connections: int | None = None, **extra: str) -> ResultWriter:
    """Results as tables of a database, which a task that runs again appends to again."""
    return lambda rows, table, task_id: append_jdbc(rows, url, table, connections, **extra)
