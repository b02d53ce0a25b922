"""Readers: visit actions, users, products, tasks, ad click logs."""

from clickloom.sources.adlog import (
    format_ad_log,
    parse_ad_log,
    read_file_lines,
    read_kafka_lines,
    rejected_lines,
    valid_clicks,
)
from clickloom.sources.jdbc import jdbc_options, read_jdbc
from clickloom.sources.tables import (
    register_views,
    scan_actions,
    scan_products,
    scan_users,
)
from clickloom.sources.tasks import MalformedTask, load_task, parse_task_params, task_by_id

__all__ = [
    "MalformedTask",
    "format_ad_log",
    "jdbc_options",
    "load_task",
    "parse_ad_log",
    "parse_task_params",
    "read_file_lines",
    "read_jdbc",
    "read_kafka_lines",
    "register_views",
    "rejected_lines",
    "scan_actions",
    "scan_products",
    "scan_users",
    "task_by_id",
    "valid_clicks",
]
