"""The named queries over the given tables, each with its SQL equivalent.

A query takes (spark, folder of Parquet tables) and returns a DataFrame.
"""

from clickloom.queries import ads, categories, functions, layout, pages, sampling, sessions, streams
from clickloom.queries.registry import QUERIES, SQL

__all__ = [
    "QUERIES",
    "SQL",
    "ads",
    "categories",
    "functions",
    "layout",
    "pages",
    "sampling",
    "sessions",
    "streams",
]
