"""Every query of the library with its SQL, by name.

Books are document sources, customers (with orders as chapters) or embedding
labels; FIXTURE texts add the characters that the cleaners look for.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import q_library, q_lines, q_more, q_split, q_stream, q_text

Query = Callable[[SparkSession, str], DataFrame]
_PARTS = (q_library, q_text, q_lines, q_split, q_more, q_stream)


def queries() -> dict[str, Query]:
    return {name: query for part in _PARTS for name, (query, _) in part.CATALOG.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, (_, sql) in part.CATALOG.items() if sql}
