"""The SQL that the queries must agree with."""

from __future__ import annotations

from . import file_queries, table_queries, text_queries


def oracle_sql() -> dict[str, str]:
    return {**text_queries.SQL, **table_queries.SQL, **file_queries.SQL}
