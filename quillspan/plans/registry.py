"""Queries over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import file_queries, table_queries, text_queries


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**text_queries.QUERIES, **table_queries.QUERIES, **file_queries.QUERIES}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents to passages, mentions, pairs, ranked passages and sentences, and the context of each pair."""
    return text_queries.context_assembly(spark, sf_dir)
