"""Sinks: JSON by document, sheets, text reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_json(nested: DataFrame, path: str, key: str = "doc_id", mode: str = "overwrite") -> None:
    """A folder for each document with its JSON object; non-ASCII characters as they are."""
    nested.write.mode(mode).option("ignoreNullFields", "true").partitionBy(key).json(path)


def write_routed(relations: DataFrame, path: str, by: str) -> None:
    """Relations in a folder for each value of a column, such as decision."""
    relations.write.mode("overwrite").partitionBy(by).json(path)


def write_sheet(rows: DataFrame, path: str) -> None:
    """CSV with a header; arrays are joined by "; "."""
    flat = rows.select(*[F.array_join(c, "; ").alias(c) if t.startswith("array") else F.col(c) for c, t in rows.dtypes])
    flat.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_report(status: DataFrame, path: str, label: str, keys: list[str]) -> None:
    """Lines "label status key | key ..." of what match_sets() gives, sorted within each label."""
    line = F.concat_ws(" ", label, "status", F.concat_ws(" | ", *[F.col(k).cast("string") for k in keys]))
    status.select(label, line.alias("value")).repartition(label).sortWithinPartitions("value").select("value").write.mode("overwrite").text(path)
