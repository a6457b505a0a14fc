"""Metadata tables kept as sheets: CSV exports, every column a string."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def all_strings(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def read_sheets(spark: SparkSession, root: str, tables: list[str], table: str | None = None) -> dict[str, DataFrame]:
    """The named table, or all configured ones, by name. An unknown name is an error."""
    if table is not None and table not in tables:
        raise ValueError(f"table {table!r} is not configured. Available tables: {', '.join(tables)}")
    return {t: all_strings(spark.read.option("header", True).option("inferSchema", False).csv(f"{root}/{t}.csv")) for t in ([table] if table else tables)}
