"""Documents of a collection: data apart from metadata, columns in the stored order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METADATA = "metadata"


def data_rows(documents: DataFrame) -> DataFrame:
    """All but metadata documents; those without a type are data."""
    return documents.where(~F.col("type").eqNullSafe(METADATA)) if "type" in documents.columns else documents


def metadata_rows(documents: DataFrame) -> DataFrame:
    return documents.where(F.col("type") == METADATA) if "type" in documents.columns else documents.limit(0)


def in_order(data: DataFrame, stored: list[str] | None) -> DataFrame:
    """The stored columns first, null where data lacks them, and the others after them."""
    if not stored:
        return data
    have = set(data.columns)
    return data.select(*[F.col(f"`{c}`") if c in have else F.lit(None).alias(c) for c in stored], *[F.col(f"`{c}`") for c in data.columns if c not in stored])
