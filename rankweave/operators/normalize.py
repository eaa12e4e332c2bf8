"""Load-time clean-up of a raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.functions.text import strip


def trim_strings(df: DataFrame) -> DataFrame:
    """TRIM every string column, found by type; pass the rest through."""
    return df.select(
        *[F.trim(F.col(c)).alias(c) if kind == "string" else F.col(c) for c, kind in df.dtypes]
    )


def rename_key(df: DataFrame, source: str, target: str = "id") -> DataFrame:
    """Put the key column first under its new name; the original name is gone."""
    rest = [c for c in df.columns if c != source]
    return df.select(F.col(source).alias(target), *rest)


def guard_queries(df: DataFrame, text: str = "query") -> DataFrame:
    """Strip query text, read NULL as empty, drop empty queries."""
    return df.withColumn(text, strip(F.coalesce(F.col(text), F.lit("")))).where(F.col(text) != "")
