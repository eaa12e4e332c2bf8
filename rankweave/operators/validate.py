"""Data checks. Each returns rows; none raises on its own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.plans.bounds import lookup_join
from rankweave.sources.tables import column_profile


def check_key(df: DataFrame, key: str) -> DataFrame:
    """Row count, duplicate and NULL keys.

    The first aggregate is combined map-side per key value, so neither a hot key nor a wide table gathers
    in one task.
    """
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.sum("n").cast("bigint").alias("n_rows"),
        F.count(key).alias("n_distinct"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("n_null"),
        F.coalesce(
            F.sum(F.when(F.col(key).isNotNull() & (F.col("n") > 1), F.col("n") - 1)), F.lit(0)
        ).cast("bigint").alias("n_repeated"),
    ).withColumn("is_key", (F.col("n_null") == 0) & (F.col("n_repeated") == 0))


def require_key(df: DataFrame, key: str) -> DataFrame:
    """``df`` itself, after failing on a key that is not unique and not null."""
    report = check_key(df, key).first()
    if not report["is_key"]:
        raise ValueError(f"{key} is not a key: {report.asDict()}")
    return df


def check_contiguous(df: DataFrame, key: str) -> DataFrame:
    """Whether the key values are exactly 0..n-1."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.sum("n").cast("bigint").alias("n_rows"),
        F.count(key).alias("n_distinct"),
        F.min(key).alias("min_id"),
        F.max(key).alias("max_id"),
    ).withColumn(
        "is_contiguous",
        (F.col("min_id") == 0)
        & (F.col("max_id") == F.col("n_rows") - 1)
        & (F.col("n_distinct") == F.col("n_rows")),
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Columns that hold NULLs, with their counts."""
    return column_profile(df).where(F.col("n_null") > 0).select("column_name", "n_null")


def enforce_domain(df: DataFrame, column: str, domain: DataFrame, flag: str = "violates") -> DataFrame:
    """NULL out values that are not in the one-column ``domain`` and flag the rows they came from."""
    known = domain.select(F.col(domain.columns[0]).alias(column)).distinct().withColumn("_known", F.lit(True))
    joined = lookup_join(df, known, [column], "left")
    unknown = F.col(column).isNotNull() & F.col("_known").isNull()
    kept = [F.when(~unknown, F.col(c)).alias(c) if c == column else F.col(c) for c in df.columns]
    return joined.select(*kept, unknown.alias(flag))
