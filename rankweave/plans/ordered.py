"""Positions in a global order, without gathering all rows in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankweave.session import cut_lineage


def running_total(df: DataFrame, key: str, weight: str | None = None, out: str = "upto") -> DataFrame:
    """Running sum of ``weight`` (rows, without one) up to and including each value of unique ``key``.

    Rows are ranged over tasks and written once, so that every range adds up its own rows and needs only
    the total of the ranges before it.
    """
    amount = F.col(weight) if weight else F.lit(1)
    placed = cut_lineage(df.repartitionByRange(key).withColumn("_range", F.spark_partition_id()), "ranges")
    totals = placed.groupBy("_range").agg(F.sum(amount).alias("_total"))
    before = F.sum("_total").over(Window.orderBy("_range")) - F.col("_total")
    # one row per task of the range shuffle
    offsets = totals.select("_range", before.alias("_before"))
    inside = F.sum(amount).over(
        Window.partitionBy("_range").orderBy(key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    joined = placed.join(F.broadcast(offsets), "_range")
    return joined.withColumn(out, F.col("_before") + inside).drop("_range", "_before")


def rank_in_groups(df: DataFrame, key: str, order: list[Column], out: str = "rank", kind: str = "int") -> DataFrame:
    """``row_number`` per key for groups of any size; ``kind`` is its type, long for groups beyond 2**31 rows.

    Rows are ranged by (key, order), so a key that holds a third of all rows lies across many tasks. Each
    stretch of a key inside one range is numbered by itself and raised by the rows of that key in earlier
    ranges; only the first key of a range can have any, so there is at most one offset per range.
    """
    placed = cut_lineage(
        df.repartitionByRange(F.col(key), *order).withColumn("_range", F.spark_partition_id()), "ranges"
    )
    before = F.sum("_n").over(Window.partitionBy(key).orderBy("_range")) - F.col("_n")
    stretches = placed.groupBy("_range", key).agg(F.count("*").alias("_n"))
    offsets = stretches.select("_range", F.col(key).alias("_key"), before.alias("_before")).where("_before > 0")
    joined = placed.join(
        F.broadcast(offsets.withColumnRenamed("_range", "_from")),
        (F.col("_range") == F.col("_from")) & F.col(key).eqNullSafe(F.col("_key")),
        "left",
    )
    inside = F.row_number().over(Window.partitionBy("_range", key).orderBy(*order))
    rank = (F.coalesce("_before", F.lit(0)) + inside).cast(kind)
    return joined.withColumn(out, rank).drop("_range", "_from", "_key", "_before")
