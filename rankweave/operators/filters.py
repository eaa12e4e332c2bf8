"""Conjunctive filters, for one record and for a table of records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankweave.functions.kernels import FACET_NAMES, RANGE_BOUNDS, count_task
from rankweave.plans.bounds import broadcast_rows, by_query_block, lookup_join

FILTER_COLUMNS = [*FACET_NAMES, *[name for name, _, _ in RANGE_BOUNDS]]
ITEM_COLUMNS = [*FACET_NAMES, "price", "points"]


def condition(record: dict) -> Column:
    """Predicate of one filter record. Unknown keys are ignored, an empty record is always true.

    An empty string leaves a facet unset; 0 is a real bound.
    """
    parts = [F.col(name) == record[name] for name in FACET_NAMES if record.get(name)]
    for name, column, lower in RANGE_BOUNDS:
        bound = record.get(name)
        if bound is not None:
            parts.append(F.col(column) >= bound if lower else F.col(column) <= bound)
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def apply(items: DataFrame, record: dict) -> DataFrame:
    """Rows that satisfy one record. The predicates reach the parquet scan."""
    return items.where(condition(record))


def facets_match() -> Column:
    """Facet part of the predicate between item columns and ``f_`` columns of the same row."""
    parts = [
        F.col(f"f_{name}").isNull() | (F.col(f"f_{name}") == "") | (F.col(f"f_{name}") == F.col(name))
        for name in FACET_NAMES
    ]
    return reduce(lambda a, b: a & b, parts)


def ranges_match() -> Column:
    parts = []
    for name, column, lower in RANGE_BOUNDS:
        bound = F.col(f"f_{name}")
        within = F.col(column) >= bound if lower else F.col(column) <= bound
        parts.append(bound.isNull() | within)
    return reduce(lambda a, b: a & b, parts)


def prefixed(filters: DataFrame) -> DataFrame:
    """Filter columns renamed to ``f_*`` so that they can sit beside item columns."""
    rest = [c for c in filters.columns if c not in FILTER_COLUMNS]
    return filters.select(*rest, *[F.col(c).alias(f"f_{c}") for c in FILTER_COLUMNS])


def _shape_key(shape: int, column) -> Column:
    """Join key for one combination of set facets: the combination and the values of its facets."""
    values = [column(name) for bit, name in enumerate(FACET_NAMES) if shape >> bit & 1]
    key = F.concat_ws("\u0001", F.lit(str(shape)), *values)
    return reduce(lambda acc, v: F.when(v.isNotNull(), acc), values, key)


def match_counts(items: DataFrame, queries: DataFrame) -> DataFrame:
    """Per query: eligible items, smallest and largest eligible id; queries with none keep a 0.

    Only distinct filter records take part. Each record has one of eight shapes (which facets are set),
    and an item carries one key per shape that a record of the block has, so records meet items through a
    hash join on equal facets; the ranges are checked on those matches alone. Records without facets are
    counted by a mask per batch of items. The records of a block are broadcast, the items stay in
    place, and counts are combined inside each task: what is shuffled is one row per record and task.
    """
    return by_query_block(queries, lambda block, n: _match_counts(items, block, n), text=None)


def _match_counts(items: DataFrame, queries: DataFrame, n: int) -> DataFrame:
    f_cols = [f"f_{c}" for c in FILTER_COLUMNS]
    queries = queries.withColumn("_record", F.to_json(F.struct(*f_cols)))
    bits = [
        F.when(F.nullif(F.col(f"f_{name}"), F.lit("")).isNotNull(), 1 << bit).otherwise(0)
        for bit, name in enumerate(FACET_NAMES)
    ]
    shape = reduce(lambda a, b: a + b, bits)
    record_key = reduce(
        lambda acc, s: F.when(shape == s, _shape_key(s, lambda n: F.col(f"f_{n}"))).otherwise(acc),
        range(1, 8),
        F.lit(None).cast("string"),
    )
    bounds = [F.col(f"f_{n}") for n, _, _ in RANGE_BOUNDS]
    records = queries.select("_record", record_key.alias("_key"), *bounds).dropDuplicates(["_record"])
    # at most eight rows
    shapes = [row[0] for row in queries.select(shape).distinct().collect()]
    counts = [F.count("*").alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")]
    parts = []
    if any(shapes):
        keys = F.array_compact(F.array(*[_shape_key(s, F.col) for s in sorted(shapes) if s]))
        spread = items.select("doc_id", "price", "points", F.explode(keys).alias("_key"))
        met = lookup_join(spread, records.where("_key IS NOT NULL"), ["_key"], small_rows=n).where(ranges_match())
        parts.append(met.groupBy("_record").agg(*counts))
    if 0 in shapes or not shapes:
        plain = records.where("_key IS NULL").select(F.col("_record").alias("query_id"), *bounds)
        shared, _ = broadcast_rows(plain)
        seen = items.select("doc_id", "price", "points").mapInArrow(
            count_task(shared), "query_id string, n long, low long, high long"
        )
        parts.append(seen.withColumnRenamed("query_id", "_record"))
    found = (
        reduce(DataFrame.unionByName, parts)
        .groupBy("_record")
        .agg(F.sum("n").alias("eligible"), F.min("low").alias("min_id"), F.max("high").alias("max_id"))
    )
    return queries.select("query_id", "_record").join(found, "_record", "left").select(
        "query_id",
        F.coalesce("eligible", F.lit(0)).cast("bigint").alias("eligible"),
        "min_id",
        "max_id",
    )


def with_selectivity(counts: DataFrame, n_items: int) -> DataFrame:
    """Share of the corpus each filter leaves."""
    share = F.round(F.col("eligible") / F.lit(n_items), 9) if n_items else F.lit(None).cast("double")
    return counts.withColumn("selectivity", share)


def value_domain(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values."""
    return df.where(F.col(column).isNotNull()).select(column).distinct()


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """Most frequent non-null values with their 1-based frequency rank; ties by value."""
    counted = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), F.asc(column))
        .limit(n)
    )
    # at most n rows are left here, so one window over them is small
    return counted.withColumn(
        "freq_rank", F.row_number().over(Window.orderBy(F.desc("n"), F.asc(column)))
    )
