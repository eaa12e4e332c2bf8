"""Text to vector. The encoder is a plug point; the built-in one is a labelled stand-in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: instruction put before query text, never before item text.
QUERY_PREFIX = "Represent this sentence for searching relevant passages: "
DIMENSIONS = 64


def with_query_prefix(queries: DataFrame, text: str = "query", prefix: str = QUERY_PREFIX) -> DataFrame:
    return queries.withColumn(text, F.concat(F.lit(prefix), F.col(text)))


def term_dimension(term: Column, dimensions: int = DIMENSIONS) -> Column:
    """Stable position of a term: leading hex digits of its MD5."""
    return F.conv(F.substring(F.md5(term), 1, 6), 16, 10).cast("int") % dimensions


def hashed_components(postings: DataFrame, key: str = "doc_id", dimensions: int = DIMENSIONS) -> DataFrame:
    """Non-zero components (key, dim, weight) of unit-length hashed term vectors.

    ``postings`` has ``key`` and ``postings``. With the catalogue's buckets both groupings stay in place.
    """
    counts = (
        postings.select(key, F.explode("postings").alias("p"))
        .groupBy(key, term_dimension(F.col("p.term"), dimensions).alias("dim"))
        .agg(F.sum("p.tf").alias("tf"))
    )
    # at most `dimensions` rows per key
    packed = counts.groupBy(key).agg(
        F.collect_list(F.struct("dim", "tf")).alias("parts"),
        F.sqrt(F.sum((F.col("tf") * F.col("tf")).cast("double"))).alias("norm"),
    )
    return packed.select(key, "norm", F.explode("parts").alias("c")).select(
        key, F.col("c.dim").alias("dim"), F.round(F.col("c.tf") / F.col("norm"), 6).alias("weight")
    )


def hashed_vectors(postings: DataFrame, key: str = "doc_id", dimensions: int = DIMENSIONS) -> DataFrame:
    """Dense (key, embedding) form of :func:`hashed_components`; texts without terms are absent."""
    packed = hashed_components(postings, key, dimensions).groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.struct("dim", "weight"))).alias("_parts")
    )
    dense = F.transform(
        F.sequence(F.lit(0), F.lit(dimensions - 1)),
        lambda d: F.coalesce(F.element_at("_parts", d), F.lit(0.0)).cast("float"),
    )
    return packed.select(key, dense.alias("embedding"))
