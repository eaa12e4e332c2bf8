"""Combining ranked lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankweave.functions.scoring import RRF_K, reciprocal_rank
from rankweave.plans.ordered import rank_in_groups


def assign_ranks(scored: DataFrame, key: str = "query_id") -> DataFrame:
    """1-based rank of every row per query by score, ties by document; lists may be of any length."""
    return rank_in_groups(scored, key, [F.desc("score"), F.asc("doc_id")])


def tag_lists(*lists: DataFrame) -> DataFrame:
    """Ranked lists stacked, each row knowing its list."""
    tagged = [
        ranked.select("query_id", "doc_id", "rank", F.lit(i).alias("list_ix")) for i, ranked in enumerate(lists)
    ]
    return reduce(DataFrame.unionByName, tagged)


def fuse(*lists: DataFrame, k: int = RRF_K) -> DataFrame:
    """Reciprocal rank fusion of any number of ranked lists.

    Every occurrence of a document adds 1 / (k + rank). Equal scores keep the order in which documents
    are first seen: earlier list, then better rank. Input is a few hundred rows per query.
    """
    fused = (
        tag_lists(*lists)
        .groupBy("query_id", "doc_id")
        .agg(
            F.round(F.sum(reciprocal_rank(F.col("rank"), k)), 12).alias("score"),
            F.min(F.struct("list_ix", "rank")).alias("_first"),
        )
    )
    window = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("_first"), F.asc("doc_id"))
    return fused.select("query_id", "doc_id", F.row_number().over(window).alias("rank"), F.round("score", 9).alias("score"))
