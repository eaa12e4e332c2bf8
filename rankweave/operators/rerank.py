"""Second-stage scoring of the few survivors, and turning ranked ids back into rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankweave.functions.scoring import term_coverage
from rankweave.functions.text import tokens
from rankweave.plans.bounds import lookup_join, rows_of_ids
from rankweave.session import cut_lineage

Scorer = Callable[[Column, Column], Column]


def lexical_scorer(query: Column, text: Column) -> Column:
    """Built-in stand-in for a pair model: share of query terms the text covers."""
    return F.round(term_coverage(tokens(query), tokens(text)), 6)


def rerank(
    fused: DataFrame,
    items: DataFrame,
    queries: DataFrame,
    top_n: int = 50,
    scorer: Scorer = lexical_scorer,
    n_queries: int | None = None,
    buckets: int = 0,
    columns: list[str] | None = None,
    limit: int = 10,
) -> DataFrame:
    """Score the first ``top_n`` of each fused list on (raw query text, item text) and sort by that score.

    Ids without an item row drop out after the cut; equal scores keep the fused order. The text is scored
    where it was read and does not enter the shuffle. With ``columns`` the first ``limit`` ranks also get
    those item columns: they are taken along from the one read, written with the scores, and joined back to
    the ranks, so items are not read again.
    """
    bound = None if n_queries is None else n_queries * top_n
    wanted = fused.where(F.col("rank") <= top_n).select("query_id", "doc_id", F.col("rank").alias("fused_rank"))
    carried = [F.struct(*columns).alias("_item")] if columns else []
    source = items.select("doc_id", F.col("description").alias("_text"), *carried)
    pairs = rows_of_ids(source, wanted, "doc_id", bound, buckets)
    asked = lookup_join(pairs, queries.select("query_id", F.col("query").alias("_query")), ["query_id"])
    scored = asked.select(
        "query_id", "doc_id", "fused_rank", scorer(F.col("_query"), F.col("_text")).alias("score"),
        *(["_item"] if columns else []),
    )
    if columns:
        scored = cut_lineage(scored, "scored")
    window = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("fused_rank"))
    ranked = scored.withColumn("rank", F.row_number().over(window)).select(
        "query_id", "doc_id", "rank", "fused_rank", "score"
    )
    if not columns:
        return ranked
    first = ranked.where(F.col("rank") <= limit)
    shown = None if n_queries is None else n_queries * limit
    found = lookup_join(scored.select("query_id", "doc_id", "_item"), first, ["query_id", "doc_id"], small_rows=shown)
    return found.select("query_id", "doc_id", "rank", "fused_rank", "score", "_item.*")


def hydrate(
    ranked: DataFrame,
    items: DataFrame,
    columns: list[str],
    limit: int = 10,
    n_queries: int | None = None,
    buckets: int = 0,
) -> DataFrame:
    """Item columns for the first ``limit`` ranks. The cut comes first, so a missing id shortens the list."""
    bound = None if n_queries is None else n_queries * limit
    first = ranked.where(F.col("rank") <= limit)
    return rows_of_ids(items.select("doc_id", *columns), first, "doc_id", bound, buckets)


def rank_shift(fused: DataFrame, reranked: DataFrame, k: int = 10) -> DataFrame:
    """First ``k`` of both orders side by side; an id in only one of them has a NULL on the other side."""
    before = fused.where(F.col("rank") <= k).select("query_id", "doc_id", F.col("rank").alias("rank_fused"))
    after = reranked.where(F.col("rank") <= k).select(
        "query_id", "doc_id", F.col("rank").alias("rank_reranked")
    )
    return before.join(after, ["query_id", "doc_id"], "full")
