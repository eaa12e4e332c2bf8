"""The whole search, for a table of queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.operators.encode import with_query_prefix
from rankweave.operators.filters import prefixed
from rankweave.operators.fusion import fuse, tag_lists
from rankweave.operators.keyword import keyword_block
from rankweave.operators.nearest import InvertedFile, ann_block, vector_block
from rankweave.operators.normalize import guard_queries
from rankweave.operators.present import NO_MATCH, meta_line, result_card
from rankweave.operators.rerank import Scorer, lexical_scorer, rerank
from rankweave.plans.bounds import by_query_block, rows_of_ids
from rankweave.session import cut_lineage
from rankweave.sources.catalogue import Catalogue

# Candidates per path, pairs reranked, results returned.
CANDIDATES = 100
RERANK_TOP = 50
LIMIT = 10


@dataclass(frozen=True)
class SearchPlan:
    """What a search runs on: the catalogue, and an inverted file for the approximate variant."""

    catalogue: Catalogue
    index: InvertedFile | None = None
    nprobe: int = 2
    candidates: int = CANDIDATES
    rerank_top: int = RERANK_TOP
    scorer: Scorer = lexical_scorer

    def keyword(self, block: DataFrame) -> DataFrame:
        return keyword_block(self.catalogue, block, self.candidates, True)

    def vector(self, block: DataFrame) -> DataFrame:
        if self.index is None:
            return vector_block(self.catalogue.items, block, self.candidates, True)
        return ann_block(self.index, block, self.candidates, self.nprobe, True)

    def reranked(
        self, block: DataFrame, n: int, fused: DataFrame, columns: list[str] | None = None, limit: int = LIMIT
    ) -> DataFrame:
        """Reranked lists of a block of ``n`` queries; with ``columns`` their first ``limit`` rows as items.

        Reranking reads the text as asked (``raw_query``) where the block has it beside the residual text.
        """
        asked = block.withColumn("query", F.col("raw_query")) if "raw_query" in block.columns else block
        items, buckets = self.catalogue.items, self.catalogue.buckets
        return rerank(fused, items, asked, self.rerank_top, self.scorer, n, buckets, columns, limit)


def hybrid_candidates(plan: SearchPlan, queries: DataFrame) -> DataFrame:
    """Both candidate lists, keyword as list 0 and vector as list 1."""
    return by_query_block(queries, lambda block, _: tag_lists(plan.keyword(block), plan.vector(block)))


def search(plan: SearchPlan, queries: DataFrame, columns: list[str], limit: int = LIMIT) -> DataFrame:
    """Filtered keyword and vector candidates, fused, reranked, first ``limit`` rows per query."""

    def run(block: DataFrame, n: int) -> DataFrame:
        return plan.reranked(block, n, fuse(plan.keyword(block), plan.vector(block)), columns, limit)

    return by_query_block(queries, run)


def understood_queries(
    asked: DataFrame,
    understand: Callable[[DataFrame], DataFrame],
    encode: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Raw texts made ready for :func:`search`.

    ``asked`` has (query_id, query). Empty texts drop out; ``understand`` gives one filter record per text
    with its residual ``query``; ``encode`` turns (query_id, query), the residual behind the instruction
    prefix, into (query_id, qv).
    """
    asked = guard_queries(asked.select("query_id", "query"))
    records = cut_lineage(understand(asked), "records")
    vectors = encode(with_query_prefix(records.select("query_id", "query")))
    ready = (
        prefixed(records)
        .join(vectors, "query_id", "left")
        .join(asked.withColumnRenamed("query", "raw_query"), "query_id")
    )
    return cut_lineage(ready, "understood")


def search_summary(plan: SearchPlan, queries: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Per query: candidates on each path, distinct fused ids and results; zeros included.

    Results are the fused ids within the cut for reranking that the catalogue still has, up to ``limit``.
    """

    def run(block: DataFrame, n: int) -> DataFrame:
        found = cut_lineage(tag_lists(plan.keyword(block), plan.vector(block)), "candidates")
        lists = [found.where(F.col("list_ix") == i) for i in range(2)]
        cut = fuse(*lists).where(F.col("rank") <= plan.rerank_top).select("query_id", "doc_id")
        ids = plan.catalogue.items.select("doc_id")
        kept = rows_of_ids(ids, cut, "doc_id", n * plan.rerank_top, plan.catalogue.buckets)
        shown = kept.groupBy("query_id").agg(F.least(F.count("*"), F.lit(limit)).alias("result_count"))
        counts = found.groupBy("query_id").agg(
            F.count_if(F.col("list_ix") == 0).alias("keyword_candidate_count"),
            F.count_if(F.col("list_ix") == 1).alias("vector_candidate_count"),
            F.count_distinct("doc_id").alias("fused_count"),
        )
        names = ["keyword_candidate_count", "vector_candidate_count", "fused_count", "result_count"]
        joined = block.select("query_id").join(counts, "query_id", "left").join(shown, "query_id", "left")
        return joined.select("query_id", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in names])

    return by_query_block(queries, run)


def search_cards(plan: SearchPlan, queries: DataFrame, title: str, meta: list[str], limit: int = LIMIT) -> DataFrame:
    """One text per query: the cards of its results in order, or a fixed sentence where it has none.

    ``title`` and ``meta`` are item columns; a query has at most ``limit`` cards.
    """
    wanted = dict.fromkeys([title, *meta, "points", "price", "description"])
    columns = [c for c in wanted if c != "doc_id"]
    found = search(plan, queries, columns, limit)
    card = result_card(
        F.col("rank"), F.col(title).cast("string"), F.col("points"), meta_line(*[F.col(c) for c in meta]),
        F.col("price"), F.col("description"),
    )
    cards = found.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("rank", card.alias("card")))).alias("_c"))
    shown = F.coalesce(F.array_join("_c.card", "\n\n"), F.lit(NO_MATCH))
    return queries.select("query_id").join(cards, "query_id", "left").select("query_id", shown.alias("cards"))


def compare_variants(exact: SearchPlan, approximate: SearchPlan, queries: DataFrame) -> DataFrame:
    """Ranked lists of both variants at every stage, stacked as (variant, stage, query_id, doc_id, rank).

    Both variants go through the later stages in one pass, as two queries each: the keyword list is
    computed once and item text is read once. Lists that several stages read are written first.
    """

    def as_variant(frame: DataFrame, variant: Column) -> DataFrame:
        twin = F.shiftleft("query_id", 1) + F.col("_variant")
        return frame.withColumn("_variant", variant).withColumn("query_id", twin).drop("_variant")

    def run(block: DataFrame, n: int) -> DataFrame:
        both = F.explode(F.array(F.lit(0), F.lit(1)))
        keyword = as_variant(cut_lineage(exact.keyword(block), "keyword"), both)
        vector = as_variant(exact.vector(block), F.lit(0)).unionByName(
            as_variant(approximate.vector(block), F.lit(1))
        )
        vector = cut_lineage(vector, "vector")
        texts = [c for c in ("query", "raw_query") if c in block.columns]
        asked = as_variant(block.select("query_id", *texts), both)
        fused = cut_lineage(fuse(keyword, vector), "fused")
        final = exact.reranked(asked, 2 * n, fused)
        stages = (("candidates", vector), ("fused", fused), ("final", final))
        stacked = reduce(
            DataFrame.unionByName,
            [frame.select(F.lit(stage).alias("stage"), "query_id", "doc_id", "rank") for stage, frame in stages],
        )
        is_exact = F.col("query_id").bitwiseAND(1) == 0
        return stacked.select(
            F.when(is_exact, "exact").otherwise("approximate").alias("variant"),
            "stage",
            F.shiftright("query_id", 1).alias("query_id"),
            "doc_id",
            "rank",
        )

    return by_query_block(queries, run)
