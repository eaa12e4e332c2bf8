"""Keyword ranking: BM25 over the catalogue's postings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.functions import kernels
from rankweave.functions.scoring import K1, B, bm25_idf
from rankweave.functions.text import tokens
from rankweave.operators.filters import FILTER_COLUMNS, ITEM_COLUMNS
from rankweave.operators.nearest import HITS, SCORE_DIGITS
from rankweave.plans.bounds import broadcast_rows, by_query_block, top_k
from rankweave.sources.catalogue import Catalogue


def query_weights(catalogue: Catalogue, block: DataFrame) -> DataFrame:
    """(query, distinct term) with its idf; terms of no document are absent."""
    terms = block.select("query_id", F.explode(F.array_distinct(tokens(F.col("query")))).alias("term"))
    # a block holds at most BLOCK_TERMS terms, so this side is bounded
    return catalogue.term_df.join(F.broadcast(terms), "term").select(
        "query_id", "term", bm25_idf(catalogue.n_docs, F.col("df")).alias("idf")
    )


def saturation_of(avgdl: float):
    """Weight of a posting by its count and the length of its document, for arrays."""
    k1, b = K1, B
    return lambda tf, dl: tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avgdl))


def keyword_hits(catalogue: Catalogue, block: DataFrame, k: int, filtered: bool) -> DataFrame:
    """Each task's best ``k`` documents per query, for one block of queries.

    The weights of the block are broadcast to the buckets. A document's postings are matched and summed where
    the document lies, and a task hands on at most k rows per query: pairs that share a term never become
    rows. Filters are checked on the same batch; term statistics stay those of the whole corpus.
    """
    filters = [f"f_{c}" for c in FILTER_COLUMNS] if filtered else []
    asked, _ = broadcast_rows(block.select("query_id", *filters))
    weights, _ = broadcast_rows(query_weights(catalogue, block))
    items = catalogue.items.select("doc_id", "dl", "postings", *(ITEM_COLUMNS if filtered else []))
    task = kernels.keyword_task(asked, weights, k, filtered, saturation_of(catalogue.avgdl))
    return items.where("dl > 0").mapInArrow(task, HITS)


def keyword_block(catalogue: Catalogue, block: DataFrame, k: int, filtered: bool) -> DataFrame:
    hits = keyword_hits(catalogue, block, k, filtered)
    ranked = top_k(hits, ["query_id"], [F.desc("score"), F.asc("doc_id")], k)
    return ranked.select("query_id", "doc_id", "rank", F.round("score", SCORE_DIGITS).alias("score"))


def keyword_top_k(
    catalogue: Catalogue, queries: DataFrame, k: int = 100, filtered: bool = True
) -> DataFrame:
    """Best ``k`` documents per query by BM25; documents sharing no term are absent."""
    return by_query_block(queries, lambda block, _: keyword_block(catalogue, block, k, filtered))
