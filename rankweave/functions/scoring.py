"""Score formulas as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The usual BM25 parameters and the usual fusion constant.
K1 = 1.2
B = 0.75
RRF_K = 60


def bm25_idf(n_docs: int | Column, df: Column) -> Column:
    n = n_docs if isinstance(n_docs, Column) else F.lit(float(n_docs))
    return F.log(F.lit(1.0) + (n - df + 0.5) / (df + 0.5))


def bm25_saturation(tf: Column, dl: Column, avgdl: float) -> Column:
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * dl / F.lit(float(avgdl))))


def reciprocal_rank(rank: Column, k: int = RRF_K) -> Column:
    return F.lit(1.0) / (F.lit(k) + rank)


def term_coverage(query_tokens: Column, text_tokens: Column) -> Column:
    """Share of the distinct query terms found in the text; 0 for a query without terms."""
    wanted = F.array_distinct(query_tokens)
    covered = F.size(F.array_intersect(wanted, text_tokens))
    return F.when(F.size(wanted) == 0, F.lit(0.0)).otherwise(covered / F.size(wanted))
