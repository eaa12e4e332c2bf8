"""Keyword ranking over analysed text: accents folded, stop words left out, suffixes stripped.

The corpus is analysed through its dictionary: each distinct term is stemmed once, and the stems are joined back to the
postings. An analysed catalogue is a catalogue like any other; queries are analysed to stems before they are ranked.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.functions.analysis import terms, with_stem
from rankweave.operators.keyword import keyword_top_k
from rankweave.plans.bounds import lookup_join
from rankweave.session import cut_lineage, scratch_path
from rankweave.sources.catalogue import Catalogue, catalogue_of_postings, open_catalogue, placed, write_bucketed


# At most so many terms are looked up in place: those with more than this part of all rows of the corpus.
OFTEN_TERMS = 100_000


@dataclass(frozen=True)
class Analyzed:
    """A catalogue over stems, and what its text went through: the stop words, as (term)."""

    catalogue: Catalogue
    stop_words: DataFrame
    stemmed: bool
    path: str


def occurrences(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, tf): folded terms of a text with their counts; combined inside each task before the shuffle."""
    exploded = rows.select(key, F.explode(terms(F.col(text))).alias("term"))
    return exploded.groupBy(key, "term").agg(F.count("*").cast("int").alias("tf"))


def frequent_terms(counted: DataFrame, n_docs: int, share: float) -> DataFrame:
    """(term): a stop-word table taken from the corpus, the terms in more than ``share`` of its documents."""
    held = counted.groupBy("term").agg(F.count("*").alias("df"))
    return held.where(F.col("df") > F.lit(share) * n_docs).select("term")


def dictionary(vocabulary: DataFrame, stop_words: DataFrame, stemmed: bool = True) -> DataFrame:
    """(term, stem) of each distinct term that is no stop word."""
    return stems_of(vocabulary.select("term").distinct(), stop_words, stemmed)


def stems_of(distinct: DataFrame, stop_words: DataFrame, stemmed: bool) -> DataFrame:
    """The dictionary of terms that are known to be distinct; their other columns stay."""
    kept = distinct.join(stop_words.select("term"), "term", "left_anti")
    return with_stem(kept, "term") if stemmed else kept.withColumn("stem", F.col("term"))


def with_stems(counted: DataFrame, stems: DataFrame, n: int) -> DataFrame:
    """``counted`` with the ``stem`` of each term in the dictionary ``stems`` (term, stem, df), over ``n`` tasks by ``doc_id``.

    Terms of many documents are few, whatever the corpus: they are looked up where the rows are. The others are too many to
    be sent to every task, but none has enough rows to burden the task that it is shuffled to.
    """
    n_rows = stems.agg(F.sum("df")).first()[0] or 0
    often = F.col("df") > n_rows // OFTEN_TERMS
    heavy = cut_lineage(stems.where(often).select("term", "stem"), "often")
    rare = stems.where(~often).select("term", "stem")
    columns = ["doc_id", "stem", "tf"]
    near = lookup_join(counted, heavy, ["term"]).select(columns)
    far = lookup_join(counted, heavy.select("term"), ["term"], "left_anti").join(rare.hint("merge"), "term").select(columns)
    return near.unionByName(far).repartition(n, "doc_id")


def analyze_catalogue(
    items: DataFrame, stop_words: DataFrame | None = None, stop_share: float | None = None, stemmed: bool = True,
    buckets: int | None = None, path: str | None = None,
) -> Analyzed:
    """Index the item text by stems and write everything below ``path``.

    ``stop_words`` is a table (term); without one ``stop_share`` takes the terms in more than this share of the documents, and
    without either there are none. Statistics (length, average length, document counts) are those of what is left.
    """
    spark = items.sparkSession
    path = path or scratch_path(spark, "analyzed")
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # items lie in the buckets that the catalogue will have, and their terms are counted there
    items = write_bucketed(placed(items, n), n, scratch_path(spark, "source"))
    counted = write_bucketed(occurrences(items, "doc_id", "description"), n, scratch_path(spark, "occurrences"))
    vocabulary = cut_lineage(counted.groupBy("term").agg(F.count("*").alias("df")), "vocabulary")
    if stop_words is None:
        frequent = F.lit(False) if stop_share is None else F.col("df") > F.lit(stop_share) * items.count()
        stop_words = vocabulary.where(frequent).select("term")
    folded = terms(F.col("term"))
    # words of the table are folded like the text; one that falls apart stands for each of its parts
    stop_words.select(F.explode(folded).alias("term")).distinct().write.parquet(f"{path}/stop_words")
    stop_words = spark.read.schema("term string").parquet(f"{path}/stop_words")
    stems = cut_lineage(stems_of(vocabulary, stop_words, stemmed), "dictionary")
    summed = with_stems(counted, stems, n).groupBy("doc_id", "stem").agg(F.sum("tf").cast("int").alias("tf"))
    postings = summed.groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct(F.col("stem").alias("term"), "tf"))).alias("postings"), F.sum("tf").cast("int").alias("dl")
    )
    catalogue = catalogue_of_postings(items, postings, n, f"{path}/catalogue")
    return Analyzed(catalogue, stop_words, stemmed, path)


def open_analyzed(spark: SparkSession, path: str, stemmed: bool = True) -> Analyzed:
    """What :func:`analyze_catalogue` wrote to ``path``."""
    stop_words = spark.read.schema("term string").parquet(f"{path}/stop_words")
    return Analyzed(open_catalogue(spark, f"{path}/catalogue"), stop_words, stemmed, path)


def analyzed_queries(analyzed: Analyzed, queries: DataFrame) -> DataFrame:
    """``queries`` with their text replaced by the stems that it asks for; a query of stop words alone asks for nothing."""
    asked = queries.select("query_id", F.explode(F.array_distinct(terms(F.col("query")))).alias("term"))
    stems = dictionary(asked, analyzed.stop_words, analyzed.stemmed)
    found = lookup_join(asked, stems, ["term"]).groupBy("query_id").agg(F.array_join(F.sort_array(F.collect_set("stem")), " ").alias("_stems"))
    joined = queries.join(found, "query_id", "left")
    return joined.withColumn("query", F.coalesce("_stems", F.lit(""))).drop("_stems")


def analyzed_top_k(analyzed: Analyzed, queries: DataFrame, k: int = 100, filtered: bool = True) -> DataFrame:
    """Best ``k`` documents per query by BM25 over stems."""
    asked = cut_lineage(analyzed_queries(analyzed, queries), "asked")
    return keyword_top_k(analyzed.catalogue, asked, k, filtered)
