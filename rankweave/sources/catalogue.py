"""The catalogue: one wide item table, bucketed by ``doc_id``, with its text statistics."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.functions.text import with_term_counts
from rankweave.session import scratch_path, settings

SUMMARY = "n_docs long, avgdl double, buckets int"


@dataclass(frozen=True)
class Catalogue:
    """``items`` carries facets, text, vector, ``dl`` and ``postings: array<struct<term, tf>>`` per row."""

    items: DataFrame
    term_df: DataFrame
    n_docs: int
    avgdl: float
    buckets: int
    path: str


def term_statistics(items: DataFrame) -> DataFrame:
    """Number of documents per term. Frequent terms are combined inside each task before the shuffle."""
    return (
        items.select(F.explode("postings.term").alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("df"))
    )


def corpus_statistics(items: DataFrame) -> DataFrame:
    return items.agg(
        F.count("*").alias("n_docs"), F.avg("dl").alias("avgdl"), F.sum("dl").alias("n_tokens")
    )


def write_bucketed(rows: DataFrame, n: int, path: str) -> DataFrame:
    """Write ``rows``, placed over ``n`` tasks by ``doc_id`` and in its order there, as a bucketed table below ``path``.

    ``sortBy`` would sort the finished rows, whose postings are many times as large as their text, and spill most of
    them. A task holds one bucket, so it writes one file in the order its rows already have.
    """
    spark = rows.sparkSession
    name = f"rankweave_{uuid.uuid4().hex}"
    writer = rows.write.bucketBy(n, "doc_id").option("path", f"{path}/items")
    one_bucket_a_task = {"spark__sql__adaptive__coalescePartitions__enabled": "false", "spark__sql__maxConcurrentOutputFileWriters": "1"}
    with settings(spark, **one_bucket_a_task):
        writer.saveAsTable(name)
    return spark.table(name)


def placed(rows: DataFrame, n: int) -> DataFrame:
    """Rows over ``n`` tasks by ``doc_id`` and in its order; to be done before postings make them large."""
    return rows.repartition(n, "doc_id").sortWithinPartitions("doc_id")


def _write_summary(catalogue: Catalogue) -> Catalogue:
    row = [(catalogue.n_docs, catalogue.avgdl, catalogue.buckets)]
    spark = catalogue.items.sparkSession
    spark.createDataFrame(row, SUMMARY).coalesce(1).write.parquet(f"{catalogue.path}/summary")
    return catalogue


def open_catalogue(spark: SparkSession, path: str) -> Catalogue:
    """A catalogue that :func:`build_catalogue` wrote to ``path``, in this session or an earlier one."""
    n_docs, avgdl, buckets = spark.read.schema(SUMMARY).parquet(f"{path}/summary").first()
    fields = spark.read.parquet(f"{path}/items").schema.fields
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    name = f"rankweave_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (doc_id) SORTED BY (doc_id) "
        f"INTO {buckets} BUCKETS LOCATION '{path}/items'"
    )
    return Catalogue(spark.table(name), spark.read.parquet(f"{path}/term_df"), n_docs, avgdl, buckets, path)


def build_catalogue(items: DataFrame, buckets: int | None = None, path: str | None = None) -> Catalogue:
    """Index the item text and write everything below ``path``, as a table bucketed by ``doc_id``.

    Postings stay with their document, so all terms of a document are in one bucket: scoring groups by
    document without a shuffle, joins on ``doc_id`` move only the other side, and a frequent term is
    spread over all buckets instead of forming one huge posting list. Sorted buckets let a lookup of few
    ids use parquet statistics.
    """
    spark = items.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = path or scratch_path(spark, "catalogue")
    table = write_bucketed(with_term_counts(placed(items, n), "description"), n, path)
    term_statistics(table).write.parquet(f"{path}/term_df")
    stats = corpus_statistics(table).first()
    term_df = spark.read.parquet(f"{path}/term_df")
    return _write_summary(Catalogue(table, term_df, stats["n_docs"], stats["avgdl"] or 0.0, n, path))


def catalogue_of_postings(
    items: DataFrame, postings: DataFrame, buckets: int | None = None, path: str | None = None
) -> Catalogue:
    """Like :func:`build_catalogue`, with the postings given as (doc_id, postings, dl); items without any have none.

    Items in as many buckets, and postings placed like them, are not shuffled.
    """
    spark = items.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = path or scratch_path(spark, "catalogue")
    none = F.array().cast(postings.schema["postings"].dataType)
    rows = items.join(postings, "doc_id", "left").withColumns(
        {"postings": F.coalesce("postings", none), "dl": F.coalesce("dl", F.lit(0))}
    )
    table = write_bucketed(placed(rows, n), n, path)
    term_statistics(table).write.parquet(f"{path}/term_df")
    stats = corpus_statistics(table).first()
    term_df = spark.read.parquet(f"{path}/term_df")
    return _write_summary(Catalogue(table, term_df, stats["n_docs"], stats["avgdl"] or 0.0, n, path))


def rows_with_vectors(catalogue: Catalogue, vectors: DataFrame) -> DataFrame:
    """Items with other vectors, in their buckets.

    The vectors of a bucket are held while its items pass by: a sort of both would move rows with all their postings.
    """
    rows = catalogue.items.drop("embedding").join(vectors.hint("shuffle_hash"), "doc_id", "left")
    return rows.repartition(catalogue.buckets, "doc_id")


def with_vectors(catalogue: Catalogue, vectors: DataFrame) -> Catalogue:
    """The same catalogue with other vectors, given as (doc_id, embedding)."""
    path = scratch_path(catalogue.items.sparkSession, "catalogue")
    table = write_bucketed(rows_with_vectors(catalogue, vectors), catalogue.buckets, path)
    catalogue.term_df.write.parquet(f"{path}/term_df")
    return _write_summary(replace(catalogue, items=table, path=path))
