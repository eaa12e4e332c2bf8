"""Vector ranking: exact, and approximate over an inverted file."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankweave.functions import kernels
from rankweave.functions.vectors import l2_norm, l2_normalize
from rankweave.operators.filters import FILTER_COLUMNS, ITEM_COLUMNS
from rankweave.plans.bounds import broadcast_rows, by_query_block, top_k
from rankweave.session import cut_lineage, scratch_path

HITS = "query_id long, doc_id long, score double"
# Centroids are sent to tasks in parts of at most this many numbers.
CENTROID_NUMBERS = 16_000_000
SCORE_DIGITS = 6


def _payload(block: DataFrame, filtered: bool, *extra: str):
    """Broadcast one block of queries (its size is bounded by the block) as Arrow bytes."""
    filters = [f"f_{c}" for c in FILTER_COLUMNS] if filtered else []
    return broadcast_rows(block.where(F.col("qv").isNotNull()).select("query_id", "qv", *filters, *extra))


def _vectors(items: DataFrame, filtered: bool, *extra: str) -> DataFrame:
    facets = ITEM_COLUMNS if filtered else []
    return items.where(F.col("embedding").isNotNull()).select("doc_id", "embedding", *facets, *extra)


def _best(hits: DataFrame, k: int) -> DataFrame:
    ranked = top_k(hits, ["query_id"], [F.desc("score"), F.asc("doc_id")], k)
    return ranked.select("query_id", "doc_id", "rank", F.round("score", SCORE_DIGITS).alias("score"))


def vector_block(items: DataFrame, block: DataFrame, k: int, filtered: bool) -> DataFrame:
    shared, _ = _payload(block, filtered)
    local = _vectors(items, filtered).mapInArrow(kernels.top_k_task(shared, k, filtered), HITS)
    return _best(local, k)


def vector_top_k(items: DataFrame, queries: DataFrame, k: int = 100, filtered: bool = True) -> DataFrame:
    """Exact best ``k`` items per query by inner product, among the items its filters admit.

    The items are never shuffled: every task multiplies its batches with the block of queries, checks the
    filters on the same batch and hands on its own best ``k`` per query.
    """
    return by_query_block(queries, lambda block, _: vector_block(items, block, k, filtered), text=None)


def score_summary(items: DataFrame, queries: DataFrame, filtered: bool = False) -> DataFrame:
    """Per query, over all items: how many were scored, and the mean, lowest and highest score."""

    def run(block: DataFrame, _: int) -> DataFrame:
        shared, _ = _payload(block, filtered)
        partial = _vectors(items, filtered).mapInArrow(
            kernels.score_summary_task(shared, filtered),
            "query_id long, n long, total double, low double, high double",
        )
        return partial.groupBy("query_id").agg(
            F.sum("n").alias("n_scored"),
            F.round(F.sum("total") / F.sum("n"), 6).alias("mean_score"),
            F.round(F.min("low"), 6).alias("min_score"),
            F.round(F.max("high"), 6).alias("max_score"),
        )

    return by_query_block(queries, run, text=None)


def normalized(df: DataFrame, vector: str) -> DataFrame:
    """Unit-length vectors; a zero vector becomes NULL."""
    return (
        df.withColumn("_norm", l2_norm(F.col(vector)))
        .withColumn(vector, l2_normalize(F.col(vector), F.col("_norm")))
        .drop("_norm")
    )


# --- inverted file -------------------------------------------------------------------------------


@dataclass(frozen=True)
class InvertedFile:
    """Items laid out by nearest centroid. ``lists`` is partitioned on disk by ``list_id``."""

    lists: DataFrame
    centroids: DataFrame
    n_lists: int
    path: str


def train_centroids(vectors: DataFrame, n_lists: int, seed: int = 7, max_iter: int = 10) -> DataFrame:
    """k-means centres of all vectors, as (list_id, centroid)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    features = vectors.where(F.col("embedding").isNotNull()).select(
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )
    model = KMeans(k=n_lists, seed=seed, maxIter=max_iter).fit(features)
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return vectors.sparkSession.createDataFrame(rows, "list_id int, centroid array<double>")


def group_centroids(vectors: DataFrame, group: str | Column) -> DataFrame:
    """Mean vector of each group as (list_id, centroid), numbered in group order from 0.

    Groups are few (they become lists); the mean is combined inside each task.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    group = F.col(group) if isinstance(group, str) else group
    means = (
        vectors.where(F.col("embedding").isNotNull())
        .groupBy(group.alias("_group"))
        .agg(Summarizer.mean(array_to_vector(F.col("embedding").cast("array<double>"))).alias("_mean"))
    )
    number = F.row_number().over(Window.orderBy("_group")) - 1
    return means.select(
        number.cast("int").alias("list_id"),
        F.transform(vector_to_array("_mean"), lambda x: F.round(x, 6)).alias("centroid"),
    )


def nearest_lists(rows: DataFrame, vector: str, centroids: DataFrame, n: int | None) -> DataFrame:
    """Append ``_lists``, the best ``n`` lists (all without one) of each vector, best first, and ``_scores``.

    Centroids beyond ``CENTROID_NUMBERS`` are taken in parts: each is broadcast by itself and improves on
    the best lists so far, and between two parts the rows are written, so no task holds two.
    """
    spark = rows.sparkSession
    lists, width = centroids.agg(F.count("*"), F.max(F.size("centroid"))).first()
    if not lists:
        raise ValueError("no centroids")
    parts = -(-lists * width // CENTROID_NUMBERS)
    schema = T.StructType(
        [
            *rows.schema.fields,
            T.StructField("_scores", T.ArrayType(T.DoubleType())),
            T.StructField("_lists", T.ArrayType(T.IntegerType())),
        ]
    )
    ordered = centroids.select("list_id", "centroid").orderBy("list_id")
    for part in range(parts):
        some = ordered.where(F.pmod(F.xxhash64("list_id"), F.lit(parts)) == part) if parts > 1 else ordered
        table = some.toArrow()
        if not table.num_rows:
            continue
        shared = spark.sparkContext.broadcast((table["list_id"].to_numpy(), kernels.matrix_of(table["centroid"])))
        rows = rows.mapInArrow(kernels.nearest_lists_task(shared, vector, n or lists, "_scores", "_lists"), schema)
        if part < parts - 1:
            rows = cut_lineage(rows, "nearest")
    return rows


def assign_lists(items: DataFrame, centroids: DataFrame) -> DataFrame:
    """Append the id of the nearest centroid to every item that has a vector."""
    items = items.where(F.col("embedding").isNotNull())
    found = nearest_lists(items, "embedding", centroids, 1)
    return found.withColumn("list_id", F.get("_lists", F.lit(0))).drop("_scores", "_lists")


def build_inverted_file(
    items: DataFrame, centroids: DataFrame, rows_per_file: int = 500_000, path: str | None = None
) -> InvertedFile:
    """Write the items partitioned by list, below ``path`` (a scratch folder without one).

    Lists are cut into files of about ``rows_per_file`` by a salt whose range follows each list's own size,
    so a list that holds a third of all items is written by many tasks. Searching scans files, never whole
    lists in one task.
    """
    spark = items.sparkSession
    path = path or scratch_path(spark, "lists")
    centroids.write.parquet(f"{path}/centroids")
    centroids = spark.read.schema(centroids.schema).parquet(f"{path}/centroids")
    assigned = cut_lineage(assign_lists(_vectors(items, True), centroids), "assigned")
    # one row per list
    sizes = assigned.groupBy("list_id").agg(F.ceil(F.count("*") / rows_per_file).alias("_files"))
    salted = assigned.join(F.broadcast(sizes), "list_id").withColumn(
        "_salt", F.pmod(F.xxhash64("doc_id"), F.col("_files"))
    )
    placed = salted.repartition("list_id", "_salt").select(assigned.columns)
    placed.write.option("maxRecordsPerFile", rows_per_file).partitionBy("list_id").parquet(f"{path}/lists")
    return open_inverted_file(spark, path)


def open_inverted_file(spark: SparkSession, path: str) -> InvertedFile:
    """An inverted file that :func:`build_inverted_file` wrote, in this session or an earlier one."""
    centroids = spark.read.parquet(f"{path}/centroids")
    lists = spark.read.parquet(f"{path}/lists").withColumn("list_id", F.col("list_id").cast("int"))
    return InvertedFile(lists, centroids, centroids.count(), path)


def probe_lists(queries: DataFrame, centroids: DataFrame, nprobe: int | str) -> DataFrame:
    """Append ``probes``: the lists a query will visit, best first. ``nprobe`` may be a column name."""
    queries = queries.where(F.col("qv").isNotNull())
    widest = queries.agg(F.max(nprobe)).first()[0] if isinstance(nprobe, str) else nprobe
    ranked = nearest_lists(queries, "qv", centroids, widest or 1)
    length = F.col(nprobe) if isinstance(nprobe, str) else F.lit(nprobe)
    return ranked.withColumn("probes", F.slice("_lists", F.lit(1), length)).drop("_scores", "_lists")


def ann_block(
    index: InvertedFile, block: DataFrame, k: int, nprobe: int | str, filtered: bool
) -> DataFrame:
    probed = probe_lists(block, index.centroids, nprobe)
    shared, table = _payload(probed, filtered, "probes")
    wanted = np.unique(table["probes"].combine_chunks().flatten().to_numpy(zero_copy_only=False))
    lists = index.lists.where(F.col("list_id").isin([int(i) for i in wanted]))
    local = _vectors(lists, filtered, "list_id").mapInArrow(
        kernels.top_k_task(shared, k, filtered, index.n_lists), HITS
    )
    return _best(local, k)


def ann_top_k(
    index: InvertedFile, queries: DataFrame, k: int = 100, nprobe: int | str = 2, filtered: bool = True
) -> DataFrame:
    """Approximate best ``k`` per query: only the ``nprobe`` nearest lists are read and scored.

    Lists no query of the block visits are pruned as partitions. May return fewer than ``k``.
    """
    return by_query_block(
        queries, lambda block, _: ann_block(index, block, k, nprobe, filtered), text=None
    )
