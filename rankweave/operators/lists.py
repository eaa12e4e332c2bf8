"""Centres of an inverted file learnt from the vectors: seeding in rounds of oversampling, then mergeable averaging steps.

Vectors are compared by direction, as the lists are when they are searched. Centres are a table from the first round to the
last; tasks get them as one broadcast of at most ``nearest.CENTROID_NUMBERS`` numbers a part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankweave.operators.nearest import InvertedFile, build_inverted_file, nearest_lists, normalized
from rankweave.session import cut_lineage

ROUNDS = 4
STEPS = 8
# Centres drawn per round, as a multiple of the lists wanted.
OVERSAMPLING = 2.0
DIGITS = 6
UNIT = float(1 << 53)


def uniform(*parts):
    """A number in [0, 1) that depends on its arguments only, so that a task that runs again draws the same."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / F.lit(UNIT)


def nearest_centre(unit: DataFrame, centres: DataFrame) -> DataFrame:
    """``unit`` (doc_id, embedding) with its best ``list_id`` and how far it is from it (1 - cosine, not below 0)."""
    found = nearest_lists(unit, "embedding", centres, 1)
    apart = F.greatest(F.lit(0.0), 1.0 - F.get("_scores", F.lit(0)))
    return found.select("doc_id", "embedding", F.get("_lists", F.lit(0)).alias("list_id"), apart.alias("apart"))


def numbered(rows: DataFrame) -> DataFrame:
    """(list_id, centroid) of chosen rows (doc_id, embedding), numbered in order of id; chosen rows are as few as lists."""
    number = F.row_number().over(Window.orderBy("doc_id")) - 1
    keys = rows.select("doc_id").withColumn("list_id", number.cast("int"))  # numbers only go through one task
    vector = F.transform("embedding", lambda x: x.cast("double"))
    return rows.join(keys, "doc_id").select("list_id", vector.alias("centroid"))


def seeds(unit: DataFrame, n_lists: int, seed: int, rounds: int = ROUNDS) -> DataFrame:
    """(list_id, centroid): ``n_lists`` starting centres (fewer where there are fewer vectors).

    A first vector is drawn; then in each round every vector is drawn with a chance in proportion to its distance from what is
    drawn so far, some ``OVERSAMPLING * n_lists`` a round. Drawn vectors are weighed by the vectors nearest to them, and
    the wanted number is drawn among them by weight, without putting back.
    """
    first = unit.select(F.min_by(F.struct("doc_id", "embedding"), uniform(F.col("doc_id"), F.lit(seed))).alias("r")).select("r.*")
    drawn = cut_lineage(first.where("doc_id is not null"), "seeds")
    for turn in range(rounds):
        placed = nearest_centre(unit, numbered(drawn))
        placed = cut_lineage(placed.select("doc_id", "embedding", "apart"), "apart")
        total = placed.agg(F.sum("apart")).first()[0] or 0.0
        if total <= 0:
            break
        chance = F.col("apart") * F.lit(OVERSAMPLING * n_lists / total)
        more = placed.where(uniform(F.col("doc_id"), F.lit(seed + turn + 1)) < chance).select("doc_id", "embedding")
        drawn = cut_lineage(drawn.unionByName(more.join(drawn.select("doc_id"), "doc_id", "left_anti")), "seeds")
    candidates = cut_lineage(numbered(drawn), "candidates")
    weights = nearest_centre(unit, candidates).groupBy("list_id").agg(F.count("*").alias("n"))
    # the n smallest of exponential times with the weight as rate are a draw by weight without putting back
    time = -F.log(1.0 - uniform(F.col("list_id"), F.lit(seed))) / F.coalesce("n", F.lit(0.5))
    chosen = candidates.join(weights, "list_id", "left").orderBy(time, "list_id").limit(n_lists)
    return numbered(chosen.select(F.col("list_id").alias("doc_id"), F.col("centroid").alias("embedding")))


def averaged(unit: DataFrame, centres: DataFrame) -> DataFrame:
    """One step: each centre becomes the direction of the sum of its vectors; one without vectors stays.

    Sums are combined inside each task: (list, dimension) is all that is shuffled.
    """
    placed = nearest_centre(unit, centres).select("list_id", F.posexplode("embedding").alias("dim", "x"))
    sums = placed.groupBy("list_id", "dim").agg(F.sum(F.col("x").cast("double")).alias("x"))
    vectors = sums.groupBy("list_id").agg(F.sort_array(F.collect_list(F.struct("dim", "x"))).alias("v"))
    moved = normalized(vectors.select("list_id", F.col("v.x").alias("embedding")), "embedding")
    rounded = F.transform("embedding", lambda x: F.round(x, DIGITS))
    joined = centres.join(moved.select("list_id", rounded.alias("_moved")), "list_id", "left")
    return joined.select("list_id", F.coalesce("_moved", "centroid").alias("centroid"))


def train_lists(vectors: DataFrame, n_lists: int, seed: int = 7, rounds: int = ROUNDS, steps: int = STEPS) -> DataFrame:
    """(list_id, centroid) of ``vectors`` (doc_id, embedding); null and zero vectors take no part."""
    known = vectors.where(F.col("embedding").isNotNull()).select("doc_id", F.col("embedding").cast("array<double>").alias("embedding"))
    unit = cut_lineage(normalized(known, "embedding").where("embedding is not null"), "unit")
    if unit.isEmpty():
        return unit.sparkSession.createDataFrame([], "list_id int, centroid array<double>")
    centres = cut_lineage(seeds(unit, n_lists, seed, rounds), "centres")
    for _ in range(steps):
        centres = cut_lineage(averaged(unit, centres), "centres")
    return centres


def build_trained_file(items: DataFrame, n_lists: int, seed: int = 7, path: str | None = None) -> InvertedFile:
    """An inverted file over lists that are learnt from the items themselves."""
    return build_inverted_file(items, train_lists(items.select("doc_id", "embedding"), n_lists, seed), path=path)
