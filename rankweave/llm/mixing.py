"""Mixing sources to target sizes by pivotal dependent rounding of copy numbers, with Spark functions only.

Targets. Sources in code point order (null last) have weights repeating; they share ``share`` of all sizes
by weight, no source above ``limit`` times its own size, and what is above goes to the others by weight until
none is above. A document of a source then has q = target / source size copies: floor(q) for sure and one
more with probability q - floor(q).

Rounding. Two open documents are paired: one gains probability and the other loses as much of it, measured
in words, by a random choice that keeps both expectations, until one of them is 0 or 1; the other stays
open. Documents of a source are dealt to leaves by a hash, a leaf's documents are paired in turn, and the one
document that stays open in each leaf goes on to the next level of the tree, ``FAN`` leaves together, up to
one per source, which is rounded by its own probability. So the words taken of a source differ from its
target by at most one document. Random choices are hashes of the seed and the documents, so reruns agree.

Rows with equal id, source and text are one unit, taken alike. Null texts and texts without words have size
0 and are taken 0 words (and 0 copies beyond floor(q)). Null ids and sources are values like others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.plans.bounds import lookup_join
from rankweave.plans.ordered import running_total
from rankweave.session import cut_lineage

WEIGHTS = (5.0, 2.0, 1.0)
FAN = 128
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: tuple[float, ...], share: float, limit: float) -> DataFrame:
    """(source, source_size, target, n) from (source, source_size, n), one row per source."""
    named = running_total(sources.where("source is not null").select("source"), "source", out="_place")
    last = named.count()
    ranks = named.unionByName(sources.where("source is null").select("source", F.lit(last + 1).cast("long").alias("_place")))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("_place") - 1, F.lit(len(weights))) + 1).cast("int"))
    weighed = sources.join(
        ranks.select(F.col("source").alias("_source"), weight.alias("_weight")), F.col("source").eqNullSafe(F.col("_source"))
    ).drop("_source")
    weighed = cut_lineage(weighed.withColumn("_cap", F.col("source_size") * F.lit(limit)), "sources")
    total, weight_sum = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.sum("_weight")).first()
    goal = share * total
    level = goal / weight_sum if weight_sum else 0.0
    capped = -1
    while True:  # the level only rises and each round caps at least one source more
        above = F.col("_weight") * F.lit(level) > F.col("_cap")
        n, held, open_ = weighed.agg(
            F.coalesce(F.sum(above.cast("int")), F.lit(0)), F.sum(F.when(above, F.col("_cap"))), F.sum(F.when(~above, F.col("_weight")))
        ).first()
        if n == capped or not open_:
            break
        capped, level = n, (goal - (held or 0.0)) / open_
    return weighed.withColumn("target", F.least(F.col("_cap"), F.col("_weight") * F.lit(level))).drop("_cap", "_weight")


def folded(level: DataFrame, seed: int) -> DataFrame:
    """Pair the open units of each (source, node): decisions, and the unit that stays open."""
    chance = lambda a, b: F.pmod(F.xxhash64(F.lit(seed), a["key"], b["key"]), F.lit(1 << 52)) / float(1 << 52)
    decide = lambda unit, up: F.struct(unit["key"].alias("key"), up.alias("extra"))

    def step(state, b):
        a, done = state["open"], state["done"]
        ratio = b["size"] / a["size"]
        rise = F.least(1 - a["p"], b["p"] * ratio)
        fall = F.least(a["p"], (1 - b["p"]) * ratio)
        up = chance(a, b) * (rise + fall) < fall
        # going up either a reaches 1 or b reaches 0; going down either a reaches 0 or b reaches 1
        a_ends = F.when(up, 1 - a["p"] <= b["p"] * ratio).otherwise(a["p"] <= (1 - b["p"]) * ratio)
        b_left = F.when(up, b["p"] - rise / ratio).otherwise(b["p"] + fall / ratio)
        a_left = F.when(up, a["p"] + rise).otherwise(a["p"] - fall)
        open_ = F.when(
            a_ends, F.struct(b["key"].alias("key"), b["size"].alias("size"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), b_left)).alias("p"))
        ).otherwise(
            F.struct(a["key"].alias("key"), a["size"].alias("size"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), a_left)).alias("p"))
        )
        decided = F.when(a_ends, decide(a, up.cast("int"))).otherwise(decide(b, (~up).cast("int")))
        # a unit that came out whole by itself is settled without a pair
        whole = (a["p"] <= 0) | (a["p"] >= 1)
        return F.struct(
            F.when(whole, b).otherwise(open_).alias("open"),
            F.concat(done, F.array(F.when(whole, decide(a, (a["p"] >= 1).cast("int"))).otherwise(decided))).alias("done"),
        )

    unit = F.struct(F.col("key"), F.col("size").cast("double").alias("size"), F.col("p"))
    order = F.xxhash64(F.lit(seed), F.col("key"))
    gathered = level.groupBy("source", "node").agg(F.sort_array(F.collect_list(F.struct(order.alias("o"), unit.alias("u")))).alias("units"))
    first = F.struct(
        F.element_at("units", 1)["u"].alias("open"),
        F.array().cast("array<struct<key:struct<id:string,digest:bigint>,extra:int>>").alias("done"),
    )
    rest = F.transform(F.slice("units", F.lit(2), F.greatest(F.size("units") - 1, F.lit(1))), lambda x: x["u"])
    return gathered.select("source", "node", F.aggregate(rest, first, step).alias("fold")).select("source", "node", "fold.open", "fold.done")


def rounded(units: DataFrame, largest: int, seed: int) -> DataFrame:
    """(source, key, extra) for units (source, key, size, p, leaves): a tree of folds up to one unit per source."""
    level = units.select(
        "source", "key", "size", "p", F.pmod(F.xxhash64(F.lit(seed), F.col("key")), F.col("leaves")).alias("node")
    )
    made = None
    while True:
        one = cut_lineage(folded(level, seed), "fold")
        done = one.select("source", F.explode("done").alias("d")).select("source", "d.key", "d.extra")
        made = done if made is None else made.unionByName(done)
        if largest <= 1:
            break
        largest = -(-largest // FAN)
        level = one.select(
            "source", "open.key", "open.size", "open.p", F.floor(F.col("node") / FAN).cast("long").alias("node")
        )
    last = F.pmod(F.xxhash64(F.lit(seed + 1), F.col("open.key")), F.lit(1 << 52)) / float(1 << 52) < F.col("open.p")
    return made.unionByName(one.select("source", "open.key", last.cast("int").alias("extra")))


def copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text: str = "text",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = 1.5,
    limit: float = 2.0,
    seed: int = 11,
) -> DataFrame:
    """(id, source, digest, size, n, source_size, target, copies): one row per distinct unit, n equal rows each."""
    measured = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.xxhash64(F.col(text)), F.lit(0)).alias("digest"),
        n_words(F.col(text)).alias("size"),
    )
    units = cut_lineage(measured.groupBy("id", "source", "digest", "size").agg(F.count("*").alias("n")), "units")
    sources = units.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.count("*").alias("_units"))
    targets = source_targets(cut_lineage(sources, "sources"), weights, share, limit)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    # a null source is a source too
    named = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    known = targets.select(named.alias("_name"), "source_size", "target", "_units", rate.alias("_rate"))
    rated = cut_lineage(lookup_join(units.withColumn("_name", named), known, ["_name"]).drop("_name"), "rated")
    sure = F.floor("_rate").cast("long")
    key = F.struct(F.col("id").cast("string").alias("id"), F.col("digest").alias("digest"))
    open_ = rated.where((F.col("_rate") > sure) & (F.col("size") > 0)).select(
        "source",
        key.alias("key"),
        (F.col("size") * F.col("n")).alias("size"),
        (F.col("_rate") - sure).alias("p"),
        F.ceil(F.col("_units") / FAN).cast("long").alias("leaves"),
    )
    largest = open_.agg(F.coalesce(F.max("leaves"), F.lit(1))).first()[0]
    extra = rounded(open_, largest, seed).select(
        F.col("source").alias("_source"), F.col("key.id").alias("_id"), F.col("key.digest").alias("_digest"), "extra"
    )
    same = (
        F.col("source").eqNullSafe(F.col("_source"))
        & F.col("id").cast("string").eqNullSafe(F.col("_id"))
        & (F.col("digest") == F.col("_digest"))
    )
    joined = rated.join(extra, same, "left")
    return joined.select(
        "id", "source", "digest", "size", "n", "source_size", "target", (sure + F.coalesce("extra", F.lit(0))).alias("copies")
    )


def mixed(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text: str = "text", **settings) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    taken = copies(docs, id_col, source_col, text, **settings).where("copies > 0").select("id", "source", "digest", "copies")
    whole = F.struct(*[F.col(f"`{c}`").alias(c) for c in docs.columns])
    keyed = docs.select(
        whole.alias("doc"),
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("doc_source"),
        F.coalesce(F.xxhash64(F.col(text)), F.lit(0)).alias("doc_digest"),
    )
    same = (
        F.col("doc_id").eqNullSafe(F.col("id"))
        & F.col("doc_source").eqNullSafe(F.col("source"))
        & (F.col("doc_digest") == F.col("digest"))
    )
    joined = keyed.join(taken, same)
    return joined.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("doc.*")
