"""Comparing retrieval variants and extraction variants."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.operators.filters import FILTER_COLUMNS
from rankweave.plans.ordered import running_total

OUTCOMES = ["agree", "both_none", "missed", "spurious", "differ"]
# Half-open ranges of eligible items.
SELECTIVITY_RANGES = [("narrow", 0, 500), ("mid", 500, 20_000), ("broad", 20_000, 10**9)]


def share(common: Column, total: Column) -> Column:
    """common / total, 1.0 for an empty total."""
    return F.when(total == 0, F.lit(1.0)).otherwise(common / total)


def overlap(a: DataFrame, b: DataFrame, queries: DataFrame) -> DataFrame:
    """Per query: how much of list ``a`` is also in list ``b``, by set; 1.0 where ``a`` is empty.

    One grouping over both lists instead of a join of one with the other.
    """
    both = a.select("query_id", "doc_id", F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        b.select("query_id", "doc_id", F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    per_doc = both.groupBy("query_id", "doc_id").agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    per_query = per_doc.groupBy("query_id").agg(
        F.sum("_a").alias("n_a"),
        F.sum("_b").alias("n_b"),
        F.count_if((F.col("_a") > 0) & (F.col("_b") > 0)).alias("n_common"),
    )
    joined = queries.select("query_id").join(per_query, "query_id", "left")
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_a", "n_b", "n_common")]
    return joined.select("query_id", *counts).withColumn("overlap", share(F.col("n_common"), F.col("n_a")))


def stage_divergence(ranked: DataFrame, queries: DataFrame) -> DataFrame:
    """Per query and stage: overlap of the approximate list with the exact one, list sizes, equal first id.

    ``ranked`` holds (variant, stage, query_id, doc_id, rank) of both variants. Every query has a row per
    stage, also where both lists are empty (overlap 1.0, first id not equal).
    """
    is_exact = F.col("variant") == "exact"
    per_doc = ranked.groupBy("stage", "query_id", "doc_id").agg(
        F.min(F.when(is_exact, F.col("rank"))).alias("_exact"),
        F.min(F.when(~is_exact, F.col("rank"))).alias("_other"),
    )
    per_query = per_doc.groupBy("stage", "query_id").agg(
        F.count("_exact").alias("n_exact"),
        F.count("_other").alias("n_approximate"),
        F.count_if(F.col("_exact").isNotNull() & F.col("_other").isNotNull()).alias("n_common"),
        F.count_if((F.col("_exact") == 1) & (F.col("_other") == 1)).alias("_same"),
    )
    stages = F.explode(F.array(*[F.lit(s) for s in ("candidates", "fused", "final")])).alias("stage")
    every = queries.select("query_id", stages)
    joined = every.join(per_query, ["stage", "query_id"], "left")
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_exact", "n_approximate", "n_common")]
    return joined.select(
        "query_id", "stage", *counts, (F.coalesce("_same", F.lit(0)) > 0).alias("top1_same")
    ).withColumn("overlap", share(F.col("n_common"), F.col("n_exact")))


def cut_stages(ranked: DataFrame, depths: dict[str, int]) -> DataFrame:
    """Keep each stage only to the depth at which it is compared."""
    keep = reduce(
        lambda acc, item: acc | ((F.col("stage") == item[0]) & (F.col("rank") <= item[1])),
        depths.items(),
        F.lit(False),
    )
    return ranked.where(keep)


def summarize(df: DataFrame, by: str, metric: str) -> DataFrame:
    """Mean, minimum and number of perfect scores of a metric."""
    return df.groupBy(by).agg(
        F.round(F.avg(metric), 9).alias("mean"),
        F.min(metric).alias("min"),
        F.count_if(F.col(metric) == 1.0).alias("perfect"),
        F.count("*").alias("n"),
    )


def numeric_summary(df: DataFrame, value: str) -> DataFrame:
    """Mean, exact median and maximum.

    Equal values are counted first, inside each task; the median is then found from running counts over
    ranges of values, so neither a frequent value nor many distinct ones gather in one task.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n"))
    upto = running_total(counted, value, "n")
    total = upto.agg(F.max("upto")).first()[0] or 0
    middle = [F.min(F.when(F.col("upto") >= at, F.col(value))) for at in ((total + 1) // 2, total // 2 + 1)]
    return upto.agg(
        F.round(F.sum(F.col(value) * F.col("n")) / F.sum("n"), 9).alias("mean"),
        F.round((middle[0] + middle[1]) / 2, 6).alias("median"),
        F.max(value).alias("max"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n"),
    )


def by_range(
    df: DataFrame, size: str, metric: str, ranges: list[tuple[str, float, float]] = SELECTIVITY_RANGES
) -> DataFrame:
    """Mean of a metric per half-open range of ``size``; ranges without rows are left out."""
    label = reduce(
        lambda acc, r: F.when((F.col(size) >= r[1]) & (F.col(size) < r[2]), r[0]).otherwise(acc),
        reversed(ranges),
        F.lit(None).cast("string"),
    )
    return (
        df.withColumn("bucket", label)
        .where(F.col("bucket").isNotNull())
        .groupBy("bucket")
        .agg(F.round(F.avg(metric), 9).alias("mean"), F.count("*").alias("n"))
    )


def field_outcomes(reference: DataFrame, other: DataFrame) -> DataFrame:
    """One row per query and filter field: both values as text and how they compare."""

    def long_form(df: DataFrame, value: str) -> DataFrame:
        as_text = [F.col(c).cast("string").alias(c) for c in FILTER_COLUMNS]
        return df.select("query_id", *as_text).unpivot("query_id", FILTER_COLUMNS, "field", value)

    paired = long_form(reference, "expected").join(long_form(other, "actual"), ["query_id", "field"])
    a, b = F.col("expected"), F.col("actual")
    outcome = (
        F.when(a.isNull() & b.isNull(), "both_none")
        .when(a.eqNullSafe(b), "agree")
        .when(b.isNull(), "missed")
        .when(a.isNull(), "spurious")
        .otherwise("differ")
    )
    return paired.withColumn("outcome", outcome)


def field_agreement(outcomes: DataFrame) -> DataFrame:
    """Confusion counts per field."""
    counts = [F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES]
    return outcomes.groupBy("field").agg(*counts)


def agreement_totals(outcomes: DataFrame) -> DataFrame:
    """Totals over all fields, the matched share of what the reference set, and identical queries."""
    per_query = outcomes.groupBy("query_id").agg(
        *[F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES]
    )
    issues = F.col("missed") + F.col("spurious") + F.col("differ")
    totals = per_query.agg(
        *[F.sum(o).cast("bigint").alias(o) for o in OUTCOMES],
        F.count_if(issues == 0).alias("identical_queries"),
        F.count("*").alias("n_queries"),
    )
    set_by_reference = F.col("agree") + F.col("missed") + F.col("differ")
    return totals.withColumn("set_by_reference", set_by_reference).withColumn(
        "matched_share", F.round(F.try_divide(F.col("agree"), F.col("set_by_reference")), 9)
    )


def disagreements(outcomes: DataFrame) -> DataFrame:
    """Queries with issues, their issues in one sorted line (at most one per field)."""
    a, b, field = F.col("expected"), F.col("actual"), F.col("field")
    issue = (
        F.when(F.col("outcome") == "missed", F.concat(F.lit("missed "), field, F.lit("="), a))
        .when(F.col("outcome") == "spurious", F.concat(F.lit("spurious "), field, F.lit("="), b))
        .when(
            F.col("outcome") == "differ",
            F.concat(field, F.lit(": expected="), a, F.lit(" actual="), b),
        )
    )
    listed = outcomes.select("query_id", issue.alias("issue")).where(F.col("issue").isNotNull())
    return listed.groupBy("query_id").agg(
        F.array_join(F.array_sort(F.collect_list("issue")), "; ").alias("issues"),
        F.count("*").alias("n_issues"),
    )


def failure_summary(runs: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Completed and failed extractions, and the agreement over completed ones only.

    ``runs`` has one row per query with its ``status``; only ``ok`` ones enter the rates.
    """
    per_query = outcomes.groupBy("query_id").agg(
        F.count_if(F.col("outcome") == "agree").alias("_agree"),
        F.count_if(F.col("outcome").isin("agree", "missed", "differ")).alias("_set"),
    )
    ok = F.col("status") == "ok"
    return runs.join(per_query, "query_id", "left").agg(
        F.count("*").alias("n_runs"),
        F.count_if(ok).alias("completed"),
        F.count_if(~ok).alias("failed"),
        F.sum(F.when(ok, F.coalesce("_agree", F.lit(0))).otherwise(0)).cast("bigint").alias("agree"),
        F.sum(F.when(ok, F.coalesce("_set", F.lit(0))).otherwise(0)).cast("bigint").alias("set_by_reference"),
    )


def config_summary(recalls: DataFrame, config: list[str]) -> DataFrame:
    """Mean and minimum recall and the number of zero-recall queries per configuration."""
    return recalls.groupBy(*config).agg(
        F.round(F.avg("recall"), 9).alias("mean"),
        F.min("recall").alias("min"),
        F.count_if(F.col("recall") == 0.0).alias("zeros"),
        F.count("*").alias("n_queries"),
    )


def best_config(summary: DataFrame, config: list[str], baseline: dict) -> DataFrame:
    """The configuration with the highest mean (the earliest one on ties) and the baseline's mean."""
    record = F.struct(*config, "mean")
    order = F.struct(F.col("mean"), *[(-F.col(c)).alias(c) for c in config])
    is_base = reduce(lambda a, b: a & b, [F.col(c) == v for c, v in baseline.items()])
    return summary.agg(
        F.max_by(record, order).alias("_best"), F.max(F.when(is_base, F.col("mean"))).alias("baseline_mean")
    ).select("_best.*", "baseline_mean")
