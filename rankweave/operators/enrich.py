"""Deriving a column from another column's distinct values."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.operators.filters import value_domain
from rankweave.plans.bounds import lookup_join
from rankweave.plans.ordered import running_total
from rankweave.session import cut_lineage

BATCH = 100


def missing_keys(keys: DataFrame, classes: DataFrame, key: str) -> DataFrame:
    """Keys the classifier gave no class for."""
    return keys.join(classes.select(key), key, "left_anti")


def classify_values(
    df: DataFrame, key: str, classifier: Callable[[DataFrame], DataFrame], default: str = "other"
) -> DataFrame:
    """Lookup table (key, color): every distinct non-null value classified once, gaps set to ``default``."""
    keys = cut_lineage(value_domain(df, key), "keys")  # read twice below, scanned once
    classes = classifier(keys)
    return keys.join(classes, key, "left").select(key, F.coalesce("color", F.lit(default)).alias("color"))


def enrich(df: DataFrame, lookup: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Replace ``columns`` of ``df`` by the lookup's; rows without a match, or without a key, get NULL."""
    return lookup_join(df.drop(*columns), lookup.select(key, *columns), [key], "left")


def key_batches(df: DataFrame, key: str, size: int = BATCH) -> DataFrame:
    """Distinct values of ``key`` in sorted order, cut into numbered batches."""
    numbered = running_total(value_domain(df, key), key)
    return numbered.select(key, F.floor((F.col("upto") - 1) / size).cast("bigint").alias("batch"))


def classify_in_batches(
    keys: DataFrame, key: str, fn: Callable[[list[str]], dict[str, str]], size: int = BATCH
) -> DataFrame:
    """Call ``fn`` (a model client, say) with at most ``size`` keys at a time, on the executors."""

    def run(frames):
        import pandas as pd

        for frame in frames:
            for start in range(0, len(frame), size):
                chunk = frame[key].iloc[start : start + size].tolist()
                yield pd.DataFrame(list(fn(chunk).items()), columns=[key, "color"])

    return keys.select(key).mapInPandas(run, f"{key} string, color string")


def spot_check(lookup: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Class of each wanted key, or NOT FOUND."""
    return wanted.join(lookup, key, "left").select(key, F.coalesce("color", F.lit("NOT FOUND")).alias("color"))
