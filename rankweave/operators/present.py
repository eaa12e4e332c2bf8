"""Display forms of results and of extracted filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankweave.functions.kernels import general_format

# Rating bands, highest first.
RATING_BANDS = [
    (98, "Classic"), (94, "Superb"), (90, "Excellent"), (87, "Very Good"), (83, "Good"), (80, "Acceptable"),
]
# Filter labels in display order.
FILTER_LABELS = [
    ("country", "Country"), ("variety", "Grape"), ("color", "Style"), ("price_min", "Min price"),
    ("price_max", "Max price"), ("points_min", "Min rating"), ("points_max", "Max rating"),
]
DOT = " · "
# Fixed value: shown for a query without results.
NO_MATCH = "No item satisfies every filter."


def rating_band(points: Column) -> Column:
    """Label of the first threshold not above ``points``; empty below all of them."""
    ladder = reduce(
        lambda acc, band: F.when(points >= band[0], band[1]).otherwise(acc),
        reversed(RATING_BANDS),
        F.lit(""),
    )
    return ladder


def general_number(value: Column) -> Column:
    """Six significant digits as ``%g`` writes them.

    The JVM formatter rounds the shortest decimal form half up; ``%g`` rounds the exact binary value. Only
    result rows are formatted, so the detour through Arrow is small.
    """
    return F.pandas_udf(general_format, T.StringType())(value.cast("double"))


def price_text(price: Column) -> Column:
    return F.when(price.isNull(), "price not listed").otherwise(F.concat(F.lit("$"), general_number(price)))


def meta_line(*parts: Column) -> Column:
    """Parts joined by a dot, skipping NULL and empty ones."""
    return F.concat_ws(DOT, *[F.nullif(p, F.lit("")) for p in parts])


def result_card(
    number: Column, title: Column, points: Column, meta: Column, price: Column, text: Column
) -> Column:
    head = F.concat(F.lit("**"), number.cast("string"), F.lit(". "), title, F.lit("**"))
    facts = F.concat(
        F.lit("`"), points.cast("string"), F.lit("/100 "), rating_band(points), F.lit("`" + DOT),
        meta, F.lit(DOT), price_text(price),
    )
    return F.concat_ws("\n", head, facts, text)


def filter_line(prefix: str = "") -> Column:
    """Set filters as labelled parts; a fixed sentence where none is set."""
    parts = []
    for name, label in FILTER_LABELS:
        column = F.col(prefix + name)
        shown = F.concat(F.lit("$"), general_number(column)) if name.startswith("price") else column.cast("string")
        parts.append(F.when(column.isNotNull(), F.concat(F.lit(f"**{label}:** "), shown)))
    return F.coalesce(F.nullif(F.concat_ws(DOT, *parts), F.lit("")), F.lit("No hard filters"))


def source_note(source: Column) -> Column:
    """Remark on where the filters came from; NULL when the model gave them."""
    return (
        F.when(source == "cache", "Filters served from cache")
        .when(source.isNull() | source.isin("", "llm"), F.lit(None))
        .otherwise(F.concat(F.lit("Filters extracted without the model ("), source, F.lit(")")))
    )


def filter_summary(keyword_count: Column, vector_count: Column, query: Column, source: Column) -> Column:
    counts = F.concat(
        keyword_count.cast("string"), F.lit(" on keywords, "), vector_count.cast("string"), F.lit(" on meaning")
    )
    meaning = F.when(query != "", F.concat(F.lit("Meaning: "), query))
    return F.concat_ws("\n", filter_line(), meaning, counts, source_note(source))
