"""Extracting filter records from query text, for a table of queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.functions.text import normalized_key, tokens, whole_word
from rankweave.operators.filters import FILTER_COLUMNS, top_values, value_domain
from rankweave.plans.bounds import lookup_join
from rankweave.session import cut_lineage

# Extraction patterns, applied to lower-cased text. A later price_max pattern overrides.
PRICE_MAX_PATTERNS = (
    r"(?:under|below|less than|cheaper than|max(?:imum)?|up to)\s*\$?\s*(\d+)",
    r"\$?\s*(\d+)\s*(?:or less|or under|and under)",
)
PRICE_MIN_PATTERN = r"(?:over|above|more than|at least|min(?:imum)?)\s*\$\s*(\d+)"
POINTS_MIN_PATTERNS = (
    r"(\d{2,3})\s*\+\s*(?:points?|pts?)",
    r"(\d{2,3})\s*(?:points?|pts?)\s*(?:or (?:better|higher|above|more))",
    r"(?:at least|minimum|min|over|above)\s*(\d{2,3})\s*(?:points?|pts?)",
    r"rated\s*(?:at least\s*)?(\d{2,3})",
    r"(\d{2,3})\s*(?:points?|pts?)\s*(?:or\s*)?(?:up|plus)",
)
POINTS_SCALE = (80, 100)

# Class keywords in priority order.
COLOR_KEYWORDS = [
    ("red", "red"), ("white", "white"), ("rose", "rose"), ("rosé", "rose"), ("blush", "rose"),
    ("sparkling", "sparkling"), ("champagne", "sparkling"), ("bubbly", "sparkling"),
    ("prosecco", "sparkling"), ("cava", "sparkling"), ("dessert", "dessert"), ("port", "fortified"),
    ("sherry", "fortified"), ("fortified", "fortified"), ("madeira", "fortified"),
    ("orange wine", "orange"),
]

# Names that stand for a facet value, in priority order.
COUNTRY_ALIASES = [
    ("italian", "Italy"), ("french", "France"), ("spanish", "Spain"), ("portuguese", "Portugal"),
    ("german", "Germany"), ("austrian", "Austria"), ("australian", "Australia"),
    ("argentinian", "Argentina"), ("argentine", "Argentina"), ("chilean", "Chile"),
    ("american", "US"), ("californian", "US"), ("californian's", "US"), ("new zealand", "New Zealand"),
    ("south african", "South Africa"), ("greek", "Greece"), ("israeli", "Israel"),
    ("hungarian", "Hungary"), ("romanian", "Romania"), ("bulgarian", "Bulgaria"),
    ("canadian", "Canada"), ("uruguayan", "Uruguay"), ("mexican", "Mexico"), ("moldovan", "Moldova"),
    ("slovenian", "Slovenia"), ("croatian", "Croatia"), ("georgian", "Georgia"),
    ("turkish", "Turkey"), ("lebanese", "Lebanon"), ("brazilian", "Brazil"), ("california", "US"),
    ("napa", "US"), ("oregon", "US"), ("sonoma", "US"), ("washington", "US"), ("willamette", "US"),
    ("paso robles", "US"), ("finger lakes", "US"), ("columbia valley", "US"), ("russian river", "US"),
]

UNCLASSED = "other"
# Fixed value: rarer varieties stay free text.
TOP_VARIETIES = 200


def _number(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).cast("double")


def price_bounds(text: Column) -> tuple[Column, Column]:
    """(price_min, price_max) stated in lower-cased text."""
    first, second = (_number(text, p) for p in PRICE_MAX_PATTERNS)
    return _number(text, PRICE_MIN_PATTERN), F.coalesce(second, first)


def points_floor(text: Column) -> Column:
    """Rating floor: the first pattern whose number lies on the rating scale."""
    found = [_number(text, p) for p in POINTS_MIN_PATTERNS]
    return F.coalesce(*[F.when(v.between(*POINTS_SCALE), v) for v in found])


@dataclass(frozen=True)
class Vocabulary:
    """Phrase tables: values to look for, all as data.

    ``countries(value)``, ``aliases(alias, value, priority)``, ``varieties(value, freq_rank)``,
    ``colors(keyword, value, priority)``, ``variety_color(variety, color)``.
    """

    countries: DataFrame
    aliases: DataFrame
    varieties: DataFrame
    colors: DataFrame
    variety_color: DataFrame

    def phrases(self) -> DataFrame:
        """One table of (kind, phrase, value, inferred, priority); the least priority wins.

        Names go alphabetically and before aliases, aliases and colours in table order, varieties longest
        first and then by frequency. Values that differ only in case count as one phrase.
        """

        def order(tier: Column, number: Column, name: Column) -> Column:
            return F.struct(
                tier.cast("int").alias("tier"), number.cast("long").alias("number"), name.alias("name")
            ).alias("priority")

        none = F.lit(None).cast("string").alias("inferred")
        zero, blank = F.lit(0), F.lit("")
        countries = (
            self.countries.groupBy(F.lower("value").alias("phrase"))
            .agg(F.max("value").alias("value"), F.min("value").alias("name"))
            .select(F.lit("country").alias("kind"), "phrase", "value", none, order(zero, zero, F.col("name")))
        )
        aliases = self.aliases.select(
            F.lit("country").alias("kind"), F.col("alias").alias("phrase"), "value", none,
            order(F.lit(1), F.col("priority"), blank),
        )
        color_of = self.variety_color.select(
            F.col("variety").alias("value"), F.nullif("color", F.lit(UNCLASSED)).alias("inferred")
        )
        varieties = (
            self.varieties.groupBy(F.lower("value").alias("phrase"))
            .agg(F.max_by("value", "freq_rank").alias("value"), F.min("freq_rank").alias("freq"))
            .join(color_of, "value", "left")
            .select(
                F.lit("variety").alias("kind"), "phrase", "value", "inferred",
                order(-F.length("phrase"), F.col("freq"), blank),
            )
        )
        colors = self.colors.select(
            F.lit("color").alias("kind"), F.col("keyword").alias("phrase"), "value", none,
            order(zero, F.col("priority"), blank),
        )
        return countries.unionByName(aliases).unionByName(varieties).unionByName(colors)


def pairs_table(spark, pairs: list[tuple[str, str]], key: str) -> DataFrame:
    """A fixed phrase list as a table that keeps its order as ``priority``."""
    rows = [(phrase, value, i) for i, (phrase, value) in enumerate(pairs)]
    return spark.createDataFrame(rows, f"{key} string, value string, priority int")


def vocabulary_of(
    items: DataFrame,
    variety_color: DataFrame,
    aliases: list[tuple[str, str]] = COUNTRY_ALIASES,
    colors: list[tuple[str, str]] = COLOR_KEYWORDS,
    top: int = TOP_VARIETIES,
) -> Vocabulary:
    """Phrase tables for an item table: every country, the most frequent varieties, fixed phrase lists."""
    spark = items.sparkSession
    return Vocabulary(
        countries=value_domain(items, "country").withColumnRenamed("country", "value"),
        aliases=pairs_table(spark, aliases, "alias"),
        varieties=top_values(items, "variety", top).select(F.col("variety").alias("value"), "freq_rank"),
        colors=pairs_table(spark, colors, "keyword"),
        variety_color=variety_color,
    )


def phrase_matches(queries: DataFrame, phrases: DataFrame) -> DataFrame:
    """Rows of ``phrases`` that occur in a query as whole words.

    Candidates come from a hash join: the query's word sequences, of the lengths that phrases have, against
    the word sequence of each phrase. Only those are then checked literally, so no query is compared with
    every phrase.
    """
    words = tokens(F.col("phrase"))
    # read twice below, so it is written once
    phrases = cut_lineage(
        phrases.select("*", F.array_join(words, " ").alias("_gram"), F.size(words).alias("_words")), "phrases"
    )
    sizes, n_phrases = phrases.agg(F.sort_array(F.collect_set("_words")), F.count("*")).first()
    parts = F.col("_parts")

    def sequences(n: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(parts) - n + 1)
        return F.transform(starts, lambda i: F.array_join(F.slice(parts, i, n), " "))

    lengths = F.lit([n for n in sizes if n]).cast("array<int>")
    grams = F.flatten(F.transform(F.filter(lengths, lambda n: n <= F.size(parts)), sequences))
    if 0 in sizes:  # phrases without any letter or digit meet every query under the empty sequence
        grams = F.concat(grams, F.array(F.lit("")))
    spread = (
        queries.select("query_id", F.lower("query").alias("_text"), tokens(F.col("query")).alias("_parts"))
        .select("query_id", "_text", F.explode(F.array_distinct(grams)).alias("_gram"))
    )
    found = lookup_join(spread, phrases.drop("_words"), ["_gram"], small_rows=n_phrases)
    return found.where(whole_word(F.col("_text"), F.col("phrase"))).drop("_gram", "_text")


def extract_by_rules(queries: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """One filter record per query from patterns and phrase tables; the query text is kept as it is."""
    matches = phrase_matches(queries, vocabulary.phrases())

    def best(kind: str, value: str, out: str) -> Column:
        order = F.when(F.col("kind") == kind, F.col("priority"))
        return F.min_by(F.when(F.col("kind") == kind, F.col(value)), order).alias(out)

    facets = matches.groupBy("query_id").agg(
        best("country", "value", "country"),
        best("variety", "value", "variety"),
        best("variety", "inferred", "_inferred"),
        best("color", "value", "_keyword"),
    )
    text = F.lower("query")
    price_min, price_max = price_bounds(text)
    return queries.select("query_id", "query").join(facets, "query_id", "left").select(
        "query_id",
        "country",
        "variety",
        F.coalesce("_keyword", "_inferred").alias("color"),
        price_min.alias("price_min"),
        price_max.alias("price_max"),
        points_floor(text).alias("points_min"),
        F.lit(None).cast("double").alias("points_max"),
        "query",
    )


def extract_once(
    queries: DataFrame, extractor: Callable[[DataFrame], DataFrame], label: str = "llm", repeats: str | None = "cache"
) -> DataFrame:
    """Send each distinct query to ``extractor`` once and give every repeat the same record.

    Repeats are found by a 128-bit hash of the normalised text. The first (least query_id) is marked ``label``, the
    others ``repeats``, or ``label`` too where that is None (rules are never served from a cache). Counting down to one row per text is combined inside each task, and the way back is a join
    that stands a text shared by a large part of all queries.
    """
    keyed = queries.withColumn("_key", F.md5(normalized_key(F.col("query")).cast("binary")))
    first = keyed.groupBy("_key").agg(
        F.min("query_id").alias("query_id"), F.min_by("query", "query_id").alias("query")
    )
    records = extractor(first.select("query_id", "query")).withColumnRenamed("query_id", "_first")
    known = first.select("_key", F.col("query_id").alias("_first")).join(records, "_first")
    source = F.when(F.col("query_id") == F.col("_first"), label).otherwise(repeats or label)
    joined = lookup_join(keyed.select("query_id", "_key"), known, ["_key"])
    return joined.select("query_id", *FILTER_COLUMNS, "query", source.alias("_source"))


def resolve(
    queries: DataFrame,
    rules: DataFrame | None,
    model: DataFrame | None = None,
    cached: DataFrame | None = None,
) -> DataFrame:
    """Choose one whole record per query: cached, else model, else rules, else the raw text.

    ``cached`` and ``model`` are records from outside keyed by query_id; absent rows fall through.
    """
    fields = [*FILTER_COLUMNS, "query"]
    out = queries.select("query_id", F.col("query").alias("_raw"))
    tiers = []
    for name, frame in (("cache", cached), ("llm", model), ("rules", rules)):
        if frame is not None:
            record = F.struct(*fields, F.lit(name).alias("_source"))
            out = out.join(frame.select("query_id", record.alias(f"_{name}")), "query_id", "left")
            tiers.append(F.col(f"_{name}"))
    kinds = ["string"] * 3 + ["double"] * 4
    empty = [F.lit(None).cast(kind).alias(name) for name, kind in zip(FILTER_COLUMNS, kinds)]
    tiers.append(F.struct(*empty, F.col("_raw").alias("query"), F.lit("raw").alias("_source")))
    return out.select("query_id", F.coalesce(*tiers).alias("_chosen")).select("query_id", "_chosen.*")


def freeze(extracted: DataFrame, counts: DataFrame) -> DataFrame:
    """Query-set records: the text, its filters as one struct, and the number of eligible items."""
    source = F.col("_source") if "_source" in extracted.columns else F.lit(None).cast("string")
    record = F.struct(*FILTER_COLUMNS, F.col("query"), source.alias("_source")).alias("filters")
    return extracted.join(counts.select("query_id", "eligible"), "query_id").select(
        "query_id", "query", record, F.col("eligible").alias("eligible_count")
    )
