"""Filter extraction from query text, and display forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankweave.functions.text import SPACES, normalized_key
from rankweave.operators import filters, normalize, present, understand
from rankweave.session import scratch_path
from rankweave.sources.tables import read_query_set, read_table, write_query_set
from rankweave.suite import bindings as b
from rankweave.suite.registry import query

EXT = b.ctes(*b.EXTRACTED_CTES)


def _extracted(spark, folder):
    return understand.extract_by_rules(b.part_queries(spark, folder), b.part_vocabulary(spark, folder))


@query("qu_guard_empty", b.ctes(b.PART_QUERIES_CTE) + r"""SELECT query_id, query FROM (
    SELECT query_id, regexp_replace(coalesce(query, ''), '^@S+|@S+$', '', 'g') AS query FROM pq) WHERE query <> ''""".replace("@S", SPACES))
def qu_guard_empty(spark, folder):
    return normalize.guard_queries(b.part_queries(spark, folder))


@query("qu_normalize_key", b.ctes(b.PART_QUERIES_CTE) + r"""SELECT query_id, trim(regexp_replace(lower(query), '@S+', ' ', 'g')) AS key FROM pq""".replace("@S", SPACES))
def qu_normalize_key(spark, folder):
    return b.part_queries(spark, folder).select("query_id", normalized_key(F.col("query")).alias("key"))


@query("qu_price", EXT + "SELECT query_id, price_min, price_max FROM ext")
def qu_price(spark, folder):
    low, high = understand.price_bounds(F.lower("query"))
    return b.part_queries(spark, folder).select("query_id", low.alias("price_min"), high.alias("price_max"))


@query("qu_points", EXT + "SELECT query_id, points_min FROM ext")
def qu_points(spark, folder):
    floor = understand.points_floor(F.lower("query"))
    return b.part_queries(spark, folder).select("query_id", floor.alias("points_min"))


@query("qu_country", EXT + "SELECT query_id, country FROM ext")
def qu_country(spark, folder):
    return _extracted(spark, folder).select("query_id", "country")


@query("qu_variety", EXT + "SELECT query_id, variety FROM ext")
def qu_variety(spark, folder):
    return _extracted(spark, folder).select("query_id", "variety")


@query("qu_color", EXT + "SELECT q.query_id, c.value AS color FROM pq q LEFT JOIN x_color c USING (query_id)")
def qu_color(spark, folder):
    """Class keywords alone, without what the variety implies."""
    queries, vocabulary = b.part_queries(spark, folder), b.part_vocabulary(spark, folder)
    found = understand.phrase_matches(queries, vocabulary.phrases().where("kind = 'color'"))
    best = found.groupBy("query_id").agg(F.min_by("value", "priority").alias("color"))
    return queries.select("query_id").join(best, "query_id", "left")


@query("qu_color_inferred", EXT + "SELECT query_id, variety, color FROM ext")
def qu_color_inferred(spark, folder):
    return _extracted(spark, folder).select("query_id", "variety", "color")


RECORD = "country, variety, color, price_min, price_max, points_min, points_max, query"


@query("qu_extract", EXT + f"SELECT query_id, {RECORD} FROM ext")
def qu_extract(spark, folder):
    return _extracted(spark, folder)


KEYED = r"""keyed AS (SELECT query_id, trim(regexp_replace(lower(query), '@S+', ' ', 'g')) AS key FROM pq),
first AS (SELECT key, min(query_id) AS first_id FROM keyed GROUP BY key)""".replace("@S", SPACES)


@query(
    "qu_dedupe_extract",
    b.ctes(*b.EXTRACTED_CTES, KEYED)
    + """SELECT k.query_id, e.country, e.variety, e.color, e.price_min, e.price_max, e.points_min, e.points_max, e.query,
       CASE WHEN k.query_id = f.first_id THEN 'llm' ELSE 'cache' END AS _source
    FROM keyed k JOIN first f USING (key) JOIN ext e ON e.query_id = f.first_id""",
)
def qu_dedupe_extract(spark, folder):
    """The rules stand in for the model here."""
    vocabulary = b.part_vocabulary(spark, folder)
    return understand.extract_once(
        b.part_queries(spark, folder), lambda once: understand.extract_by_rules(once, vocabulary)
    )


_REFERENCE = ", ".join(f"{rule} AS {name}" for name, rule in b.PART_REFERENCE.items())
REFERENCE_CTE = f"ref AS (SELECT query_id, {_REFERENCE}, query, p_size, p_brand FROM pq)"


@query(
    "qu_fallback",
    b.ctes(*b.EXTRACTED_CTES, REFERENCE_CTE)
    + "SELECT e.query_id, "
    + ", ".join(
        f"CASE WHEN r.p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') THEN r.{c} ELSE e.{c} END AS {c}"
        for c in RECORD.split(", ")
    )
    + """, CASE WHEN r.p_brand = 'Brand#1' THEN 'cache' WHEN r.p_brand IN ('Brand#2', 'Brand#3') THEN 'llm' ELSE 'rules' END AS _source
    FROM ext e JOIN ref r USING (query_id)""",
)
def qu_fallback(spark, folder):
    """Records from outside exist for some brands; the other queries fall through to the rules."""
    brands = read_table(spark, folder, "part").select(F.col("p_partkey").alias("query_id"), "p_brand")
    outside = b.part_reference(spark, folder).join(brands, "query_id")
    return understand.resolve(
        b.part_queries(spark, folder),
        rules=_extracted(spark, folder),
        model=outside.where(F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3")),
        cached=outside.where(F.col("p_brand") == "Brand#1"),
    )


NO_RECORD = "p_brand IN ('Brand#4', 'Brand#5')"


@query(
    "qu_fallback_raw",
    b.ctes(*b.EXTRACTED_CTES)
    + "SELECT e.query_id, "
    + ", ".join(f"CASE WHEN {NO_RECORD} THEN NULL ELSE e.{c} END AS {c}" for c in filters.FILTER_COLUMNS)
    + f""", e.query, CASE WHEN {NO_RECORD} THEN 'raw' ELSE 'rules' END AS _source
    FROM ext e JOIN part p ON p.p_partkey = e.query_id""",
)
def qu_fallback_raw(spark, folder):
    """Where no tier gives a record, the text itself is the query and no filter is set."""
    brands = read_table(spark, folder, "part").select(F.col("p_partkey").alias("query_id"), "p_brand")
    some = _extracted(spark, folder).join(brands, "query_id").where(f"NOT ({NO_RECORD})")
    return understand.resolve(b.part_queries(spark, folder), rules=some.drop("p_brand"))


def _frozen(spark, folder):
    """Query set over the documents, written as JSON."""
    queries = b.queries(spark, folder)
    counts = filters.match_counts(b.catalogue(spark, folder).items, queries)
    plain = queries.select(
        "query_id", "query", *[F.col(f"f_{c}").alias(c) for c in filters.FILTER_COLUMNS], F.lit("rules").alias("_source")
    )
    path = scratch_path(spark, "query_set")
    write_query_set(understand.freeze(plain, counts), path)
    return path


_FLAT = ", ".join(f"f_{c} AS {c}" for c in filters.FILTER_COLUMNS)
FROZEN_SQL = (
    b.ctes(*b.ITEMS_AND_QUERIES, b.ELIGIBLE_CTE, "n AS (SELECT query_id, count(*) AS c FROM elig GROUP BY query_id)")
    + f"SELECT query_id, query, {_FLAT}, 'rules' AS _source, coalesce(n.c, 0) AS eligible_count FROM queries LEFT JOIN n USING (query_id)"
)


@query("queryset_freeze", FROZEN_SQL)
def queryset_freeze(spark, folder):
    frozen = read_query_set(spark, _frozen(spark, folder))
    names = [f"filters.{c}" for c in (*filters.FILTER_COLUMNS, "_source")]
    return frozen.select("query_id", "query", *names, "eligible_count")


@query(
    "queryset_load",
    b.ctes(*b.ITEMS_AND_QUERIES)
    + "SELECT query_id, query, f_country AS country, f_points_min AS points_min FROM queries",
)
def queryset_load(spark, folder):
    """The same records as JSON arrays, one of about a thousand records per file."""
    frozen = read_query_set(spark, _frozen(spark, folder))
    path = scratch_path(spark, "query_arrays")
    n_files = frozen.count() // 1000 + 1
    arrays = frozen.groupBy(F.pmod(F.xxhash64("query_id"), F.lit(n_files)).alias("part")).agg(
        F.to_json(
            F.collect_list(F.struct("query_id", "query", "filters", "eligible_count")),
            {"ignoreNullFields": "false"},
        ).alias("value")
    )
    arrays.write.partitionBy("part").text(path)
    loaded = read_query_set(spark, path, array=True)
    return loaded.select("query_id", "query", "filters.country", "filters.points_min")


# --- display -------------------------------------------------------------------------------------


@query(
    "rating_band",
    f"SELECT p_partkey, p_size + 55 AS points, {b.sql_band('(p_size + 55)')} AS band FROM part",
)
def rating_band(spark, folder):
    part = read_table(spark, folder, "part").select("p_partkey", (F.col("p_size") + 55).alias("points"))
    return part.withColumn("band", present.rating_band(F.col("points")))


CARD_PRICE = "CASE WHEN p_size > 5 THEN p_retailprice / p_size END"
CARD_PLACE = "CASE WHEN p_size > 45 THEN NULL WHEN p_size > 40 THEN '' ELSE p_brand END"


@query(
    "result_cards",
    f"""WITH c AS (SELECT p_partkey, p_name, p_size + 55 AS points, {CARD_PRICE} AS price, {CARD_PLACE} AS place, p_type FROM part)
    SELECT p_partkey, '**' || p_partkey || '. ' || p_name || '**' || chr(10) || '`' || points || '/100 '
       || {b.sql_band('points')}
       || '` · ' || concat_ws(' · ', p_type, nullif(place, '')) || ' · '
       || CASE WHEN price IS NULL THEN 'price not listed' ELSE '$' || printf('%g', price) END || chr(10) || p_type AS card
    FROM c""",
)
def result_cards(spark, folder):
    part = read_table(spark, folder, "part")
    card = present.result_card(
        F.col("p_partkey"), F.col("p_name"), F.col("p_size") + 55,
        present.meta_line(F.col("p_type"), F.expr(CARD_PLACE)), F.expr(CARD_PRICE), F.col("p_type"),
    )
    return part.select("p_partkey", card.alias("card"))


_PARTS = ", ".join(b.sql_labelled(n, lab) for n, lab in present.FILTER_LABELS)


@query(
    "filter_summary",
    EXT
    + f"""SELECT e.query_id, concat_ws(chr(10),
       coalesce(nullif(concat_ws(' · ', {_PARTS}), ''), 'No hard filters'),
       CASE WHEN e.query <> '' THEN 'Meaning: ' || e.query END,
       p.p_size || ' on keywords, ' || 100 || ' on meaning', 'Filters extracted without the model (rules)') AS summary
    FROM ext e JOIN part p ON p.p_partkey = e.query_id""",
)
def filter_summary(spark, folder):
    sizes = read_table(spark, folder, "part").select(F.col("p_partkey").alias("query_id"), "p_size")
    summary = present.filter_summary(F.col("p_size"), F.lit(100), F.col("query"), F.lit("rules"))
    return _extracted(spark, folder).join(sizes, "query_id").select("query_id", summary.alias("summary"))
