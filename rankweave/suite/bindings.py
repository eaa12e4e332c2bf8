"""The given tables bound to the roles of a search corpus, in Spark and as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.functions.text import with_term_counts
from rankweave.operators import understand
from rankweave.operators.encode import QUERY_PREFIX, hashed_vectors
from rankweave.operators.enrich import enrich
from rankweave.operators.filters import FILTER_COLUMNS, value_domain
from rankweave.operators.nearest import InvertedFile, build_inverted_file, group_centroids
from rankweave.operators.present import RATING_BANDS
from rankweave.operators.understand import (
    COLOR_KEYWORDS,
    Vocabulary,
    extract_by_rules,
    extract_once,
    vocabulary_of,
)
from rankweave.plans.bounds import lookup_join
from rankweave.plans.search import SearchPlan, understood_queries
from rankweave.session import cut_lineage
from rankweave.sources.catalogue import Catalogue, build_catalogue, with_vectors
from rankweave.sources.tables import read_table

# --- items and queries over documents ------------------------------------------------------------

# class of a source, by the number in its name; 4 and 9 have none
SOURCE_CLASS = """CASE WHEN CAST(substr(variety, 4) AS INT) IN (4, 9) THEN NULL
    WHEN CAST(substr(variety, 4) AS INT) IN (14, 19) THEN 'other'
    WHEN CAST(substr(variety, 4) AS INT) % 5 = 0 THEN 'red'
    WHEN CAST(substr(variety, 4) AS INT) % 5 = 1 THEN 'white'
    WHEN CAST(substr(variety, 4) AS INT) % 5 = 2 THEN 'sparkling'
    WHEN CAST(substr(variety, 4) AS INT) % 5 = 3 THEN 'rose' END"""

# filter record of a query, by its id
FILTER_RULES = {
    "country": "CASE item_id % 5 WHEN 1 THEN 'en' WHEN 2 THEN 'fr' WHEN 3 THEN 'de' WHEN 4 THEN '' END",
    "variety": "CASE WHEN item_id % 11 = 7 THEN concat('src', CAST(item_id % 20 AS STRING)) END",
    "color": "CASE item_id % 6 WHEN 2 THEN 'red' WHEN 5 THEN 'white' END",
    "price_min": "CASE WHEN item_id % 8 = 3 THEN CAST(1 AS DOUBLE) END",
    "price_max": "CASE WHEN item_id % 8 = 6 THEN CAST(0 AS DOUBLE) END",
    "points_min": "CASE WHEN item_id % 4 = 1 THEN CAST(500 AS DOUBLE) WHEN item_id = 36 THEN CAST(1000000 AS DOUBLE) END",
    "points_max": "CASE WHEN item_id % 7 = 4 THEN CAST(5000 AS DOUBLE) END",
}

ITEMS_CTE = f"""src_class AS (
  SELECT variety, color FROM (
    SELECT variety, {SOURCE_CLASS} AS color FROM (SELECT DISTINCT source AS variety FROM documents)
  ) WHERE color IS NOT NULL
),
items AS (
  SELECT d.doc_id, d.text AS description, d.lang AS country, d.source AS variety, c.color,
         CAST(l.quality AS DOUBLE) AS price, d.n_chars AS points, e.embedding
  FROM documents d
  LEFT JOIN labels l USING (doc_id)
  LEFT JOIN embeddings e ON e.vec_id = d.doc_id
  LEFT JOIN src_class c ON c.variety = d.source
)"""

QUERIES_CTE = (
    "queries AS (\n  SELECT b.item_id AS query_id, b.text AS query, e.embedding AS qv,\n    "
    + ",\n    ".join(f"{rule} AS f_{name}" for name, rule in FILTER_RULES.items())
    + "\n  FROM benchmark b LEFT JOIN embeddings e ON e.vec_id = b.item_id\n)"
)

FILTER_ON = """(q.f_country IS NULL OR q.f_country = '' OR q.f_country = i.country)
    AND (q.f_variety IS NULL OR q.f_variety = '' OR q.f_variety = i.variety)
    AND (q.f_color IS NULL OR q.f_color = '' OR q.f_color = i.color)
    AND (q.f_price_min IS NULL OR i.price >= q.f_price_min)
    AND (q.f_price_max IS NULL OR i.price <= q.f_price_max)
    AND (q.f_points_min IS NULL OR i.points >= q.f_points_min)
    AND (q.f_points_max IS NULL OR i.points <= q.f_points_max)"""

ELIGIBLE_CTE = f"elig AS (SELECT q.query_id, i.doc_id FROM queries q JOIN items i ON {FILTER_ON})"


def sql_tokens(column: str) -> str:
    return (
        f"list_filter(string_split_regex(lower(coalesce({column}, '')), '[^\\p{{L}}\\p{{N}}]+'), "
        "lambda x: x <> '')"
    )


POSTINGS_CTE = f"""toks AS (SELECT doc_id, unnest({sql_tokens('description')}) AS term FROM items),
postings AS (SELECT doc_id, term, count(*) AS tf FROM toks GROUP BY doc_id, term),
doc_len AS (
  SELECT i.doc_id, coalesce(t.dl, 0) AS dl FROM items i
  LEFT JOIN (SELECT doc_id, sum(tf) AS dl FROM postings GROUP BY doc_id) t USING (doc_id)
),
term_df AS (SELECT term, count(*) AS df FROM postings GROUP BY term),
stats AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM doc_len)"""

KEYWORD_CTE = f"""qterms AS (
  SELECT DISTINCT query_id, term FROM (SELECT query_id, unnest({sql_tokens('query')}) AS term FROM queries)
),
kw_scores AS (
  SELECT q.query_id, p.doc_id,
         round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))), 10) AS score
  FROM qterms q JOIN postings p USING (term) JOIN term_df USING (term) JOIN doc_len USING (doc_id), stats
  GROUP BY q.query_id, p.doc_id
)"""


def sql_top(source: str, k: int, name: str, where: str = "") -> str:
    return f"""{name} AS (
  SELECT query_id, doc_id, CAST(r AS INTEGER) AS rank, round(score, 6) AS score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS r
    FROM {source} {where}
  ) WHERE r <= {k}
)"""


IN_ELIGIBLE = "WHERE (query_id, doc_id) IN (SELECT query_id, doc_id FROM elig)"
KW_CTE = sql_top("kw_scores", 100, "kw", IN_ELIGIBLE)
VECTOR_CTE = """vec_scores AS (
  SELECT q.query_id, i.doc_id,
         round(list_dot_product(CAST(q.qv AS DOUBLE[]), CAST(i.embedding AS DOUBLE[])), 10) AS score
  FROM queries q, items i WHERE q.qv IS NOT NULL AND i.embedding IS NOT NULL
)"""
VEC_CTE = sql_top("vec_scores", 100, "vec", IN_ELIGIBLE)


def sql_centroids(group: str, name: str) -> str:
    """Mean vector per group of embeddings and the nearest of them for items and queries."""
    return f"""{name}_means AS (
  SELECT g, list(m ORDER BY pos) AS centroid FROM (
    SELECT {group} AS g, pos, round(avg(CAST(embedding[pos] AS DOUBLE)), 6) AS m
    FROM embeddings, range(1, 65) AS r(pos) GROUP BY {group}, pos
  ) GROUP BY g
),
{name}_cent AS (SELECT CAST(row_number() OVER (ORDER BY g) - 1 AS INTEGER) AS list_id, centroid FROM {name}_means),
{name}_lists AS (
  SELECT doc_id, list_id FROM (
    SELECT doc_id, list_id, row_number() OVER (PARTITION BY doc_id
      ORDER BY round(list_dot_product(CAST(embedding AS DOUBLE[]), centroid), 10) DESC, list_id) AS r
    FROM items, {name}_cent WHERE embedding IS NOT NULL
  ) WHERE r = 1
),
{name}_probes AS (
  SELECT query_id, list_id, row_number() OVER (PARTITION BY query_id
      ORDER BY round(list_dot_product(CAST(qv AS DOUBLE[]), centroid), 10) DESC, list_id) AS probe
  FROM queries, {name}_cent WHERE qv IS NOT NULL
),
{name}_scores AS (
  SELECT s.query_id, s.doc_id, s.score, p.probe
  FROM vec_scores s JOIN {name}_lists l USING (doc_id) JOIN {name}_probes p USING (query_id, list_id)
)"""


def sql_fuse(lists: dict[str, str], name: str) -> str:
    """``lists`` maps each ranked CTE to its list number."""
    union = " UNION ALL ".join(f"SELECT query_id, doc_id, rank, {ix} AS li FROM {cte}" for cte, ix in lists.items())
    return f"""{name} AS (
  SELECT query_id, doc_id, round(score, 9) AS score,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY t.score DESC, seen, doc_id) AS INTEGER) AS rank
  FROM (
    SELECT query_id, doc_id, round(sum(1.0::DOUBLE / (60 + rank)), 12) AS score, min(li * 1000000 + rank) AS seen
    FROM ({union}) GROUP BY query_id, doc_id
  ) t
)"""


def sql_rerank(fused: str, name: str) -> str:
    return f"""{name} AS (
  SELECT query_id, doc_id, score, fused_rank,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, fused_rank) AS INTEGER) AS rank
  FROM (
    SELECT f.query_id, f.doc_id, f.rank AS fused_rank,
           CASE WHEN len(qt) = 0 THEN 0.0::DOUBLE
                ELSE round(len(list_intersect(qt, {sql_tokens('i.description')})) / len(qt), 6) END AS score
    FROM {fused} f
    JOIN (SELECT query_id, list_distinct({sql_tokens('query')}) AS qt FROM queries) q USING (query_id)
    JOIN items i USING (doc_id)
    WHERE f.rank <= 50
  )
)"""


def sql_labelled(name: str, label: str) -> str:
    shown = f"'$' || printf('%g', {name})" if name.startswith("price") else f"CAST({name} AS VARCHAR)"
    return f"'**{label}:** ' || {shown}"


def sql_band(points: str) -> str:
    """The rating ladder from its fixed values."""
    return "CASE " + " ".join(f"WHEN {points} >= {low} THEN '{label}'" for low, label in RATING_BANDS) + " ELSE '' END"


def ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


ITEMS_AND_QUERIES = (ITEMS_CTE, QUERIES_CTE)
KEYWORD = (*ITEMS_AND_QUERIES, ELIGIBLE_CTE, POSTINGS_CTE, KEYWORD_CTE)
HYBRID = (*KEYWORD, VECTOR_CTE, KW_CTE, VEC_CTE)
SEARCHED = (*HYBRID, sql_fuse({"kw": "0", "vec": "1"}, "fused"), sql_rerank("fused", "reranked"))


def source_classes(keys: DataFrame) -> DataFrame:
    """Rule classifier of sources; sources it does not know are absent."""
    return keys.select("variety", F.expr(SOURCE_CLASS).alias("color")).where(F.col("color").isNotNull())


def items_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as items, before the class column."""
    labels = read_table(spark, folder, "labels").select("doc_id", F.col("quality").cast("double").alias("price"))
    vectors = read_table(spark, folder, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    return (
        read_table(spark, folder, "documents")
        .select(
            "doc_id", F.col("text").alias("description"), F.col("lang").alias("country"),
            F.col("source").alias("variety"), F.col("n_chars").alias("points"),
        )
        .join(labels, "doc_id", "left")
        .join(vectors, "doc_id", "left")
    )


def items(spark: SparkSession, folder: str) -> DataFrame:
    raw = items_raw(spark, folder)
    lookup = source_classes(value_domain(documents_as_items(spark, folder), "variety"))
    return enrich(raw, lookup, "variety", ["color"]).select(
        "doc_id", "description", "country", "variety", "color", "price", "points", "embedding"
    )


def documents_as_items(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "documents").select("doc_id", F.col("source").alias("variety"))


def _bind_queries(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read_table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("item_id"), F.col("embedding").alias("qv")
    )
    bench = read_table(spark, folder, "benchmark")
    # few vectors belong to queries: find those first and leave the rest where they are
    matched = lookup_join(vectors, bench.select("item_id"), ["item_id"])
    return bench.join(matched, "item_id", "left").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query"), "qv",
        *[F.expr(rule).alias(f"f_{name}") for name, rule in FILTER_RULES.items()],
    )


_built: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, folder: str, what: str, build):
    """Indexes are written once per session and corpus and then read by every query that needs them."""
    key = (spark.sparkContext.applicationId, folder, what)
    if key not in _built:
        _built[key] = build()
    return _built[key]


def queries(spark: SparkSession, folder: str) -> DataFrame:
    """Query text, vector and filters (``f_`` columns), written once: every stage of a plan reads them."""
    return _once(spark, folder, "queries", lambda: cut_lineage(_bind_queries(spark, folder), "queries"))


def catalogue(spark: SparkSession, folder: str) -> Catalogue:
    return _once(spark, folder, "catalogue", lambda: build_catalogue(items(spark, folder)))


def centroids(spark: SparkSession, folder: str, group: str = "label") -> DataFrame:
    vectors = read_table(spark, folder, "embeddings")
    return group_centroids(vectors, F.expr(group))


def inverted_file(spark: SparkSession, folder: str, group: str = "label") -> InvertedFile:
    def build() -> InvertedFile:
        means = cut_lineage(centroids(spark, folder, group), "centroids")
        return build_inverted_file(catalogue(spark, folder).items, means)

    return _once(spark, folder, f"lists {group}", build)


def exact_plan(spark: SparkSession, folder: str) -> SearchPlan:
    return SearchPlan(catalogue(spark, folder))


def approximate_plan(spark: SparkSession, folder: str) -> SearchPlan:
    return SearchPlan(catalogue(spark, folder), inverted_file(spark, folder), nprobe=2)


# --- query strings over part ---------------------------------------------------------------------

# One query text per part; the wording covers the extraction rules and their corner cases.
PART_QUERY = """CASE p_size % 12
    WHEN 0 THEN concat('cheap ', p_brand, ' ', p_name, ' under $', CAST(p_size AS STRING), ', 90+ points')
    WHEN 1 THEN concat(p_name, ' rated at least ', CAST(60 + p_size AS STRING))
    WHEN 2 THEN 'something crisp and refreshing'
    WHEN 3 THEN concat('$', CAST(p_size * 10 AS STRING), ' or less ', p_type, ' ', p_name)
    WHEN 4 THEN concat('Under $30 or ', CAST(p_size AS STRING), ' or less')
    WHEN 5 THEN concat(p_brand, ' over $', CAST(p_size AS STRING), ' with 95 points or better')
    WHEN 6 THEN concat('white port over ', CAST(50 + p_size AS STRING), ' points')
    WHEN 7 THEN concat('  ', upper(p_name), '   at least 92  ')
    WHEN 8 THEN concat('orange wine, thunder ', CAST(p_size AS STRING), ' max ', CAST(p_size * 2 AS STRING), ' ', p_brand, '5')
    WHEN 9 THEN concat(p_type, '-style ', p_name, ', minimum ', CAST(60 + p_size AS STRING), ' pts up to $', CAST(p_size * 3 AS STRING))
    WHEN 10 THEN concat('blue', p_name, ' bubbly under 90 points')
    ELSE '   ' END"""

# A reference extraction for the same texts; it departs from the rules in places on purpose.
PART_REFERENCE = {
    "country": "CASE WHEN p_size % 12 IN (0, 5) THEN p_brand WHEN p_size % 12 = 3 THEN 'Brand#1' END",
    "variety": "CASE WHEN p_size % 12 IN (0, 1, 3, 7, 9, 10) THEN p_name END",
    "color": "CASE p_size % 12 WHEN 2 THEN 'white' WHEN 6 THEN 'fortified' WHEN 8 THEN 'orange' END",
    "price_min": "CASE WHEN p_size % 12 = 5 THEN CAST(p_size AS DOUBLE) END",
    "price_max": "CASE p_size % 12 WHEN 0 THEN CAST(p_size AS DOUBLE) WHEN 3 THEN CAST(p_size * 10 AS DOUBLE) WHEN 4 THEN CAST(30 AS DOUBLE) END",
    "points_min": "CASE p_size % 12 WHEN 0 THEN CAST(90 AS DOUBLE) WHEN 5 THEN CAST(95 AS DOUBLE) END",
    "points_max": "CAST(NULL AS DOUBLE)",
}

# class of a part name by its first word; other names have none
NAME_CLASS = """CASE WHEN variety LIKE 'red %' THEN 'red' WHEN variety LIKE 'blue %' THEN 'white'
    WHEN variety LIKE 'hot %' THEN 'sparkling' WHEN variety LIKE 'small %' THEN 'rose' END"""

PART_ALIASES = [
    ("economy", "Brand#1"), ("standard", "Brand#2"), ("promo", "Brand#3"), ("medium", "Brand#4"),
    ("large", "Brand#5"), ("small", "Brand#6"),
]

PART_QUERIES_CTE = f"pq AS (SELECT p_partkey AS query_id, {PART_QUERY} AS query, * FROM part)"


def part_queries(spark: SparkSession, folder: str) -> DataFrame:
    part = read_table(spark, folder, "part")
    return part.select(F.col("p_partkey").alias("query_id"), F.expr(PART_QUERY).alias("query"))


def part_reference(spark: SparkSession, folder: str) -> DataFrame:
    part = read_table(spark, folder, "part")
    fields = [F.expr(PART_REFERENCE[name]).alias(name) for name in FILTER_COLUMNS]
    return part.select(F.col("p_partkey").alias("query_id"), *fields, F.expr(PART_QUERY).alias("query"))


def name_classes(keys: DataFrame) -> DataFrame:
    return keys.select("variety", F.expr(NAME_CLASS).alias("color")).where(F.col("color").isNotNull())


def part_vocabulary(spark: SparkSession, folder: str) -> Vocabulary:
    part = read_table(spark, folder, "part").select(
        F.col("p_brand").alias("country"), F.col("p_name").alias("variety")
    )
    return vocabulary_of(part, name_classes(value_domain(part, "variety")), PART_ALIASES)


def sql_values(pairs: list[tuple[str, str]], key: str) -> str:
    rows = ", ".join(f"('{phrase.replace(chr(39), chr(39) * 2)}', '{value}', {i})" for i, (phrase, value) in enumerate(pairs))
    return f"(VALUES {rows}) AS t({key}, value, priority)"


def sql_word(text: str, phrase: str) -> str:
    edge = "[^\\p{L}\\p{N}_]"
    return (
        f"CASE WHEN contains({text}, {phrase}) THEN "
        f"regexp_matches({text}, '(^|{edge})\\Q' || {phrase} || '\\E($|{edge})') ELSE false END"
    )


def _first(candidates: str, out: str, order: str) -> str:
    return f"""{out} AS (
  SELECT query_id, value FROM (
    SELECT query_id, value, row_number() OVER (PARTITION BY query_id ORDER BY {order}) AS r FROM ({candidates})
  ) WHERE r = 1
)"""


def sql_extract(base: str, countries: str, aliases: list[tuple[str, str]], varieties: str, inferred: str) -> tuple[str, ...]:
    """CTEs that extract records from CTE ``base(query_id, query)`` into ``ext``.

    ``countries`` and ``varieties`` select a column ``v``; ``inferred`` is the class of a ``variety``.
    """
    return (
        f"lq AS (SELECT query_id, lower(query) AS t FROM {base})",
        _first(
            f"""SELECT q.query_id, c.v AS value, 0 AS tier, c.v AS name, 0 AS pos
        FROM lq q JOIN (SELECT DISTINCT v FROM ({countries}) WHERE v IS NOT NULL) c ON {sql_word('q.t', 'lower(c.v)')}
        UNION ALL
        SELECT q.query_id, t.value, 1, '', t.priority
        FROM lq q JOIN {sql_values(aliases, 'alias')} ON {sql_word('q.t', 'alias')}""",
            "x_country",
            "tier, name, pos",
        ),
        f"""top_names AS (
  SELECT v, row_number() OVER (ORDER BY n DESC, v) AS freq FROM (
    SELECT v, count(*) AS n FROM ({varieties}) WHERE v IS NOT NULL GROUP BY v
  ) QUALIFY freq <= 200
)""",
        _first(
            f"SELECT q.query_id, n.v AS value, n.freq FROM lq q JOIN top_names n ON {sql_word('q.t', 'lower(n.v)')}",
            "x_variety",
            "length(value) DESC, freq",
        ),
        _first(
            f"SELECT q.query_id, t.value, t.priority FROM lq q JOIN {sql_values(COLOR_KEYWORDS, 'keyword')} ON {sql_word('q.t', 'keyword')}",
            "x_color",
            "priority",
        ),
        f"x_inferred AS (SELECT query_id, nullif({inferred.replace('variety', 'value')}, 'other') AS value FROM x_variety)",
        sql_price_points(),
        f"""ext AS (
  SELECT b.query_id, c.value AS country, v.value AS variety, coalesce(k.value, f.value) AS color,
         n.price_min, n.price_max, n.points_min, CAST(NULL AS DOUBLE) AS points_max, b.query
  FROM {base} b LEFT JOIN x_country c USING (query_id) LEFT JOIN x_variety v USING (query_id)
  LEFT JOIN x_color k USING (query_id) LEFT JOIN x_inferred f USING (query_id)
  JOIN x_numbers n USING (query_id)
)""",
    )


def _sql_number(pattern: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract(t, '{pattern}', 1), '') AS DOUBLE)"


def sql_price_points() -> str:
    """x_numbers: the numeric bounds, from the same fixed patterns as the Spark expressions."""
    max1, max2 = map(_sql_number, understand.PRICE_MAX_PATTERNS)
    low = _sql_number(understand.PRICE_MIN_PATTERN)
    points = [_sql_number(p) for p in understand.POINTS_MIN_PATTERNS]
    least, most = understand.POINTS_SCALE
    ladder = ", ".join(f"CASE WHEN {p} BETWEEN {least} AND {most} THEN {p} END" for p in points)
    return f"""x_numbers AS (
  SELECT query_id, {low} AS price_min, coalesce({max2}, {max1}) AS price_max, coalesce({ladder}) AS points_min FROM lq
)"""


EXTRACTED_CTES = (
    PART_QUERIES_CTE,
    *sql_extract("pq", "SELECT p_brand AS v FROM part", PART_ALIASES, "SELECT p_name AS v FROM part", NAME_CLASS),
)


# --- whole search from raw text ------------------------------------------------------------------

# A benchmark text with a request at its end; language codes and source names are the facet values.
ASKED = """concat(text, CASE item_id % 5 WHEN 0 THEN concat(' SRC', CAST(item_id % 20 AS STRING))
    WHEN 1 THEN ' over 90 points' WHEN 2 THEN ' red, under $1' WHEN 3 THEN ' english text rated 85' ELSE '  ' END)"""
ASKED_ALIASES = [("english", "en"), ("und", "de"), ("les", "fr")]

_HASHED = """{name}_h AS (
  SELECT {key}, dim, CAST(round(tf / sqrt(CAST(sum(tf * tf) OVER (PARTITION BY {key}) AS DOUBLE)), 6) AS FLOAT) AS w FROM (
    SELECT {key}, CAST('0x' || substr(md5(term), 1, 6) AS INTEGER) % 64 AS dim, count(*) AS tf
    FROM (SELECT {key}, unnest({tokens}) AS term FROM {source}) GROUP BY ALL
  )
),
{name} AS (
  SELECT {key}, list(CAST(coalesce(h.w, 0) AS FLOAT) ORDER BY d.dim) AS v
  FROM (SELECT DISTINCT {key} FROM {name}_h) k CROSS JOIN range(64) AS d(dim) LEFT JOIN {name}_h h USING ({key}, dim)
  GROUP BY {key}
)"""


def sql_hashed(name: str, key: str, source: str, text: str) -> str:
    """Dense hashed term vectors as CTE ``name(key, v)``."""
    return _HASHED.format(name=name, key=key, source=source, tokens=sql_tokens(text))


def asked_ctes() -> tuple[str, ...]:
    """Everything of a search from raw text, down to ``reranked``."""
    records = ", ".join(f"e.{c} AS f_{c}" for c in FILTER_COLUMNS)
    items_cte = ITEMS_CTE.replace("items AS (", "plain_items AS (")
    return (
        f"aq AS (SELECT item_id AS query_id, trim({ASKED}) AS query FROM benchmark)",
        *sql_extract("aq", "SELECT lang AS v FROM documents", ASKED_ALIASES, "SELECT source AS v FROM documents", SOURCE_CLASS),
        items_cte,
        sql_hashed("dv", "doc_id", "documents", "text"),
        sql_hashed("av", "query_id", "aq", f"'{QUERY_PREFIX}' || query"),
        "items AS (SELECT p.* EXCLUDE (embedding), dv.v AS embedding FROM plain_items p LEFT JOIN dv USING (doc_id))",
        f"queries AS (SELECT e.query_id, e.query, {records}, av.v AS qv FROM ext e LEFT JOIN av USING (query_id))",
        ELIGIBLE_CTE, POSTINGS_CTE, KEYWORD_CTE, VECTOR_CTE, KW_CTE, VEC_CTE,
        sql_fuse({"kw": "0", "vec": "1"}, "fused"), sql_rerank("fused", "reranked"),
    )


def asked_queries(spark: SparkSession, folder: str) -> DataFrame:
    bench = read_table(spark, folder, "benchmark")
    return bench.select(F.col("item_id").alias("query_id"), F.expr(ASKED).alias("query"))


def document_vocabulary(spark: SparkSession, folder: str) -> Vocabulary:
    docs = read_table(spark, folder, "documents").select(
        F.col("lang").alias("country"), F.col("source").alias("variety")
    )
    return vocabulary_of(docs, source_classes(value_domain(docs, "variety")), ASKED_ALIASES)


def hashed_catalogue(spark: SparkSession, folder: str) -> Catalogue:
    """The catalogue with vectors of the built-in encoder."""
    plain = catalogue(spark, folder)
    return _once(spark, folder, "hashed", lambda: with_vectors(plain, hashed_vectors(plain.items)))


def understood(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = document_vocabulary(spark, folder)
    return understood_queries(
        asked_queries(spark, folder),
        understand=lambda asked: extract_once(asked, lambda once: extract_by_rules(once, vocabulary), "rules", None),
        encode=lambda texts: hashed_vectors(with_term_counts(texts, "query"), "query_id").withColumnRenamed(
            "embedding", "qv"
        ),
    )
