"""Sources, sinks, clean-up, checks, filters and plain aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankweave.functions.text import snippet
from rankweave.operators import enrich, filters, normalize, validate
from rankweave.plans.bounds import lookup_join
from rankweave.session import scratch_path
from rankweave.sources import tables
from rankweave.sources.catalogue import corpus_statistics
from rankweave.suite import bindings as b
from rankweave.suite.registry import query

PART_COLUMNS = "p_partkey, p_name, p_brand, p_type, p_size, p_retailprice"


def _part_csv(spark, folder):
    path = scratch_path(spark, "part_csv")
    tables.write_csv(tables.read_table(spark, folder, "part"), path)
    return path


@query("src_csv_scan", f"SELECT {PART_COLUMNS} FROM part")
def src_csv_scan(spark, folder):
    schema = tables.read_table(spark, folder, "part").schema
    return tables.read_csv(spark, _part_csv(spark, folder), schema)


@query(
    "src_describe",
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{name}' AS column_name, '{kind}' AS column_type, "
        f"count(*) - count({name}) AS n_null FROM part"
        for i, (name, kind) in enumerate(
            [("p_partkey", "INTEGER"), ("p_name", "VARCHAR"), ("p_brand", "VARCHAR"), ("p_type", "VARCHAR"),
             ("p_size", "INTEGER"), ("p_retailprice", "DOUBLE")]
        )
    ),
)
def src_describe(spark, folder):
    """Types as inferred from the CSV text, with null counts."""
    return tables.column_profile(tables.read_csv(spark, _part_csv(spark, folder)))


@query("sink_overwrite", f"SELECT {PART_COLUMNS} FROM part")
def sink_overwrite(spark, folder):
    """Replace a table by another version of itself and read the second one."""
    part = tables.read_table(spark, folder, "part")
    path = scratch_path(spark, "part")
    tables.write_table(part.withColumn("p_name", F.upper("p_name")), path)
    tables.write_table(part, path)
    return spark.read.parquet(path)


PADDED = "concat('  ', p_name, ' ')"


@query(
    "norm_trim_strings",
    "SELECT p_partkey, p_name, trim(p_brand) AS p_brand, trim(p_type) AS p_type, p_size, p_retailprice FROM part",
)
def norm_trim_strings(spark, folder):
    part = tables.read_table(spark, folder, "part")
    return normalize.trim_strings(part.withColumn("p_name", F.expr(PADDED)))


@query("norm_rename_key", "SELECT p_partkey AS id, * EXCLUDE (p_partkey) FROM part")
def norm_rename_key(spark, folder):
    return normalize.rename_key(tables.read_table(spark, folder, "part"), "p_partkey")


@query("snippet", "SELECT doc_id, substr(text, 1, 100) AS snippet FROM documents")
def text_snippet(spark, folder):
    docs = tables.read_table(spark, folder, "documents")
    return docs.select("doc_id", snippet(F.col("text")).alias("snippet"))


# --- checks --------------------------------------------------------------------------------------


@query(
    "validate_pk",
    """WITH k AS (SELECT l_orderkey AS key, count(*) AS n FROM lineitem GROUP BY l_orderkey)
    SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(key) AS n_distinct,
           CAST(coalesce(sum(n) FILTER (key IS NULL), 0) AS BIGINT) AS n_null,
           CAST(coalesce(sum(n - 1) FILTER (key IS NOT NULL), 0) AS BIGINT) AS n_repeated,
           coalesce(sum(n) FILTER (key IS NULL), 0) = 0 AND max(n) = 1 AS is_key
    FROM k""",
)
def validate_pk(spark, folder):
    return validate.check_key(tables.read_table(spark, folder, "lineitem"), "l_orderkey")


@query(
    "validate_contiguous",
    """SELECT count(*) AS n_rows, count(DISTINCT doc_id) AS n_distinct, min(doc_id) AS min_id, max(doc_id) AS max_id,
       min(doc_id) = 0 AND max(doc_id) = count(*) - 1 AND count(DISTINCT doc_id) = count(*) AS is_contiguous
    FROM documents""",
)
def validate_contiguous(spark, folder):
    return validate.check_contiguous(tables.read_table(spark, folder, "documents"), "doc_id")


@query(
    "validate_domain",
    b.ctes(b.ITEMS_CTE)
    + """SELECT doc_id, CASE WHEN variety IN (SELECT variety FROM src_class) THEN variety END AS variety,
       variety IS NOT NULL AND variety NOT IN (SELECT variety FROM src_class) AS violates FROM items""",
)
def validate_domain(spark, folder):
    docs = b.documents_as_items(spark, folder)
    known = b.source_classes(filters.value_domain(docs, "variety")).select("variety")
    return validate.enforce_domain(docs, "variety", known)


@query(
    "profile_nulls",
    b.ctes(b.ITEMS_CTE)
    + "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null FROM items"
        for c in ("doc_id", "description", "country", "variety", "color", "price", "points", "embedding")
    )
    + ") WHERE n_null > 0",
)
def profile_nulls(spark, folder):
    return validate.null_profile(b.items(spark, folder))


# --- filters -------------------------------------------------------------------------------------

RECORD = {"country": "en", "variety": "", "color": None, "price_min": 0.0, "points_max": 5000.0, "_source": "rules"}
ITEM_FIELDS = ["doc_id", "country", "variety", "color", "price", "points"]


@query(
    "filter_dynamic",
    b.ctes(b.ITEMS_CTE)
    + f"SELECT {', '.join(ITEM_FIELDS)} FROM items WHERE country = 'en' AND price >= 0 AND points <= 5000",
)
def filter_dynamic(spark, folder):
    return filters.apply(b.catalogue(spark, folder).items, RECORD).select(*ITEM_FIELDS)


@query(
    "filter_eligible_ids",
    b.ctes(b.ITEMS_CTE) + "SELECT doc_id FROM items WHERE color = 'red' AND points >= 500",
)
def filter_eligible_ids(spark, folder):
    return filters.apply(b.catalogue(spark, folder).items, {"color": "red", "points_min": 500}).select("doc_id")


COUNTS_SQL = b.ctes(*b.ITEMS_AND_QUERIES, b.ELIGIBLE_CTE)


@query(
    "filter_dynamic_batch",
    COUNTS_SQL
    + """SELECT q.query_id, count(e.doc_id) AS eligible, min(e.doc_id) AS min_id, max(e.doc_id) AS max_id
    FROM queries q LEFT JOIN elig e USING (query_id) GROUP BY q.query_id""",
)
def filter_dynamic_batch(spark, folder):
    return filters.match_counts(b.catalogue(spark, folder).items, b.queries(spark, folder))


@query(
    "filter_eligible_count",
    COUNTS_SQL
    + """SELECT q.query_id, count(e.doc_id) AS eligible,
       round(count(e.doc_id) / (SELECT count(*) FROM items), 9) AS selectivity
    FROM queries q LEFT JOIN elig e USING (query_id) GROUP BY q.query_id""",
)
def filter_eligible_count(spark, folder):
    catalogue = b.catalogue(spark, folder)
    counts = filters.match_counts(catalogue.items, b.queries(spark, folder))
    return filters.with_selectivity(counts, catalogue.n_docs).select("query_id", "eligible", "selectivity")


@query("filter_facet_eq", "SELECT doc_id, lang, source, n_chars FROM documents WHERE lang = 'fr' AND source = 'src3'")
def filter_facet_eq(spark, folder):
    docs = tables.read_table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    return docs.where((F.col("lang") == "fr") & (F.col("source") == "src3"))


@query(
    "filter_range_nullable",
    b.ctes(b.ITEMS_CTE)
    + "SELECT doc_id, price, points FROM items WHERE price >= 0 AND price <= 1 AND points >= 100 AND points <= 20000",
)
def filter_range_nullable(spark, folder):
    record = {"price_min": 0, "price_max": 1, "points_min": 100, "points_max": 20000}
    return filters.apply(b.catalogue(spark, folder).items, record).select("doc_id", "price", "points")


@query(
    "filter_topk_structured",
    b.ctes(b.ITEMS_CTE)
    + """SELECT doc_id, points, price FROM items WHERE country = 'en' AND points >= 90 AND price < 1
    ORDER BY points DESC, doc_id LIMIT 5""",
)
def filter_topk_structured(spark, folder):
    """Structured top-k report with a strict upper bound."""
    found = b.catalogue(spark, folder).items.where(
        (F.col("country") == "en") & (F.col("points") >= 90) & (F.col("price") < 1)
    )
    return found.orderBy(F.desc("points"), "doc_id").limit(5).select("doc_id", "points", "price")


@query(
    "lookup_by_id",
    "SELECT b.item_id, d.lang, d.source, d.n_chars FROM benchmark b JOIN documents d ON d.doc_id = b.item_id",
)
def lookup_by_id(spark, folder):
    wanted = tables.read_table(spark, folder, "benchmark").select(F.col("item_id").alias("doc_id"))
    docs = tables.read_table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    return lookup_join(docs, wanted, ["doc_id"]).withColumnRenamed("doc_id", "item_id")


@query(
    "filter_in_list",
    "SELECT doc_id, lang, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)",
)
def filter_in_list(spark, folder):
    ids = tables.read_table(spark, folder, "labels").where("toxic = 1").select("doc_id").distinct()
    docs = tables.read_table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    return lookup_join(docs, ids, ["doc_id"], "left_semi")


# --- aggregates ----------------------------------------------------------------------------------


@query(
    "color_distribution",
    b.ctes(b.ITEMS_CTE) + "SELECT color, count(*) AS n FROM items GROUP BY color ORDER BY n DESC",
)
def color_distribution(spark, folder):
    return b.items(spark, folder).groupBy("color").agg(F.count("*").alias("n")).orderBy(F.desc("n"))


@query("domain_values", "SELECT DISTINCT source FROM documents WHERE source IS NOT NULL ORDER BY source")
def domain_values(spark, folder):
    docs = tables.read_table(spark, folder, "documents")
    return filters.value_domain(docs, "source").orderBy("source")


@query(
    "domain_top_n",
    """SELECT p_name, n, CAST(row_number() OVER (ORDER BY n DESC, p_name) AS INTEGER) AS freq_rank
    FROM (SELECT p_name, count(*) AS n FROM part WHERE p_name IS NOT NULL GROUP BY p_name)
    QUALIFY freq_rank <= 60""",
)
def domain_top_n(spark, folder):
    return filters.top_values(tables.read_table(spark, folder, "part"), "p_name", 60)


# --- text index ----------------------------------------------------------------------------------

TEXT = b.ctes(b.ITEMS_CTE, b.POSTINGS_CTE)


@query("fts_postings", TEXT + "SELECT doc_id, term, CAST(tf AS INTEGER) AS tf FROM postings")
def fts_postings(spark, folder):
    postings = b.catalogue(spark, folder).items.select("doc_id", F.explode("postings").alias("p"))
    return postings.select("doc_id", "p.term", "p.tf")


@query("fts_term_df", TEXT + "SELECT term, df FROM term_df")
def fts_term_df(spark, folder):
    return b.catalogue(spark, folder).term_df


@query("fts_doc_len", TEXT + "SELECT doc_id, CAST(dl AS INTEGER) AS dl FROM doc_len")
def fts_doc_len(spark, folder):
    return b.catalogue(spark, folder).items.select("doc_id", "dl")


@query(
    "fts_corpus_stats",
    TEXT + "SELECT count(*) AS n_docs, round(avg(dl), 6) AS avgdl, CAST(sum(dl) AS BIGINT) AS n_tokens FROM doc_len",
)
def fts_corpus_stats(spark, folder):
    return corpus_statistics(b.catalogue(spark, folder).items).withColumn("avgdl", F.round("avgdl", 6))


# --- enrichment ----------------------------------------------------------------------------------


@query("enrich_color", b.ctes(b.ITEMS_CTE) + "SELECT doc_id, variety, color FROM items")
def enrich_color(spark, folder):
    docs = b.documents_as_items(spark, folder)
    lookup = b.source_classes(filters.value_domain(docs, "variety"))
    return enrich.enrich(docs, lookup, "variety", ["color"])


DEFAULTED = """SELECT s.variety, coalesce(c.color, 'other') AS color
    FROM (SELECT DISTINCT source AS variety FROM documents) s LEFT JOIN src_class c USING (variety)"""


@query("enrich_lookup_table", b.ctes(b.ITEMS_CTE) + DEFAULTED)
def enrich_lookup_table(spark, folder):
    docs = b.documents_as_items(spark, folder)
    path = scratch_path(spark, "lookup")
    tables.write_table(enrich.classify_values(docs, "variety", b.source_classes), path)
    return spark.read.parquet(path)


@query(
    "enrich_default_fill",
    b.ctes(b.ITEMS_CTE) + f"SELECT d.doc_id, d.source AS variety, f.color FROM documents d JOIN ({DEFAULTED}) f ON f.variety = d.source",
)
def enrich_default_fill(spark, folder):
    docs = b.documents_as_items(spark, folder)
    lookup = enrich.classify_values(docs, "variety", b.source_classes)
    return enrich.enrich(docs, lookup, "variety", ["color"])


@query(
    "enrich_missing_keys",
    b.ctes(b.ITEMS_CTE)
    + "SELECT DISTINCT source AS variety FROM documents WHERE source NOT IN (SELECT variety FROM src_class)",
)
def enrich_missing_keys(spark, folder):
    keys = filters.value_domain(b.documents_as_items(spark, folder), "variety")
    return enrich.missing_keys(keys, b.source_classes(keys), "variety")


@query(
    "enrich_batches",
    """SELECT c_name, CAST(floor((row_number() OVER (ORDER BY c_name) - 1) / 100) AS BIGINT) AS batch
    FROM (SELECT DISTINCT c_name FROM customer WHERE c_name IS NOT NULL)""",
)
def enrich_batches(spark, folder):
    return enrich.key_batches(tables.read_table(spark, folder, "customer"), "c_name")


@query(
    "enrich_spot_check",
    b.ctes(b.ITEMS_CTE)
    + """SELECT s.variety, coalesce(c.color, 'NOT FOUND') AS color
    FROM (SELECT DISTINCT source AS variety FROM documents) s LEFT JOIN src_class c USING (variety)""",
)
def enrich_spot_check(spark, folder):
    wanted = filters.value_domain(b.documents_as_items(spark, folder), "variety")
    return enrich.spot_check(b.source_classes(wanted), wanted, "variety")
