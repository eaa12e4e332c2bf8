"""Keyword, vector and hybrid retrieval, fusion, reranking and the whole search."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankweave.functions.text import with_term_counts
from rankweave.functions.vectors import l2_norm
from rankweave.operators import encode, fusion, nearest, rerank
from rankweave.operators.filters import FILTER_COLUMNS
from rankweave.operators.keyword import keyword_top_k
from rankweave.operators.present import FILTER_LABELS, NO_MATCH, filter_summary
from rankweave.plans import search
from rankweave.session import cut_lineage
from rankweave.sources.catalogue import open_catalogue
from rankweave.sources.tables import read_table
from rankweave.suite import bindings as b
from rankweave.suite.registry import query

RANKED = "query_id, doc_id, rank, score"


@query("bm25_topk", b.ctes(*b.KEYWORD, b.sql_top("kw_scores", 100, "best")) + f"SELECT {RANKED} FROM best")
def bm25_topk(spark, folder):
    return keyword_top_k(b.catalogue(spark, folder), b.queries(spark, folder), 100, filtered=False)


@query("catalogue_reopen", b.ctes(*b.KEYWORD, b.sql_top("kw_scores", 100, "best")) + f"SELECT {RANKED} FROM best")
def catalogue_reopen(spark, folder):
    """Keyword ranking over a catalogue opened from its folder alone."""
    opened = open_catalogue(spark, b.catalogue(spark, folder).path)
    return keyword_top_k(opened, b.queries(spark, folder), 100, filtered=False)


@query("bm25_topk_filtered", b.ctes(*b.KEYWORD, b.KW_CTE) + f"SELECT {RANKED} FROM kw")
def bm25_topk_filtered(spark, folder):
    return keyword_top_k(b.catalogue(spark, folder), b.queries(spark, folder), 100)


# --- vectors -------------------------------------------------------------------------------------

VECTORS = (*b.ITEMS_AND_QUERIES, b.ELIGIBLE_CTE, b.VECTOR_CTE)


@query(
    "vec_scan",
    """SELECT vec_id, label, len(embedding) AS dims, round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS total,
       round(sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))), 6) AS norm
    FROM embeddings""",
)
def vec_scan(spark, folder):
    """Vectors written and read back by key."""
    vectors = cut_lineage(read_table(spark, folder, "embeddings"), "vectors")
    total = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return vectors.select(
        "vec_id", "label", F.size("embedding").cast("bigint").alias("dims"),
        F.round(total, 6).alias("total"), F.round(l2_norm(F.col("embedding")), 6).alias("norm"),
    )


@query(
    "vec_l2_normalize",
    """WITH scaled AS (SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * vec_id) AS v FROM embeddings),
    unit AS (SELECT vec_id, sqrt(list_dot_product(v, v)) AS norm, v FROM scaled)
    SELECT vec_id, round(norm, 6) AS norm_before,
           CASE WHEN norm > 0 THEN round(v[1] / norm, 6) END AS first_component,
           CASE WHEN norm > 0 THEN round(list_sum(v) / norm, 6) END AS total
    FROM unit""",
)
def vec_l2_normalize(spark, folder):
    """Vectors stretched by their id, so that vector 0 is the zero vector, and brought back to length 1."""
    vectors = read_table(spark, folder, "embeddings")
    scaled = vectors.select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double") * F.col("vec_id")).alias("v")
    ).withColumn("norm_before", F.round(l2_norm(F.col("v")), 6))
    unit = nearest.normalized(scaled, "v")
    total = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x)
    return unit.select(
        "vec_id", "norm_before", F.round(F.get("v", F.lit(0)), 6).alias("first_component"), F.round(total, 6).alias("total")
    )


@query("vec_exact_topk", b.ctes(*VECTORS, b.sql_top("vec_scores", 100, "best")) + f"SELECT {RANKED} FROM best")
def vec_exact_topk(spark, folder):
    return nearest.vector_top_k(b.catalogue(spark, folder).items, b.queries(spark, folder), 100, filtered=False)


@query("vec_exact_topk_filtered", b.ctes(*VECTORS, b.VEC_CTE) + f"SELECT {RANKED} FROM vec")
def vec_exact_topk_filtered(spark, folder):
    return nearest.vector_top_k(b.catalogue(spark, folder).items, b.queries(spark, folder), 100)


@query(
    "vec_cross_scores",
    b.ctes(*b.ITEMS_AND_QUERIES)
    + """, pairs AS (SELECT query_id, list_dot_product(CAST(qv AS DOUBLE[]), CAST(embedding AS DOUBLE[])) AS s
      FROM queries, items WHERE qv IS NOT NULL AND embedding IS NOT NULL)
    SELECT query_id, count(*) AS n_scored, round(avg(s), 6) AS mean_score, round(min(s), 6) AS min_score, round(max(s), 6) AS max_score
    FROM pairs GROUP BY query_id""",
)
def vec_cross_scores(spark, folder):
    """Every query scored against every item, kept as a summary per query."""
    return nearest.score_summary(b.catalogue(spark, folder).items, b.queries(spark, folder))


@query("ivf_index_build", b.ctes(*VECTORS, b.sql_centroids("label", "ivf")) + "SELECT doc_id, list_id FROM ivf_lists")
def ivf_index_build(spark, folder):
    return b.inverted_file(spark, folder).lists.select("doc_id", "list_id")


def _ann(where: str, k: int) -> str:
    return b.ctes(*VECTORS, b.sql_centroids("label", "ivf"), b.sql_top("ivf_scores", k, "best", where)) + f"SELECT {RANKED} FROM best"


@query("ann_topk", _ann("WHERE probe <= 2", 10))
def ann_topk(spark, folder):
    return nearest.ann_top_k(b.inverted_file(spark, folder), b.queries(spark, folder), 10, 2, filtered=False)


@query("ann_topk_filtered", _ann(f"{b.IN_ELIGIBLE} AND probe <= 2", 100))
def ann_topk_filtered(spark, folder):
    return nearest.ann_top_k(b.inverted_file(spark, folder), b.queries(spark, folder), 100, 2)


@query("ivf_reopen", _ann(f"{b.IN_ELIGIBLE} AND probe <= 2", 100))
def ivf_reopen(spark, folder):
    """Vector ranking over an inverted file opened from its folder alone."""
    opened = nearest.open_inverted_file(spark, b.inverted_file(spark, folder).path)
    return nearest.ann_top_k(opened, b.queries(spark, folder), 100, 2)


# --- encoder stand-in ----------------------------------------------------------------------------


def _hashed_sql(key: str, source: str, text: str) -> str:
    return f"""WITH t AS (SELECT {key}, unnest({b.sql_tokens(text)}) AS term FROM {source}),
    c AS (
      SELECT {key}, CAST(CAST('0x' || substr(md5(term), 1, 6) AS INTEGER) % 64 AS INTEGER) AS dim, count(*) AS tf
      FROM t GROUP BY ALL
    )
    SELECT {key}, dim, round(tf / sqrt(CAST(sum(tf * tf) OVER (PARTITION BY {key}) AS DOUBLE)), 6) AS weight FROM c"""


@query("embed_hashed", _hashed_sql("doc_id", "documents", "text"))
def embed_hashed(spark, folder):
    return encode.hashed_components(b.catalogue(spark, folder).items)


PREFIXED = f"'{encode.QUERY_PREFIX}' || text"


@query("embed_query_prefixed", _hashed_sql("item_id", "benchmark", PREFIXED))
def embed_query_prefixed(spark, folder):
    texts = encode.with_query_prefix(read_table(spark, folder, "benchmark"), "text")
    return encode.hashed_components(with_term_counts(texts, "text"), "item_id")


# --- hybrid --------------------------------------------------------------------------------------


@query(
    "hybrid_candidates",
    b.ctes(*b.HYBRID)
    + """SELECT query_id, doc_id, rank, 0 AS list_ix FROM kw UNION ALL SELECT query_id, doc_id, rank, 1 FROM vec""",
)
def hybrid_candidates(spark, folder):
    return search.hybrid_candidates(b.exact_plan(spark, folder), b.queries(spark, folder))


@query(
    "rank_assign",
    """SELECT o_custkey AS query_id, o_orderkey AS doc_id, o_totalprice AS score,
       CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rank
    FROM orders""",
)
def rank_assign(spark, folder):
    orders = read_table(spark, folder, "orders")
    return fusion.assign_ranks(
        orders.select(
            F.col("o_custkey").alias("query_id"), F.col("o_orderkey").alias("doc_id"), F.col("o_totalprice").alias("score")
        )
    )


@query("rrf_fuse", b.ctes(*b.HYBRID, b.sql_fuse({"kw": "0", "vec": "1"}, "fused")) + "SELECT query_id, doc_id, rank, score FROM fused")
def rrf_fuse(spark, folder):
    queries, plan = b.queries(spark, folder), b.exact_plan(spark, folder)
    lists = search.hybrid_candidates(plan, queries)
    both = cut_lineage(lists, "candidates")
    return fusion.fuse(both.where("list_ix = 0"), both.where("list_ix = 1"))


def _searched(spark, folder):
    """Fused and reranked lists; the fused ones are written, since both reranking and the caller read them."""
    queries, plan = b.queries(spark, folder), b.exact_plan(spark, folder)
    lists = cut_lineage(search.hybrid_candidates(plan, queries), "candidates")
    fused = cut_lineage(fusion.fuse(lists.where("list_ix = 0"), lists.where("list_ix = 1")), "fused")
    return fused, rerank.rerank(fused, plan.catalogue.items, queries, n_queries=queries.count())


@query("rerank_topk", b.ctes(*b.SEARCHED) + "SELECT query_id, doc_id, rank, CAST(fused_rank AS INTEGER) AS fused_rank, score FROM reranked")
def rerank_topk(spark, folder):
    return _searched(spark, folder)[1]


@query(
    "rerank_shift",
    b.ctes(*b.SEARCHED)
    + """SELECT query_id, doc_id, f.rank AS rank_fused, r.rank AS rank_reranked
    FROM (SELECT * FROM fused WHERE rank <= 10) f
    FULL JOIN (SELECT * FROM reranked WHERE rank <= 10) r USING (query_id, doc_id)""",
)
def rerank_shift(spark, folder):
    return rerank.rank_shift(*_searched(spark, folder))


FIELDS = ["description", "country", "variety", "color", "price", "points"]


@query(
    "search_topk",
    b.ctes(*b.SEARCHED)
    + f"""SELECT r.query_id, r.doc_id, r.rank, CAST(r.fused_rank AS INTEGER) AS fused_rank, r.score, {', '.join('i.' + c for c in FIELDS)}
    FROM reranked r JOIN items i USING (doc_id) WHERE r.rank <= 10""",
)
def search_topk(spark, folder):
    return search.search(b.exact_plan(spark, folder), b.queries(spark, folder), FIELDS)


@query(
    "search_hydrate",
    b.ctes(*VECTORS, b.VEC_CTE)
    + """SELECT v.query_id, v.doc_id, v.rank, v.score, i.country, i.variety, i.color, i.price, i.points
    FROM vec v JOIN items i USING (doc_id) WHERE v.rank <= 10""",
)
def search_hydrate(spark, folder):
    catalogue, queries = b.catalogue(spark, folder), b.queries(spark, folder)
    ranked = nearest.vector_top_k(catalogue.items, queries, 100)
    return rerank.hydrate(ranked, catalogue.items, FIELDS[1:], 10, queries.count())


@query(
    "search_summary",
    b.ctes(*b.SEARCHED)
    + """SELECT q.query_id,
       (SELECT count(*) FROM kw WHERE kw.query_id = q.query_id) AS keyword_candidate_count,
       (SELECT count(*) FROM vec WHERE vec.query_id = q.query_id) AS vector_candidate_count,
       (SELECT count(*) FROM fused WHERE fused.query_id = q.query_id) AS fused_count,
       (SELECT count(*) FROM reranked WHERE reranked.query_id = q.query_id AND rank <= 10) AS result_count
    FROM queries q""",
)
def search_summary(spark, folder):
    return search.search_summary(b.exact_plan(spark, folder), b.queries(spark, folder))


@query(
    "search_cards",
    b.ctes(*b.SEARCHED)
    + f"""SELECT q.query_id, coalesce(c.cards, '{NO_MATCH}') AS cards FROM queries q LEFT JOIN (
      SELECT r.query_id, string_agg('**' || r.rank || '. ' || i.doc_id || '**' || chr(10) || '`' || i.points || '/100 '
         || {b.sql_band('i.points')} || '` · ' || concat_ws(' · ', nullif(i.variety, ''), nullif(i.color, ''), nullif(i.country, '')) || ' · '
         || CASE WHEN i.price IS NULL THEN 'price not listed' ELSE '$' || printf('%g', i.price) END
         || chr(10) || i.description, chr(10) || chr(10) ORDER BY r.rank) AS cards
      FROM reranked r JOIN items i USING (doc_id) WHERE r.rank <= 10 GROUP BY r.query_id
    ) c USING (query_id)""",
)
def search_cards(spark, folder):
    """Searched items as cards, and a sentence for queries that find nothing."""
    return search.search_cards(
        b.exact_plan(spark, folder), b.queries(spark, folder), "doc_id", ["variety", "color", "country"]
    )


ASKED = b.ctes(*b.asked_ctes())


@query(
    "search_from_text",
    ASKED
    + f"""SELECT r.query_id, r.doc_id, r.rank, CAST(r.fused_rank AS INTEGER) AS fused_rank, r.score, {', '.join('i.' + c for c in FIELDS[1:])}
    FROM reranked r JOIN items i USING (doc_id) WHERE r.rank <= 10""",
)
def search_from_text(spark, folder):
    """Raw text in, ranked items out: guard, rules, encoder, filtered retrieval, fusion, reranking."""
    plan = search.SearchPlan(b.hashed_catalogue(spark, folder))
    return search.search(plan, b.understood(spark, folder), FIELDS[1:])


@query(
    "search_interpretation",
    ASKED
    + f"""SELECT e.query_id, concat_ws(chr(10),
       coalesce(nullif(concat_ws(' · ', {', '.join(b.sql_labelled(n, lab) for n, lab in FILTER_LABELS)}), ''), 'No hard filters'),
       CASE WHEN e.query <> '' THEN 'Meaning: ' || e.query END,
       (SELECT count(*) FROM kw WHERE kw.query_id = e.query_id) || ' on keywords, '
         || (SELECT count(*) FROM vec WHERE vec.query_id = e.query_id) || ' on meaning', 'Filters extracted without the model (rules)') AS summary
    FROM ext e""",
)
def search_interpretation(spark, folder):
    """How each text was read and how much either path found."""
    queries = b.understood(spark, folder)
    counts = search.search_summary(search.SearchPlan(b.hashed_catalogue(spark, folder)), queries)
    records = queries.select("query_id", "query", *[F.col(f"f_{c}").alias(c) for c in FILTER_COLUMNS])
    summary = filter_summary(
        F.col("keyword_candidate_count"), F.col("vector_candidate_count"), F.col("query"), F.lit("rules")
    )
    return records.join(counts, "query_id").select("query_id", summary.alias("summary"))
