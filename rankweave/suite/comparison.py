"""Evaluation: stage divergence, recall, parameter sweep, extraction agreement."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankweave.operators import evaluate, nearest, understand
from rankweave.operators.filters import match_counts, with_selectivity
from rankweave.plans import search
from rankweave.session import cut_lineage
from rankweave.sources.tables import read_table
from rankweave.suite import bindings as b
from rankweave.suite.registry import query
from rankweave.suite.understanding import REFERENCE_CTE

DEPTHS = {"candidates": 100, "fused": 50, "final": 10}

VARIANTS = (
    *b.SEARCHED,
    b.sql_centroids("label", "ivf"),
    b.sql_top("ivf_scores", 100, "avec", f"{b.IN_ELIGIBLE} AND probe <= 2"),
    b.sql_fuse({"kw": "0", "avec": "1"}, "afused"),
    b.sql_rerank("afused", "areranked"),
    """staged AS (
  SELECT 'candidates' AS stage, 1 AS e, query_id, doc_id, rank FROM vec
  UNION ALL SELECT 'candidates', 0, query_id, doc_id, rank FROM avec
  UNION ALL SELECT 'fused', 1, query_id, doc_id, rank FROM fused WHERE rank <= 50
  UNION ALL SELECT 'fused', 0, query_id, doc_id, rank FROM afused WHERE rank <= 50
  UNION ALL SELECT 'final', 1, query_id, doc_id, rank FROM reranked WHERE rank <= 10
  UNION ALL SELECT 'final', 0, query_id, doc_id, rank FROM areranked WHERE rank <= 10
),
divergence AS (
  SELECT q.query_id, s.stage, count(x.doc_id) FILTER (x.e = 1) AS n_exact, count(x.doc_id) FILTER (x.e = 0) AS n_approximate,
         (SELECT count(*) FROM staged m JOIN staged n USING (stage, query_id, doc_id)
          WHERE m.e = 1 AND n.e = 0 AND m.query_id = q.query_id AND m.stage = s.stage) AS n_common,
         coalesce(min(x.doc_id) FILTER (x.e = 1 AND x.rank = 1) = min(x.doc_id) FILTER (x.e = 0 AND x.rank = 1), false) AS top1_same
  FROM queries q CROSS JOIN (VALUES ('candidates'), ('fused'), ('final')) AS s(stage)
  LEFT JOIN staged x ON x.query_id = q.query_id AND x.stage = s.stage
  GROUP BY q.query_id, s.stage
),
diverged AS (
  SELECT *, CASE WHEN n_exact = 0 THEN 1.0::DOUBLE ELSE n_common / n_exact END AS overlap FROM divergence
)""",
)
DIVERGED = b.ctes(*VARIANTS)


def _diverged(spark, folder):
    queries = b.queries(spark, folder)
    ranked = search.compare_variants(b.exact_plan(spark, folder), b.approximate_plan(spark, folder), queries)
    return evaluate.stage_divergence(evaluate.cut_stages(ranked, DEPTHS), queries)


@query(
    "eval_stage_divergence",
    DIVERGED + "SELECT query_id, stage, n_exact, n_approximate, n_common, top1_same, overlap FROM diverged",
)
def eval_stage_divergence(spark, folder):
    return _diverged(spark, folder)


@query(
    "eval_aggregate",
    DIVERGED
    + """SELECT stage, round(avg(overlap), 9) AS mean, min(overlap) AS min, count(*) FILTER (overlap = 1.0) AS perfect, count(*) AS n
    FROM diverged GROUP BY stage""",
)
def eval_aggregate(spark, folder):
    return evaluate.summarize(_diverged(spark, folder), "stage", "overlap")


@query("eval_top1_same", DIVERGED + "SELECT query_id, top1_same FROM diverged WHERE stage = 'final'")
def eval_top1_same(spark, folder):
    return _diverged(spark, folder).where("stage = 'final'").select("query_id", "top1_same")


@query(
    "eval_by_selectivity",
    DIVERGED
    + """, share AS (SELECT query_id, count(*) / (SELECT count(*) FROM items) AS s FROM elig GROUP BY query_id),
    sized AS (SELECT d.overlap, coalesce(s.s, 0) AS s FROM diverged d LEFT JOIN share s USING (query_id) WHERE d.stage = 'final')
    SELECT CASE WHEN s < 0.02 THEN 'narrow' WHEN s < 0.2 THEN 'mid' ELSE 'broad' END AS bucket,
           round(avg(overlap), 9) AS mean, count(*) AS n FROM sized GROUP BY bucket""".replace("\n    ", "\n"),
)
def eval_by_selectivity(spark, folder):
    """Ranges are shares of the corpus, since the tables come in several sizes."""
    catalogue = b.catalogue(spark, folder)
    counts = with_selectivity(match_counts(catalogue.items, b.queries(spark, folder)), catalogue.n_docs)
    final = _diverged(spark, folder).where("stage = 'final'").join(counts, "query_id")
    ranges = [("narrow", 0.0, 0.02), ("mid", 0.02, 0.2), ("broad", 0.2, 2.0)]
    return evaluate.by_range(final, "selectivity", "overlap", ranges)


@query(
    "eval_overlap",
    b.ctes(*b.HYBRID)
    + """SELECT q.query_id, count(k.doc_id) AS n_a, (SELECT count(*) FROM vec v WHERE v.query_id = q.query_id) AS n_b,
       count(v.doc_id) AS n_common,
       CASE WHEN count(k.doc_id) = 0 THEN 1.0::DOUBLE ELSE count(v.doc_id) / count(k.doc_id) END AS overlap
    FROM queries q LEFT JOIN kw k USING (query_id) LEFT JOIN vec v ON v.query_id = k.query_id AND v.doc_id = k.doc_id
    GROUP BY q.query_id""",
)
def eval_overlap(spark, folder):
    """How much of the keyword list the vector list also holds."""
    queries = b.queries(spark, folder)
    lists = search.hybrid_candidates(b.exact_plan(spark, folder), queries)
    tagged = cut_lineage(lists, "candidates")
    return evaluate.overlap(tagged.where("list_ix = 0"), tagged.where("list_ix = 1"), queries)


# --- recall of the index -------------------------------------------------------------------------

SAMPLE_CTE = """sample AS (
  SELECT vec_id AS query_id, embedding AS qv FROM embeddings ORDER BY md5('7:' || vec_id), vec_id LIMIT 50
)"""


def _sample(spark, folder):
    """50 vectors in the order of a seeded hash of their id: the same ones however the data is laid out."""
    vectors = read_table(spark, folder, "embeddings")
    order = F.md5(F.concat(F.lit("7:"), F.col("vec_id").cast("string")))
    return vectors.orderBy(order, "vec_id").limit(50).select(
        F.col("vec_id").alias("query_id"), F.col("embedding").alias("qv")
    )


@query("sample_seeded", b.ctes(SAMPLE_CTE) + "SELECT query_id FROM sample")
def sample_seeded(spark, folder):
    return _sample(spark, folder).select("query_id")


_SAMPLED = b.ctes(
    b.ITEMS_CTE,
    SAMPLE_CTE,
    b.VECTOR_CTE.replace("FROM queries q", "FROM sample q"),
    b.sql_centroids("label", "ivf").replace("FROM queries,", "FROM sample,"),
    b.sql_top("vec_scores", 10, "best"),
    b.sql_top("ivf_scores", 10, "found", "WHERE probe <= 2"),
)


@query(
    "ann_recall",
    _SAMPLED
    + """SELECT s.query_id, count(x.doc_id) AS n_expected, count(f.doc_id) AS n_found,
       CASE WHEN count(x.doc_id) = 0 THEN 1.0::DOUBLE ELSE count(f.doc_id) / count(x.doc_id) END AS recall
    FROM sample s LEFT JOIN best x USING (query_id) LEFT JOIN found f ON f.query_id = x.query_id AND f.doc_id = x.doc_id
    GROUP BY s.query_id""",
)
def ann_recall(spark, folder):
    """Recall of the index's first 10 against the exact first 10, corpus vectors as queries."""
    queries = cut_lineage(_sample(spark, folder), "sample")
    exact = nearest.vector_top_k(b.catalogue(spark, folder).items, queries, 10, filtered=False)
    found = nearest.ann_top_k(b.inverted_file(spark, folder), queries, 10, 2, filtered=False)
    compared = evaluate.overlap(exact, found, queries)
    return compared.select(
        "query_id", F.col("n_a").alias("n_expected"), F.col("n_common").alias("n_found"), F.col("overlap").alias("recall")
    )


# Build grid (how embeddings are grouped into lists) and search grid (lists visited).
BUILDS = {10: "label", 5: "CAST(floor(label / 2) AS INT)"}
PROBES = (1, 2, 4)


def _sweep_sql() -> tuple[str, ...]:
    parts, unions = [*b.ITEMS_AND_QUERIES, b.ELIGIBLE_CTE, b.VECTOR_CTE, b.VEC_CTE], []
    for n_lists, group in BUILDS.items():
        parts.append(b.sql_centroids(group, f"b{n_lists}"))
        for nprobe in PROBES:
            name = f"f{n_lists}_{nprobe}"
            parts.append(b.sql_top(f"b{n_lists}_scores", 100, name, f"{b.IN_ELIGIBLE} AND probe <= {nprobe}"))
            unions.append(
                f"""SELECT {n_lists} AS n_lists, {nprobe} AS nprobe, q.query_id,
        CASE WHEN count(v.doc_id) = 0 THEN 1.0::DOUBLE ELSE count(f.doc_id) / count(v.doc_id) END AS recall
      FROM queries q LEFT JOIN vec v USING (query_id) LEFT JOIN {name} f ON f.query_id = v.query_id AND f.doc_id = v.doc_id
      GROUP BY q.query_id"""
            )
    parts.append("recalls AS (" + "\nUNION ALL\n".join(unions) + ")")
    parts.append(
        """swept AS (SELECT n_lists, nprobe, round(avg(recall), 9) AS mean, min(recall) AS min,
         count(*) FILTER (recall = 0.0) AS zeros, count(*) AS n_queries FROM recalls GROUP BY n_lists, nprobe)"""
    )
    return tuple(parts)


SWEPT = b.ctes(*_sweep_sql())


def _swept(spark, folder):
    """Recall of every (build, search) setting against the exact lists.

    The search grid becomes more queries in the same pass: each query is repeated per setting with its own
    number of lists to visit, so a build is scanned once for all its settings.
    """
    queries = b.queries(spark, folder)
    exact = cut_lineage(
        nearest.vector_top_k(b.catalogue(spark, folder).items, queries, 100).select("query_id", "doc_id"), "exact"
    )
    grid = F.posexplode(F.array(*[F.lit(p) for p in PROBES])).alias("_ix", "nprobe")
    width = len(PROBES)
    settings = queries.select("*", grid).withColumn("query_id", F.col("query_id") * width + F.col("_ix"))
    out = None
    for n_lists, group in BUILDS.items():
        found = nearest.ann_top_k(b.inverted_file(spark, folder, group), settings, 100, "nprobe")
        # the exact list of a query, once per setting
        repeated = exact.select("query_id", "doc_id", F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("_ix"))
        expected = repeated.select((F.col("query_id") * width + F.col("_ix")).alias("query_id"), "doc_id")
        recalls = evaluate.overlap(expected, found, settings).select(
            F.lit(n_lists).alias("n_lists"),
            F.element_at(F.array(*[F.lit(p) for p in PROBES]), (F.col("query_id") % width + 1).cast("int")).alias("nprobe"),
            F.col("overlap").alias("recall"),
        )
        out = recalls if out is None else out.unionByName(recalls)
    return evaluate.config_summary(out, ["n_lists", "nprobe"])


@query("ann_sweep", SWEPT + "SELECT * FROM swept")
def ann_sweep(spark, folder):
    return _swept(spark, folder)


@query(
    "eval_best_config",
    SWEPT
    + """SELECT n_lists, nprobe, mean, (SELECT mean FROM swept WHERE n_lists = 10 AND nprobe = 1) AS baseline_mean
    FROM swept ORDER BY mean DESC, n_lists, nprobe LIMIT 1""",
)
def eval_best_config(spark, folder):
    return evaluate.best_config(_swept(spark, folder), ["n_lists", "nprobe"], {"n_lists": 10, "nprobe": 1})


# --- extraction agreement ------------------------------------------------------------------------

_PAIRS = " UNION ALL ".join(
    f"SELECT query_id, '{c}' AS field, CAST(r.{c} AS VARCHAR) AS a, CAST(e.{c} AS VARCHAR) AS b FROM ref r JOIN ext e USING (query_id)"
    for c in b.FILTER_RULES
)
OUTCOMES = (
    *b.EXTRACTED_CTES,
    REFERENCE_CTE,
    f"pairs AS ({_PAIRS})",
    """outcomes AS (SELECT *, CASE WHEN a IS NULL AND b IS NULL THEN 'both_none' WHEN a = b THEN 'agree'
     WHEN b IS NULL THEN 'missed' WHEN a IS NULL THEN 'spurious' ELSE 'differ' END AS outcome FROM pairs)""",
)
COUNTED = ", ".join(f"count(*) FILTER (outcome = '{o}') AS {o}" for o in evaluate.OUTCOMES)


def _outcomes(spark, folder):
    rules = understand.extract_by_rules(b.part_queries(spark, folder), b.part_vocabulary(spark, folder))
    return evaluate.field_outcomes(b.part_reference(spark, folder), rules)


@query("eval_field_agreement", b.ctes(*OUTCOMES) + f"SELECT field, {COUNTED} FROM outcomes GROUP BY field")
def eval_field_agreement(spark, folder):
    return evaluate.field_agreement(_outcomes(spark, folder))


@query(
    "eval_agreement_totals",
    b.ctes(*OUTCOMES)
    + f"""SELECT {COUNTED},
       (SELECT count(*) FROM (SELECT query_id FROM outcomes GROUP BY query_id
          HAVING count(*) FILTER (outcome IN ('missed', 'spurious', 'differ')) = 0)) AS identical_queries,
       count(DISTINCT query_id) AS n_queries,
       count(*) FILTER (outcome IN ('agree', 'missed', 'differ')) AS set_by_reference,
       round(count(*) FILTER (outcome = 'agree') / count(*) FILTER (outcome IN ('agree', 'missed', 'differ')), 9) AS matched_share
    FROM outcomes""",
)
def eval_agreement_totals(spark, folder):
    return evaluate.agreement_totals(_outcomes(spark, folder))


@query(
    "eval_disagreements",
    b.ctes(*OUTCOMES)
    + """SELECT query_id, string_agg(issue, '; ' ORDER BY issue) AS issues, count(*) AS n_issues FROM (
      SELECT query_id, CASE outcome WHEN 'missed' THEN 'missed ' || field || '=' || a
        WHEN 'spurious' THEN 'spurious ' || field || '=' || b
        WHEN 'differ' THEN field || ': expected=' || a || ' actual=' || b END AS issue FROM outcomes
    ) WHERE issue IS NOT NULL GROUP BY query_id""",
)
def eval_disagreements(spark, folder):
    return evaluate.disagreements(_outcomes(spark, folder))


@query(
    "eval_failures",
    b.ctes(*OUTCOMES)
    + r""", runs AS (SELECT query_id, CASE WHEN trim(query) = '' THEN 'failed' ELSE 'ok' END AS status FROM pq)
    SELECT (SELECT count(*) FROM runs) AS n_runs, (SELECT count(*) FROM runs WHERE status = 'ok') AS completed,
       (SELECT count(*) FROM runs WHERE status <> 'ok') AS failed,
       count(*) FILTER (outcome = 'agree') AS agree,
       count(*) FILTER (outcome IN ('agree', 'missed', 'differ')) AS set_by_reference
    FROM outcomes JOIN runs USING (query_id) WHERE status = 'ok'""",
)
def eval_failures(spark, folder):
    """A backend that fails on blank queries: failures are counted apart and stay out of the rates."""
    runs = b.part_queries(spark, folder).select(
        "query_id", F.when(F.trim("query") == "", "failed").otherwise("ok").alias("status")
    )
    return evaluate.failure_summary(runs, _outcomes(spark, folder))


@query(
    "eval_numeric_summary",
    """SELECT round(avg(value), 9) AS mean, round(median(value), 6) AS median, max(value) AS max, count(value) AS n
    FROM events WHERE value IS NOT NULL""",
)
def eval_numeric_summary(spark, folder):
    return evaluate.numeric_summary(read_table(spark, folder, "events"), "value")
