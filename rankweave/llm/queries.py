"""The operators over whole given tables, with the columns their contracts name, and SQL where it can say the same."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.llm import (
    hard_negatives,
    licenses,
    line_frequency,
    manifest,
    merkle,
    mixing,
    ngram_lm,
    ordinal,
    packing,
    prefix_join,
    simhash,
    substring_dedup,
    url_filter,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# grades: 0 toxic, 1 poor, 2 good; kept where good enough is at least as likely as this, and as a limit that
# rejects this share of held-out toxic documents
GRADES = 3
KEEP_TAIL = 0.4
TOXIC_RECALL = 0.95


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def tokenizer_path() -> str:
    """Where the public byte-level vocabulary is; ``RANKWEAVE_TOKENIZER`` names another file."""
    named = os.environ.get("RANKWEAVE_TOKENIZER")
    if named:
        return named
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scanned(table(spark, folder, "documents")).drop("spans").withColumnRenamed("id", "doc_id")


@query
def op2_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text").withColumn("held_out", ngram_lm.held_out())
    model = ngram_lm.fit(docs.where("not held_out"))
    scored = ngram_lm.score(docs, model)
    return scored.select("doc.*", "n_tokens", "n_known", F.lit(int(model.tokens)).cast("long").alias("train_tokens"), "base_score", "score", "perplexity")


@query
def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    units = mixing.copies(table(spark, folder, "documents"))
    return units.withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).select(
        F.col("id").alias("doc_id"), "source", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


@query
def op4_ordinal_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    graded = ordinal.graded_rows(docs, table(spark, folder, "labels"))
    grader, limit = ordinal.fit_with_limit(graded, GRADES, GRADES - 1, TOXIC_RECALL, KEEP_TAIL)
    scored = ordinal.scored(docs, grader, GRADES - 1, GRADES, keep=["doc_id"])
    return scored.select(
        "doc.doc_id",
        F.col("expected").alias("expected_grade"),
        F.col("tail").alias("tail_probability"),
        ordinal.selected(F.col("tail"), limit).alias("kept"),
    )


@query
def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    cut = packing.pieces(table(spark, folder, "documents"), tokenizer_path())
    slim = cut.select("id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(slim).withColumnRenamed("id", "doc_id")


@query
def op6_line_frequency(spark: SparkSession, folder: str) -> DataFrame:
    judged = line_frequency.judged(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")
    return judged.withColumn("cleaned_sha256", F.sha2(F.coalesce("cleaned", F.lit("")), 256)).drop("cleaned")


@query
def op7_merkle(spark: SparkSession, folder: str) -> DataFrame:
    made = merkle.edited(table(spark, folder, "documents"))
    return made.select(
        F.col("id").alias("doc_id"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    )


@query
def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = substring_dedup.dedup(table(spark, folder, "documents").select("doc_id", "text"))
    return cut.select("doc.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), simhash.as_hex(F.col("bits")).alias("fingerprint"), F.col("component").alias("component_id"), "n_docs"
    )


@query
def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(
        [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")],
        "host string, path string, verdict string",
    )
    return url_filter.judged(table(spark, folder, "pages"), rules).drop("words").withColumnRenamed("id", "page_id")


@query
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select("vec_id", "label", "embedding")
    moved = (F.col("label").cast("long") + 1) % 10
    return hard_negatives.hard_negatives(rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, moved).otherwise(F.col("label"))))


@query
def op12_prefix_join(spark: SparkSession, folder: str) -> DataFrame:
    found = prefix_join.components(table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.col("size").alias("n_shingles"), F.col("component").alias("component_id"), "n_copies")


@query
def op13_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.verified(table(spark, folder, "documents"))


# Windows are compared as text here, words are cut at the same white space.
ORACLES["op8_substring_dedup"] = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), win AS (
  SELECT doc_id, pos, md5(array_to_string(w[pos:pos + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS pos FROM d)
), first_doc AS (
  SELECT h, min(doc_id) AS first_id FROM win GROUP BY h
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + 50)) AS pos FROM win JOIN first_doc USING (h) WHERE first_id < doc_id
), each AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS body, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""".strip()


ORACLES["op11_hard_negatives"] = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, e.vec_id, a.label = e.label AS same, CAST(list_dot_product(a.v, e.v) AS BIGINT) AS score
  FROM e a JOIN e ON a.vec_id % 50 = 0 AND a.vec_id <> e.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 3
""".strip()

# Pairs are met by every common shingle here, components by repeated reach.
ORACLES["op12_prefix_join"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(
    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS w FROM documents
), g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS s FROM d
), size AS (
  SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id
), pair AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM g x JOIN g y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM pair JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b WHERE 100 * shared >= 90 * (p.n + q.n - shared)
), reach AS (
  SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
), copies AS (
  SELECT doc_id, count(*) OVER (PARTITION BY whole) AS n FROM (SELECT doc_id, list(s ORDER BY s) AS whole FROM g GROUP BY doc_id)
)
SELECT doc_id, coalesce(size.n, 0) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id, coalesce(copies.n, 1) AS n_copies
FROM d LEFT JOIN size USING (doc_id) LEFT JOIN copies USING (doc_id)
LEFT JOIN (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a) USING (doc_id)
""".strip()


def _manifest_sql(levels: int = 16, tree_levels: int = 6) -> str:
    """The tree level by level; ``levels`` are enough for 2**levels rows of a language."""

    def sized(value: str) -> str:
        return f"coalesce(CAST(strlen({value}) AS VARCHAR) || ':' || {value}, '-')"

    def leaf(n_chars: str) -> str:
        names = ("CAST(doc_id AS VARCHAR)", "source", "lang", n_chars, "text")
        return f"sha256({' || '.join(map(sized, names))})"

    def tree(name: str, n: int, key: str) -> list[str]:
        """Levels ``name0`` to ``name{n}`` of (key, i, c, h): c nodes on the level, numbered from 0."""
        return [
            f"{name}{k} AS (SELECT {key}, CASE WHEN c = 1 THEN i ELSE i // 2 END AS i, any_value((c + 1) // 2) AS c, "
            f"CASE WHEN any_value(c) = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h "
            f"FROM {name}{k - 1} GROUP BY {key}, CASE WHEN c = 1 THEN i ELSE i // 2 END)"
            for k in range(1, n + 1)
        ]

    def climb(name: str, n: int, before: str, key: str) -> tuple[list[str], str]:
        """Proof and folded root of ``before`` (key, i, c, proof, up) after ``n`` levels; tree and side are told from i and c."""
        steps = []
        for k in range(n):
            steps.append(
                f"{name}{k} AS (SELECT b.* REPLACE (b.i // 2 AS i, (b.c + 1) // 2 AS c, b.proof || coalesce(s.h, '') AS proof, "
                f"CASE WHEN b.c = 1 THEN b.up WHEN s.h IS NULL THEN sha256(b.up) WHEN b.i % 2 = 0 THEN sha256(b.up || s.h) "
                f"ELSE sha256(s.h || b.up) END AS up) FROM {before} b LEFT JOIN {'t' if key == 'k' else 'r'}{k} s "
                f"ON b.c > 1 AND s.{key} = b.{key} AND s.i = xor(b.i, 1))"
            )
            before = f"{name}{k}"
        return steps, before

    bits = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    octets = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))"
    crc = f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {octets}), lambda a, b: {bits}), 4294967295)"
    up, last = climb("up", levels, "start", "k")
    over, top = climb("over", tree_levels, "middle", "one")
    parts = [
        f"leaves AS (SELECT doc_id, coalesce('1' || lang, '0') AS k, {leaf('CAST(n_chars AS VARCHAR)')} AS h, "
        f"CASE WHEN {crc} % 7 = 0 THEN {leaf('CAST(n_chars + 1 AS VARCHAR)')} ELSE {leaf('CAST(n_chars AS VARCHAR)')} END AS shown FROM documents)",
        "numbered AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY k) AS c FROM leaves)",
        "t0 AS (SELECT k, i, c, h FROM numbered)",
        *tree("t", levels, "k"),
        f"sub AS (SELECT 1 AS one, k, h, row_number() OVER (ORDER BY k) - 1 AS i, count(*) OVER () AS c FROM t{levels})",
        "r0 AS (SELECT one, i, c, h FROM sub)",
        *tree("r", tree_levels, "one"),
        "start AS (SELECT doc_id, k, i, c, h AS leaf, '' AS proof, shown AS up FROM numbered)",
        *up,
        f"middle AS (SELECT u.* REPLACE (s.i AS i, s.c AS c), s.h AS subroot, 1 AS one FROM {last} u JOIN sub s USING (k))",
        *over,
    ]
    return (
        f"WITH {', '.join(parts)} SELECT doc_id, leaf, subroot, root.h AS root, sha256(proof) AS proof_sha256, up AS folded_root, "
        f"up = root.h AS verified FROM {top}, (SELECT h FROM r{tree_levels}) root"
    )


ORACLES["op13_manifest"] = _manifest_sql()
