"""From raw documents to packed sequences: each stage's rows are written and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.llm import mixing, ordinal, packing, simhash, substring_dedup, wide_simhash
from rankweave.llm.queries import GRADES, KEEP_TAIL, TOXIC_RECALL, table, tokenizer_path
from rankweave.session import cut_lineage

# No SQL expresses the trained classifier or the random rounding; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the best grade is high enough, by a limit that rejects most held-out toxic ones."""
    graded = ordinal.graded_rows(docs, table(spark, sf_dir, "labels"))
    grader, limit = ordinal.fit_with_limit(graded, GRADES, GRADES - 1, TOXIC_RECALL, KEEP_TAIL)
    scored = ordinal.scored(docs, grader, GRADES - 1, GRADES)
    return scored.where(ordinal.selected(F.col("tail"), limit)).select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, the one with the smallest id.

    Five-word shingles at a similarity of 0.8, which takes fingerprints of more than 64 bits.
    """
    found = cut_lineage(wide_simhash.near_duplicates(docs), "found")
    return simhash.first_rows(docs, found)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of earlier documents; a document that was nothing else goes."""
    cut = substring_dedup.dedup(docs)
    text = F.when(F.col("n_removed") == 0, F.col("doc.text")).otherwise(F.col("kept"))
    changed = F.col("doc").withField("text", text).withField("n_chars", F.length(text).cast("long"))
    return cut.where("n_removed = 0 or n_removed < n_words").select(changed.alias("doc")).select("doc.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's share takes it."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with the sequence and the place each one has in it."""
    cut = packing.pieces(docs, tokenizer_path())
    slim = cut.select("id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(slim).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality classifier", quality),
    ("simhash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("mixing", mix),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut_lineage(docs, "stage")
    return docs
