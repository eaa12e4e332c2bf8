"""Quality rules from how many documents of a host share a line, with Spark functions only.

Lines are split at line feeds and normalised: lower case, runs of digits as 0, runs of white space as one
space, ends trimmed. Each document counts once per distinct line of any length that is not blank. A line is
boilerplate where more than ``max_share`` of its host's documents hold it, which must be more than ``max_docs``:
the share decides, and the few documents only keep a line of a small host from counting as shared by chance. Boilerplate lines are removed and the other lines keep their order (``cleaned``); a
document is rejected as depleted where less than ``min_left`` of its words remain, or fewer than the ``MIN_WORDS`` that
every document needs.

Only (host, line hash) pairs are shuffled, never lines. Counts are added up before the shuffle, so a line in
a third of all documents is one row per task. Boilerplate comes back to documents as one list of line hashes per
host, which the share bounds: at 2 %, to 50 times the lines of the host's average document. Lists are broadcast only
if counted to be small; otherwise texts are shuffled once, each host split over salts.

Base rules per document are counted inside its row. A 3-word window counts as repeated where its hash is
found again in the same text; hash and position share 64 bits, so for 20,000 words 49 bits tell windows apart.

Null and empty texts have no words or lines and fail the base rules. A null host is a host. Repeated rows count as
documents of their own in line counts, since only their ids could tell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.plans.bounds import lookup_join

SPACES = r"[\x20\x09-\x0D]+"
MIN_WORDS = 50
MAX_REPEATED = 50
MAX_DOCS = 3
MAX_SHARE = 0.02
MIN_LEFT = 0.3


def split_words(text: Column) -> Column:
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def shifted(values: Column, by: int) -> Column:
    """Elements from ``by`` on."""
    return F.slice(values, F.lit(by + 1), F.greatest(F.size(values) - F.lit(by), F.lit(0)))


def counted(docs: DataFrame, text: str) -> DataFrame:
    """Base measures of each text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    Each step is a projection of its own, so that no array is worked out twice.
    """
    keep = docs.columns
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = docs.select(
        *keep,
        F.transform(split_words(whole), lambda w: F.xxhash64(w)).alias("_words"),
        lines.alias("_lines"),
        F.length(F.regexp_replace(whole, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(whole) - F.length(F.regexp_replace(whole, "[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
    )
    measures = ["word_chars", "n_symbols", "n_words", "n_dup_lines"]
    window = F.zip_with(
        F.zip_with("_words", shifted(F.col("_words"), 1), lambda a, b: F.xxhash64(a, b)),
        shifted(F.col("_words"), 2),
        lambda a, b: F.when(b.isNotNull(), F.xxhash64(a, b)),
    )
    df = df.select(
        *keep,
        "word_chars",
        "n_symbols",
        F.size("_words").cast("long").alias("n_words"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.slice(window, F.lit(1), F.greatest(F.size("_words") - 2, F.lit(0))).alias("_windows"),
        F.ceil(F.log2(F.size("_words").cast("double") + 2)).cast("int").alias("_bits"),
    )
    # hash above, position below: sorting brings equal windows together
    placed = F.transform(
        F.arrays_zip(
            F.col("_windows").alias("h"), F.array_repeat("_bits", F.size("_windows")).alias("b")
        ),
        lambda x, i: F.call_function("shiftleft", x["h"], x["b"]).bitwiseOR(i.cast("long")),
    )
    df = df.select(*keep, *measures, "_bits", F.sort_array(placed).alias("_placed"))
    high = F.transform(
        F.arrays_zip(F.col("_placed").alias("p"), F.array_repeat("_bits", F.size("_placed")).alias("b")),
        lambda x: F.call_function("shiftright", x["p"], x["b"]),
    )
    df = df.select(*keep, *measures, "_bits", "_placed", high.alias("_high"))
    # equal to the one before or after
    again = F.zip_with(
        F.zip_with(F.col("_high"), F.concat(F.array(F.lit(None).cast("long")), F.col("_high")), lambda a, b: F.struct(a.alias("h"), (a == b).alias("e"))),
        shifted(F.col("_high"), 1),
        lambda a, b: F.coalesce(a["e"], F.lit(False)) | F.coalesce(a["h"] == b, F.lit(False)),
    )
    found = F.filter(
        F.zip_with("_placed", F.slice(again, F.lit(1), F.size("_placed")), lambda p, e: F.when(e, p)), lambda p: p.isNotNull()
    )
    df = df.select(*keep, *measures, "_bits", found.alias("_found"))
    at = F.transform(
        F.arrays_zip(F.col("_found").alias("p"), F.array_repeat("_bits", F.size("_found")).alias("b")),
        lambda x: x["p"].bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), x["b"]) - 1),
    )
    df = df.select(*keep, *measures, F.sort_array(at).alias("_at"))
    # words from each repeated window on, up to the next one
    covered = F.aggregate(
        "_at",
        F.struct(F.lit(-3).cast("long").alias("last"), F.lit(0).cast("long").alias("n")),
        lambda s, p: F.struct(p.alias("last"), (s["n"] + F.least(p - s["last"], F.lit(3).cast("long"))).alias("n")),
        lambda s: s["n"],
    )
    return df.select(*keep, *measures, covered.alias("n_repeat_words"))


def line_hashes(text: Column) -> Column:
    """Hash of each normalised line in order, null where it is blank."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    plain = F.transform(
        lines, lambda x: F.trim(F.regexp_replace(F.regexp_replace(F.lower(x), "[0-9]+", "0"), SPACES, " "))
    )
    return F.transform(plain, lambda x: F.when(x != "", F.xxhash64(x)))


def boilerplate(lines: DataFrame, hosts: DataFrame, max_docs: int, max_share: float) -> DataFrame:
    """(host, line) pairs held by too many of the host's documents; hosts are (host, n_docs)."""
    held = lines.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") > max_docs)
    return lookup_join(held, hosts, ["host"]).where(F.col("n") > F.col("n_docs") * max_share).select("host", "line")


def cleaned(
    docs: DataFrame,
    id_col: str = "doc_id",
    host_col: str = "source",
    text: str = "text",
    max_docs: int = MAX_DOCS,
    max_share: float = MAX_SHARE,
) -> DataFrame:
    """(id, text, cleaned), one row per document: its text, and that without the boilerplate lines of its host.

    Null texts stay null; a text that is all boilerplate becomes empty.
    """
    host = F.coalesce(F.concat(F.lit("="), F.col(host_col).cast("string")), F.lit(""))
    slim = docs.select(F.col(id_col).alias("id"), host.alias("host"), F.col(text).alias("text"))
    once = slim.select("host", F.explode(F.array_distinct(line_hashes(F.col("text")))).alias("line")).where("line is not null")
    hosts = slim.groupBy("host").agg(F.count("*").alias("n_docs"))
    lists = boilerplate(once, hosts, max_docs, max_share).groupBy("host").agg(F.collect_list("line").alias("_common"))
    found = lookup_join(slim, lists, ["host"], "left").select("id", "text", "_common", F.when(F.col("_common").isNotNull(), line_hashes(F.col("text"))).alias("_lines"))
    # the few boilerplate lines that the text has
    gone = found.select("id", "text", "_lines", F.array_intersect("_common", "_lines").alias("_gone"))
    kept = F.filter(F.split("text", "\n"), lambda x, k: ~F.coalesce(F.array_contains("_gone", F.get("_lines", k)), F.lit(False)))
    return gone.select("id", "text", F.when(F.size("_gone") > 0, F.array_join(kept, "\n")).otherwise(F.col("text")).alias("cleaned"))


def judged(
    docs: DataFrame,
    id_col: str = "doc_id",
    host_col: str = "source",
    text: str = "text",
    max_docs: int = MAX_DOCS,
    max_share: float = MAX_SHARE,
    min_left: float = MIN_LEFT,
) -> DataFrame:
    """(id, base measures, n_words_left, base_failed, kept, cleaned), one row per document."""
    texts = cleaned(docs, id_col, host_col, text, max_docs, max_share)
    measured = counted(texts, "text")
    left = F.size(split_words(F.coalesce("cleaned", F.lit("")))).cast("long")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return measured.select(
        "id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        left.alias("n_words_left"),
        failed.alias("base_failed"),
        "cleaned",
    ).select(
        "id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_words_left", "base_failed",
        (~F.col("base_failed") & (F.col("n_words_left") >= F.greatest(min_left * F.col("n_words"), F.lit(float(MIN_WORDS))))).alias("kept"),
        "cleaned",
    )
