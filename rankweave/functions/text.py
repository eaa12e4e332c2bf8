"""Text expressions. All of them stay on the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: anything that is neither letter nor digit separates tokens.
TOKEN_SEPARATOR = r"[^\p{L}\p{N}]+"
# Fixed value: characters that do not continue a word.
NON_WORD = r"[^\p{L}\p{N}_]"


def tokens(text: Column) -> Column:
    """Lower-cased letter and digit runs; NULL text has no tokens."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), TOKEN_SEPARATOR)
    return F.filter(parts, lambda t: t != "")


def with_term_counts(df: DataFrame, text: str, out: str = "postings") -> DataFrame:
    """Add ``out: array<struct<term, tf>>`` and ``dl`` (token count) to each row.

    Counting runs inside the row: sort the tokens, note where neighbours differ, take the distances. No
    explode and no shuffle, so a corpus is indexed by a map-only stage, and a document of any length is
    handled whole. Lambdas see only their own arguments, so the work stays linear even where the optimizer
    repeats an expression below a filter.
    """
    sorted_, edges = F.col("_sorted"), F.col("_edges")
    shifted = F.concat(F.array(F.lit(None).cast("string")), sorted_)
    # one longer than the tokens: the end of the last run is an edge as well
    changes = F.zip_with(sorted_, shifted, lambda here, before: ~here.eqNullSafe(before))
    positions = F.filter(F.transform(changes, lambda new, i: F.when(new, i)), lambda i: i.isNotNull())
    runs = F.greatest(F.size(edges) - 1, F.lit(0))
    lengths = F.zip_with(
        F.slice(edges, F.lit(1), runs), F.slice(edges, F.lit(2), runs), lambda begin, end: end - begin
    )
    postings = F.zip_with(
        F.array_distinct(sorted_), lengths, lambda term, tf: F.struct(term.alias("term"), tf.alias("tf"))
    )
    return (
        df.withColumn("_sorted", F.sort_array(tokens(F.col(text))))
        .withColumn("_edges", positions)
        .withColumn("dl", F.size(sorted_))
        .withColumn(out, postings)
        .drop("_sorted", "_edges")
    )


def whole_word(text: Column, literal: Column) -> Column:
    """True where ``literal`` occurs in ``text`` with no word character directly beside it."""
    pattern = F.concat(
        F.lit(f"(^|{NON_WORD})\\Q"), literal, F.lit(f"\\E($|{NON_WORD})")
    )
    return F.rlike(text, pattern)


# White space as Unicode has it, in a form that Java and RE2 both read.
SPACES = r"[\s\x0B\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def strip(text: Column) -> Column:
    """Remove white space of every kind at both ends."""
    return F.regexp_replace(text, f"^{SPACES}+|{SPACES}+$", "")


def normalized_key(text: Column) -> Column:
    """Lower case with runs of white space collapsed: the identity of a repeated query."""
    return strip(F.regexp_replace(F.lower(text), f"{SPACES}+", " "))


def snippet(text: Column, length: int = 100) -> Column:
    return F.substring(text, 1, length)
