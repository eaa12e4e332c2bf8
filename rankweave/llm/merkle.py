"""Document fingerprints as Merkle trees over paragraphs and sections, with Spark functions only.

A paragraph is the text up to a line feed, cut further at white space behind a mark (``.,;:!?|*#$%&``), so
that long lines have more than one. Paragraph hashes are 32 bits of their SHA-256. A section is a run of paragraphs that ends behind one
whose last hash digit is 0 modulo ``SECTION``, so an edit changes the sections around it and leaves the others. A
section's hash is taken over its paragraph hashes, the root over the section hashes.

A fingerprint is text: the root's SHA-256 in hex, then per section ``|``, 16 hex digits of its hash, ``:`` and
8 hex digits per paragraph. Equal texts have equal roots; trees with different roots are compared section by
section, and only branches whose hashes differ are opened (``differing``).

The root also covers the whole text's hash, so texts that differ only in the white space between paragraphs
have different roots. Null is like empty: one empty paragraph.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.plans.ordered import running_total
from rankweave.session import cut_lineage

SECTION = 8
PARAGRAPHS = r"\n|(?<=[.,;:!?|*#$%&])[\x20\x09-\x0D]+"
LEAF = 8


def paragraph_hashes(text: Column) -> Column:
    """8 hex digits per paragraph."""
    return F.transform(F.split(text, PARAGRAPHS), lambda p: F.substring(F.sha2(p, 256), 1, LEAF))


def sections(leaves: Column) -> Column:
    """The paragraph hashes of each section as one string each.

    Hashes whose last digit ends a section get a mark behind them; the marks cut the joined string.
    """
    digits = "0123456789abcdef"[::SECTION]
    marked = F.transform(leaves, lambda h: F.when(F.substring(h, LEAF, 1).isin(*digits), F.concat(h, F.lit("|"))).otherwise(h))
    return F.filter(F.split(F.array_join(marked, ""), r"\|"), lambda s: s != "")


def with_tree(df: DataFrame, text: str) -> DataFrame:
    """Add ``fingerprint`` of the text column ``text`` (not null)."""
    keep = df.columns
    leaves = df.select(*keep, sections(paragraph_hashes(F.col(text))).alias("_sections"))
    branches = F.transform("_sections", lambda s: F.concat(F.substring(F.sha2(s, 256), 1, 16), F.lit(":"), s))
    tree = leaves.select(*keep, F.array_join(branches, "|").alias("_tree"))
    heads = F.regexp_replace("_tree", ":[0-9a-f]+", "")
    root = F.sha2(F.concat_ws("|", heads, F.sha2(F.col(text), 256)), 256)
    return tree.select(*keep, F.concat_ws("|", root, "_tree").alias("fingerprint"))


def parts(fingerprint: Column) -> Column:
    """The sections of a fingerprint as ``hash:paragraphs`` strings."""
    return F.slice(F.split(fingerprint, r"\|"), F.lit(2), F.lit(2**31 - 2))


def leaves_of(branches: Column) -> Column:
    return F.flatten(
        F.transform(branches, lambda b: F.regexp_extract_all(F.substring_index(b, ":", -1), F.lit(f"[0-9a-f]{{{LEAF}}}"), F.lit(0)))
    )


def differing(a: Column, b: Column) -> Column:
    """Paragraph hashes of ``a`` in branches that ``b`` does not have, without those ``b`` has elsewhere; none for equal roots."""
    opened = F.array_except(parts(a), parts(b))
    other = F.array_except(parts(b), parts(a))
    edits = F.array_except(leaves_of(opened), leaves_of(other))
    return F.when(F.substring_index(a, "|", 1) == F.substring_index(b, "|", 1), F.array().cast("array<string>")).otherwise(edits)


def likeness(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Add a column per pair of fingerprint columns: twice the distinct paragraphs both have, over those of each."""
    keep = df.columns
    used = sorted({c for pair in pairs.values() for c in pair})
    own = df.select(*keep, *[F.array_distinct(leaves_of(parts(F.col(c)))).alias(f"_leaves_{c}") for c in used])
    out = []
    for name, (a, b) in pairs.items():
        both = F.size(F.array_intersect(f"_leaves_{a}", f"_leaves_{b}"))
        share = 2.0 * both / (F.size(f"_leaves_{a}") + F.size(f"_leaves_{b}"))
        same = F.substring_index(a, "|", 1) == F.substring_index(b, "|", 1)
        out.append(F.when(same, F.lit(1.0)).otherwise(share).alias(name))
    return own.select(*keep, *out)


def next_documents(rows: DataFrame) -> DataFrame:
    """(key, taker, wanted): who takes the head of each distinct document, and how many code points of it.

    ``rows`` are distinct (key, n_chars), key a struct that starts with the id, null ids lowest. Each document
    gives to the one with the next higher key, the highest to the lowest. Only keys are moved.
    """
    placed = cut_lineage(running_total(rows, "key", out="_rank"), "order")
    n = placed.count()
    taker = placed.select(
        F.col("key").alias("taker"),
        F.floor(F.col("n_chars") / 3).cast("int").alias("wanted"),
        F.when(F.col("_rank") == 1, F.lit(n)).otherwise(F.col("_rank") - 1).alias("_rank"),
    )
    return cut_lineage(placed.join(taker, "_rank").select("key", "taker", "wanted"), "next")


def edited(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_chars, fingerprint, edited, edited_fingerprint, near_edited, near_next) of every document.

    The edited text has the last third of the code points replaced by as many (or all) of the first ones of the
    next document in descending (id, text hash), null ids last; the last one's next is the first. Rows that
    repeat a document are equal to it and are not its next. Texts are shuffled once by key, and the heads
    with their fingerprints once to their takers.
    """
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = base.select(
        F.struct("id", F.xxhash64("text").alias("digest")).alias("key"), "text", F.length("text").cast("long").alias("n_chars")
    )
    distinct = cut_lineage(rows.groupBy("key").agg(F.first("n_chars").alias("n_chars"), F.count("*").alias("n")), "keys")
    links = next_documents(distinct.select("key", "n_chars"))
    texts = rows.select("key", "text")  # both joins read one shuffle of these
    heads = with_tree(texts.join(links, "key").select("taker", "wanted", "text"), "text").select(
        F.col("taker").alias("key"),
        F.substring(F.col("text"), F.lit(1), F.col("wanted")).alias("_head"),
        F.col("fingerprint").alias("_next"),
    )
    if not distinct.where("n > 1").isEmpty():
        heads = heads.dropDuplicates(["key"])
    size = F.length("text")
    # floor(n / 3) of the taker's code points go, whatever the head has
    own = F.substring(F.col("text"), F.lit(1), size - F.floor(size / 3).cast("int"))
    joined = with_tree(texts.join(heads, "key"), "text").select(
        F.col("key.id").alias("id"),
        size.cast("long").alias("n_chars"),
        F.col("fingerprint").alias("_own"),
        F.concat(own, F.col("_head")).alias("edited"),
        "_next",
    )
    both = with_tree(joined, "edited").withColumnsRenamed({"fingerprint": "edited_fingerprint", "_own": "fingerprint"})
    pairs = {"near_edited": ("fingerprint", "edited_fingerprint"), "near_next": ("fingerprint", "_next")}
    return likeness(both, pairs).drop("_next")
