"""SimHash fingerprints and their links, found with an index in Gray order.

A text's fingerprint has the bits that are set in over half of its shingles' XXH64 hashes. Fingerprints
link where at most ``radius`` bits differ, and a document's component is the smallest id it reaches.

Index. Equal fingerprints are one entry. Entries go to partitions that a link cannot miss: of the radius + 1
bands of a fingerprint a linked pair shares one, so every entry is placed once per band under the leading
bits of that band, as many bits as keep partitions small, and a partition that is still too large is parted
again by bands of the bits left. In a partition the entries are sorted by Gray rank and every ``FAN`` in a
row make a node that keeps the bits they share (mask and pattern); nodes make nodes in the same way. A
search goes down from the top and adds up the differences in the bits each node newly shares; above the
radius the whole group is dropped, and a group that fits with all its open bits different is taken whole.

Entries of a partition that link are merged there, so at most one edge per entry and partition leaves it,
never all pairs of a group. The edges' components come from alternating star steps, each written to the
shared folder, until nothing changes.

No words: fingerprint zero, linked like any other. Fewer words than a shingle: the whole sequence. Null ids
are kept; a component of null ids alone is null. Repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.llm import words
from rankweave.session import cut_lineage

BITS = 64
RADIUS = 3
FAN = 4
# Entries a partition should have, and may have before it is parted again.
PARTITION = 2_048
LARGEST = 32_768
PAIRS_PER_STEP = 1 << 21
HASHED_AT_ONCE = 1 << 16
ONE = np.uint64(1)


def text_fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """Fingerprint of one text (UTF-8): A-Z lower-cased, words between ASCII white space."""
    found = (text or b"").lower().split()
    if not found:
        return 0
    digest = partial(xxhash.xxh64_intdigest, seed=42)
    grams = map(b" ".join, zip(*(found[k:] for k in range(shingle)))) if len(found) >= shingle else iter([b" ".join(found)])
    total = max(len(found) - shingle + 1, 1)
    ones = np.zeros(BITS, np.int64)
    while True:
        h = np.fromiter(map(digest, islice(grams, HASHED_AT_ONCE)), np.uint64)
        if not len(h):
            break
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(id, digest, bits): a hash of the text, and the fingerprint as a signed long."""
    source = docs.select(F.col(id_col).alias("id"), digest_of(F.col(text)).alias("digest"), F.col(text).alias("text"))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, "text"):
                made = [text_fingerprint(x, shingle) for x in part.column("text").cast(pa.binary()).to_pylist()]
                bits = pa.array(np.array(made, np.uint64).view(np.int64))
                yield pa.record_batch([part.column("id"), part.column("digest"), bits], ["id", "digest", "bits"])

    return source.mapInArrow(kernel, f"id {source.schema['id'].dataType.simpleString()}, digest long, bits long")


def digest_of(text: Column) -> Column:
    return F.coalesce(F.xxhash64(text), F.lit(0))


def as_hex(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def gray_rank(code: np.ndarray) -> np.ndarray:
    """Position of a code in the reflected binary order."""
    rank = code.copy()
    for step in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(step)
    return rank


class GrayTree:
    """Nodes over codes in Gray order; ``levels[0]`` are the codes, the last level is the top."""

    def __init__(self, codes: np.ndarray):
        self.order = np.argsort(gray_rank(codes), kind="stable")
        self.codes = codes[self.order]
        full = np.full(len(codes), ~np.uint64(0))
        self.levels = [(self.codes, full)]
        while len(self.levels[-1][0]) > FAN:
            pattern, mask = self.levels[-1]
            begin = np.arange(0, len(pattern), FAN)
            every = np.bitwise_and.reduceat(pattern, begin)
            some = np.bitwise_or.reduceat(pattern, begin)
            shared = np.bitwise_and.reduceat(mask, begin) & ~(every ^ some)
            self.levels.append((every & shared, shared))

    def near(self, begin: int, end: int, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """(query, node, level) for codes ``begin:end``: the node's codes are all within ``radius``.

        Only nodes that reach beyond the query in the order are visited, so a pair is met once.
        """
        top = len(self.levels) - 1
        n_top = len(self.levels[top][0])
        query = np.repeat(np.arange(begin, end), n_top)
        node = np.tile(np.arange(n_top), end - begin)
        known = np.zeros(len(node), np.uint64)
        apart = np.zeros(len(node), np.uint8)
        for level in range(top, -1, -1):
            span = FAN**level
            ahead = (node + 1) * span > query + 1
            query, node, known, apart = query[ahead], node[ahead], known[ahead], apart[ahead]
            pattern, mask = self.levels[level]
            shared = mask[node]
            apart = apart + np.bitwise_count((self.codes[query] ^ pattern[node]) & shared & ~known)
            fits = apart <= radius
            query, node, shared, apart = query[fits], node[fits], shared[fits], apart[fits]
            whole = apart + (BITS - np.bitwise_count(shared)) <= radius
            if whole.any():
                yield query[whole], node[whole], level
                query, node, shared, apart = query[~whole], node[~whole], shared[~whole], apart[~whole]
            if level == 0 or not len(node):
                return
            below = len(self.levels[level - 1][0])
            query, shared, apart = np.repeat(query, FAN), np.repeat(shared, FAN), np.repeat(apart, FAN)
            node = (node[:, None] * FAN + np.arange(FAN)).ravel()
            real = node < below
            query, node, known, apart = query[real], node[real], shared[real], apart[real]


def merged(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the sets of ``a[i]`` and ``b[i]``; ``label`` names each entry's set by its first member."""
    while len(a):
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            break
        a, b = a[differ], b[differ]
        low, high = np.minimum(la, lb)[differ], np.maximum(la, lb)[differ]
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label = label[label]
    return label


def components(codes: np.ndarray, radius: int) -> np.ndarray:
    """For each code the index of a code that stands for its component."""
    tree = GrayTree(codes)
    n = len(codes)
    label = np.arange(n)
    step = max(1, PAIRS_PER_STEP // max(n, 1))
    for begin in range(0, n, step):
        for query, node, level in tree.near(begin, min(begin + step, n), radius):
            span = FAN**level
            first = node * span
            label = merged(label, query, first)
            if level:  # the node's codes all link to the query, and so to its first code
                closed = np.unique(node)
                inner = (closed[:, None] * span + np.arange(1, span)).ravel()
                head = np.repeat(closed * span, span - 1)
                real = inner < n
                label = merged(label, inner[real], head[real])
    out = np.empty(n, np.int64)
    out[tree.order] = tree.order[label]
    return out


def turned(bits: Column, by: Column | int) -> Column:
    """Rotated left; ``by`` is below 64."""
    by = F.lit(by) if isinstance(by, int) else by
    low = F.call_function("shiftrightunsigned", bits, (F.lit(BITS) - by).cast("int"))
    return F.when(by == 0, bits).otherwise(F.call_function("shiftleft", bits, by.cast("int")).bitwiseOR(low))


def leading(bits: Column, n: int) -> Column:
    return F.call_function("shiftrightunsigned", bits, F.lit(BITS - n)) if n else F.lit(0).cast("long")


def placed(entries: DataFrame, radius: int, n: int) -> DataFrame:
    """Each entry under the keys (place, key) of the partitions it belongs to."""
    bands = radius + 1
    band = BITS // bands
    prefix = min(band, max(0, int(np.ceil(np.log2(max(n, 1) / PARTITION)))))
    once = entries.select(
        "bits", F.explode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("place")
    ).withColumn("key", leading(turned(F.col("bits"), F.col("place") * band), prefix))
    large = once.groupBy("place", "key").count().where(F.col("count") > LARGEST).drop("count")
    large = cut_lineage(large, "large")
    if large.isEmpty():
        return once
    # a partition this large is parted by its whole band and by a band of the other bits
    rest = (BITS - band) // bands
    marked = once.join(large.withColumn("_large", F.lit(True)), ["place", "key"], "left")
    again = (
        marked.where("_large")
        .withColumn("_inner", F.explode(F.sequence(F.lit(0), F.lit(bands - 1))))
        .withColumn("_band", leading(turned(F.col("bits"), F.col("place") * band), band))
        .withColumn(
            "key",
            F.xxhash64(
                "_band", "_inner", leading(turned(F.col("bits"), (F.col("place") * band + band + F.col("_inner") * rest) % BITS), rest)
            ),
        )
        .withColumn("place", F.lit(bands) + F.col("place") * bands + F.col("_inner"))
    )
    return marked.where("_large is null").select("bits", "place", "key").unionByName(again.select("bits", "place", "key"))


def edges(entries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links enough to connect what is within ``radius``; at most one per entry and partition."""
    n = entries.count()

    def kernel(table: pa.Table) -> pa.Table:
        codes = table.column("bits").to_numpy()
        to = codes[components(codes.view(np.uint64), radius)]
        keep = to != codes
        return pa.table({"a": codes[keep], "b": to[keep]})

    return placed(entries, radius, n).groupBy("place", "key").applyInArrow(kernel, "a long, b long")


def connected(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node each linked node reaches, roots left out."""

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    # a > b throughout
    now = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = cut_lineage(now, "links")
    before = None
    while before != (seen := state(now)):
        before = seen
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        now = cut_lineage(small, "links")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = RADIUS) -> DataFrame:
    """(id, digest, bits, component, n_docs, leader) of every document; see ``grouped``."""
    prints = cut_lineage(fingerprints(docs, id_col, text, shingle), "prints")
    return grouped(prints, edges(cut_lineage(prints.select("bits").distinct(), "entries"), radius))


def grouped(prints: DataFrame, links: DataFrame) -> DataFrame:
    """Documents (id, digest, bits) with the components that ``links`` between their ``bits`` make.

    ``component`` is the smallest id reached, ``n_docs`` the size of the component. Its leader is the document with the
    smallest (id, digest), null ids last; rows that repeat the leader are leaders too.
    """
    place = F.struct(F.col("id").isNull().alias("unknown"), "id", "digest")
    entries = prints.groupBy("bits").agg(F.min(place).alias("least"), F.count("*").alias("n"))
    roots = connected(links)
    rooted = entries.join(roots, entries["bits"] == roots["node"], "left").select(
        "bits", F.coalesce("root", "bits").alias("root"), "least", "n"
    )
    classes = rooted.groupBy("root").agg(F.min("least").alias("least"), F.sum("n").alias("n_docs"))
    named = rooted.select("bits", "root").join(classes, "root").drop("root")
    joined = prints.join(named, "bits")
    leader = F.col("id").eqNullSafe(F.col("least.id")) & (F.col("digest") == F.col("least.digest"))
    return joined.select("id", "digest", "bits", F.col("least.id").alias("component"), "n_docs", leader.alias("leader"))


def first_rows(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` per component: its leader's."""
    leaders = found.where("leader").select(F.col("id").alias("leader_id"), F.col("digest").alias("leader_digest"))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`").alias(c) for c in docs.columns]).alias("doc"),
        F.col(id_col).alias("id"),
        digest_of(F.col(text)).alias("digest"),
    )
    same = F.col("id").eqNullSafe(F.col("leader_id")) & (F.col("digest") == F.col("leader_digest"))
    kept = rows.join(leaders.distinct(), same, "left_semi")
    if leaders.groupBy("leader_id", "leader_digest").count().where("count > 1").isEmpty():
        return kept.select("doc.*")
    return kept.dropDuplicates(["id", "digest"]).select("doc.*")
