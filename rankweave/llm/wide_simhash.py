"""Near-duplicate texts by Jaccard similarity of word shingles, with SimHash fingerprints of 256 bits.

64 bits cannot tell similarity 0.8 from much less: such texts differ in 10 of 64 bits give or take 3. In 256
bits they differ in 39 give or take 6, unrelated ones in 128 give or take 8, so a wide radius finds nearly all pairs
and few others. These are candidates; a pair links where its shingle sets are found to be similar enough.

Fingerprint. A text's distinct shingles (A-Z lower-cased words between ASCII white space) are hashed, each hash
gives 256 bits, and a bit of the fingerprint is what most shingles say; where they are even, what the shingle
with the smallest hash says. The order and number of repeats do not count.

Index. Equal shingle sets are one entry. A table places entries by a few chosen bits, more bits for more entries
so that partitions stay small, and there are as many tables as give a pair at the wanted similarity the chance
``FOUND`` to share a partition at least. A partition that is still too large (a large group of near copies) is
placed again by further bits, in tables counted the same way. In a partition a tree in Gray order over one
64-bit word drops groups that differ too much in it; what is left is compared in all 256 bits.

Candidates. Only components count, so a pair whose ends are connected already needs no check. Entries carry ``MARK_BITS``
parities of their shingles; sets differ in at least as many members as parities differ, so pairs that cannot be similar
enough are left out before they become rows. In the first ``ROUNDS`` rounds an entry and partition give one candidate, the
nearest entry outside the component; then all candidates between different components are checked. A large group of near
copies takes a few checks per text that way; a large group within the radius takes one per pair only where the parities
cannot tell its texts from linked ones. Shingle sets are made again from the texts of candidates
only; sets that many pairs need are repeated over salts.

Texts without words are one component and link to nothing else. Fewer words than a shingle: the whole sequence. Shingle
sets are named by a 64-bit hash of their sorted hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.llm import simhash, words
from rankweave.plans.bounds import lookup_join
from rankweave.session import cut_lineage

WORDS = 4
BITS = 64 * WORDS
SHINGLE = 5
SIMILARITY = 0.8
# Chance of a pair at the wanted similarity to share a partition, and how far above the mean its distance may be.
FOUND = 0.999
DEVIATIONS = 4.0
WORD_DEVIATIONS = 4.0
# Rounds of nearest candidates before all that are left, and pairs that one copy of a shingle set serves.
ROUNDS = 2
PAIRS_PER_SET = 256
# Entries a partition should have, and may have before it is placed again.
PARTITION = 1_024
LARGEST = 16_384
HASHED_AT_ONCE = 1 << 14
STEPS = np.arange(1, WORDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
CODE = [f"w{k}" for k in range(WORDS)]
# Parities of a set's shingles, which bound from below how many members two sets differ in.
MARK_BITS = 512
MARK = [f"m{k}" for k in range(MARK_BITS // 64)]
ENTRY = ["bits", "size", "root", *CODE, *MARK]


def differing(similarity: float) -> float:
    """Expected share of bits in which texts of this Jaccard similarity differ."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def radius_of(similarity: float, bits: int, deviations: float) -> int:
    p = differing(similarity)
    return min(bits, math.ceil(bits * p + deviations * math.sqrt(bits * p * (1 - p))))


def tables_for(similarity: float, chosen: int) -> int:
    """Tables of so many chosen bits that such a pair shares a partition with chance ``FOUND``."""
    agree = (1 - differing(similarity)) ** chosen
    return 1 if agree >= FOUND else math.ceil(math.log(1 - FOUND) / math.log(1 - agree))


def chosen_for(n: int) -> int:
    """Bits that cut ``n`` entries into partitions of the wanted size."""
    return max(0, math.ceil(math.log2(max(n, 1) / PARTITION)))


def spread_bits(hashes: np.ndarray) -> np.ndarray:
    """(n, 256) zeros and ones, all of them from each 64-bit hash."""
    wide = words.mix(hashes[:, None] + STEPS)
    return np.unpackbits(wide.view(np.uint8).reshape(len(hashes), -1), axis=1, bitorder="little")


def shingle_set(text: bytes | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of a text's (UTF-8) distinct shingles; none without words."""
    found = (text or b"").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    grams = map(b" ".join, zip(*(found[k:] for k in range(shingle)))) if len(found) >= shingle else iter([b" ".join(found)])
    digest = partial(xxhash.xxh64_intdigest, seed=42)
    return np.unique(np.fromiter(map(digest, grams), np.uint64))


def set_code(hashes: np.ndarray) -> np.ndarray:
    """The fingerprint of a shingle set as four words, zero without shingles."""
    if not len(hashes):
        return np.zeros(WORDS, np.uint64)
    ones = np.zeros(BITS, np.int64)
    for begin in range(0, len(hashes), HASHED_AT_ONCE):
        ones += spread_bits(hashes[begin : begin + HASHED_AT_ONCE]).sum(0, dtype=np.int64)
    even = (ones * 2 == len(hashes)) & (spread_bits(hashes[:1])[0] == 1)
    return np.packbits((ones * 2 > len(hashes)) | even, bitorder="little").view(np.uint64)


def set_marks(hashes: np.ndarray) -> np.ndarray:
    """How many shingles fall on each of ``MARK_BITS`` bits, odd or even, as words."""
    odd = np.bincount((hashes & np.uint64(MARK_BITS - 1)).astype(np.int64), minlength=MARK_BITS) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.uint64)


def set_name(hashes: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(hashes.tobytes(), seed=42) if len(hashes) else 0


def text_code(text: bytes | None, shingle: int = SHINGLE) -> np.ndarray | None:
    """The fingerprint of one text (UTF-8); None without words."""
    hashes = shingle_set(text, shingle)
    return set_code(hashes) if len(hashes) else None


def fingerprints(docs: DataFrame, id_col: str, text: str, shingle: int) -> DataFrame:
    """(id, digest, bits, size, w0..w3, m0..): ``bits`` names the shingle set, 0 where there are no words; size counts it."""
    source = docs.select(F.col(id_col).alias("id"), simhash.digest_of(F.col(text)).alias("digest"), F.col(text).alias("text"))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, "text"):
                made = []
                for x in part.column("text").cast(pa.binary()).to_pylist():
                    hashes = shingle_set(x, shingle)
                    made.append((set_name(hashes), len(hashes), np.concatenate((set_code(hashes), set_marks(hashes)))))
                code = np.array([x[2] for x in made], np.uint64).reshape(-1, len(CODE) + len(MARK)).view(np.int64)
                names = np.array([x[0] for x in made], np.uint64).view(np.int64)
                columns = [part.column("id"), part.column("digest"), pa.array(names), pa.array([x[1] for x in made], pa.int64())]
                columns += [pa.array(x) for x in code.T]
                yield pa.record_batch(columns, ["id", "digest", "bits", "size", *CODE, *MARK])

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(kernel, f"id {kind}, digest long, bits long, size long, " + ", ".join(f"{c} long" for c in CODE + MARK))


def shingle_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """(bits, hashes) of the texts in column ``text``, one row for each set."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, "text"):
                made = [shingle_set(x, shingle) for x in part.column("text").cast(pa.binary()).to_pylist()]
                names = np.array([set_name(x) for x in made], np.uint64).view(np.int64)
                cuts = np.concatenate(([0], np.cumsum([len(x) for x in made]))).astype(np.int32)
                hashes = pa.ListArray.from_arrays(cuts, pa.array(np.concatenate(made).view(np.int64)))
                yield pa.record_batch([pa.array(names), hashes], ["bits", "hashes"])

    return texts.select("text").mapInArrow(kernel, "bits long, hashes array<long>").groupBy("bits").agg(F.first("hashes").alias("hashes"))


def codes_of(batch: pa.RecordBatch | pa.Table) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy() for c in CODE], 1).view(np.uint64)


def chosen_bits(table: int, chosen: int, seed: int = 0) -> np.ndarray:
    """The bits of a table: tables of one shuffled order have none in common, then comes another order."""
    per_order = max(1, BITS // max(chosen, 1))
    order = np.random.default_rng([seed, table // per_order]).permutation(BITS)
    return np.resize(order, (per_order, min(chosen, BITS)))[table % per_order] if chosen else order[:0]


def keys(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One number per row of (n, 256) ``bits``: those at ``at``, of which there are at most 63."""
    return bits[:, at] @ (np.int64(1) << np.arange(len(at), dtype=np.int64))


def placed(entries: DataFrame, n: int, similarity: float) -> DataFrame:
    """Each entry under the (place, key, inner, inner_key) of its partitions."""
    chosen = chosen_for(n)
    tables = tables_for(similarity, chosen)
    columns = ", ".join(f"{c} long" for c in ENTRY)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.unpackbits(codes_of(batch).view(np.uint8), axis=1, bitorder="little").astype(np.int64)
            for table in range(tables):
                place = pa.array(np.full(batch.num_rows, table, np.int32))
                key = pa.array(keys(bits, chosen_bits(table, chosen)))
                yield pa.record_batch([*batch.select(ENTRY).columns, place, key], [*ENTRY, "place", "key"])

    once = entries.mapInArrow(first, f"{columns}, place int, key long")
    large = once.groupBy("place", "key").count().where(F.col("count") > LARGEST)
    large = cut_lineage(large.withColumn("deeper", F.ceil(F.log2(F.col("count") / PARTITION)).cast("int")).drop("count"), "large")
    whole = {"inner": F.lit(-1), "inner_key": F.lit(0).cast("long")}
    if large.isEmpty():
        return once.withColumns(whole)

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            deeper = batch.column("deeper").to_numpy()
            for depth in np.unique(deeper).tolist():
                part = batch.filter(pa.array(deeper == depth))
                bits = np.unpackbits(codes_of(part).view(np.uint8), axis=1, bitorder="little").astype(np.int64)
                columns = part.select([*ENTRY, "place", "key"]).columns
                for table in range(tables_for(similarity, depth)):
                    inner = pa.array(np.full(part.num_rows, table, np.int32))
                    key = pa.array(keys(bits, chosen_bits(table, depth, seed=1)))
                    yield pa.record_batch([*columns, inner, key], [*ENTRY, "place", "key", "inner", "inner_key"])

    marked = once.join(large, ["place", "key"], "left")
    again = marked.where("deeper is not null").mapInArrow(second, f"{columns}, place int, key long, inner int, inner_key long")
    return marked.where("deeper is null").drop("deeper").withColumns(whole).unionByName(again)


def near_pairs(codes: np.ndarray, word: int, word_radius: int, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(one, other, bits that differ) of pairs of the (n, 4) codes within both radii, each pair once, in parts."""
    tree = simhash.GrayTree(np.ascontiguousarray(codes[:, word]))
    wide = codes[tree.order]
    n = len(codes)
    step = max(1, simhash.PAIRS_PER_STEP // max(n, 1))
    for begin in range(0, n, step):
        for query, node, level in tree.near(begin, min(begin + step, n), word_radius):
            span = simhash.FAN**level
            member = (node[:, None] * span + np.arange(span)).ravel()
            query = np.repeat(query, span)
            real = (member > query) & (member < n)
            query, member = query[real], member[real]
            apart = np.zeros(len(query), np.int64)
            for k in range(WORDS):
                apart += np.bitwise_count(wide[query, k] ^ wide[member, k])
            near = apart <= radius
            yield tree.order[query[near]], tree.order[member[near]], apart[near]


def components(codes: np.ndarray, word: int, word_radius: int, radius: int) -> np.ndarray:
    """For each of the (n, 4) codes the index of one that stands for its component."""
    label = np.arange(len(codes))
    for one, other, _ in near_pairs(codes, word, word_radius, radius):
        label = simhash.merged(label, one, other)
    return label


def candidates(entries: DataFrame, n: int, similarity: float, nearest: bool) -> DataFrame:
    """(a, b), a < b: entries with different roots that may be similar, all pairs or the nearest of each entry and partition."""
    radius = radius_of(similarity, BITS, DEVIATIONS)
    word_radius = radius_of(similarity, 64, WORD_DEVIATIONS)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        names, size, root = (table.column(c).to_numpy() for c in ("bits", "size", "root"))
        marks = np.stack([table.column(c).to_numpy() for c in MARK], 1).view(np.uint64)
        word = (table.column("place")[0].as_py() + table.column("inner")[0].as_py() + 1) % WORDS

        def pairs(one: np.ndarray, other: np.ndarray) -> pa.RecordBatch:
            a, b = names[one], names[other]
            return pa.record_batch([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

        none = np.int64(1 << 62)
        best = np.full(len(names), none)
        for one, other, apart in near_pairs(codes_of(table), word, word_radius, radius):
            small, large = np.minimum(size[one], size[other]), np.maximum(size[one], size[other])
            # sets of more different sizes cannot be similar enough
            keep = (root[one] != root[other]) & (small >= similarity * large - 1e-9)
            one, other, apart = one[keep], other[keep], apart[keep]
            # nor can sets that are sure to differ in more members than this
            most = (1 - similarity) / (1 + similarity) * (size[one] + size[other]) + 1e-9
            keep = np.bitwise_count(marks[one] ^ marks[other]).sum(1, dtype=np.int64) <= most
            one, other, apart = one[keep], other[keep], apart[keep]
            if not nearest:
                yield pairs(one, other)
                continue
            np.minimum.at(best, one, (apart << 32) + other)
            np.minimum.at(best, other, (apart << 32) + one)
        if nearest:
            has = np.flatnonzero(best < none)
            yield pairs(has, best[has] & 0xFFFFFFFF)

    grouped = placed(entries, n, similarity).groupBy("place", "key", "inner", "inner_key")
    return grouped.applyInArrow(kernel, "a long, b long").distinct()


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The (a, b) of ``pairs`` whose ``sets`` (bits, hashes) have at least this Jaccard similarity."""
    for end in ("a", "b"):
        often = pairs.groupBy(end).count().where(F.col("count") > PAIRS_PER_SET)
        often = cut_lineage(often.select(end, F.ceil(F.col("count") / PAIRS_PER_SET).cast("int").alias("salts")), "often")
        salts = F.coalesce("salts", F.lit(1))
        salted = lookup_join(pairs, often, [end], "left").withColumn("salt", F.pmod(F.xxhash64("a", "b"), salts).cast("int"))
        own = lookup_join(sets.select(F.col("bits").alias(end), F.col("hashes").alias(f"of_{end}")), often, [end], "left")
        own = own.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts")
        pairs = salted.drop("salts").join(own, [end, "salt"]).drop("salt")
    both = pairs.withColumn("shared", F.size(F.array_intersect("of_a", "of_b")))
    either = F.size("of_a") + F.size("of_b") - F.col("shared")
    return both.where(F.col("shared") >= similarity * either - 1e-9).select("a", "b")


def links(docs: DataFrame, codes: DataFrame, text: str, shingle: int, similarity: float) -> DataFrame:
    """(a, b): verified links between named shingle sets that connect what all such links connect."""
    source = docs.select(simhash.digest_of(F.col(text)).alias("digest"), F.col(text).alias("text"))
    found = codes.select(F.col("bits").alias("a"), F.col("bits").alias("b")).limit(0)
    n = codes.count()
    for turn in range(ROUNDS + 1):
        roots = simhash.connected(found) if turn else found.toDF("node", "root")
        rooted = codes.join(roots, codes["bits"] == roots["node"], "left").withColumn("root", F.coalesce("root", "bits"))
        pairs = cut_lineage(candidates(rooted.select(*ENTRY), n, similarity, turn < ROUNDS), "pairs")
        if pairs.isEmpty():
            break
        nodes = pairs.select(F.col("a").alias("bits")).unionByName(pairs.select(F.col("b").alias("bits"))).distinct()
        wanted = codes.join(nodes, "bits", "left_semi").select("digest").distinct()
        sets = cut_lineage(shingle_sets(lookup_join(source, wanted, ["digest"], "left_semi"), shingle), "sets")
        found = found.unionByName(cut_lineage(verified(pairs, sets, similarity), "links"))
    return found


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY
) -> DataFrame:
    """(id, digest, bits, component, n_docs, leader) of every document, as ``simhash.near_duplicates`` gives them."""
    prints = cut_lineage(fingerprints(docs, id_col, text, shingle), "prints")
    first = [F.first(c).alias(c) for c in ["size", *CODE, *MARK]]
    codes = cut_lineage(prints.where("bits <> 0").groupBy("bits").agg(F.min("digest").alias("digest"), *first), "codes")
    return simhash.grouped(prints.select("id", "digest", "bits"), links(docs, codes, text, shingle, similarity))
