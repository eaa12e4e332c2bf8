"""Jaccard join of documents' shingle sets: documents with one prefix and size are one group, groups are joined, members verified.

1. All shingles of all documents are counted in ``BUCKETS`` hashed counters. (count, hash) is the order of shingles: those
   that many documents share come last. Any order gives right results; this one keeps common passages out of prefixes.
2. A document's shingles in that order are its set. Documents with one set are one class, and classes of one size with the
   same prefix (the first ``size - ceil(share * size) + 1`` shingles) are one group. Linked sets share a shingle of their prefixes.
3. Classes meet under each shared prefix shingle and are filtered where they meet: by size, by the position of the shingle and
   by parity bits of their shingles, which two sets that are similar enough cannot differ in too often. Only pairs that pass
   become rows; they are verified by intersecting their sets.
4. Verification runs in rounds. All but the last take neighbours of different components only: a group's lead and the nearest that
   passes before it under its rarest shared shingles, members of one group in a row, by size and then in a shuffled order. That
   links a large group of near copies by few pairs. The last takes every pair of classes of different components that
   passes the filters, in cells of bounded size, so no link is lost, and copies are never expanded into all pairs. Of these the
   likeliest pair of each two components is verified first, then all pairs of components that are still apart.

``linked`` gives all links between classes, without the shortcut of round one. Shingles, prefixes and sets go by 64-bit hashes.

Defined results: text without words, null or empty: an empty set, a component by itself; one or two words: one shingle of
them; repeated rows are copies; a null id is counted but names no component (null where no other id is reached); ids may be
of any ordered type; texts of any length are taken whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankweave.llm import words
from rankweave.llm.simhash import connected
from rankweave.plans.bounds import lookup_join
from rankweave.session import cut_lineage

SHINGLE = 3
# Two sets link when ``SHARE[1] * intersection >= SHARE[0] * union``.
SHARE = (90, 100)
BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
# Classes of one shingle that are compared with as many others of it at once, and pairs of them that are looked at together.
CELL = 1024
PAIRS_AT_ONCE = 1 << 18
# Shared shingles under which a group looks for neighbours in the first round.
FIRST = 3
# Places apart that neighbours are at most, and rounds that compare only those, each in another order, before all pairs that are left.
NEXT = 4
ROUNDS = 2
SLICE_BYTES = 1 << 20
# Parities of a set at least; a larger set has as many as the next power of two of its members.
MARK_BITS = 1024
# Parities that entries carry, so that pairs are filtered before they become rows.
FOLD_BITS = 512
STEPS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every shingle of every text, repeats included."""
    (hashes,), first = words.word_hashes(texts, lower=True)
    count = np.diff(first)
    owner = np.repeat(np.arange(len(count)), count)
    left = np.repeat(first[1:], count) - np.arange(len(hashes))  # words from here to the end of the text
    found, text = [], []
    for size in range(1, SHINGLE + 1):
        at = np.flatnonzero(left >= size) if size == SHINGLE else np.flatnonzero((left == size) & (count[owner] == size))
        value = np.full(len(at), size, np.uint64)
        for k in range(size):
            value = value + hashes[at + k] * STEPS[k]
        found.append(words.mix(value))
        text.append(owner[at])
    return np.concatenate(text), np.concatenate(found)


def distinct(text: np.ndarray, value: np.ndarray, rank: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Each (text, hash) once, texts in order, hashes by (rank, hash)."""
    order = np.lexsort((value, text) if rank is None else (value, rank, text))
    text, value = text[order], value[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    return text[new], value[new]


def bucket(value: np.ndarray) -> np.ndarray:
    return (value >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def counts(docs: DataFrame, text: str) -> np.ndarray:
    """How many (document, shingle) pairs fall in each of the ``BUCKETS``, over all documents."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in words.slices(batch, "text", SLICE_BYTES):
                _, value = distinct(*shingles(part.column("text")))
                total += np.bincount(bucket(value), minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.record_batch([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    partial = docs.select(F.col(text).alias("text")).mapInArrow(kernel, "bucket long, n long")
    table = partial.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # at most BUCKETS rows
    total = np.zeros(BUCKETS, np.int64)
    total[table["bucket"].to_numpy()] = table["n"].to_numpy()
    return total


def texts_of(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("digest"), F.col(text).alias("text"))


def named(value: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the members of each run, whatever their order."""
    upto = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words.mix(value ^ STEPS[0]), dtype=np.uint64)))
    return words.mix(upto[end] - upto[begin] + (end - begin).astype(np.uint64))


def marks(owner: np.ndarray, value: np.ndarray, size: np.ndarray) -> pa.Array:
    """Parities of texts with ``size`` distinct shingles: how many of them fall on a bit, odd or even, as lists of longs.

    They are as many as the shingles, so that they tell large sets apart as well as small ones.
    """
    bits = np.maximum(MARK_BITS, 1 << np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64))
    cut = np.concatenate(([0], np.cumsum(bits)))
    key = cut[owner] + (value & (bits[owner] - 1).astype(np.uint64)).astype(np.int64)
    out = np.zeros(cut[-1] // 64, np.uint64)
    np.bitwise_xor.at(out, key >> 6, np.uint64(1) << (key & 63).astype(np.uint64))
    return list_of(out, cut // 64)


def list_of(value: np.ndarray, cut: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(cut.astype(np.int32), pa.array(value.view(np.int64)))


def prefixes(texts: DataFrame, share: tuple[int, int] = SHARE) -> DataFrame:
    """(id, digest, size, name, grp, prefix, mark): the name of a document's set, its prefix and marks, and the name of its group."""
    total = texts.sparkSession.sparkContext.broadcast(counts(texts, "text"))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, "text", SLICE_BYTES):
                owner, value = shingles(part.column("text"))
                owner, value = distinct(owner, value, total.value[bucket(value)])
                cut = np.searchsorted(owner, np.arange(part.num_rows + 1))
                size = np.diff(cut)
                length = prefix_of(size, share)
                group = words.mix(named(value, cut[:-1], cut[:-1] + length) ^ (size.astype(np.uint64) * STEPS[1]))
                inside = np.arange(len(owner)) - cut[owner] < length[owner]
                upto = np.concatenate(([0], np.cumsum(length)))
                own = named(value, cut[:-1], cut[1:])
                yield pa.record_batch(
                    [
                        part.column("id"), part.column("digest"), pa.array(size), pa.array(own.view(np.int64)),
                        pa.array(group.view(np.int64)), list_of(value[inside], upto), marks(owner, value, size),
                    ],
                    ["id", "digest", "size", "name", "grp", "prefix", "mark"],
                )

    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(kernel, f"id {kind}, digest long, size long, name long, grp long, prefix array<long>, mark array<long>")


def sets(texts: DataFrame) -> DataFrame:
    """(name, hashes): the whole set of each text that has one."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, "text", SLICE_BYTES):
                owner, value = distinct(*shingles(part.column("text")))
                cut = np.searchsorted(owner, np.arange(part.num_rows + 1))
                own = named(value, cut[:-1], cut[1:])
                yield pa.record_batch([pa.array(own.view(np.int64)), list_of(value, cut)], ["name", "hashes"])

    return texts.select("text").mapInArrow(kernel, "name long, hashes array<long>")


def prefix_of(size: np.ndarray, share: tuple[int, int]) -> np.ndarray:
    """Length of the prefix of sets of these sizes."""
    part, whole = share
    return np.where(size > 0, size - -(-size * part // whole) + 1, 0)


def shared_prefixes(found: DataFrame, share: tuple[int, int] = SHARE) -> DataFrame:
    """(token, place from 1, grp, size): each group under the shingles of its prefix that a group of a fitting size has in its own.

    In order of (token, size) the closest size is next to a group, so one pass over ranges finds the groups that none fits,
    and rows of copies. Rows at the ends of a batch are kept: their neighbours are not seen. A token that a third of all
    groups have lies across many ranges.
    """
    part, whole = share
    columns = ["token", "size", "grp", "place"]
    every = found.select("grp", "size", F.posexplode("prefix").alias("place", "token")).withColumn("place", F.col("place") + 1)
    ranged = every.select(columns).repartitionByRange("token", "size", "grp").sortWithinPartitions("token", "size", "grp")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            if not batch.num_rows:
                continue
            token, size, group = (batch.column(c).to_numpy() for c in columns[:3])
            new = np.ones(len(token), bool)
            new[1:] = (token[1:] != token[:-1]) | (group[1:] != group[:-1])
            new[0] = before != (token[0], group[0])
            before = token[-1], group[-1]
            at = np.flatnonzero(new)
            token, size = token[at], size[at].astype(np.int64)
            fits = (token[1:] == token[:-1]) & (size[:-1] * whole >= size[1:] * part)
            keep = np.ones(len(at), bool)
            keep[1:-1] = fits[1:] | fits[:-1]
            yield batch.take(pa.array(at[keep]))

    return ranged.mapInArrow(kernel, ranged.schema).select("token", "place", "grp", "size")


def first_of(entries: DataFrame, n: int = FIRST) -> DataFrame:
    """The entries of each group under its first ``n`` shared shingles, the rarest ones."""
    window = Window.partitionBy("grp").orderBy("place", "token")
    return entries.withColumn("_n", F.row_number().over(window)).where(F.col("_n") <= n).drop("_n")


def folded(mark: str, words_: Column | int = FOLD_BITS // 64) -> Column:
    """A mark as fewer parities, in ``words_`` longs: those of the shingles that fall on any of several bits."""
    kept = F.lit(words_) if isinstance(words_, int) else words_
    later = F.sequence(F.lit(1), (F.size(mark) / kept).cast("int") - 1)
    more = F.transform(F.when(F.size(mark) > kept, later).otherwise(F.array().cast("array<int>")), lambda k: F.slice(mark, k * kept + 1, kept))
    return F.aggregate(more, F.slice(mark, 1, kept), lambda out, part: F.zip_with(out, part, lambda x, y: x.bitwiseXOR(y)))


def folds(batch: pa.RecordBatch) -> np.ndarray:
    """The column ``mark`` of a batch, one row of words each."""
    return batch.column("mark").flatten().to_numpy().view(np.uint64).reshape(-1, FOLD_BITS // 64)


def similar(size: np.ndarray, place: np.ndarray, mark: np.ndarray, x: np.ndarray, y: np.ndarray, share: tuple[int, int]) -> np.ndarray:
    """Whether entries at ``x`` and ``y`` that first meet at a shingle can be similar enough, by their sizes, its places in them and
    the parities: sets differ in at least as many members as parities differ."""
    part, whole = share
    one, other = size[x], size[y]
    most = 1 + np.minimum(one - place[x], other - place[y])
    fits = (np.minimum(one, other) * whole >= np.maximum(one, other) * part) & (most * (part + whole) >= (one + other) * part)
    left = np.flatnonzero(fits)
    apart = np.bitwise_count(mark[x[left]] ^ mark[y[left]]).sum(1, dtype=np.int64)
    fits[left] = apart * (part + whole) <= (one + other)[left] * (whole - part)
    return fits


def neighbours(entries: DataFrame, share: tuple[int, int], turn: int) -> DataFrame:
    """(a, b), a < b: for each group (or member, column ``grp``) and token the nearest before it, within ``NEXT`` places, that is of
    another component and passes the filters.

    ``mark`` holds the parities of the group's lead. The first turn has groups in order of size, each later one in another
    shuffled order. Entries are ranged over tasks, so a token that a third of all groups have lies across many.
    """
    columns = ["token", "size", "grp", "place", "low", "high"]
    order = F.col("size") if turn == 0 else F.xxhash64("grp", F.lit(turn))
    placed = entries.select(*columns, "mark", order.alias("by"))
    ranged = placed.repartitionByRange("token", "by", "grp").sortWithinPartitions("token", "by", "grp").select(*columns, "mark")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            now, mark = np.stack([batch.column(c).to_numpy() for c in columns]).astype(np.int64), folds(batch)
            held = 0
            if before is not None:
                held = before[0].shape[1]
                now, mark = np.concatenate((before[0], now), axis=1), np.concatenate((before[1], mark))
            before = now[:, -NEXT:], mark[-NEXT:]
            token, size, group, place, low, high = now
            todo = np.arange(held, len(token))  # those of this batch that have no neighbour yet
            for step in range(1, NEXT + 1):
                todo = todo[todo >= step]
                todo = todo[token[todo] == token[todo - step]]
                x, y = todo - step, todo
                fits = similar(size, place, mark, x, y, share) & ((low[x] != high[x]) | (low[y] != high[y]) | (low[x] != low[y]))
                a, b = group[x[fits]], group[y[fits]]
                yield pa.record_batch([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])
                todo = todo[~fits]

    return ranged.mapInArrow(kernel, "a long, b long").distinct()


def across(entries: DataFrame, share: tuple[int, int]) -> DataFrame:
    """(a, b), a < b: all pairs under a token that pass the filters, but for those of one component.

    ``entries`` has (token, place, name, size, root, mark). Under each token the classes outside its largest component meet all
    others, in cells of about ``CELL`` of either. Pairs are made and filtered inside a cell; only those that pass become rows.
    """
    part, whole = share
    tally = entries.groupBy("token", "root").agg(F.count("*").alias("n"))
    cells = tally.groupBy("token").agg(F.max(F.struct("n", "root")).alias("main"), F.sum("n").alias("n"))
    minor = F.col("n") - F.col("main.n")
    cells = cells.where(minor > 0).select(
        "token", F.col("main.root").alias("main"),
        F.ceil(minor / F.lit(CELL)).cast("int").alias("rows"), F.ceil(F.col("n") / F.lit(CELL)).cast("int").alias("columns"),
    )
    marked = entries.join(cells, "token").withColumn("minor", F.col("root") != F.col("main"))

    def place(row: Column, column: Column, left: Column, right: bool) -> Column:
        return F.struct(row.alias("row"), column.alias("column"), left.alias("left"), F.lit(right).alias("right"))

    def upto(n: str) -> Column:
        return F.sequence(F.lit(0), F.col(n) - 1)

    # one cell: every entry once; else one of a row meets all columns, and one of a column all rows
    row, column = (F.pmod(F.xxhash64("name", F.lit(k)), F.col(n)).cast("int") for k, n in enumerate(("rows", "columns")))
    lefts = F.filter(F.transform(upto("columns"), lambda y: place(row, y, F.lit(True), False)), lambda _: F.col("minor"))
    rights = F.transform(upto("rows"), lambda x: place(x, column, F.lit(False), True))
    alone = F.array(place(F.lit(0), F.lit(0), F.col("minor"), True))
    at = F.explode(F.when(F.col("columns") == 1, alone).otherwise(F.concat(lefts, rights))).alias("at")
    key = ["token", "row", "column"]
    columns = [*key, "size", "name", "place", "root"]
    placed = marked.select("token", "size", "name", "place", "root", "mark", at).select(*columns[:1], "at.*", *columns[3:], "mark")
    dealt = placed.repartition(*key).sortWithinPartitions(*key, "size").select(*columns, "left", "right", "mark")

    def pairs(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        now = {c: rows.column(c).to_numpy().astype(np.int64) for c in columns}
        left, right = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("left", "right"))
        mark = np.concatenate([folds(x) for x in rows.to_batches()])
        size, name, root = now["size"], now["name"], now["root"]
        new = np.concatenate(([False], np.any([now[c][1:] != now[c][:-1] for c in key], axis=0)))
        cell = np.cumsum(new) << 40
        # sizes ascend in a cell: those that fit a size are a run of it
        x = np.flatnonzero(left)
        begin = np.searchsorted(cell + size, cell[x] - (-size[x] * part // whole), "left")
        end = np.searchsorted(cell + size, cell[x] + np.minimum(size[x] * whole // part, (1 << 40) - 1), "right")
        met = np.concatenate(([0], np.cumsum(end - begin)))
        at = 0
        while at < len(x):
            to = max(at + 1, int(np.searchsorted(met, met[at] + PAIRS_AT_ONCE, "right")) - 1)
            n = end[at:to] - begin[at:to]
            one = np.repeat(x[at:to], n)
            other = np.arange(met[to] - met[at]) + np.repeat(begin[at:to] - (met[at:to] - met[at]), n)
            # entries that are both left and right meet from either side
            keep = right[other] & (root[one] != root[other]) & ((one < other) | ~left[other])
            one, other = one[keep], other[keep]
            keep = similar(size, now["place"], mark, one, other, share)
            a, b = name[one[keep]], name[other[keep]]
            yield pa.record_batch([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])
            at = to

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the last cell, which may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            ends = [batch.column(c).to_numpy() for c in key]
            changes = np.flatnonzero(np.any([x[1:] != x[:-1] for x in ends], axis=0))
            if held and any(held[-1].column(c)[held[-1].num_rows - 1].as_py() != x[0] for c, x in zip(key, ends)):
                yield from pairs(pa.Table.from_batches(held))
                held = []
            if len(changes):
                cut = int(changes[-1]) + 1
                yield from pairs(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held, batch = [], batch.slice(cut)
            held.append(batch)
        if held:
            yield from pairs(pa.Table.from_batches(held))

    return dealt.mapInArrow(kernel, "a long, b long").distinct()


def plausible(pairs: DataFrame, classes: DataFrame, share: tuple[int, int]) -> DataFrame:
    """(a, b, apart): pairs whose marks differ in no more bits than sets that are similar enough have members apart; the share of
    members that are at least apart.

    A member that only one set has turns one bit, so the sets differ in at least as many members as bits differ.
    """
    part, whole = share
    for end in ("a", "b"):
        own = classes.select(F.col("name").alias(end), F.col("mark").alias(f"mark_{end}"), F.col("size").alias(f"size_{end}"))
        pairs = pairs.join(own, end)
    shorter = F.least(F.size("mark_a"), F.size("mark_b"))
    bits = F.zip_with(folded("mark_a", shorter), folded("mark_b", shorter), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    both = F.col("size_a") + F.col("size_b")
    pairs = pairs.withColumn("differ", F.aggregate(bits, F.lit(0), lambda total, n: total + n))
    return pairs.where(F.col("differ") * (part + whole) <= both * (whole - part)).select("a", "b", (F.col("differ") / both).alias("apart"))


def checked(pairs: DataFrame, texts: DataFrame, classes: DataFrame, share: tuple[int, int], members: DataFrame | None = None) -> DataFrame:
    """The pairs of classes whose sets are similar enough; with ``members`` (name, root) only enough of them to connect what they link."""
    pairs = cut_lineage(plausible(pairs, classes, share), "plausible")
    if members is None:
        return verified(pairs.select("a", "b"), texts, classes, share)
    for end in ("a", "b"):
        pairs = pairs.join(members.select(F.col("name").alias(end), F.col("root").alias(f"root_{end}")), end)
    pairs = cut_lineage(pairs.withColumns({"low": F.least("root_a", "root_b"), "high": F.greatest("root_a", "root_b")}), "bridges")
    likely = pairs.groupBy("low", "high").agg(F.min(F.struct("apart", "a", "b")).alias("best"))
    likely = cut_lineage(likely.select("best.a", "best.b", "low", "high"), "likely")
    links = cut_lineage(verified(likely.select("a", "b"), texts, classes, share), "links")
    roots = connected(likely.join(links, ["a", "b"], "left_semi").select(F.col("low").alias("a"), F.col("high").alias("b")))
    rest = pairs.join(likely, ["a", "b"], "left_anti").select("a", "b", "low", "high")
    for end in ("low", "high"):
        rest = rest.join(roots.select(F.col("node").alias(end), F.col("root").alias(f"to_{end}")), end, "left")
    rest = rest.where(F.coalesce("to_low", "low") != F.coalesce("to_high", "high"))
    rest = cut_lineage(rest.select("a", "b"), "rest")
    return links if rest.isEmpty() else links.unionByName(verified(rest, texts, classes, share))


def verified(pairs: DataFrame, texts: DataFrame, classes: DataFrame, share: tuple[int, int]) -> DataFrame:
    """``pairs``, already written, whose sets are similar enough. One text of each class that is needed is read again."""
    nodes = pairs.select(F.col("a").alias("name")).unionByName(pairs.select(F.col("b").alias("name"))).distinct()
    wanted = classes.join(nodes, "name", "left_semi").select("sample.*")
    rows = texts.select(*sample_of(), "text")
    made = sets(lookup_join(rows, wanted, ["unknown", "of", "digest"], "left_semi"))
    # both ends read one shuffle of the sets
    held = made.groupBy("name").agg(F.first("hashes").alias("hashes")).withColumnRenamed("name", "of")
    for end in ("a", "b"):
        # a class of many pairs is a skewed partition of them, which its one set is joined to in parts
        pairs = pairs.join(held.select(F.col("of").alias(end), F.col("hashes").alias(f"of_{end}")), end)
    both = pairs.withColumn("shared", F.size(F.array_intersect("of_a", "of_b")).cast("long"))
    either = F.size("of_a") + F.size("of_b") - F.col("shared")
    return both.where(F.col("shared") * share[1] >= either * share[0]).select("a", "b")


def sample_of() -> list[Column]:
    """What tells a row from all others, but for rows that repeat it."""
    return [F.col("id").isNull().alias("unknown"), F.xxhash64("id").alias("of"), F.col("digest")]


def joined(found: DataFrame, texts: DataFrame, share: tuple[int, int] = SHARE, every: bool = False) -> tuple[DataFrame, DataFrame]:
    """(classes, links (a, b)) of written ``prefixes`` of ``texts``; links enough to connect what is linked, or ``every`` one."""
    classes = found.where("size > 0").groupBy("name").agg(
        F.min("id").alias("id"), F.first("size").alias("size"), F.first("grp").alias("grp"), F.count("*").alias("n"),
        F.min(F.struct(*sample_of())).alias("sample"), F.first("mark").alias("mark"),
    )
    classes = cut_lineage(classes, "classes")
    groups = classes.groupBy("grp").agg(F.min("name").alias("lead"), F.count("*").alias("members"), F.min_by(folded("mark"), "name").alias("mark"))
    groups = cut_lineage(groups, "groups")
    entries = cut_lineage(shared_prefixes(found, share), "prefixes")
    # members of one group are entries under their group's name, at the first place
    crowds = lookup_join(classes, groups.where("members > 1").select("grp"), ["grp"], "left_semi")
    inner = crowds.select(F.col("grp").alias("token"), F.lit(1).alias("place"), "name", "size", folded("mark").alias("mark"))
    links = classes.select(F.col("name").alias("a"), F.col("name").alias("b")).limit(0)
    first = cut_lineage(first_of(entries).join(groups.select("grp", "mark"), "grp"), "first")
    for turn in range(ROUNDS + 1):
        members = cut_lineage(rooted(classes, links).select("grp", "name", "root"), "members")
        bounds = members.groupBy("grp").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        within = inner.join(members.select("name", "root"), "name")
        if every or turn == ROUNDS:
            break
        near = neighbours(first.join(bounds, "grp"), share, turn)
        for end in ("a", "b"):
            near = near.join(groups.select(F.col("grp").alias(end), F.col("lead").alias(f"lead_{end}")), end)
        alone = within.withColumnsRenamed({"name": "grp", "root": "low"}).withColumn("high", F.col("low"))
        near = near.select(F.least("lead_a", "lead_b").alias("a"), F.greatest("lead_a", "lead_b").alias("b"))
        near = cut_lineage(near.unionByName(neighbours(alone, share, turn)).distinct(), "pairs")
        found_links = cut_lineage(checked(near, texts, classes, share), "links")
        if found_links.isEmpty():
            break
        links = links.unionByName(found_links)
    held = cut_lineage(entries.join(bounds, "grp"), "bounds")
    apart = held.groupBy("token").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low <> high").select("token")
    outer = held.join(apart, "token", "left_semi").select("token", "place", "grp", "size")
    own = classes.select("name", folded("mark").alias("mark")).join(members, "name")
    outer = outer.join(own, "grp").select("token", "place", "name", "size", "root", "mark")
    # members of one group whose components differ meet under their group's name
    unlike = bounds.where("low <> high").select(F.col("grp").alias("token"))
    inside = within.join(unlike, "token", "left_semi").select("token", "place", "name", "size", "root", "mark")
    pairs = cut_lineage(across(cut_lineage(outer.unionByName(inside), "met"), share), "pairs")
    last = checked(pairs, texts, classes, share, None if every else members)
    return classes, links.unionByName(cut_lineage(last, "links"))


def rooted(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``classes`` with the name of their component."""
    roots = connected(links)
    return classes.join(roots, classes["name"] == roots["node"], "left").withColumn("root", F.coalesce("root", "name"))


def linked(docs: DataFrame, id_col: str = "doc_id", text: str = "text", share: tuple[int, int] = SHARE) -> tuple[DataFrame, DataFrame]:
    """(membership (id, size, name), links (a, b)): each document's class, and all links between different classes."""
    texts = texts_of(docs, id_col, text)
    found = cut_lineage(prefixes(texts, share), "named")
    _, links = joined(found, texts, share, every=True)
    return found.select("id", "size", "name"), links


def components(docs: DataFrame, id_col: str = "doc_id", text: str = "text", share: tuple[int, int] = SHARE) -> DataFrame:
    """(id, size, component, n_copies) of every document: the smallest id reachable by links, the documents with the same set."""
    texts = texts_of(docs, id_col, text)
    found = cut_lineage(prefixes(texts, share), "named")
    classes, links = joined(found, texts, share)
    named = cut_lineage(rooted(classes, links).select("name", "id", "root", "n"), "rooted")
    least = named.groupBy("root").agg(F.min("id").alias("component"))
    # both lookups grow with the corpus; a component or a set that a third of all rows have is split as a skewed partition
    by_name = named.select("name", "root", F.col("n").alias("n_copies")).join(least, "root").drop("root")
    some = found.where("size > 0").select("id", "size", "name").join(by_name, "name")
    none = found.where("size = 0").select("id", "size", F.col("id").alias("component"), F.lit(1).cast("long").alias("n_copies"))
    return some.select("id", "size", "component", "n_copies").unionByName(none)
