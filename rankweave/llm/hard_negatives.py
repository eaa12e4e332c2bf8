"""Hard negatives: rows of other labels that score almost as well as an anchor's positives, found over rotated one-bit codes.

A vector x is rotated (signs and Walsh-Hadamard, three times) and keeps one bit per dimension: its code c, a unit vector of
signs. Stored beside the code are the norm of x and its alignment a = <x, c>, so x = a c + r with r at right angles to c and
|r|^2 = |x|^2 - a^2. A query is rotated alike and rounded to ``PLANES`` bits a dimension; s = <q, c> comes from popcounts of its
bit planes with the code, off by at most the norm e of what rounding lost. Then <q, x> = a s + <q - s c, r>, and by Cauchy and
Schwarz the last term is at most sqrt(|q|^2 - s^2) sqrt(|x|^2 - a^2). These intervals always hold the score. Rows whose
interval cannot reach the k-th best so far, or the wanted window of scores, are left out; all others are scored in integers.
Positives are looked for among an anchor's label only. Anchors are a fixed share of the rows, so the work grows with the
square of their number; it is spread over tasks, and a task holds ``CELLS`` (anchor, row) cells at once.

Rows are never shuffled for a search: blocks of anchors are broadcast, and a task hands on a few rows per anchor.

Defined results: rows without an id, a label, a vector, or with a null or non-finite component take no part; an id that
occurs repeatedly counts once, with its smallest (label, vector); shorter vectors are padded with zeros; equal scores go by
smaller id; scores are exact integers up to 2**53 and beyond that rounded to a double, within the range of a long; an anchor
with fewer rows than asked for gives what it has; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.functions.kernels import matrix_of
from rankweave.plans.bounds import broadcast_rows, by_query_block, top_k
from rankweave.session import cut_lineage

SCALE = 256
ANCHOR_EVERY = 50
POSITIVES = 5
NEGATIVES = 3
# Negatives score from LOW[0] / LOW[1] to HIGH[0] / HIGH[1] of their positive.
LOW, HIGH = (50, 100), (95, 100)
PLANES = 6
ROUNDS = 3
SEED = 20
PAIRS_PER_STEP = 1 << 15
# (anchor, row) cells compared at once: a few arrays of them stay in a processor's cache.
CELLS = 1 << 18
# From this share of cells on all are multiplied as matrices rather than the chosen ones as pairs.
DENSE = 0.05
EXACT = 2.0**53


def rotated(vectors: np.ndarray) -> np.ndarray:
    """An orthonormal map of the rows, padded to a power of two of at least 64; a constant of the width."""
    width = max(64, 1 << max(vectors.shape[1] - 1, 0).bit_length())
    out = np.zeros((len(vectors), width))
    out[:, : vectors.shape[1]] = vectors
    sign = np.random.default_rng(SEED).choice([-1.0, 1.0], (ROUNDS, width))
    for turn in range(ROUNDS):
        out *= sign[turn]
        half = 1
        while half < width:
            pair = out.reshape(len(out), width // (2 * half), 2, half)
            pair[:, :, 0], pair[:, :, 1] = pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]
            half *= 2
        out /= np.sqrt(width)
    return out


def packed(bits: np.ndarray) -> np.ndarray:
    """(..., width) zeros and ones as 64-bit words."""
    return np.packbits(bits, axis=-1, bitorder="little").view(np.uint64)


def coded(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code words, alignment with the code and norm of each row."""
    turned = rotated(vectors)
    align = np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])
    return packed(turned >= 0), align, np.sqrt((vectors * vectors).sum(axis=1))


class Planes:
    """Queries cut into bit planes."""

    def __init__(self, vectors: np.ndarray):
        turned = rotated(vectors)
        self.width = turned.shape[1]
        self.low = turned.min(axis=1, initial=0.0)
        self.step = (turned.max(axis=1, initial=0.0) - self.low) / ((1 << PLANES) - 1)
        safe = np.where(self.step > 0, self.step, 1.0)
        level = np.round((turned - self.low[:, None]) / safe[:, None]).astype(np.uint64)
        rounded = self.low[:, None] + self.step[:, None] * level
        self.lost = np.sqrt(((turned - rounded) ** 2).sum(axis=1))
        self.norm = np.sqrt((vectors * vectors).sum(axis=1))
        self.sum = level.sum(axis=1).astype(np.float64)
        self.planes = [packed((level >> np.uint64(p)) & np.uint64(1) > 0) for p in range(PLANES)]

    def interval(self, code: np.ndarray, align: np.ndarray, norm: np.ndarray, some: np.ndarray | slice = slice(None)) -> tuple[np.ndarray, np.ndarray]:
        """query x row: bounds that hold every inner product, for ``some`` of the queries."""
        ones = np.bitwise_count(code).sum(axis=1, dtype=np.int64)
        lowest, step, total, lost, length = (x[some, None] for x in (self.low, self.step, self.sum, self.lost, self.norm))
        hits = np.zeros((len(lowest), len(code)), np.int32)
        for p, plane in enumerate(self.planes):
            for w in range(code.shape[1]):
                hits += np.bitwise_count(plane[some, w, None] & code[None, :, w]).astype(np.int32) << p
        toward = lowest * (2.0 * ones - self.width) + step * (2.0 * hits - total)
        toward /= np.sqrt(self.width)
        least = np.maximum(np.abs(toward) - lost, 0.0)
        aside = np.sqrt(np.maximum(length**2 - least**2, 0.0))
        rest = np.sqrt(np.maximum(norm**2 - align**2, 0.0))
        slack = 1e-7 * length * norm + 1e-3  # far above what rounding of doubles can add up to
        reach = align * lost + aside * rest + slack
        middle = align * toward
        return middle - reach, middle + reach


def scores(a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> np.ndarray:
    """Inner products of the chosen rows, of whole numbers held as doubles."""
    out = np.empty(len(at_a))
    for k in range(0, len(out), PAIRS_PER_STEP):
        some = slice(k, k + PAIRS_PER_STEP)
        out[some] = np.einsum("ij,ij->i", a[at_a[some]], b[at_b[some]])
    return out


def chosen_scores(a: np.ndarray, b: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """a x b: inner products of the ``chosen`` cells, NaN in the others."""
    longest = (np.sqrt((x * x).sum(axis=1)).max(initial=0.0) for x in (a, b))
    # below 2**53 all sums of whole numbers are exact, in any order
    if np.prod(list(longest)) < EXACT / 2 and chosen.mean() > DENSE:
        out = a @ b.T
        out[~chosen] = np.nan
        return out
    out = np.full(chosen.shape, np.nan)
    row, at = np.nonzero(chosen)
    out[row, at] = scores(a, b, row, at)
    return out


def within(positive: np.ndarray, negative: np.ndarray) -> np.ndarray:
    """Whether the negative's score lies in the window of the positive's; exact up to 2**53."""

    def compare(p, n):
        return (p * LOW[0] <= n * LOW[1]) & (n * HIGH[1] <= p * HIGH[0])

    plain = np.maximum(np.abs(positive), np.abs(negative)) <= EXACT
    whole = compare(np.where(plain, positive, 0).astype(np.int64), np.where(plain, negative, 0).astype(np.int64))
    return np.where(plain, whole, compare(positive, negative))


def kth(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row, -inf in rows with fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(values, -k, axis=1)[:, -k]


class Best:
    """The best ``k`` (score down, id up) per slot, as flat arrays."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.slot, self.id, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self.least = np.full(slots, -np.inf)

    def push(self, slot: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        near = score >= self.least[slot]
        slot = np.concatenate((self.slot, slot[near]))
        ids, score = np.concatenate((self.id, ids[near])), np.concatenate((self.score, score[near]))
        order = np.lexsort((ids, -score, slot))
        slot, ids, score = slot[order], ids[order], score[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot)
        keep = place < self.k
        last = place == self.k - 1
        self.least[slot[last]] = score[last]
        self.slot, self.id, self.score = slot[keep], ids[keep], score[keep]


def whole(values: np.ndarray) -> pa.Array:
    return pa.array(np.clip(values, -(2.0**63), 2.0**63 - 1024).astype(np.int64))


class Anchors:
    """A block of anchors, read from its broadcast."""

    def __init__(self, payload: bytes):
        table = pa.ipc.open_stream(payload).read_all()
        self.ids = table["query_id"].to_numpy()
        self.label = table["label"].to_numpy()
        self.vectors = matrix_of(table["vector"])
        self.planes = Planes(self.vectors)
        self.table = table

    def codes(self, batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        """(ids, labels, vectors, code words, align, norm) of rows."""
        ids = batch.column("vec_id").to_numpy()
        code = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint64).reshape(len(ids), -1)
        return ids, batch.column("label").to_numpy(), matrix_of(batch.column("vector")), code, batch.column("align").to_numpy(), batch.column("norm").to_numpy()


def positives_task(shared, k: int):
    """Partition function: each anchor's best ``k`` rows of its label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(shared.value)
        if not len(anchors.ids):
            return
        best = Best(len(anchors.ids), k)
        order = np.argsort(anchors.label, kind="stable")
        kinds, cut = np.unique(anchors.label[order], return_index=True)
        owners = dict(zip(kinds.tolist(), np.split(order, cut[1:])))
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, label, vectors, code, align, norm = anchors.codes(batch)
            by_label = np.argsort(label, kind="stable")
            kinds, cut = np.unique(label[by_label], return_index=True)
            for kind, rows in zip(kinds.tolist(), np.split(by_label, cut[1:])):
                mine = owners.get(kind)
                size = max(64, CELLS // len(mine)) if mine is not None else len(rows)
                for some in (rows[j : j + size] for j in range(0, len(rows), size) if mine is not None):
                    low, high = anchors.planes.interval(code[some], align[some], norm[some], mine)
                    other = anchors.ids[mine, None] != ids[None, some]  # an anchor is no partner of itself
                    floor = np.maximum(best.least[mine], kth(np.where(other, low, -np.inf), k))
                    row, at = np.nonzero(other & (high >= floor[:, None]))
                    best.push(mine[row], ids[some[at]], scores(anchors.vectors, vectors, mine[row], some[at]))
        yield pa.record_batch(
            [pa.array(anchors.ids[best.slot]), pa.array(best.id), whole(best.score)], ["query_id", "positive_id", "positive_score"]
        )

    return run


def negatives_task(shared, k: int):
    """Partition function: each (anchor, positive)'s best ``k`` rows of other labels in the window of the positive's score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(shared.value)
        if not len(anchors.ids):
            return
        offers = anchors.table["positives"].combine_chunks()
        count = offers.value_lengths().to_numpy(zero_copy_only=False)
        flat = offers.flatten()
        positive_id = flat.field("positive_id").to_numpy(zero_copy_only=False)
        positive = flat.field("positive_score").to_numpy(zero_copy_only=False).astype(np.float64)
        owner = np.repeat(np.arange(len(count)), count)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        best = Best(len(owner), k)
        slack = np.abs(positive) * 1e-9 + 1e-3  # the exact window is checked on what is left
        lowest, highest = positive * (LOW[0] / LOW[1]) - slack, positive * (HIGH[0] / HIGH[1]) + slack
        slots = [np.flatnonzero(place == turn) for turn in range(int(count.max(initial=0)))]  # a slot of each anchor in turn
        upmost = np.full(len(anchors.ids), -np.inf)
        np.maximum.at(upmost, owner, highest)
        size = max(64, CELLS // len(anchors.ids))
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, label, vectors, code, align, norm = anchors.codes(batch)
            for some in (slice(j, j + size) for j in range(0, len(ids), size)):
                low, high = anchors.planes.interval(code[some], align[some], norm[some])
                floor = np.maximum(best.least, lowest)
                least = np.full(len(anchors.ids), np.inf)
                np.minimum.at(least, owner, floor)
                reach = (anchors.label[:, None] != label[None, some]) & (high >= least[:, None]) & (low <= upmost[:, None])
                score = chosen_scores(anchors.vectors, vectors[some], reach)
                found = []
                for slot in slots:
                    value = score[owner[slot]]
                    mine, column = np.nonzero((value >= floor[slot, None]) & (value <= highest[slot, None]))
                    value = value[mine, column]
                    fits = within(positive[slot[mine]], value)
                    found.append((slot[mine[fits]], ids[some][column[fits]], value[fits]))
                if found:
                    best.push(*(np.concatenate(x) for x in zip(*found)))
        yield pa.record_batch(
            [
                pa.array(anchors.ids[owner[best.slot]]), pa.array(positive_id[best.slot]), whole(positive[best.slot]),
                pa.array(best.id), whole(best.score),
            ],
            ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"],
        )

    return run


def usable(vector: Column) -> Column:
    """Neither null nor with a null or non-finite component."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def index(rows: DataFrame) -> DataFrame:
    """(vec_id, label, vector, code, align, norm) of ``rows`` (vec_id, label, embedding): whole numbers and their codes."""
    known = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("embedding"))
    # from 2**53 on a double is a whole number as it is, and floor to a long could overflow
    number = lambda x: F.when(F.abs(x) < EXACT, F.floor(x).cast("double")).otherwise(x)
    numbers = F.transform("embedding", lambda x: number(x.cast("double") * SCALE))
    slim = rows.where(known).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), numbers.alias("vector")
    )
    once = slim.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row"))
    once = cut_lineage(once.select("vec_id", "row.label", "row.vector"), "vectors")
    width = max(1, once.agg(F.max(F.size("vector"))).first()[0] or 0)
    padded = F.concat("vector", F.array_repeat(F.lit(0.0), F.lit(width) - F.size("vector")))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, align, norm = coded(matrix_of(batch.column("vector")).reshape(batch.num_rows, width))
            more = [pa.array([x.tobytes() for x in code], pa.binary()), pa.array(align), pa.array(norm)]
            yield pa.record_batch([*batch.columns, *more], [*batch.schema.names, "code", "align", "norm"])

    shaped = once.withColumn("vector", F.when(F.size("vector") < width, padded).otherwise(F.col("vector")))
    return cut_lineage(
        shaped.mapInArrow(kernel, "vec_id long, label long, vector array<double>, code binary, align double, norm double"), "codes"
    )


def mined(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """Hard negatives of ``anchors`` (query_id, label, vector) among the ``index`` ``rows``, ranked per anchor and positive."""
    schema = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"

    def run(block: DataFrame, _: int) -> DataFrame:
        shared, _ = broadcast_rows(block)
        local = rows.mapInArrow(positives_task(shared, POSITIVES), "query_id long, positive_id long, positive_score long")
        best = top_k(local, ["query_id"], [F.desc("positive_score"), F.asc("positive_id")], POSITIVES, id_col="positive_id")
        offers = best.groupBy("query_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
        # at most POSITIVES per anchor of the block
        offered, _ = broadcast_rows(block.join(offers, "query_id"))
        found = rows.mapInArrow(negatives_task(offered, NEGATIVES), schema)
        order = [F.desc("negative_score"), F.asc("negative_id")]
        return top_k(found, ["anchor_id", "positive_id"], order, NEGATIVES, id_col="negative_id")

    return by_query_block(anchors, run, text=None)


def hard_negatives(rows: DataFrame, every: int = ANCHOR_EVERY) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows whose id ``every`` divides."""
    coded_rows = index(rows)
    anchors = coded_rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "label", "vector")
    return mined(coded_rows, anchors).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
