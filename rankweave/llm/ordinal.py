"""Quality grades by ordinal regression (cumulative link) on hashed text.

A grade g of 0 .. G-1 has P(grade <= g) = sigmoid(t_g - x.w) with one weight vector w and ordered thresholds
t_0 < t_1 < ... A text's features are its lower-cased words hashed to one range of cells (log(1 + n), times the
log of documents per document with the cell), its byte triples hashed to another (log(1 + n), scaled to length
1), and the share of words that repeat the word before. The expected grade is the sum over g of
P(grade > g), the tail probability P(grade >= tail).

Fitting. All labelled documents are used. Cells in less than ``least_docs`` of them are left out. The features are
written once, where the texts are read; every evaluation broadcasts the weights of the cells left and adds up the loss
and its gradient in as many tasks as the rows need, whose vectors one more task adds up for the driver. L-BFGS takes its
steps there (vectors of fixed size). Scoring is one pass over all documents.

The limit for keeping comes from labels held out of the fit (``fit_with_limit``): the least tail probability that
rejects a wanted share of grade 0. P(grade > 0) rises with the tail probability, both follow from the same x.w, so a
limit on one is a limit on the other. Held-out rows are ranked in tasks, and the driver gets the two that set the limit.

Null and empty texts have no features and get the grade of the thresholds alone. Without labelled documents of two
different grades every text gets tail probability 1: nothing is known against it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.llm import words
from rankweave.plans import bounds
from rankweave.plans.ordered import rank_in_groups
from rankweave.session import cut_lineage, settings

WORD_CELLS = 1 << 20
TRIPLE_CELLS = 1 << 16
CELLS = WORD_CELLS + TRIPLE_CELLS + 1
ECHO = CELLS - 1
STEPS = 30
# Text whose features, and features whose gradient, are held at once (a document's features always are).
SLICE_BYTES = 1 << 20
SLICE_FEATURES = 1 << 18
# Rows and bytes of features that a worker is sent at once.
BATCH_ROWS = 1_000
BATCH_BYTES = 16 << 20
# Tasks of an evaluation: at least, and one for so many rows.
TASKS = 8
TASK_ROWS = 100_000
HELD_OUT = 5
# Share of the held-out rows of the best grade that a limit must keep.
GOOD_RECALL = 0.97
WORD_SCALE, TRIPLE_SCALE, ECHO_SCALE = 0.3, 10.0, 3.0


def features(part: pa.RecordBatch, text: str | tuple[str, str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell, value) of a batch, in order of row; words and triples not yet weighed."""
    (hashes,), first = words.word_hashes(words.column(part, text), lower=True)
    n = part.num_rows
    per_row = np.diff(first)
    word_row = np.repeat(np.arange(n), per_row)
    row, cell, value = counted(word_row, (hashes >> np.uint64(20)).astype(np.int64) % WORD_CELLS)
    found = [(row, cell, value)]
    data, starts = words.joined(words.column(part, text))
    raw = np.frombuffer(data, np.uint8).astype(np.uint32)
    if len(raw) > 2:
        triple = (raw[:-2] << np.uint32(16)) | (raw[1:-1] << np.uint32(8)) | raw[2:]
        cell = ((triple * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64)
        row, cell, value = counted(np.repeat(np.arange(n), np.diff(starts))[:-2], cell)
        length = np.sqrt(np.bincount(row, value * value, n))
        found.append((row, cell + WORD_CELLS, value / length[row]))
    echo = np.concatenate(([False], (hashes[1:] == hashes[:-1]) & (word_row[1:] == word_row[:-1]))) if len(hashes) else np.zeros(0)
    found.append((np.arange(n), np.full(n, ECHO), np.bincount(word_row, echo, n) / np.maximum(per_row, 1)))
    row, cell, value = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(row, kind="stable")
    return row[order], cell[order], value[order]


def counted(row: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    key, count = np.unique(row * np.int64(1 << 24) + cell, return_counts=True)
    return key >> 24, key & ((1 << 24) - 1), np.log1p(count)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass(frozen=True)
class Grader:
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, part: pa.RecordBatch, text: str | tuple[str, str]) -> np.ndarray:
        """P(grade > g) per text and g."""
        row, cell, value = features(part, text)
        x = np.bincount(row, value * self.weights[cell], part.num_rows)
        return 1 - sigmoid(self.thresholds[None, :] - x[:, None])


def slope(weights, thresholds, row, cell, value, grade, weight) -> tuple[np.ndarray, np.ndarray, float]:
    """Gradients of the negative log likelihood, and the loss."""
    n = len(grade)
    x = np.bincount(row, value * weights[cell], n)
    edge = np.concatenate(([-np.inf], thresholds, [np.inf]))
    with np.errstate(over="ignore"):
        up, down = sigmoid(edge[grade + 1] - x), sigmoid(edge[grade] - x)
    p = np.maximum(up - down, 1e-12)
    d_up, d_down = up * (1 - up), down * (1 - down)
    by_x = weight * (d_up - d_down) / p
    g_weights = np.bincount(cell, value * by_x[row], len(weights))[: len(weights)]
    g_thresholds = np.bincount(grade, -weight * d_up / p, len(thresholds) + 1)[:-1]
    g_thresholds += np.bincount(grade, weight * d_down / p, len(thresholds) + 1)[1:]
    return g_weights, g_thresholds, float(-(weight * np.log(p)).sum())


def minimised(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, steps: int, memory: int = 8) -> np.ndarray:
    """Limited-memory BFGS with step halving."""
    value, slope = loss(x)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        direction, shares = slope.copy(), []
        for s, y in reversed(moves):
            shares.append(s @ direction / (y @ s))
            direction -= shares[-1] * y
        direction *= moves[-1][0] @ moves[-1][1] / (moves[-1][1] @ moves[-1][1]) if moves else 1 / max(np.abs(slope).sum(), 1e-12)
        for (s, y), share in zip(moves, reversed(shares)):
            direction += s * (share - y @ direction / (y @ s))
        size = 1.0
        while True:
            there = x - size * direction
            new_value, new_slope = loss(there)
            if new_value <= value - 1e-4 * size * (slope @ direction) or size < 1e-3:
                break
            size /= 2
        if (there - x) @ (new_slope - slope) > 1e-12:
            moves = [*moves, (there - x, new_slope - slope)][-memory:]
        gain = value - new_value
        x, value, slope = there, new_value, new_slope
        if gain < 1e-6 * abs(value):
            break
    return x


def graded_rows(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", sample: int | None = None
) -> DataFrame:
    """(id, text, grade) of all labelled documents, or about ``sample`` of them: grade 0 toxic, 1 poor, 2 good.

    ``labels`` (doc_id, quality, toxic) with missing values give no grade; of several of a document the lowest counts.
    """
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    worst = labels.select(F.col("doc_id").alias("id"), grade.alias("grade")).groupBy("id").agg(F.min("grade").alias("grade"))
    worst = cut_lineage(worst.where("grade is not null and id is not null"), "grades")
    total = worst.count()
    if sample is not None and sample < total:
        # those with the smallest hashes of their ids
        worst, total = worst.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int((1 << 30) * sample / total)), sample
    texts = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    if total <= bounds.BROADCAST_ROWS:
        return texts.join(F.broadcast(worst), "id")
    # texts are shuffled once and not sorted: a task holds its share of the labels while they pass by
    return cut_lineage(texts.join(worst.hint("shuffle_hash"), "id"), "graded")


def as_bytes(cuts: np.ndarray, numbers: np.ndarray) -> pa.Array:
    """Numbers between ``cuts`` as the bytes of a row."""
    ends = (cuts * numbers.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(numbers))])


def of_bytes(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """(how many in each row, numbers of all rows)."""
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int32)[column.offset : column.offset + len(column) + 1]
    numbers = np.frombuffer(data if data is not None else b"", np.uint8)[ends[0] : ends[-1]].view(kind)
    return np.diff(ends) // numbers.itemsize, numbers


def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of features in order, ``SLICE_FEATURES`` features or one row at a time."""
    ends = np.cumsum(of_bytes(batch.column("cell"), np.int32)[0]) if batch.num_rows else []
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, before + SLICE_FEATURES, side="right")))
        yield batch.slice(at, upto - at)
        at = upto


def vector(numbers: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array([numbers.tobytes()], pa.binary())], ["sums"])


def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One vector, the sum of all."""
    total = sum(np.frombuffer(sums.as_buffer(), np.float64) for batch in batches for sums in batch.column("sums"))
    if isinstance(total, np.ndarray):
        yield vector(total)


def summed(rows: DataFrame, n: int, sums: Callable) -> np.ndarray:
    """The sum of the vectors that ``sums`` makes of parts of the ``n`` rows; the driver gets this one only.

    The parts are as many as the rows need, however many the files are read in. Their vectors are shuffled to one task, and
    these files go at once.
    """
    parts = rows.coalesce(max(TASKS, -(-n // TASK_ROWS))).mapInArrow(sums, "sums binary")
    limits = {
        "spark__sql__execution__arrow__maxRecordsPerBatch": str(BATCH_ROWS),
        "spark__sql__execution__arrow__maxBytesPerBatch": str(BATCH_BYTES),
        "spark__sql__classic__shuffleDependency__fileCleanup__enabled": "true",
    }
    with settings(rows.sparkSession, **limits):
        (row,) = parts.repartition(1).mapInArrow(added, "sums binary").collect()
    return np.frombuffer(row["sums"], np.float64)


def fit(graded: DataFrame, grades: int, steps: int = STEPS, balance: float = 0.5, decay: float = 1e-3, least_docs: int = 5) -> Grader | None:
    """Fit on all rows of ``graded`` (text, grade from 0 to ``grades`` - 1).

    A grade's rows count as (rows / (grades x rows of it)) ** ``balance`` each.
    """
    spark = graded.sparkSession

    def to_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, "text", SLICE_BYTES):
                row, cell, value = features(part, "text")
                cuts = np.searchsorted(row, np.arange(part.num_rows + 1))
                yield pa.record_batch(
                    [part.column("grade"), as_bytes(cuts, cell.astype(np.int32)), as_bytes(cuts, value.astype(np.float32))],
                    ["grade", "cell", "value"],
                )

    # arrays of numbers as their bytes, which Spark copies whole
    schema = "grade int, cell binary, value binary"
    source = graded.select(F.col("text"), F.col("grade").cast("int").alias("grade"))
    rows = cut_lineage(source.mapInArrow(to_features, schema), "features")
    n = rows.count()
    if not n:
        return None

    def counted_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(CELLS + grades)
        for batch in batches:
            for some in pieces(batch):
                count[:CELLS] += np.bincount(of_bytes(some.column("cell"), np.int32)[1], minlength=CELLS)
                count[CELLS:] += np.bincount(some.column("grade").to_numpy(), minlength=grades)
        yield vector(count)

    sums = summed(rows, n, counted_cells)  # a document has a cell once
    held, count = sums[:CELLS], sums[CELLS:]
    if (count > 0).sum() < 2:
        return None
    cells = np.flatnonzero(held >= least_docs)
    size = len(cells)
    scale = np.where(cells < WORD_CELLS, WORD_SCALE * np.log(n / np.maximum(held[cells], 1)), TRIPLE_SCALE)
    scale[cells == ECHO] = ECHO_SCALE
    weight_of = np.array([(n / (grades * c)) ** balance if c else 0.0 for c in count])

    def thresholds_of(z: np.ndarray) -> np.ndarray:
        return np.cumsum(np.concatenate((z[size : size + 1], np.exp(z[size + 1 :]))))

    known = spark.sparkContext.broadcast(cells)

    def loss(z: np.ndarray) -> tuple[float, np.ndarray]:
        sent = spark.sparkContext.broadcast((z[:size] * scale, thresholds_of(z)))

        def gradient(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            some_w, t = sent.value
            w = np.zeros(CELLS)  # cells that are left out weigh nothing
            w[known.value] = some_w
            by_cell, others = np.zeros(CELLS), np.zeros(len(t) + 1)
            for batch in batches:
                for some in pieces(batch):
                    per_row, cell = of_bytes(some.column("cell"), np.int32)
                    _, value = of_bytes(some.column("value"), np.float32)
                    row = np.repeat(np.arange(some.num_rows), per_row)
                    g = some.column("grade").to_numpy()
                    gw, gt, total = slope(w, t, row, cell, value, g, weight_of[g])
                    by_cell += gw
                    others += np.concatenate((gt, [total]))
            yield vector(np.concatenate((by_cell[known.value], others)))

        total = summed(rows, n, gradient) / n
        sent.destroy()  # the driver's copy too, or every evaluation leaves one
        by_step = np.cumsum(total[size:-1][::-1])[::-1].copy()  # a step moves every threshold behind it
        by_step[1:] *= np.exp(z[size + 1 :])
        slope_z = np.concatenate((total[:size] * scale + decay * z[:size], by_step))
        return float(total[-1] + decay / 2 * (z[:size] @ z[:size])), slope_z

    start = np.zeros(size + grades - 1)
    start[size] = -1.0
    z = minimised(loss, start, steps)
    known.destroy()
    weights = np.zeros(CELLS, np.float32)
    weights[cells] = z[:size] * scale
    return Grader(weights, thresholds_of(z))


def scored(docs: DataFrame, grader: Grader | None, tail: int, grades: int, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(doc, expected, tail): expected grade and probability of at least grade ``tail``; doc holds ``keep`` (default: all)."""
    source, place, kind = words.documents(docs, keep if keep is not None else docs.columns, text)
    if grader is None:
        return source.select("doc", F.lit(float(grades - 1)).alias("expected"), F.lit(1.0).alias("tail"))
    sent = docs.sparkSession.sparkContext.broadcast(grader)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, place, SLICE_BYTES):
                above = sent.value.above(part, place)
                yield pa.record_batch(
                    [part.column("doc"), pa.array(above.sum(1)), pa.array(above[:, tail - 1])], ["doc", "expected", "tail"]
                )

    return source.mapInArrow(kernel, f"doc {kind}, expected double, tail double")


class Ranked:
    """Tail probabilities of one grade in ascending order; they stay in ``ranks`` (grade, tail, rank), a place is looked up."""

    def __init__(self, ranks: DataFrame, grade: int, n: int):
        self.rows, self.n = ranks.where(F.col("grade") == grade), n

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, place: int) -> float:
        return self.rows.where(F.col("rank") == place + 1).first()["tail"]


def ascending(tails: np.ndarray | Ranked) -> np.ndarray | Ranked:
    return np.sort(tails) if isinstance(tails, np.ndarray) else tails


def limit_for(tails: np.ndarray | Ranked, recall: float, least: float) -> float:
    """The lowest limit, ``least`` or more, below which this share of ``tails`` is."""
    passing = math.floor((1 - recall) * len(tails) + 1e-9)
    return max(least, float(np.nextafter(ascending(tails)[len(tails) - 1 - passing], np.inf))) if passing < len(tails) else least


def limit_keeping(tails: np.ndarray | Ranked, recall: float, limit: float, least: float) -> float:
    """``limit``, lowered as far as this share of ``tails`` needs to reach it, but not below ``least``."""
    lost = math.floor((1 - recall) * len(tails) + 1e-9)
    return max(least, min(limit, float(ascending(tails)[lost]))) if len(tails) else limit


def fit_with_limit(
    graded: DataFrame, grades: int, tail: int, recall: float, least: float, good_recall: float = GOOD_RECALL
) -> tuple[Grader | None, float]:
    """A fit on all but one in ``HELD_OUT`` rows of ``graded`` (id, text, grade), and a limit chosen by the others.

    The limit rejects ``recall`` of those of grade 0, unless fewer than ``good_recall`` of those of the best grade would
    reach it: few rows of grade 0 say little about where their upper end is, and the limit gives way down to ``least``.
    Rows too few to fit on without the others are all fitted on, and ``least`` is the limit.
    """
    fold = graded.withColumn("_out", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(HELD_OUT)) == 0)
    grader = fit(fold.where("not _out"), grades)
    if grader is None:
        return fit(graded, grades), least
    ends = fold.where("_out").where(F.col("grade").isin(0, grades - 1)).select("id", "text", "grade")
    rows = scored(ends, grader, tail, grades, keep=["grade"]).select("doc.grade", "tail")
    ranks = rank_in_groups(rows, "grade", [F.col("tail")], kind="long")
    count = {r["grade"]: r["n"] for r in ranks.groupBy("grade").agg(F.max("rank").alias("n")).collect()}
    worst, best = (Ranked(ranks, g, count.get(g, 0)) for g in (0, grades - 1))
    return grader, limit_keeping(best, good_recall, limit_for(worst, recall, least), least)


def selected(tail: Column, least: float) -> Column:
    return tail >= least
