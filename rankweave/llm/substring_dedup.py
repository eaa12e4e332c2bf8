"""Removal of word sequences that also start in an earlier document, behind a count-min prefilter.

A window is ``width`` consecutive words of one document. A word goes if some window over it has the same
words as a window of a document with a smaller id. Windows are compared by 96 hash bits.

1. Sketch. Each slice of documents lists the sketch cells of its windows (a window of two documents of the
   slice counts twice) as packed gaps; tasks merge the lists per block of cells and keep one bit per cell,
   "counted at least twice", in a file that workers map. A window's estimate is the least of its cells, so
   it can only be too high: no repeated window is lost. The sketch has two cells per expected window in each
   row at every size of the corpus: blocks of cells grow in number, and a slice visits those it has windows
   in, one after the other. ``max_cells`` bounds a row for a caller who has less room; more single windows
   then pass the filter, with the same result.
2. Exact pass. Windows estimated as repeated are resolved inside their slice first: only the earliest
   document of the slice still has to be compared, so a window that millions of documents share sends one
   row per slice and no key is hot. Rows meet by hash, sorted by document; all but the earliest are covered.
3. Covered spans are gathered per document and its words outside them are kept.

Null texts have no words; fewer than ``width`` words make no window. Documents with the same id never cover
each other; repeated rows get equal results. A null id counts as later than all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.llm import words
from rankweave.llm.shards import Shards
from rankweave.session import scratch_path

WIDTH = 50
ROWS = 2
BLOCK_CELLS = 1 << 24
# Text that is cut into words as Python objects at once.
CUT_BYTES = 1 << 20
LAST = (1 << 63) - 1
WORD_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
WINDOW_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
SPANS = "id long, digest int, start int, end int"


def windows(part: pa.RecordBatch, text: str, width: int) -> tuple[np.ndarray, ...]:
    """(first hash, second hash, row, position in the row) of every window of a batch."""
    hashes, first = words.word_hashes(part.column(text), bases=WORD_BASES)
    n = np.maximum(np.diff(first) - width + 1, 0)
    row = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    start = first[row] + at
    both = [words.mix(words.spans_hash(h, start, start + width, b)) for h, b in zip(hashes, WINDOW_BASES)]
    return both[0], both[1] >> np.uint64(32), row, at


def cells(window: np.ndarray, row: int, n_cells: int) -> np.ndarray:
    salted = words.mix(window + np.uint64(row) * np.uint64(0x9E3779B97F4A7C15))
    return (salted & np.uint64(n_cells - 1)).astype(np.int64)


def by_document(first: np.ndarray, second: np.ndarray, id_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (window, id) and, in that order, whether a row has its window's earliest document."""
    order = np.lexsort((id_of, second, first))
    a, b, d = first[order], second[order], id_of[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    group = np.cumsum(new) - 1
    return order, d == d[np.flatnonzero(new)][group] if len(d) else new


def sketch(docs: DataFrame, store: Shards, n_cells: int, block_cells: int, width: int) -> None:
    """Write, for each block of cells of each row, one bit per cell: counted at least twice."""
    blocks = n_cells // block_cells

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for part in words.slices(batch, "text"):
                window, second, row, _ = windows(part, "text", width)
                if not len(window):
                    continue
                doc = part.column("id").to_numpy()[row]
                order, earliest = by_document(window, second, doc)
                window = window[order]
                # one entry for the earliest document, one more if there are others
                new = np.ones(len(window), bool)
                new[1:] = (window[1:] != window[:-1]) | (second[order][1:] != second[order][:-1])
                other = np.maximum.reduceat(~earliest, np.flatnonzero(new))
                listed = np.concatenate((window[new], window[new][other]))
                for sketch_row in range(ROWS):
                    cell = np.sort(cells(listed, sketch_row, n_cells))
                    block = cell // block_cells
                    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(cell)]
                    ids, data = [], []
                    for a, b in zip(cuts, cuts[1:]):
                        inside = cell[a:b] - block[a] * block_cells
                        gaps = np.diff(inside, prepend=0).astype("<u4")
                        ids.append(sketch_row * blocks + int(block[a]))
                        # byte planes: the high ones are almost all zero
                        data.append(pack.compress(np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 4).T).tobytes()))
                    yield pa.record_batch([pa.array(ids, pa.int32()), pa.array(data, pa.binary())], ["block", "gaps"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        count, current = None, None

        def done():
            store.write(f"block/{current}", np.packbits(count >= 2, bitorder="little"))
            return pa.record_batch([pa.array([int((count >= 2).sum())])], ["repeated"])

        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if block != current:
                    if current is not None:
                        yield done()
                    current, count = block, np.zeros(block_cells, np.uint8)
                planes = np.frombuffer(unpack.decompress(data), np.uint8).reshape(4, -1)
                at = np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.int64)
                count[at] = np.minimum(count[at], 1) + 1
                count[at[1:][np.diff(at) == 0]] = 2
        if current is not None:
            yield done()

    listed = docs.mapInArrow(lists, "block int, gaps binary")
    merged = listed.repartition(ROWS * blocks, "block").sortWithinPartitions("block")
    merged.mapInArrow(merge, "repeated long").agg(F.sum("repeated")).collect()


def estimated_repeated(window: np.ndarray, store: Shards, n_cells: int, block_cells: int) -> np.ndarray:
    blocks = n_cells // block_cells
    held = np.arange(len(window))  # windows that all rows so far estimate as repeated
    for row in range(ROWS):
        cell = cells(window[held], row, n_cells)
        order = np.argsort(cell)
        held, cell = held[order], cell[order]
        block = cell // block_cells
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(cell)] if len(cell) else [0]
        again = np.zeros(len(cell), bool)
        for a, b in zip(cuts, cuts[1:]):
            bits = store.read(f"block/{row * blocks + int(block[a])}", np.uint8)
            inside = cell[a:b] - block[a] * block_cells
            if len(bits):
                again[a:b] = (bits[inside >> 3] >> (inside & 7).astype(np.uint8)) & 1
        held = held[again]
    found = np.zeros(len(window), bool)
    found[held] = True
    return found


def runs(row: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows and word spans covered by windows given in order of (row, position), touching ones joined."""
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (at[1:] > at[:-1] + width)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(row))[: len(begin)] - 1
    return row[begin], at[begin], at[end] + width


def candidates(docs: DataFrame, store: Shards, n_cells: int, block_cells: int, width: int) -> DataFrame:
    """Windows to compare between slices (``done`` false), and spans already known to be covered."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, "text"):
                window, second, row, at = windows(part, "text", width)
                again = estimated_repeated(window, store, n_cells, block_cells)
                window, second, row, at = window[again], second[again], row[again], at[again]
                if not len(row):
                    continue
                doc, digest = part.column("id").to_numpy(), part.column("digest").to_numpy()
                order, earliest = by_document(window, second, doc[row])
                covered = np.sort(order[~earliest])
                span_row, start, end = runs(row[covered], at[covered], width)
                # the earliest document's windows still meet those of other slices
                open_ = np.sort(order[earliest])
                key = np.concatenate((window[open_], words.mix(doc[span_row].view(np.uint64))))
                yield pa.record_batch(
                    [
                        pa.array(key.view(np.int64)),
                        pa.array(np.concatenate((second[open_], np.zeros(len(start), np.uint64))).astype(np.int64)),
                        pa.array(np.concatenate((doc[row[open_]], doc[span_row]))),
                        pa.array(np.concatenate((digest[row[open_]], digest[span_row]))),
                        pa.array(np.concatenate((at[open_], start)).astype(np.int32)),
                        pa.array(np.concatenate((np.zeros(len(open_), np.int64), end)).astype(np.int32)),
                    ],
                    ["first", "second", "id", "digest", "start", "end"],
                )

    return docs.mapInArrow(kernel, "first long, second long, id long, digest int, start int, end int")


def covered_spans(rows: DataFrame, width: int) -> DataFrame:
    """Spans covered by a window of an earlier document; ``rows`` of one window meet in one sorted run."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            first, second, doc, digest, start, end = [batch.column(k).to_numpy() for k in range(6)]
            new = np.ones(len(first), bool)
            new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
            if last is not None and len(first):
                new[0] = last[:2] != (first[0], second[0])
            begin = np.flatnonzero(new)
            lead = np.concatenate(([last[2] if last is not None else 0], doc[begin]))
            lead = lead[np.cumsum(new)]
            if len(first):
                last = (first[-1], second[-1], lead[-1])
            keep = (end > 0) | (doc > lead)
            stop = np.where(end > 0, end, start + width)
            columns = [doc[keep], digest[keep], start[keep], stop[keep].astype(np.int32)]
            yield pa.record_batch([pa.array(x) for x in columns], ["id", "digest", "start", "end"])

    # finished spans (end > 0) must not lead a group: they sort behind the open windows of an equal key
    met = rows.repartition("first").sortWithinPartitions("first", "second", "end", "id")
    return met.mapInArrow(kernel, SPANS)


def dedup(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = WIDTH,
    max_cells: int | None = None, block_cells: int = BLOCK_CELLS,
) -> DataFrame:
    """(doc, n_words, n_removed, kept): all columns of ``docs`` as a struct, and its kept words joined by one space."""
    whole, place, _ = words.documents(docs, docs.columns, text)
    keyed = whole.select(
        "doc",
        F.coalesce(F.col("doc")[id_col].cast("long"), F.lit(LAST)).alias("id"),
        F.hash(F.col("doc")[text]).alias("digest"),
    )
    slim = keyed.select("id", "digest", F.col("doc")[text].alias("text"))
    size = slim.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    wanted = 2 * size / 6 if max_cells is None else min(2 * size / 6, max_cells)
    n_cells = 1 << 16
    while n_cells < wanted:
        n_cells *= 2
    store = Shards(scratch_path(docs.sparkSession, "windows"))
    block_cells = min(block_cells, n_cells)
    sketch(slim.select("id", "text"), store, n_cells, block_cells, width)
    spans = covered_spans(candidates(slim, store, n_cells, block_cells, width), width)
    # touching spans of a text become one before they meet its rows; one row per text, however often it is repeated
    joined = spans.repartition("id", "digest").sortWithinPartitions("id", "digest", "start", "end").mapInArrow(touching, SPANS)
    packed = F.shiftleft(F.col("start").cast("long"), 32).bitwiseOR(F.col("end").cast("long"))
    gathered = joined.groupBy("id", "digest").agg(F.sort_array(F.collect_set(packed)).alias("spans"))
    return cut(keyed.join(gathered, ["id", "digest"], "left").select("doc", "spans"), place)


def touching(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans in order of (text, start), those joined that touch or overlap within a batch."""
    for batch in batches:
        doc, digest, start, end = [batch.column(k).to_numpy() for k in range(4)]
        if not len(doc):
            continue
        text = np.concatenate(([True], (doc[1:] != doc[:-1]) | (digest[1:] != digest[:-1])))
        # the furthest end so far in the same text, by adding a step per text that no position reaches
        shift = np.cumsum(text).astype(np.int64) << 33
        reach = np.maximum.accumulate(end + shift) - shift
        new = text.copy()
        new[1:] |= start[1:] > reach[:-1]
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(doc)) - 1
        yield pa.record_batch(
            [pa.array(doc[first]), pa.array(digest[first]), pa.array(start[first]), pa.array(reach[last].astype(np.int32))],
            ["id", "digest", "start", "end"],
        )


def cut(df: DataFrame, place: tuple[str, str]) -> DataFrame:
    """Take the words inside ``spans`` out of each text."""
    kind = df.schema["doc"].dataType.simpleString()

    def one(value: bytes | None, spans: np.ndarray) -> tuple[int, int, bytes]:
        found = (value or b"").split()
        if not len(spans):
            return len(found), 0, b" ".join(found)
        change = np.zeros(len(found) + 1, np.int64)
        np.add.at(change, spans >> 32, 1)
        np.add.at(change, spans & 0xFFFFFFFF, -1)
        keep = np.cumsum(change)[:-1] == 0
        left = [w for w, k in zip(found, keep.tolist()) if k]
        return len(found), len(found) - len(left), b" ".join(left)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, place, CUT_BYTES):
                texts = words.column(part, place).cast(pa.binary()).to_pylist()
                spans = part.column("spans")
                flat, at = spans.flatten().to_numpy(), 0
                made = []
                for value, many in zip(texts, pc.fill_null(pc.list_value_length(spans), 0).to_pylist()):
                    made.append(one(value, flat[at : at + many]))
                    at += many
                n, gone, left = zip(*made)
                yield pa.record_batch(
                    [part.column("doc"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(left, pa.binary()).cast(pa.string())],
                    ["doc", "n_words", "n_removed", "kept"],
                )

    return df.mapInArrow(kernel, f"doc {kind}, n_words long, n_removed long, kept string")
