"""Arrow kernels for the one thing Spark expressions lack: a matrix product per batch.

Spark partitions the items and feeds Arrow batches. Each task keeps only the best ``k`` rows per query, so
what leaves a task is bounded by (queries in the block) x k, whatever the size of the partition.
This module needs only numpy, pandas and pyarrow and is pickled by value, so workers need not have the package.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CELLS_PER_STEP = 1 << 21
# Scores this close differ by the order of a sum only; they tie and the lower id comes first.
RANK_DIGITS = 10
FACET_NAMES = ("country", "variety", "color")
# (filter column, item column, lower bound?)
RANGE_BOUNDS = (
    ("price_min", "price", True),
    ("price_max", "price", False),
    ("points_min", "points", True),
    ("points_max", "points", False),
)


def matrix_of(column) -> np.ndarray:
    """A list column of equal-length vectors as a float64 matrix, without per-row Python objects."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0))
    width = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    if (width != width[0]).any():
        raise ValueError(f"vectors of {np.nanmin(width):g} to {np.nanmax(width):g} numbers in one column")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64, copy=False).reshape(len(column), -1)


@dataclass
class QueryBlock:
    """A bounded block of queries in column form."""

    ids: np.ndarray
    matrix: np.ndarray
    facets: dict = field(default_factory=dict)  # name -> (value set, code per query; -1 is unset)
    bounds: dict = field(default_factory=dict)  # name -> float per query; NaN is unset
    probes: tuple[np.ndarray, np.ndarray] | None = None  # (list, query) pairs in order of list

    @classmethod
    def read(cls, payload: bytes, filtered: bool, n_lists: int = 0) -> QueryBlock:
        table = pa.ipc.open_stream(payload).read_all()
        vectors = matrix_of(table["qv"]) if "qv" in table.column_names else np.zeros((table.num_rows, 0))
        block = cls(table["query_id"].to_numpy(), vectors)
        if filtered:
            for name in FACET_NAMES:
                if f"f_{name}" not in table.column_names:
                    continue
                wanted = table[f"f_{name}"].combine_chunks()
                values = pc.unique(wanted).drop_null()
                values = values.filter(pc.not_equal(values, ""))  # an empty string is unset too
                codes = pc.fill_null(pc.index_in(wanted, value_set=values), -1)
                block.facets[name] = (values, codes.to_numpy())
            for name, _, _ in RANGE_BOUNDS:
                column = table[f"f_{name}"].cast(pa.float64())
                block.bounds[name] = pc.fill_null(column, float("nan")).to_numpy()
        if n_lists:
            lists = table["probes"].combine_chunks()
            visited = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            query = np.repeat(np.arange(table.num_rows), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
            order = np.argsort(visited, kind="stable")
            block.probes = visited[order], query[order]
        return block

    def eligible(self, batch: pa.Table) -> np.ndarray:
        """query x item mask of the conjunctive filters; a NULL attribute fails a set bound."""
        mask = np.ones((len(self.ids), batch.num_rows), dtype=bool)
        for name, (values, codes) in self.facets.items():
            if (codes >= 0).any():
                found = pc.fill_null(pc.index_in(batch[name], value_set=values), -2).to_numpy()
                mask &= (codes[:, None] < 0) | (codes[:, None] == found[None, :])
        for name, column, lower in RANGE_BOUNDS:
            bound = self.bounds.get(name)
            if bound is not None and not np.isnan(bound).all():
                value = pc.fill_null(batch[column].cast(pa.float64()), float("nan")).to_numpy()
                within = value[None, :] >= bound[:, None] if lower else value[None, :] <= bound[:, None]
                mask &= np.isnan(bound)[:, None] | within
        return mask

    def probed(self, list_ids: np.ndarray) -> np.ndarray:
        """query x item mask of the lists that queries visit; only lists that the items are in take any room."""
        visited, query = self.probes
        present, at = np.unique(list_ids, return_inverse=True)
        begin, end = np.searchsorted(visited, present), np.searchsorted(visited, present, side="right")
        count = end - begin
        column = np.repeat(np.arange(len(present)), count)
        pair = np.arange(count.sum()) + np.repeat(begin - (np.cumsum(count) - count), count)
        mask = np.zeros((len(self.ids), len(present)), dtype=bool)
        mask[query[pair], column] = True
        return mask[:, at]

    def scores(self, batch: pa.Table) -> np.ndarray:
        """query x item scores; ineligible or unprobed pairs are -inf.

        Rows that no query may see are dropped before the product.
        """
        mask = self.eligible(batch)
        if self.probes is not None:
            mask &= self.probed(batch["list_id"].to_numpy())
        out = np.full(mask.shape, -np.inf)
        rows, cols = np.flatnonzero(mask.any(axis=1)), np.flatnonzero(mask.any(axis=0))
        if len(rows) and len(cols):
            vectors = matrix_of(batch["embedding"].combine_chunks().take(pa.array(cols)))
            product = self.matrix[rows] @ vectors.T
            grid = np.ix_(rows, cols)
            out[grid] = np.where(mask[grid], product, -np.inf)
        return out


class RunningTopK:
    """Best ``k`` (score desc, id asc) per query over a stream of batches, ties resolved exactly."""

    def __init__(self, n_queries: int, k: int):
        self.k = k
        self.score = np.full((n_queries, k), -np.inf)
        self.id = np.full((n_queries, k), np.iinfo(np.int64).max)

    def push(self, ids: np.ndarray, score: np.ndarray) -> None:
        better = (score > self.score[:, -1:]) | (
            (score == self.score[:, -1:]) & (ids[None, :] < self.id[:, -1:])
        )
        better &= np.isfinite(score)
        if score.shape[1] > self.k:
            # anything below this batch's own k-th best cannot survive; ties with it stay
            kth = np.partition(score, -self.k, axis=1)[:, -self.k, None]
            better &= score >= kth
        q_new, col = np.nonzero(better)
        if not len(q_new):
            return
        touched = np.unique(q_new)
        q = np.concatenate([q_new, np.repeat(touched, self.k)])
        s = np.concatenate([score[q_new, col], self.score[touched].ravel()])
        i = np.concatenate([ids[col], self.id[touched].ravel()])
        order = np.lexsort((i, -s, q))
        q, s, i = q[order], s[order], i[order]
        first = np.searchsorted(q, touched)
        position = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
        keep = position < self.k
        self.score[touched] = s[keep].reshape(len(touched), self.k)
        self.id[touched] = i[keep].reshape(len(touched), self.k)

    def rows(self, query_ids: np.ndarray) -> pa.RecordBatch:
        q, c = np.nonzero(np.isfinite(self.score))
        return pa.RecordBatch.from_arrays(
            [pa.array(query_ids[q]), pa.array(self.id[q, c]), pa.array(self.score[q, c])],
            names=["query_id", "doc_id", "score"],
        )


def steps(batches, n_queries: int):
    """Slice incoming batches so that one query x item grid stays small."""
    size = max(64, CELLS_PER_STEP // max(1, n_queries))
    for batch in batches:
        table = pa.Table.from_batches([batch])
        for start in range(0, table.num_rows, size):
            yield table.slice(start, size)


def top_k_task(shared, k: int, filtered: bool, n_lists: int = 0):
    """Partition function: local top-k of every query in the block."""

    def run(batches):
        block = QueryBlock.read(shared.value, filtered, n_lists)
        best = RunningTopK(len(block.ids), k)
        for piece in steps(batches, len(block.ids)):
            score = np.round(block.scores(piece), RANK_DIGITS) + 0.0  # no negative zero
            best.push(piece["doc_id"].to_numpy(), score)
        yield best.rows(block.ids)

    return run


def keyword_task(queries, weights, k: int, filtered: bool, saturation):
    """Partition function: local best ``k`` documents per query by the sum of idf x saturation over shared terms.

    ``weights`` are (query_id, term, idf) of the block; ``saturation(tf, dl)`` is the weight of a posting. Pairs
    of a query and a document exist only as cells of one small grid at a time.
    """

    def run(batches):
        block = QueryBlock.read(queries.value, filtered)
        table = pa.ipc.open_stream(weights.value).read_all()
        terms = pc.unique(table["term"])
        term = pc.index_in(table["term"], value_set=terms).to_numpy()
        by_id = np.argsort(block.ids)
        query = by_id[np.searchsorted(block.ids[by_id], table["query_id"].to_numpy())]
        order = np.argsort(term, kind="stable")
        query, idf = query[order], table["idf"].to_numpy()[order]
        start = np.searchsorted(term[order], np.arange(len(terms) + 1))
        best = RunningTopK(len(block.ids), k)
        for piece in steps(batches, len(block.ids)):
            postings = piece["postings"].combine_chunks()
            flat = postings.flatten()
            found = pc.fill_null(pc.index_in(pc.struct_field(flat, "term"), value_set=terms), -1).to_numpy()
            lengths = pc.fill_null(pc.list_value_length(postings), 0).to_numpy()
            doc = np.repeat(np.arange(piece.num_rows), lengths)
            hit = np.flatnonzero(found >= 0)
            found, doc = found[hit], doc[hit]
            tf = pc.struct_field(flat, "tf").to_numpy(zero_copy_only=False)[hit]
            weight = saturation(tf, piece["dl"].to_numpy()[doc])
            asking = start[found + 1] - start[found]
            ends = np.cumsum(asking)
            shape = (len(block.ids), piece.num_rows)
            score = np.zeros(shape[0] * shape[1])
            a = 0
            while a < len(hit):  # postings whose queries fit in one step
                done = ends[a - 1] if a else 0
                b = max(a + 1, int(np.searchsorted(ends, done + CELLS_PER_STEP, side="right")))
                n = asking[a:b]
                at = np.arange(n.sum()) + np.repeat(start[found[a:b]] - (np.cumsum(n) - n), n)
                cell = query[at] * shape[1] + np.repeat(doc[a:b], n)
                score += np.bincount(cell, idf[at] * np.repeat(weight[a:b], n), len(score))
                a = b
            score = score.reshape(shape)
            seen = score > 0
            if filtered:
                seen &= block.eligible(piece)
            best.push(piece["doc_id"].to_numpy(), np.where(seen, np.round(score, RANK_DIGITS), -np.inf))
        yield best.rows(block.ids)

    return run


def block_task(weights, k: int, saturation):
    """Group function: the best ``k`` documents per query of one block of postings, for the queries that chose the block.

    ``weights`` are (query_id, term, idf); the groups are (block, term, entries) and (block, query_id). A posting is not
    repeated per query outside of one small grid at a time. Rows of one document id add up.
    """
    held = {}

    def prepared():
        if not held:
            table = pa.ipc.open_stream(weights.value).read_all()
            terms, queries = pc.unique(table["term"]), pc.unique(table["query_id"])
            query = pc.index_in(table["query_id"], value_set=queries).to_numpy()
            order = np.argsort(query, kind="stable")
            term = pc.index_in(table["term"], value_set=terms).to_numpy()[order]
            start = np.searchsorted(query[order], np.arange(len(queries) + 1))
            held["all"] = terms, queries, start, term, table["idf"].to_numpy()[order]
        return held["all"]

    def run(postings, chosen):
        terms, queries, start, term, idf = prepared()
        names = ["query_id", "doc_id", "score"]
        if not postings.num_rows or not chosen.num_rows:
            return pa.table([queries.slice(0, 0), pa.array([], pa.int64()), pa.array([], pa.float64())], names=names)
        entries = postings["entries"].combine_chunks()
        flat = entries.flatten()
        docs, doc = np.unique(pc.struct_field(flat, "doc_id").to_numpy(zero_copy_only=False), return_inverse=True)
        tf, dl = (pc.struct_field(flat, name).to_numpy(zero_copy_only=False) for name in ("tf", "dl"))
        weight = saturation(tf, dl)
        length = pc.list_value_length(entries).to_numpy()
        first = np.cumsum(length) - length
        place = np.full(len(terms), -1, np.int64)
        place[pc.index_in(postings["term"], value_set=terms).to_numpy()] = np.arange(len(length))
        asking = pc.index_in(chosen["query_id"], value_set=queries).to_numpy()
        size = max(1, CELLS_PER_STEP // len(docs))
        out = []
        for at in range(0, len(asking), size):
            some = asking[at : at + size]
            n = start[some + 1] - start[some]
            pair = np.arange(n.sum()) + np.repeat(start[some] - (np.cumsum(n) - n), n)
            row, query = place[term[pair]], np.repeat(np.arange(len(some)), n)
            hit = row >= 0
            row, query, gain = row[hit], query[hit], idf[pair[hit]]
            ends = np.cumsum(length[row])
            score = np.zeros(len(some) * len(docs))
            a = 0
            while a < len(row):  # rows whose postings fit in one step
                done = ends[a - 1] if a else 0
                b = max(a + 1, int(np.searchsorted(ends, done + CELLS_PER_STEP, side="right")))
                m = length[row[a:b]]
                entry = np.arange(m.sum()) + np.repeat(first[row[a:b]] - (np.cumsum(m) - m), m)
                cell = np.repeat(query[a:b], m) * len(docs) + doc[entry]
                score += np.bincount(cell, np.repeat(gain[a:b], m) * weight[entry], len(score))
                a = b
            score = score.reshape(len(some), len(docs))
            best = RunningTopK(len(some), k)
            best.push(docs, np.where(score > 0, np.round(score, RANK_DIGITS), -np.inf))
            found = best.rows(some)
            out.append(pa.table([queries.take(found.column(0)), found.column(1), found.column(2)], names=names))
        return pa.concat_tables(out)

    return run


def count_task(shared):
    """Partition function: eligible rows, smallest and largest id per record, never the pairs."""

    def run(batches):
        block = QueryBlock.read(shared.value, True)
        n = len(block.ids)
        count = np.zeros(n, np.int64)
        low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, np.iinfo(np.int64).min)
        for piece in steps(batches, n):
            seen = block.eligible(piece)
            ids = piece["doc_id"].to_numpy()
            count += seen.sum(axis=1)
            low = np.minimum(low, np.where(seen, ids, np.iinfo(np.int64).max).min(axis=1))
            high = np.maximum(high, np.where(seen, ids, np.iinfo(np.int64).min).max(axis=1))
        some = count > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(block.ids[some], pa.string()), *[pa.array(a[some]) for a in (count, low, high)]],
            names=["query_id", "n", "low", "high"],
        )

    return run


def score_summary_task(shared, filtered: bool):
    """Partition function: count, sum and extremes of all scores per query, never the pairs."""

    def run(batches):
        block = QueryBlock.read(shared.value, filtered)
        n = len(block.ids)
        count, total = np.zeros(n, dtype=np.int64), np.zeros(n)
        low, high = np.full(n, np.inf), np.full(n, -np.inf)
        for piece in steps(batches, n):
            score = block.scores(piece)
            seen = np.isfinite(score)
            count += seen.sum(axis=1)
            total += np.where(seen, score, 0.0).sum(axis=1)
            low = np.minimum(low, np.where(seen, score, np.inf).min(axis=1))
            high = np.maximum(high, score.max(axis=1))
        some = count > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(a[some]) for a in (block.ids, count, total, low, high)],
            names=["query_id", "n", "total", "low", "high"],
        )

    return run


def nearest_lists_task(shared, vector: str, n: int, score_out: str, list_out: str):
    """Partition function: the best ``n`` lists of ``vector`` so far, best first, with their scores.

    ``shared`` holds one part of the centroids. Lists and scores of earlier parts are read from the columns
    of those names and replaced, so any number of parts can follow one another.
    """

    def run(batches):
        list_ids, centroids = shared.value
        for piece in steps(batches, len(list_ids)):
            score = np.round(matrix_of(piece[vector]) @ centroids.T, RANK_DIGITS)
            lists = np.broadcast_to(list_ids, score.shape)
            if list_out in piece.column_names:
                score = np.concatenate((matrix_of(piece[score_out]), score), axis=1)
                lists = np.concatenate((matrix_of(piece[list_out]).astype(np.int64), lists), axis=1)
                piece = piece.drop_columns([score_out, list_out])
            order = np.lexsort((lists, -score), axis=1)[:, :n]
            offsets = np.arange(0, order.size + 1, order.shape[1], dtype=np.int32)
            for name, values in ((score_out, score), (list_out, lists.astype(np.int32))):
                best = np.take_along_axis(values, order, axis=1).ravel()
                piece = piece.append_column(name, pa.ListArray.from_arrays(offsets, pa.array(best)))
            yield from piece.combine_chunks().to_batches()

    return run


def general_format(values: pd.Series) -> pd.Series:
    """Six significant digits without trailing zeros, as ``%g`` gives them; None stays None."""
    return values.map("{:g}".format, na_action="ignore").astype(object).where(values.notna(), None)
