"""Interpolated modified Kneser-Ney bigram model, counted by Spark and kept as sorted hash arrays.

Counting. Tasks hash words to 64 bits, count the pairs of a slice of documents and send them to the shard of the
context, those of one slice and shard as one row of packed arrays (contexts, how many followers each has, followers,
counts); the followers of very frequent contexts are spread over ``HOT_WAYS``
shards. A shard's task reads its pairs in order, adds equal ones up and writes two files: sorted 64-bit pair
hashes and one count byte each (larger counts in a short side table). What it learns of single words (how
often, after how many different words, how many different followers seen once, twice, more) is added up by a
second shuffle into sorted word arrays. Only the counts of counts reach the driver.

Scoring. Every worker maps the shards from the shared folder and looks up the distinct pairs of a slice by
binary search; a text's score is the sum of log10 p(word | previous word), the end of the text included.

    p(w | u) = (c(u,w) - D(c))+ / c(u) + gamma(u) * p(w)
    p(w)     = (t(w) - E(t))+ / T + g / (V + 1)          t(w): different words before w, T: their sum

An unknown word has t = 0, an unknown context leaves p(w). Discounts come from the counts of counts
(Chen and Goodman); where one of those is zero they are 0.5, 1 and 1.5.

Nulls, empty texts and texts of white space have one token, the end. Repeated rows count each time. Without
training rows every token has p = 1 / (V + 1) = 1. Word hashes collide with probability below 2**-20 for a
vocabulary of four million words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.llm import words
from rankweave.llm.shards import Shards
from rankweave.session import scratch_path

START = np.uint64(0x5157A27)
END = np.uint64(0xE0D0F7E)
PAIR_BASE = np.uint64(0xD6E8FEB86659FD93)
# Text whose pairs are counted together before they are shuffled.
COUNT_BYTES = 8 << 20
# A context with this share of a sample's tokens is hot; there are at most 1 / share of them.
HOT_SHARE = 0.002
HOT_WAYS = 16
SAMPLE_SHARE = 0.01
PAIRS_PER_SHARD = 400_000

COUNTED = "shard int, u binary, followers binary, v binary, n binary"
LEARNT = "kind int, shard int, word long, n0 long, n1 long, n2 long, n3 long, n4 long"


def with_ends(batch: pa.RecordBatch, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(previous, token, text of the token) for all tokens of a batch, each text closed by its end."""
    (hashes,), first = words.word_hashes(words.column(batch, text), lower=True)
    n_texts = batch.num_rows
    per_text = np.diff(first)
    text_of = np.repeat(np.arange(n_texts), per_text + 1)
    ends = np.cumsum(per_text + 1) - 1
    token = np.empty(len(text_of), np.uint64)
    word = np.ones(len(text_of), bool)
    word[ends] = False
    token[word] = hashes
    token[ends] = END
    previous = np.empty_like(token)
    previous[1:] = token[:-1]
    previous[ends[:-1] + 1] = START
    if n_texts:
        previous[0] = START
    return previous, token, text_of


def pair_hash(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    return words.mix(u * PAIR_BASE + v)


def spread(u: np.ndarray, v: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    """The shard of a pair: that of its context, or one of several for a hot context."""
    key = u.copy()
    if len(hot):
        at = np.minimum(np.searchsorted(hot, u), len(hot) - 1)
        frequent = hot[at] == u
        key[frequent] += np.uint64(1) + v[frequent] % np.uint64(HOT_WAYS)
    return (words.mix(key) % np.uint64(shards)).astype(np.int32)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def frequent_contexts(docs: DataFrame, text: str) -> np.ndarray:
    """Hashes of contexts that hold ``HOT_SHARE`` of a sample's tokens. They only balance the shuffle."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, text):
                previous, _, _ = with_ends(part, text)
                found, n = np.unique(previous, return_counts=True)
                keep = n > HOT_SHARE / 2 * len(previous)
                yield pa.record_batch(
                    [pa.array(signed(found[keep])), pa.array(n[keep]), pa.array(np.full(keep.sum(), 0))],
                    ["u", "n", "all"],
                )
                yield pa.record_batch([pa.array([0]), pa.array([0]), pa.array([len(previous)])], ["u", "n", "all"])

    seen = docs.select(text).sample(SAMPLE_SHARE, 7).mapInArrow(kernel, "u long, n long, all long")
    total = seen.agg(F.coalesce(F.sum("all"), F.lit(0))).first()[0]
    rows = seen.groupBy("u").agg(F.sum("n").alias("n")).where(F.col("n") > HOT_SHARE * total).collect()
    return np.sort(np.array([r["u"] for r in rows], np.int64).view(np.uint64))


class BigramModel:
    """A fitted model: shard files below ``store`` and a few numbers. It pickles as those alone."""

    def __init__(self, store: Shards, shards: int, hot: np.ndarray, pair_counts: list[int], word_counts: list[int]):
        self.store, self.shards, self.hot = store, shards, hot
        self.tokens, self.vocabulary, self.types, self.texts = word_counts[:4]
        self.high = discounts(pair_counts)
        self.low = discounts(word_counts[4:8])
        n1, n2, more = word_counts[4], word_counts[5], word_counts[8]
        self.uniform = 1.0 / (self.vocabulary + 1)
        self.left = (np.array([n1, n2, more]) @ self.low[1:]) / self.types if self.types else 1.0

    def words_known(self, token: np.ndarray) -> np.ndarray:
        """(count, different words before, followers seen once, twice, more) per distinct token hash."""
        out = np.zeros((len(token), 5), np.float64)
        shard = (words.mix(token) % np.uint64(self.shards)).astype(np.int64)
        for k, at in by_shard(shard):
            keys = self.store.read(f"words/{k}.key", np.uint64)
            if len(keys):
                place = np.minimum(np.searchsorted(keys, token[at]), len(keys) - 1)
                hit = keys[place] == token[at]
                values = self.store.read(f"words/{k}.value", np.uint64).reshape(-1, 5)
                out[at[hit]] = values[place[hit]]
        return out

    def pairs_known(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Count per pair; pairs come sorted by hash, so that the maps are read forwards."""
        out = np.zeros(len(u), np.float64)
        key = pair_hash(u, v)
        for k, at in by_shard(spread(u, v, self.hot, self.shards)):
            keys = self.store.read(f"pairs/{k}.key", np.uint64)
            if not len(keys):
                continue
            place = np.minimum(np.searchsorted(keys, key[at]), len(keys) - 1)
            hit = keys[place] == key[at]
            n = self.store.read(f"pairs/{k}.count", np.uint8)[place[hit]].astype(np.float64)
            large = n == 255
            if large.any():
                wide = self.store.read(f"pairs/{k}.large", np.uint64).reshape(-1, 2)
                n[large] = wide[np.searchsorted(wide[:, 0], key[at[hit]][large]), 1]
            out[at[hit]] = n
        return out

    def score(self, batch: pa.RecordBatch, text: str) -> tuple[np.ndarray, ...]:
        """(tokens, known tokens, add-one log10 score, model log10 score) of each text of a batch."""
        previous, token, text_of = with_ends(batch, text)
        n_texts = batch.num_rows
        single, which = np.unique(np.concatenate((token, previous)), return_inverse=True)
        known = self.words_known(single)
        w, u = which[: len(token)], which[len(token) :]
        key = pair_hash(previous, token)
        _, at, back = np.unique(key, return_index=True, return_inverse=True)
        count = self.pairs_known(previous[at], token[at])[back]

        low = self.left * self.uniform + np.zeros(len(single))
        if self.types:
            low += np.maximum(known[:, 1] - discount_of(known[:, 1], self.low), 0) / self.types
        total = known[:, 0].copy()
        total[single == START] = self.texts
        total[single == END] = 0
        seen = total > 0
        back_off = np.ones(len(single))
        back_off[seen] = (known[seen, 2:] @ self.high[1:]) / total[seen]
        p = back_off[u] * low[w]
        p += np.where(seen[u], np.maximum(count - discount_of(count, self.high), 0) / np.maximum(total[u], 1), 0)
        add_one = (known[w, 0] + 1) / (self.tokens + self.vocabulary + 1)
        summed = lambda x: np.bincount(text_of, x, n_texts)
        return (
            np.bincount(text_of, minlength=n_texts),
            summed(known[w, 0] > 0).astype(np.int64),
            summed(np.log10(add_one)),
            summed(np.log10(p)),
        )


def by_shard(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(shard, kind="stable")
    cuts = np.flatnonzero(np.diff(shard[order])) + 1
    for at in np.split(order, cuts):
        if len(at):
            yield int(shard[at[0]]), at


def discounts(n: list[int]) -> np.ndarray:
    """D for counts of 0, 1, 2 and 3 or more, from how many things were counted 1, 2, 3 and 4 times."""
    n1, n2, n3, n4 = n[:4]
    if not (n1 and n2 and n3 and n4):
        return np.array([0.0, 0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    d = np.array([0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    return np.clip(d, 0, [0, 1, 2, 3])


def discount_of(count: np.ndarray, d: np.ndarray) -> np.ndarray:
    return d[np.minimum(count, 3).astype(np.int64)]


def count_pairs(docs: DataFrame, text: str, hot: np.ndarray, shards: int) -> DataFrame:
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, text, COUNT_BYTES):
                u, v, _ = with_ends(part, text)
                _, at, n = np.unique(pair_hash(u, v), return_index=True, return_counts=True)
                u, v = u[at], v[at]
                shard = spread(u, v, hot, shards)
                order = np.lexsort((u, shard))
                shard, u, v, n = shard[order], u[order], v[order], n[order]
                del at, order  # a batch's temporaries need not outlive it while its rows are sent
                yield packed(shard, u, v, n)

    return docs.select(text).mapInArrow(kernel, COUNTED)


def packed(shard: np.ndarray, u: np.ndarray, v: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """One row per shard of pairs that come by shard and context: each context once, with the number of its followers."""
    new_shard = np.concatenate(([True], np.diff(shard) != 0))[: len(shard)]
    new = np.flatnonzero(new_shard | np.concatenate(([True], np.diff(u) != 0))[: len(u)])
    followers = np.diff(np.append(new, len(u))).astype(np.uint32)
    begin = np.flatnonzero(new_shard)
    pairs = np.append(begin, len(u))
    contexts = np.searchsorted(new, pairs)

    def cut(values: np.ndarray, at: np.ndarray) -> pa.Array:
        values = np.ascontiguousarray(values)
        offsets = pa.py_buffer((at * values.itemsize).astype(np.int32))
        return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, offsets, pa.py_buffer(values)])

    columns = [pa.array(shard[begin]), cut(u[new], contexts), cut(followers, contexts), cut(v, pairs), cut(n.astype(np.uint32), pairs)]
    return pa.record_batch(columns, ["shard", "u", "followers", "v", "n"])


def unpacked(rows: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, follower, count) of all pairs of rows of ``packed``."""

    def whole(name: str, kind: type) -> np.ndarray:
        return np.frombuffer(b"".join(x.as_py() for row in rows for x in row.column(name)), kind)

    u = np.repeat(whole("u", np.uint64), whole("followers", np.uint32))
    return u, whole("v", np.uint64), whole("n", np.uint32).astype(np.int64)


def write_pairs(counted: DataFrame, store: Shards, shards: int) -> DataFrame:
    """Write the pair arrays of each shard; return what the shards know of single words, and counts of counts."""

    def finish(shard: int, u: np.ndarray, v: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        key = pair_hash(u, v)
        order = np.argsort(key)
        new = np.flatnonzero(np.concatenate(([True], np.diff(key[order]) != 0)))
        n = np.add.reduceat(n[order], new)
        order = order[new]
        key, u, v = key[order], u[order], v[order]
        store.write(f"pairs/{shard}.key", key)
        store.write(f"pairs/{shard}.count", np.minimum(n, 255).astype(np.uint8))
        large = n >= 255
        store.write(f"pairs/{shard}.large", np.stack((key[large], n[large].astype(np.uint64)), 1))
        zero = lambda m: np.zeros(m, np.int64)
        yield learnt(1, zero(1), [np.array([(n == k).sum()]) for k in (1, 2, 3, 4)] + [zero(1)], shards)
        one, which = np.unique(u, return_inverse=True)
        follow = [np.bincount(which, n == 1), np.bincount(which, n == 2), np.bincount(which, n > 2)]
        yield learnt(0, signed(one), [zero(len(one)), zero(len(one)), *follow], shards)
        one, which = np.unique(v, return_inverse=True)
        yield learnt(0, signed(one), [np.bincount(which, n), np.bincount(which)] + [zero(len(one))] * 3, shards)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current = None

        def done():
            return finish(current, *unpacked(held))

        for batch in batches:
            shard = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
            for a, b in zip(cuts, cuts[1:]):
                if b > a:
                    if held and shard[a] != current:
                        yield from done()
                        held = []
                    current = int(shard[a])
                    held.append(batch.slice(a, b - a))
        if held:
            yield from done()

    summed = counted.repartition(shards, "shard").sortWithinPartitions("shard")
    return summed.mapInArrow(kernel, LEARNT)


def learnt(kind: int, word: np.ndarray, values: list[np.ndarray], shards: int) -> pa.RecordBatch:
    shard = (words.mix(word.view(np.uint64)) % np.uint64(shards)).astype(np.int32)
    columns = [pa.array(np.full(len(word), kind, np.int32)), pa.array(shard), pa.array(word)]
    columns += [pa.array(np.asarray(x).astype(np.int64)) for x in values]
    return pa.record_batch(columns, ["kind", "shard", "word", "n0", "n1", "n2", "n3", "n4"])


def write_words(known: DataFrame, store: Shards, shards: int) -> DataFrame:
    """Write the word arrays; return one row of sums per shard (kind 2), besides the counts of pairs (kind 1)."""
    out = "kind int, " + ", ".join(f"m{k} long" for k in range(9))

    def rows(kind: int, values: list[int]) -> pa.RecordBatch:
        columns = [pa.array([kind], pa.int32())] + [pa.array([int(x)], pa.int64()) for x in values]
        return pa.record_batch(columns, ["kind"] + [f"m{k}" for k in range(9)])

    def finish(shard: int, word: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        one, which = np.unique(word.view(np.uint64), return_inverse=True)
        total = np.stack([np.bincount(which, values[:, k], len(one)) for k in range(5)], 1)
        store.write(f"words/{shard}.key", one)
        store.write(f"words/{shard}.value", total.astype(np.uint64))
        n, before = total[:, 0], total[:, 1]
        texts = n[one == END].sum()
        counts = [(before == k).sum() for k in (1, 2, 3, 4)] + [(before > 2).sum()]
        return rows(2, [n.sum(), (n > 0).sum(), before.sum(), texts, *counts])

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        current = None
        for batch in batches:
            kind, shard = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            word = batch.column(2).to_numpy()
            values = np.stack([batch.column(k).to_numpy() for k in range(3, 8)], 1)
            for at in np.flatnonzero(kind == 1):
                yield rows(1, [*values[at], 0, 0, 0, 0])
            keep = kind == 0
            shard, word, values = shard[keep], word[keep], values[keep]
            cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
            for a, b in zip(cuts, cuts[1:]):
                if b > a:
                    if held and shard[a] != current:
                        yield finish(current, *map(np.concatenate, zip(*held)))
                        held = []
                    current = int(shard[a])
                    held.append((word[a:b], values[a:b]))
        if held:
            yield finish(current, *map(np.concatenate, zip(*held)))

    return known.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(kernel, out)


def fit(docs: DataFrame, text: str = "text") -> BigramModel:
    """Count ``docs`` and write the model to the shared folder."""
    spark = docs.sparkSession
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    # about one pair in three is new after counting, and a word with its space takes some six bytes
    shards = max(1, round(size / 6 / 3 / PAIRS_PER_SHARD))
    store = Shards(scratch_path(spark, "bigrams"))
    hot = frequent_contexts(docs, text)
    known = write_pairs(count_pairs(docs, text, hot, shards), store, shards)
    sums = [F.coalesce(F.sum(f"m{k}"), F.lit(0)).alias(f"m{k}") for k in range(9)]
    rows = {r["kind"]: list(r)[1:] for r in write_words(known, store, shards).groupBy("kind").agg(*sums).collect()}
    return BigramModel(store, shards, hot, rows.get(1, [0] * 9), rows.get(2, [0] * 9))


def score(docs: DataFrame, model: BigramModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(doc, n_tokens, n_known, base_score, score, perplexity) of each text; doc holds the ``keep`` columns."""
    source, place, kind = words.documents(docs, keep if keep is not None else [c for c in docs.columns if c != text], text)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, place):
                scored = [pa.array(x) for x in model.score(part, place)]
                yield pa.record_batch([part.column("doc"), *scored], ["doc", "n_tokens", "n_known", "base_score", "score"])

    scored = source.mapInArrow(kernel, f"doc {kind}, n_tokens long, n_known long, base_score double, score double")
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def held_out(id_col: str = "doc_id", ways: int = 7, fold: int = 2) -> Column:
    """True where crc32 of the id as text leaves ``fold``; a null id counts as empty text."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return (F.crc32(text.cast("binary")) % ways) == fold
