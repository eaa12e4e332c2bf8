"""Vector best-fit packing of token sequences into bins of several capacities.

A piece asks for three things: its tokens, one document, and its attention cost (tokens squared). Pieces of
one length ask for the same vector, so the choice of bins is made on counts per length (at most
``Capacity.tokens`` numbers, whatever the corpus): lengths go from long to short, and each goes to the open
bins that can take it under every capacity and whose weighted residual is then smallest (``rule="norm"``)
or matches it best (``rule="dot"``). Bins with the same residual are handled as one range of numbers. The
result is a short list of placements "pieces ranked a to b of length n are in bins c to d at offset o", and
Spark ranks the pieces of a length and joins them to it.

Texts longer than ``Capacity.tokens`` are cut so that only the first piece is short. A null or empty text is
its end token alone. Pieces of equal length are told apart by (id, piece, ids); repeated rows are packed
each for itself.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankweave.llm import words
from rankweave.session import cut_lineage

END_ID = 2
CACHED_WORDS = 1 << 19
# Texts encoded in one call, new words put into one of them, and text cut in one step: they bound a worker's memory.
ENCODED_AT_ONCE = 1 << 13
WORDS_PER_TEXT = 256
STEP_BYTES = 4 << 20
PIECES_PER_BLOCK = 5_000
# Longer units are not kept.
KEPT_BYTES = 256
NONE = pa.array([], pa.binary())

# Words of letters that any version of Unicode has as such.
LETTERS = "^ [A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+$"
ASCII_LETTER = np.zeros(256, bool)
ASCII_LETTER[65:91] = ASCII_LETTER[97:123] = True
# 1 for white space, 2 for punctuation of ASCII, before which units may begin.
SORT = np.zeros(256, np.uint8)
SORT[33:127] = 2
SORT[48:58] = 0
SORT[ASCII_LETTER] = 0
SORT[[9, 10, 13, 32]] = 1
# Last bytes of white space beyond ASCII in three bytes of UTF-8.
SPACE_ENDS = np.zeros(256, bool)
SPACE_ENDS[0x80:0x90] = True
SPACE_ENDS[[0x9F, 0xA8, 0xA9, 0xAF]] = True


@dataclass(frozen=True)
class Capacity:
    """What a bin holds, and how much each part counts when bins are compared."""

    tokens: int = 1024
    documents: int = 1024
    attention: int = 1024 * 1024
    weights: tuple[float, float, float] = (1.0, 0.05, 0.2)

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.attention], np.float64)


class WordIds:
    """Token ids of texts as one array of 32-bit ids and its cuts, with the ids of frequent words kept.

    A text is cut where GPT-2's rule for byte-level vocabularies never joins characters (:func:`units`), so its
    ids are those of its units one after the other. Units are told apart and put together by Arrow; Python
    sees each distinct unit of a slice once and looks up its place in a table of ids. New words are encoded
    many to a text, which is cut at the tokens that begin with a space: each word has one, at its head. Texts with
    added tokens, and all texts of a vocabulary with another rule, are encoded whole.
    """

    def __init__(self, path: str):
        # a task has one core; threads of the tokenizer would only take turns on it
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.heads = np.zeros(max(vocabulary.values()) + 1, bool)
        # the byte-level alphabet writes a space as this letter
        self.heads[[at for token, at in vocabulary.items() if token.startswith("\u0120")]] = True
        self.added = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        rule = self.tokenizer.pre_tokenizer
        self.cut = isinstance(rule, pre_tokenizers.ByteLevel) and rule.use_regex and not rule.add_prefix_space and not self.tokenizer.normalizer
        # words of letters are cut at spaces alone, without the rule's regular expression; the model is shared
        self.lettered = Tokenizer(self.tokenizer.model)
        self.lettered.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split(" ", "merged_with_next"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.forget()

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for at in range(0, len(texts), ENCODED_AT_ONCE):
            encoded = self.tokenizer.encode_batch_fast(texts[at : at + ENCODED_AT_ONCE], add_special_tokens=False)
            out += [np.array(x.ids, "<u4").tobytes() for x in encoded]
        return out

    def runs(self, units: list[str]) -> pa.Array:
        """Ids of each unit, as :meth:`encode` gives them."""
        letters = pc.match_substring_regex(pa.array(units, pa.string()), LETTERS).to_numpy(zero_copy_only=False)
        words, rest = np.flatnonzero(letters), np.flatnonzero(~letters)
        tails = [units[k][1:] for k in rest.tolist()]
        alone = np.array([units[k][:1] != " " or " " in t for k, t in zip(rest.tolist(), tails)], bool)
        alone |= spaced(pa.array(tails, pa.string()), tails)
        order = np.concatenate((words, rest[~alone], rest[alone]))
        some = [units[k] for k in order.tolist()]
        first, second = len(words), len(order) - int(alone.sum())
        out = [NONE, *self.behind_spaces(self.lettered, some[:first]), *self.behind_spaces(self.tokenizer, some[first:second])]
        out.append(pa.array(self.encode(some[second:]), pa.binary()))
        return pa.concat_arrays(out).take(pa.array(np.argsort(order)))

    def behind_spaces(self, tokenizer, words: list[str]) -> Iterator[pa.Array]:
        """Ids of words that begin with their only space, many to a text."""
        for at in range(0, len(words), ENCODED_AT_ONCE * 4):
            some = words[at : at + ENCODED_AT_ONCE * 4]
            texts = ["".join(some[k : k + WORDS_PER_TEXT]) for k in range(0, len(some), WORDS_PER_TEXT)]
            found: list[int] = []
            for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False):
                found += x.ids
            ids = np.array(found, "<u4")
            begin = np.flatnonzero(self.heads[ids])
            if len(begin) != len(some):  # a vocabulary with other rules for spaces
                yield pa.array(self.encode(some), pa.binary())
                continue
            cuts = (np.append(begin, len(ids)) * 4).astype(np.int32)
            yield pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(cuts), pa.py_buffer(ids)])

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of words that follow a space."""
        return self.runs([" " + w for w in words]).to_pylist()

    def places(self, units: list[str]) -> np.ndarray:
        """Where ``table`` has the ids of units. Those used since the last two generations began are kept."""
        if len(self.known) > CACHED_WORDS:
            self.known, self.table, self.older, self.older_table = {}, NONE, self.known, self.table
        place = np.fromiter(map(self.known.get, units, repeat(-1)), np.int32, len(units))
        for source in (self.older, None):
            new = np.flatnonzero(place < 0)
            missing = [units[k] for k in new.tolist()]
            if source is not None:
                old = np.fromiter(map(source.get, missing, repeat(-1)), np.int32, len(missing))
                new, missing = new[old >= 0], [missing[k] for k in np.flatnonzero(old >= 0).tolist()]
                more = self.older_table.take(pa.array(old[old >= 0]))
            else:
                more = self.runs(missing)
            place[new] = np.arange(len(self.table), len(self.table) + len(new))
            self.known.update(zip(missing, place[new].tolist()))
            self.table = pa.concat_arrays([self.table, more])
        return place

    def of_words(self, words: list[str]) -> list[bytes]:
        """As :meth:`encode_words`, with the words kept."""
        places = self.places([" " + w for w in words])
        return self.table.take(pa.array(places)).to_pylist()

    def forget(self) -> None:
        """Let go of the kept words, which would fill the worker during other stages."""
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}
        self.table = self.older_table = NONE
        pa.default_memory_pool().release_unused()

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as :meth:`encode` gives them."""
        ids, cuts = self.joined(pa.array(texts, pa.string()))
        return [ids[a:b].astype("<u4").tobytes() for a, b in zip(cuts, cuts[1:])]

    def joined(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, cuts): the ids of text k are ``ids[cuts[k]:cuts[k + 1]]``."""
        texts = pc.fill_null(texts, "")
        whole = np.full(len(texts), not self.cut)
        for token in self.added:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        found, begin = units(texts, whole)
        coded = found.dictionary_encode()
        # long units seldom come again; kept, they would fill the worker
        long = pc.greater(pc.binary_length(coded.dictionary), KEPT_BYTES).to_numpy(zero_copy_only=False)
        distinct = coded.dictionary.to_numpy(zero_copy_only=False)
        place = np.zeros(len(distinct), np.int32)
        place[~long] = self.places(distinct[~long].tolist())
        others = self.encode(distinct[long].tolist())
        place[long] = np.arange(len(self.table), len(self.table) + len(others))
        table = pa.concat_arrays([self.table, pa.array(others, pa.binary())]) if others else self.table
        held = table.take(pa.array(place[coded.indices.to_numpy()]))
        if not len(held):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        offsets = np.frombuffer(held.buffers()[1], np.int32)[held.offset : held.offset + len(held) + 1]
        ids = np.frombuffer(held.buffers()[2] or b"", "<u4", int(offsets[-1]) >> 2)
        return ids, offsets[begin].astype(np.int64) >> 2


def units(texts: pa.Array, whole: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Texts in parts that GPT-2's rule never joins, and each text's first part (one entry more); those of ``whole`` are left whole.

    The rule's alternatives never go on from other characters to white space, or from a letter to
    punctuation, and look ahead only behind white space. So a cut is right before ASCII white space that
    surely follows something else, and before ASCII punctuation that surely follows a letter.
    """
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    # no buffers of an empty array are sure to be there
    bounds = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, kind)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    sort = SORT[data]
    at = np.flatnonzero(sort[1:]) + 1
    last = data[at - 1]
    # of a character of several bytes, the lead is the second or third byte from its end, or it has four and is no white space
    second, third = data[at - 2], data[at - 3]
    spacing = (second == 0xC2) & ((last == 0x85) | (last == 0xA0)) | (third >= 0xE1) & (third <= 0xE3) & SPACE_ENDS[last]
    printed = (last > 32) & (last < 127) | (last > 127) & ~spacing
    letter = ASCII_LETTER[last] | (second == 0xC3) & (last > 127) & (last != 0x97) & (last != 0xB7)
    begins = np.zeros(len(data), bool)
    begins[at[np.where(sort[at] == 1, printed, letter)]] = True
    for k in np.flatnonzero(whole).tolist():
        begins[bounds[k] : bounds[k + 1]] = False
    begins[bounds[:-1][bounds[1:] > bounds[:-1]]] = True
    starts = np.flatnonzero(begins)
    cuts = np.append(starts, len(data)).astype(kind)
    return pa.Array.from_buffers(texts.type, len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(data)]), np.searchsorted(starts, bounds)


def spaced(array: pa.Array, words: list[str]) -> np.ndarray:
    """Whether each of ``words``, the strings of ``array``, is empty or has white space at an end."""
    odd = np.ones(len(array), bool)
    if not len(array):
        return odd
    kind = np.int64 if pa.types.is_large_string(array.type) else np.int32
    offsets = np.frombuffer(array.buffers()[1], kind)[array.offset : array.offset + len(array) + 1]
    some = np.flatnonzero(offsets[1:] > offsets[:-1])
    if len(some):
        data = np.frombuffer(array.buffers()[2], np.uint8)
        # no printing ASCII character is white space; the others are left to Python
        plain = (data > 32) & (data < 127)
        odd[some] = ~(plain[offsets[some]] & plain[offsets[some + 1] - 1])
    unclear = np.flatnonzero(odd).tolist()
    odd[unclear] = [not words[k] or words[k].strip() != words[k] for k in unclear]
    return odd


_word_ids: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One per worker process."""
    if path not in _word_ids:
        _word_ids[path] = WordIds(path)
    return _word_ids[path]


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", tokens: int = 1024) -> DataFrame:
    """(id, piece, start, length, ids): the token ids of each text and its end, in pieces of ``tokens``."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch], encode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, "text", STEP_BYTES):
                found, cuts = encode(part.column("text"))
                ends = cuts[1:] + np.arange(1, part.num_rows + 1)  # behind the end of each text
                ids = np.insert(found, cuts[1:], END_ID).astype("<u4", copy=False)
                n = np.diff(ends, prepend=0)
                many = -(-n // tokens)
                row = np.repeat(np.arange(part.num_rows), many)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                first = n - (many - 1) * tokens  # of each text's first piece
                start = np.where(piece > 0, first[row] + (piece - 1) * tokens, 0)
                length = np.where(piece > 0, tokens, first[row])
                bounds = np.append((ends - n)[row] + start, len(ids)).astype(np.int32) * 4
                held = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(bounds), pa.py_buffer(ids)])
                yield pa.record_batch(
                    [
                        part.column("id").take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start),
                        pa.array(length), held,
                    ],
                    ["id", "piece", "start", "length", "ids"],
                )

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = word_ids(tokenizer)
        try:
            yield from cut(batches, ids.joined)
        finally:
            ids.forget()

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(kernel, f"id {kind}, piece int, start long, length long, ids binary")


def best_fit(lengths: dict[int, int], room: Capacity, rule: str = "norm") -> list[tuple[int, int, int, int, int]]:
    """Placements (length, first rank, how many, first bin, offset) for ``lengths[n]`` pieces of n tokens.

    Ranks start at 0 and a placement's pieces go to consecutive bins, one each.
    """
    scale = room.vector()
    weight = np.array(room.weights)
    out: list[tuple[int, int, int, int, int]] = []
    left = np.zeros((0, 3))  # residual of each range of equal bins
    at = np.zeros((0, 2), np.int64)  # its first bin and number of bins
    bins = 0
    for n in sorted(lengths, reverse=True):
        asks = np.array([n, 1.0, float(n) * n])
        if (asks > scale).any():
            raise ValueError(f"a piece of {n} tokens fits no bin")
        rank, todo = 0, lengths[n]

        def place(residual, first, count, each):
            """``each`` pieces into each of ``count`` bins; what is left of those bins."""
            nonlocal rank
            offset = int(room.tokens - residual[0])
            for k in range(each):
                out.append((n, rank, count, first, offset + k * n))
                rank += count
            return residual - each * asks

        after = left - asks
        fits = np.flatnonzero((after >= 0).all(1) & (at[:, 1] > 0)) if len(left) else np.zeros(0, np.int64)
        if rule == "norm":
            worth = -((after[fits] / scale) ** 2 @ weight)
        else:
            worth = (left[fits] / scale * (asks / scale)) @ weight
        more_left, more_at = [], []
        for k in fits[np.argsort(-worth, kind="stable")]:
            if not todo:
                break
            residual, (first, count) = left[k], at[k].tolist()
            each = int((residual // asks).min())
            full = min(count, todo // each)
            if full:
                more_left.append(place(residual, first, full, each))
                more_at.append((first, full))
                todo -= full * each
                first, count = first + full, count - full
            if count and 0 < todo < each:
                more_left.append(place(residual, first, 1, todo))
                more_at.append((first, 1))
                todo, first, count = 0, first + 1, count - 1
            at[k] = first, count
        if todo:
            each = int((scale // asks).min())
            for count, inside in ((todo // each, each), (int(todo % each > 0), todo % each)):
                if count:
                    more_left.append(place(scale, bins, count, inside))
                    more_at.append((bins, count))
                    bins += count
        if more_left:
            left = np.concatenate((left, more_left))
            at = np.concatenate((at, np.array(more_at, np.int64)))
        open_ = (at[:, 1] > 0) & (left[:, 0] >= 1) & (left[:, 1] >= 1) & (left[:, 2] >= 1)
        left, at = left[open_], at[open_]
    return out


def ranked(cut: DataFrame, total: int) -> DataFrame:
    """``rank`` from 0 within each length: numbered inside hashed blocks, raised by the blocks before."""
    blocks = max(1, -(-total // PIECES_PER_BLOCK))
    block = F.pmod(F.xxhash64(*cut.columns), F.lit(blocks)).cast("int")
    cut = cut.withColumn("_block", block)
    held = cut.groupBy("length", "_block").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_block")) - F.col("_n")
    offsets = held.select("length", "_block", before.alias("_before"))
    inside = F.row_number().over(Window.partitionBy("length", "_block").orderBy("id", "piece", "ids_crc32"))
    numbered = cut.withColumn("_inside", inside)
    joined = numbered.join(offsets, ["length", "_block"])
    return joined.withColumn("rank", F.col("_before") + F.col("_inside") - 1).drop("_block", "_before", "_inside")


def pack(cut: DataFrame, room: Capacity = Capacity(), rule: str = "norm") -> DataFrame:
    """Add sequence_id and offset to pieces (id, piece, start, length, ids_crc32, ...)."""
    spark = cut.sparkSession
    cut = cut_lineage(cut, "pieces")
    # one number per length, at most room.tokens of them
    lengths = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = spark.createDataFrame(
        best_fit(lengths, room, rule), "length long, _rank long, _count long, _bin long, offset long"
    )
    # the number of placements depends on the capacities, not on the corpus
    placed = ranked(cut, sum(lengths.values())).join(F.broadcast(plan), "length")
    inside = (F.col("rank") >= F.col("_rank")) & (F.col("rank") < F.col("_rank") + F.col("_count"))
    return (
        placed.where(inside)
        .withColumn("sequence_id", F.col("_bin") + F.col("rank") - F.col("_rank"))
        .drop("rank", "_rank", "_count", "_bin")
    )
