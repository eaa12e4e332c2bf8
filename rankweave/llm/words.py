"""Words of whole Arrow batches as 64-bit hashes, found and hashed on bytes without a Python object per word.

White space is ASCII (space, tab to carriage return), so UTF-8 bytes can be cut without decoding. A word's
hash is a polynomial over its bytes modulo 2**64, read off prefix sums and then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes hashed in one step, which bounds the temporary arrays; a longer word makes its own step longer.
BLOCK_BYTES = 1 << 20
# Text of one slice of a batch.
SLICE_BYTES = 4 << 20

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64 for i < n; ``base`` is odd."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        both = []
        for step in (base, pow(base, -1, 1 << 64)):
            column = np.full(size, step, np.uint64)
            column[0] = 1
            both.append(np.cumprod(column, dtype=np.uint64))
        have = _powers[base] = (both[0], both[1])
    return have


def spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of ``values[start:end]`` for many spans, by prefix sums; not mixed."""
    up, down = powers(base, len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values.astype(np.uint64, copy=False) * up[: len(values)], out=total[1:])
    return (total[ends] - total[starts]) * down[starts]


def joined(texts: pa.Array) -> tuple[bytes, np.ndarray]:
    """All texts (null: empty) as bytes, each followed by a line feed, and where each one starts."""
    parts = [x or b"" for x in texts.cast(pa.large_binary() if texts.type == pa.large_string() else pa.binary()).to_pylist()]
    starts = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(x) + 1 for x in parts], out=starts[1:])
    parts.append(b"")
    return b"\n".join(parts), starts


def word_hashes(
    texts: pa.Array, lower: bool = False, bases: tuple[int, ...] = (0x9E3779B97F4A7C15,)
) -> tuple[list[np.ndarray], np.ndarray]:
    """One array of word hashes per base, and for each text the index of its first word (n + 1 entries)."""
    data, first_byte = joined(texts)
    raw = np.frombuffer(data, np.uint8)
    if lower:
        raw = LOWER[raw]
    hashes: list[list[np.ndarray]] = [[] for _ in bases]
    at: list[np.ndarray] = []
    begin = 0
    while begin < len(raw):
        end = min(begin + BLOCK_BYTES, len(raw))
        space = SPACE[raw[begin:end]]
        while end < len(raw) and not space.any():
            end = min(end + BLOCK_BYTES, len(raw))
            space = SPACE[raw[begin:end]]
        cut = int(np.flatnonzero(space)[-1]) + 1 if end < len(raw) else end - begin
        block, space = raw[begin : begin + cut], space[:cut]
        edge = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        for k, base in enumerate(bases):
            value = spans_hash(block, starts, ends, base)
            hashes[k].append(mix(value + (ends - starts).astype(np.uint64)))
        at.append(starts + begin)
        begin += cut
    none = np.zeros(0, np.uint64)
    where = np.concatenate(at) if at else np.zeros(0, np.int64)
    return [np.concatenate(x) if x else none for x in hashes], np.searchsorted(where, first_byte)


def column(batch: pa.RecordBatch, name: str | tuple[str, str]) -> pa.Array:
    """A column, or with (struct, field) a field of one."""
    return pc.struct_field(batch.column(name[0]), name[1]) if isinstance(name, tuple) else batch.column(name)


def slices(
    batch: pa.RecordBatch, name: str | tuple[str, str], limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose text stays within ``limit`` bytes; a longer text makes a run by itself."""
    size = pc.fill_null(pc.binary_length(column(batch, name)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    begin, held = 0, 0
    for row, n in enumerate(size.tolist()):
        if row > begin and held + n > limit:
            yield batch.slice(begin, row - begin)
            begin, held = row, 0
        held += n
    if batch.num_rows > begin:
        yield batch.slice(begin)


def documents(docs: DataFrame, keep: list[str], text: str) -> tuple[DataFrame, str | tuple[str, str], str]:
    """Rows as one struct ``doc`` of the columns to keep, where the text is in them, and the struct's SQL type.

    Columns of the caller cannot clash with an operator's own that way.
    """
    whole = F.struct(*[F.col(f"`{c}`").alias(c) for c in keep]).alias("doc")
    kept = docs.select(whole)
    kind = kept.schema["doc"].dataType.simpleString()
    return (kept, ("doc", text), kind) if text in keep else (docs.select(whole, F.col(text).alias("text")), "text", kind)
