"""Calls of outside functions over batches of rows: models kept per worker, and calls that may fail.

A function that fails on a batch is asked again with its halves, down to single rows, so one bad row costs a few calls and
never its neighbours' answers, nor the task.
"""

from __future__ import annotations

import sys
import time
import types
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

OK, FAILED, MISSING = "ok", "failed", "missing"
BATCH = 128
# Rows whose order by length is put right again at once.
WINDOW = 64 * BATCH
LONGEST_ERROR = 500


def answers(
    fn: Callable[[list], Sequence], values: list, retries: int = 0, wait: float = 0.0
) -> list[tuple[str, object, str | None, int]]:
    """(status, answer, error, calls that took part) per value; an answer of None is ``missing``.

    A failing batch is halved; a single value is asked ``retries`` more times, after ``wait`` seconds each.
    """
    if not values:
        return []
    try:
        found = list(fn(values))
        if len(found) != len(values):
            raise ValueError(f"{len(found)} answers to {len(values)} values")
        return [(OK if x is not None else MISSING, x, None, 1) for x in found]
    except Exception as error:  # whatever an outside call raises concerns its rows only
        if len(values) == 1:
            if retries:
                time.sleep(wait)
                status, answer, text, calls = answers(fn, values, retries - 1, wait)[0]
                return [(status, answer, text, calls + 1)]
            return [(FAILED, None, f"{type(error).__name__}: {error}"[:LONGEST_ERROR], 1)]
        half = len(values) // 2
        both = answers(fn, values[:half], retries, wait) + answers(fn, values[half:], retries, wait)
        return [(status, answer, text, calls + 1) for status, answer, text, calls in both]


def call_rows(
    rows: DataFrame, key: str, value: str, fn: Callable[[list], Sequence], kind: str = "string",
    size: int = BATCH, retries: int = 0, wait: float = 0.0,
) -> DataFrame:
    """(key, answer, status, error, calls) for every row: ``fn`` is called on the executors with up to ``size`` values at a time.

    ``status`` is ok, failed or missing (no answer, or no value to ask with). A failing call never fails the task. Answers are
    written before they are used, so that each value is asked for once however often they are read.
    """
    source = rows.select(F.col(key).alias("key"), F.col(value).alias("value"))
    answer_type = _arrow_type(rows, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                values = part.column("value").to_pylist()
                known = [k for k, x in enumerate(values) if x is not None]
                found: list = [(MISSING, None, None, 0)] * len(values)
                for k, answer in zip(known, answers(fn, [values[k] for k in known], retries, wait)):
                    found[k] = answer
                status, answer, error, calls = zip(*found)
                yield pa.record_batch(
                    [
                        part.column("key"), pa.array(answer, answer_type), pa.array(status), pa.array(error, pa.string()),
                        pa.array(calls, pa.int32()),
                    ],
                    ["key", "answer", "status", "error", "calls"],
                )

    key_type = source.schema["key"].dataType.simpleString()
    out = source.mapInArrow(run, f"key {key_type}, answer {kind}, status string, error string, calls int")
    return cut_lineage(out.withColumnRenamed("key", key), "answers")


def _arrow_type(rows: DataFrame, kind: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_type(_parse_datatype_string(kind))


def answered_or(called: DataFrame, key: str, fallback: DataFrame, answer: Column | None = None) -> DataFrame:
    """(key, answer, origin): the call's answer, or the ``fallback``'s (key, answer) for exactly the keys without one."""
    good = called.where(F.col("status") == OK).select(key, (answer if answer is not None else F.col("answer")).alias("answer"))
    rest = called.where(F.col("status") != OK).select(key)
    other = rest.join(fallback.select(key, "answer"), key, "left")
    return good.withColumn("origin", F.lit("call")).unionByName(other.withColumn("origin", F.lit("fallback")))


# --- models ---------------------------------------------------------------------------------------


def held(token: str, load: Callable[[], object]) -> object:
    """What ``load`` returned the first time it was asked for under this token in this process.

    This module reaches workers by value, a copy per task; what they share is kept as a module of the process.
    """
    kept = sys.modules.setdefault("_rankweave_models", types.ModuleType("_rankweave_models")).__dict__
    if token not in kept:
        kept[token] = load()
    return kept[token]


def encode_rows(
    rows: DataFrame, key: str, text: str, load: Callable[[], Callable[[list[str]], np.ndarray]], out: str = "embedding",
    size: int = BATCH, token: str | None = None,
) -> DataFrame:
    """(key, vector) of every row with a text; ``load`` returns a model that turns a list of texts into a matrix.

    The model is loaded once per worker process and token. Within ``WINDOW`` rows texts go to it in order of length, so that a
    batch of ``size`` pads little, and vectors come back in the order of the rows.
    """
    token = token or uuid.uuid4().hex
    source = rows.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        for batch in batches:
            if not batch.num_rows:
                continue
            model = model or held(token, load)
            for at in range(0, batch.num_rows, WINDOW):
                part = batch.slice(at, WINDOW)
                texts = part.column("text").to_pylist()
                order = sorted(range(len(texts)), key=lambda k: (len(texts[k]), k))
                made = [np.asarray(model([texts[k] for k in order[i : i + size]]), np.float32) for i in range(0, len(order), size)]
                matrix = np.concatenate(made)
                if len(matrix) != len(texts):
                    raise ValueError(f"{len(matrix)} vectors for {len(texts)} texts")
                right = np.empty_like(matrix)
                right[order] = matrix
                cuts = np.arange(0, right.size + 1, right.shape[1], dtype=np.int32)
                vectors = pa.ListArray.from_arrays(cuts, pa.array(right.ravel()))
                yield pa.record_batch([part.column("key"), vectors], ["key", out])

    key_type = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(run, f"key {key_type}, {out} array<float>").withColumnRenamed("key", key)
