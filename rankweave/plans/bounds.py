"""Size bounds, salting, query blocks and top-k: the parts of a plan that depend on data volume."""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankweave.functions.text import tokens
from rankweave.session import cut_lineage, scratch_path

# A side is broadcast only when it is known to hold at most this many rows, and counted bytes.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
# Queries (and their distinct terms) handled in one pass over the corpus.
BLOCK_QUERIES = 4_096
BLOCK_TERMS = 400_000
# Ranked rows whose ids are looked up one by one instead of scanning for them: always, and at most.
POINT_LOOKUPS = 1_000
MAX_LOOKUPS = 20_000
# How many ways the large side of a shuffled lookup is split per key.
SALTS = 32
FIXED_WIDTH = re.compile("boolean|tinyint|smallint|int|bigint|float|double|decimal|date|timestamp")


def lookup_join(
    large: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "inner",
    small_rows: int | None = None,
) -> DataFrame:
    """Join a large side to a lookup whose keys may be badly skewed on the large side.

    ``small_rows`` is an upper bound already known, for short rows; without one the lookup is written and its rows
    and bytes are counted. Inside the bound the lookup is broadcast and the large side is not shuffled at all. Beyond it
    both sides shuffle on (key, salt): the large side draws a salt per row, the lookup is repeated once per
    salt, so a key holding a third of all rows spreads over ``SALTS`` tasks.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"{how} would repeat lookup rows once per salt")
    if small_rows is None:
        small = cut_lineage(small, "lookup")
        long = [c for c, kind in small.dtypes if not FIXED_WIDTH.match(kind)]
        size = sum([F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in long], F.lit(16))
        small_rows, n_bytes = small.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
        if n_bytes > BROADCAST_BYTES:
            small_rows = BROADCAST_ROWS + 1
    if small_rows <= BROADCAST_ROWS:
        return large.join(F.broadcast(small), on, how)
    # short columns spread a key's rows as well as all would, without hashing texts and vectors
    short = [c for c, kind in large.dtypes if c not in on and FIXED_WIDTH.match(kind)]
    salted = large.withColumn(
        "_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in short or large.columns]), F.lit(SALTS)).cast("int")
    )
    repeated = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    # without the hint Spark takes all copies for as small as the file they are read from, and may send them to the driver
    return salted.join(repeated.hint("merge"), [*on, "_salt"], how).drop("_salt")


def rows_of_ids(
    table: DataFrame, wanted: DataFrame, key: str, max_rows: int | None = None, buckets: int = 0
) -> DataFrame:
    """Join a large table to ranked rows that name few of its keys, without moving the table.

    ``table`` is expected to be bucketed by the integer ``key`` (the catalogue). Keys that are few, or well
    below the number of ``buckets``, become an IN predicate, and only the buckets they fall in are read.
    More are broadcast; beyond the bound only ``wanted`` is shuffled, to the buckets of the table.
    """
    wanted = cut_lineage(wanted, "wanted")
    lookups = max(POINT_LOOKUPS, min(buckets // 2, MAX_LOOKUPS))
    rows = wanted.count() if max_rows is None or max_rows > lookups else max_rows
    if rows <= lookups:
        keys = ", ".join(str(int(row[0])) for row in wanted.select(key).distinct().collect())
        table = table.where(F.expr(f"{key} IN ({keys})") if keys else F.lit(False))
    if rows <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    return table.join(wanted, key)


def by_query_block(
    queries: DataFrame, run: Callable[[DataFrame, int], DataFrame], text: str | None = "query"
) -> DataFrame:
    """Run ``run(block, number of queries in it)`` over blocks small enough to be broadcast.

    Work per pass grows with (queries in the block) x (items), so the extra scans of later blocks are a
    small share of it. With more than one block each result is written before the next block starts, and
    only one block is ever held in memory.
    """
    terms = F.size(F.array_distinct(tokens(F.col(text)))) if text else F.lit(0)
    n, n_terms = queries.agg(F.count("*"), F.coalesce(F.sum(terms), F.lit(0))).first()
    blocks = max(-(-n // BLOCK_QUERIES), -(-n_terms // BLOCK_TERMS), 1)
    if blocks == 1:
        return run(queries, n)
    spark = queries.sparkSession
    path = scratch_path(spark, "blocks")
    schema = None
    for block in range(blocks):
        part = queries.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block)
        result = run(part, part.count())
        schema = result.schema
        result.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def broadcast_rows(rows: DataFrame):
    """(broadcast, table): rows of one block of queries, whose size is bounded, as an Arrow stream for tasks."""
    table = rows.toArrow()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return rows.sparkSession.sparkContext.broadcast(sink.getvalue().to_pybytes()), table


def top_k(
    df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank", id_col: str = "doc_id"
) -> DataFrame:
    """First ``k`` rows per key with their 1-based rank.

    ``row_number() <= k`` lets Spark cut every partition to k rows per key before the shuffle
    (WindowGroupLimit; up to ``spark.sql.optimizer.windowGroupLimitThreshold``, 1000 unless raised). On wide clusters k x (upstream tasks) rows per key is still a lot for one task, so
    a salted round cuts them again first.
    """
    fan_in = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 64
    ranked = F.row_number()
    if fan_in > 1:
        salt = F.pmod(F.xxhash64(id_col), F.lit(fan_in))
        df = (
            df.withColumn("_salt", salt)
            .withColumn("_cut", ranked.over(Window.partitionBy(*keys, "_salt").orderBy(*order)))
            .where(F.col("_cut") <= k)
            .drop("_cut", "_salt")
        )
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, ranked.over(window)).where(F.col(rank) <= k)
