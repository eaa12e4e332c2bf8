"""CSV whose quoted fields may hold line breaks, read by many tasks.

A line break ends a record unless an odd number of quotes lies before it. A split of a file cannot know how many lie before
its first byte, so the lines are read once, with their split and the quotes in each, and kept in the shared folder. The
parity at which a split starts is a prefix sum over splits, one small row each. With it every split finds the records that
begin in it; what a split holds of a record that began earlier, or that it cannot finish, are fragments, two a split at
most, put together by the split in which the record begins. Records then go through Spark's own CSV parser.

Types come from one aggregate over the parsed text: per column the widest type that any value needs.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankweave.session import cut_lineage

QUOTE = '"'
# Lines joined into records at once.
LINES_AT_ONCE = 4096
# The types that text may stand for, narrow to wide; a column takes the widest one that any of its values needs.
LATTICE = ("void", "int", "bigint", "double", "timestamp", "boolean", "string")
NUMBERS = (1, 2, 3)


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """Every line with its file, the first byte of its split, and its quotes; written, so that the files are read once."""
    text = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    rows = text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begin"),
        F.col("value").alias("line"), quotes.cast("int").alias("quotes"),
    )
    # the order of lines within a split is kept by a number, since a written file may be cut into splits of its own
    return cut_lineage(rows.withColumn("at", F.monotonically_increasing_id()), "lines")


def split_starts(lines: DataFrame) -> DataFrame:
    """(file, begin, odd, n, open): whether a split begins inside quotes, and its lines. One row per split of a file."""
    splits = lines.groupBy("file", "begin").agg(
        (F.sum("quotes") % 2).cast("int").alias("odd"), F.count("*").alias("n")
    )
    before = Window.partitionBy("file").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    return splits.withColumn("open", F.pmod(F.coalesce(F.sum("odd").over(before), F.lit(0)), F.lit(2)) == 1)


def fragments_of(lines: DataFrame, starts: DataFrame) -> DataFrame:
    """(file, begin, kind, record, first): whole records, and heads and tails of those that go over an end of a split.

    ``kind`` is 0 for a whole record, 1 for a tail (it begins here), 2 for a head (it ends here), 3 for a split that is
    all inside one record. ``first`` marks the first record of a file.
    """
    # one row per split of a file, which a task holds the lines of
    rows = lines.join(F.broadcast(starts.select("file", "begin", "open", "n")), ["file", "begin"])
    rows = rows.repartition("file", "begin").sortWithinPartitions("file", "begin", "at")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, inside, begun, left, first = None, [], False, True, 0, False
        out: list[tuple] = []

        def flush(kind: int) -> None:
            nonlocal first
            out.append((key[0], key[1], kind, "\n".join(held), first and kind in (0, 1)))
            first = first and kind not in (0, 1)
            held.clear()

        for batch in batches:
            for at in range(0, batch.num_rows, LINES_AT_ONCE):
                part = batch.slice(at, LINES_AT_ONCE)
                files, begins, texts, quotes, opens, counts = [part.column(k).to_pylist() for k in range(6)]
                for file, begin, text, odd, opened, n in zip(files, begins, texts, quotes, opens, counts):
                    if key != (file, begin):
                        key, inside, begun, left, first = (file, begin), opened, not opened, n, begin == 0
                    held.append(text)
                    inside ^= bool(odd % 2)
                    left -= 1
                    if not inside:
                        flush(0 if begun else 2)
                        begun = True
                    elif not left:
                        flush(1 if begun else 3)
                if out:
                    yield rows_of(out)
                    out.clear()

    def rows_of(found: list[tuple]) -> pa.RecordBatch:
        file, begin, kind, record, head = zip(*found)
        columns = [pa.array(file), pa.array(begin, pa.int64()), pa.array(kind, pa.int32()), pa.array(record), pa.array(head)]
        return pa.record_batch(columns, ["file", "begin", "kind", "record", "first"])

    slim = rows.select("file", "begin", "line", "quotes", "open", "n")
    return slim.mapInArrow(kernel, "file string, begin long, kind int, record string, first boolean")


def records_of(spark: SparkSession, path: str) -> DataFrame:
    """(record, first): the text of every record of the files, line breaks included; ``first`` is a file's first one."""
    lines = lines_of(spark, path)
    parts = cut_lineage(fragments_of(lines, split_starts(lines)), "records")
    whole = parts.where("kind = 0").select("record", "first")
    # a record over several splits begins in the last split before with a tail: two fragments a split at most
    pieces = parts.where("kind > 0")
    since = Window.partitionBy("file").orderBy("begin", F.col("kind") == 1).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    owned = pieces.withColumn("of", F.max(F.when(F.col("kind") == 1, F.col("begin"))).over(since))
    piece = F.struct("begin", (F.col("kind") == 1).alias("later"), "record", "first")
    stitched = owned.groupBy("file", "of").agg(F.sort_array(F.collect_list(piece)).alias("p"))
    return whole.unionByName(
        stitched.select(F.array_join("p.record", "\n").alias("record"), F.exists("p.first", lambda x: x).alias("first"))
    )


def needed_type(value: Column) -> Column:
    """Place in ``LATTICE`` of the narrowest type that the text stands for; 0 for NULL."""
    text = F.trim(value)
    whole = F.rlike(text, F.lit(r"^[+-]?[0-9]+$"))
    return (
        F.when(value.isNull(), 0)
        .when(whole & text.try_cast("int").isNotNull(), 1)
        .when(whole & text.try_cast("bigint").isNotNull(), 2)
        .when(F.rlike(text, F.lit(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$")) | text.isin("NaN", "Infinity", "-Infinity"), 3)
        .when(F.rlike(text, F.lit("^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T]|$)")) & text.try_cast("timestamp").isNotNull(), 4)
        .when(F.lower(text).isin("true", "false"), 5)
        .otherwise(6)
    )


def inferred(parsed: DataFrame) -> T.StructType:
    """Column types from one aggregate over text columns: the set of types needed, merged in any order."""
    sets = parsed.agg(*[F.bit_or(F.call_function("shiftleft", F.lit(1), needed_type(F.col(f"`{c}`")))).alias(f"c{k}") for k, c in enumerate(parsed.columns)])
    row = sets.first()
    fields = []
    for k, name in enumerate(parsed.columns):
        needed = [i for i in range(1, len(LATTICE)) if (row[k] or 0) >> i & 1]
        if not needed:
            kind = "string"
        elif all(i in NUMBERS for i in needed):
            kind = LATTICE[max(needed)]
        else:
            kind = LATTICE[needed[0]] if len(needed) == 1 else "string"
        fields.append(T.StructField(name, T._parse_datatype_string(kind)))
    return T.StructType(fields)


def header_of(record: str) -> list[str]:
    """Column names of a header record, as Spark names them: by place where they are empty, with it where they repeat."""
    names = next(csv.reader([record.rstrip("\r")], quotechar=QUOTE))
    folded = [x.lower() for x in names]
    return [f"_c{k}" if not x else f"{x}{k}" if folded.count(x.lower()) > 1 else x for k, x in enumerate(names)]


def read_records(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header, doubled quotes and line breaks inside quotes; types are inferred without a schema."""
    records = records_of(spark, path)
    body = records.where(~F.col("first") & (F.trim(F.regexp_replace("record", "\r$", "")) != ""))
    if schema is None:
        # one row per file
        named = records.where("first").select(F.min("record")).first()[0]
        if named is None:
            raise ValueError(f"no header below {path}")
        wanted = T.StructType([T.StructField(c, T.StringType()) for c in header_of(named)])
    else:
        wanted = schema
    # a line break would end the record for the parser: it goes in as another character and comes back out of the text
    stand_in = "\uE00A"
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in wanted.fields])
    line = F.translate(F.regexp_replace("record", "\r$", ""), "\n", stand_in)
    options = {"escape": QUOTE, "quote": QUOTE, "maxCharsPerColumn": "-1", "mode": "PERMISSIVE"}
    parsed = body.select(F.from_csv(line, _ddl(text), options).alias("r")).select("r.*")
    parsed = parsed.select(*[F.translate(F.col(f"`{f.name}`"), stand_in, "\n").alias(f.name) for f in text.fields])
    kinds = inferred(parsed) if schema is None else schema
    return parsed.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in kinds.fields])


def _ddl(schema: T.StructType) -> str:
    return ", ".join("`{}` STRING".format(f.name.replace("`", "``")) for f in schema.fields)
