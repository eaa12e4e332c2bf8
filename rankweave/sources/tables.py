"""Plain readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankweave.sources.records import read_records

FILTER_FIELDS = [
    T.StructField("country", T.StringType()),
    T.StructField("variety", T.StringType()),
    T.StructField("color", T.StringType()),
    T.StructField("price_min", T.DoubleType()),
    T.StructField("price_max", T.DoubleType()),
    T.StructField("points_min", T.DoubleType()),
    T.StructField("points_max", T.DoubleType()),
    T.StructField("query", T.StringType()),
    T.StructField("_source", T.StringType()),
]
QUERY_SET_SCHEMA = T.StructType(
    [
        T.StructField("query_id", T.LongType()),
        T.StructField("query", T.StringType()),
        T.StructField("filters", T.StructType(FILTER_FIELDS)),
        T.StructField("eligible_count", T.LongType()),
    ]
)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace whatever the path holds."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, line_breaks: bool = True
) -> DataFrame:
    """CSV with a header and doubled quotes; types are inferred without a schema. A file is split over tasks.

    Quoted line breaks are part of their field. Without ``line_breaks`` every line is a record, which saves writing the lines
    once, and is wrong for files that have such breaks.
    """
    if line_breaks:
        return read_records(spark, path, schema)
    reader = spark.read.option("header", True).option("escape", '"')
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).option("escape", '"').csv(path)


def write_query_set(df: DataFrame, path: str) -> None:
    """One JSON record per query with the nested filter record; unset filters stay as explicit nulls."""
    df.write.option("ignoreNullFields", False).json(path)


def read_query_set(spark: SparkSession, path: str, array: bool = False) -> DataFrame:
    """A frozen query set. ``array`` reads one JSON array per file instead of one record per line."""
    return spark.read.schema(QUERY_SET_SCHEMA).option("multiLine", array).json(path)


# SQL names of the column types in use.
SQL_TYPE_NAMES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "float": "FLOAT", "timestamp": "TIMESTAMP",
}


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type and null count, from a single pass over the data."""
    nulls = df.agg(*[F.sum(F.col(c).isNull().cast("bigint")).alias(c) for c in df.columns])
    entries = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("column_name"),
            F.lit(SQL_TYPE_NAMES.get(kind, kind.upper())).alias("column_type"),
            F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias("n_null"),
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return nulls.select(F.inline(F.array(*entries)))
