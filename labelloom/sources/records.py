"""Line-delimited JSON records: strict and tolerant reads, writes, appends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD = T.StructType(
    [
        T.StructField("record_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("label", T.StringType()),
    ]
)
EXPANDED = T.StructType(
    RECORD.fields
    + [
        T.StructField("lang", T.StringType()),
        T.StructField("conv_type", T.StringType()),
        T.StructField("register", T.StringType()),
        T.StructField("noised", T.BooleanType()),
    ]
)
NATURALIZED = T.StructType(EXPANDED.fields + [T.StructField("original_text", T.StringType())])
REQUEST = T.StructType(
    [
        T.StructField("request_id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("text", T.StringType()),
        T.StructField("context", T.MapType(T.StringType(), T.StringType())),
    ]
)
BAD = "_corrupt_record"


def read_records(
    spark: SparkSession, paths: str | list[str], schema: T.StructType = RECORD, mode: str = "strict"
) -> DataFrame:
    """Blank lines are skipped. ``strict`` raises on a malformed line; ``tolerant`` drops it,
    and drops rows without a label when the schema has one."""
    if mode == "strict":
        return spark.read.schema(schema).option("mode", "FAILFAST").json(paths)
    if mode != "tolerant":
        raise ValueError(f"mode: {mode}")
    with_bad = T.StructType(schema.fields + [T.StructField(BAD, T.StringType())])
    df = (
        spark.read.schema(with_bad)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD)
        .json(paths)
        .filter(F.col(BAD).isNull())
        .drop(BAD)
    )
    return df.filter(F.col("label").isNotNull()) if "label" in schema.names else df


def write_records(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per row, non-ASCII characters as they are."""
    df.write.mode(mode).option("ignoreNullFields", "true").json(path)


def append_records(df: DataFrame, path: str) -> None:
    """Append rows that are known to be missing (see ``pending`` and ``class_deficit``)."""
    write_records(df, path, mode="append")


def read_requests(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    return reader.schema(REQUEST).json(path)


def write_decisions(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    write_records(df, path, mode)
