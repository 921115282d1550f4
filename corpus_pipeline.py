"""A corpus from raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again for the next.
All but the last return the columns of ``documents``; ``n_chars`` follows the text. Nulls, empty tables, repeated rows and other
columns are treated as the operator of each stage says; rows with a null doc_id pass the two deduplications.
"""

from __future__ import annotations

from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.llm import quality
from labelloom.llm.bitmaps import bitmap, bits_for, holds
from labelloom.llm.line_dedup import dedup_lines
from labelloom.llm.ngram_join import jaccard_components
from labelloom.llm.packing import pack_documents
from labelloom.llm.scratch import materialize
from labelloom.llm.secret_scan import KEY_BEGIN, PRIVATE_KEY, redact, secret_spans
from labelloom.llm.workers import task

METADATA = ("n_chars",)
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    learn = labels.filter(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) != 1)
    model = quality.train(docs, learn, "quality", METADATA)
    scored = quality.score(docs, model, METADATA, tuple(docs.columns))
    return scored.filter(F.col("__score") >= 0.5).drop("__score")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat earlier ones.

    Private keys are masked first: their BEGIN and END lines are common lines, without which the secret scan would not know the rest.
    """
    text = F.col("text")
    masked = F.when(text.contains(KEY_BEGIN), F.regexp_replace(text, PRIVATE_KEY, "[SECRET]")).otherwise(text)  # the texts are read several times
    return _counted(dedup_lines(docs.withColumn("text", masked)))


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__row``, a number of the row's own: by file, then by place in the file.

    Rows of Parquet files are numbered where they are; of another table, or where rows of a file come several times, a copy is written first.
    """
    try:
        place = docs.metadataColumn("_metadata")
        placed = docs.withColumns({"__file": place["file_path"], "__row": place["row_index"]})
        if not placed.groupBy("__file", "__row").count().filter("count > 1").isEmpty():
            raise ValueError("rows that come several times")
    except (AnalysisException, ValueError):
        return _numbered(materialize(docs, "rows"))
    paths = sorted(r[0] for r in placed.select("__file").distinct().collect())  # as many as the driver lists anyway
    # an Arrow table stays in the driver, where a list would go through Python workers of a second kind, which then stay
    files = docs.sparkSession.createDataFrame(pa.table({"__file": pa.array(paths, pa.string()), "__part": pa.array(range(len(paths)), pa.int64())}))
    return placed.join(F.broadcast(files), "__file").withColumn("__row", F.shiftleft("__part", 36) + F.col("__row")).select(*docs.columns, "__row")


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each class of the n-gram Jaccard join.

    Every row is compared for itself, whatever its doc_id: of rows with equal ids in a class one stays, the first as written; rows
    with equal ids in several classes may all stay. Rows without words are in no class with others and stay, and so do rows with a null doc_id.
    Texts are not shuffled: a bitmap tells the rows that surely stay, and only the others meet the rows that go.
    """
    keyed = _numbered(docs)
    known = keyed.filter("doc_id IS NOT NULL")
    classes = jaccard_components(known.select(F.col("__row").alias("doc_id"), "text"))
    named = classes.select(F.col("doc_id").alias("__row"), "component_id").join(known.select("__row", "doc_id"), "__row")
    named = materialize(named, "named")
    several = named.groupBy("component_id").agg(F.min(F.struct("doc_id", "__row")).alias("least"), F.count("*").alias("rows")).filter("rows > 1")
    gone = named.join(several, "component_id").filter(F.col("__row") != F.col("least.__row")).select("__row")
    gone = materialize(gone, "gone")
    table = spark.sparkContext.broadcast(bitmap(gone, F.xxhash64("__row"), bits_for(gone.count())))
    marked = keyed.withColumn("__mark", F.xxhash64("__row"))
    sure, asked = (marked.mapInArrow(task(_marked(table, hit)), marked.schema) for hit in (False, True))
    return sure.unionByName(asked.join(gone, "__row", "left_anti").select(*marked.columns)).select(*docs.columns)


def _marked(table, hit: bool):
    """Rows whose last column's bit is set in ``table``, or those where it is not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(holds(table.value, batch.column(batch.num_columns - 1).to_numpy()) == hit))

    return run


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked."""
    return _counted(redact(docs, materialize(secret_spans(docs), "secrets")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens with their sequence and place."""
    return pack_documents(docs, TOKENIZER)


STAGES = [
    ("quality", keep_good),
    ("line_dedup", drop_lines),
    ("ngram_jaccard", keep_one_of_near_copies),
    ("secret_scan", mask_secrets),
    ("packing", pack_sequences),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
