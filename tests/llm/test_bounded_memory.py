import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

import corpus_pipeline
from labelloom.llm.packing import pack
from labelloom.llm.scratch import materialize

CONFS = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize")


def test_long_texts_come_in_batches_of_bounded_bytes(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["rows", "bytes"])

    before = [spark.conf.get(c) for c in CONFS]
    docs = spark.range(0, 1_500, 1, 1).select(F.repeat(F.lit("x"), 20_000).alias("text"))
    got = materialize(docs.mapInArrow(sizes, "rows long, bytes long"), "test").agg(F.sum("rows"), F.max("bytes")).first()
    assert got[0] == 1_500 and got[1] < 8 << 20  # 1,000 rows had 20 MB
    assert [spark.conf.get(c) for c in CONFS] == before


def test_written_row_groups_are_bounded(spark):
    parts = F.concat(*[F.sha2(F.concat("id", F.lit(f"-{k}")), 512) for k in range(16)])
    made = materialize(spark.range(0, 16_000, 1, 1).select("id", parts.alias("text")), "test")  # 33 MB
    (file,) = made.inputFiles()
    groups = pq.ParquetFile(file.removeprefix("file:")).metadata
    assert made.count() == 16_000 and groups.num_row_groups > 1
    assert max(groups.row_group(k).total_byte_size for k in range(groups.num_row_groups)) < 20 << 20


def test_small_tables_of_the_driver_need_no_python_workers(spark):
    pieces = materialize(spark.range(20).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), (F.col("id") * 100 + 1).alias("length")), "test")
    packed = pack(pieces)
    docs = materialize(spark.range(3).selectExpr("id AS doc_id", "'a b' AS text"), "test")
    numbered = corpus_pipeline._numbered(docs)
    for df in (packed, numbered):
        assert "ExistingRDD" not in df._jdf.queryExecution().toString()  # a list goes through workers of a second kind
    assert packed.count() == 20 and numbered.select("__row").distinct().count() == 3


def test_private_keys_are_masked_wherever_they_begin(spark):
    key = "-----BEGIN RSA PRIVATE KEY-----\nQUJDREVGR0g=\n-----END RSA PRIVATE KEY-----"
    texts = [f"one {key} two", "three BEGIN RSA PRIVATE KEY four", "-----BEGIN CERTIFICATE-----\nfive", None]
    rows = [(k, t, "en", "web", len(t or "")) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in corpus_pipeline.drop_lines(spark, docs, "").collect()}
    assert got == {0: "one [SECRET] two", 1: texts[1], 2: texts[2], 3: None}
