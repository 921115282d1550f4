"""Written intermediate tables in the folder that the cluster shares.

The folder is ``spark.checkpoint.dir`` of the session; where that is unset (tests), a folder in
the warehouse is used. A written table cuts the lineage and survives lost executors.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


#: Rows may hold whole texts: small batches, and small groups of rows in the files, bound the memory of readers and writers.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1_000, "spark.sql.parquet.columnarReaderBatchSize": 500}
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
GROUP_BYTES = 8 << 20  # of a Parquet row group, which its writer holds whole


def shared_folder(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (named or spark.conf.get("spark.sql.warehouse.dir") + "/_scratch").rstrip("/")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to a new folder and read it again."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    given = {name: spark.conf.get(name) for name in (*BATCHES, BATCH_BYTES)}
    try:
        for name, most in BATCHES.items():
            spark.conf.set(name, str(min(int(given[name]), most) if int(given[name]) > 0 else most))
        spark.conf.set(BATCH_BYTES, "4m")
        df.write.option("parquet.block.size", GROUP_BYTES).parquet(path)
    finally:
        for name, value in given.items():
            spark.conf.set(name, value)
    return spark.read.schema(df.schema).parquet(path)
