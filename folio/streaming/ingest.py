"""Incremental ingestion with Structured Streaming: each file is read once, by the checkpoint's record of it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.plans.runtime import shared_dir


def reading(spark: SparkSession, source: str) -> DataFrame:
    """A stream of the rows of a Parquet table, be it a folder or a single file."""
    folder, name = source.rstrip("/").rsplit("/", 1)
    is_file = spark.read.format("binaryFile").option("pathGlobFilter", name).load(folder).select("path").limit(1).count()
    stream = spark.readStream.schema(spark.read.parquet(source).schema)
    return stream.option("pathGlobFilter", name).parquet(folder) if is_file else stream.parquet(source)


def run_once(spark: SparkSession, source: str, target: str, checkpoint: str, transform) -> None:
    """Processes the files of source that the checkpoint does not know, and appends to target; a failed run is repeated without loss or repeats."""
    schema = spark.read.parquet(source).schema
    folder, name = source.rstrip("/").rsplit("/", 1)
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    # a single file is a folder's one match; a table's folder is read whole
    is_file = spark.read.format("binaryFile").option("pathGlobFilter", name).load(folder).select("path").limit(1).count() if name.endswith(".parquet") else 0
    rows = stream.option("pathGlobFilter", name).parquet(folder) if is_file else stream.parquet(source)
    query = transform(rows).writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", target).trigger(availableNow=True).start()
    query.awaitTermination()


def registered(docs: DataFrame) -> DataFrame:
    """What the manifest keeps of a document."""
    return docs.select("doc_id", "source", F.length("text").cast("long").alias("n_chars"), F.sha1(F.col("text").cast("binary")).alias("sha1"))


def ingest_twice(spark: SparkSession, source: str) -> DataFrame:
    base = f"{shared_dir(spark)}/ingest-{uuid.uuid4().hex}"
    for _ in range(2):
        run_once(spark, source, f"{base}/out", f"{base}/state", registered)
    return spark.read.parquet(f"{base}/out")


def stream_totals(spark: SparkSession, source: str) -> DataFrame:
    """Events and latest time of each user, kept by streaming state; every batch writes a table of totals of its own, and the last one counts, so a
    failure in between leaves the one before."""
    base = f"{shared_dir(spark)}/totals-{uuid.uuid4().hex}"
    rows = reading(spark, source)
    totals = rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("last_ts"))

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={number}")  # a batch that is run again replaces itself

    totals.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    every = spark.read.parquet(f"{base}/out")
    return every.filter(F.col("batch") == every.agg(F.max("batch")).first()[0]).drop("batch")
