"""The corpus pipeline: language ID, near-dedup, benchmark decontamination, mixing to target weights, and sharding, in this order.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with the columns of documents; the last adds shard and slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import decontam, langid, mixing, neardup, sharding
from folio.llm.common import fresh, read, sent_if_small, staged

#: A document is rejected if the network gives its best language less than this probability, or finds no letter in it.
LEAST_SCORE = 0.4
SHARDS = 16


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language is recognised. Learns from the documents that name theirs; lang itself is not looked at to decide."""
    model = langid.train(docs.filter(F.col("doc_id").isNotNull()))
    known = langid.predict(docs, model).filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return known.select(*[f"`{c}`" for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked at 0.8 on five-word shingles; of rows that repeat an id the first by hash stays, rows without an id all stay."""
    found = staged(neardup.near_duplicates(docs, shingle=5, percent=80).groupBy("doc_id").agg(F.min("component_id").alias("c"), F.count(F.lit(1)).alias("n")), "found")
    flag, times = fresh(docs, "dropped_id", "times")
    odd = found.filter("doc_id IS NOT NULL AND (doc_id <> c OR n > 1)").select(F.col("doc_id").alias(flag), F.when(F.expr("doc_id = c"), F.col("n")).otherwise(0).alias(times))
    rows = docs.join(sent_if_small(odd), docs["doc_id"] == odd[flag], "left")
    once = rows.filter(F.col(flag).isNull()).select(*[f"`{c}`" for c in docs.columns])
    if not odd.filter(F.col(times) > 1).limit(1).count():
        return once
    every = [F.col(f"`{c}`") for c in docs.columns]
    first = rows.filter(F.col(times) > 1).groupBy("doc_id").agg(F.min(F.struct(F.xxhash64(*every).alias("h"), *every)).alias("first"))
    return once.unionByName(first.select(*[F.col("first")[c].alias(c) for c in docs.columns]))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that hold no benchmark item, verbatim or with other numbers, names and units."""
    return decontam.clean(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents as the mix takes them; a document that is taken in part counts as the nearest whole number of times."""
    (times,) = fresh(docs, "times")
    mixed = mixing.mix(docs)
    rows = mixed.withColumn(times, F.round(F.col("taken") / F.greatest(F.col("size"), F.lit(1))).cast("int")).filter(F.col(times) > 0)
    return rows.withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*[f"`{c}`" for c in docs.columns])


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A uniform shuffle into 16 shards whose sizes differ by one row at most."""
    return sharding.shuffle(docs, SHARDS)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontamination", decontamination), ("mix_sources", mix_sources), ("shard", shard)]
#: Hashing, training and a seeded shuffle are not SQL; tests/llm/test_pipeline.py checks each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
