"""The session's shared folder, and joins, names and sizes that operators have in common."""

from __future__ import annotations

import gc
import math
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, NumericType, StringType, StructField, StructType

_own: dict[str, str] = {}
#: Up to so many rows of a few numbers or words are sent to every task; more are joined by a shuffle, with the same result.
MOST_SENT = 200_000


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see (spark.checkpoint.dir). Where it is unset a local session (a test) takes a temporary one; on a cluster that is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None) or _own.get(spark.sparkContext.applicationId)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = _own[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="spark-shared-")
    return base.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """df written to the shared folder, its lineage cut."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def kept(df: DataFrame, name: str) -> DataFrame:
    """df as Parquet in the shared folder, read back: later steps read only the columns that they need."""
    path = f"{shared_dir(df.sparkSession)}/folio-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sent_if_small(df: DataFrame, most: int = MOST_SENT) -> DataFrame:
    """df, marked for sending to all tasks if a count shows that it has `most` rows at most. df should be cheap to read twice."""
    return F.broadcast(df) if df.count() <= most else df


def fresh(df: DataFrame | list[str], *names: str) -> list[str]:
    """Column names like the given ones that df (or a list of names) does not have (compared without case, as Spark does)."""
    taken, out = {c.lower() for c in (df if isinstance(df, list) else df.columns)}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def without(df: DataFrame, *names: str) -> DataFrame:
    """df less its columns of these names in any case: an operator's own output column replaces an input column."""
    gone = {n.lower() for n in names}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def own(df: DataFrame) -> list[Column]:
    """All columns of df, whatever signs their names hold."""
    return [F.col(f"`{c}`") for c in df.columns]


def same_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join by keys in which null meets null; each key stands once in the result, as the left side has it. Keys that cannot be null are compared plainly,
    so that sides that lie by them (see laid_by) stay where they are."""
    names = fresh(left, *[f"{k}_right" for k in keys])
    filled = lambda df: {f.name for f in df.schema.fields if not f.nullable}
    plain = filled(left) & filled(right)
    other = right.select(*[F.col(f"`{c}`").alias(names[keys.index(c)] if c in keys else c) for c in right.columns])
    condition = [F.col(f"`{k}`") == F.col(f"`{n}`") if k in plain else F.col(f"`{k}`").eqNullSafe(F.col(f"`{n}`")) for k, n in zip(keys, names, strict=True)]
    joined = left.join(other, condition, how) if keys else left.join(other, F.lit(True), how)
    return joined.drop(*names)


def laid_by(df: DataFrame, keys: list[str]) -> DataFrame:
    """df less rows with a null key, written to the shared folder by its keys: joins, sums and windows by them, or by more, need no further shuffle if the
    other side lies so too. Numbers and strings are then known not to be null."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    never = {k: F.coalesce(F.col(f"`{k}`"), F.lit(0 if isinstance(kinds[k], NumericType) else "").cast(kinds[k])) for k in keys if isinstance(kinds[k], NumericType | StringType)}
    by_key = df.dropna(subset=keys).withColumns(never).repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *[F.col(f"`{k}`") for k in keys])
    return checkpointed(by_key)


@contextmanager
def in_place(spark: SparkSession) -> Iterator[None]:
    """For steps over tables that lie by the same key (laid_by): what is planned and run meanwhile is planned once, not anew after each shuffle, and joins by
    that key and more take both sides where they lie. The session's settings return at the end."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.requireAllClusterKeysForCoPartition": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def in_parts(df: DataFrame, keys: list[str], most: int, name: str) -> list[DataFrame]:
    """df dealt by its keys into parts of about `most` rows, for steps whose tables would be too large together: each key's rows are in one part. More than one
    part is written to the shared folder once, each part to a folder of its own, without a shuffle."""
    n = math.ceil(df.count() / most)
    if n <= 1:
        return [df]
    (part,) = fresh(df, "part")
    path = f"{shared_dir(df.sparkSession)}/folio-{name}-{uuid.uuid4().hex}"
    place = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(n)).cast("int")
    df.withColumn(part, place).write.option("compression", "zstd").partitionBy(part).parquet(path)
    whole = df.sparkSession.read.schema(StructType([*df.schema.fields, StructField(part, IntegerType())])).parquet(path)
    return [whole.filter(F.col(part) == k).drop(part) for k in range(n)]


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Checkpoints made meanwhile are removed at the end, and what was shuffled for them goes once nothing refers to it; results have to be written by then."""
    context = spark.sparkContext
    context.setCheckpointDir(shared_dir(spark))
    folder = context._jvm.org.apache.hadoop.fs.Path(context.getCheckpointDir())
    try:
        yield
    finally:
        context.setCheckpointDir(shared_dir(spark))
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
        gc.collect()
        context._jvm.System.gc()


def once(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), value worked out once for a row however often `then` names it, also within functions of an array's elements."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def spread(df: DataFrame) -> DataFrame:
    """A table that was just read, dealt to all cores if it comes in fewer pieces than there are (a file of one row group): work by row is then done on
    all of them. Tables of any size come in more pieces, and stay where they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
