"""Mixing sources to target weights by capped water-filling, with seeded whole and fractional repetitions.

Sources share the sum of all sizes by weight. A source whose share is above max_epochs times its own size is clamped there, and what is
left is shared anew among the others, until none is above. With r = target / size of its source, every document is taken floor(r) times
whole; the rest of the target is filled by one more time of the documents that come first in a seeded order of the source, the last of
them only as far as the words last. So a source's taken words are its target, rounded down.

The order is that of md5(seed:id). Prefix sums run over buckets of md5 prefixes (a small table per source), and over single rows only in
the one bucket of a source where its target ends; so no task holds a source.

Edge cases: a null or wordless text has size 0 and is taken 0 times; a null source is a source of its own, last in order; equal ids are
ordered by size, and equal (id, size) rows are interchangeable; an empty table gives no rows; input columns named like the outputs are replaced.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.common import fresh, staged, without, word_count

WEIGHTS = (5, 2, 1)
#: Up to so many sources are planned by the driver and sent to all tasks; more are planned by Spark and joined by a shuffle, with the same result.
MAX_SOURCES = 1_000_000


def water_fill(sizes: list[int], weights: list[int], max_epochs: int) -> list[float]:
    """Targets that share sum(sizes) by weight, none above max_epochs times its size."""
    targets, open_, left = [0.0] * len(sizes), set(range(len(sizes))), sum(sizes)
    while open_:
        total = sum(weights[i] for i in open_)
        above = {i for i in open_ if left * weights[i] > max_epochs * sizes[i] * total}
        if not above:
            for i in open_:
                targets[i] = float(left * weights[i]) / float(total)
            break
        for i in above:
            targets[i] = float(max_epochs * sizes[i])
        left -= sum(max_epochs * sizes[i] for i in above)
        open_ -= above
    return targets


def planned(per_source: DataFrame, src: str, weights, max_epochs: int) -> DataFrame:
    """(src, source_size, n, target): the water filling of any number of sources.

    Places in order come from ranges of sources, numbered within each range. The sources above their cap are those whose size is small for their
    weight, measured by what is left for the open ones; that level only rises, so each round is one sum over all sources, until it stays.
    """
    part, place, weight = fresh(per_source, "part", "place", "weight")
    name = F.col(src).cast("string").asc_nulls_last()  # strings are in order of their bytes
    ranged = staged(per_source.repartitionByRange(name).withColumn(part, F.spark_partition_id()), "sources")
    before, upto = {}, 0
    for p, n in sorted(tuple(r) for r in ranged.groupBy(part).count().collect()):
        before[p], upto = upto, upto + n
    if not before:
        return ranged.select(src, "source_size", "n", F.lit(0.0).alias("target"))
    first = F.create_map(*[F.lit(v) for pair in before.items() for v in pair])[F.col(part)]
    ranged = ranged.withColumn(place, F.row_number().over(Window.partitionBy(part).orderBy(name)) - 1 + first)
    ranged = staged(ranged.withColumn(weight, F.element_at(F.array(*map(F.lit, weights)), (F.col(place) % len(weights) + 1).cast("int"))), "weights")
    whole = lambda c: c.cast("decimal(19,0)")
    size, w = whole(F.col("source_size")), whole(F.col(weight))
    every = ranged.agg(F.sum("source_size"), F.sum(weight)).first()
    left, total = every
    while True:
        above = whole(F.lit(left)) * w > max_epochs * size * whole(F.lit(total))
        capped = ranged.filter(above).agg(F.coalesce(F.sum(max_epochs * F.col("source_size")), F.lit(0)), F.coalesce(F.sum(weight), F.lit(0))).first()
        now = every[0] - capped[0], every[1] - capped[1]
        if now == (left, total):
            break
        left, total = now
    target = F.when(above, (max_epochs * F.col("source_size")).cast("double")).otherwise((whole(F.lit(left)) * w).cast("double") / F.lit(float(total)))
    return ranged.select(src, "source_size", "n", target.alias("target"))


def mix(df: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", weights=WEIGHTS, max_epochs: int = 3, seed: int = 17, bucket_rows: int = 4096) -> DataFrame:
    """Adds size, source_size, target (of the row's source) and taken (words) to every row. Of up to MAX_SOURCES sources the table comes to the driver."""
    df = without(df, "size", "source_size", "target", "taken")
    src, order, bucket, whole, rest, upto, mine = fresh(df, "mix_source", "mix_order", "mix_bucket", "mix_whole", "mix_rest", "mix_upto", "mix_sum")
    sized = df.withColumn("size", word_count(F.col(text)))
    table = staged(sized.groupBy(F.col(source).alias(src)).agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")), "sizes")
    spark, few = df.sparkSession, table.count() <= MAX_SOURCES
    if few:
        per_source = table.collect()
        # code point order is that of the UTF-8 bytes; null is last
        per_source.sort(key=lambda r: (r[0] is None, str("" if r[0] is None else r[0]).encode()))
        sizes = [r[1] for r in per_source]
        targets = water_fill(sizes, [weights[i % len(weights)] for i in range(len(sizes))], max_epochs)
        rows = []
        for r, t in zip(per_source, targets, strict=True):
            times = min(max_epochs, int(Fraction(t) / r[1])) if r[1] else 0
            rows.append((r[0], r[1], t, times, int(t) - times * r[1] if r[1] else 0))
        plan = spark.createDataFrame(rows, f"`{src}` {sized.schema[source].dataType.simpleString()}, source_size long, target double, `{whole}` long, `{rest}` long")
        most = max([1, *(r[2] for r in per_source)])
    else:
        plan = planned(table, src, weights, max_epochs)
        most = plan.agg(F.max("n")).first()[0]
        floor_ = F.floor("target").cast("long")
        times = F.when(F.col("source_size") > 0, F.least(F.lit(max_epochs).cast("long"), F.expr("CAST(floor(target) AS BIGINT) div nullif(source_size, 0)"))).otherwise(0)
        plan = staged(plan.withColumn(whole, times).withColumn(rest, F.when(F.col("source_size") > 0, floor_ - F.col(whole) * F.col("source_size")).otherwise(0)).drop("n"), "plan")
    sent = F.broadcast if few else (lambda d: d)
    digits = 1
    while 16**digits * bucket_rows < most and digits < 8:
        digits += 1
    ordered = (
        sized.withColumn(order, F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))))
        .withColumn(bucket, F.substring(order, 1, digits))
    )
    # the sums of buckets, and for each source the words before each bucket
    sums = ordered.groupBy(F.col(source).alias(src), bucket).agg(F.sum("size").alias(mine))
    sums = sums.withColumn(upto, F.sum(mine).over(Window.partitionBy(src).orderBy(bucket)) - F.col(mine))
    ends = sums.join(sent(plan), sums[src].eqNullSafe(plan[src])).filter((F.col(upto) <= F.col(rest)) & (F.col(upto) + F.col(mine) > F.col(rest)))
    ends = ends.select(sums[src], F.col(bucket).alias("last_bucket"), F.col(upto).alias("last_upto"))
    end_src, last, last_upto = fresh(ordered, "end_source", "last_bucket", "last_upto")
    ends = ends.toDF(end_src, last, last_upto)
    # one row for each source in both tables
    joined = ordered.join(sent(plan), ordered[source].eqNullSafe(plan[src]), "left").join(sent(ends), F.col(src).eqNullSafe(F.col(end_src)), "left")
    here = F.coalesce(F.col(bucket) == F.col(last), F.lit(False))
    # only the rows of those buckets are put in order; the others never move
    w = Window.partitionBy(src, end_src).orderBy(order, "size").rowsBetween(Window.unboundedPreceding, -1)
    within = joined.filter(here).withColumn(mine, F.coalesce(F.sum("size").over(w), F.lit(0)) + F.col(last_upto))
    joined = joined.filter(~here).withColumn(mine, F.lit(None).cast("long")).unionByName(within)
    more = (
        F.when(F.col(last).isNull() | (F.col(bucket) < F.col(last)), F.when(F.col(rest) > 0, F.col("size")).otherwise(0))
        .when(here, F.greatest(F.lit(0), F.least(F.col("size"), F.col(rest) - F.col(mine))))
        .otherwise(0)
    )
    taken = (F.col(whole) * F.col("size") + more).cast("long")
    return joined.select(*[f"`{c}`" for c in df.columns], "size", "source_size", "target", taken.alias("taken"))
