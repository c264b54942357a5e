"""Exact percentiles of weighted values per group, without gathering a group in one task.

A histogram over signed logarithmic buckets tells which bucket holds a rank. Only the values in that bucket are
looked at again; while they are too many for one task, the span is cut into equal parts, counted, and narrowed to
the part that holds the rank. A span is always given by values that occur, so it ends at a single value at the latest.
"""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import drop_scratch, join_small, materialise

#: Values below this in size share the bucket 0.
SMALLEST = 1e-12
#: Distinct values of one span that a task may sort; parts that a larger span is cut into.
SPAN_VALUES, PARTS = 100_000, 1024


def log_bucket(x: Column, gamma: float) -> Column:
    """Signed logarithmic bucket of a double: k > 0 holds (SMALLEST * gamma**(k-1), SMALLEST * gamma**k], -k the negatives, 0 what is smaller."""
    size = F.abs(x)
    top = int((math.log(1.79e308) - math.log(SMALLEST)) / math.log(gamma)) + 2
    k = F.greatest(F.lit(1), F.ceil((F.log(F.least(size, F.lit(1.79e308))) - math.log(SMALLEST)) / math.log(gamma)))
    k = F.when(size == float("inf"), F.lit(top)).otherwise(F.least(k, F.lit(top - 1)))
    return F.when(size < SMALLEST, F.lit(0)).when(x > 0, k).otherwise(-k).cast("int")


def bucket_middle(k: Column, gamma: float) -> Column:
    """The value whose relative error to everything in the bucket is at most (gamma - 1) / (gamma + 1)."""
    size = F.lit(SMALLEST) * F.pow(F.lit(gamma), F.abs(k)) * (2 / (gamma + 1))
    return F.when(k == 0, F.lit(0.0)).otherwise(F.signum(k.cast("double")) * size)


def rank_of(p: float, n: Column) -> Column:
    """ceil(p * n), at least 1; p is taken as the decimal it is written as."""
    return F.greatest(F.lit(1), F.ceil(F.lit(Decimal(str(p))) * n)).cast("long")


def locate(hist: DataFrame, group: list[str], probs: list[float]) -> DataFrame:
    """Of a histogram (group, bucket, n): for each p the bucket that holds rank ceil(p n), and the rank inside it.

    A group has as many rows as buckets, which the width of the buckets bounds.
    """
    w = Window.partitionBy(*group)
    cum = F.sum("n").over(w.orderBy("bucket"))
    at = hist.select(*group, "bucket", "n", (cum - F.col("n")).alias("below"), F.sum("n").over(w).alias("group_n"))
    wanted = F.explode(F.array(*[F.struct(F.lit(float(p)).alias("p"), rank_of(p, F.col("group_n")).alias("rank")) for p in probs]))
    at = at.withColumn("want", wanted).where("want.rank > below and want.rank <= below + n")
    return at.select(*group, "bucket", F.col("want.p").alias("p"), (F.col("want.rank") - F.col("below")).alias("rank"), "n", "group_n")


def resolve(values: DataFrame, cells: DataFrame, group: list[str]) -> DataFrame:
    """The values at the ranks of ``cells``. ``values``: (group, bucket, value, weight); ``cells``: from ``locate``. Gives (group, p, value, group_n).

    Null group keys are a group of their own.
    """
    keys = [*group, "bucket"]
    null_safe = lambda df: df.withColumns({f"_g{i}": F.coalesce(F.concat(F.lit("="), F.col(g).cast("string")), F.lit("null")) for i, g in enumerate(group)})
    on = [*(f"_g{i}" for i in range(len(group))), "bucket"]
    inside = join_small(null_safe(values).drop(*group), materialise(null_safe(cells), "cells"), on).groupBy(*keys, "p", "rank", "group_n", "value").agg(F.sum("weight").alias("weight"))
    inside = old = materialise(inside, "span")
    span = Window.partitionBy(*keys, "p")
    while (most := inside.groupBy(*keys, "p").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0) > SPAN_VALUES:
        ends = inside.groupBy(*keys, "p").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
        joined = join_small(null_safe(inside).withColumn("_p", F.col("p")), materialise(null_safe(ends).withColumn("_p", F.col("p")).drop(*group, "p"), "ends"), [*on, "_p"])
        part = F.least(F.lit(PARTS - 1), F.floor((F.col("value") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2) * PARTS))
        joined = joined.withColumn("part", F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(part))
        counts = joined.groupBy(*keys, "p", "part").agg(F.sum("weight").alias("n"))
        counts = counts.withColumn("below", F.sum("n").over(span.orderBy("part")) - F.col("n"))
        marks = materialise(null_safe(counts).withColumn("_p", F.col("p")).drop(*group, "p"), "parts")
        kept = join_small(joined.drop("n"), marks, [*on, "_p", "part"]).where("rank > below and rank <= below + n")
        kept = kept.withColumn("rank", F.col("rank") - F.col("below")).select(*keys, "p", "rank", "group_n", "value", "weight")
        inside = materialise(kept, "span")
        drop_scratch(values.sparkSession, old.inputFiles()[0].rpartition("/")[0])
        old = inside
        if most == inside.count():  # nothing could be cut off: values closer together than doubles can be parted
            break
    cum = F.sum("weight").over(span.orderBy("value"))
    found = inside.withColumn("below", cum - F.col("weight")).where("rank > below and rank <= below + weight")
    return found.select(*group, "p", "value", "group_n")


def weighted_quantiles(values: DataFrame, group: list[str], probs: list[float], gamma: float = 1.02) -> DataFrame:
    """Exact values at rank ceil(p n) per group of ``values`` (group, value double, weight); nulls and NaN don't count.

    Gives (group, p, value, group_n). Ties and repeated rows count as often as they occur; a group without values has no rows.
    """
    if taken := set(group) & {"bucket", "p", "rank", "n", "group_n", "value", "weight"}:
        raise ValueError(f"group columns can't be named {', '.join(sorted(taken))}")
    rows = values.where("value is not null and not isnan(value)").select(*group, "value", "weight", log_bucket(F.col("value"), gamma).alias("bucket"))
    hist = rows.groupBy(*group, "bucket").agg(F.sum("weight").alias("n"))
    return resolve(rows, locate(hist, group, probs), group)
