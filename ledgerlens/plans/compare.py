"""Extensions on dated classifications: two periods side by side, and changes of segment over time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.text import col


def compare_periods(before: DataFrame, after: DataFrame, key: str, value: str = "CA_EUR") -> DataFrame:
    """One row per key of either: segment and value before and after. Null keys meet; a key of one side only has nulls on the other."""
    a = before.select(col(key).alias("k"), F.col("segment").alias("segment_before"), col(value).alias("value_before"))
    b = after.select(col(key).alias("k2"), F.col("segment").alias("segment_after"), col(value).alias("value_after"))
    both = a.join(b, F.col("k").eqNullSafe(F.col("k2")), "full_outer")
    return both.select(F.coalesce("k", "k2").alias(key), "segment_before", "segment_after", "value_before", "value_after")


def transitions(history: DataFrame, key: str, when: str, segment: str = "segment") -> DataFrame:
    """Rows where a key's segment differs from that of its previous date, with the segment before."""
    w = Window.partitionBy(col(key)).orderBy(col(when))
    return history.withColumn("previous_segment", F.lag(segment).over(w)).where(F.col("previous_segment").isNotNull() & (F.col("previous_segment") != F.col(segment)))
