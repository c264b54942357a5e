"""Union, de-duplication and derived columns of raw operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.text import col, q


def concat_by_name(frames: list[DataFrame]) -> DataFrame:
    """Bag union by column name; a column that a frame lacks is null there. Duplicates are kept."""
    if not frames:
        raise ValueError("nothing to concatenate")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the given order; null keys are one key.

    Spark drops all but the first row of a key before the shuffle too (window group limit), so a key that repeats in a
    third of all rows sends one row per task. ``order`` must be total for a result that doesn't depend on the layout.
    """
    w = Window.partitionBy(*[col(k) for k in keys]).orderBy(*[col(o) for o in order])
    return df.withColumn("__keep_first_rn__", F.row_number().over(w)).where("__keep_first_rn__ = 1").drop("__keep_first_rn__")


def removed_count(df: DataFrame, key: str) -> DataFrame:
    """One row with the counts before and after keeping the first row of each key; null is one key."""
    per_key = df.groupBy(col(key)).agg(F.count("*").alias("n"))
    return per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"), F.count("*").alias("rows_after")).withColumn("removed", F.col("rows_before") - F.col("rows_after"))


def with_period(df: DataFrame, year: str = "Year", month: str = "Month", out: str = "Period") -> DataFrame:
    """Adds the first day of the month; null where a part is null or no such month exists. Without both columns the frame is unchanged."""
    if not {year, month} <= set(df.columns):
        return df
    y, m = (F.expr(f"try_cast({q(c)} as int)") for c in (year, month))
    return df.withColumn(out, F.try_to_date(F.format_string("%04d-%02d-01", y, m), "yyyy-MM-dd"))
