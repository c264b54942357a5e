"""Per-key results where a few keys hold most rows: value-frequency compression.

Rows are grouped by key and value first. That aggregation is combined before the shuffle and spread by key and
value, so a hot key is shared by all tasks; what is left of it is one row per distinct value with its weight. Counts,
exact distinct counts and modes per key come from these weighted values by aggregations that are combined again before they
are shuffled, percentiles by ranks over the weights.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.quantiles import weighted_quantiles
from ledgerlens.session import materialise


def compress(df: DataFrame, keys: dict[str, Column], value: Column) -> DataFrame:
    """(field_name, key_value, value, weight) for every field of ``keys``; null keys and values are kept as values of their own."""
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("field_name"), c.alias("key_value")) for k, c in keys.items()]))
    rows = df.select(value.alias("value"), pairs.alias("k")).select("k.field_name", "k.key_value", "value")
    return rows.groupBy("field_name", "key_value", "value").agg(F.count("*").alias("weight"))


def key_profile(weighted: DataFrame) -> DataFrame:
    """(field_name, key_value, n_rows, n_values, n_distinct, mode, mode_rows) per key, from ``compress``.

    Null values count in n_rows only. Of equally frequent values the smallest is the mode; a key without values
    has none (null) and n_distinct 0.
    """
    has = F.col("value").isNotNull()
    # the weight of the mode by a fixed-width aggregate; the value itself is looked up among the few that reach it
    stats = weighted.groupBy("field_name", "key_value").agg(
        F.sum("weight").alias("n_rows"),
        F.coalesce(F.sum(F.when(has, F.col("weight"))), F.lit(0)).alias("n_values"),
        F.count("value").alias("n_distinct"),
        F.min(F.when(has, F.struct(-F.col("weight"), F.col("value")))).alias("best"),
    )
    return stats.select("field_name", "key_value", "n_rows", "n_values", "n_distinct", F.col("best.value").alias("mode"), (-F.col("best.col1")).alias("mode_rows"))


def key_quantiles(weighted: DataFrame, probs: list[float]) -> DataFrame:
    """Exact percentiles per key, (field_name, key_value, p, value, group_n); ``value`` of ``weighted`` is cast to double."""
    return weighted_quantiles(weighted.withColumn("value", F.col("value").cast("double")), ["field_name", "key_value"], probs)


def heavy_keys(profile: DataFrame, share: float) -> DataFrame:
    """(field_name, key_value) of the keys that hold at least ``share`` of all rows of their field, null keys counted in all rows only."""
    profile = materialise(profile.select("field_name", "key_value", "n_rows"), "profile")
    total = profile.groupBy("field_name").agg(F.sum("n_rows").alias("total"))
    # one row per field: bounded by the fields asked for, not by the data
    held = profile.join(F.broadcast(total), "field_name").where(F.col("key_value").isNotNull() & (F.col("n_rows") >= F.lit(share) * F.col("total")))
    return held.select("field_name", "key_value", "n_rows", "total")
