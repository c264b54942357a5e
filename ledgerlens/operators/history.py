"""History of changing attributes: per-attribute change logs, combined into versions.

Each attribute has a change log of its own, an event wherever its value differs from the one before. Versions come
from splitting time at the union of all boundary dates and joining neighbours that agree in every attribute.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FOREVER = "9999-12-31"


def latest_per_date(df: DataFrame, entity: str, date: str, received: list[str], payload: list[str]) -> DataFrame:
    """One row per entity and date: the one received last. Combined before the shuffle, so repeated deliveries of one entity don't gather."""
    best = F.max(F.struct(*received, *payload)).alias("best")
    return df.where(F.col(entity).isNotNull() & F.col(date).isNotNull()).groupBy(entity, date).agg(best).select(entity, date, *[F.col(f"best.{p}").alias(p) for p in payload])


def change_log(states: DataFrame, entity: str, date: str, attributes: list[str], active: str) -> DataFrame:
    """(entity, date, attribute, value, valid_to) of every attribute by itself; the row's activity is the attribute ``active``.

    A null attribute keeps the value before it; until there is one it is unknown (null). An entity has one row a date,
    so a window over it is bounded by the dates.
    """
    by = Window.partitionBy(entity).orderBy(date)
    known = states.select(entity, date, F.col(active).cast("string").alias(active), *[F.last(a, ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, 0)).alias(a) for a in attributes])
    names = [*attributes, active]
    changed = known.select(entity, date, *[F.struct((~F.col(a).eqNullSafe(F.lag(a).over(by)) | (F.row_number().over(by) == 1)).alias("new"), F.col(a).alias("value")).alias(a) for a in names])
    events = changed.select(entity, date, F.explode(F.filter(F.array(*[F.struct(F.lit(a).alias("attribute"), F.col(a)["new"].alias("new"), F.col(a)["value"].alias("value")) for a in names]), lambda x: x["new"])).alias("e"))
    nxt = F.lead(date).over(Window.partitionBy(entity, "attribute").orderBy(date))
    return events.select(entity, date, "e.attribute", "e.value").withColumn("valid_to", nxt)


def combine(log: DataFrame, entity: str, date: str, attributes: list[str], active: str) -> DataFrame:
    """Versions (entity, attributes, valid_from, valid_to) while ``active`` is 'true', from a change log.

    Time is split at every boundary date of any attribute; pieces that agree with the one before are joined to it.
    valid_to is exclusive, and null while the version is open.
    """
    names = [*attributes, active]
    at = log.groupBy(entity, date).agg(*[F.max(F.when(F.col("attribute") == a, F.struct(F.lit(True).alias("set"), F.col("value")))).alias(a) for a in names])
    by = Window.partitionBy(entity).orderBy(date)
    held = at.select(entity, date, *[F.last(a, ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, 0))["value"].alias(a) for a in names])
    same: Column = F.lit(True)
    for a in names:
        same = same & F.col(a).eqNullSafe(F.lag(a).over(by))
    pieces = held.withColumn("same", same & (F.row_number().over(by) > 1)).where(~F.col("same"))
    versions = pieces.select(entity, *attributes, active, F.col(date).alias("valid_from"), F.lead(date).over(by).alias("valid_to"))
    return versions.where(F.col(active) == "true").drop(active)


def attribute_history(df: DataFrame, entity: str, date: str, received: list[str], attributes: list[str], active: str) -> DataFrame:
    """Full history of ``attributes``, a row per version, from snapshots and updates that may arrive late and more than once.

    Of several rows for an entity and date the last in the order of ``received`` counts. Rows without entity or date
    are left out; dates left out change nothing; an empty table gives no rows.
    """
    states = latest_per_date(df, entity, date, received, [*attributes, active])
    return combine(change_log(states, entity, date, attributes, active), entity, date, attributes, active)
