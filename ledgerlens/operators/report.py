"""Distribution of classified customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.schema import SEGMENT


def _share(part, whole):
    """Percent to one decimal, halves to even; null of a zero total."""
    return F.rint(F.try_divide(part.cast("double") * 100, whole.cast("double")) * 10) / 10


def distribution(classified: DataFrame) -> DataFrame:
    """segment, nb_clients, % and, where CA_EUR exists, CA_total_EUR and %_CA; most clients first, ties by name.

    One aggregation gives counts and totals; the totals over all segments come from a window over its few rows.
    """
    has_ca = "CA_EUR" in classified.columns
    aggs = [F.count("*").alias("nb_clients")]
    if has_ca:
        aggs.append(F.coalesce(F.sum(F.when(~F.isnan(F.col("CA_EUR").cast("double")), F.col("CA_EUR")).cast("decimal(28,6)")), F.lit(0).cast("decimal(28,6)")).alias("ca"))
    per = classified.groupBy(SEGMENT).agg(*aggs)
    every = Window.partitionBy(F.lit(0))
    out = per.select(SEGMENT, "nb_clients", _share(F.col("nb_clients"), F.sum("nb_clients").over(every)).alias("%"), *([F.col("ca").cast("double").alias("CA_total_EUR"), _share(F.col("ca"), F.sum("ca").over(every)).alias("%_CA")] if has_ca else []))
    return out.orderBy(F.desc("nb_clients"), SEGMENT)


def segment_view(classified: DataFrame, segments: list[str]) -> DataFrame:
    """The rows of some segments only."""
    return classified.where(F.col(SEGMENT).isin(list(segments)) if segments else F.lit(False))
