"""Operations to one row per customer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import schema as S
from ledgerlens.functions.text import col


class AggregationError(ValueError):
    """A specification that can't be aggregated."""


@dataclass(frozen=True)
class AggSpec:
    """``key`` None: the first candidate present. ``metrics`` None: all present. ``deduplicated``: the input has each
    JobfileNumber once, so counting is as good as counting distinct values, and needs no second shuffle."""

    key: str | None = None
    metrics: tuple[str, ...] | None = None
    deduplicated: bool = True


def resolve_key(df: DataFrame, key: str | None) -> str:
    if key is not None:
        if key not in df.columns:
            raise AggregationError(f"no column {key!r}")
        return key
    found = next((k for k in (*S.KEYS, *df.columns) if k in df.columns), None)
    if found is None:
        raise AggregationError("no column to group by")
    return found


def exact_sum(df: DataFrame, name: str) -> Column:
    """Null-skipping sum as double, 0 without values. Added up as decimals, so the order of rows doesn't matter; NaN counts as null."""
    kind = df.schema[name].dataType
    c = col(name)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        c = F.when(~F.isnan(c), c).cast("decimal(28,6)")
    return F.coalesce(F.sum(c).cast("double"), F.lit(0.0))


def aggregate(df: DataFrame, spec: AggSpec = AggSpec()) -> DataFrame:
    """The null key is a group. Columns: key, metrics, operations, first and last month, active months, modal labels."""
    key = resolve_key(df, spec.key)
    if unknown := set(spec.metrics or ()) - set(S.METRICS):
        raise AggregationError(f"no metric: {', '.join(sorted(unknown))}")
    # in the order they were chosen in
    wanted = list(S.METRICS if spec.metrics is None else dict.fromkeys(spec.metrics))
    aggs = {S.METRICS[m]: exact_sum(df, m) for m in wanted if m in df.columns}
    if S.DEDUP_KEY in df.columns:
        aggs[S.OPERATION_COUNT] = F.count(col(S.DEDUP_KEY)) if spec.deduplicated else F.count_distinct(col(S.DEDUP_KEY))
    if "Period" in df.columns:
        # months are few per customer: a set costs less than a second distinct aggregation
        aggs |= {S.FIRST: F.min("Period"), S.LAST: F.max("Period"), S.MONTHS: F.size(F.collect_set("Period")).cast("long")}
    aggs |= {m: F.mode(col(m), True) for m in S.MODAL if m in df.columns and m != key}
    if not aggs:
        raise AggregationError("nothing to aggregate")
    if key in aggs:
        raise AggregationError(f"the key {key!r} is also a result column")
    return df.groupBy(col(key).alias(key)).agg(*[a.alias(n) for n, a in aggs.items()])


def sorted_aggregate(agg: DataFrame) -> DataFrame:
    """Descending by the first metric present, else by the second column; nulls last, ties by key."""
    key = agg.columns[0]
    by = next((m for m in S.METRICS.values() if m in agg.columns and m != key), agg.columns[min(1, len(agg.columns) - 1)])
    return agg.orderBy(F.desc_nulls_last(col(by)), col(key).asc_nulls_first())
