"""Filters on operations: years, a range of months, and label dimensions."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.text import col
from ledgerlens.schema import DIMENSIONS


@dataclass(frozen=True)
class FilterSpec:
    """``years`` None: every year, rows without one dropped. ``months``: inclusive range in each year, None: every month,
    rows without one dropped if any month exists. A dimension that is absent or None isn't filtered and keeps nulls;
    a list keeps its labels only, an empty one nothing."""

    years: list[int] | None = None
    months: tuple[int, int] | None = None
    dims: Mapping[str, list[str] | None] = field(default_factory=dict)
    #: Whether any row has a month, where the caller knows.
    has_months: bool | None = None


def domain(df: DataFrame, name: str) -> DataFrame:
    """The distinct non-null values of a column, ascending, as column ``value``."""
    return df.where(col(name).isNotNull()).select(col(name).alias("value")).distinct().orderBy("value")


def cascading_domain(df: DataFrame, spec: FilterSpec, name: str) -> DataFrame:
    """The domain of a dimension after the filters that come before it."""
    before = {d: spec.dims.get(d) for d in DIMENSIONS[: DIMENSIONS.index(name)]}
    return domain(apply_filters(df, FilterSpec(spec.years, spec.months, before, spec.has_months)), name)


def apply_filters(df: DataFrame, spec: FilterSpec) -> DataFrame:
    """All predicates as one filter, left to the optimizer to push down. Columns that are missing aren't filtered.

    No job is run: where no range of months is given, whether any month exists is a subquery of the plan, unless ``spec`` tells.
    """
    unknown = set(spec.dims) - set(DIMENSIONS)
    if unknown:
        raise ValueError(f"no dimension: {', '.join(sorted(unknown))}")
    keep = F.lit(True)
    if "Year" in df.columns:
        keep = keep & (F.col("Year").isNotNull() if spec.years is None else F.col("Year").isin(list(spec.years)))
    if "Month" in df.columns:
        if spec.months is not None:
            keep = keep & F.col("Month").between(*spec.months)
        elif spec.has_months is None:
            any_month = df.where("Month is not null").select(F.lit(True).alias("any")).limit(1).scalar()
            keep = keep & (F.col("Month").isNotNull() | any_month.isNull())
        elif spec.has_months:
            keep = keep & F.col("Month").isNotNull()
    for name in DIMENSIONS:
        chosen = spec.dims.get(name)
        if chosen is not None and name in df.columns:
            keep = keep & (col(name).isin(list(chosen)) if chosen else F.lit(False))
    return df.where(keep)
