"""The whole way from extracts to a classified table, each step a plain DataFrame."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators.aggregate import AggSpec, aggregate, resolve_key, sorted_aggregate
from ledgerlens.operators.filters import FilterSpec, apply_filters
from ledgerlens.operators.prepare import keep_first, with_period
from ledgerlens.operators.report import distribution, segment_view
from ledgerlens.plans.compiler import classify
from ledgerlens.plans.rules import RuleSet
from ledgerlens.schema import DEDUP_KEY, LINEAGE, SEGMENT


@dataclass(frozen=True)
class Pipeline:
    """``Pipeline(spark).read(paths).filter(spec).aggregate(spec).classify(rules).report()``."""

    spark: SparkSession
    df: DataFrame | None = None
    key: str | None = None
    errors: tuple[tuple[str, str], ...] = ()
    raw: DataFrame | None = None

    def read(self, paths: list[str]) -> "Pipeline":
        """Reads extracts, keeps the first row of each JobfileNumber in the order of files and lines, and derives Period."""
        from ledgerlens.sources.load import FILE_ORDER, ROW_ORDER, read_extracts

        df, errors = read_extracts(self.spark, paths)
        return replace(self.of(df, [FILE_ORDER, ROW_ORDER]), errors=tuple(errors))

    def of(self, df: DataFrame, order: list[str]) -> "Pipeline":
        """Starts from a table of operations; ``order`` tells which row of a JobfileNumber is first. Order columns made for reading are dropped."""
        raw = df
        if DEDUP_KEY in df.columns:
            df = keep_first(df, [DEDUP_KEY], order)
        df = df.drop(*[c for c in order if c.startswith("__") and c.endswith("_order__")])
        return replace(self, df=df if "Period" in df.columns else with_period(df), raw=raw)

    def filter(self, spec: FilterSpec) -> "Pipeline":
        return replace(self, df=apply_filters(self.df, spec), raw=None)

    def aggregate(self, spec: AggSpec = AggSpec()) -> "Pipeline":
        """One row per customer, in no order; ``clients`` and ``view`` sort."""
        return replace(self, df=aggregate(self.df, spec), key=resolve_key(self.df, spec.key))

    def classify(self, rules: RuleSet, compat_null_text: bool = False) -> "Pipeline":
        return replace(self, df=classify(self.df, rules, compat_null_text, self.key))

    def clients(self) -> DataFrame:
        """The aggregate as it is shown and exported: by descending first metric."""
        if self.key is None:
            raise ValueError("aggregate first")
        return sorted_aggregate(self.df)

    def view(self, segments: list[str]) -> DataFrame:
        return segment_view(self.clients(), segments)

    def is_empty(self) -> bool:
        """Whether no rows are left, as after filters that nothing passes: there is nothing to aggregate then."""
        return self.df.isEmpty()

    def summary(self) -> DataFrame:
        """One row: n_rows, n_columns, n_files, and the rows that keeping the first of each JobfileNumber removed from what was read."""
        files = F.count_distinct(F.col(LINEAGE)) if LINEAGE in self.df.columns else F.lit(0).cast("long")
        before = F.lit(None).cast("long") if self.raw is None else self.raw.groupBy().count().scalar()
        counts = self.df.agg(F.count("*").alias("n_rows"), files.alias("n_files"))
        return counts.select("n_rows", F.lit(len(self.df.columns)).alias("n_columns"), "n_files", (before - F.col("n_rows")).alias("removed"))

    def preview(self, rows: int = 20) -> DataFrame:
        """The first rows, in the order of ``clients`` once aggregated."""
        return (self.clients() if self.key is not None else self.df).limit(rows)

    def columns(self) -> list[str]:
        return list(self.df.columns)

    def report(self) -> DataFrame:
        if SEGMENT not in self.df.columns:
            raise ValueError("classify first")
        return distribution(self.df)
