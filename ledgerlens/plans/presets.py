"""Ready-made rule sets. The names of the segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.plans.rules import Condition, RuleError, RuleSet, Segment


def quartile_thresholds(agg: DataFrame, column: str = "CA_EUR") -> DataFrame:
    """One row q1, q2, q3: exact quartiles with linear interpolation; nulls and NaN are skipped."""
    q = F.percentile(F.when(~F.isnan(F.col(column).cast("double")), F.col(column).cast("double")), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return agg.agg(q.alias("q")).select(*[F.col("q")[i].alias(f"q{i + 1}") for i in range(3)])


def quartiles(agg: DataFrame, column: str = "CA_EUR") -> RuleSet:
    """VIP, Gold and Silver from the upper three quartiles (thresholds cut to integers), Bronze above 0."""
    if column not in agg.columns:
        raise RuleError(f"no column {column!r}")
    row = quartile_thresholds(agg, column).first()
    if row is None or row[0] is None:
        raise RuleError(f"no values in {column!r}")
    steps = [("VIP", ">=", row[2]), ("Gold", ">=", row[1]), ("Silver", ">=", row[0]), ("Bronze", ">", 0)]
    return RuleSet(tuple(Segment(n, "AND", (Condition(column, op, str(int(v))),)) for n, op, v in steps))
