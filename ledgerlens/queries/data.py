"""Queries of the general data operators: features (p1), drifting schemas (p4), hot keys (p6), history (p7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.text import col, name_form
from ledgerlens.operators import drift, features, history, skew
from ledgerlens.operators.prepare import keep_first
from ledgerlens.queries import table

SQL_NAME = "upper(trim(regexp_replace({}, '\\s+', ' ', 'g')))"


def sql_name(c: str) -> str:
    return SQL_NAME.format(f'"{c}"')


def _events(spark: SparkSession, d: str) -> DataFrame:
    ops = table(spark, d, "operations").select(
        "load_seq", "JobfileNumber", "Customer", col("Activity Name (EN)").alias("activity"), col("Product Name").alias("product"), "Period", (col("Turnover in EUR") * 10000).cast("long").alias("amount")
    )
    first = keep_first(ops.where("JobfileNumber is not null"), ["JobfileNumber"], ["load_seq"])
    return first.select(name_form(F.col("Customer")).alias("customer"), "activity", "product", "Period", "amount").where("customer is not null and activity is not null and product is not null")


def _features(spark: SparkSession, d: str, whole: bool):
    """``whole``: wide, a row for every customer of operations, and operations without Period count; else only dated ones, as p1_found has it."""
    raw = table(spark, d, "operations").select(name_form(F.col("Customer")).alias("customer"), col("Activity Name (EN)").alias("activity"), col("Product Name").alias("product"))
    types = features.event_types(raw, ["activity", "product"], features.FeatureSpec.max_types)
    return features.feature_table(_events(spark, d), "customer", ["activity", "product"], "Period", F.col("amount"), types, wide=whole, population=raw, every=whole, undated=whole), types


def p1_feature_table(spark: SparkSession, d: str) -> DataFrame:
    """A row for every customer of operations, also one without any kept operation of a known type."""
    return _features(spark, d, True)[0]


def p1_features_long(spark: SparkSession, d: str) -> DataFrame:
    """The filled cells of the table of dated operations, a row each."""
    wide, types = _features(spark, d, False)
    return _filled(wide, types).select("customer", "activity", "product", "n", "last", (F.col("total") / 10000).alias("total"))


def _filled(wide: DataFrame, types: list[tuple], keep=lambda x: x["n"] > 0) -> DataFrame:
    if not types:
        return wide.select(F.lit("").alias("customer"), F.lit("").alias("activity"), F.lit("").alias("product"), F.lit(0).cast("long").alias("n"), F.lit(None).cast("date").alias("last"), F.lit(0).cast("long").alias("total")).limit(0)
    kinds = F.array(*[F.struct(F.lit(a).alias("activity"), F.lit(p).alias("product")) for a, p in types])
    cells = F.filter(F.arrays_zip(F.sequence(F.lit(0), F.lit(len(types) - 1)).alias("k"), F.col("n"), F.col("last"), F.col("total")), lambda x: keep(x))
    rows = wide.select(F.col("entity").alias("customer"), F.explode(cells).alias("c"))
    return rows.select("customer", F.get(kinds, F.col("c")["k"]).alias("t"), "c.n", "c.last", "c.total").select("customer", "t.activity", "t.product", "n", "last", "total")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    wide, types = _features(spark, d, False)
    latest = table(spark, d, "operations").agg(F.max("Period")).first()[0]
    until = F.add_months(F.lit(latest).cast("date"), -12)
    return _filled(wide, types, lambda x: (x["n"] >= 3) & (x["total"] < 0) & (x["last"] <= until)).select("customer", "activity", "product")


P1_KEPT = f"""with kept as (select * from (select *, row_number() over (partition by "JobfileNumber" order by load_seq) as rn
  from operations where "JobfileNumber" is not null) where rn = 1),
 cells as (select {sql_name('Customer')} as customer, "Activity Name (EN)" as activity, "Product Name" as product, count(*) as n, max("Period") as last,
  sum(coalesce("Turnover in EUR", 0)) as total from kept
  where "Customer" is not null and "Activity Name (EN)" is not null and "Product Name" is not null and "Period" is not null group by 1, 2, 3)
"""


def _drift(spark: SparkSession, d: str) -> drift.Drift:
    return drift.Drift(table(spark, d, "extract_rows"), table(spark, d, "extract_files"), "file_id", "row_no", "cells", "crm_source", "extracted_on")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _drift(spark, d).changes().select("file_id", "field_name", "change_kind")


def p4_changes(spark: SparkSession, d: str) -> DataFrame:
    """Every change with the field's first and former name, former and present type."""
    return _drift(spark, d).changes()


def p4_unified(spark: SparkSession, d: str) -> DataFrame:
    """The data lines of all files as one table of the union schema."""
    return _drift(spark, d).unified()


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return skew.heavy_keys(p6_key_profile(spark, d), 0.04).select("field_name", "key_value")


def _weighted(spark: SparkSession, d: str, value) -> DataFrame:
    return skew.compress(table(spark, d, "operations"), {c: name_form(col(c)) for c in ("Customer", "HQ CTO Customer Name")}, value)


def _profile(spark: SparkSession, d: str, value) -> DataFrame:
    return skew.key_profile(_weighted(spark, d, value))


def p6_key_profile(spark: SparkSession, d: str) -> DataFrame:
    """Rows, distinct market segments and the modal one for every key of both fields."""
    return _profile(spark, d, name_form(col("Market Segment Name"))).withColumn("mode_rows", F.coalesce("mode_rows", F.lit(0)))


def p6_key_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Exact quartiles of Turnover in EUR for every key of both fields."""
    return skew.key_quantiles(_weighted(spark, d, col("Turnover in EUR")), [0.25, 0.5, 0.75]).select("field_name", "key_value", "p", "value", F.col("group_n").alias("n"))


P6_ROWS = " union all ".join(f"select '{c}' as field_name, {sql_name(c)} as key_value, {sql_name('Market Segment Name')} as seg, cast(\"Turnover in EUR\" as double) as value from operations" for c in ("Customer", "HQ CTO Customer Name"))


def _history(spark: SparkSession, d: str) -> DataFrame:
    snaps = table(spark, d, "customer_snapshots").select(
        name_form(F.col("Customer")).alias("customer"), "snapshot_date", "received_at", "snap_id", name_form(col("Reporting Entity Label")).alias("entity"), name_form(col("Market Segment Name")).alias("market"), (F.col("account_status") == "active").alias("active")
    )
    return history.attribute_history(snaps, "customer", "snapshot_date", ["received_at", "snap_id"], ["entity", "market"], "active")


def p7_history(spark: SparkSession, d: str) -> DataFrame:
    to = F.coalesce(F.date_format("valid_to", "yyyy-MM-dd"), F.lit(history.FOREVER))
    return _history(spark, d).select("customer", "entity", "market", F.date_format("valid_from", "yyyy-MM-dd").alias("valid_from"), to.alias("valid_to"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return p7_history(spark, d).select("customer", "valid_from", "valid_to")


P7 = f"""with raw as (select {sql_name('Customer')} as customer, snapshot_date as d, received_at, snap_id, {sql_name('Reporting Entity Label')} as e, {sql_name('Market Segment Name')} as m, account_status = 'active' as a from customer_snapshots),
 one as (select * from (select *, row_number() over (partition by customer, d order by received_at desc, snap_id desc) as rn from raw) where rn = 1),
 grp as (select *, count(e) over (partition by customer order by d) as ge, count(m) over (partition by customer order by d) as gm from one),
 fill as (select customer, d, a, max(e) over (partition by customer, ge) as e, max(m) over (partition by customer, gm) as m from grp),
 prev as (select *, lag(a) over w as pa, lag(e) over w as pe, lag(m) over w as pm, row_number() over w as rn from fill window w as (partition by customer order by d)),
 starts as (select *, case when rn = 1 or a is distinct from pa or (a and (e is distinct from pe or m is distinct from pm)) then 1 else 0 end as s from prev),
 cut as (select *, lead(d) over (partition by customer order by d) as nxt from starts where s = 1)
select customer, {{}} strftime(d, '%Y-%m-%d') as valid_from, coalesce(strftime(nxt, '%Y-%m-%d'), '9999-12-31') as valid_to from cut where a"""

QUERIES = {f.__name__: f for f in (p1_found, p1_features_long, p1_feature_table, p4_found, p4_changes, p4_unified, p6_found, p6_key_profile, p6_key_percentiles, p7_found, p7_history)}

ORACLE = {
    "p1_found": P1_KEPT + 'select customer, activity, product from cells where n >= 3 and total < 0 and last <= (select max("Period") from operations) - interval 12 month',
    "p1_features_long": P1_KEPT + "select customer, activity, product, n, last, cast(total as double) as total from cells",
    "p6_found": f"with r as ({P6_ROWS}) select field_name, key_value from r where key_value is not null group by 1, 2 having count(*) >= 0.04 * (select count(*) from operations)",
    "p6_key_profile": f"""with r as ({P6_ROWS}), v as (select field_name, key_value, seg, count(*) as w from r group by 1, 2, 3),
 b as (select field_name, key_value, seg, w, row_number() over (partition by field_name, key_value order by w desc, seg) as rn from v where seg is not null),
 s as (select field_name, key_value, cast(sum(w) as bigint) as n_rows, cast(coalesce(sum(case when seg is not null then w end), 0) as bigint) as n_values, count(seg) as n_distinct from v group by 1, 2)
select s.field_name, s.key_value, n_rows, n_values, n_distinct, b.seg as mode, coalesce(b.w, 0) as mode_rows from s left join b on s.field_name = b.field_name and s.key_value is not distinct from b.key_value and b.rn = 1""",
    "p6_key_percentiles": f"""with r as ({P6_ROWS}), o as (select field_name, key_value, value, row_number() over (partition by field_name, key_value order by value) as rn, count(*) over (partition by field_name, key_value) as n from r where value is not null)
select field_name, key_value, p, value, n from o, (values (0.25::double, 1), (0.5::double, 2), (0.75::double, 3)) as t(p, k) where rn = (k * n + 3) // 4""",
    "p7_found": P7.format(""),
    "p7_history": P7.format("e as entity, m as market,"),
}
