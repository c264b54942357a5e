"""Queries of the classification engine: preparation, filters, aggregation, predicates, rules, report."""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.text import col
from ledgerlens.operators import aggregate as A
from ledgerlens.operators import prepare
from ledgerlens.operators.filters import FilterSpec, apply_filters, cascading_domain, domain
from ledgerlens.operators.report import distribution, segment_view
from ledgerlens.plans import compare, presets
from ledgerlens.plans.compiler import classify, compile_condition
from ledgerlens.plans.pipeline import Pipeline
from ledgerlens.plans.rules import Condition, RuleSet, Segment
from ledgerlens.plans.star import ORDER, star_operations
from ledgerlens.queries import table
from ledgerlens.session import materialise
from ledgerlens.streaming.watch import windowed_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def add(f):
        n = name or f.__name__
        QUERIES[n] = f
        if sql is not None:
            ORACLE[n] = sql
        return f

    return add


# ---- preparation ----------------------------------------------------------------------------------------------------

KEPT = """kept as (select * exclude (rn) from (select *, row_number() over (partition by "JobfileNumber" order by load_seq) as rn from operations) where rn = 1)"""
W = f"with {KEPT} "


def _kept(spark: SparkSession, d: str) -> DataFrame:
    return prepare.keep_first(table(spark, d, "operations"), ["JobfileNumber"], ["load_seq"])


@query('select load_seq, "Year"::double as "Year", null::double as "Month", "Customer" from operations union all select load_seq, null, "Month"::double, "Customer" from operations')
def concat_by_name(spark, d):
    ops = table(spark, d, "operations")
    frames = [ops.select("load_seq", F.col("Year").cast("double").alias("Year"), "Customer"), ops.select(F.col("Month").cast("double").alias("Month"), "Customer", "load_seq")]
    return prepare.concat_by_name(frames)


@query(W + 'select load_seq, "JobfileNumber" from kept')
def dedup_keep_first(spark, d):
    return _kept(spark, d).select("load_seq", "JobfileNumber")


@query(W + "select (select count(*) from operations) as rows_before, (select count(*) from kept) as rows_after, (select count(*) from operations) - (select count(*) from kept) as removed")
def dedup_removed_count(spark, d):
    return prepare.removed_count(table(spark, d, "operations"), "JobfileNumber")


@query(W + 'select load_seq from kept where "JobfileNumber" is null')
def dedup_null_key(spark, d):
    return _kept(spark, d).where("JobfileNumber is null").select("load_seq")


SQL_PERIOD = """case when "Month" between 1 and 12 and "Year" between 1 and 9999 then make_date("Year", "Month", 1) end"""


@query(f'select load_seq, {SQL_PERIOD} as derived from operations')
def period_month(spark, d):
    return prepare.with_period(table(spark, d, "operations"), out="derived").select("load_seq", "derived")


@query(f'select load_seq, "Month" from operations where "Year" is not null and "Month" is not null and {SQL_PERIOD} is null')
def period_invalid_month(spark, d):
    return prepare.with_period(table(spark, d, "operations"), out="derived").where("Year is not null and Month is not null and derived is null").select("load_seq", "Month")


# ---- filters --------------------------------------------------------------------------------------------------------


@query('select distinct "Year" as value from operations where "Year" is not null')
def years_domain(spark, d):
    return domain(table(spark, d, "operations"), "Year")


@query('select distinct "Month" as value from operations where "Month" is not null')
def months_domain(spark, d):
    return domain(table(spark, d, "operations"), "Month")


def _filtered(spark, d, spec: FilterSpec) -> DataFrame:
    return apply_filters(_kept(spark, d), spec).select("load_seq")


_ALL = '"Year" is not null and "Month" is not null'


@query(W + 'select load_seq from kept where "Year" in (2023, 2024) and "Month" is not null')
def filter_years(spark, d):
    return _filtered(spark, d, FilterSpec(years=[2023, 2024]))


@query(W + f"select load_seq from kept where {_ALL}")
def filter_years_drops_null(spark, d):
    return _filtered(spark, d, FilterSpec())


@query(W + 'select load_seq from kept where "Year" is not null and "Month" between 3 and 9')
def filter_month_range(spark, d):
    return _filtered(spark, d, FilterSpec(months=(3, 9)))


@query(W + f"""select distinct "Market Segment Name" as value from kept where {_ALL} and "Zone 3 Label" in ('PACIFIC', 'EAST ASIA') and "Market Segment Name" is not null""")
def dim_domain_cascading(spark, d):
    return cascading_domain(_kept(spark, d), FilterSpec(dims={"Zone 3 Label": ["PACIFIC", "EAST ASIA"], "Product Name": ["Livestock"]}), "Market Segment Name")


@query(W + f"select load_seq from kept where {_ALL}")
def filter_dim_all_keeps_null(spark, d):
    return _filtered(spark, d, FilterSpec(dims={"Product Name": None}))


@query(W + f"""select load_seq from kept where {_ALL} and "Product Name" in ('Livestock', 'Parcel') and "Shipping Type Name" in ('Direct')""")
def filter_dim_subset(spark, d):
    return _filtered(spark, d, FilterSpec(dims={"Product Name": ["Livestock", "Parcel"], "Shipping Type Name": ["Direct"]}))


@query(W + "select load_seq from kept where false")
def filter_dim_empty(spark, d):
    return _filtered(spark, d, FilterSpec(dims={"Product Name": []}))


@query(W + 'select count(*) as n from kept where "Year" in (2023) and "Month" between 1 and 6')
def filter_count(spark, d):
    return _filtered(spark, d, FilterSpec(years=[2023], months=(1, 6))).agg(F.count("*").alias("n"))


# ---- aggregation ----------------------------------------------------------------------------------------------------


def _dec(c: str) -> str:
    return f"coalesce(cast(sum(case when not isnan(\"{c}\") then cast(\"{c}\" as decimal(28,6)) end) as double), 0)"


def _money(c: str) -> str:
    return f'coalesce(cast(sum("{c}") as double), 0)'


METRICS_SQL = f"""{_money('Turnover in EUR')} as "CA_EUR", {_money('Direct GM in EUR')} as "GM_EUR", {_money('Gross Billing Tax Excl. in EUR')} as "Billing_HT_EUR", {_dec('TEU')} as "TEU", {_dec('Freight Ton')} as "Freight_Ton" """
ACTIVITY_SQL = """count("JobfileNumber") as "Nb_operations", min("Period") as "Premiere_activite", max("Period") as "Derniere_activite", count(distinct "Period") as "Nb_mois_actifs" """


def _mode_sql(key: str, c: str) -> str:
    return f"""(select k, v from (select "{key}" as k, "{c}" as v, row_number() over (partition by "{key}" order by count(*) desc, "{c}") as rn from kept where "{c}" is not null group by "{key}", "{c}") where rn = 1)"""


def _agg_sql(key: str, modal: list[str], tail: str = "") -> str:
    joins = " ".join(f"left join {_mode_sql(key, c)} as m{i} on a.k is not distinct from m{i}.k" for i, c in enumerate(modal))
    return W + f""", a as (select "{key}" as k, {METRICS_SQL}, {ACTIVITY_SQL} from kept group by "{key}") select a.k as "{key}", a.* exclude (k), {", ".join(f'm{i}.v as "{c}"' for i, c in enumerate(modal))} from a {joins} {tail}"""


@query(_agg_sql("Customer", ["HQ CTO Customer Name", "Reporting Entity Label", "Market Segment Name"]))
def agg_by_customer(spark, d):
    return A.aggregate(_kept(spark, d))


@query(_agg_sql("HQ CTO Customer Name", ["Reporting Entity Label", "Market Segment Name"]))
def agg_by_hq(spark, d):
    return A.aggregate(_kept(spark, d), A.AggSpec(key="HQ CTO Customer Name"))


@query(W + f"""select "Customer", {_money('Turnover in EUR')} as "CA_EUR", count("JobfileNumber") as "Nb_operations" from kept group by "Customer" having "Customer" is null""")
def agg_null_key_group(spark, d):
    return A.aggregate(_kept(spark, d), A.AggSpec(metrics=("Turnover in EUR",))).where("Customer is null").select("Customer", "CA_EUR", "Nb_operations")


@query("""select "Customer", 0::double as "CA_EUR" from (select "Customer" from (select "Customer", case when "Turnover in EUR" > 0 then null else "Turnover in EUR" end as t from operations) group by "Customer" having count(t) = 0)""")
def agg_sum_all_null_is_zero(spark, d):
    rows = table(spark, d, "operations").select("Customer", F.when(~(F.coalesce(col("Turnover in EUR") > 0, F.lit(False))), col("Turnover in EUR")).alias("Turnover in EUR"))
    some = rows.groupBy("Customer").agg(F.count(col("Turnover in EUR")).alias("n"))
    return A.aggregate(rows).alias("a").join(some.alias("s"), F.col("a.Customer").eqNullSafe(F.col("s.Customer"))).where("n = 0").select("a.Customer", "CA_EUR")


@query('select "Customer", count(distinct "JobfileNumber") as "Nb_operations" from operations group by "Customer"')
def agg_distinct_ops(spark, d):
    return A.aggregate(table(spark, d, "operations"), A.AggSpec(metrics=(), deduplicated=False)).select("Customer", "Nb_operations")


@query(W + 'select "Customer", min("Period") as "Premiere_activite", max("Period") as "Derniere_activite", count(distinct "Period") as "Nb_mois_actifs" from kept group by "Customer"')
def agg_active_months(spark, d):
    return A.aggregate(_kept(spark, d)).select("Customer", "Premiere_activite", "Derniere_activite", "Nb_mois_actifs")


@query(W + f"""select "Zone 3 Label", v as "Market Segment Name" from (select distinct "Zone 3 Label" from kept) z left join {_mode_sql('Zone 3 Label', 'Market Segment Name')} m on z."Zone 3 Label" is not distinct from m.k""")
def agg_modal_attributes(spark, d):
    return A.aggregate(_kept(spark, d), A.AggSpec(key="Zone 3 Label")).select("Zone 3 Label", "Market Segment Name")


@query(W + f"""select "Customer", {_money('Turnover in EUR')} as "CA_EUR" from kept group by "Customer" order by 2 desc, 1 nulls first limit 50""")
def agg_sorted_top50(spark, d):
    return A.sorted_aggregate(A.aggregate(_kept(spark, d), A.AggSpec(metrics=("Turnover in EUR",))).select("Customer", "CA_EUR")).limit(50)


# ---- predicates over the customer aggregate -------------------------------------------------------------------------

_CA = 'case when not isnan("CA_EUR") then "CA_EUR" end'
_MARKET, _ENTITY = '"Market Segment Name"', '"Reporting Entity Label"'
_STRIP = "trim({}, ' ' || chr(9) || chr(10) || chr(13) || chr(160))"

PREDICATES: dict[str, tuple[Condition, str]] = {
    "p_num_eq": (Condition("Nb_operations", "==", " 12 "), '"Nb_operations" = 12'),
    "p_num_ne_null": (Condition("CA_EUR", "!=", "0"), f"({_CA}) is distinct from 0"),
    "p_num_gt": (Condition("CA_EUR", ">", "1e5"), f"({_CA}) > 100000"),
    "p_num_ge": (Condition("Nb_operations", ">=", "50"), '"Nb_operations" >= 50'),
    "p_num_lt": (Condition("CA_EUR", "<", "0"), f"({_CA}) < 0"),
    "p_num_le": (Condition("GM_EUR", "<=", "1_000"), '"GM_EUR" <= 1000 and not isnan("GM_EUR")'),
    "p_num_between": (Condition("CA_EUR", "between", ["1000", "50000"]), f"({_CA}) between 1000 and 50000"),
    "p_num_between_reversed": (Condition("CA_EUR", "between", ["50000", "1000"]), "false"),
    "p_num_in": (Condition("Nb_mois_actifs", "dans la liste", "1, 3,x,5"), '"Nb_mois_actifs" in (1, 3, 5)'),
    "p_num_not_in": (Condition("Nb_mois_actifs", "pas dans la liste", "1,3,5"), 'not coalesce("Nb_mois_actifs" in (1, 3, 5), false)'),
    "p_num_empty": (Condition("CA_EUR", "est vide"), f"({_CA}) is null"),
    "p_num_not_empty": (Condition("CA_EUR", "n'est pas vide"), f"({_CA}) is not null"),
    "p_num_eq_unparseable": (Condition("CA_EUR", "==", "10,5"), "false"),
    "p_txt_eq_ci": (Condition("Market Segment Name", "==", "Perishables"), f"lower({_MARKET}) = 'perishables'"),
    "p_txt_ne_ci": (Condition("Market Segment Name", "!=", "Perishables"), f"lower({_MARKET}) is distinct from 'perishables'"),
    "p_txt_contains": (Condition("Market Segment Name", "contient", "retail"), f"regexp_matches({_MARKET}, '(?i)retail')"),
    "p_txt_contains_regex": (Condition("Market Segment Name", "contient", "^(oil|food).*s?$"), f"regexp_matches({_MARKET}, '(?i)^(oil|food).*s?$')"),
    "p_txt_contains_empty": (Condition("Market Segment Name", "contient", ""), "true"),
    "p_txt_not_contains": (Condition("Market Segment Name", "ne contient pas", "food"), f"not coalesce(regexp_matches({_MARKET}, '(?i)food'), false)"),
    "p_txt_prefix": (Condition("Reporting Entity Label", "commence par", "Agence"), f"starts_with({_ENTITY}, 'Agence')"),
    "p_txt_suffix": (Condition("Reporting Entity Label", "finit par", "Transit"), f"{_ENTITY} like '%Transit'"),
    "p_txt_in_cs": (Condition("Market Segment Name", "dans la liste", "PERISHABLES , CHEMICALS,,"), f"{_MARKET} in ('PERISHABLES', 'CHEMICALS')"),
    "p_txt_not_in": (Condition("Market Segment Name", "pas dans la liste", "PERISHABLES,CHEMICALS"), f"not coalesce({_MARKET} in ('PERISHABLES', 'CHEMICALS'), false)"),
    "p_txt_regex": (Condition("Reporting Entity Label", "regex", r"\d{5}$"), f"regexp_matches({_ENTITY}, '[0-9]{{5}}$')"),
    "p_txt_regex_invalid": (Condition("Reporting Entity Label", "regex", "("), "false"),
    "p_txt_empty": (Condition("Market Segment Name", "est vide"), f"{_MARKET} is null or {_STRIP.format(_MARKET)} = ''"),
    "p_txt_not_empty": (Condition("Market Segment Name", "n'est pas vide"), f"not ({_MARKET} is null or {_STRIP.format(_MARKET)} = '')"),
    "p_date_eq": (Condition("Derniere_activite", "==", "2024-01"), "\"Derniere_activite\" = date '2024-01-01'"),
    "p_date_ne": (Condition("Derniere_activite", "!=", "01/01/2024"), "\"Derniere_activite\" is distinct from date '2024-01-01'"),
    "p_date_ge": (Condition("Derniere_activite", ">=", "2024"), "\"Derniere_activite\" >= date '2024-01-01'"),
    "p_date_gt": (Condition("Derniere_activite", ">", "2023-06-15 12:00"), "\"Derniere_activite\" >= date '2023-06-16'"),
    "p_date_le": (Condition("Premiere_activite", "<=", "31/12/2022"), "\"Premiere_activite\" <= date '2022-12-31'"),
    "p_date_lt": (Condition("Premiere_activite", "<", "2022-07-01"), "\"Premiere_activite\" < date '2022-07-01'"),
    "p_date_between": (Condition("Premiere_activite", "between", ["2023-01-01", "2023-06-01"]), "\"Premiere_activite\" between date '2023-01-01' and date '2023-06-01'"),
    "p_date_empty": (Condition("Premiere_activite", "est vide"), '"Premiere_activite" is null'),
    "p_unknown_column": (Condition("no such column", "!=", "x"), "false"),
    "p_unknown_op": (Condition("CA_EUR", "~", "x"), "false"),
}


def _predicate(cond: Condition):
    def run(spark: SparkSession, d: str) -> DataFrame:
        agg = table(spark, d, "client_aggregates")
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            return agg.where(compile_condition(agg, cond)).select("agg_id")

    return run


for _name, (_cond, _sql) in PREDICATES.items():
    query(f"select agg_id from client_aggregates where coalesce({_sql}, false)", _name)(_predicate(_cond))


# ---- classification -------------------------------------------------------------------------------------------------

_BIG, _OLD, _FOOD = Condition("CA_EUR", ">=", "50000"), Condition("Derniere_activite", "<", "2023-06-01"), Condition("Market Segment Name", "contient", "food")
_BIG_SQL, _OLD_SQL, _FOOD_SQL = f"({_CA}) >= 50000", "\"Derniere_activite\" < date '2023-06-01'", f"regexp_matches({_MARKET}, '(?i)food')"


def _cls(rules: list[Segment]):
    def run(spark: SparkSession, d: str) -> DataFrame:
        return classify(table(spark, d, "client_aggregates"), RuleSet(tuple(rules))).select("agg_id", "segment")

    return run


for _name, _rules, _case in (
    ("cls_and", [Segment("big food", "AND", (_BIG, _FOOD))], f"when {_BIG_SQL} and {_FOOD_SQL} then 'big food'"),
    ("cls_or", [Segment("big or food", "OR", (_BIG, _FOOD))], f"when {_BIG_SQL} or {_FOOD_SQL} then 'big or food'"),
    ("cls_empty_segment", [Segment("none", "AND"), Segment("none either", "OR"), Segment("big", "AND", (_BIG,))], f"when {_BIG_SQL} then 'big'"),
    ("cls_first_match_wins", [Segment("food", "AND", (_FOOD,)), Segment("big", "AND", (_BIG,)), Segment("old", "AND", (_OLD,))], f"when {_FOOD_SQL} then 'food' when {_BIG_SQL} then 'big' when {_OLD_SQL} then 'old'"),
    ("cls_default_named_rule", [Segment("Non classe", "AND", (_FOOD,)), Segment("big", "AND", (_BIG,))], f"when {_BIG_SQL} then 'big'"),
    ("cls_duplicate_names", [Segment("x", "AND", (_FOOD,)), Segment("big", "AND", (_BIG,)), Segment("x", "AND", (_OLD,))], f"when {_FOOD_SQL} then 'x' when {_BIG_SQL} then 'big' when {_OLD_SQL} then 'x'"),
):
    query(f"select agg_id, case {_case} else 'Non classe' end as segment from client_aggregates", _name)(_cls(_rules))


@query(f"select agg_id, case when {_FOOD_SQL} then 'food' else 'big' end as segment from client_aggregates where coalesce({_FOOD_SQL}, false) or coalesce({_BIG_SQL}, false)")
def cls_view_by_segment(spark, d):
    done = classify(table(spark, d, "client_aggregates"), RuleSet((Segment("food", "AND", (_FOOD,)), Segment("big", "AND", (_BIG,)))))
    return segment_view(done, ["food", "big"]).select("agg_id", "segment")


_Q = 'q as (select quantile_cont("CA_EUR", 0.25) as q1, quantile_cont("CA_EUR", 0.5) as q2, quantile_cont("CA_EUR", 0.75) as q3 from client_aggregates where not isnan("CA_EUR"))'
_PRESET = f"case when ({_CA}) >= trunc(q3) then 'VIP' when ({_CA}) >= trunc(q2) then 'Gold' when ({_CA}) >= trunc(q1) then 'Silver' when ({_CA}) > 0 then 'Bronze' else 'Non classe' end"


@query(f"with {_Q} select q1, q2, q3 from q")
def quartile_thresholds(spark, d):
    return presets.quartile_thresholds(table(spark, d, "client_aggregates"))


def _preset(spark, d) -> DataFrame:
    agg = table(spark, d, "client_aggregates")
    return classify(agg, presets.quartiles(agg))


@query(f"with {_Q} select agg_id, {_PRESET} as segment from client_aggregates, q")
def cls_quartile_preset(spark, d):
    return _preset(spark, d).select("agg_id", "segment")


def _report_sql(source: str, seg: str, ca: str) -> str:
    return f""", c as (select {seg} as segment, cast({ca} as decimal(28,6)) as ca from {source}), t as (select count(*) as n, sum(coalesce(ca, 0)) as ca from c)
 select segment, count(*) as nb_clients, round_even(count(*) * 100.0::double / max(t.n), 1) as "%", cast(coalesce(sum(c.ca), 0) as double) as "CA_total_EUR",
 round_even(cast(coalesce(sum(c.ca), 0) as double) * 100 / nullif(cast(max(t.ca) as double), 0), 1) as "%_CA" from c, t group by segment"""


@query(f"with {_Q}" + _report_sql("client_aggregates, q", _PRESET, _CA))
def segment_distribution(spark, d):
    return distribution(_preset(spark, d))



@query(f"""with {KEPT}, a as (select "Customer" as k, {_money('Turnover in EUR')} as ca from kept where "Year" = 2023 and "Month" is not null group by 1), b as (select "Customer" as k, {_money('Turnover in EUR')} as ca from kept where "Year" = 2024 and "Month" is not null group by 1)
 select coalesce(a.k, b.k) as "Customer", case when a.ca >= 50000 then 'big' when a.ca is not null then 'Non classe' end as segment_before, case when b.ca >= 50000 then 'big' when b.ca is not null then 'Non classe' end as segment_after, a.ca as value_before, b.ca as value_after from a full outer join b on a.k is not distinct from b.k""")
def compare_two_periods(spark, d):
    rules = RuleSet((Segment("big", "AND", (_BIG,)),))
    years = [classify(A.aggregate(apply_filters(_kept(spark, d), FilterSpec(years=[y])), A.AggSpec(metrics=("Turnover in EUR",))), rules) for y in (2023, 2024)]
    return compare.compare_periods(*years, "Customer")


@query("""select agg_id, previous_segment, segment from (select agg_id, segment, lag(segment) over (partition by "Customer" order by as_of, agg_id) as previous_segment from client_aggregates) where previous_segment <> segment""")
def segment_transitions(spark, d):
    rows = table(spark, d, "client_aggregates").select("agg_id", "Customer", "segment", F.struct("as_of", "agg_id").alias("at"))
    return compare.transitions(rows, "Customer", "at").select("agg_id", "previous_segment", "segment")


@query("select date_trunc('hour', ts) as window_start, event_type, count(*) as n from events group by 1, 2")
def events_per_hour(spark, d):
    return windowed_counts(table(spark, d, "events"))


# ---- the whole way over the star schema -----------------------------------------------------------------------------

STAR = ("lineitem", "orders", "customer", "nation", "region", "part", "supplier")
_STAR_SQL = """star as (select l_orderkey || '-' || l_linenumber as job, c_name, cast(l_extendedprice as decimal(18,2)) * (1 - cast(l_discount as decimal(18,2))) as turnover,
  row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus) as rn
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey),
 agg as (select c_name, cast(sum(turnover) as double) as "CA_EUR" from star where rn = 1 group by 1),
 q as (select quantile_cont("CA_EUR", 0.25) as q1, quantile_cont("CA_EUR", 0.5) as q2, quantile_cont("CA_EUR", 0.75) as q3 from agg)"""


def star_table(spark: SparkSession, d: str) -> DataFrame:
    return star_operations({t: table(spark, d, t) for t in STAR})


@query(f"with {_STAR_SQL}" + _report_sql("agg, q", _PRESET, '"CA_EUR"'))
def flagship_pipeline(spark, d):
    dated = not table(spark, d, "orders").where("o_orderdate is not null").isEmpty()
    done = Pipeline(spark).of(star_table(spark, d), ORDER).filter(FilterSpec(has_months=dated)).aggregate()
    # the thresholds and the report both read the customer table: it is written once
    agg = materialise(done.df.select("Customer", "CA_EUR"), "customers")
    return distribution(classify(agg, presets.quartiles(agg)))


@query(f"""with {_STAR_SQL}, k as (select * from star where rn = 1) select c_name as "Customer", cast(sum(turnover) as double) as "CA_EUR", count(*) as "Nb_operations" from k group by 1""")
def star_aggregate(spark, d):
    return Pipeline(spark).of(star_table(spark, d), ORDER).filter(FilterSpec()).aggregate().df.select("Customer", "CA_EUR", "Nb_operations")
