"""Queries of sources, sinks and rule sets: tables are written as files, read back as extracts, and compared with what was written."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.text import col
from ledgerlens.plans.compiler import classify
from ledgerlens.plans.pipeline import Pipeline
from ledgerlens.plans.rules import RuleSet, RuleStore
from ledgerlens.queries import table
from ledgerlens.session import scratch_path
from ledgerlens.sources import load, sinks
from ledgerlens.sources.xlsx import write_workbook

COLUMNS = ["load_seq", "Year", "Month", "Customer", "JobfileNumber", "Turnover in EUR"]
_SQL = 'select load_seq, "Year", "Month", nullif(trim("Customer"), \'\') as "Customer", nullif(trim("JobfileNumber"), \'\') as "JobfileNumber", "Turnover in EUR"::double as "turnover"'


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder that the driver and all executors see."""
    path = scratch_path(spark, name).removeprefix("file:").replace("//", "/")
    os.makedirs(path)
    return path


def _back(df: DataFrame, *more: str) -> DataFrame:
    text = lambda c: F.nullif(F.trim(c), F.lit(""))
    return df.select(F.expr("try_cast(try_cast(load_seq as double) as bigint)").alias("load_seq"), "Year", "Month", text("Customer").alias("Customer"), text("JobfileNumber").alias("JobfileNumber"), col("Turnover in EUR").cast("double").alias("turnover"), *more)


def _books(spark: SparkSession, d: str) -> str:
    """A workbook for each file that the operations came from, two lines above the header; one more file is no workbook."""
    folder = _folder(spark, "books")
    rows = table(spark, d, "operations").select("__source_file__", *[col(c) for c in COLUMNS]).repartition("__source_file__").sortWithinPartitions("__source_file__", "load_seq")
    now, lines = None, []

    def close() -> None:
        if now is not None:
            write_workbook(f"{folder}/{now}", {"data": (["Filters applied"], iter([["Exported data"], COLUMNS, *lines]))})

    for r in rows.toLocalIterator():
        if r[0] != now:
            close()
            now, lines = r[0], []
        lines.append([float(v) if k == 6 and v is not None else v for k, v in enumerate(r) if k])
    close()
    with open(f"{folder}/~broken.xlsx", "wb") as f:
        f.write(b"no workbook")
    return folder


def source_xlsx(spark: SparkSession, d: str) -> DataFrame:
    """Excel files, headers found below other lines, a column that tells the file; the unreadable one is left out."""
    return _back(load.read_extracts(spark, [_books(spark, d)])[0], "__source_file__")


def source_errors(spark: SparkSession, d: str) -> DataFrame:
    """The files that couldn't be read."""
    return spark.createDataFrame([(e[0],) for e in load.read_extracts(spark, [_books(spark, d)])[1]], "file string")


def source_landing(spark: SparkSession, d: str) -> DataFrame:
    """A second load reads the Parquet copy."""
    books, landing = _books(spark, d), _folder(spark, "landing")
    os.remove(f"{books}/~broken.xlsx")
    load.land(spark, [books], landing)
    return _back(load.land(spark, [books], landing)[0], "__source_file__")


def source_csv(spark: SparkSession, d: str) -> DataFrame:
    """CSV parts written in parallel and read back."""
    folder = _folder(spark, "csv")
    sinks.write_csv(table(spark, d, "operations").select(*[col(c) for c in COLUMNS]), f"{folder}/parts")
    return _back(load.read_extracts(spark, [f"{folder}/parts/*.csv"])[0])


def source_parquet_keep_first(spark: SparkSession, d: str) -> DataFrame:
    """A folder of Parquet parts as one extract: the first line of each JobfileNumber in the order of the parts' names and lines."""
    folder = _folder(spark, "parts")
    table(spark, d, "operations").repartitionByRange("load_seq").sortWithinPartitions("load_seq").write.parquet(f"{folder}/x.parquet")
    return Pipeline(spark).read([f"{folder}/x.parquet"]).df.select("load_seq", "JobfileNumber", "Period")


def load_summary(spark: SparkSession, d: str) -> DataFrame:
    """Rows after keeping the first, columns, files, rows removed."""
    return Pipeline(spark).of(table(spark, d, "operations"), ["load_seq"]).summary().drop("n_columns")


def cls_edited_rules(spark: SparkSession, d: str) -> DataFrame:
    """A rule set made by every kind of edit, exported, imported into a store and loaded from it."""
    rules = RuleSet().add("x").add_condition(0, "CA_EUR", "<", "0").clear().add("big").add("food ").add("gone")
    rules = rules.add_condition(0, "CA_EUR", ">=", "1").set_condition(0, 0, value="20000").add_condition(0, "TEU").remove_condition(0, 1)
    rules = rules.rename(1, "old").set_logic(1, "OR").add_condition(1, "Nb_operations", ">", "20").add_condition(1, "segment", "est vide").remove(2).move(1, -1)
    store = RuleStore(f"{_folder(spark, 'rules')}/rules.json")
    assert store.load() == RuleSet()
    store.import_json(rules.to_json())
    return classify(table(spark, d, "client_aggregates").select("agg_id", "CA_EUR", "Nb_operations", F.lit("x").alias("segment")), store.load()).select("agg_id", "segment")


QUERIES = {f.__name__: f for f in (source_xlsx, source_errors, source_landing, source_csv, source_parquet_keep_first, load_summary, cls_edited_rules)}
_KEPT = 'with kept as (select *, row_number() over (partition by "JobfileNumber" order by load_seq) as rn from operations)'
ORACLE = {
    "source_xlsx": f"{_SQL}, __source_file__ from operations",
    "source_errors": "select '~broken.xlsx' as file",
    "source_landing": f"{_SQL}, __source_file__ from operations",
    "source_csv": f"{_SQL} from operations",
    "source_parquet_keep_first": f'{_KEPT} select load_seq, "JobfileNumber", "Period" from kept where rn = 1',
    "load_summary": f"{_KEPT} select count(*) filter (where rn = 1) as n_rows, count(distinct __source_file__) as n_files, count(*) filter (where rn > 1) as removed from kept",
    "cls_edited_rules": """select agg_id, case when "Nb_operations" > 20 then 'old' when "CA_EUR" >= 20000 and not isnan("CA_EUR") then 'big' else 'Non classe' end as segment from client_aggregates""",
}
