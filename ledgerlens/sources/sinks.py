"""Exports: CSV, two-sheet workbooks, Parquet snapshots."""

from __future__ import annotations

import csv
import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.sources.xlsx import write_workbook


def write_csv(df: DataFrame, folder: str) -> None:
    """Any size: a folder of CSV parts with headers, written in parallel."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder)


def write_csv_file(df: DataFrame, path: str) -> None:
    """One file in UTF-8 with byte order mark, nulls empty; rows stream through the driver a partition at a time."""
    with open(path, "w", encoding="utf-8-sig", newline="") as f:
        w = csv.writer(f)
        w.writerow(df.columns)
        for row in df.toLocalIterator():
            w.writerow(["" if v is None else v.isoformat() if isinstance(v, (dt.date, dt.datetime)) else v for v in row])


def write_xlsx(clients: DataFrame, report: DataFrame, path: str) -> None:
    """The sheets ``clients`` and ``repartition``; more rows than a sheet holds raise ValueError before a file appears."""
    write_workbook(path, {"clients": (clients.columns, clients.toLocalIterator()), "repartition": (report.columns, report.toLocalIterator())})


def write_snapshot(df: DataFrame, folder: str, as_of: str) -> None:
    """Appends a dated snapshot of a classified table; writing a date again replaces that date only."""
    df.withColumn("as_of", F.lit(as_of).cast("date")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("as_of").parquet(folder)
