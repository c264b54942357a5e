"""Reading extracts (Excel, CSV, Parquet) into canonical operations.

Every file's header is looked for in its first lines; what stands above it is skipped. Names are stripped. Files that can't be
read are reported and the others go on. ``__file_order__`` and ``__row_order__`` keep the order of files and lines.
"""

from __future__ import annotations

import csv
import glob
import hashlib
import os
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import schema as S
from ledgerlens.functions.text import col
from ledgerlens.operators.prepare import concat_by_name

FILE_ORDER, ROW_ORDER = "__file_order__", "__row_order__"


def detect_header(rows: Iterable[list], markers: frozenset[str] = S.HEADER_MARKERS, scan: int = S.HEADER_SCAN_ROWS) -> int:
    """The first of the first ``scan`` lines whose stripped cells hold all markers, else 0."""
    for i, row in enumerate(rows):
        if i >= scan:
            break
        if markers <= {str(v).strip() for v in row if v is not None}:
            return i
    return 0


def column_names(header: list) -> list[str]:
    """Stripped names; blanks become ``Unnamed: k``, repeated names get .1, .2 and so on."""
    seen: dict[str, int] = {}
    out = []
    for k, v in enumerate(header):
        n = (str(v).strip() if v is not None else "") or f"Unnamed: {k}"
        seen[n] = seen.get(n, -1) + 1
        out.append(n if not seen[n] else f"{n}.{seen[n]}")
    return out


def _typed(df: DataFrame) -> DataFrame:
    """Canonical columns to their types, what doesn't fit to null; NaN to null."""
    out = {}
    for f in df.schema:
        kind = S.OPERATIONS.get(f.name)
        if kind is None or f.dataType == kind:
            continue
        name = kind.simpleString()
        if name == "int":
            out[f.name] = F.expr(f"try_cast(try_cast(`{f.name}` as double) as int)")
        elif f.dataType.simpleString() in ("double", "float") and name.startswith("decimal"):
            out[f.name] = F.when(~F.isnan(col(f.name)), F.expr(f"try_cast(`{f.name}` as {name})"))
        else:
            out[f.name] = F.expr(f"try_cast(`{f.name}` as {name})")
    for f in df.schema:
        if f.name in S.OPERATIONS and S.OPERATIONS[f.name].simpleString() == "double":
            c = out.get(f.name, col(f.name))
            out[f.name] = F.when(~F.isnan(c), c)
    return df.withColumns({k: v for k, v in out.items()}) if out else df


def _from_rows(rows: DataFrame, header: list, head: int, name: str, order: int) -> DataFrame:
    names = column_names(header)
    body = rows.where(F.col("row_no") > head)
    cells = [F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(names)]
    blank = F.lit(True)
    for i in range(len(names)):
        blank = blank & F.get("cells", F.lit(i)).isNull()
    return body.where(~blank).select(*cells, F.lit(name).alias(S.LINEAGE), F.lit(order).alias(FILE_ORDER), F.col("row_no").alias(ROW_ORDER))


def read_xlsx(spark: SparkSession, path: str, order: int = 0) -> DataFrame:
    """First sheet of one workbook; raises ValueError if it can't be read."""
    from ledgerlens.sources.xlsx import XlsxSource

    spark.dataSource.register(XlsxSource)
    rows = spark.read.format("xlsx_rows").option("paths", path).load()
    first = rows.where(F.col("row_no") < S.HEADER_SCAN_ROWS).orderBy("row_no").collect()
    for r in first:
        if r["error"] is not None:
            raise ValueError(r["error"])
    # absolute line numbers, so that lines which aren't stored count
    by_no = {r["row_no"]: list(r["cells"]) for r in first}
    scan = [by_no.get(i, []) for i in range(S.HEADER_SCAN_ROWS)]
    head = detect_header(scan)
    return _from_rows(rows.select("row_no", "cells"), scan[head], head, os.path.basename(path), order)


def read_csv(spark: SparkSession, path: str, order: int = 0, sep: str = ",") -> DataFrame:
    """One delimited file, UTF-8 with or without byte order mark. Line numbers come from the file's offsets."""
    with open(path.removeprefix("file://"), encoding="utf-8-sig", newline="") as f:
        scan = [row for _, row in zip(range(S.HEADER_SCAN_ROWS), csv.reader(f, delimiter=sep))]
    if not scan:
        raise ValueError("an empty file")
    head = detect_header(scan)
    names = column_names(scan[head])
    width = max(len(r) for r in scan)
    schema = ", ".join(f"c{i} string" for i in range(max(width, len(names))))
    raw = spark.read.schema(schema).option("sep", sep).option("multiLine", True).option("quote", '"').option("escape", '"').option("encoding", "UTF-8").csv(path)
    # one file with multi-line records is one partition, in which the ids count its records from 0; blank lines are no records
    numbered = raw.withColumn("row_no", F.monotonically_increasing_id())
    skip = sum(1 for r in scan[:head] if r and any(c != "" for c in r) or len(r) > 1)
    cells = F.array(*[F.when(F.trim(f"c{i}") != "", F.col(f"c{i}")) for i in range(len(names))])
    return _from_rows(numbered.select("row_no", cells.alias("cells")), scan[head], skip, os.path.basename(path), order)


def read_parquet(spark: SparkSession, path: str, order: int = 0) -> DataFrame:
    """A Parquet file or folder; lines count on from file to file in name order, whatever splits Spark reads."""
    df = spark.read.parquet(path)
    parts = sorted(df.inputFiles())
    where = df.select(*[col(c) for c in df.columns], F.col("_metadata.file_name").alias("__name__"), F.col("_metadata.row_index").alias(ROW_ORDER))
    if len(parts) > 1:
        # the files of one folder; more rows than 2 ** 40 in a file there can't be
        names = F.broadcast(spark.createDataFrame([(p.rpartition("/")[2], k) for k, p in enumerate(parts)], "__name__ string, __part__ long"))
        where = where.join(names, "__name__").withColumn(ROW_ORDER, F.col("__part__") * (1 << 40) + F.col(ROW_ORDER)).drop("__part__")
    if S.LINEAGE not in df.columns:
        where = where.withColumn(S.LINEAGE, F.col("__name__"))
    return where.drop("__name__").withColumn(FILE_ORDER, F.lit(order))


def expand(paths: list[str]) -> list[str]:
    """Folders and patterns as the files in them, in name order; a folder of Parquet parts stays one."""
    files: list[str] = []
    for p in paths:
        p = p.removeprefix("file://")
        files += sorted(glob.glob(p)) if any(c in p for c in "*?[") else sorted(os.path.join(p, f) for f in os.listdir(p)) if os.path.isdir(p) and not p.endswith(".parquet") else [p]
    return files


def read_extracts(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, list[tuple[str, str]]]:
    """(operations of all files in their order, [(file, error)]). Folders and patterns are expanded in name order."""
    files = expand(paths)
    frames, errors = [], []
    for i, p in enumerate(files):
        try:
            if p.endswith((".xlsx", ".xlsm")):
                df = read_xlsx(spark, p, i)
            elif p.endswith((".csv", ".txt")):
                df = read_csv(spark, p, i)
            elif p.endswith(".parquet"):
                df = read_parquet(spark, p, i)
            else:
                raise ValueError("no reader for this kind of file")
            frames.append(_typed(df))
        except Exception as e:  # noqa: BLE001 - the other files go on
            errors.append((os.path.basename(p), f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"))
    if not frames:
        schema = ", ".join(f"`{n}` {t.simpleString()}" for n, t in S.OPERATIONS.items())
        return spark.createDataFrame([], f"{schema}, `{S.LINEAGE}` string, `{FILE_ORDER}` int, `{ROW_ORDER}` long"), errors
    return concat_by_name(frames), errors


def land(spark: SparkSession, paths: list[str], folder: str) -> tuple[DataFrame, list[tuple[str, str]]]:
    """``read_extracts`` through a Parquet copy in ``folder`` that is kept by the names, sizes and times of change of all files that
    the paths lead to: a second load of the same files reads the copy, a new or changed file makes another."""
    h = hashlib.sha256()
    for p in expand(paths):
        inside = sorted(os.path.join(at, f) for at, _, names in os.walk(p) for f in names) if os.path.isdir(p) else [p] if os.path.isfile(p) else []
        h.update(f"{p}\0{[(f, os.stat(f).st_size, os.stat(f).st_mtime_ns) for f in inside]}\0".encode())
    at = os.path.join(folder, h.hexdigest()[:32])
    if os.path.exists(os.path.join(at, "_SUCCESS")):
        return spark.read.parquet(at), []
    df, errors = read_extracts(spark, paths)
    if not errors:
        df.write.mode("overwrite").parquet(at)
        df = spark.read.parquet(at)
    return df, errors
