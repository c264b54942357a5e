"""Files whose schemas drift: one union table, and an ordered log of what changed from file to file.

The header and a profile of each column are found per file in parallel: its values' types joined in a promotion
lattice, and hashed counts of what its values look like. A fold over each series of files, a sorted stream of these
small profiles, then compares every file with the one before. A name is a former field renamed when its values look
like those of a vanished field.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import materialise

#: The lattice, least to most general; bool joins with anything else to text.
BOOL, INT, NUM, TEXT = "boolean", "integer", "number", "text"
SPARK_TYPES = {BOOL: "boolean", INT: "bigint", NUM: "double", TEXT: "string", None: "string"}
#: Sizes of the two hashed feature families of a column profile, and the likeness from which a new name is a renamed field.
WORDS, SHAPES = 512, 128
LIKENESS = 0.3

_DIGITS = re.compile(r"\d+")
_LETTERS = re.compile(r"[^\W\d_]+")
_NUMBER = re.compile(r"\s*[-+]?\d+(?:\.\d+)?\s*\Z")


def promote(a: str | None, b: str | None) -> str | None:
    """The least type that holds both; None is the type of no values."""
    if a is None or b is None or a == b:
        return a or b
    return NUM if {a, b} == {INT, NUM} else TEXT


def kind_of(v: object) -> str | None:
    if v is None:
        return None
    return BOOL if isinstance(v, bool) else INT if isinstance(v, int) else NUM if isinstance(v, float) else TEXT


def _slot(s: str, size: int) -> int:
    return zlib.crc32(s.encode()) % size


def looks(v: object) -> tuple[list[int], int]:
    """Hashed words and hashed shape of a value. Numbers written as text look like numbers."""
    if isinstance(v, bool):
        return [_slot("bool", WORDS)], _slot("bool", SHAPES)
    if isinstance(v, (int, float)) or _NUMBER.match(v):
        s = repr(v) if isinstance(v, (int, float)) else v.strip()
        x = abs(float(s))
        size = int(2 * np.log10(x + 1)) if x < 1e300 else 600
        return [_slot(f"size {size} {s.startswith('-')}", WORDS)], _slot(f"decimals {min(3, len(s.partition('.')[2].rstrip('0')))}", SHAPES)
    s = _DIGITS.sub("9", v.upper())
    return [_slot(w, WORDS) for w in s.split()] or [_slot("", WORDS)], _slot(_LETTERS.sub("A", s), SHAPES)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1: overlap (Bhattacharyya) of the word counts times that of the shape counts, as a geometric mean."""
    r = 1.0
    for x, y in ((a[:WORDS], b[:WORDS]), (a[WORDS:], b[WORDS:])):
        if not x.sum() or not y.sum():
            return 0.0
        r *= float(np.sqrt(x / x.sum() * (y / y.sum())).sum())
    return r**0.5


def _profile(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(file, pos, slot, n): counts of features by column, added up per batch. Slots from WORDS + SHAPES on are the types."""
    kinds = [BOOL, INT, NUM, TEXT]
    for pdf in batches:
        counts: Counter = Counter()
        for fid, cells in zip(pdf["file"], pdf["cells"]):
            for pos, v in enumerate(json.loads(cells)):
                if v is None:
                    continue
                if isinstance(v, (list, dict)):
                    v = json.dumps(v)
                words, shape = looks(v)
                for w in words:
                    counts[fid, pos, w] += 1
                counts[fid, pos, WORDS + shape] += 1
                counts[fid, pos, WORDS + SHAPES + kinds.index(kind_of(v))] += 1
        if counts:
            f, p, s = zip(*counts)
            yield pd.DataFrame({"file": f, "pos": p, "slot": s, "n": list(counts.values())})


def header_names(cells: list) -> list[str]:
    """Name forms of a header line; a blank name is UNNAMED with its position, a repeated one gets a number."""
    seen: Counter = Counter()
    out = []
    for i, c in enumerate(cells):
        n = " ".join(str(c).split()).upper() if c is not None else ""
        n = n or f"UNNAMED {i}"
        out.append(n if not seen[n] else f"{n}.{seen[n]}")
        seen[n] += 1
    return out


def _renames(new: dict[str, np.ndarray], gone: dict[str, np.ndarray]) -> dict[str, str]:
    """New name to vanished name, the likest pairs first, each name once; ties in name order."""
    pairs = sorted(((-likeness(p, g), n, m) for n, p in new.items() for m, g in gone.items()), key=lambda x: (round(x[0], 12), x[1], x[2]))
    out: dict[str, str] = {}
    for s, n, m in pairs:
        if -s >= LIKENESS and n not in out and m not in out.values():
            out[n] = m
    return out


class _Series:
    """State of one series: for each present field its first name, last known type and profile over all files so far.

    No two present fields share a first name: one added under a name that a renamed field had first gets a number.
    """

    def __init__(self) -> None:
        self.fields: dict[str, dict] | None = None

    def step(self, names: list[str], cols: list[tuple[str | None, np.ndarray]]) -> list[tuple]:
        """Rows (pos, field_name, first_name, former_name, change_kind, former_type, type); change_kind None maps a column."""
        now = dict(zip(names, zip(range(len(names)), cols)))
        before = self.fields or {}
        gone = {m: f["looks"] for m, f in before.items() if m not in now}
        renamed = _renames({n: c[1] for n, (_, c) in now.items() if n not in before}, gone)
        added = [n for n in now if n not in before and n not in renamed]
        taken = {before[n if n in before else renamed[n]]["first"] for n in now if n not in added}
        first = {n: n for n in added if n not in taken}
        taken |= set(first)
        for n in added:
            if n not in first:
                first[n] = next(x for x in (f"{n}.{k}" for k in range(1, len(taken) + 2)) if x not in taken)
                taken.add(first[n])
        rows, fields = [], {}
        for n, (pos, (kind, looks_)) in now.items():
            former = n if n in before else renamed.get(n)
            if former is None:
                fields[n] = {"first": first[n], "type": kind, "looks": looks_}
                if self.fields is not None:
                    rows.append((pos, n, first[n], None, "added", None, kind))
            else:
                old = before[former]
                fields[n] = {"first": old["first"], "type": kind or old["type"], "looks": old["looks"] + looks_}
                if n != former:
                    rows.append((pos, n, old["first"], former, "renamed", old["type"], fields[n]["type"]))
                if kind and old["type"] and kind != old["type"]:
                    rows.append((pos, n, old["first"], former, "retyped", old["type"], kind))
            rows.append((pos, n, fields[n]["first"], former, None, None, fields[n]["type"]))
        rows += [(None, m, before[m]["first"], m, "removed", before[m]["type"], None) for m in gone if m not in renamed.values()]
        self.fields = fields
        return rows


_FOLD = "series string, at date, file long, pos int, field_name string, first_name string, former_name string, change_kind string, former_type string, type string"


def _fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Files in the order of their series; holds the state of one series at a time."""
    current, state = object(), _Series()
    for pdf in batches:
        out = []
        for s, at, fid, head, cols in zip(pdf["series"], pdf["at"], pdf["file"], pdf["header"], pdf["cols"]):
            if s != current:
                current, state = s, _Series()
            names = header_names(json.loads(head))
            profiles = [(None, np.zeros(WORDS + SHAPES)) for _ in names]
            for c in cols if cols is not None else []:
                if c is None or c["pos"] >= len(names):
                    continue
                p, kind = np.zeros(WORDS + SHAPES), None
                for x in c["counts"]:
                    if x["slot"] < WORDS + SHAPES:
                        p[x["slot"]] = x["n"]
                    else:
                        kind = promote(kind, (BOOL, INT, NUM, TEXT)[x["slot"] - WORDS - SHAPES])
                profiles[c["pos"]] = (kind, p)
            out += [(s, at, fid, *r) for r in state.step(names, profiles)]
        if out:
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _FOLD.split(", ")]).astype({"pos": "Int32"})


class Drift:
    """Files given as rows of JSON arrays, in series.

    ``rows``: file, line number and the line's typed cells; ``files``: file, series and order. A file's header is its
    first line of more than one cell; a file without one (or that no row of ``files`` names) is left out. Lines
    shorter than the header end in nulls, cells beyond it are dropped. Blank and repeated lines are kept as lines.
    Tables without rows give no changes and an empty table.
    """

    def __init__(self, rows: DataFrame, files: DataFrame, file: str, line: str, cells: str, series: str, order: str) -> None:
        self.rows = rows.select(F.col(file).cast("long").alias("file"), F.col(line).alias("line"), F.col(cells).alias("cells"))
        self.files = files.select(F.col(file).cast("long").alias("file"), F.col(series).cast("string").alias("series"), F.col(order).cast("date").alias("at"))
        self.headers = self.rows.where("json_array_length(cells) > 1").groupBy("file").agg(F.min(F.struct("line", "cells")).alias("h")).select("file", F.col("h.line").alias("head"), F.col("h.cells").alias("header"))
        self._log: DataFrame | None = None

    def body(self) -> DataFrame:
        """(file, line, cells) of the data lines."""
        return self.rows.join(self.headers.select("file", "head"), "file").where("line > head").drop("head")

    def log(self) -> DataFrame:
        """The fold's rows: a mapping of every column of every file, and the changes."""
        if self._log is None:
            counts = self.body().select("file", "cells").mapInPandas(_profile, "file long, pos int, slot int, n long").groupBy("file", "pos", "slot").agg(F.sum("n").alias("n"))
            cols = counts.groupBy("file", "pos").agg(F.collect_list(F.struct("slot", "n")).alias("counts")).groupBy("file").agg(F.collect_list(F.struct("pos", "counts")).alias("cols"))
            heads = self.files.join(self.headers, "file").join(cols, "file", "left")
            ordered = heads.select("series", "at", "file", "header", "cols").repartition("series").sortWithinPartitions("series", "at", "file")
            # read by the changes, the union schema and the table
            self._log = materialise(ordered.mapInPandas(_fold, _FOLD), "drift")
        return self._log

    def changes(self) -> DataFrame:
        c = self.log().where("change_kind is not null")
        return c.select(F.col("file").alias("file_id"), F.col("series"), F.col("at").alias("extracted_on"), "field_name", "change_kind", "first_name", "former_name", "former_type", F.col("type").alias("new_type"))

    def union_schema(self) -> list[tuple[str, str]]:
        """(first name, type) over all files, in name order; a table's width, not its length, bounds it."""
        kinds = self.log().where("change_kind is null").select("first_name", "type").distinct().collect()
        out: dict[str, str | None] = {}
        for r in kinds:
            out[r[0]] = promote(out.get(r[0]), r[1])
        return sorted((k, v) for k, v in out.items())

    def unified(self) -> DataFrame:
        """All data lines in the union schema: file_id, row_no, then a column for each field under its first name in its series."""
        schema = self.union_schema()
        where = self.log().where("change_kind is null").groupBy("file", "first_name").agg(F.min("pos").alias("pos"))
        where = where.groupBy("file").agg(F.map_from_entries(F.collect_list(F.struct("first_name", "pos"))).alias("pos"))
        lines = self.body().join(where, "file").withColumn("v", F.from_json("cells", "array<string>"))
        value = lambda n, t: F.expr(f"try_cast(get(v, try_element_at(pos, {_sql_text(n)})) as {SPARK_TYPES[t]})").alias(n)
        taken = {"file_id", "row_no"}
        return lines.select(F.col("file").alias("file_id"), F.col("line").alias("row_no"), *[value(n, t) if n.lower() not in taken else value(n, t).alias(n + "_") for n, t in schema])


def _sql_text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


__all__ = ["Drift", "promote", "likeness", "header_names"]
