"""Rules to Spark columns. Every predicate is two-valued, and no Python runs on the data.

A condition's type is the column's: numeric, date or text. Literals are read on the driver. A null matches no positive
predicate and all negations; ``compat_null_text`` instead reads a null in text predicates as the word 'None' ('nan'
in the key column), as string conversion would.
"""

from __future__ import annotations

import datetime as dt
import math
import re
import warnings
from functools import reduce
from operator import and_, or_

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.text import col, strip
from ledgerlens.plans.rules import ALIASES, OPERATORS, Condition, RuleError, RuleSet, Segment
from ledgerlens.schema import DEFAULT_SEGMENT, SEGMENT

_ORDER = {">": "__gt__", ">=": "__ge__", "<": "__lt__", "<=": "__le__"}
_NUMERIC, _DATE = (T.NumericType, T.BooleanType), (T.DateType, T.TimestampType, T.TimestampNTZType)


def _sure(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def _kind(field: T.StructField) -> str:
    return "number" if isinstance(field.dataType, _NUMERIC) else "date" if isinstance(field.dataType, _DATE) else "text"


def _coerce(kind: str, value):
    """The literal in the column's type; what can't be read stays as it is, as do None and ''."""
    if value is None or value == "":
        return value
    try:
        if kind == "number":
            return float(value)
        if kind == "date":
            t = pd.to_datetime(value)
            return value if pd.isna(t) else t.to_pydatetime().replace(tzinfo=None)
    except (ValueError, TypeError, OverflowError):
        return value
    return str(value)


def java_pattern(pattern: str, flags: str) -> str | None:
    """A Python pattern for Spark's engine; None if it is invalid in Python.

    Groups get names that both engines allow, the end of the text its other name, and in sets the signs that only one engine reads
    as operators are escaped. As in Python, only a line feed ends a line.
    """
    try:
        names = re.compile(pattern).groupindex
    except (re.error, TypeError):
        return None
    named = {n: f"g{i}" for n, i in names.items()}
    out, i, in_set = [], 0, False
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            out.append("\\z" if pattern[i : i + 2] == "\\Z" and not in_set else pattern[i : i + 2])
            i += 2
            continue
        if in_set:
            if c == "]" and i > first:
                in_set = False
            elif c in "[]" or c in "&~" and pattern[i + 1 : i + 2] == c:
                c = "\\" + c
        elif c == "[":
            in_set, first = True, i + 1 + (pattern[i + 1 : i + 2] == "^")
        elif m := re.match(r"\(\?P<(\w+)>|\(\?P=(\w+)\)", pattern[i:]):
            out.append(f"(?<{named[m[1]]}>" if m[1] else f"\\k<{named[m[2]]}>")
            i += m.end()
            continue
        out.append(c)
        i += 1
    return f"(?d{flags})" + "".join(out)


def _java_valid(df: DataFrame, pattern: str) -> bool:
    try:
        df.sparkSession._jvm.java.util.regex.Pattern.compile(pattern)
    except AttributeError:  # a session without a JVM at hand: left to the job
        return True
    except Exception:  # noqa: BLE001 - a pattern error of the JVM
        return False
    return True


def compile_condition(df: DataFrame, cond: Condition, compat_null_text: bool = False, key: str | None = None) -> Column:
    """One condition as a boolean column without nulls. Raises RuleError where no comparison is possible."""
    op = ALIASES.get(cond.op, cond.op)
    if cond.column not in df.columns:
        warnings.warn(f"no column {cond.column!r}: the condition matches nothing", stacklevel=2)
        return F.lit(False)
    if op not in OPERATORS:
        warnings.warn(f"no operator {cond.op!r}: the condition matches nothing", stacklevel=2)
        return F.lit(False)
    field = df.schema[cond.column]
    kind, raw = _kind(field), col(cond.column)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        raw = F.when(~F.isnan(raw), raw)  # NaN is a null here
    elif isinstance(field.dataType, T.BooleanType):
        raw = raw.cast("double")
    if op in ("est vide", "n'est pas vide"):
        empty = raw.isNull()
        if kind == "text":
            empty = empty | _sure(strip(raw.cast("string")) == "")
        return empty if op == "est vide" else ~empty
    if op == "between":
        return _between(kind, raw, cond.value)
    if op in ("dans la liste", "pas dans la liste"):
        inside = _in_list(kind, raw, cond.value)
        return inside if op == "dans la liste" else ~inside
    if op in ("contient", "ne contient pas", "commence par", "finit par", "regex"):
        return _text(df, op, _as_text(field, raw, compat_null_text, key), "" if cond.value is None else str(cond.value))
    value = _coerce(kind, cond.value)
    if op in ("==", "!="):
        same = _equal(kind, _as_text(field, raw, compat_null_text, key) if kind == "text" else raw, value, compat_null_text)
        return same if op == "==" else ~same
    return _ordered(kind, op, raw, value)


def _as_text(field: T.StructField, raw: Column, compat: bool, key: str | None) -> Column:
    c = F.date_format(raw, "yyyy-MM-dd") if isinstance(field.dataType, T.DateType) else raw.cast("string")
    return F.coalesce(c, F.lit("nan" if field.name == key else "None")) if compat else c


def _equal(kind: str, c: Column, value, compat: bool) -> Column:
    if kind == "text":
        if value is None:
            return _sure(F.lower(c) == "none") if compat else F.lit(False)
        return _sure(F.lower(c) == F.lower(F.lit(value)))
    if isinstance(value, float) and not math.isnan(value) or isinstance(value, dt.datetime):
        return _sure(_left(kind, c, value) == F.lit(value))
    return F.lit(False)


def _left(kind: str, c: Column, value) -> Column:
    return c.cast("timestamp_ntz") if kind == "date" and isinstance(value, dt.datetime) else c


def _ordered(kind: str, op: str, c: Column, value) -> Column:
    if kind == "text":
        return F.lit(False) if value is None else _sure(getattr(c.cast("string"), _ORDER[op])(F.lit(value)))
    if kind == "number" and value is None or kind == "date" and value == "":
        return F.lit(False)
    if not isinstance(value, (float, dt.datetime)):
        raise RuleError(f"{value!r} can't be compared with a {kind}")
    if isinstance(value, float) and math.isnan(value):
        return F.lit(False)
    return _sure(getattr(_left(kind, c, value), _ORDER[op])(F.lit(value)))


def _between(kind: str, c: Column, value) -> Column:
    if not isinstance(value, (list, tuple)):
        if kind == "date":
            raise RuleError("between needs two dates")
        return F.lit(False)
    if len(value) < 2:
        raise RuleError("between needs two bounds")
    low, high = (_coerce(kind, v) for v in value[:2])
    return _ordered(kind, ">=", c, low) & _ordered(kind, "<=", c, high)


def _in_list(kind: str, c: Column, value) -> Column:
    items = [x.strip() for x in ("" if value is None else ",".join(map(str, value)) if isinstance(value, (list, tuple)) else str(value)).split(",")]
    items = [_coerce(kind, x) for x in items if x]
    if kind == "text":
        return _sure(c.cast("string").isin(items)) if items else F.lit(False)
    usable = [x for x in items if isinstance(x, (float, dt.datetime))]
    nan = any(isinstance(x, float) and math.isnan(x) for x in usable)
    usable = [x for x in usable if not (isinstance(x, float) and math.isnan(x))]
    inside = _sure(reduce(or_, [_left(kind, c, x) == F.lit(x) for x in usable])) if usable else F.lit(False)
    return inside | c.isNull() if nan else inside


def _text(df: DataFrame, op: str, c: Column, value: str) -> Column:
    if value == "":
        return F.lit(op != "ne contient pas")
    if op == "commence par":
        return _sure(c.startswith(value))
    if op == "finit par":
        return _sure(c.endswith(value))
    pattern = java_pattern(value, "U" if op == "regex" else "iuU")
    if pattern is not None and not _java_valid(df, pattern):
        raise RuleError(f"no such pattern in this engine: {value!r}")
    if pattern is None:
        if op != "regex":
            raise RuleError(f"not a pattern: {value!r}")
        warnings.warn(f"not a pattern: {value!r}: the condition matches nothing", stacklevel=3)
        return F.lit(False)
    found = _sure(c.rlike(pattern))
    return ~found if op == "ne contient pas" else found


def segment_mask(df: DataFrame, segment: Segment, **options) -> Column:
    """All conditions (AND) or any (every other logic); a segment without conditions matches nothing."""
    if not segment.conditions:
        return F.lit(False)
    return reduce(and_ if segment.logic == "AND" else or_, [compile_condition(df, c, **options) for c in segment.conditions])


def segment_column(df: DataFrame, rules: RuleSet, **options) -> Column:
    """First match wins. A segment named as the default doesn't keep its rows from later ones, so it is left out."""
    out = None
    for s in rules.segments:
        if s.conditions and s.name != DEFAULT_SEGMENT:
            mask = segment_mask(df, s, **options)
            out = F.when(mask, F.lit(s.name)) if out is None else out.when(mask, F.lit(s.name))
    return F.lit(DEFAULT_SEGMENT) if out is None else out.otherwise(F.lit(DEFAULT_SEGMENT))


def classify(df: DataFrame, rules: RuleSet, compat_null_text: bool = False, key: str | None = None) -> DataFrame:
    """``df`` with the column ``segment`` last, replacing one of that name."""
    column = segment_column(df, rules, compat_null_text=compat_null_text, key=key)
    rest = [col(c) for c in df.columns if c != SEGMENT]
    return df.select(*rest, column.alias(SEGMENT))
