"""Column expressions for names, labels and text cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def q(name: str) -> str:
    """Quote a column name, so that blanks, slashes and dots in it are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(q(name))


def name_form(c: Column) -> Column:
    """Outer blanks removed, runs of blanks made one blank, upper case; null stays null."""
    return F.upper(F.trim(F.regexp_replace(c, r"(?U)\s+", " ")))


def strip(c: Column) -> Column:
    """Removes Unicode white space from both ends (``trim`` removes blanks only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
