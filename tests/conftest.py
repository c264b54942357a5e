from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
DATA = Path(os.environ.get("TEST_DATA", "/root/testdata"))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings operations client_aggregates customer_snapshots extract_files extract_rows mix_targets review_examples".split()


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "3g")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def canonical(df):
    """Rows as sorted tuples of comparable texts."""
    import pandas as pd

    def cell(x):
        if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and x != x):
            return ""
        if isinstance(x, bool):
            return str(x)
        if isinstance(x, (int, float)) or type(x).__name__ in ("Decimal", "float64", "int64", "int32"):
            return format(float(x), ".9g")
        return str(x).replace(" 00:00:00", "")

    return sorted(tuple(cell(r[c]) for c in sorted(df.columns)) for r in df.to_dict("records"))


def against_sql(spark, query, sql, scale="sf0.001"):
    """Rows of the query and of its SQL."""
    import duckdb

    d = DATA / scale
    if not d.exists():
        pytest.skip("no test data")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{d}/{t}.parquet'")
    a, b = query(spark, str(d)).toPandas(), con.sql(sql).df()
    assert sorted(a.columns) == sorted(b.columns)
    return canonical(a), canonical(b)
