"""Every query of the core against its SQL; the goldens of the star schema."""

import pytest

from ledgerlens.queries import data, files, reference
from tests.conftest import DATA, against_sql

QUERIES = reference.QUERIES | data.QUERIES | files.QUERIES
ORACLE = reference.ORACLE | data.ORACLE | files.ORACLE


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    got, wanted = against_sql(spark, QUERIES[name], ORACLE[name])
    assert got == wanted


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql_runs(spark, name):
    if not (DATA / "sf0.001").exists():
        pytest.skip("no test data")
    assert QUERIES[name](spark, str(DATA / "sf0.001")).count() > 0


def test_goldens(spark):
    if not (DATA / "sf0.01").exists():
        pytest.skip("no test data")
    rows = {r["segment"]: r for r in reference.flagship_pipeline(spark, str(DATA / "sf0.01")).collect()}
    assert {k: r["nb_clients"] for k, r in rows.items()} == dict.fromkeys(("VIP", "Gold", "Silver", "Bronze"), 375)
    assert rows["VIP"]["CA_total_EUR"] == pytest.approx(856160044.5133) and rows["Bronze"]["%_CA"] == 14.2


def test_entry_contract(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns[0] == "segment"


def test_feature_table_of_all_customers(spark):
    d = DATA / "sf0.001"
    if not d.exists():
        pytest.skip("no test data")
    import duckdb

    ops, name = f"'{d}/operations.parquet'", data.sql_name("Customer")
    kept = f"""(select * from (select *, row_number() over (partition by "JobfileNumber" order by load_seq) as rn from {ops} where "JobfileNumber" is not null) where rn = 1)"""
    customers, n = duckdb.sql(f"select (select count(distinct {name}) from {ops}), (select count(*) from {kept} where {name} is not null and \"Activity Name (EN)\" is not null and \"Product Name\" is not null)").fetchall()[0]
    rows = data.p1_feature_table(spark, str(d)).toPandas()
    assert len(rows) == rows.entity.nunique() == customers
    assert rows[[c for c in rows if c.startswith("n_")]].to_numpy().sum() == n
