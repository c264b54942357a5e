"""General data operators against brute force; nulls, ties, repeats, empty tables, clashing names."""

import datetime as dt
import json
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import aggregate as A
from ledgerlens.operators import drift, features, history, prepare, quantiles, skew
from ledgerlens.operators.filters import FilterSpec, apply_filters
from ledgerlens.operators.report import distribution


def test_exact_sums_beyond_doubles():
    rng = np.random.default_rng(1)
    cells, values = rng.integers(0, 5, 1000), rng.integers(-(2**52), 2**52, 1000)
    assert features.exact_sums(cells, values, 5).tolist() == [int(values[cells == k].sum()) for k in range(5)]
    with pytest.raises(OverflowError):
        features.exact_sums(np.zeros(4, int), np.full(4, 2**62), 1)


@pytest.mark.parametrize("wide", [False, True])
def test_feature_table(spark, wide):
    rng = random.Random(2)
    rows = []
    for i in range(3000):
        e = rng.choice(["HOT"] * 20 + [f"e{k}" for k in range(40)] + [None])
        rows.append((e, rng.choice(["a", "b", None]), rng.choice(["x", "y", "z"]), rng.choice([dt.date(2024, m, 1) for m in range(1, 13)] + [None]), rng.choice([None, -5, 10**12, 3]), "clash"))
    df = spark.createDataFrame(rows, "who string, k1 string, k2 string, day date, amount long, entity string")
    types = features.event_types(df, ["k1", "k2"], 10)
    assert types == [(a, b) for a in "ab" for b in "xyz"]
    spec = features.FeatureSpec(entities_per_bucket=7, rows_per_flush=100)
    got = features.feature_table(df, "who", ["k1", "k2"], "day", F.col("amount"), types, spec, wide)
    pdf = pd.DataFrame(rows, columns=["e", "a", "b", "day", "amount", "_"])
    pdf = pdf[pdf.e.notna() & pdf.a.notna() & pdf.day.notna()]
    pdf["amount"] = pdf.amount.fillna(0).astype("int64")
    wanted = {(e, types.index((a, b))): (len(g), max(g.day), int(g.amount.sum())) for (e, a, b), g in pdf.groupby(["e", "a", "b"])}
    out = {}
    for r in got.collect():
        for k in range(len(types)):
            n, last, total = (r[f"n_{k}"], r[f"last_{k}"], r[f"total_{k}"]) if wide else (r.n[k], r.last[k], r.total[k])
            if n:
                out[r.entity, k] = (n, last, total)
            else:
                assert last is None and total == 0
    assert out == wanted
    assert features.feature_table(df.limit(0), "who", ["k1", "k2"], "day", F.col("amount"), types, spec, wide).count() == 0
    assert features.event_types(df.limit(0), ["k1"], 5) == []
    with pytest.raises(ValueError):
        features.event_types(df, ["k1", "k2"], 5)


@pytest.mark.parametrize("wide", [False, True])
def test_feature_table_has_every_entity(spark, wide):
    rows = [("a", "x", dt.date(2024, 1, 1), 5), ("a", "x", None, 7), ("b", "y", None, None), ("c", None, dt.date(2024, 1, 1), 1), (None, "x", None, 1)]
    df = spark.createDataFrame(rows, "who string, k string, day date, amount long")
    people = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), ("d",), (None,)], "who string")
    types = [("x",), ("y",)]
    table = lambda df, types, **k: features.feature_table(df, "who", ["k"], "day", F.col("amount"), types, features.FeatureSpec(entities_per_bucket=2), wide, people, **k)
    cells = lambda r: [(r[f"n_{k}"], r[f"last_{k}"], r[f"total_{k}"]) if wide else (r.n[k], r.last[k], r.total[k]) for k in (0, 1)]
    none = (0, None, 0)
    got = sorted((r.entity, cells(r)) for r in table(df, types, every=True, undated=True).collect())
    assert got == [("a", [(2, dt.date(2024, 1, 1), 12), none]), ("b", [none, (1, None, 0)]), ("c", [none, none]), ("d", [none, none])]
    assert [(r.entity, cells(r)) for r in table(df, types).collect()] == [("a", [(1, dt.date(2024, 1, 1), 5), none])]
    assert sorted(r.entity for r in table(df.limit(0), types, every=True).collect()) == sorted(r.entity for r in table(df, [], every=True).collect()) == ["a", "b", "c", "d"]


@pytest.mark.parametrize("limit", [100_000, 20])
def test_quantiles_and_narrowing(spark, monkeypatch, limit):
    monkeypatch.setattr(quantiles, "SPAN_VALUES", limit)
    rng = np.random.default_rng(3)
    vals = {"hot": [*rng.lognormal(3, 2, 900), *[7.0] * 300, *np.linspace(100, 101, 400)], "neg": [*-rng.lognormal(1, 3, 50), 0.0, 0.0], "one": [5.0], None: [1.0, 2.0, 3.0], "inf": [float("inf"), -float("inf"), 1.0]}
    rows = [(g, float(v), 1, "x") for g, vs in vals.items() for v in vs] + [("hot", float("nan"), 1, "x"), ("hot", None, 1, "x"), ("none", None, 1, "x")]
    df = spark.createDataFrame(rows, "g string, value double, weight long, n string")
    got = {(r.g, r.p): r.value for r in quantiles.weighted_quantiles(df, ["g"], [0.1, 0.5, 0.9, 1.0]).collect()}
    wanted = {(g, p): sorted(v)[max(1, -(-int(p * 10) * len(v) // 10)) - 1] for g, v in vals.items() for p in (0.1, 0.5, 0.9, 1.0)}
    assert got == wanted
    with pytest.raises(ValueError):
        quantiles.weighted_quantiles(df.withColumn("p", F.lit(1)), ["p"], [0.5])


def test_key_profile(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["HOT"] * 9 + ["a", "b", None]), rng.choice(["x", "y", None]), 1) for _ in range(500)] + [("nul", None, 1), ("tie", "q", 1), ("tie", "p", 1)]
    df = spark.createDataFrame(rows, "k string, v string, weight int")
    w = skew.compress(df, {"k": F.col("k")}, F.col("v"))
    got = {r.key_value: r for r in skew.key_profile(w).collect()}
    pdf = pd.DataFrame(rows, columns=["k", "v", "_"])
    assert got["HOT"].n_rows == (pdf.k == "HOT").sum() and got[None].n_rows == pdf.k.isna().sum()
    assert got["HOT"].mode == pdf[pdf.k == "HOT"].v.value_counts().index[0] and got["tie"].mode == "p"
    assert (got["nul"].mode, got["nul"].n_distinct, got["nul"].n_values) == (None, 0, 0)
    heavy = {r.key_value for r in skew.heavy_keys(skew.key_profile(w), 0.5).collect()}
    assert heavy == {"HOT"}
    assert skew.key_profile(skew.compress(df.limit(0), {"k": F.col("k")}, F.col("v"))).count() == 0


def _versions(rows):
    """Brute force of one entity's history."""
    best = {}
    for date, received, label, active in rows:
        if date not in best or received > best[date][0]:
            best[date] = (received, label, active)
    out, label, open_ = [], None, None
    for date in sorted(best):
        _, new, active = best[date]
        changed = new is not None and new != label
        label = new if new is not None else label
        if open_ is not None and (not active or changed):
            out.append((open_[1], open_[0], date))
            open_ = None
        if active and open_ is None:
            open_ = (date, label)
    if open_ is not None:
        out.append((open_[1], open_[0], None))
    return out


def test_history(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", "HOT", "HOT"]), dt.date(2024, 1, 1) + dt.timedelta(rng.randrange(60)), k, rng.choice(["x", "y", None, None]), rng.random() < 0.8) for k in range(300)]
    rows += [(None, dt.date(2024, 1, 1), 1000, "x", True)]
    df = spark.createDataFrame(rows, "who string, day date, got long, label string, active boolean").withColumn("value", F.lit(1))
    h = history.attribute_history(df, "who", "day", ["got"], ["label"], "active")
    got = sorted((r.who, str(r.label), r.valid_from, str(r.valid_to)) for r in h.collect())
    wanted = sorted((w, str(v), a, str(b)) for w in ("a", "b", "HOT") for v, a, b in _versions([r[1:] for r in rows if r[0] == w]))
    assert got == wanted
    assert history.attribute_history(df.limit(0), "who", "day", ["got"], ["label"], "active").count() == 0


def _extract(spark, files):
    rows = [(fid, n, json.dumps(c)) for fid, lines in files.items() for n, c in enumerate(lines)]
    meta = [(fid, "s", dt.date(2024, 1, fid)) for fid in files]
    return drift.Drift(spark.createDataFrame(rows, "file_id long, row_no int, cells string"), spark.createDataFrame(meta, "file_id long, crm_source string, extracted_on date"), "file_id", "row_no", "cells", "crm_source", "extracted_on")


def test_drift(spark):
    firms = [f"{a} {b} LTD" for a in ("ALPHA", "BETA", "GAMMA") for b in ("FOODS", "METALS")]
    files = {
        1: [["preamble"], [], ["Year", "Customer", "Ok", "Empty"], *[[2024, f, True, None] for f in firms]],
        2: [[" year ", "CLIENT", "Ok", "Note", "Empty"], *[[str(2024), f, True, "some words here", None] for f in firms]],
        3: [["year", "Client", "Empty"], *[["2024", f, 1] for f in firms], ["2024", "Z", 2.5], [None, None, None], ["2024"]],
        4: [["only a preamble"]],
    }
    d = _extract(spark, files)
    got = sorted((r.file_id, r.field_name, r.change_kind) for r in d.changes().collect())
    assert got == [(2, "CLIENT", "renamed"), (2, "NOTE", "added"), (2, "YEAR", "retyped"), (3, "NOTE", "removed"), (3, "OK", "removed")]
    assert dict(d.union_schema()) == {"CUSTOMER": "text", "EMPTY": "number", "NOTE": "text", "OK": "boolean", "YEAR": "text"}
    rows = d.unified().orderBy("file_id", "row_no").collect()
    assert len(rows) == 6 + 6 + 9 and {r.CUSTOMER for r in rows if r.file_id == 3} == {*firms, "Z", None} and rows[0].OK is True and rows[-3].EMPTY == 2.5
    none = drift.Drift(d.rows.limit(0).toDF("file_id", "row_no", "cells"), d.files.limit(0).toDF("file_id", "crm_source", "extracted_on"), "file_id", "row_no", "cells", "crm_source", "extracted_on")
    assert none.changes().count() == 0 and none.unified().count() == 0


def test_drift_keeps_a_field_added_under_a_former_name(spark):
    firms = [f"{a} {b} LTD" for a in ("ALPHA", "BETA", "GAMMA") for b in ("FOODS", "METALS")]
    files = {
        1: [["Customer", "Year"], *[[f, 2024] for f in firms]],
        2: [["Client", "Year"], *[[f, 2024] for f in firms]],
        3: [["Customer", "Client", "Year", "Customer.1"], *[[k * 1.5, f, 2024, True] for k, f in enumerate(firms)]],
        4: [["Client", "Customer", "Year"], *[[f, k * 1.5, 2024] for k, f in enumerate(firms)]],
    }
    d = _extract(spark, files)
    log = sorted((r.file_id, r.field_name, r.change_kind, r.first_name) for r in d.changes().collect())
    assert log == [(2, "CLIENT", "renamed", "CUSTOMER"), (3, "CUSTOMER", "added", "CUSTOMER.2"), (3, "CUSTOMER.1", "added", "CUSTOMER.1"), (4, "CUSTOMER.1", "removed", "CUSTOMER.1")]
    assert dict(d.union_schema()) == {"CUSTOMER": "text", "CUSTOMER.1": "boolean", "CUSTOMER.2": "number", "YEAR": "integer"}
    rows = [tuple(r) for r in d.unified().orderBy("file_id", "row_no").collect()]
    wanted = [(f, k + 1, firm, True if f == 3 else None, k * 1.5 if f > 2 else None, 2024) for f in files for k, firm in enumerate(firms)]
    assert rows == wanted


def test_lattice():
    kinds = [None, drift.BOOL, drift.INT, drift.NUM, drift.TEXT]
    for a in kinds:
        for b in kinds:
            assert drift.promote(a, b) == drift.promote(b, a) and drift.promote(a, a) == a
            for c in kinds:
                assert drift.promote(a, drift.promote(b, c)) == drift.promote(drift.promote(a, b), c)
    assert drift.promote(drift.BOOL, drift.INT) == drift.TEXT and drift.promote(drift.INT, drift.NUM) == drift.NUM


def test_prepare_and_aggregate(spark):
    df = spark.createDataFrame([("j1", 2, 2024, 1, "A", 5.0), ("j1", 1, 2024, 13, "B", 1.0), (None, 4, 2024, 2, None, None), (None, 3, None, 2, "A", float("nan"))], "JobfileNumber string, o int, Year int, Month int, Customer string, TEU double")
    once = prepare.keep_first(df, ["JobfileNumber"], ["o"])
    assert sorted((r.JobfileNumber or "", r.o) for r in once.collect()) == [("", 3), ("j1", 1)]
    assert prepare.keep_first(once, ["JobfileNumber"], ["o"]).count() == 2
    assert prepare.removed_count(df, "JobfileNumber").first().asDict() == {"rows_before": 4, "rows_after": 2, "removed": 2}
    assert [r.Period for r in prepare.with_period(df).orderBy("o").collect()] == [None, dt.date(2024, 1, 1), None, dt.date(2024, 2, 1)]
    assert prepare.with_period(df.drop("Year")).columns == df.drop("Year").columns
    out = prepare.concat_by_name([df.select("o"), df.select("Year", "o")])
    assert out.count() == 8 and out.where("Year is null").count() == 5
    agg = A.aggregate(prepare.with_period(df), A.AggSpec(deduplicated=False))
    assert agg.columns == ["Customer", "TEU", "Nb_operations", "Premiere_activite", "Derniere_activite", "Nb_mois_actifs"]
    got = {r.Customer: r for r in agg.collect()}
    assert got["A"].TEU == 5.0 and got[None].TEU == 0.0 and got[None].Nb_operations == 0 and got["A"].Nb_mois_actifs == 1
    with pytest.raises(A.AggregationError):
        A.aggregate(df, A.AggSpec(key="TEU"))
    with pytest.raises(A.AggregationError):
        A.aggregate(df.select("Customer"))
    with pytest.raises(A.AggregationError):
        A.aggregate(df, A.AggSpec(key="nope"))
    assert A.sorted_aggregate(agg).first().Customer == "A"


def test_filters(spark):
    df = spark.createDataFrame([(1, 2023, 5, "P"), (2, None, 5, "P"), (3, 2023, None, "Q"), (4, 2024, 8, None)], "i int, Year int, Month int, `Product Name` string")
    ids = lambda **k: sorted(r.i for r in apply_filters(df, FilterSpec(**k)).collect())
    assert ids() == [1, 4] and ids(years=[2023]) == [1] and ids(months=(8, 9)) == [4] and ids(dims={"Product Name": ["P"]}) == [1] and ids(dims={"Product Name": []}) == []
    assert sorted(r.i for r in apply_filters(df.drop("Month"), FilterSpec()).collect()) == [1, 3, 4]
    with pytest.raises(ValueError):
        apply_filters(df, FilterSpec(dims={"nope": []}))


def test_distribution(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", -1.0), ("b", None), ("b", float("nan"))], "segment string, CA_EUR double")
    rows = distribution(df).collect()
    assert [r["%"] for r in rows] == [50.0, 50.0] and all(r["%_CA"] is None for r in rows) and rows[0]["CA_total_EUR"] == 0
    assert distribution(df.drop("CA_EUR")).columns == ["segment", "nb_clients", "%"]
    assert distribution(df.limit(0)).count() == 0
