"""Predicates row by row, composition, first match wins, rule sets as data."""

import datetime as dt
import json
import warnings

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerlens.plans import presets
from ledgerlens.plans.compiler import classify, compile_condition
from ledgerlens.plans.rules import Condition, RuleError, RuleSet, RuleStore, Segment

NUM = [1.0, 5.0, -0.0, 1e7, None, float("nan")]
TEXT = ["Abc", "nan", "", " ", " ", "abc", " Abc", "xAbC", "a,b", "É(b)", None]
DATE = [dt.date(2024, 1, 1), dt.date(2024, 3, 1), None]


@pytest.fixture(scope="module")
def frames(spark):
    return {
        "n": spark.createDataFrame([(i, v) for i, v in enumerate(NUM)], "i int, n double"),
        "t": spark.createDataFrame([(i, v) for i, v in enumerate(TEXT)], "i int, t string"),
        "d": spark.createDataFrame([(i, v) for i, v in enumerate(DATE)], "i int, d date"),
    }


def hits(frames, col, op, value="", **options):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        df = frames[col]
        return sorted(r.i for r in df.where(compile_condition(df, Condition(col, op, value), **options)).collect())


@pytest.mark.parametrize(
    "col, op, value, wanted",
    [
        ("n", "==", "5", [1]), ("n", "==", " 5 ", [1]), ("n", "==", "0", [2]), ("n", "==", "x", []), ("n", "==", "", []), ("n", "!=", "5", [0, 2, 3, 4, 5]),
        ("n", "!=", "x", [0, 1, 2, 3, 4, 5]), ("n", ">", "1", [1, 3]), ("n", ">=", "1", [0, 1, 3]), ("n", "<", "1", [2]), ("n", "<=", "1_0", [0, 1, 2]), ("n", ">", "nan", []),
        ("n", ">", None, []), ("n", "between", ["0", "5"], [0, 1, 2]), ("n", "between", ["5", "0"], []), ("n", "between", "5", []), ("n", "dans la liste", "5, x, 1e7", [1, 3]),
        ("n", "dans la liste", "nan", [4, 5]), ("n", "dans la liste", "", []), ("n", "pas dans la liste", "5", [0, 2, 3, 4, 5]), ("n", "est vide", "", [4, 5]), ("n", "n'est pas vide", "", [0, 1, 2, 3]),
        ("t", "==", "ABC", [0, 5]), ("t", "!=", "ABC", [1, 2, 3, 4, 6, 7, 8, 9, 10]), ("t", "==", None, []), ("t", "contient", "ABC", [0, 5, 6, 7]), ("t", "contient", "é", [9]), ("t", "contient", "", list(range(11))),
        ("t", "ne contient pas", "abc", [1, 2, 3, 4, 8, 9, 10]), ("t", "ne contient pas", "", []), ("t", "commence par", "A", [0]), ("t", "commence par", "", list(range(11))), ("t", "finit par", "bc", [0, 5, 6]),
        ("t", "dans la liste", "Abc, a", [0]), ("t", "dans la liste", "a,b", []), ("t", "pas dans la liste", "Abc", [1, 2, 3, 4, 5, 6, 7, 8, 9, 10]), ("t", "regex", r"^\w+$", [0, 1, 5, 7]), ("t", "regex", "(?P<x>b)c", [0, 5, 6]),
        ("t", "regex", "(", []), ("t", "est vide", "", [2, 3, 4, 10]), ("t", "n'est pas vide", "", [0, 1, 5, 6, 7, 8, 9]), ("t", ">", "abc", [1, 4, 7, 9]),
        ("d", "==", "2024", [0]), ("d", "!=", "2024-01-01", [1, 2]), ("d", "==", "x", []), ("d", ">", "2024-01-15", [1]), ("d", "<=", "31/12/2024", [0, 1]), ("d", "between", ["2024-02-01", "2024-03-01"], [1]), ("d", ">", "", []), ("d", "est vide", "", [2]),
        ("t", "no such", "x", []),
    ],
)
def test_predicate(frames, col, op, value, wanted):
    assert hits(frames, col, op, value) == wanted


def test_unknown_column_matches_nothing(spark, frames):
    with pytest.warns(UserWarning):
        assert frames["n"].where(compile_condition(frames["n"], Condition("zz", "!=", "1"))).count() == 0


def test_compat_null_text(frames):
    assert 10 in hits(frames, "t", "contient", "on", compat_null_text=True)
    assert 10 in hits(frames, "t", "==", "nan", compat_null_text=True, key="t")
    assert 10 in hits(frames, "t", "==", None, compat_null_text=True)


@pytest.mark.parametrize("col, op, value", [("n", ">", "x"), ("n", "<", ""), ("n", "between", ["1"]), ("d", "between", "2024"), ("d", ">", "x"), ("d", ">", None), ("t", "contient", "(")])
def test_impossible_literals_raise_before_any_job(frames, col, op, value):
    with pytest.raises(RuleError):
        hits(frames, col, op, value)


@pytest.mark.parametrize("a, b", [("dans la liste", "pas dans la liste"), ("contient", "ne contient pas"), ("est vide", "n'est pas vide"), ("==", "!=")])
@pytest.mark.parametrize("value", ["", "abc", "a,b"])
def test_negations_partition_the_rows(frames, a, b, value):
    x, y = hits(frames, "t", a, value), hits(frames, "t", b, value)
    assert sorted(x + y) == list(range(len(TEXT)))


def test_first_match_wins_and_no_python_in_the_plan(spark, frames):
    rules = RuleSet((Segment("Non classe", "AND", (Condition("n", ">", "0"),)), Segment("empty"), Segment("big", "AND", (Condition("n", ">", "1"), Condition("n", "<", "1e9"))), Segment("any", "OR", (Condition("n", "==", "1"), Condition("n", "est vide")))))
    done = classify(frames["n"].withColumnRenamed("i", "segment").withColumnRenamed("segment", "i"), rules)
    assert [r.segment for r in done.orderBy("i").collect()] == ["any", "big", "Non classe", "big", "any", "any"]
    assert "Python" not in done._jdf.queryExecution().toString()


def test_existing_segment_column_is_replaced(spark):
    df = spark.createDataFrame([("old", 1.0)], "segment string, n double")
    assert classify(df, RuleSet()).collect()[0].asDict() == {"n": 1.0, "segment": "Non classe"}


def test_rule_set_operations(tmp_path):
    r = RuleSet().add(" A ").add("B").add_condition(0, "x", "==", "1").move(0, 1)
    assert [s.name for s in r.segments] == ["B", "A"] and r.move(1, 1) == r and r.rename(0, "C").segments[0].name == "C"
    assert r.set_logic(0, "OR").segments[0].logic == "OR" and r.set_condition(1, 0, value="2").segments[1].conditions[0].value == "2"
    assert not r.remove_condition(1, 0).segments[1].conditions and len(r.remove(0).segments) == 1 and r.clear() == RuleSet()
    for bad in (lambda: r.add(" "), lambda: r.remove(9), lambda: r.set_logic(0, "XOR"), lambda: RuleSet.from_json("{"), lambda: RuleSet.from_json("{}"), lambda: RuleSet.from_json('[{"name": 1}]')):
        with pytest.raises(RuleError):
            bad()
    store = RuleStore(tmp_path / "a" / "rules.json")
    assert store.load() == RuleSet()
    store.save(r)
    assert store.load() == r
    store.path.write_text("broken")
    assert store.load() == RuleSet()
    assert RuleSet.from_json('[{"name": "x"}]').segments[0].logic == "AND"


_conditions = st.builds(Condition, st.text(max_size=4), st.sampled_from(["==", "regex", "between"]), st.one_of(st.none(), st.text(max_size=4), st.tuples(st.text(max_size=3), st.text(max_size=3))))


@given(st.lists(st.builds(Segment, st.text(max_size=5), st.sampled_from(["AND", "OR"]), st.lists(_conditions, max_size=3).map(tuple)), max_size=4))
@settings(max_examples=50, deadline=None, suppress_health_check=list(HealthCheck))
def test_json_round_trip(segments):
    rules = RuleSet(tuple(segments))
    assert RuleSet.from_json(rules.to_json()) == rules
    json.loads(rules.to_json())


def test_quartile_preset(spark):
    df = spark.createDataFrame([(float(i),) for i in range(-2, 102)] + [(None,), (float("nan"),)], "CA_EUR double")
    rules = presets.quartiles(df)
    assert [s.name for s in rules.segments] == ["VIP", "Gold", "Silver", "Bronze"] and rules.segments[0].conditions[0].value == "75"
    with pytest.raises(RuleError):
        presets.quartiles(df.where("CA_EUR is null"))


@pytest.mark.parametrize("pattern", [r"(?P<x_y>a)b", r"(?P<x_y>a)(?P=x_y)", r"\(?P<", r"b\Z", r"[[]a", r"[&&]", r"[^]]b", r"[]a]b", "^a.b$", r"a&&b"])
@pytest.mark.parametrize("op", ["regex", "contient"])
def test_python_patterns(spark, pattern, op):
    import re

    texts = ["ab", "aa", "(P<", "[a", "&", "]b", "xb", "a\rb", "a\nb", "a&&b", "", "b\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(compile_condition(df, Condition("t", op, pattern))).collect()]
    assert got == [bool(re.search(pattern, t, re.I if op == "contient" else 0)) for t in texts]


def test_pattern_that_only_python_has(spark):
    df = spark.createDataFrame([("ab",)], "t string")
    for op in ("regex", "contient"):
        with pytest.raises(RuleError):
            compile_condition(df, Condition("t", op, r"(a)?(?(1)b|c)"))


def test_classification_has_no_python_node(spark):
    df = spark.createDataFrame([("ab", 1.0)], "t string, CA_EUR double")
    rules = RuleSet((Segment("x", "AND", (Condition("t", "regex", "a"), Condition("CA_EUR", ">", "0"))),))
    plan = classify(df, rules)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan
