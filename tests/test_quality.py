"""Seeded violations: every kind of rule can fail, and counts what it should."""

import pytest

from revmart.operators.quality import (
    ACCEPTED_VALUES,
    EXPRESSION,
    NOT_NULL,
    RELATIONSHIP,
    ROW_COUNT,
    UNIQUE,
    UNIQUE_COMBINATION,
    DataCheckError,
    Rule,
    enforce,
    evaluate,
    scorecard,
)


@pytest.fixture(scope="module")
def models(spark):
    rows = [("a", "x", 1, True), ("a", "y", -1, None), (None, "x", None, False), (None, None, 3, True), ("b", "x", 4, True)]
    return {
        "child": spark.createDataFrame(rows, "id string, kind string, n int, ok boolean"),
        "parent": spark.createDataFrame([("a",), ("z",), (None,)], "key string"),
        "part": spark.createDataFrame([(1,), (2,)], "i int"),
    }


CASES = {
    "missing values": (Rule("child", NOT_NULL, ("id",)), 2),
    "missing values where ok": (Rule("child", NOT_NULL, ("id",), where="ok"), 1),
    "repeated values ignore NULL": (Rule("child", UNIQUE, ("id",)), 1),
    "repeated values where kind is y": (Rule("child", UNIQUE, ("id",), where="kind = 'y'"), 0),
    "repeated combinations count NULL": (Rule("child", UNIQUE_COMBINATION, ("id",)), 2),
    "no repeated combination": (Rule("child", UNIQUE_COMBINATION, ("id", "kind")), 0),
    "unlisted values ignore NULL": (Rule("child", ACCEPTED_VALUES, ("kind",), values=("x",)), 1),
    "boolean values by text": (Rule("child", ACCEPTED_VALUES, ("ok",), values=("false",)), 3),
    "predicate lets NULL pass": (Rule("child", EXPRESSION, expression="n >= 0"), 1),
    "orphans ignore NULL": (Rule("child", RELATIONSHIP, ("id",), parent=("parent", "key")), 1),
    "orphans of another column": (Rule("child", RELATIONSHIP, ("kind",), parent=("parent", "key")), 4),
    "row counts differ": (Rule("child", ROW_COUNT, parts=("parent", "part", "part")), 1),
    "row counts agree": (Rule("child", ROW_COUNT, parts=("parent", "part")), 0),
}


def test_counts(models):
    report = evaluate(models, [rule for rule, _ in CASES.values()]).collect()
    found = {r.check_id: r.failures for r in report}
    assert {name: found[i] for i, name in enumerate(CASES, start=1)} == {n: c for n, (_, c) in CASES.items()}


def test_severity_decides_the_outcome(models):
    warn = Rule("child", NOT_NULL, ("id",), severity="warn", dimension="completeness")
    error = Rule("child", NOT_NULL, ("kind",), dimension="completeness")
    fine = Rule("part", NOT_NULL, ("i",))
    enforce(evaluate(models, [warn, fine]))
    with pytest.raises(DataCheckError, match=r"child: not_null\(kind\) \(1\)"):
        enforce(evaluate(models, [warn, error, fine]))
    card = {r.dimension: tuple(r)[1:] for r in scorecard(evaluate(models, [warn, error, fine])).collect()}
    assert card == {"completeness": (2, 0, 1, 1, 3), "none": (1, 1, 0, 0, 0)}


def test_row_rules_share_one_scan(models):
    rules = [Rule("child", NOT_NULL, (c,)) for c in ("id", "kind", "n", "ok")]
    plan = evaluate(models, rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 2  # the model and the rule descriptions


def test_missing_model_is_named(models):
    with pytest.raises(KeyError, match="nowhere"):
        evaluate(models, [Rule("nowhere", NOT_NULL, ("id",))])
