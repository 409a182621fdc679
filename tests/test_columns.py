"""Column idioms on edge rows."""

import pytest
from pyspark.sql import functions as F

from revmart.functions import columns as c


def evaluate(spark, column, schema, rows):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def texts(spark, column, *values):
    return evaluate(spark, column, "x string", [(v,) for v in values])


def test_truthy(spark):
    values = ["true", " Yes ", "T", "1", "y", "n", "", None, "1.0", "\ttrue", "on"]
    assert texts(spark, c.truthy("x"), *values) == [True] * 5 + [False] * 6


def test_truthy_of_native_boolean(spark):
    assert evaluate(spark, c.truthy("x"), "x boolean", [(True,), (False,), (None,)]) == [True, False, False]


def test_blank_to_null_trims_spaces_only(spark):
    assert texts(spark, c.blank_to_null("x"), "  a b ", "   ", "", None, "\t") == ["a b", None, None, None, "\t"]


def test_proper_case(spark):
    assert texts(spark, c.proper_case("x"), " mary-jane O'BRIEN ", "  ", None) == ["Mary-jane O'brien", None, None]


def test_email_in_domain(spark):
    values = ["a@Corp.Example", "a@corp.example.org", "nodomain", "", None, "a@x@corp.example"]
    assert texts(spark, c.email_in_domain("x", "corp.example"), *values) == [True, False, False, False, None, False]


def test_fallback_key(spark):
    key = c.fallback_key("k", {"NO_A": F.col("a"), "NO_B": F.col("b")})
    rows = [(" R1 ", "a", "b"), ("  ", "a", None), (None, None, None), (None, "", "b")]
    assert evaluate(spark, key, "k string, a string, b string", rows) == ["R1", "a|NO_B", "NO_A|NO_B", "|b"]


def test_surrogate_key_separates_null_from_blank(spark):
    keys = evaluate(spark, c.surrogate_key("a", "b"), "a string, b int", [("x", 1), ("x", None), ("x", 1)])
    assert keys[0] == keys[2] != keys[1]
    assert all(len(k) == 32 for k in keys)


@pytest.mark.parametrize(("dtype", "tiny"), [("decimal(33,15)", True), ("decimal(30,4)", False)])
def test_positive_amount_depends_on_precision(spark, dtype, tiny):
    values = ["0.00001", "0", "", "x", None, "12.5", "-1", "1" * 40]
    expected = [tiny, False, False, False, False, True, False, False]
    assert texts(spark, c.positive_amount("x", dtype), *values) == expected


def test_contains_any(spark):
    values = ["Duplicate opportunity found", "unqualified", None, "fine"]
    words = ("DUPLICATE OPPORTUNITY", "UNQUALIFIED")
    assert texts(spark, c.contains_any("x", words), *values) == [True, True, False, False]


def test_timestamps_strict_and_lenient(spark):
    assert texts(spark, c.timestamp_of("x", lenient=True).cast("string"), "2024-01-02", "n/a", None) == [
        "2024-01-02 00:00:00",
        None,
        None,
    ]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        texts(spark, c.timestamp_of("x"), "n/a")


def test_relabel_first_match_and_default(spark):
    rule = c.relabel(F.col("x"), {("a", "b"): "AB", ("c",): "C"}, F.col("x"))
    assert texts(spark, rule, "a", "b", "c", "d", None) == ["AB", "AB", "C", "d", None]
