"""Coercions against expected outcomes and against Python's own rules."""

from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from sheetloom.functions import coerce
from sheetloom.functions.text import double_text, quoted, ratio_text, strict_double


def outcomes(spark, fn, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", fn(F.col("t")).alias("r")).orderBy("i").collect()
    return [(r.r.value, r.r.rule) for r in rows]


def test_coerce_str(spark):
    texts = [None, "", "  ", "NULL", " n/a ", "x", " x ", " x\t", "-", "--", "None", "?"]
    assert outcomes(spark, coerce.coerce_str, texts) == [
        (None, None), (None, None), (None, None), (None, "null_sentinel"), (None, "null_sentinel"),
        ("x", None), ("x", "whitespace"), ("x", "whitespace"), (None, "null_sentinel"),
        (None, "null_sentinel"), (None, "null_sentinel"), (None, "null_sentinel")]


def test_coerce_appearance(spark):
    texts = ["White Powder", "white powder", " White Powder ", "WHITE POWDER", "Off-white wet cake",
             "McDonald  cake", "NULL", "", "30% solution"]
    assert outcomes(spark, coerce.coerce_appearance, texts) == [
        ("White Powder", None), ("White Powder", "case_variant"), ("White Powder", "whitespace"),
        ("White Powder", "case_variant"), ("Off-white Wet Cake", "case_variant"),
        ("McDonald Cake", "case_variant"), (None, "null_sentinel"), (None, None),
        ("30% Solution", "case_variant")]


def test_coerce_pass_fail(spark):
    texts = ["OK", " ok ", "Out of Spec", "oos", "maybe", "NULL", "", None, "Y", "n"]
    assert outcomes(spark, coerce.coerce_pass_fail, texts) == [
        (True, None), (True, "whitespace"), (False, None), (False, None),
        (None, "unrecognized_token"), (None, "null_sentinel"), (None, None), (None, None),
        (True, None), (False, None)]


DATE_TEXTS = {
    "2026-3-4": (date(2026, 3, 4), None), "2026/03/04": (date(2026, 3, 4), None),
    "04/03/2026": (date(2026, 3, 4), "non_standard_date"),
    "12/31/2026": (date(2026, 12, 31), "non_standard_date"),
    "12-31-2026": (date(2026, 12, 31), "non_standard_date"),
    "Mar   4\t2026": (date(2026, 3, 4), "non_standard_date"),
    "MARCH 4 2026": (date(2026, 3, 4), "non_standard_date"),
    "4 may 2026": (date(2026, 5, 4), "non_standard_date"),
    "4-Mar-2026": (date(2026, 3, 4), "non_standard_date"),
    "04-march-2026": (date(2026, 3, 4), "non_standard_date"),
    "30/02/2026": (None, "malformed_date"), "29/02/2024": (date(2024, 2, 29), "non_standard_date"),
    "2026-03-04 00:00:00": (None, "malformed_date"), "0000-01-01": (None, "malformed_date"),
    "005/03/2026": (None, "malformed_date"), "4/3/26": (None, "malformed_date"),
    "Sept 4 2026": (None, "malformed_date"), "?": (None, "null_sentinel"), " ": (None, None),
}


def test_coerce_date(spark):
    assert outcomes(spark, coerce.coerce_date, list(DATE_TEXTS)) == list(DATE_TEXTS.values())


TIME_TEXTS = {
    "08:05:09": "08:05:09", "8:5": "08:05:00", "8:05 pm": "20:05:00", "12:00 AM": "00:00:00",
    "8:05:07  PM": "20:05:07", "27:00.0": None, "24:00": None, "8:05PM": None, "0:05 PM": None,
    "8.30": None, "??:??": None, "NULL": None, "8:60": None,
}


def test_coerce_time(spark):
    expected = [(v, None if v else "malformed_time") for v in TIME_TEXTS.values()]
    assert outcomes(spark, coerce.coerce_time, list(TIME_TEXTS)) == expected
    assert outcomes(spark, coerce.coerce_time, ["", None]) == [(None, None), (None, None)]


FLOAT_TEXTS = ["1.5", " 1.5", "-0.1", "1_000", "1__0", "1.5d", "0x1p3", "1e3", ".5", "5.", "abc",
               "NULL", "-", "", None, "inf", "-inf", "+2", "1,5", "-0.0", "1e400", "infinity"]


def test_coerce_float_follows_python(spark):
    def model(text):
        if text is None or not text.strip():
            return None, None
        s = text.strip()
        if s.lower() in coerce.NULL_SENTINELS:
            return None, "null_sentinel"
        try:
            value = float(s)
        except ValueError:
            return None, "non_numeric"
        if value < 0:
            return None, "negative_value"
        return value, "whitespace" if s != text else None

    assert outcomes(spark, coerce.coerce_float, FLOAT_TEXTS) == [model(t) for t in FLOAT_TEXTS]
    (value, rule), = outcomes(spark, coerce.coerce_float, ["nan"])
    assert value != value and rule is None


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("0123456789._+-eE nainf\t", max_size=8), min_size=20, max_size=60))
def test_strict_double_follows_float(spark, texts):
    def model(text):
        try:
            return float(text)
        except ValueError:
            return None

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.v for r in df.select("i", strict_double(F.col("t")).alias("v")).orderBy("i").collect()]
    assert [str(v) for v in got] == [str(model(t)) for t in texts]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.decimals("-1e12", "1e12", places=6).map(float), min_size=30, max_size=80))
def test_double_text_follows_str(spark, values):
    values = [*values, 0.0, 1e-4, 1.5e-5, 1e7, 123456789.5, 1e16, 2.5e22, float("inf"), -1e-7]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r.t for r in df.select("i", double_text(F.col("v")).alias("t")).orderBy("i").collect()]
    assert [float(t) for t in got] == values
    # JDK 17 may print one digit more than the shortest form
    assert all(t == str(v) or len(t) > len(str(v)) for t, v in zip(got, values))


def test_ratio_text_follows_format(spark):
    pairs = [(a, n) for n in range(1, 81) for a in range(1, 50)]
    df = spark.createDataFrame(pairs, "a int, n int")
    got = df.select("a", "n", ratio_text(F.col("a"), F.col("n")).alias("t")).collect()
    assert [(r.a, r.n, r.t) for r in got if r.t != f"{r.a / r.n:.2f}"] == []


def test_quoted_follows_repr(spark):
    texts = ["plain", "it's", 'say "x"', "it's \"x\"", "tab\tnew\nline", "back\\slash"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.q for r in df.select("i", quoted(F.col("t")).alias("q")).orderBy("i").collect()]
    assert got == [repr(t) for t in texts]


@pytest.mark.parametrize("value,low,high,expected", [
    (None, 1.0, 2.0, None), (1.0, 1.0, None, True), (0.9, 1.0, None, False), (2.0, None, 2.0, True),
    (2.1, None, 2.0, False), (1.0, None, None, None), (float("nan"), 1.0, 2.0, True),
    (float("nan"), None, None, None)])
def test_evaluate_pass(spark, value, low, high, expected):
    df = spark.createDataFrame([(value, low, high)], "v double, lo double, hi double")
    got = df.select(coerce.evaluate_pass(F.col("v"), F.col("lo"), F.col("hi")).alias("p")).first().p
    assert got is expected


def test_unit_limits_and_serialization(spark):
    df = spark.createDataFrame(
        [("%", "w/w", "Min.", 1.0, True), (None, "w/w", None, 2.0, None), ("%", None, "Max", 3.0, False),
         (None, None, "minimum", None, True)], "u string, s string, b string, v double, f boolean")
    limits = coerce.spec_limits(F.col("b"), F.col("v"), F.col("v") / 2)
    rows = df.select(coerce.compose_unit(F.col("u"), F.col("s")).alias("unit"),
                     *[c.alias(n) for n, c in limits.items()],
                     coerce.serialize(F.col("f"), "boolean").alias("f"),
                     coerce.serialize(F.col("v"), "double").alias("v")).collect()
    assert [r.unit for r in rows] == ["%/w/w", "/w/w", "%", None]
    assert [(r.spec_min, r.spec_max) for r in rows] == [(1.0, None), (None, 2.0), (None, 3.0), (None, None)]
    assert [(r.spec_internal_min, r.spec_internal_max) for r in rows][:2] == [(0.5, None), (None, 1.0)]
    assert [(r.f, r.v) for r in rows] == [("true", "1.0"), ("", "2.0"), ("false", "3.0"), ("true", "")]


def test_native_cells(spark):
    from grids import cell
    from sheetloom.contracts import CELL
    values = [datetime(2026, 3, 4, 8, 30), datetime(2026, 3, 4, 8, 30, 0, 500000), True, -1, 2, "x"]
    df = spark.createDataFrame([(i, cell(v)) for i, v in enumerate(values)],
                               f"i int, c {CELL.simpleString()}")
    rows = df.orderBy("i").select(
        coerce.coerce_date_cell(F.col("c")).alias("d"), coerce.coerce_time_cell(F.col("c")).alias("t"),
        coerce.coerce_float_cell(F.col("c")).alias("f")).collect()
    assert rows[0].d.value == date(2026, 3, 4) and rows[0].t.value == "08:30:00"
    assert rows[1].t.value == "08:30:00.500000"
    assert tuple(rows[2].f) == (None, "wrong_type")
    assert tuple(rows[3].f) == (None, "negative_value") and tuple(rows[4].f) == (2.0, None)
    assert tuple(rows[5].f) == (None, "non_numeric") and rows[3].d.rule == "malformed_date"
