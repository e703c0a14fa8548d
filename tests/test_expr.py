import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from statforge.functions import expr as E


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")


def apply(spark, values, build, kind="string"):
    df = column(spark, values, kind)
    return [r[0] for r in df.select("i", build(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


def test_text_keeps_blanks_and_defaults_only_nulls(spark):
    assert apply(spark, [None, "", "  x ", "   "], lambda c: E.text(c, "Unknown")) == ["Unknown", "", "x", ""]
    assert apply(spark, [None, " left"], lambda c: E.text(c, "UNKNOWN", upper=True)) == ["UNKNOWN", "LEFT"]


def test_int_or_zero(spark):
    cases = {
        "3": 3,
        "3.7": 3,
        "-3.7": -3,
        "abc": 0,
        None: 0,
        "3000000000": 0,
        " 4 ": 4,
        "1e3": 0,
        "3.x": 0,
        "3.1.2": 0,
        "": 0,
        "2147483647": 2147483647,
        "+5": 5,
    }
    assert apply(spark, list(cases), E.int_or_zero) == list(cases.values())


def test_whole_parts_beyond_32_bits_never_reach_the_cast(spark):
    """Each would raise inside the cast; borderline ones, which only the cast can judge, still get there and are NULL."""
    beyond = ["3000000000", "-2200000000", " 10000000000.5 ", "+00099999999999"]
    border = ["2147483648", "-2147483649", "2199999999", "2147483647.99999999999999"]
    inside = {"-2147483648": -2147483648, "-2147483648.9": -2147483648, "0002147483647.5": 2147483647, "1999999999": 1999999999, "0": 0, "00000000000000": 0, "000000000000012.": 12, "-0.9": 0, " 25.5\n": 25}
    values = [*beyond, *border, *inside]
    reached = dict(zip(values, apply(spark, values, lambda c: c.rlike(E._DIGITS))))
    assert [v for v in values if not reached[v]] == beyond
    assert apply(spark, values, E.lenient_int) == [None] * (len(beyond) + len(border)) + list(inside.values())


def test_the_number_pattern_refuses_nothing_readable(spark):
    draw = random.Random(7)
    old = re.compile(r"^\s*[+-]?\d+(\.\d*)?\s*$")
    values = ["".join(draw.choice("0012.9+- x\t") for _ in range(draw.randint(0, 13))) for _ in range(3000)]
    values += [f"{'0' * draw.randint(0, 3)}{draw.randint(0, 10 ** draw.randint(1, 12))}{draw.choice(['', '.', '.5', ' ', 'x'])}" for _ in range(1000)]

    def expected(value):
        whole = int(float(value)) if old.match(value) else None
        return whole if whole is not None and -(2**31) <= whole < 2**31 else None

    assert apply(spark, values, E.lenient_int) == [expected(v) for v in values]


def test_int_of_numeric_columns_truncates(spark):
    schema = column(spark, [3.7], "double").schema
    out = apply(spark, [3.7, -3.7, 1e10, None], lambda c: E.int_or_zero(c, schema["x"].dataType), "double")
    assert out == [3, -3, 0, 0]


def test_lenient_double(spark):
    assert apply(spark, ["1.5", "free", None, "1e3", " 2", "-.5", "-"], E.lenient_double) == [1.5, None, None, 1000.0, 2.0, -0.5, None]


def test_lenient_date(spark):
    values = ["2020-02-29", "2020-13-01", "2019-02-29", "x", None, "2020-1-1", " 2020-01-01"]
    assert apply(spark, values, E.lenient_date) == [dt.date(2020, 2, 29), None, None, None, None, None, None]


def test_iso_and_zone(spark):
    out = apply(spark, ["2024-01-01T20:00:00Z", "bad", None], lambda c: E.in_zone(E.iso_utc(c), "Asia/Ho_Chi_Minh"))
    assert out == [dt.datetime(2024, 1, 2, 3), None, None]


@pytest.mark.parametrize(
    ("value", "cm"),
    [("0", None), (None, None), ("1.85", 185), ("1.15", 114), ("185", 185), ("9.99", 999), ("10", 10), ("tall", None)],
)
def test_height(spark, value, cm):
    assert apply(spark, [value], E.height_cm) == [cm]


def test_height_nearest(spark):
    assert apply(spark, ["1.15"], lambda c: E.height_cm(c, nearest=True)) == [115]


@pytest.mark.parametrize(
    ("total", "minutes", "rate"),
    [(1, 0, None), (1, 89, None), (1, 90, 1.0), (1, 180, 0.5), (400, 90, 3.0), (1, 271, 0.3321), (0, 90, 0.0)],
)
def test_per_90(spark, total, minutes, rate):
    df = spark.createDataFrame([(total, minutes)], "t bigint, m bigint")
    assert df.select(E.per_90("t", "m")).first()[0] == rate


def test_pct_change_and_direction(spark):
    df = spark.createDataFrame([(5, None), (5, 0), (6, 4), (4, 4), (2, 4)], "v int, p int")
    got = df.select(E.pct_change("v", "p"), E.direction(F.col("v") - F.col("p"))).collect()
    assert [tuple(r) for r in got] == [
        (0.0, "STABLE"),
        (0.0, "INCREASING"),
        (50.0, "INCREASING"),
        (0.0, "STABLE"),
        (-50.0, "DECREASING"),
    ]


def test_labels(spark):
    levels = lambda c: E.label_by_floor(c, ((5, "HIGH"), (2, "MEDIUM")), "LOW")
    assert apply(spark, [2.0, 2.01, 5.0, 5.01, 10.0, None], levels, "double") == ["LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "LOW"]


def test_ratio_and_clamp(spark):
    df = spark.createDataFrame([(7, 3), (7, 0), (None, 3)], "a int, b int")
    assert [r[0] for r in df.select(E.ratio("a", "b", 2)).collect()] == [2.33, None, None]
    assert apply(spark, [-5.0, 50.0, 200.0], lambda c: E.clamp(c, 0.0, 100.0), "double") == [0.0, 50.0, 100.0]


def test_scoreline_and_leader(spark):
    df = spark.createDataFrame([("A", 1, None, "B"), ("A", 1, 2, None)], "h string, hg int, ag int, a string")
    assert [r[0] for r in df.select(E.scoreline("h", "hg", "ag", "a")).collect()] == ["A 1-0 B", None]
    df = spark.createDataFrame([(2, 1), (1, 2), (1, 1), (None, 2)], "h int, a int")
    assert [r[0] for r in df.select(E.leader("h", "a", "H", "A", "DRAW")).collect()] == ["H", "A", "DRAW", "DRAW"]


def test_half_up(spark):
    assert apply(spark, [1.005, 2.345, -0.125], lambda c: E.half_up(c, 2), "double") == [1.01, 2.35, -0.13]


def test_age_is_calendar_difference(spark):
    df = spark.createDataFrame([(dt.date(2000, 12, 31),), (None,)], "d date")
    assert [r[0] for r in df.select(E.age_years("d", "2024-01-01")).collect()] == [24, None]
