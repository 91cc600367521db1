from datetime import date

from pyspark.sql import functions as F

from leadtide.functions import scores
from leadtide.functions.dates import week_start
from leadtide.functions.text import (
    WHITESPACE, normalise, percent_text, posting_key, posting_text, preview,
)
from leadtide.functions.titles import seniority, seniority_narrow


def values(spark, rows, column, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_normalise_strips_all_whitespace(spark):
    texts = ["  ACME\t", "acme", "  Été　", "a\tb", "", " \t ", None, "Ünï ", "!x!"]
    assert values(spark, texts, normalise("x")) == [
        "acme", "acme", "été", "a\tb", "", "", None, "ünï", "!x!",
    ]
    padded = [f"{c}X{c}" for c in WHITESPACE]
    assert set(values(spark, padded, normalise("x"))) == {"x"}
    assert len(WHITESPACE) == 25 and all(c.isspace() for c in WHITESPACE)


def test_round_half_up_on_decimals(spark):
    got = values(spark, [1.005, 10.075, 0.285, -57.142857], scores.round_to(F.col("x")), "double")
    assert got == [1.01, 10.08, 0.29, -57.14]


def test_week_starts_on_monday(spark):
    days = [date(2024, 1, 7), date(2024, 1, 8), None]
    assert values(spark, days, week_start("x"), "date") == [date(2024, 1, 1), date(2024, 1, 8), None]


def test_seniority_classes(spark):
    titles = ["Sr. Engineer", "Senior Lead", "Principal X", "JR. dev", "Engineer", "Junior Lead"]
    assert values(spark, titles, seniority(F.col("x"))) == [
        "Senior", "Senior", "Lead", "Junior", "Mid-Level", "Junior",
    ]
    assert values(spark, titles, seniority_narrow(F.col("x"))) == [
        "Mid-Level", "Senior", "Mid-Level", "Mid-Level", "Mid-Level", "Junior",
    ]


def test_bands(spark):
    got = values(spark, [49.99, 50.0, 79.99, 80.0], scores.band(F.col("x")), "double")
    assert got == ["cold", "warm", "warm", "hot"]


def test_histogram_edges(spark):
    got = values(spark, [-3.0, 0.0, 4.99, 5.0, 99.0, 100.0], scores.histogram_bin(F.col("x")), "double")
    assert got == [0, 0, 0, 1, 19, 19]


def test_text_helpers(spark):
    assert values(spark, ["a" * 31, "b" * 30], preview("x")) == ["a" * 30 + "...", "b" * 30]
    assert values(spark, [12.345], percent_text(F.col("x"), 1), "double") == ["12.3%"]
    df = spark.createDataFrame(
        [("Acme", "Dev", date(2024, 1, 3), 7, ["A", "B", "C", "D"])],
        "c string, t string, d date, i int, techs array<string>",
    )
    import hashlib

    want = hashlib.sha256(b"Acme_Dev_2024-01-03_7").hexdigest()[:16]
    assert df.select(posting_key("c", "t", "d", "i")).first()[0] == want
    text = df.select(posting_text("c", "t", "techs", ["be kind"], ["tea"], "Oslo")).first()[0]
    assert text.split("\n\n")[1].split("\n")[0] == "Requirements:" and "- be kind" in text
    assert text.endswith("Benefits:\n- tea\n\nLocation: Oslo")


def test_rounding_is_half_up_once(spark):
    from decimal import ROUND_HALF_UP, Decimal

    from leadtide.functions.scores import round_to

    values = [0.0049999996, 0.005, 0.0050000004, 1.005, 10.075, 0.285, -57.134999999, -57.135, 3e12 + 0.125, 1e14 + 0.5,
              1e18, -1e300, 0.0, 5e-324, 123456.785]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for v, r in df.select("v", round_to(df.v)).collect():
        want = float(Decimal(repr(v)).quantize(Decimal("0.01"), ROUND_HALF_UP)) if abs(v) < 1e15 else v
        assert r == want, v
