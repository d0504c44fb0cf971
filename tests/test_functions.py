"""Scalar functions: T-SQL semantics on edge values."""

import datetime as dt
import hashlib
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata import functions as X


def one(spark, col, value=None, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def us_week_py(d: dt.date) -> int:
    """DATEPART(week) with DATEFIRST 7: week 1 holds Jan 1, weeks start on Sunday."""
    jan1 = dt.date(d.year, 1, 1)
    offset = (jan1.weekday() + 1) % 7  # days since the Sunday on/before Jan 1
    return (d.timetuple().tm_yday - 1 + offset) // 7 + 1


def test_us_week_against_definition(spark):
    start = dt.date(1990, 1, 1)
    days = [start + dt.timedelta(days=i) for i in range(0, 365 * 40, 3)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = {r["d"]: r["w"] for r in df.select("d", X.us_week(F.col("d")).alias("w")).collect()}
    assert all(got[d] == us_week_py(d) for d in days)


def test_us_week_sunday_and_saturday_new_year(spark):
    # 2023-01-01 is a Sunday, 2022-01-01 a Saturday
    rows = [(dt.date(2023, 1, 1),), (dt.date(2023, 1, 7),), (dt.date(2023, 1, 8),),
            (dt.date(2022, 1, 1),), (dt.date(2022, 1, 2),)]
    df = spark.createDataFrame(rows, "d date").select(X.us_week(F.col("d")).alias("w"))
    assert [r.w for r in df.collect()] == [1, 1, 2, 1, 2]


def test_month_boundaries_counts_boundaries_not_months(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 28), dt.date(2024, 3, 1)), (dt.date(2024, 1, 31), dt.date(2024, 1, 1)),
                                (dt.date(2023, 12, 31), dt.date(2024, 1, 1))], "a date, b date")
    assert [r.m for r in df.select(X.month_boundaries("a", "b").alias("m")).collect()] == [1, 0, 1]


def test_parse_money_variants(spark):
    vals = ["$ 1.234,56", "$1.234", "'1.000,5'", "1234.56", "abc", "", None, "$ 12.345.678,90"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r.m for r in df.select(X.parse_money("v").alias("m")).collect()]
    assert got == [Decimal("1234.56"), Decimal("1234.00"), Decimal("1000.50"), Decimal("123456.00"), None, None, None,
                   Decimal("12345678.90")]


def test_parse_amount_or_zero_blank_null_invalid(spark):
    df = spark.createDataFrame([("4.500,00",), ("",), (None,), ("x",)], "v string")
    got = [r.m for r in df.select(X.parse_amount_or_zero("v").alias("m")).collect()]
    assert got == [Decimal("4500.00"), Decimal("0.00"), Decimal("0.00"), None]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=9_999_999_999), min_size=1, max_size=20))
def test_money_text_round_trip(spark, cents):
    df = spark.createDataFrame([(Decimal(c) / 100,) for c in cents], "a decimal(12,2)")
    out = df.select("a", X.parse_money(X.money_text(F.col("a"))).alias("b")).collect()
    assert all(r.a == r.b for r in out)


def test_parse_dmy(spark):
    df = spark.createDataFrame([("05/02/1996",), ("5/2/1996",), ("30/02/1996",), ("29/02/2024",), ("x",)], "v string")
    assert [r.d for r in df.select(X.parse_dmy("v").alias("d")).collect()] == [
        dt.date(1996, 2, 5), dt.date(1996, 2, 5), None, dt.date(2024, 2, 29), None]


def test_due_date_clamps_to_month_end(spark):
    df = spark.createDataFrame([(2024, 2, 31), (2023, 2, 29), (2024, 4, 31), (2024, 5, 10)], "y int, m int, d int")
    got = [r.x for r in df.select(X.due_date(F.col("y"), F.col("m"), F.col("d")).alias("x")).collect()]
    assert got == [dt.date(2024, 2, 29), dt.date(2023, 2, 28), dt.date(2024, 4, 30), dt.date(2024, 5, 10)]


def test_spanish_months(spark):
    df = spark.createDataFrame([("abril ",), ("SEPTIEMBRE",), ("  enero",), ("abr",), (None,)], "v string")
    assert [r.n for r in df.select(X.es_month_number("v").alias("n")).collect()] == [4, 9, 1, None, None]
    df2 = spark.range(0, 14).select(X.es_month_title(F.col("id")).alias("t"))
    titles = [r.t for r in df2.collect()]
    assert titles[1] == "Enero" and titles[12] == "Diciembre" and titles[0] is None and titles[13] is None


def test_es_ar_format(spark):
    df = spark.createDataFrame([(Decimal("1234567.89"),), (Decimal("-0.50"),), (Decimal("5"),)], "a decimal(12,2)")
    assert [r.t for r in df.select(X.format_es_ar("a").alias("t")).collect()] == ["1.234.567,89", "-0,50", "5,00"]


def test_text_semantics(spark):
    assert one(spark, X.tsql_len(F.col("v")), "ab  ") == 2
    assert one(spark, X.file_name(F.col("v")), "C:\\datos\\sub/archivo.csv") == "archivo.csv"
    assert one(spark, F.concat(F.col("v"), F.lit(" "), F.lit(None).cast("string")), "x") is None
    assert one(spark, X.strip_crlf(F.col("v")), "a\r\nb") == "ab"
    assert one(spark, X.blank_to_null(F.col("v")), "   ") is None
    assert one(spark, X.xml_escape(F.col("v")), "a<b & 'c'") == "a&lt;b &amp; &apos;c&apos;"


def test_sha256_varchar_and_nvarchar(spark):
    v = "cliente1@correo.com"
    assert one(spark, X.sha256_hex(F.col("v")), v) == hashlib.sha256(v.encode("utf-8")).hexdigest()
    assert one(spark, X.sha256_hex_utf16(F.col("v")), v) == hashlib.sha256(v.encode("utf-16-le")).hexdigest()


def test_clamp_and_exact_cents(spark):
    df = spark.createDataFrame([(Decimal("123456789.12"),), (Decimal("-123456789.12"),), (Decimal("5.55"),)],
                               "a decimal(18,2)")
    got = [r.c for r in df.select(X.clamp("a").alias("c")).collect()]
    assert got == [Decimal("99999999.99"), Decimal("-99999999.99"), Decimal("5.55")]
    df2 = spark.createDataFrame([(Decimal("12.345"),)], "a decimal(12,3)")
    assert df2.select(X.money("a").alias("m")).first().m == Decimal("12.35")  # half-up like T-SQL CAST
