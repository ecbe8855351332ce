"""Column functions: the semantics table."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from layercake.functions import (
    fallback,
    lenient_date,
    map_codes,
    missing_flag,
    null_if_future,
    parse_int_date,
    repair_amount,
    round_to_long,
    split_composite_key,
    strip_chars,
    strip_prefix,
    title_case,
)


def one_col(spark, values, dtype="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")


def apply(spark, values, fn, dtype="string"):
    df = one_col(spark, values, dtype)
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_op1_title_case(spark):
    values = ["  joHN  ", "mary   ann", "", "   ", None, "\t", "o'neil MARY-ann", "élan vital", "a\tb", "x "]
    assert apply(spark, values, title_case) == [
        "John", "Mary Ann", None, None, None, " ", "O'neil Mary-ann", "Élan Vital", "A B", "X",
    ]


def test_op1_title_case_beyond_ascii(spark):
    values = ["ΝΙΚΟΣ ΣΑΣ", "ßeta", "ﬁNN", "ǆURA", "ŉx", "İZMİR", "\u00a0ÉTÉ\u3000", "ᾳδω", "ñU éÈ"]
    assert apply(spark, values, title_case) == [
        "Νικοσ Σασ", "ẞeta", "ﬁnn", "Ǆura", "ŉx", "İzmir", "Été", "ᾼδω", "Ñu Éè",
    ]


def test_op10_null_if_future_builds_the_date_once(spark):
    df = one_col(spark, ["2020-01-01", "2020-01-02", None, "x", "9999-12-31"], "string")
    out = df.orderBy("i").select(null_if_future("v", "2020-01-01").alias("d"))
    assert [r.d and str(r.d) for r in out.collect()] == ["2020-01-01", None, None, None, None]
    both = [f(F.col("v")) for f in (lenient_date, lambda c: null_if_future(c, "2020-01-01"))]
    once, cut = [df.select(c)._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") for c in both]
    assert cut <= once


def test_zero_padded_keeps_long_numbers(spark):
    from layercake.plans.standins import zero_padded

    assert [r[0] for r in spark.createDataFrame([(7,), (1234567,)], "v long").orderBy("v").select(zero_padded(F.col("v"), 5)).collect()] == ["00007", "1234567"]


def test_zero_padded_without_formatter(spark):
    """Whole numbers are padded without Java's formatter, and all as it pads them."""
    from layercake.plans.standins import zero_padded

    values = [0, 7, 99999, 100000, 2**63 - 1, -1, -12345, -(2**63), None]
    padded = spark.createDataFrame([(v,) for v in values], "v long").select(zero_padded(F.col("v"), 5).alias("p"))
    want = ["00000", "00007", "99999", "100000", "9223372036854775807", "-0001", "-12345", "-9223372036854775808", " null"]
    assert [r.p for r in padded.collect()] == want
    ids = spark.range(3).select(zero_padded(F.col("id"), 5).alias("p"))
    assert "lpad(" in ids._jdf.queryExecution().optimizedPlan().toString()


def test_op2_map_codes_exact_and_default(spark):
    m = {"S": "Single", "M": "Married"}
    assert apply(spark, ["S", "M", "s", None, "X"], lambda c: map_codes(c, m, "Unknown")) == [
        "Single", "Married", "Unknown", "Unknown", "Unknown",
    ]


def test_op2_map_codes_normalized_groups(spark):
    m = {"F": "Female", "FEMALE": "Female", "M": "Male", "MALE": "Male"}
    out = apply(spark, ["F", "Female", "FEMALE ", " m", "Male", "", "X", None],
                lambda c: map_codes(c, m, "n/a", normalize="upper_trim"))
    assert out == ["Female", "Female", "Female", "Male", "Male", "n/a", "n/a", "n/a"]


def test_op2_country_rule(spark):
    m = {"DE": "Germany", "US": "United States", "USA": "United States", "": "n/a"}
    out = apply(spark, ["DE", "US", "USA ", "", "  ", None, " France ", "de"],
                lambda c: map_codes(c, m, F.trim(c), normalize="trim", null_as="n/a"))
    assert out == ["Germany", "United States", "United States", "n/a", "n/a", "n/a", "France", "de"]


def test_op6_split_composite_key(spark):
    df = one_col(spark, ["AC-HE-HL-U509-R", "CO-RF-FR-R92B-58", "AB", None])
    head, tail = split_composite_key("v", 5, "-", "_")
    assert [(r[0], r[1]) for r in df.orderBy("i").select(head, tail).collect()] == [
        ("AC_HE", "HL-U509-R"), ("CO_RF", "FR-R92B-58"), ("AB", ""), (None, None),
    ]


def test_op7_parse_int_date(spark):
    values = [20101229, 0, None, 20101, 201012290, 20101329, 20100229, 20240229, -2010122]
    out = apply(spark, values, parse_int_date, "bigint")
    assert out == [dt.date(2010, 12, 29), None, None, None, None, None, None, dt.date(2024, 2, 29), None]


def test_op7_every_month_and_day_number(spark):
    values = [y * 10000 + m * 100 + d for y in (1000, 1900, 2000, 2023, 2024, 9999) for m in (*range(14), 99) for d in (*range(33), 60, 99)]
    values += [9_999_999, 100_000_000, 2**31 + 20101229, 2**62, -(2**62)]

    def day(n):
        try:
            return dt.datetime.strptime(str(n), "%Y%m%d").date() if len(str(n)) == 8 else None
        except ValueError:
            return None

    assert apply(spark, values, parse_int_date, "bigint") == [day(n) for n in values]


def test_op8_repair_truth_table(spark):
    # (sales, qty, price) -> (sales', price')
    table = [
        ((10, 2, 5), (10, 5.0)), ((None, 2, 5), (10, 5.0)), ((0, 2, 5), (10, 5.0)),
        ((-10, 2, 5), (10, 5.0)), ((11, 2, 5), (10, 5.0)), ((10, 2, None), (10, 5.0)),
        ((None, 2, None), (None, None)), ((10, 2, 0), (0, 5.0)), ((10, 2, -5), (10, 5.0)),
        ((10, 0, 5), (0, 5.0)), ((10, 0, None), (10, None)), ((10, None, 5), (10, 5.0)),
        ((None, 2, -5), (10, None)), ((-10, 2, None), (None, -5.0)),
    ]
    df = spark.createDataFrame(
        [(i, *inp) for i, (inp, _) in enumerate(table)], "i int, s bigint, q bigint, p bigint"
    )
    sales, price = repair_amount("s", "q", "p")
    got = [(r[0], r[1]) for r in df.orderBy("i").select(sales, price).collect()]
    assert got == [out for _, out in table]
    assert dict(df.select(sales.alias("a"), price.alias("b")).dtypes) == {"a": "bigint", "b": "double"}


def test_op9_strip_prefix(spark):
    assert apply(spark, ["NASAW00011000", "AW00011000", "nasAW1", "NAS", None],
                 lambda c: strip_prefix(c, "NAS")) == ["AW00011000", "AW00011000", "nasAW1", "", None]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("2025-01-05", dt.date(2025, 1, 5)),
        ("2025/01/05", dt.date(2025, 1, 5)),
        ("2025 01 05", dt.date(2025, 1, 5)),
        ("2025-1-5", dt.date(2025, 1, 5)),
        (" 2025-01-05", dt.date(2025, 1, 5)),
        ("2025-01-05 10:30:00", dt.date(2025, 1, 5)),
        ("2025-01-05T08:15", dt.date(2025, 1, 5)),
        ("2025", None),
        ("2025-01", None),
        ("2025-01-05T", None),
        ("2025-01-05 10", None),
        ("2025-01-05 xx", None),
        ("2025-02-30", None),
        ("garbage", None),
        (None, None),
        ("2025-01-05 24:00", dt.date(2025, 1, 5)),
        ("2025-01-05 25:00", None),
        ("2025-01-05 23:60", None),
        ("2025-01-05 10:30:60", None),
        ("2025-01-05  1:5 PM", dt.date(2025, 1, 5)),
        ("99-1-1", dt.date(99, 1, 1)),
        ("4-02-29", dt.date(4, 2, 29)),
        ("100-02-29", None),
        ("0-01-01", None),
    ],
)
def test_s25_lenient_date(spark, text, expected):
    assert apply(spark, [text], lenient_date) == [expected]


def test_op10_null_if_future(spark):
    out = apply(spark, ["2010-01-02", "2010-01-01", "1999-12-31", "bad"],
                lambda c: null_if_future(c, "2010-01-01"))
    assert out == [None, dt.date(2010, 1, 1), dt.date(1999, 12, 31), None]


def test_op11_strip_chars(spark):
    assert apply(spark, ["AW-000-11", "--", None], lambda c: strip_chars(c, "-")) == ["AW00011", "", None]


def test_op12_missing_flag(spark):
    df = spark.createDataFrame([("a", "b"), (None, "b"), ("a", None), (None, None)], "x string, y string")
    assert [r[0] for r in df.select(missing_flag("x", "y")).collect()] == [False, True, True, True]


def test_op13_fallback_literal_and_intended(spark):
    df = spark.createDataFrame(
        [("Male", "Female"), ("n/a", "Female"), ("n/a", None), ("Unknown", "Male"), (None, "Male")],
        "crm string, erp string",
    )
    lit = [r[0] for r in df.select(fallback("crm", "erp")).collect()]
    intended = [r[0] for r in df.select(fallback("crm", "erp", unknown=("n/a", "Unknown"))).collect()]
    assert lit == ["Male", "Female", "n/a", "Unknown", "Male"]
    assert intended == ["Male", "Female", "n/a", "Male", "Male"]


def test_s22_round_half_even(spark):
    assert apply(spark, [2.5, 1.5, -1.5, 0.4, None], round_to_long, "double") == [2, 2, -2, 0, None]
