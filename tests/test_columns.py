from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from revrecon.functions import dates, labels, money, names

OFFICES = ((("CAMPUS", "SOUTH"), "South"), (("MAIN",), "North"))


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("text", "plain", "zero", "signed", "ledger"),
    [
        ("$1,234.56", "1234.56", "1234.56", "1234.56", "1234.56"),
        (" 1,234.56 ", "1234.56", "1234.56", "1234.56", "1234.56"),
        ("(5.00)", None, "5.00", "-5.00", "0.00"),
        ("-7", "-7.00", "-7.00", "-7.00", "-7.00"),
        ("$ 12", "12.00", "12.00", "12.00", "12.00"),
        ("-", None, "0.00", "0.00", "0.00"),
        ("", None, "0.00", "0.00", "0.00"),
        ("nan", None, "0.00", "0.00", "0.00"),
        ("abc", None, "0.00", "0.00", "0.00"),
        (None, None, "0.00", "0.00", "0.00"),
    ],
)
def test_currency_text(spark, text, plain, zero, signed, ledger):
    want = [None if x is None else Decimal(x) for x in (plain, zero, signed, ledger)]
    got = [
        one(spark, text, money.parse_money("t")),
        one(spark, text, money.parse_money_or_zero("t")),
        one(spark, text, money.parse_money_or_zero("t", negative_parens=True)),
        one(spark, text, money.ledger_amount("t")),
    ]
    assert got == want


@pytest.mark.parametrize(
    ("text", "us", "free"),
    [
        ("09/01/2025", "2025-09-01", "2025-09-01"),
        ("9/1/2025", "2025-09-01", "2025-09-01"),
        ("2025-09-01", None, "2025-09-01"),
        ("13/45/2025", None, None),
        ("", None, None),
        (None, None, None),
    ],
)
def test_date_text(spark, text, us, free):
    assert str(one(spark, text, dates.parse_us_date("t"))) == str(us)
    assert str(one(spark, text, dates.parse_any_date("t"))) == str(free)


@pytest.mark.parametrize(
    ("text", "upper", "collapsed", "flipped", "short"),
    [
        ("Doe, Jane", "DOE, JANE", "DOE, JANE", "JANE DOE", "DOE, JANE"),
        (" jane  doe ", "JANE  DOE", "JANE DOE", "JANE  DOE", "JANE DOE"),
        ("JANE Q DOE", "JANE Q DOE", "JANE Q DOE", "JANE Q DOE", "JANE DOE"),
        ("Cher", "CHER", "CHER", "CHER", None),
        ("  ", "", "", "", None),
        (None, "", "", "", None),
    ],
)
def test_names(spark, text, upper, collapsed, flipped, short):
    assert one(spark, text, names.name_upper("t")) == upper
    assert one(spark, text, names.name_collapsed("t")) == collapsed
    assert one(spark, text, names.name_flipped("t")) == flipped
    assert one(spark, text, names.first_last(names.name_upper("t"))) == short


@pytest.mark.parametrize(
    ("text", "want"), [("09/01/2025", "9/1/2025"), (" 9/1/25 ", "9/1/25"), ("Sept 1", "Sept 1"), ("nan", ""), (None, "")]
)
def test_dob_text(spark, text, want):
    assert one(spark, text, names.dob_text("t")) == want


def test_facilities_and_stages(spark):
    assert one(spark, " North Clinic ", labels.facility_normalized("t", {"North Clinic": "North"})) == "North"
    assert one(spark, "Elsewhere", labels.facility_normalized("t", {"North Clinic": "North"})) == "Unknown"
    assert one(spark, None, labels.facility_normalized("t", {"North Clinic": "North"})) == "Unknown"
    assert one(spark, "12 - Campus Clinics", labels.facility_from_office("t", OFFICES)) == "South"
    assert one(spark, "34 - MAIN OFFICE", labels.facility_from_office("t", OFFICES)) == "North"
    assert one(spark, None, labels.facility_from_office("t", OFFICES)) == "Unknown"
    assert one(spark, "In Progress", labels.stage_class("t")) == "other"


def test_rounding_and_ratio(spark):
    row = spark.range(1).select(
        money.round_half_away(F.lit(-2.675)).alias("a"),
        money.round_half_away(F.lit(0.125)).alias("b"),
        money.pct(F.lit(1), F.lit(0)).alias("c"),
        money.pct(F.lit(1), F.lit(3)).alias("d"),
    ).first()
    assert (row.a, row.b, row.c, row.d) == (-2.68, 0.13, None, 33.33)


def test_month_bounds():
    assert [str(d) for d in dates.month_bounds("2025-12")] == ["2025-12-01", "2026-01-01"]
    assert [str(d) for d in dates.month_bounds("2025-01")] == ["2025-01-01", "2025-02-01"]
