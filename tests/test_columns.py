from datetime import date
from decimal import Decimal

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from tidemart.functions import columns as c
from tidemart.functions.calendar import date_spine, days_spanned


def one(spark, expression, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(expression.alias("x")).first()["x"]


def test_normalize_email(spark):
    emails = spark.createDataFrame([(" A@B.com ",), ("",), ("   ",), (None,)], "e string")
    got = [r[0] for r in emails.select(c.normalize_email("e")).collect()]
    assert got == ["a@b.com", None, None, None]


def test_blank_to(spark):
    values = spark.createDataFrame([("",), (None,), ("x",)], "v string")
    got = [r[0] for r in values.select(c.blank_to("v", "(direct)")).collect()]
    assert got == ["(direct)", "(direct)", "x"]


def test_minor_to_major_keeps_the_scale(spark):
    assert one(spark, c.minor_to_major("cents"), cents=12345) == Decimal("123.4500")


def test_surrogate_key_is_md5_of_text(spark):
    assert one(spark, c.surrogate_key("k"), k=7) == "8f14e45fceea167a5a36dedd4bea2543"
    two = one(spark, c.surrogate_key("a", "b"), a="x", b="y")
    assert two == one(spark, F.md5(F.lit("x-y")))
    nothing = spark.createDataFrame([(None,)], "k string").select(c.surrogate_key("k")).first()[0]
    assert nothing == one(spark, F.md5(F.lit(c.NULL_KEY_PART)))


def test_month_starts_between_counts_boundaries(spark):
    def months(a, b):
        return one(spark, c.month_starts_between("a", "b"), a=a, b=b)

    assert months(date(2026, 1, 31), date(2026, 2, 1)) == 1
    assert months(date(2026, 1, 1), date(2026, 1, 31)) == 0
    assert months(date(2025, 11, 30), date(2026, 2, 1)) == 3


def test_ratios_without_a_denominator(spark):
    zero = {"n": 5, "d": 0}
    assert one(spark, c.ratio_or_zero("n", "d"), **zero) == 0.0
    assert one(spark, c.ratio_or_null("n", "d"), **zero) is None
    assert one(spark, c.ratio_of_sums(F.col("n"), F.col("d")), **zero) is None
    assert one(spark, c.ratio_of_sums(F.col("n"), F.col("d")), n=5, d=-2) == -2.5
    assert one(spark, c.ratio_or_null("n", "d"), n=5, d=-2) is None


def test_cents_are_whole_or_refused(spark):
    assert one(spark, c.cents("v"), v=Decimal("1.23")) == 123
    fine = spark.createDataFrame([(Decimal("1.2300"),), (None,)], "v decimal(12,4)")
    assert [r[0] for r in fine.select(c.cents("v")).collect()] == [123, None]
    with pytest.raises(SparkRuntimeException, match="not a whole number of cents"):
        one(spark, c.cents("v"), v=Decimal("1.239"))


def test_mean_of_ratios_keeps_small_digits(spark):
    tiny = spark.createDataFrame([(1e-10,), (3e-10,)], "v double")
    assert tiny.agg(c.mean_of_ratios("v")).first()[0] == 2e-10


def test_days_spanned(spark):
    dates = spark.createDataFrame([(date(2026, 1, 3),), (date(2026, 1, 1),), (None,)], "d date")
    assert days_spanned(dates, "d").count() == 3
    assert days_spanned(dates.where("d is null"), "d").count() == 0


def test_mean_of_nothing_is_null(spark):
    empty = spark.createDataFrame([], "v decimal(12,2)")
    assert empty.agg(c.mean("v")).first()[0] is None


def test_calendar_stops_before_its_end(spark):
    days = [r[0] for r in date_spine(spark, date(2026, 1, 1), date(2026, 12, 31)).collect()]
    assert len(days) == len(set(days)) == 364
    assert (min(days), max(days)) == (date(2026, 1, 1), date(2026, 12, 30))


def test_calendar_of_no_days(spark):
    assert date_spine(spark, date(2026, 1, 1), date(2026, 1, 1)).count() == 0
    assert date_spine(spark, date(2026, 1, 2), date(2026, 1, 1)).count() == 0
