from decimal import Decimal

from pyspark.sql import functions as F

from skyfold.functions import exprs as X


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


def test_date_key_and_band(spark):
    assert one(spark, X.date_key(F.lit("2026-03-05").cast("date"))) == 20260305
    assert one(spark, X.date_key(F.lit(None).cast("date"))) is None
    assert [one(spark, X.distance_band(F.lit(k))) for k in (399, 400, 899, 900)] == ["corta", "media", "media", "larga"]


def test_money_rounding(spark):
    fare, tax = X.tax_split(F.lit("2.345").cast("decimal(12,3)"), F.lit("100.00").cast("decimal(5,2)"))
    assert one(spark, fare) == Decimal("2.34")          # half-even
    _, tax = X.tax_split(F.lit("100.00").cast("decimal(12,2)"), F.lit("19.00").cast("decimal(5,2)"))
    assert one(spark, tax) == Decimal("19.00")
    assert one(spark, X.net_fare(F.lit("1000.05").cast("decimal(12,2)"), F.lit("8.00").cast("decimal(5,2)"))) == Decimal("920.05")
    assert one(spark, X.load_factor(F.lit(1), F.lit(3))) == Decimal("0.3333")
    assert one(spark, X.load_factor(F.lit(2), F.lit(3))) == Decimal("0.6667")   # half-up
    assert one(spark, X.load_factor(F.lit(5), F.lit(0))) == Decimal("0.0000")
    assert one(spark, X.price_grid(F.lit(240), F.lit("380.0").cast("decimal(8,1)"))) == Decimal("91000.00")


def test_minutes_truncate_toward_zero(spark):
    a = F.lit("2026-01-01 10:00:59").cast("timestamp")
    b = F.lit("2026-01-01 10:02:00").cast("timestamp")
    assert one(spark, X.minutes_between(a, b)) == 1
    assert one(spark, X.minutes_between(b, a)) == -1
    assert one(spark, X.duration_minutes(a, b)) == 1


def test_calendar_helpers(spark):
    d = F.lit("2026-03-02").cast("date")  # a Monday
    assert one(spark, X.runs_on_day(F.lit("1234567"), d)) is True
    assert one(spark, X.runs_on_day(F.lit("23456"), d)) is False
    utc = one(spark, X.local_to_utc(d, F.lit("06:30"), F.lit("America/Bogota")))
    assert str(utc) == "2026-03-02 11:30:00"


def test_pnr_alphabet(spark):
    p = one(spark, X.pnr_from_number(F.lit(32 ** 6 - 1)))
    assert p == "999999" and len(one(spark, X.pnr_from_number(F.lit(0)))) == 6
    assert not set(one(spark, X.pnr_from_number(F.lit(123456789)))) & set("IO01")
