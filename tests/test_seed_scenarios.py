"""Counts and scenarios of the reference seed (FIXTURES §A)."""

from pyspark.sql import functions as F

from skyfold.operators import dims
from skyfold.operators import search as S
from skyfold.sources.fixtures import CURRENCY


def test_seed_counts(seed):
    assert seed.flight_instance.count() == 854
    assert seed.flight_inventory.count() == 1342
    assert seed.fare.count() == 48
    caps = {(r.seat_map_id, r.cabin_code): r.capacity for r in seed.capacity.collect()}
    assert caps == {(1, "ECO"): 68, (2, "BUS"): 12, (2, "ECO"): 150, (3, "BUS"): 12, (3, "ECO"): 162}
    assert seed.flight_instance.where(F.col("aircraft_id").isNull()).count() == 0


def test_calendar(spark):
    d = dims.dim_date(spark)
    assert d.count() == 1095
    assert d.agg(F.max("date_key")).first()[0] == 20281230


def _avail(seed):
    return S.flight_availability(seed.flight_instance, seed.scheduled_flight, seed.route, seed.flight_inventory)


def _request(spark, origin, dest, date, cabin="ECO", pax=1, today="2026-03-02"):
    return spark.createDataFrame([(1, origin, dest, date, cabin, pax, CURRENCY, today)],
                                 "request_id long, origin string, destination string, flight_date string, "
                                 "cabin_code string, passengers int, currency string, search_date string") \
        .withColumn("flight_date", F.col("flight_date").cast("date")).withColumn("search_date", F.col("search_date").cast("date"))


def test_direct_search_one_week_ahead(spark, seed):
    ladder = S.fare_ladder(seed.fare, seed.fare_class, seed.fare_rule)
    d = S.search_direct(_request(spark, "BOG", "MDE", "2026-03-09"), _avail(seed), ladder).collect()
    assert len(d) == 2
    # 7 days ahead: the 21-day promo is not eligible, the 7-day standard fare is the cheapest
    assert {r.l1_class for r in d} == {"Y"}


def test_one_stop_over_ctg_respects_mct(spark, seed):
    ladder = S.fare_ladder(seed.fare, seed.fare_class, seed.fare_rule)
    o = S.search_one_stop(_request(spark, "MDE", "SMR", "2026-03-20"), _avail(seed), ladder, seed.airport).collect()
    assert o, "MDE-CTG-SMR connects at CTG"
    for r in o:
        assert r.l1_dest == "CTG" and r.connection_minutes >= 40


def test_offers_sorted_and_capped(spark, seed):
    ladder = S.fare_ladder(seed.fare, seed.fare_class, seed.fare_rule)
    req = _request(spark, "BOG", "CTG", "2026-04-10", pax=2)
    av = _avail(seed)
    offers = S.search_offers(S.search_direct(req, av, ladder), S.search_one_stop(req, av, ladder, seed.airport))
    rows = sorted(offers.collect(), key=lambda r: r["rank"])
    assert rows and all(r.total_amount > 0 for r in rows)
    assert [r.total_amount for r in rows] == sorted(r.total_amount for r in rows)
    assert all(r.total_amount == r.price_per_passenger * 2 for r in rows)
