"""Reference scenarios (FIXTURES §A.3) as batch jobs over small tables."""

import datetime as dt

from pyspark.sql import functions as F

from skyfold.operators import dims, facts
from skyfold.operators import reservations as R

T0 = dt.datetime(2026, 3, 2, 12, 0)


def _flights(seed):
    return (seed.flight_instance.select("flight_instance_id", "scheduled_flight_id", "status", "departure_utc",
                                        "arrival_utc")
            .join(seed.scheduled_flight.select("scheduled_flight_id", "flight_number", "route_id"), "scheduled_flight_id")
            .join(seed.route.select("route_id", "origin_iata", "destination_iata"), "route_id"))


def _pick(seed, number, date):
    f = _flights(seed).where((F.col("flight_number") == number) & (F.to_date("departure_utc") == date)).first()
    return f.flight_instance_id


def test_discontinuous_itinerary_refused(spark, seed):
    a, b = _pick(seed, "AV8101", "2026-03-10"), _pick(seed, "AV8501", "2026-03-10")   # BOG-MDE then CTG-SMR
    c, d = _pick(seed, "AV8301", "2026-03-10"), _pick(seed, "AV8501", "2026-03-10")   # MDE-CTG 11:15 then CTG-SMR 15:00
    seg = spark.createDataFrame([(1, 1, a), (1, 2, b), (2, 1, c), (2, 2, d)],
                                "itinerary_id long, sequence_no int, flight_instance_id long")
    got = {r.itinerary_id: r.result for r in
           R.itinerary_validation(seg, _flights(seed), seed.airport, "2026-03-02 00:00:00").collect()}
    assert got == {1: "NOT_CONTINUOUS", 2: "OK"}


def _events(spark, rows):
    return spark.createDataFrame(rows, "event_id long, reservation_id long, occurred_at timestamp, to_status string, "
                                       "from_status string")


def test_lifecycle_held_confirmed_cancelled(spark):
    ev = _events(spark, [(1, 7, T0, "HELD", None), (2, 7, T0 + dt.timedelta(minutes=5), "CONFIRMED", "HELD"),
                         (3, 7, T0 + dt.timedelta(days=1), "CANCELLED", "CONFIRMED")])
    audit = R.transition_audit(ev).collect()
    assert all(r.is_legal and r.from_matches for r in audit)
    at = lambda t: R.state_as_of(ev, t).first().status
    assert at("2026-03-02 12:01:00") == "HELD"
    assert at("2026-03-02 13:00:00") == "CONFIRMED"
    assert at("2026-03-04 00:00:00") == "CANCELLED"
    times = facts.first_status_times(ev).first()
    assert times.event_count == 3 and times.confirmed_at == T0 + dt.timedelta(minutes=5)


def test_payment_redelivered_five_times_has_one_effect(spark):
    pe = spark.createDataFrame([(i, 9, "evt-1", "payment.succeeded", "{}", T0 + dt.timedelta(seconds=i)) for i in range(5)],
                               "payment_event_id long, payment_id long, psp_event_id string, event_type string, "
                               "payload string, received_at timestamp")
    rows = R.dedupe_payments(pe).collect()
    assert len(rows) == 1 and rows[0].deliveries == 5 and rows[0].payment_event_id == 0


def test_wrong_last_name_finds_nothing(spark):
    res = spark.createDataFrame([(1, "ABCDEF", "HELD")], "reservation_id long, pnr string, status string")
    rp = spark.createDataFrame([(1, 1, 11)], "reservation_id long, passenger_ref int, passenger_id long")
    pax = spark.createDataFrame([(11, "Pérez")], "passenger_id long, last_name string")
    ok = spark.createDataFrame([(" abcdef", "pérez  ")], "pnr string, last_name string")
    bad = spark.createDataFrame([("ABCDEF", "Gómez")], "pnr string, last_name string")
    assert R.reservation_by_name(ok, res, rp, pax).count() == 1
    assert R.reservation_by_name(bad, res, rp, pax).count() == 0


def test_expired_hold_frees_seat(spark):
    res = spark.createDataFrame([(1, "HELD", T0 - dt.timedelta(minutes=30), "AAAAAA"),
                                 (2, "HELD", T0 + dt.timedelta(minutes=10), "AAAAAB")],
                                "reservation_id long, status string, hold_expires_at timestamp, pnr string")
    it = spark.createDataFrame([(1, 1), (2, 2)], "itinerary_id long, reservation_id long")
    seg = spark.createDataFrame([(1, 100, "BUS", "ACTIVE"), (2, 100, "BUS", "ACTIVE")],
                                "itinerary_id long, flight_instance_id long, cabin_code string, status string")
    seats = spark.createDataFrame([(1, 1), (2, 1)], "reservation_id long, seats int")
    inv = spark.createDataFrame([(100, "BUS", 12, 10, 2)],
                                "flight_instance_id long, cabin_code string, capacity int, seats_sold int, seats_held int")
    row = R.expire_holds(res, seg, it, inv, seats, T0.isoformat(sep=" ")).first()
    assert (row.held_released, row.seats_held) == (1, 1)


def test_channel_dimension_default_row(spark):
    empty = spark.createDataFrame([], "channel string, agency_id int")
    agency = spark.createDataFrame([(1, "X")], "agency_id int, legal_name string")
    rows = dims.dim_channel(empty, agency).collect()
    assert [(r.channel_key, r.channel, r.agency_name, r.is_indirect) for r in rows] == [(1, "WEB", None, False)]


def test_credit_ledger_never_negative_and_flags_breach(spark):
    res = spark.createDataFrame([(1, 1, "CONFIRMED", "600.00", T0), (2, 1, "CANCELLED", "500.00", T0 + dt.timedelta(hours=1))],
                                "reservation_id long, agency_id int, status string, total_amount string, created_at timestamp") \
        .withColumn("total_amount", F.col("total_amount").cast("decimal(14,2)")).withColumn("updated_at", F.col("created_at"))
    ag = spark.createDataFrame([(1, "1000.00")], "agency_id int, credit_limit string") \
        .withColumn("credit_limit", F.col("credit_limit").cast("decimal(14,2)"))
    led = sorted(R.agency_credit_ledger(res, ag).collect(), key=lambda r: (r.entry_at, r.kind))
    assert [float(r.credit_used) for r in led] == [600.0, 1100.0, 600.0]
    assert [r.is_breach for r in led] == [False, True, False]


def _two_itineraries(spark):
    reservation = spark.createDataFrame([(1, "CONFIRMED", 5, 100), (2, "HELD", None, 50), (3, "CANCELLED", None, 9)],
                                        "reservation_id long, status string, agency_id int, total_amount int")
    itinerary = spark.createDataFrame([(10, 1, "ACTIVE"), (11, 1, "ACTIVE"), (20, 2, "ACTIVE"), (21, 2, "ACTIVE"), (30, 3, "ACTIVE")],
                                      "itinerary_id long, reservation_id long, status string")
    segment = spark.createDataFrame([(100, 10, 1, "ECO", "ACTIVE"), (101, 11, 2, "ECO", "ACTIVE"), (200, 20, 1, "ECO", "ACTIVE"), (201, 21, 3, "BUS", "ACTIVE")],
                                    "segment_id long, itinerary_id long, flight_instance_id long, cabin_code string, status string")
    seats = spark.createDataFrame([(1, 2), (2, 1)], "reservation_id long, seats int")
    return reservation, itinerary, segment, seats


def test_itineraries_cancelled_one_by_one(spark):
    from skyfold.operators import reservations as R
    tables = _two_itineraries(spark)
    both = spark.createDataFrame([(1, 10), (1, 11), (2, 20), (3, None)], "reservation_id long, itinerary_id long")
    got = {r.reservation_id: r for r in R.apply_cancellations(both, *tables).collect()}
    assert set(got) == {1, 2}
    assert (got[1].new_status, got[1].itineraries_cancelled, got[1].segments_cancelled, got[1].seats_released, got[1].credit_returned) == ("CANCELLED", 2, 2, 4, 100)
    assert (got[2].new_status, got[2].itineraries_cancelled, got[2].segments_cancelled, got[2].credit_returned) == ("HELD", 1, 1, None)
    rel = {(r.flight_instance_id, r.cabin_code): (r.sold_released, r.held_released) for r in R.release_seats(both, *tables).collect()}
    assert rel == {(1, "ECO"): (2, 1), (2, "ECO"): (2, 0)}


def test_pnr_collisions_move_on_and_settled_codes_stay(spark, monkeypatch):
    from skyfold.operators import reservations as R
    res = spark.range(20_000).withColumnRenamed("id", "reservation_id")
    real = R.pnr_code
    monkeypatch.setattr(R, "pnr_code", lambda c, salt: F.substring(real(c, salt), 1, 3))      # 32,768 codes
    out = R.pnr_assign(res).collect()
    assert len(out) == 20_000 and len({r.pnr for r in out}) == 20_000 and max(r.salt for r in out) > 3


def test_latency_summary_equals_percentile_on_many_rows(spark):
    from skyfold.operators import reservations as R
    log = spark.range(0, 2_000_000, 1, 16).select(
        (F.col("id") % 3).alias("g"), F.lit("created").alias("outcome"),
        F.round(F.pow(F.pmod(F.xxhash64("id"), F.lit(100_000)) / 1000, F.lit(2.0)) - F.lit(500.0), 3).alias("latency_ms"))
    got = {r.g: r.p50_ms for r in R.request_latency_summary(log, ["g"]).collect()}
    want = {r.g: r.p for r in log.groupBy("g").agg(F.percentile("latency_ms", 0.5).alias("p")).collect()}
    assert got == want
