"""Jobs over every line or request do not deal their wide rows out more often than they need to."""

from pyspark.sql import functions as F

from skyfold.operators import extensions as XT
from skyfold.operators import inventory as I
from skyfold.operators import search as S
from skyfold.plans.star import Star
from skyfold.sources.fixtures import FlightModel
from tests.conftest import SF_SMALL


def _nodes(plan):
    out = [plan]
    for i in range(plan.children().size()):
        out += _nodes(plan.children().apply(i))
    return out


def _named(df, name):
    return [n for n in _nodes(df._jdf.queryExecution().optimizedPlan()) if n.nodeName() == name]


def test_ticket_rows_pass_three_joins(spark):
    fact = Star(FlightModel(spark, SF_SMALL)).fact_ticket_sale
    wide = [j for j in _named(fact, "Join") if "ticket_number" in j.output().mkString(",")]
    assert 0 < len(wide) <= 3


def test_ticket_rows_are_dealt_out_by_ticket_and_reservation_only(spark):
    previous = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        fact = Star(FlightModel(spark, SF_SMALL)).fact_ticket_sale
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plan = fact._jdf.sparkSession().sessionState().executePlan(fact._jdf.queryExecution().logical(), fact._jdf.queryExecution().mode()).executedPlan()
        wide = [n for n in _nodes(plan) if n.nodeName() == "Exchange" and "commission_amount" in n.output().mkString(",")]
    finally:
        for k, v in previous.items():
            spark.conf.set(k, v)
    assert len(wide) == 2


def _small(spark):
    avail = spark.createDataFrame(
        [(i, f"2020-01-{day:02d}", f"2020-01-{day:02d} {hour:02d}:00:00", route, cabin, seats, status)
         for i, (day, hour, route, cabin, seats, status) in enumerate([
             (5, 6, 1, "ECO", 1, "SCHEDULED"), (5, 8, 1, "ECO", 1, "SCHEDULED"), (5, 9, 1, "ECO", 4, "SCHEDULED"),
             (5, 5, 1, "ECO", 9, "CANCELLED"), (6, 7, 2, "ECO", 2, "SCHEDULED"), (6, 9, 1, "ECO", 3, "SCHEDULED"),
             (8, 7, 1, "ECO", 0, "SCHEDULED"), (9, 7, 1, "BUS", 5, "SCHEDULED"), (11, 7, 1, "ECO", 5, "SCHEDULED")])],
        "flight_instance_id long, d string, t string, route_id int, cabin_code string, seats_available int, flight_status string")
    avail = avail.select("*", F.col("d").cast("date").alias("flight_date"), F.col("t").cast("timestamp").alias("departure_utc"),
                         F.col("t").cast("timestamp").alias("arrival_utc"), F.lit("F1").alias("flight_number"),
                         F.lit("AAA").alias("origin_iata"), F.lit("BBB").alias("destination_iata"))
    ladder = spark.createDataFrame([(1, 0, 2, "90.00"), (1, 2, None, "70.00"), (2, 0, None, "60.00")],
                                   "route_id int, min_advance_days int, next_adv int, a string").select(
        "route_id", F.lit("ECO").alias("cabin_code"), F.lit("COP").alias("currency"), F.lit("2000-01-01").cast("date").alias("valid_from"),
        F.lit("2030-01-01").cast("date").alias("valid_to"), "min_advance_days", "next_adv",
        F.struct(F.col("a").cast("decimal(12,2)").alias("base_amount"), F.lit(7).alias("fare_id"), F.lit("Y").alias("fare_class_code"),
                 F.lit("10.00").cast("decimal(5,2)").alias("tax_pct")).alias("best"))
    requests = spark.createDataFrame([(n, p, d) for n, p, d in ((1, 1, 5), (2, 2, 6), (3, 2, 6), (4, 5, 8), (5, 9, 8))],
                                     "request_id long, passengers int, day int").select(
        "request_id", F.lit("AAA").alias("origin"), F.lit("BBB").alias("destination"), F.make_date(F.lit(2020), F.lit(1), "day").alias("flight_date"),
        F.lit("ECO").alias("cabin_code"), "passengers", F.lit("COP").alias("currency"), F.lit("2020-01-04").cast("date").alias("search_date"))
    return requests, avail, ladder


def test_flexible_dates_equals_a_search_per_day(spark):
    requests, avail, ladder = _small(spark)
    got = {(r.request_id, r["shift"]): (str(r.flight_date), r.flight_instance_id, r.unit_price)
           for r in S.flexible_dates(requests, avail, ladder).collect()}
    want = {}
    for shift in range(-3, 4):
        day = requests.withColumn("flight_date", F.date_add("flight_date", shift))
        for r in S.search_direct(day, avail, ladder, 1).collect():
            want[r.request_id, shift] = (str(r.flight_date), r.l1_id, r.sort_price)
    assert got == want and len({k[0] for k in got}) == 4      # the fifth asks for more seats than any flight has


def test_flexible_dates_keeps_one_row_a_request_up_to_the_last_join(spark):
    requests, avail, ladder = _small(spark)
    got = S.flexible_dates(requests, avail, ladder)
    ids = [n.child().output().mkString(",") for n in _named(got, "Generate") if "request_id" in n.child().output().mkString(",")]
    assert len(ids) == 1


def test_a_row_per_seat_is_not_shuffled(spark):
    seats = I.seat_map_seats(I.seat_layouts(spark))
    fi = spark.createDataFrame([(1, 100)], "flight_instance_id long, scheduled_flight_id int")
    sf = spark.createDataFrame([(100, 1)], "scheduled_flight_id int, seat_map_id int")
    taken = spark.createDataFrame([(1, "ECO", 7, 2), (9, "ECO", 8, 1)], "flight_instance_id long, cabin_code string, ticket_id long, seats int")
    out = I.seat_map_status(fi, sf, seats, taken)
    named = [(r["flight_instance_id"], r["seat_rank"], r["status"]) for r in out.where("ticket_id is not null").collect()]
    assert sorted(named) == [(1, 1, "TAKEN"), (1, 2, "TAKEN"), (9, 1, "UNSEATED")]
    above = [j for j in _named(out, "Join") if "explode(sequence((lo" in j.left().toString()]
    assert above and all("broadcast" in j.hint().toString() for j in above)


def test_last_travel_is_found_before_passengers_come_in(spark):
    passenger = spark.createDataFrame([(p, f"F{p}", "L", "CC", f"{p}") for p in (1, 2, 3, 4)],
                                      "passenger_id long, first_name string, last_name string, document_type string, document_number string")
    passenger = passenger.select("*", F.lit("1980-01-01").cast("date").alias("birth_date"), F.lit("a@b").alias("email"), F.lit("1").alias("phone"))
    on = spark.createDataFrame([(10, 1), (20, 1), (20, 2), (30, 3)], "reservation_id long, passenger_id long")
    itinerary = spark.createDataFrame([(100, 10), (200, 20), (201, 20), (300, 30)], "itinerary_id long, reservation_id long")
    segment = spark.createDataFrame([(100, 1), (200, 2), (201, 3), (300, 99)], "itinerary_id long, flight_instance_id long")
    flight = spark.createDataFrame([(1, "2001-05-01"), (2, "1996-01-01"), (3, "1997-01-01")], "flight_instance_id long, d string")
    out = XT.anonymise_passengers(passenger, on, segment, itinerary, flight.select("flight_instance_id", F.col("d").cast("date").alias("flight_date")), "2003-01-01")
    got = sorted((str(r.document_number), str(r.last_travel), r.is_anonymised) for r in out.collect())
    assert got == [("1", "2001-05-01", False), ("3", "None", False), ("4", "None", False), ("None", "1997-01-01", True)]
    for j in _named(out, "Join"):
        columns = j.output().mkString(",")
        assert not ("passenger_id" in columns and ("flight_instance_id" in columns or "itinerary_id" in columns))
