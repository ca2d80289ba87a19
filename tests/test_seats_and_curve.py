"""Seats beyond the map, the inventory curve with dips, running levels of hot keys, card numbers."""

import collections
import datetime as dt
import random

from pyspark.sql import functions as F

from skyfold.operators import extensions as XT
from skyfold.operators import inventory as I
from skyfold.operators.ranking import running_level


def test_every_sold_seat_is_in_the_result(spark, monkeypatch):
    monkeypatch.setattr(I, "TICKETS_PER_BUCKET", 3)
    seats = I.seat_map_seats(I.seat_layouts(spark)).cache()
    rng = random.Random(2)
    fi = spark.createDataFrame([(f, 100 + f % 3) for f in range(1, 7)], "flight_instance_id long, scheduled_flight_id int")
    sf = spark.createDataFrame([(100, 1), (101, 2), (102, 3)], "scheduled_flight_id int, seat_map_id int")
    tickets = [(rng.randrange(1, 7), rng.choice(("ECO", "BUS")), t, rng.choice((1, 2, 7, 0))) for t in range(60)]
    tickets += [(3, "ECO", 1000 + t, 5) for t in range(60)] + [(99, "ECO", 2000, 2)]      # an oversold flight, an unknown one
    out = I.seat_map_status(fi, sf, seats, spark.createDataFrame(tickets, "flight_instance_id long, cabin_code string, ticket_id long, seats int")).collect()
    sold = collections.Counter(r["ticket_id"] for r in out if r["ticket_id"] is not None)
    assert sold == {t: n for _, _, t, n in tickets if n}
    room = {(r["seat_map_id"], r["cabin_code"]): r["n"] for r in seats.groupBy("seat_map_id", "cabin_code").agg(F.count("*").alias("n")).collect()}
    for f in range(1, 7):
        for cabin in ("ECO", "BUS"):
            rows = [r for r in out if r["flight_instance_id"] == f and r["cabin_code"] == cabin]
            n, have = sum(x[3] for x in tickets if x[:2] == (f, cabin)), room.get((1 + f % 3, cabin), 0)
            status = collections.Counter(r["status"] for r in rows)
            assert (status["TAKEN"], status["FREE"], status["UNSEATED"]) == (min(n, have), max(have - n, 0), max(n - have, 0))
            assert len({r["seat_number"] for r in rows if r["seat_number"]}) == have
            line = [r["ticket_id"] for r in sorted(rows, key=lambda r: r["seat_rank"]) if r["ticket_id"] is not None]
            assert line == sorted(line)
    assert {r["status"] for r in out if r["flight_instance_id"] == 99} == {"UNSEATED"}


def test_running_level_equals_a_loop(spark):
    rng = random.Random(8)
    rows = [(rng.choice("aab"), i, rng.randrange(-5, 6), rng.randrange(-2, 3)) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, i int, x int, y int")
    for width in (1, 17, 1000):
        got = {(r["k"], r["i"]): (r["x_level"], r["x_lowest"], r["y_level"], r["y_lowest"]) for r in running_level(df, ["k"], ["i"], ["x", "y"], F.floor(F.col("i") / width)).collect()}
        state = {}
        for k, i, x, y in rows:
            a, b, c, d = state.get(k, (0, None, 0, None))
            a, c = a + x, c + y
            state[k] = (a, a if b is None else min(a, b), c, c if d is None else min(c, d))
            assert got[k, i] == state[k]


def test_curve_flags_dips(spark):
    day = dt.datetime(2026, 1, 1)
    events = [(1, 1, day, "HELD"), (2, 1, day + dt.timedelta(hours=1), "CONFIRMED"), (3, 1, day + dt.timedelta(days=2), "CANCELLED"), (4, 1, day + dt.timedelta(days=2, hours=1), "HELD"),
              (5, 2, day + dt.timedelta(hours=1), "HELD"), (6, 2, day + dt.timedelta(days=3), "EXPIRED"), (7, 2, day + dt.timedelta(days=4), "CONFIRMED"), (8, 3, day, None)]
    ev = spark.createDataFrame(events, "event_id long, reservation_id long, occurred_at timestamp, to_status string")
    seg = spark.createDataFrame([(1, 10, "ECO", 2), (1, 10, "ECO", 1), (1, 11, "BUS", 4), (2, 10, "ECO", 5)], "itinerary_id long, flight_instance_id long, cabin_code string, seats int")
    it = spark.createDataFrame([(1, 1), (2, 2)], "itinerary_id long, reservation_id long")
    out = I.inventory_curve(ev, seg, it).orderBy("flight_instance_id", "occurred_at").collect()
    assert [(r["seats_held"], r["seats_sold"]) for r in out if r["flight_instance_id"] == 10] == [(3, 0), (5, 3), (5, 0), (8, 0), (3, 0)]
    assert not any(r["dipped"] for r in out)
    # moves of two reservations where a counter falls before it rises
    late = ev.withColumn("occurred_at", F.when(F.col("event_id") == 1, F.lit(day + dt.timedelta(hours=1))).otherwise(F.col("occurred_at"))).where("event_id != 5")
    levels = running_level(spark.createDataFrame([("f", 1, -2), ("f", 2, 5), ("f", 3, -1)], "k string, t int, held int"), ["k"], ["t"], ["held"], F.col("t")).orderBy("t").collect()
    assert [(r["held_level"], r["held_lowest"]) for r in levels] == [(-2, -2), (3, -2), (2, -2)]
    assert I.inventory_curve(late, seg, it).count() > 0


def test_card_numbers_and_near_misses(spark):
    rows = [(1, "call 4111 1111 1111 1111 now", None), (2, "4111-1111-1111-1112", "x"), (3, "on 2024 4111111111111111", "5500005555555559"), (4, "411111111111", "3782 822463 10005"),
            (5, "12345678901234567890123456", "4111  1111 1111 1111"), (6, None, ""), (7, "id 4111.1111.1111.1111", "6011000990139424,6011000990139424")]
    df = spark.createDataFrame(rows, "k int, a string, b string")
    out = XT.card_number_scan({"t": (df, "k", ["a", "b"])})
    got = {(r["row_key"], r["column_name"], r["masked"]) for r in out.collect()}
    assert got >= {("1", "a", "****1111"), ("3", "a", "****1111"), ("3", "b", "****5559"), ("4", "b", "****0005"), ("7", "b", "****9424")}
    assert not {k for k in got if k[0] in ("2", "5", "6") or k[:2] == ("4", "a") or k[:2] == ("7", "a")}
    assert out.count() == len(got)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") <= 1
