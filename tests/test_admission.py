"""E1: parallel rounds equal a sequential loop; the reference's contention cases."""

import random


from pyspark.sql import functions as F

from skyfold.operators.reservations import seat_admission, seat_admission_sequential

SCHEMA = "request_id long, requested_at timestamp, flight_instance_id long, cabin_code string, demand int"


def _run(spark, reqs, remaining):
    rq = spark.createDataFrame(reqs, SCHEMA)
    rem = spark.createDataFrame([(f, c, n) for (f, c), n in remaining.items()],
                                "flight_instance_id long, cabin_code string, remaining int")
    return {r.request_id: r.accepted for r in seat_admission(rq, rem).collect()}


def _ts(i):
    import datetime as dt
    return dt.datetime(2026, 3, 1) + dt.timedelta(minutes=i // 3)


def test_k_of_n_single_seat(spark):
    for n, k in ((2, 1), (10, 1), (40, 1), (40, 5)):
        reqs = [(i, _ts(i), 1, "BUS", 1) for i in range(n)]
        got = _run(spark, reqs, {(1, "BUS"): k})
        assert sum(got.values()) == k and len(got) == n


def test_second_leg_full_refuses_whole_request(spark):
    reqs = [(1, _ts(0), 10, "ECO", 1), (1, _ts(0), 11, "ECO", 1), (2, _ts(5), 10, "ECO", 1)]
    got = _run(spark, reqs, {(10, "ECO"): 1, (11, "ECO"): 0})
    assert got == {1: False, 2: True}      # the first leg stays free for request 2


def test_equals_sequential_on_random_inputs(spark):
    rnd = random.Random(7)
    reqs, remaining = [], {}
    keys = [(f, c) for f in range(4) for c in ("ECO", "BUS")]
    for k in keys:
        remaining[k] = rnd.randint(0, 6)
    for rid in range(60):
        at = _ts(rnd.randint(0, 30))          # one arrival time per request, shared by its legs
        for k in rnd.sample(keys, rnd.randint(1, 3)):
            reqs.append((rid, at, k[0], k[1], rnd.randint(1, 3)))
    got = _run(spark, reqs, remaining)
    want = seat_admission_sequential(
        [dict(request_id=r[0], requested_at=r[1], flight_instance_id=r[2], cabin_code=r[3], demand=r[4]) for r in reqs],
        remaining)
    assert got == want


def _chain(spark, n):
    legs, left = [], {(0, "ECO"): 1}
    for i in range(n):
        left[i + 1, "ECO"] = 1
        for f in (i, i + 1):
            legs.append({"request_id": i, "requested_at": f"2024-01-01 00:{i // 60:02d}:{i % 60:02d}", "flight_instance_id": f, "cabin_code": "ECO", "demand": 1})
    rq = spark.createDataFrame([tuple(x.values()) for x in legs], "request_id int, requested_at string, flight_instance_id int, cabin_code string, demand int") \
              .withColumn("requested_at", F.col("requested_at").cast("timestamp"))
    rem = spark.createDataFrame([(f, c, n) for (f, c), n in left.items()], "flight_instance_id int, cabin_code string, remaining int")
    return seat_admission_sequential(legs, left), seat_admission(rq, rem).collect()


def test_a_long_chain_takes_few_rounds(spark):
    """Each request waits for the one before it."""
    want, rows = _chain(spark, 1000)
    assert {r.request_id: r.accepted for r in rows} == want
    assert max(r.decided_round for r in rows) <= 2


def test_chains_longer_than_a_block(spark, monkeypatch):
    from skyfold.operators import reservations
    monkeypatch.setattr(reservations, "CHAIN", 9)
    want, rows = _chain(spark, 40)
    assert {r.request_id: r.accepted for r in rows} == want
    assert 3 <= max(r.decided_round for r in rows) <= 6


def test_blocks_equal_sequential_on_random_inputs(spark, monkeypatch):
    from skyfold.operators import reservations
    monkeypatch.setattr(reservations, "CHAIN", 7)
    rnd = random.Random(11)
    keys = [(f, c) for f in range(5) for c in ("ECO", "BUS")]
    remaining = {k: rnd.randint(0, 9) for k in keys}
    reqs = []
    for rid in range(70):
        at = _ts(rnd.randint(0, 60))
        reqs += [(rid, at, k[0], k[1], rnd.randint(1, 4)) for k in rnd.sample(keys, rnd.randint(1, 4))]
    want = seat_admission_sequential([dict(request_id=r[0], requested_at=r[1], flight_instance_id=r[2], cabin_code=r[3], demand=r[4]) for r in reqs], remaining)
    assert _run(spark, reqs, remaining) == want


def _random_requests(seed):
    rnd = random.Random(seed)
    keys = [(f, c) for f in range(5) for c in ("ECO", "BUS")]
    remaining = {k: rnd.randint(0, 12) for k in keys}
    reqs = []
    for rid in range(80):
        at = _ts(rnd.randint(0, 9000))       # several days, so that hot keys have several buckets
        reqs += [(rid, at, k[0], k[1], rnd.randint(1, 3)) for k in rnd.sample(keys, rnd.randint(1, 4))]
    want = seat_admission_sequential([dict(request_id=r[0], requested_at=r[1], flight_instance_id=r[2], cabin_code=r[3], demand=r[4]) for r in reqs], remaining)
    return reqs, remaining, want


def test_hot_flights_equal_sequential(spark, monkeypatch):
    from skyfold.operators import reservations
    for hot, chain in ((0, 7), (14, 7), (14, 50_000)):
        monkeypatch.setattr(reservations, "HOT_LEGS", hot)
        monkeypatch.setattr(reservations, "CHAIN", chain)
        reqs, remaining, want = _random_requests(hot + chain)
        assert _run(spark, reqs, remaining) == want


def test_a_round_reads_only_what_still_waits(spark, monkeypatch, tmp_path):
    """A hundred requests that are accepted at once on the flight that the others wait for."""
    from skyfold.operators import reservations
    monkeypatch.setattr(reservations, "CHAIN", 2)
    monkeypatch.setattr(reservations, "work_dir", lambda _, name: str(tmp_path / name.split("/")[0]))
    reqs = [(i, _ts(0), 0, "ECO", 1) for i in range(100)]
    reqs += [(100 + i, _ts(30 + 3 * i), f, "ECO", 1) for i in range(8) for f in (0, i + 1, i + 2)]
    remaining = {(0, "ECO"): 103} | {(i, "ECO"): 1 for i in range(1, 11)}
    want = seat_admission_sequential([dict(request_id=r[0], requested_at=r[1], flight_instance_id=r[2], cabin_code=r[3], demand=r[4]) for r in reqs], remaining)
    assert _run(spark, reqs, remaining) == want
    rows = [spark.read.parquet(str(p)).count() for p in sorted((tmp_path / "admission").glob("bulk-*"))]
    assert rows[0] == len(reqs) and len(rows) > 1 and max(rows[1:]) <= 24
