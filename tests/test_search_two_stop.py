"""Two-stop search against a brute force over all chains, and folding of equal requests."""

import datetime as dt
import itertools
import random
from decimal import Decimal

import pytest

from skyfold.operators import itineraries
from skyfold.operators import search as S
from tests.test_wide_shuffles import _named

MCT = {"AAA": 30, "BBB": 45, "CCC": 60, "DDD": 30, "EEE": 90}
DAY = dt.date(2026, 5, 10)


def _flights(rng):
    out = []
    for i in range(260):
        a, b = rng.sample(sorted(MCT), 2)
        dep = dt.datetime(2026, 5, 10) + dt.timedelta(minutes=rng.randrange(0, 3 * 1440, 15))
        route = sorted(MCT).index(a) * 10 + sorted(MCT).index(b)
        out.append((i, dep.date(), dep, dep + dt.timedelta(minutes=rng.choice((45, 60, 120))), rng.choice(("SCHEDULED",) * 9 + ("DELAYED",)), f"N{i}", route, a, b,
                    rng.choice(("ECO", "ECO", "BUS")), rng.choice((0, 1, 2, 9, 50))))
    return out


@pytest.fixture(scope="module")
def network(spark):
    rng = random.Random(4)
    flights = _flights(rng)
    avail = spark.createDataFrame(flights, "flight_instance_id long, flight_date date, departure_utc timestamp, arrival_utc timestamp, flight_status string, flight_number string, "
                                           "route_id int, origin_iata string, destination_iata string, cabin_code string, seats_available int")
    fares = [(100 * r + k, r, f"{c}{k}", k, Decimal(rng.randrange(5, 12) * 10), "COP", Decimal("19.00"), dt.date(2026, 1, 1), dt.date(2026, 12, 31))
             for r in sorted({f[6] for f in flights}) for k, c in enumerate(("ECO", "BUS", "ECO")) if rng.random() < 0.95]
    fare = spark.createDataFrame(fares, "fare_id long, route_id int, fare_class_code string, fare_rule_id int, base_amount decimal(12,2), currency string, tax_pct decimal(5,2), valid_from date, valid_to date")
    classes = spark.createDataFrame([("ECO0", "ECO"), ("BUS1", "BUS"), ("ECO2", "ECO")], "fare_class_code string, cabin_code string")
    rules = spark.createDataFrame([(0, 0), (1, 3), (2, 6)], "fare_rule_id int, min_advance_days int")
    airport = spark.createDataFrame(list(MCT.items()), "iata_code string, min_connection_min int")
    requests = [(k, a, b, DAY, cabin, pax, "COP", DAY - dt.timedelta(days=lead))
                for k, ((a, b), cabin, pax, lead) in enumerate(itertools.product(itertools.permutations(sorted(MCT), 2), ("ECO", "BUS"), (1, 5), (1, 6)))]
    requests += [(1000, *requests[3][1:]), (1001, *requests[3][1:])]
    req = spark.createDataFrame(requests, "request_id long, origin string, destination string, flight_date date, cabin_code string, passengers int, currency string, search_date date")
    return flights, fares, requests, avail, S.fare_ladder(fare, classes, rules), airport, req


def _fare(fares, flight, cabin, as_of):
    days = (flight[1] - as_of).days
    fits = [f for f in fares if f[1] == flight[6] and f[2][:3] == cabin and (0, 3, 6)[f[3]] <= days]
    return min(fits, key=lambda f: (f[4], f[0]), default=None)


def _chains(flights, fares, request):
    _, origin, dest, day, cabin, pax, _, as_of = request
    legs = [f for f in flights if f[4] == "SCHEDULED" and f[9] == cabin and f[10] >= pax]

    def fits(a, b):
        gap = b[2] - a[3]
        return a[8] == b[7] and dt.timedelta(minutes=MCT[a[8]]) <= gap <= dt.timedelta(hours=12) and 0 <= (b[1] - a[1]).days <= 1

    out = []
    for a in legs:
        if a[7] == origin and a[1] == day and a[8] != dest:
            for b in legs:
                if fits(a, b) and b[8] not in (origin, dest):
                    for c in legs:
                        if fits(b, c) and c[8] == dest:
                            picked = [_fare(fares, x, cabin, as_of) for x in (a, b, c)]
                            if all(picked):
                                price = sum(f[4] for f in picked) * Decimal("1.19")
                                out.append((price, c[3] - a[2], a[0], b[0], c[0]))
    return sorted(out)


@pytest.mark.parametrize("limit", [3, 50])
def test_two_stop_equals_brute_force(network, limit):
    flights, fares, requests, avail, ladder, airport, req = network
    got = {}
    for r in S.search_two_stop(req, avail, ladder, airport, limit=limit).collect():
        got[r["request_id"], r["rank"]] = (r["l1_id"], r["l2_id"], r["l3_id"])
    expected = {(q[0], k + 1): c[2:] for q in requests for k, c in enumerate(_chains(flights, fares, q)[:limit])}
    assert got == expected
    assert len(got) > 60 and any(k[1] == 3 for k in got)


def test_itineraries_are_searched_once_and_returned_to_all(network):
    flights, fares, requests, avail, ladder, airport, req = network
    searches, members = S.fold_requests(req)
    assert searches.count() == len(requests) - 2 and members.count() == len(requests)
    best = S.search_itineraries(req, avail, ladder, airport, max_stops=2).collect()
    own = {i: [(r["rank"], r["first_flight_id"], r["second_flight_id"], r["third_flight_id"]) for r in best if r["request_id"] == i] for i in (3, 1000, 1001)}
    assert own[3] and sorted(own[3]) == sorted(own[1000]) == sorted(own[1001])
    assert {r["stops"] for r in best} == {0, 1, 2}
    for r in best:
        assert (r["third_flight_id"] is not None) == (r["stops"] == 2) == (r["connection2_minutes"] is not None)
    plan = S.search_itineraries(req, avail, ladder, airport, max_stops=0)
    assert {r["stops"] for r in plan.collect()} == {0}
    with pytest.raises(ValueError):
        S.search_itineraries(req, avail, ladder, airport, max_stops=3)


def _rows(df):
    return sorted((r["request_id"], r["stops"], r["rank"], r["first_flight_id"], r["second_flight_id"] or 0, r["third_flight_id"] or 0) for r in df.collect())


def test_a_large_day_is_dealt_out_without_another_result(network, monkeypatch):
    _, _, _, avail, ladder, airport, req = network
    whole = _rows(S.search_itineraries(req, avail, ladder, airport, max_stops=2))
    monkeypatch.setattr(itineraries, "REQUESTS", 7)
    assert _rows(S.search_itineraries(req, avail, ladder, airport, max_stops=2)) == whole


def test_chains_are_never_rows_of_a_shuffle(network):
    _, _, _, avail, ladder, airport, req = network
    for df, column in ((S.search_one_stop(req, avail, ladder, airport), "l2_id"), (S.search_two_stop(req, avail, ladder, airport), "l2_id"),
                       (S.offer_documents(S.search_itineraries(req, avail, ladder, airport, max_stops=2, segments=True), avail), "second_flight_id")):
        assert column in df.columns
        wide = [n for name in ("Join", "Window", "Aggregate", "RepartitionByExpression") for n in _named(df, name)]
        assert wide and not any(c in n.output().mkString(",") for n in wide for c in ("l2_id", "second_flight_id"))


def test_documents_of_repeated_requests_list_their_segments_as_the_joins_do(network):
    _, _, _, avail, ladder, airport, req = network
    for asked, copies in ((req, 1), (req.unionByName(req.where("request_id = 3")), 2)):
        docs = S.itinerary_documents(asked, avail, ladder, airport, max_stops=2).where("request_id = 3").collect()
        joined = S.offer_documents(S.search_itineraries(asked, avail, ladder, airport, max_stops=2), avail).where("request_id = 3").collect()
        plain = lambda rows: sorted((r["rank"], r["segments"], r["connection_minutes"]) for r in rows)
        assert docs and plain(docs) == plain(joined)
        assert all(len(r["segments"]) == copies * (r["stops"] + 1) for r in docs)
