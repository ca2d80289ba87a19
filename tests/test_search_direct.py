"""Direct search and flexible dates: neither candidates nor results are rows of a shuffle."""

from skyfold.operators import search as S
from tests.test_wide_shuffles import _named, _small


def test_direct_flights_meet_requests_without_a_shuffle_of_either_with_the_other(spark):
    requests, avail, ladder = _small(spark)
    found = S.search_direct(requests.unionByName(requests.withColumn("request_id", requests.request_id + 100)), avail, ladder)
    wide = [n for name in ("Join", "Window", "Aggregate", "RepartitionByExpression") for n in _named(found, name)]
    assert wide and not any("l1_id" in n.output().mkString(",") for n in wide)
    got = {(r.request_id, r["rank"]): (r.l1_id, r.sort_price, str(r.search_date), r.passengers) for r in found.collect()}
    assert {k for k in got if k[0] < 100} == {(1, 1), (1, 2), (1, 3), (2, 1), (2, 2), (3, 1), (3, 2)}
    assert all(got[i + 100, k] == got[i, k] for i, k in got if i < 100)
    assert [got[2, k][0] for k in (1, 2)] == [4, 5]


def test_equal_requests_are_one_search_of_flexible_dates(spark):
    from skyfold.operators import itineraries
    requests, avail, ladder = _small(spark)
    found = itineraries.cheapest_days(requests, avail.where("flight_status = 'SCHEDULED'"), ladder, 3).collect()
    assert {(tuple(sorted(x.request_id for x in r.request_ids)), r["shift"]) for r in found if r.passengers == 2} == {((2, 3), -1), ((2, 3), 0)}
    wide = [n.output().mkString(",") for n in _named(S.flexible_dates(requests, avail, ladder), "Join")]
    assert wide and not any("search_date" in w and "flight_instance_id" in w for w in wide)
