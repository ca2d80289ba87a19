"""Chains of three flights against the join of pairs, with repeated rows; pairs are not shuffled."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from skyfold.operators import connections
from skyfold.operators import search as S
from tests.test_search_two_stop import network  # noqa: F401
from tests.test_wide_shuffles import _named


def _joined(flights, airport):
    c12 = S.one_stop_connections(flights, airport)
    c23 = S.one_stop_connections(flights, airport).select(
        F.col("l1_id").alias("l2_id"), F.col("l2_id").alias("l3_id"), F.col("l2_dest").alias("l3_dest"), F.col("l2_arr").alias("l3_arr"),
        F.col("connection_minutes").alias("connection2_minutes"))
    return c12.join(c23, "l2_id").where(F.col("l3_dest") != F.col("l1_orig")).select(
        "l1_id", "l2_id", "l3_id", "l1_orig", "l3_dest", "l1_dep", "l3_arr", F.col("connection_minutes").alias("connection1_minutes"), "connection2_minutes")


@pytest.mark.parametrize("listed", [5_000, 3])
def test_chains_equal_the_join_of_pairs(network, monkeypatch, listed):  # noqa: F811
    _, _, _, avail, _, airport, _ = network
    monkeypatch.setattr(connections, "LISTED", listed)
    again = avail.where("flight_instance_id % 5 = 0")
    # rows of a flight come again, one of them a day later, one without a time, and one airport has two times
    later = again.where("flight_instance_id % 3 = 0").withColumn("departure_utc", F.expr("departure_utc + interval 1 day")).withColumn("arrival_utc", F.expr("arrival_utc + interval 1 day"))
    timeless = again.where("flight_instance_id % 7 = 0").withColumn("departure_utc", F.lit(None).cast("timestamp"))
    flights = avail.where("flight_instance_id < 130").unionByName(again).unionByName(later).unionByName(timeless)
    airport = airport.unionByName(airport.where("iata_code = 'AAA'").withColumn("min_connection_min", F.lit(200)))
    got, want = (Counter(map(tuple, df.collect())) for df in (S.two_stop_connections(flights, airport), _joined(flights, airport)))
    assert got == want and sum(want.values()) > 1000


def test_pairs_are_not_shuffled(network):  # noqa: F811
    _, _, _, avail, _, airport, _ = network
    chains = S.two_stop_connections(avail, airport)
    wide = [n for name in ("Join", "Window", "Aggregate", "RepartitionByExpression") for n in _named(chains, name)]
    assert wide and not any("l2_id" in n.output().mkString(",") or "minutes" in n.output().mkString(",") for n in wide)
