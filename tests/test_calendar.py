"""The calendar covers the dates of the data, whatever their years."""

import datetime as dt

from pyspark.sql import functions as F

from skyfold.plans.star import Star
from skyfold.sources.fixtures import FlightModel
from skyfold.sources.tables import read_table
from tests.conftest import SF_SMALL


def test_no_fact_is_lost_outside_the_supplied_years(spark, tmp_path):
    later = {t: read_table(spark, SF_SMALL, t).withColumn(c, F.add_months(c, 60).cast(read_table(spark, SF_SMALL, t).schema[c].dataType))
             for t, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"))}
    star = Star(FlightModel(spark, SF_SMALL, later).snapshot(str(tmp_path / "snapshot"), FlightModel.STAR_SNAPSHOT), as_of="2003-01-01")
    first, last, n = star.dim_date.agg(F.min("full_date"), F.max("full_date"), F.count("*")).first()
    days = [x for t, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate")) for x in later[t].agg(F.min(c).cast("date"), F.max(c).cast("date")).first()]
    assert (first, last) == (dt.date(min(days).year, 1, 1), dt.date(max(days).year, 12, 31))
    assert n == (last - first).days + 1
    flights = star.fact_flight_occupancy.count()
    assert flights and star.occupancy_by_route.agg(F.sum("flights")).first()[0] == flights
    assert star.cancellation_patterns.agg(F.sum("reservations")).first()[0] == star.fact_reservation_lifecycle.count()
