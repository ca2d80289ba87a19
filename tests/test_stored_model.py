"""A shared model writes the relations that a job reads, and no others."""

import os

from skyfold.sources.fixtures import FlightModel, StoredModel
from tests.conftest import SF_SMALL


def _written(folder):
    return sorted(n.rsplit("-", 1)[0] for n in os.listdir(folder)) if os.path.exists(folder) else []


def test_only_relations_that_are_read_are_written(spark, tmp_path):
    folder = str(tmp_path / "stored")
    m = StoredModel(spark, SF_SMALL, folder)
    assert m.aircraft.count() > 0 and _written(folder) == []
    assert m.flight_instance.count() > 0 and _written(folder) == ["flight_base"]
    m.ticket, m.itinerary_segment, m.ancillary
    assert _written(folder) == ["flight_base", "lines", "orders"]


def test_stored_relations_equal_derived_ones(spark, tmp_path):
    stored, derived = StoredModel(spark, SF_SMALL, str(tmp_path / "stored")), FlightModel(spark, SF_SMALL)
    for name in FlightModel.SNAPSHOT:
        a, b = getattr(stored, name), getattr(derived, name)
        assert a.columns == b.columns and a.count() == b.count() and a.exceptAll(b).isEmpty(), name


def test_requests_equal_those_joined_from_schedules_and_routes(spark):
    m = FlightModel(spark, SF_SMALL)
    r = m.route.select("route_id", "origin_iata", "destination_iata")
    sf = m.scheduled_flight.select("scheduled_flight_id", "route_id")
    want = (m.lines.select("ticket_id", "flight_instance_id", "cabin_code").join(m.flight_instance, "flight_instance_id")
            .join(sf, "scheduled_flight_id").join(r, "route_id")
            .selectExpr("ticket_id request_id", "origin_iata origin", "destination_iata destination", "flight_date", "cabin_code"))
    got = m.search_requests.select(*want.columns)
    assert got.count() == want.count() > 0 and got.exceptAll(want).isEmpty()


def test_written_copies_are_packed_by_zstd(spark, tmp_path):
    model = StoredModel(spark, SF_SMALL, str(tmp_path))
    assert model.agency.count() == FlightModel(spark, SF_SMALL).agency.count()
    files = [f.name for f in tmp_path.rglob("part-*.parquet")]
    assert files and all(".zstd." in f for f in files)


def test_the_credit_ledger_joins_and_writes_agency_reservations_only(spark, tmp_path, monkeypatch):
    from skyfold.operators.reservations import agency_credit_ledger
    from skyfold.plans import reservation_queries as Q
    from skyfold.plans.catalog import columns, shaped
    folder = str(tmp_path / "stored")
    m, plain = StoredModel(spark, SF_SMALL, folder), FlightModel(spark, SF_SMALL)
    monkeypatch.setattr(Q.FlightModel, "shared", classmethod(lambda *_: m))
    got = Q.q_agency_credit_ledger(spark, SF_SMALL)
    want = shaped(agency_credit_ledger(plain.reservation, plain.agency), columns("agency_credit_ledger"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() > 0
    assert _written(folder) == ["agency", "agency_reservation"]
