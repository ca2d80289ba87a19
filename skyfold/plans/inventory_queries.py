"""Driver queries of seat maps, materialisation and inventory (phases 4–5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyfold.operators import inventory as I
from skyfold.operators import search as S
from skyfold.plans.catalog import register
from skyfold.sources.fixtures import DEFAULT_AS_OF, FlightModel

INV_COLS = "flight_instance_id:i cabin_code:s capacity:i seats_sold:i seats_held:i"


def _fleet_seats(m: FlightModel):
    seats = I.seat_map_seats(I.seat_layouts(m.spark))
    return m.aircraft.select("aircraft_id", "seat_map_id").join(F.broadcast(seats), "seat_map_id")


def _materialized(m: FlightModel):
    return I.materialize_flights(m.scheduled_flight, m.route, m.airport, m.aircraft, DEFAULT_AS_OF)


@register("seat_map_seats", "aircraft_id:i seat_map_id:i seat_number:s cabin_code:s row_num:i seat_letter:s "
                            "is_window:b is_aisle:b is_exit_row:b")
def q_seat_map_seats(spark, sf_dir):
    """Seat inventory of the whole fleet: each aircraft's seat map, row × letter."""
    return _fleet_seats(FlightModel.shared(spark, sf_dir))


@register("seat_map_capacity", "aircraft_id:i seat_map_id:i cabin_code:s capacity:i")
def q_seat_map_capacity(spark, sf_dir):
    seats = _fleet_seats(FlightModel.shared(spark, sf_dir))
    return seats.groupBy("aircraft_id", "seat_map_id", "cabin_code").agg(F.count(F.lit(1)).alias("capacity"))


@register("materialize_flights", "flight_instance_id:i scheduled_flight_id:i flight_date:D departure_utc:t "
                                 "arrival_utc:t aircraft_id:n status:s")
def q_materialize_flights(spark, sf_dir):
    return _materialized(FlightModel.shared(spark, sf_dir))


@register("assign_aircraft", "scheduled_flight_id:i flight_date:D aircraft_id:n")
def q_assign_aircraft(spark, sf_dir):
    return _materialized(FlightModel.shared(spark, sf_dir))


@register("flight_inventory_init", "flight_instance_id:i cabin_code:s capacity:i seats_sold:i seats_held:i")
def q_flight_inventory_init(spark, sf_dir):
    m = FlightModel.shared(spark, sf_dir)
    cap = I.seat_map_capacity(I.seat_map_seats(I.seat_layouts(spark)))
    return I.flight_inventory_init(_materialized(m), cap)


@register("fare_grid", "fare_id:i route_id:i fare_class_code:s fare_rule_id:i base_amount:d tax_pct:d")
def q_fare_grid(spark, sf_dir):
    m = FlightModel.shared(spark, sf_dir)
    return I.fare_grid(m.route, "1995-01-01", "2001-12-31")


@register("seed_scarcity", INV_COLS)
def q_seed_scarcity(spark, sf_dir):
    """Leave one seat on the next sellable flight of each cabin; whole inventory out."""
    m = FlightModel.shared(spark, sf_dir)
    targets = S.next_sellable_flight(m.flight_instance, m.flight_inventory, DEFAULT_AS_OF)
    return I.seed_scarcity(m.flight_inventory, targets, 1)


@register("scarce_inventory", "flight_instance_id:i cabin_code:s capacity:i seats_sold:i seats_held:i "
                              "seats_available:i")
def q_scarce_inventory(spark, sf_dir):
    m = FlightModel.shared(spark, sf_dir)
    avail = S.flight_availability(m.flight_instance, m.scheduled_flight, m.route, m.flight_inventory)
    return I.scarce_inventory(avail, 1)


@register("oversell_check", "flight_instance_id:i cabin_code:s capacity:i seats_sold:i seats_held:i committed:i")
def q_oversell_check(spark, sf_dir):
    return I.oversell_check(FlightModel.shared(spark, sf_dir).flight_inventory)


@register("inventory_reconciliation", "flight_instance_id:i cabin_code:s seats_sold:i seats_held:i "
                                      "actual_confirmed:i actual_held:i is_mismatch:b")
def q_inventory_reconciliation(spark, sf_dir):
    m = FlightModel.shared(spark, sf_dir)
    committed = I.committed_seats(m.itinerary_segment, m.itinerary, m.reservation)
    return I.inventory_reconciliation(m.flight_inventory, committed)


@register("inventory_from_events", "flight_instance_id:i cabin_code:s seats_held:i seats_sold:i is_negative:b")
def q_inventory_from_events(spark, sf_dir):
    m = FlightModel.shared(spark, sf_dir)
    return I.inventory_from_events(m.reservation_event, m.itinerary_segment, m.itinerary)


@register("inventory_curve", "flight_instance_id:i cabin_code:s occurred_at:t seats_held:i seats_sold:i lowest_held:i "
                             "lowest_sold:i dipped:b")
def q_inventory_curve(spark, sf_dir):
    m = FlightModel.shared(spark, sf_dir)
    return I.inventory_curve(m.reservation_event, m.itinerary_segment, m.itinerary)


@register("capacity_cut_impact", "flight_instance_id:i cabin_code:s seat_map_id:i old_capacity:i new_capacity:i "
                                 "committed:i seats_to_reaccommodate:i")
def q_capacity_cut_impact(spark, sf_dir):
    m = FlightModel.shared(spark, sf_dir)
    cap = I.seat_map_capacity(I.seat_map_seats(I.seat_layouts(spark)))
    return I.capacity_cut_impact(m.flight_inventory, m.flight_instance, m.scheduled_flight, cap)


@register("seat_map_status", "flight_instance_id:i cabin_code:s seat_number:s seat_rank:i status:s ticket_id:n")
def q_seat_map_status(spark, sf_dir):
    """Seat status of every flight: seats go to the issued tickets of
    confirmed reservations in ticket order, what exceeds the map is UNSEATED."""
    m = FlightModel.shared(spark, sf_dir)
    seats = I.seat_map_seats(I.seat_layouts(spark))
    taken = (m.ticket.where(F.col("status") != "CANCELLED").select("ticket_id", "segment_id", "reservation_id", "seats")
             .join(m.reservation.where(F.col("status") == "CONFIRMED").select("reservation_id"), "reservation_id")
             .join(m.itinerary_segment.select("segment_id", "flight_instance_id", "cabin_code"), "segment_id"))
    return I.seat_map_status(m.flight_instance, m.scheduled_flight, seats, taken)
