"""Driver queries of the reservation-state jobs (phase 5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyfold.functions import exprs as X
from skyfold.operators import facts
from skyfold.operators import reservations as R
from skyfold.operators import search as S
from skyfold.plans.catalog import register
from skyfold.sources.fixtures import CURRENCY, DEFAULT_AS_OF, FlightModel

NOW = f"{DEFAULT_AS_OF} 00:00:00"
EVENT_AS_OF = "2024-01-16 00:00:00"


def _seats(m: FlightModel):
    return facts.seated_passengers(m.reservation, m.reservation_passenger)


def _flights(m: FlightModel):
    return (m.flight_instance.select("flight_instance_id", "scheduled_flight_id", "status", "departure_utc", "arrival_utc")
            .join(m.scheduled_flight.select("scheduled_flight_id", "route_id"), "scheduled_flight_id")
            .join(m.route.select("route_id", "origin_iata", "destination_iata"), "route_id"))


@register("itinerary_validation", "itinerary_id:i segments:i failed_sequence_no:n result:s")
def q_itinerary_validation(spark, sf_dir):
    m = FlightModel.shared(spark, sf_dir)
    return R.itinerary_validation(m.itinerary_segment, _flights(m), m.airport, NOW)


@register("transition_audit", "event_id:i reservation_id:i previous_status:s from_status:s to_status:s "
                              "from_matches:b is_legal:b")
def q_transition_audit(spark, sf_dir):
    return R.transition_audit(FlightModel.shared(spark, sf_dir).reservation_event)


@register("expired_holds", "reservation_id:i pnr:s hold_expires_at:t")
def q_expired_holds(spark, sf_dir):
    return R.expired_holds(FlightModel.shared(spark, sf_dir).reservation, NOW)


@register("seat_demand", "reservation_id:i flight_instance_id:i cabin_code:s demand:i")
def q_seat_demand(spark, sf_dir):
    m = FlightModel.shared(spark, sf_dir)
    return R.seat_demand(m.itinerary_segment, m.itinerary, _seats(m))


def _quote_requests(m: FlightModel):
    held = m.reservation.where(F.col("status") == "HELD").select("reservation_id", "agency_id", "created_at")
    seg = m.itinerary_segment.select("segment_id", F.col("itinerary_id").alias("reservation_id"),
                                     "flight_instance_id", "cabin_code", "fare_class_code")
    return (seg.join(held, "reservation_id")
            .select("reservation_id", "segment_id", "flight_instance_id", "cabin_code",
                    F.when(F.col("segment_id") % 2 == 0, F.col("fare_class_code")).alias("fare_class_code"),
                    F.lit(CURRENCY).alias("currency"), F.to_date("created_at").alias("as_of"), "agency_id"))


def _quotes(m: FlightModel):
    avail = S.flight_availability(m.flight_instance, m.scheduled_flight, m.route, m.flight_inventory)
    return R.quote_segments(_quote_requests(m), avail, m.fare, m.fare_class, m.fare_rule, m.agency)


@register("quote_segments", "reservation_id:i segment_id:i fare_id:n base_amount:d net_fare:d tax_amount:d reason:s")
def q_quote_segments(spark, sf_dir):
    return _quotes(FlightModel.shared(spark, sf_dir))


@register("reservation_total", "reservation_id:i total_amount:d quoted_segments:i")
def q_reservation_total(spark, sf_dir):
    m = FlightModel.shared(spark, sf_dir)
    return R.reservation_total(_quotes(m), _seats(m))


@register("seat_admission", "request_id:i requested_at:t accepted:b decided_round:i legs:i seats:i")
def q_seat_admission(spark, sf_dir):
    """Held orders compete, in arrival order, for the seats left after sales."""
    m = FlightModel.shared(spark, sf_dir)
    inv = m.flight_inventory
    remaining = inv.select("flight_instance_id", "cabin_code",
                           (X.sellable_capacity("capacity", "oversell_factor") - F.col("seats_sold")).alias("remaining"))
    return R.seat_admission(m.admission_requests, remaining)


@register("issue_tickets", "ticket_number:s reservation_id:i passenger_ref:i segment_id:i fare_id:i fare_amount:d "
                           "tax_amount:d commission_amount:d")
def q_issue_tickets(spark, sf_dir):
    m = FlightModel.shared(spark, sf_dir)
    return R.issue_tickets(m.reservation, m.itinerary_segment, m.itinerary, m.reservation_passenger, m.agency)


def _cancel_requests(m: FlightModel):
    """Reservations whose log has a cancel event ask for the whole reservation; of those divisible by 3
    each single itinerary with an odd number is asked for instead, by a request of its own."""
    ev = m.reservation_event.where(F.col("to_status") == "CANCELLED").select("reservation_id").distinct()
    whole = ev.where("reservation_id % 3 != 0").withColumn("itinerary_id", F.lit(None).cast("bigint"))
    it = m.itinerary.where("sequence_no % 2 = 1").select("reservation_id", "itinerary_id")
    return whole.unionByName(ev.where("reservation_id % 3 = 0").join(it, "reservation_id"))


@register("apply_cancellations", "reservation_id:i previous_status:s new_status:s itineraries_cancelled:i segments_cancelled:i "
                                 "seats_released:i released_from:s credit_returned:d")
def q_apply_cancellations(spark, sf_dir):
    m = FlightModel.shared(spark, sf_dir)
    return R.apply_cancellations(_cancel_requests(m), m.reservation, m.itinerary, m.itinerary_segment, _seats(m))


@register("state_as_of", "reservation_id:i status:s since:t status_events:i")
def q_state_as_of(spark, sf_dir):
    return R.state_as_of(FlightModel.shared(spark, sf_dir).reservation_event, EVENT_AS_OF)


@register("dedupe_payments", "psp_event_id:s payment_event_id:i payment_id:i received_at:t deliveries:i")
def q_dedupe_payments(spark, sf_dir):
    return R.dedupe_payments(FlightModel.shared(spark, sf_dir).payment_event)


@register("upsert_passengers", "document_type:s document_number:s passenger_id:i first_name:s last_name:s email:s "
                               "birth_date:D phone:s versions:i")
def q_upsert_passengers(spark, sf_dir):
    return R.upsert_passengers(FlightModel.shared(spark, sf_dir).passenger)


@register("agency_credit_ledger", "agency_id:i reservation_id:i entry_at:t kind:i amount:d credit_used:d is_breach:b")
def q_agency_credit_ledger(spark, sf_dir):
    m = FlightModel.shared(spark, sf_dir)
    return R.agency_credit_ledger(m.agency_reservation, m.agency)


@register("expire_holds", "flight_instance_id:i cabin_code:s capacity:i seats_sold:i seats_held_before:i "
                          "held_released:i seats_held:i")
def q_expire_holds(spark, sf_dir):
    m = FlightModel.shared(spark, sf_dir)
    return R.expire_holds(m.reservation, m.itinerary_segment, m.itinerary, m.flight_inventory, _seats(m), NOW)


@register("unknown_flights", "flight_instance_id:i cabin_code:s reason:s")
def q_unknown_flights(spark, sf_dir):
    """Every segment's flight asked in both cabins."""
    m = FlightModel.shared(spark, sf_dir)
    req = (m.itinerary_segment.select("flight_instance_id")
           .withColumn("cabin_code", F.explode(F.array(F.lit("BUS"), F.lit("ECO")))))
    return R.unknown_flights(req, m.flight_instance, m.flight_inventory)


def _name_lookups(m: FlightModel):
    r = m.reservation.select("reservation_id", "pnr", "contact_email")
    o = m._orders.select(F.col("o_orderkey").alias("reservation_id"), "c_name")
    j = r.join(o, "reservation_id")
    good = j.where(F.col("reservation_id") % 3 == 0).select(
        F.concat(F.lit(" "), F.lower("pnr")).alias("pnr"), F.concat(F.lower("c_name"), F.lit("  ")).alias("last_name"))
    bad = j.where(F.col("reservation_id") % 3 == 1).select(
        "pnr", F.concat(F.col("c_name"), F.lit("X")).alias("last_name"))
    return good.unionByName(bad)


@register("reservation_by_name", "pnr:s reservation_id:i status:s")
def q_reservation_by_name(spark, sf_dir):
    m = FlightModel.shared(spark, sf_dir)
    return R.reservation_by_name(_name_lookups(m), m.reservation, m.reservation_passenger, m.passenger)


@register("reservation_document", "reservation_id:i pnr:s status:s document:s")
def q_reservation_document(spark, sf_dir):
    m = FlightModel.shared(spark, sf_dir)
    d = R.reservation_document(m.reservation, m.reservation_passenger, m.passenger, m.itinerary,
                               m.itinerary_segment, m.ticket)
    return d.withColumn("document", F.to_json(F.struct("passengers", "itineraries", "tickets")))


@register("pnr_assign", "reservation_id:i pnr:s salt:i")
def q_pnr_assign(spark, sf_dir):
    return R.pnr_assign(FlightModel.shared(spark, sf_dir).reservation)


@register("request_latency_summary", "day:D created:i rejected:i errors:i requests:i p50_ms:d p95_ms:d max_ms:d")
def q_request_latency_summary(spark, sf_dir):
    """Events read as a request log: purchase = created, error = error,
    anything else = rejected; value = latency in ms; one summary per day."""
    e = FlightModel.shared(spark, sf_dir)._src("events")
    log = e.select(F.to_date("ts").alias("day"),
                   F.when(F.col("event_type") == "purchase", F.lit("created"))
                   .when(F.col("event_type") == "error", F.lit("error")).otherwise(F.lit("rejected")).alias("outcome"),
                   F.col("value").alias("latency_ms"))
    return R.request_latency_summary(log, ["day"])
