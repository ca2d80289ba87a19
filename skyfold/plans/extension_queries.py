"""Driver queries of the second-wave jobs (phase 7)."""

from __future__ import annotations

from skyfold.operators import extensions as XT
from skyfold.plans.catalog import register
from skyfold.plans.star import Star
from skyfold.sources.fixtures import DEFAULT_AS_OF, FlightModel

ANONYMISE_AS_OF = "2003-01-01"


@register("agency_settlement", "agency_name:s year:i month:i tickets:i sales:d commission:d cancelled_tickets:i "
                               "cancelled_value:d balance_due:d")
def q_agency_settlement(spark, sf_dir):
    s = Star(FlightModel.shared(spark, sf_dir))
    return XT.agency_settlement(s.fact_ticket_sale, s.dim_channel, s.dim_date)


@register("refund_due", "ticket_id:i fare_id:i is_refundable:b paid_amount:d penalty:d refund_amount:d")
def q_refund_due(spark, sf_dir):
    m = FlightModel.shared(spark, sf_dir)
    return XT.refund_due(m.ticket, m.fare, m.fare_rule)


@register("anonymise_passengers", "passenger_id:n first_name:s last_name:s birth_date:D document_type:s "
                                  "document_number:s email:s phone:s last_travel:D is_anonymised:b")
def q_anonymise_passengers(spark, sf_dir):
    m = FlightModel.shared(spark, sf_dir)
    return XT.anonymise_passengers(m.passenger, m.reservation_passenger, m.itinerary_segment, m.itinerary,
                                   m.flight_instance, ANONYMISE_AS_OF)


@register("card_number_scan", "table_name:s column_name:s row_key:s masked:s")
def q_card_number_scan(spark, sf_dir):
    m = FlightModel.shared(spark, sf_dir)
    return XT.card_number_scan({
        "reservation_event": (m.reservation_event, "event_id", ["payload"]),
        "reservation": (m.reservation, "reservation_id", ["contact_email", "pnr"]),
        "passenger": (m.passenger, "passenger_id", ["first_name", "last_name", "email", "phone"]),
    })


@register("payment_reconciliation", "reservation_id:i pnr:s hold_expires_at:t total_amount:d payment_events:i "
                                    "first_payment_at:t")
def q_payment_reconciliation(spark, sf_dir):
    m = FlightModel.shared(spark, sf_dir)
    return XT.payment_reconciliation(m.reservation, m.payment_event, f"{DEFAULT_AS_OF} 00:00:00")
