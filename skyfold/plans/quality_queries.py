"""Driver queries of the data-quality jobs (phase 5)."""

from __future__ import annotations

from skyfold.operators import quality as Q
from skyfold.plans.catalog import register
from skyfold.plans.star import Star
from skyfold.sources.fixtures import FlightModel

MODEL_TABLES = ("airport", "route", "scheduled_flight", "flight_instance", "flight_inventory", "fare", "agency",
                "reservation", "reservation_passenger", "itinerary", "itinerary_segment", "ticket", "ancillary",
                "aircraft", "payment_event")


def model_tables(m: FlightModel) -> dict:
    return {t: getattr(m, t) for t in MODEL_TABLES}


@register("dq_range_checks", "table_name:s rule:s rows_checked:i violations:i")
def q_dq_range_checks(spark, sf_dir):
    return Q.dq_range_checks(model_tables(FlightModel.shared(spark, sf_dir)))


@register("dq_enum_checks", "table_name:s rule:s rows_checked:i violations:i")
def q_dq_enum_checks(spark, sf_dir):
    return Q.dq_enum_checks(model_tables(FlightModel.shared(spark, sf_dir)))


@register("dq_unique_checks", "table_name:s key_name:s duplicate_keys:i duplicate_rows:i")
def q_dq_unique_checks(spark, sf_dir):
    return Q.dq_unique_checks(model_tables(FlightModel.shared(spark, sf_dir)))


@register("dq_foreign_keys", "fk_name:s child_table:s parent_table:s orphans:i")
def q_dq_foreign_keys(spark, sf_dir):
    return Q.dq_foreign_keys(model_tables(FlightModel.shared(spark, sf_dir)))


@register("star_vs_source", "flight_key:i source_tickets:n source_total:d source_seats:n star_tickets:n "
                            "star_total:d star_seats:n is_match:b")
def q_star_vs_source(spark, sf_dir):
    m = FlightModel.shared(spark, sf_dir)
    return Q.star_vs_source(m.ticket, m.itinerary_segment, m.ancillary, Star(m).fact_ticket_sale)
