"""Driver queries of the star build: dimensions, facts and marts (phases 1–2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyfold.plans.catalog import register
from skyfold.plans.star import Star
from skyfold.sources.fixtures import FlightModel


def star(spark: SparkSession, sf_dir: str) -> Star:
    return Star(FlightModel.shared(spark, sf_dir))


@register("dim_date", "date_key:i full_date:D year:i quarter:i month:i month_name:s day:i "
                      "day_of_week:i day_name:s is_weekend:b is_high_season:b")
def q_dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star(spark, sf_dir).dim_date


@register("dim_route", "route_key:i origin_iata:s origin_city:s destination_iata:s destination_city:s "
                       "route_label:s distance_km:i distance_band:s")
def q_dim_route(spark, sf_dir):
    return star(spark, sf_dir).dim_route


@register("dim_fare", "fare_key:i fare_class_code:s fare_class_name:s cabin_code:s cabin_name:s rule_name:s "
                      "min_advance_days:i is_refundable:b is_changeable:b")
def q_dim_fare(spark, sf_dir):
    return star(spark, sf_dir).dim_fare


@register("dim_flight", "flight_key:i flight_number:s route_key:i departure_date_key:i departure_utc:t "
                        "aircraft_model:s aircraft_registration:s flight_status:s")
def q_dim_flight(spark, sf_dir):
    return star(spark, sf_dir).dim_flight


@register("dim_channel", "channel_key:i channel:s agency_name:s is_indirect:b")
def q_dim_channel(spark, sf_dir):
    return star(spark, sf_dir).dim_channel


@register("fact_ticket_sale", "ticket_key:i ticket_number:s flight_key:i route_key:i fare_key:i channel_key:i "
                              "issue_date_key:i departure_date_key:i fare_amount:d tax_amount:d discount_amount:d "
                              "commission_amount:d ancillary_amount:d total_amount:d seats:i "
                              "days_before_departure:i currency:s ticket_status:s is_cancelled:b reservation_pnr:s")
def q_fact_ticket_sale(spark, sf_dir):
    return star(spark, sf_dir).fact_ticket_sale


@register("fact_flight_occupancy", "flight_key:i cabin_code:s route_key:i departure_date_key:i capacity:i "
                                   "seats_sold:i seats_held:i load_factor:d revenue_amount:d revenue_per_seat:d")
def q_fact_flight_occupancy(spark, sf_dir):
    return star(spark, sf_dir).fact_flight_occupancy


@register("fact_reservation_lifecycle", "reservation_key:i pnr:s channel_key:i route_key:n created_date_key:i "
                                        "departure_date_key:n final_status:s passengers:i segments:i total_amount:d "
                                        "currency:s minutes_to_confirm:n minutes_to_cancel:n "
                                        "days_before_departure_at_cancel:n was_held:b was_confirmed:b "
                                        "was_cancelled:b expired_without_payment:b event_count:i")
def q_fact_reservation_lifecycle(spark, sf_dir):
    return star(spark, sf_dir).fact_reservation_lifecycle


@register("occupancy_by_route", "route_label:s origin_city:s destination_city:s year:i month:i is_high_season:b "
                                "cabin_code:s flights:i seats_offered:i seats_sold:i avg_load_factor_pct:d revenue:d")
def q_occupancy_by_route(spark, sf_dir):
    return star(spark, sf_dir).occupancy_by_route


@register("revenue_by_fare", "cabin_name:s fare_class_code:s fare_class_name:s rule_name:s min_advance_days:i "
                             "year:i month:i tickets:i seats:i fare_revenue:d tax_collected:d ancillary_revenue:d "
                             "commissions_paid:d total_revenue:d avg_fare:d avg_days_before_departure:d")
def q_revenue_by_fare(spark, sf_dir):
    return star(spark, sf_dir).revenue_by_fare


@register("cancellation_patterns", "channel:s agency_name:s route_label:s year:i month:i reservations:i "
                                   "cancelled:i expired_unpaid:i cancellation_rate_pct:d avg_minutes_to_confirm:d "
                                   "avg_days_before_dep_at_cancel:d cancelled_value:d")
def q_cancellation_patterns(spark, sf_dir):
    return star(spark, sf_dir).cancellation_patterns


@register("lead_time_by_class", "fare_class_code:s rule_name:s min_advance_days:i tickets:i "
                                "avg_days_before_departure:d min_days_before_departure:i max_days_before_departure:i")
def q_lead_time_by_class(spark, sf_dir):
    return star(spark, sf_dir).lead_time_by_class


@register("first_status_times", "reservation_id:i held_at:t confirmed_at:t cancelled_at:t expired_at:t event_count:i")
def q_first_status_times(spark, sf_dir):
    from skyfold.operators.facts import first_status_times
    return first_status_times(FlightModel.shared(spark, sf_dir).reservation_event)


@register("trip_summary", "reservation_id:i route_id:i first_departure:D segments:i")
def q_trip_summary(spark, sf_dir):
    from skyfold.operators.facts import trip_summary
    m = FlightModel.shared(spark, sf_dir)
    return trip_summary(m.itinerary, m.itinerary_segment, m.flight_instance, m.scheduled_flight)
