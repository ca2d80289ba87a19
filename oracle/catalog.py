"""Oracle SQL per registered driver query, shaped like the Spark output."""

from __future__ import annotations

from oracle import extensions, inventory, model, quality, reservations, search, sinks, star, streaming  # noqa: F401,E501
from oracle.model import CTES, with_model

_DUCK_CAST = {"i": "BIGINT", "n": "DOUBLE", "d": "DOUBLE", "s": "VARCHAR", "b": "BOOLEAN"}

# name -> (final relation, extra CTEs as (name, sql, deps))
SOURCES: dict[str, tuple[str, list[tuple[str, str, tuple[str, ...]]]]] = {}


def oracle(name: str, relation: str | None = None, extra=()) -> None:
    SOURCES[name] = (relation or name, list(extra))


def shaped_sql(name: str, cols: list[tuple[str, str]]) -> str:
    relation, extra = SOURCES[name]
    sel = []
    for c, kind in cols:
        if kind == "t":
            sel.append(f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}")
        elif kind == "D":
            sel.append(f"strftime({c}, '%Y-%m-%d') AS {c}")
        else:
            sel.append(f"CAST({c} AS {_DUCK_CAST[kind]}) AS {c}")
    body = f"SELECT {', '.join(sel)} FROM {relation}"
    uses = [relation] if relation in CTES else []
    return with_model(body, uses, extra)


for _n in ("dim_date", "dim_route", "dim_fare", "dim_flight", "dim_channel", "fact_ticket_sale",
           "fact_flight_occupancy", "fact_reservation_lifecycle", "occupancy_by_route", "revenue_by_fare",
           "cancellation_patterns", "lead_time_by_class",
           "flight_availability", "available_flights", "cheapest_eligible_fare", "one_stop_connections",
           "search_direct", "search_one_stop", "search_two_stop", "search_offers", "next_sellable_flight", "two_stop_connections",
           "seat_map_seats", "seat_map_capacity", "materialize_flights", "assign_aircraft", "flight_inventory_init",
           "fare_grid", "seed_scarcity", "scarce_inventory", "oversell_check", "inventory_reconciliation",
           "inventory_from_events", "inventory_curve", "card_number_scan", "capacity_cut_impact",
           "itinerary_validation", "transition_audit", "expired_holds", "seat_demand", "quote_segments",
           "reservation_total", "issue_tickets", "apply_cancellations", "state_as_of", "dedupe_payments",
           "upsert_passengers", "agency_credit_ledger", "expire_holds", "unknown_flights", "reservation_by_name",
           "request_latency_summary", "pnr_assign",
           "dq_range_checks", "dq_enum_checks", "dq_unique_checks", "dq_foreign_keys", "star_vs_source",
           "incremental_tickets", "watermark_advance", "upsert_occupancy", "insert_if_absent_channel",
           "star_row_counts", "catalog_report", "etl_run_log",
           "stream_status_counts", "stream_payment_dedup", "stream_ticket_fact", "stream_hold_expiry", "stream_reservation_state",
           "agency_settlement", "refund_due", "anonymise_passengers", "payment_reconciliation",
           "offer_documents", "reservation_document",
           "seat_map_status", "first_status_times", "trip_summary", "flexible_dates"):
    oracle(_n)
