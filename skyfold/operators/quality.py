"""Declared constraints of the operational model as data-quality jobs.

Q1 dq_range_checks, Q2 dq_enum_checks, Q3 dq_unique_checks,
Q4 dq_foreign_keys, Q5 star_vs_source.

Each table is scanned once for all its row rules (one aggregate of
``count(when(rule is false))``). A CHECK passes when its predicate is TRUE
or NULL, so only FALSE counts as a violation.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The row constraints and enumerations the schema declares.
# (table, rule name, SQL predicate that must not be FALSE)
# ---------------------------------------------------------------------------
RANGE_RULES = [
    ("airport", "mct_0_480", "min_connection_min BETWEEN 0 AND 480"),
    ("route", "distance_positive", "distance_km > 0"),
    ("route", "origin_not_destination", "origin_iata <> destination_iata"),
    ("scheduled_flight", "day_offset_0_1", "arrival_day_offset IN (0, 1)"),
    ("scheduled_flight", "validity_order", "valid_to >= valid_from"),
    ("flight_instance", "arrival_after_departure", "arrival_utc > departure_utc"),
    ("flight_inventory", "capacity_non_negative", "capacity >= 0"),
    ("flight_inventory", "factor_1_to_1_5", "oversell_factor >= 1.00 AND oversell_factor <= 1.50"),
    ("flight_inventory", "counters_non_negative", "seats_sold >= 0 AND seats_held >= 0"),
    ("fare", "base_non_negative", "base_amount >= 0"),
    ("fare", "validity_order", "valid_to >= valid_from"),
    ("agency", "discount_pct_0_100", "net_fare_discount_pct BETWEEN 0 AND 100"),
    ("agency", "commission_pct_0_100", "commission_pct BETWEEN 0 AND 100"),
    ("agency", "credit_within_limit", "credit_used <= credit_limit"),
    ("reservation", "total_non_negative", "total_amount >= 0"),
    ("reservation", "hold_has_expiry", "(status = 'HELD' AND hold_expires_at IS NOT NULL) OR (status <> 'HELD')"),
    ("reservation", "b2b_iff_agency", "(channel = 'B2B' AND agency_id IS NOT NULL) OR (channel <> 'B2B' AND agency_id IS NULL)"),
    ("itinerary_segment", "quoted_non_negative", "quoted_fare_amount >= 0 AND quoted_tax_amount >= 0"),
    ("ticket", "amounts_non_negative",
     "fare_amount >= 0 AND tax_amount >= 0 AND discount_amount >= 0 AND commission_amount >= 0"),
    ("ancillary", "amount_non_negative", "amount >= 0"),
]

ENUM_RULES = [
    ("aircraft", "status", ("ACTIVE", "MAINTENANCE", "RETIRED")),
    ("flight_instance", "status", ("SCHEDULED", "DELAYED", "DEPARTED", "ARRIVED", "CANCELLED")),
    ("reservation", "channel", ("WEB", "B2B", "COUNTER")),
    ("reservation", "status", ("HELD", "CONFIRMED", "CANCELLED", "EXPIRED")),
    ("reservation_passenger", "passenger_type", ("ADT", "CHD", "INF")),
    ("itinerary", "status", ("ACTIVE", "CANCELLED")),
    ("itinerary_segment", "status", ("ACTIVE", "CANCELLED")),
    ("ticket", "status", ("ISSUED", "USED", "CANCELLED", "REFUNDED")),
    ("ancillary", "status", ("ACTIVE", "CANCELLED", "REFUNDED")),
]

# (table, key name, key columns)
UNIQUE_KEYS = [
    ("airport", "pk", ("iata_code",)),
    ("route", "pk", ("route_id",)),
    ("route", "origin_destination", ("origin_iata", "destination_iata")),
    ("flight_instance", "pk", ("flight_instance_id",)),
    ("flight_inventory", "pk", ("flight_instance_id", "cabin_code")),
    ("fare", "pk", ("fare_id",)),
    ("reservation", "pk", ("reservation_id",)),
    ("reservation", "pnr", ("pnr",)),
    ("reservation_passenger", "pk", ("reservation_id", "passenger_ref")),
    ("itinerary_segment", "pk", ("segment_id",)),
    ("ticket", "pk", ("ticket_id",)),
    ("ticket", "ticket_number", ("ticket_number",)),
    ("ticket", "segment_reservation_passenger", ("segment_id", "reservation_id", "passenger_ref")),
    ("payment_event", "psp_event_id", ("psp_event_id",)),
]

# (name, child table, child columns, parent table, parent columns)
FOREIGN_KEYS = [
    ("route_origin", "route", ("origin_iata",), "airport", ("iata_code",)),
    ("route_destination", "route", ("destination_iata",), "airport", ("iata_code",)),
    ("instance_schedule", "flight_instance", ("scheduled_flight_id",), "scheduled_flight", ("scheduled_flight_id",)),
    ("instance_aircraft", "flight_instance", ("aircraft_id",), "aircraft", ("aircraft_id",)),
    ("fare_route", "fare", ("route_id",), "route", ("route_id",)),
    ("reservation_agency", "reservation", ("agency_id",), "agency", ("agency_id",)),
    ("segment_inventory", "itinerary_segment", ("flight_instance_id", "cabin_code"),
     "flight_inventory", ("flight_instance_id", "cabin_code")),
    ("ticket_passenger", "ticket", ("reservation_id", "passenger_ref"),
     "reservation_passenger", ("reservation_id", "passenger_ref")),
    ("ticket_segment", "ticket", ("segment_id",), "itinerary_segment", ("segment_id",)),
]
# ---------------------------------------------------------------------------


def _violation(pred: str) -> F.Column:
    return F.count(F.when(~F.coalesce(F.expr(f"({pred})"), F.lit(True)), F.lit(1)))


def _per_table(tables: Mapping[str, DataFrame], rules: list[tuple[str, str, str]]) -> DataFrame:
    by_table: dict[str, list[tuple[str, str]]] = {}
    for t, name, pred in rules:
        by_table.setdefault(t, []).append((name, pred))
    parts = []
    for t, rs in by_table.items():
        agg = tables[t].agg(F.count(F.lit(1)).alias("rows_checked"),
                            *[_violation(p).alias(f"v{i}") for i, (_, p) in enumerate(rs)])
        stack = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"v{i}").alias("violations"))
                                    for i, (n, _) in enumerate(rs)]))
        parts.append(agg.select(F.lit(t).alias("table_name"), "rows_checked", stack.alias("r"))
                     .select("table_name", "r.rule", "rows_checked", "r.violations"))
    return reduce(DataFrame.unionByName, parts)


# Q1
def dq_range_checks(tables: Mapping[str, DataFrame], rules=RANGE_RULES) -> DataFrame:
    return _per_table(tables, rules)


def enum_predicates(rules=ENUM_RULES) -> list[tuple[str, str, str]]:
    return [(t, c, f"{c} IN ({', '.join(repr(v) for v in vals)})") for t, c, vals in rules]


# Q2
def dq_enum_checks(tables: Mapping[str, DataFrame], rules=ENUM_RULES) -> DataFrame:
    return _per_table(tables, enum_predicates(rules))


# Q3
def dq_unique_checks(tables: Mapping[str, DataFrame], keys=UNIQUE_KEYS) -> DataFrame:
    """Per declared key: keys that occur more than once and the rows in them.
    NULL key parts never conflict (SQL UNIQUE), so they are left out."""
    parts = []
    for t, name, cols in keys:
        df = tables[t].select(*cols)
        df = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))
        g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
        parts.append(g.agg(F.count(F.when(F.col("n") > 1, 1)).alias("duplicate_keys"),
                           F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("duplicate_rows"))
                     .select(F.lit(t).alias("table_name"), F.lit(name).alias("key_name"),
                             "duplicate_keys", "duplicate_rows"))
    return reduce(DataFrame.unionByName, parts)


# Q4
def dq_foreign_keys(tables: Mapping[str, DataFrame], fks=FOREIGN_KEYS) -> DataFrame:
    """Child rows whose (non-null) key has no parent row."""
    parts = []
    for name, child, ccols, parent, pcols in fks:
        c = tables[child].select(*[F.col(a).alias(f"_k{i}") for i, a in enumerate(ccols)])
        c = c.where(reduce(lambda a, b: a & b, [F.col(f"_k{i}").isNotNull() for i in range(len(ccols))]))
        p = tables[parent].select(*[F.col(a).alias(f"_k{i}") for i, a in enumerate(pcols)]).distinct()
        orphans = c.join(p, [f"_k{i}" for i in range(len(ccols))], "left_anti")
        parts.append(orphans.agg(F.count(F.lit(1)).alias("orphans"))
                     .select(F.lit(name).alias("fk_name"), F.lit(child).alias("child_table"),
                             F.lit(parent).alias("parent_table"), "orphans"))
    return reduce(DataFrame.unionByName, parts)


# Q5
def star_vs_source(ticket: DataFrame, segment: DataFrame, ancillary: DataFrame, ticket_fact: DataFrame) -> DataFrame:
    """Per flight: ticket count, Σ total and Σ seats from the source tables
    against the ticket fact; a full outer join keeps flights missing on
    either side."""
    anc = (ancillary.where(F.col("status") == "ACTIVE").groupBy("ticket_id")
           .agg(F.sum("amount").alias("_anc")))
    t = ticket.select("ticket_id", "segment_id", "fare_amount", "tax_amount",
                      (F.col("seats") if "seats" in ticket.columns else F.lit(1)).alias("seats"))
    src = (t.join(segment.select("segment_id", "flight_instance_id"), "segment_id")
           .join(anc, "ticket_id", "left")
           .groupBy(F.col("flight_instance_id").alias("flight_key"))
           .agg(F.count(F.lit(1)).alias("source_tickets"),
                F.sum(F.col("fare_amount") + F.col("tax_amount") + F.coalesce("_anc", F.lit(0))).alias("source_total"),
                F.sum("seats").alias("source_seats")))
    star = (ticket_fact.groupBy("flight_key")
            .agg(F.count(F.lit(1)).alias("star_tickets"), F.sum("total_amount").alias("star_total"),
                 F.sum("seats").alias("star_seats")))
    j = src.join(star, "flight_key", "full_outer")
    ok = ((F.coalesce("source_tickets", F.lit(0)) == F.coalesce("star_tickets", F.lit(0)))
          & (F.coalesce("source_total", F.lit(0)) == F.coalesce("star_total", F.lit(0)))
          & (F.coalesce("source_seats", F.lit(0)) == F.coalesce("star_seats", F.lit(0))))
    return j.withColumn("is_match", ok)
