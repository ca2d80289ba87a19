"""Facts of the star schema and their building blocks.

J4 fact_ticket_sale, J5 ancillary_per_ticket, J6 fact_flight_occupancy,
J7 seated_passengers, J8 passenger_count, J18 fact_reservation_lifecycle,
A1 first_status_times, A2 trip_summary.

Every correlated (LATERAL) aggregate of the reference is written as an
explicit pre-aggregation followed by a left join, so the aggregate is
partially computed map-side before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.functions import exprs as X
from skyfold.operators.dims import with_channel_key

EPOCH = "1970-01-01 00:00:00"


# J5
def ancillary_per_ticket(ancillary: DataFrame) -> DataFrame:
    """SUM of ACTIVE ancillaries per ticket."""
    return (ancillary.where(F.col("status") == "ACTIVE")
            .groupBy("ticket_id").agg(F.sum("amount").alias("ancillary_total")))


# J7
def seated_passengers(reservation: DataFrame, reservation_passenger: DataFrame) -> DataFrame:
    """Non-infant passengers per reservation; a reservation without any counts 0."""
    seated = (reservation_passenger.where(F.col("passenger_type") != "INF")
              .groupBy("reservation_id").agg(F.count(F.lit(1)).alias("_n")))
    return (reservation.select("reservation_id").join(seated, "reservation_id", "left")
            .select("reservation_id", F.coalesce("_n", F.lit(0)).cast("int").alias("seats")))


# J8
def passenger_count(reservation_passenger: DataFrame) -> DataFrame:
    """All passengers (infants included) per reservation."""
    return (reservation_passenger.groupBy("reservation_id")
            .agg(F.count(F.lit(1)).cast("int").alias("passengers")))


def change_time(ticket: DataFrame, mode: str = "latest") -> F.Column:
    """Time used by incremental extraction. ``strict``: issued_at only, as the
    reference (a later cancellation never reaches the fact); ``latest``:
    greatest(issued_at, cancelled_at)."""
    if mode == "strict":
        return F.col("issued_at")
    return F.greatest(F.col("issued_at"), F.coalesce(F.col("cancelled_at"), F.col("issued_at")))


# J4
def fact_ticket_sale(ticket: DataFrame, segment: DataFrame, itinerary: DataFrame,
                     reservation: DataFrame, agency: DataFrame, flight_instance: DataFrame,
                     scheduled_flight: DataFrame, ancillary: DataFrame, channels: DataFrame,
                     watermark: str | None = None, change_mode: str = "latest") -> DataFrame:
    """One row per ticket (passenger × segment). ``watermark`` (exclusive lower
    bound on the change time) gives the incremental extract; None = full."""
    t = ticket
    if watermark is not None:
        t = t.where(change_time(t, change_mode) > F.lit(watermark).cast("timestamp"))
    if "seats" not in t.columns:
        t = t.withColumn("seats", F.lit(1))
    t = t.select("ticket_id", "ticket_number", "segment_id", "reservation_id", "fare_id",
                 "fare_amount", "tax_amount", "discount_amount", "commission_amount", "currency",
                 "status", "issued_at", "seats")
    # Narrow joins first: the ticket rows are dealt out three times only, by segment, reservation and ticket.
    s = segment.select("segment_id", "itinerary_id", "flight_instance_id")
    i = itinerary.select("itinerary_id")
    ag = agency.select("agency_id", F.col("legal_name").alias("agency_name"))
    r = (reservation.select("reservation_id", "pnr", "channel", "agency_id")
         .join(ag, "agency_id", "left").drop("agency_id"))
    r = with_channel_key(r, channels).select("reservation_id", "pnr", "channel_key")
    fi = flight_instance.select("flight_instance_id", "scheduled_flight_id", "flight_date")
    sf = scheduled_flight.select("scheduled_flight_id", "route_id")
    fl = fi.join(sf, "scheduled_flight_id").drop("scheduled_flight_id")
    seg = s.join(i, "itinerary_id").drop("itinerary_id").join(fl, "flight_instance_id")
    anc = ancillary_per_ticket(ancillary)
    j = (t.join(anc, "ticket_id", "left").join(seg, "segment_id").join(r, "reservation_id"))
    anc_amt = F.coalesce(F.col("ancillary_total"), F.lit(0).cast(X.MONEY)).cast(X.MONEY)
    return j.select(
        F.col("ticket_id").alias("ticket_key"), "ticket_number",
        F.col("flight_instance_id").alias("flight_key"), F.col("route_id").alias("route_key"),
        F.col("fare_id").alias("fare_key"), "channel_key",
        X.date_key("issued_at").alias("issue_date_key"),
        X.date_key("flight_date").alias("departure_date_key"),
        "fare_amount", "tax_amount", "discount_amount", "commission_amount",
        anc_amt.alias("ancillary_amount"),
        X.ticket_total("fare_amount", "tax_amount", anc_amt).alias("total_amount"),
        F.col("seats").cast("int").alias("seats"),
        X.days_before_departure("flight_date", "issued_at").alias("days_before_departure"),
        "currency", F.col("status").alias("ticket_status"),
        (F.col("status") == "CANCELLED").alias("is_cancelled"),
        F.col("pnr").alias("reservation_pnr"), "issued_at")


# J6
def flight_revenue(ticket: DataFrame, segment: DataFrame) -> DataFrame:
    """Revenue (fare + tax) of not-cancelled tickets per (flight, cabin),
    aggregated before the join with inventory. REFUNDED still counts."""
    t = ticket.where(F.col("status") != "CANCELLED").select("segment_id", "fare_amount", "tax_amount")
    s = segment.select("segment_id", "flight_instance_id", "cabin_code")
    return (t.join(s, "segment_id").groupBy("flight_instance_id", "cabin_code")
            .agg(F.sum(F.col("fare_amount") + F.col("tax_amount")).alias("revenue")))


def fact_flight_occupancy(inventory: DataFrame, flight_instance: DataFrame, scheduled_flight: DataFrame,
                          ticket: DataFrame, segment: DataFrame, as_of: str,
                          window_days: int = 365) -> DataFrame:
    """One row per cabin of a flight with departure in as_of ± window_days."""
    d0 = F.lit(as_of).cast("date")
    fi = (flight_instance.where(F.col("flight_date").between(F.date_sub(d0, window_days), F.date_add(d0, window_days)))
          .select("flight_instance_id", "scheduled_flight_id", "flight_date"))
    sf = scheduled_flight.select("scheduled_flight_id", "route_id")
    rev = flight_revenue(ticket, segment)
    j = (inventory.join(fi, "flight_instance_id").join(sf, "scheduled_flight_id")
         .join(rev, ["flight_instance_id", "cabin_code"], "left"))
    revenue = F.coalesce(F.col("revenue"), F.lit(0)).cast(X.MONEY_TOTAL)
    return j.select(
        F.col("flight_instance_id").alias("flight_key"), "cabin_code",
        F.col("route_id").alias("route_key"), X.date_key("flight_date").alias("departure_date_key"),
        "capacity", "seats_sold", "seats_held",
        X.load_factor("seats_sold", "capacity").alias("load_factor"),
        revenue.alias("revenue_amount"),
        X.revenue_per_seat(revenue, F.col("capacity")).alias("revenue_per_seat"))


# A1
def first_status_times(reservation_event: DataFrame) -> DataFrame:
    """Per reservation: first time of each status and the event count."""
    def first(status: str) -> F.Column:
        return F.min(F.when(F.col("to_status") == status, F.col("occurred_at")))
    return (reservation_event.groupBy("reservation_id")
            .agg(first("HELD").alias("held_at"), first("CONFIRMED").alias("confirmed_at"),
                 first("CANCELLED").alias("cancelled_at"), first("EXPIRED").alias("expired_at"),
                 F.count(F.lit(1)).alias("event_count")))


# A2
def trip_summary(itinerary: DataFrame, segment: DataFrame, flight_instance: DataFrame,
                 scheduled_flight: DataFrame) -> DataFrame:
    """Per reservation: MIN(route_id), MIN(flight_date), COUNT(segments of any status)."""
    i = itinerary.select("itinerary_id", "reservation_id")
    s = segment.select("itinerary_id", "segment_id", "flight_instance_id")
    fi = flight_instance.select("flight_instance_id", "scheduled_flight_id", "flight_date")
    sf = scheduled_flight.select("scheduled_flight_id", "route_id")
    return (i.join(s, "itinerary_id").join(fi, "flight_instance_id").join(sf, "scheduled_flight_id")
            .groupBy("reservation_id")
            .agg(F.min("route_id").alias("route_id"), F.min("flight_date").alias("first_departure"),
                 F.count("segment_id").alias("segments")))


# J18
def fact_reservation_lifecycle(reservation: DataFrame, reservation_event: DataFrame,
                               itinerary: DataFrame, segment: DataFrame,
                               flight_instance: DataFrame, scheduled_flight: DataFrame,
                               agency: DataFrame, reservation_passenger: DataFrame,
                               channels: DataFrame) -> DataFrame:
    """One row per reservation, from the audit log and the trip."""
    e = first_status_times(reservation_event)
    tr = trip_summary(itinerary, segment, flight_instance, scheduled_flight)
    pax = passenger_count(reservation_passenger)
    ag = agency.select("agency_id", F.col("legal_name").alias("agency_name"))
    r = reservation.select("reservation_id", "pnr", "channel", "agency_id", "created_at",
                           "status", "total_amount", "currency")
    j = (r.join(e, "reservation_id", "left").join(tr, "reservation_id", "left")
         .join(ag, "agency_id", "left").join(pax, "reservation_id", "left"))
    j = with_channel_key(j, channels)
    held, conf = F.col("held_at"), F.col("confirmed_at")
    canc, exp = F.col("cancelled_at"), F.col("expired_at")
    return j.select(
        F.col("reservation_id").alias("reservation_key"), "pnr", "channel_key",
        F.col("route_id").alias("route_key"),
        X.date_key("created_at").alias("created_date_key"),
        X.date_key("first_departure").alias("departure_date_key"),
        F.col("status").alias("final_status"),
        F.coalesce("passengers", F.lit(0)).cast("int").alias("passengers"),
        F.coalesce("segments", F.lit(0)).cast("int").alias("segments"),
        "total_amount", "currency",
        F.when(conf.isNotNull() & held.isNotNull(), X.minutes_between(held, conf)).alias("minutes_to_confirm"),
        F.when(canc.isNotNull(), X.minutes_between(F.col("created_at"), canc)).alias("minutes_to_cancel"),
        F.when(canc.isNotNull() & F.col("first_departure").isNotNull(),
               X.days_before_cancel("first_departure", canc)).alias("days_before_departure_at_cancel"),
        X.reached(held).alias("was_held"), X.reached(conf).alias("was_confirmed"),
        X.reached(canc).alias("was_cancelled"), X.reached(exp).alias("expired_without_payment"),
        F.coalesce("event_count", F.lit(0)).cast("int").alias("event_count"))
