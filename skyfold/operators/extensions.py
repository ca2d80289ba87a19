"""Jobs the reference declares but does not implement (second wave):
X3 agency_settlement, X4 refund_due, X6 anonymise_passengers,
X7 card_number_scan, X9 payment_reconciliation. (X1, X5 live in
``search``; X8 in ``inventory``.)
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfold.functions import exprs as X

ANONYMISE_AFTER_YEARS = 5
#: A run of digit groups, one space or dash apart.
DIGIT_RUN = "[0-9]+(?:[ -][0-9]+)*"
CARD_DIGITS = (13, 19)


# X3
def agency_settlement(ticket_fact: DataFrame, dim_channel: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Per agency and issue month: sales (non-cancelled totals), commission,
    cancelled value and the balance owed (sales − commission)."""
    ch = dim_channel.where(F.col("is_indirect")).select("channel_key", "agency_name")
    d = dim_date.select(F.col("date_key").alias("issue_date_key"), "year", "month")
    j = ticket_fact.join(ch, "channel_key").join(d, "issue_date_key")
    live = ~F.col("is_cancelled")
    sales = F.sum(F.when(live, F.col("total_amount")).otherwise(F.lit(0)))
    comm = F.sum(F.when(live, F.col("commission_amount")).otherwise(F.lit(0)))
    return (j.groupBy("agency_name", "year", "month")
            .agg(F.count(F.when(live, 1)).alias("tickets"), sales.alias("sales"), comm.alias("commission"),
                 F.count(F.when(~live, 1)).alias("cancelled_tickets"),
                 F.sum(F.when(~live, F.col("total_amount")).otherwise(F.lit(0))).alias("cancelled_value"),
                 (sales - comm).alias("balance_due")))


# X4
def refund_due(ticket: DataFrame, fare: DataFrame, fare_rule: DataFrame) -> DataFrame:
    """Cancelled tickets: refundable amount = fare + tax − penalty (floored
    at 0) under a refundable rule, otherwise 0."""
    t = ticket.where(F.col("status") == "CANCELLED").select("ticket_id", "fare_id", "fare_amount", "tax_amount")
    fr = fare_rule.select("fare_rule_id", "is_refundable", "refund_penalty")
    j = t.join(fare.select("fare_id", "fare_rule_id"), "fare_id").join(fr, "fare_rule_id")
    paid = F.col("fare_amount") + F.col("tax_amount")
    refund = F.when(F.col("is_refundable"), X.floor_at_zero(paid - F.col("refund_penalty"))).otherwise(F.lit(0))
    return j.select("ticket_id", "fare_id", "is_refundable", paid.cast(X.MONEY).alias("paid_amount"),
                    F.col("refund_penalty").alias("penalty"), refund.cast(X.MONEY).alias("refund_amount"))


# X6
def anonymise_passengers(passenger: DataFrame, reservation_passenger: DataFrame, segment: DataFrame,
                         itinerary: DataFrame, flight_instance: DataFrame, as_of: str,
                         years: int = ANONYMISE_AFTER_YEARS) -> DataFrame:
    """Passengers whose last travel ended more than ``years`` ago lose names,
    passenger id, document, contact data and birth date (a digest of a document
    number could be reversed by trying all numbers). Others are unchanged.

    The latest date is taken per itinerary, then per reservation, before
    passengers come in, so that no row per segment and passenger is made."""
    latest = F.max("last_travel").alias("last_travel")
    trip = (segment.select("itinerary_id", "flight_instance_id")
            .join(flight_instance.select("flight_instance_id", F.col("flight_date").alias("last_travel")), "flight_instance_id")
            .groupBy("itinerary_id").agg(latest))
    booked = trip.join(itinerary.select("itinerary_id", "reservation_id"), "itinerary_id").groupBy("reservation_id").agg(latest)
    last = (reservation_passenger.select("reservation_id", "passenger_id").join(booked, "reservation_id")
            .groupBy("passenger_id").agg(latest))
    cutoff = F.add_months(F.lit(as_of).cast("date"), -12 * years)
    p = passenger.join(last, "passenger_id", "left")
    old = F.coalesce(F.col("last_travel") < cutoff, F.lit(False))
    def blank(c: str) -> Column:
        return F.when(old, F.lit(None).cast(passenger.schema[c].dataType)).otherwise(F.col(c)).alias(c)
    personal = ("passenger_id", "first_name", "last_name", "birth_date", "document_type", "document_number", "email", "phone")
    return p.select(*map(blank, personal), "last_travel", old.alias("is_anonymised"))


def luhn_ok(digits: Column) -> Column:
    """Luhn check of a digit string, in array expressions (no UDF)."""
    ds = F.transform(F.reverse(F.split(digits, "")), lambda c: c.cast("int"))
    doubled = F.transform(ds, lambda d, i: F.when(i % 2 == 1, F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2))
                          .otherwise(d))
    return F.aggregate(doubled, F.lit(0), lambda acc, x: acc + x) % 10 == 0


# X7
def card_candidates(text: Column) -> Column:
    """All strings of 13 to 19 digits made of whole neighbouring digit groups of a text (a run of
    digits, or groups one space or dash apart), so that a number after a year or a code is seen too."""
    low, high = CARD_DIGITS
    runs = F.filter(F.regexp_extract_all(text, F.lit(DIGIT_RUN), 0), lambda r: F.length(F.regexp_replace(r, "[ -]", "")) >= low)

    def windows(groups: Column) -> Column:
        # a group holds a digit at least, so no window has more groups than digits
        return F.flatten(F.transform(F.sequence(F.lit(1), F.size(groups)), lambda i: F.transform(
            F.sequence(F.lit(1), F.least(F.lit(high), F.size(groups) - i + 1)), lambda k: F.array_join(F.slice(groups, i, k), ""))))

    found = F.flatten(F.transform(runs, lambda r: windows(F.split(r, "[ -]"))))
    return F.filter(found, lambda d: F.length(d).between(low, high))


def card_number_scan(tables: dict[str, tuple[DataFrame, str, list[str]]]) -> DataFrame:
    """Card-like numbers in text columns that pass the Luhn check, once per row and column. ``tables``:
    name -> (frame, key column, text columns); a table is scanned once for all its columns. Zero
    hits expected."""
    parts = []
    for name, (df, key, cols) in tables.items():
        cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols]))
        hits = df.select(F.col(key).cast("string").alias("row_key"), cells.alias("cell")).select("row_key", "cell.column_name", F.col("cell.value").alias("value"))
        hits = hits.where(F.col("value").rlike("[0-9]")).select("row_key", "column_name", F.explode(F.array_distinct(card_candidates(F.col("value")))).alias("digits"))
        parts.append(hits.where(luhn_ok(F.col("digits"))).select(F.lit(name).alias("table_name"), "column_name", "row_key",
                                                                 F.concat(F.lit("****"), F.substring("digits", -4, 4)).alias("masked")))
    return reduce(DataFrame.unionByName, parts)


# X9
def payment_reconciliation(reservation: DataFrame, payment_event: DataFrame, as_of: str) -> DataFrame:
    """Reservations still HELD past their hold deadline although a payment
    attempt was received: money taken without a confirmation."""
    pay = (payment_event.groupBy(F.col("payment_id").alias("reservation_id"))
           .agg(F.count(F.lit(1)).alias("payment_events"), F.min("received_at").alias("first_payment_at")))
    held = reservation.where((F.col("status") == "HELD")
                             & (F.col("hold_expires_at") < F.lit(as_of).cast("timestamp")))
    return held.select("reservation_id", "pnr", "hold_expires_at", "total_amount").join(pay, "reservation_id")
