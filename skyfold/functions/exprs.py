"""Scalar column expressions of the domain (P1–P26).

All of them are built from ``pyspark.sql.functions`` so they stay inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference system's for equal results.
# ---------------------------------------------------------------------------
DISTANCE_BAND_SHORT = "corta"        # distance_km < 400
DISTANCE_BAND_MEDIUM = "media"       # distance_km < 900
DISTANCE_BAND_LONG = "larga"         # otherwise
HIGH_SEASON_MONTHS = (1, 6, 7, 12)
PNR_ALPHABET = "ABCDEFGHJKLMNPQRSTUVWXYZ23456789"
PNR_LENGTH = 6
HOLD_MINUTES = 20
MAX_CONNECTION_HOURS = 12
INDIRECT_CHANNEL = "B2B"
RESERVATION_STATES = ("HELD", "CONFIRMED", "CANCELLED", "EXPIRED")
# ---------------------------------------------------------------------------

MONEY = "decimal(12,2)"
MONEY_TOTAL = "decimal(14,2)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# P1
def date_key(c: str | Column) -> Column:
    """Date or timestamp -> int YYYYMMDD; NULL stays NULL."""
    return F.date_format(col(c), "yyyyMMdd").cast("int")


# P2
def distance_band(km: str | Column) -> Column:
    km = col(km)
    return (F.when(km < 400, F.lit(DISTANCE_BAND_SHORT))
            .when(km < 900, F.lit(DISTANCE_BAND_MEDIUM))
            .otherwise(F.lit(DISTANCE_BAND_LONG)))


# P3
def route_label(origin: str | Column, destination: str | Column) -> Column:
    return F.concat_ws("-", col(origin), col(destination))


# P4
def is_indirect(channel: str | Column) -> Column:
    return col(channel) == F.lit(INDIRECT_CHANNEL)


# P5
def days_before_departure(flight_date: str | Column, issued_at: str | Column) -> Column:
    """Flight date minus the (UTC) issue date, in days; may be negative."""
    return F.datediff(col(flight_date), F.to_date(col(issued_at)))


# P6
def ticket_total(fare: str | Column, tax: str | Column, ancillary: str | Column) -> Column:
    """fare + tax + active ancillaries; surcharge, discount, commission excluded."""
    return (col(fare) + col(tax) + F.coalesce(col(ancillary), F.lit(0).cast(MONEY))).cast(MONEY)


def _safe_ratio(num: Column, den: Column, scale: int, out_type: str) -> Column:
    q = num.cast("decimal(18,2)") / den.cast("decimal(18,0)")
    return (F.when(den == 0, F.lit(0)).otherwise(F.round(q, scale))).cast(out_type)


# P7
def load_factor(sold: str | Column, capacity: str | Column) -> Column:
    """capacity 0 -> 0, else round(sold / capacity, 4) half-up. Held seats not counted."""
    return _safe_ratio(col(sold), col(capacity), 4, "decimal(9,4)")


# P8
def revenue_per_seat(revenue: str | Column, capacity: str | Column) -> Column:
    return _safe_ratio(col(revenue), col(capacity), 2, MONEY)


# P9 / P17
def minutes_between(start: str | Column, end: str | Column) -> Column:
    """Whole minutes from start to end, truncated toward zero (epoch / 60)."""
    micros = F.unix_micros(col(end)) - F.unix_micros(col(start))
    return (micros / F.lit(60_000_000)).cast("int")


# P10
def days_before_cancel(first_departure: str | Column, cancelled_at: str | Column) -> Column:
    return F.datediff(col(first_departure), F.to_date(col(cancelled_at)))


# P11
def reached(first_time: str | Column) -> Column:
    return col(first_time).isNotNull()


# P12
def seats_available(capacity: str | Column, oversell_factor: str | Column,
                    sold: str | Column, held: str | Column) -> Column:
    sellable = F.floor(col(capacity).cast("decimal(9,2)") * col(oversell_factor))
    return (sellable - col(sold) - col(held)).cast("int")


def sellable_capacity(capacity: str | Column, oversell_factor: str | Column) -> Column:
    return F.floor(col(capacity).cast("decimal(9,2)") * col(oversell_factor)).cast("int")


# P13
def tax_split(base: str | Column, tax_pct: str | Column) -> tuple[Column, Column]:
    """(fare, tax): fare to cents, tax = fare * pct / 100 to cents, half-even."""
    fare = F.bround(col(base).cast("decimal(14,4)"), 2).cast(MONEY)
    tax = F.bround(fare * col(tax_pct) / F.lit(100), 2).cast(MONEY)
    return fare, tax


# P14
def net_fare(base: str | Column, discount_pct: str | Column) -> Column:
    d = F.coalesce(col(discount_pct), F.lit(0).cast("decimal(5,2)"))
    return F.bround(col(base) * (F.lit(100) - d) / F.lit(100), 2).cast(MONEY)


# P15
def commission(fare: str | Column, commission_pct: str | Column) -> Column:
    p = F.coalesce(col(commission_pct), F.lit(0).cast("decimal(5,2)"))
    return F.bround(col(fare) * p / F.lit(100), 2).cast(MONEY)


# P16
def duration_minutes(start: str | Column, end: str | Column) -> Column:
    """Whole minutes, floor."""
    secs = F.unix_seconds(col(end)) - F.unix_seconds(col(start))
    return F.floor(secs / F.lit(60)).cast("int")


# P18
def local_to_utc(day: str | Column, local_hhmm: str | Column, tz: str | Column,
                 day_offset: str | Column | None = None) -> Column:
    """date + local wall time 'HH:mm' (+ day offset) at an airport zone ->
    UTC instant. Arithmetic on the parts, no per-row string parsing."""
    d = col(day)
    if day_offset is not None:
        d = F.date_add(d, col(day_offset).cast("int"))
    hh = F.substring(col(local_hhmm), 1, 2).cast("int")
    mm = F.substring(col(local_hhmm), 4, 2).cast("int")
    wall = F.to_timestamp(d) + F.make_dt_interval(F.lit(0), hh, mm)
    return F.to_utc_timestamp(wall, col(tz))


# P19
def runs_on_day(days_mask: str | Column, day: str | Column) -> Column:
    """7-char mask such as '1234567' contains the ISO weekday of ``day``."""
    iso_dow = (F.weekday(col(day)) + 1).cast("string")
    return F.instr(col(days_mask), iso_dow) > 0


# P20
def price_grid(distance_km: str | Column, factor: str | Column) -> Column:
    return F.round(col(distance_km).cast("decimal(12,2)") * col(factor), -3).cast(MONEY)


# P21
def ticket_number(pnr: str | Column, segment_seq: str | Column, passenger_ref: str | Column) -> Column:
    return F.concat_ws("-", col(pnr), col(segment_seq).cast("string"), col(passenger_ref).cast("string"))


def pnr_from_number(n: str | Column) -> Column:
    """Six base-32 digits of a non-negative number over the PNR alphabet."""
    n = col(n).cast("bigint")
    digits = []
    for pos in range(PNR_LENGTH - 1, -1, -1):
        idx = F.pmod(F.floor(n / F.lit(32 ** pos)).cast("bigint"), F.lit(32)).cast("int")
        digits.append(F.substring(F.lit(PNR_ALPHABET), idx + 1, 1))
    return F.concat(*digits)


# P23
def normalise_code(c: str | Column) -> Column:
    return F.upper(F.trim(col(c)))


# P25
def optional_filter(c: str | Column, value) -> Column:
    """Predicate that is always true when the parameter is None (no filter)."""
    return F.lit(True) if value is None else (col(c) == F.lit(value))


# P24
def audit_payload(*fields: str | Column) -> Column:
    return F.to_json(F.struct(*[col(f) for f in fields]))


# P26
def floor_at_zero(c: str | Column) -> Column:
    return F.greatest(col(c), F.lit(0))


def money_from_double(c: str | Column) -> Column:
    """Test-table doubles -> exact money: whole cents first, then decimal(12,2)."""
    cents = F.round(col(c) * 100).cast("bigint")
    return (cents.cast("decimal(18,0)") / F.lit(100)).cast(MONEY)


def exact_avg(total: Column, n: Column, scale: int) -> Column:
    """round(total / n, scale), half-up, computed in decimals (no double)."""
    return F.round(total.cast("decimal(30,4)") / n.cast("decimal(20,0)"), scale)
