"""Dimensions of the star schema: S4 dim_date, J1 dim_route, J2 dim_fare,
J3 dim_flight, A11 dim_channel and the J12 channel-key lookup.

Broadcast policy: airports (one per nation), cabins and aircraft models are
bounded by construction and broadcast explicitly. Agencies, channels, fare
rules, flights and fares are users' tables and joined by plain equi-joins;
Spark turns those into broadcast joins only when the measured side is small.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyfold.functions import exprs as X

# Calendar of the reference ETL: 365 * 3 days from this date.
CALENDAR_START = "2026-01-01"
CALENDAR_DAYS = 365 * 3


def _calendar_columns(d: Column) -> list[Column]:
    return [
        X.date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day"),
        (F.weekday(d) + 1).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        (F.weekday(d) >= 5).alias("is_weekend"),
        F.month(d).isin(*X.HIGH_SEASON_MONTHS).alias("is_high_season"),
    ]


def dim_date(spark: SparkSession, start: str = CALENDAR_START, days: int = CALENDAR_DAYS) -> DataFrame:
    """S4: generated calendar of ``days`` days from ``start`` (reference: 1,095
    days from 2026-01-01, ending 2028-12-30 because 2028 is a leap year)."""
    end = (_dt.date.fromisoformat(start) + _dt.timedelta(days=days - 1)).isoformat()
    seq = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("d"))
    return seq.select(*_calendar_columns(F.col("d")))


def dim_date_between(bounds: DataFrame) -> DataFrame:
    """S4 over a range derived from data: ``bounds`` has one row with columns
    ``lo`` and ``hi`` (dates), e.g. an aggregate over the source tables."""
    seq = bounds.select(F.explode(F.sequence(F.col("lo"), F.col("hi"))).alias("d"))
    return seq.select(*_calendar_columns(F.col("d")))


def dim_route(route: DataFrame, airport: DataFrame) -> DataFrame:
    """J1: route ⋈ airport (origin) ⋈ airport (destination)."""
    ao = F.broadcast(airport.select(F.col("iata_code").alias("_o"), F.col("city").alias("origin_city")))
    ad = F.broadcast(airport.select(F.col("iata_code").alias("_d"), F.col("city").alias("destination_city")))
    j = (route.join(ao, route.origin_iata == ao._o)
         .join(ad, route.destination_iata == ad._d))
    return j.select(
        F.col("route_id").alias("route_key"), "origin_iata", "origin_city",
        "destination_iata", "destination_city",
        X.route_label("origin_iata", "destination_iata").alias("route_label"),
        "distance_km", X.distance_band("distance_km").alias("distance_band"))


def dim_fare(fare: DataFrame, fare_class: DataFrame, cabin: DataFrame, fare_rule: DataFrame) -> DataFrame:
    """J2: fare ⋈ class ⋈ cabin ⋈ rule."""
    fc = fare_class.select("fare_class_code", "cabin_code", F.col("name").alias("fare_class_name"))
    c = F.broadcast(cabin.select("cabin_code", F.col("name").alias("cabin_name")))
    fr = fare_rule.select("fare_rule_id", F.col("name").alias("rule_name"), "min_advance_days", "is_refundable", "is_changeable")
    j = fare.join(fc, "fare_class_code").join(c, "cabin_code").join(fr, "fare_rule_id")
    return j.select(F.col("fare_id").alias("fare_key"), "fare_class_code", "fare_class_name",
                    "cabin_code", "cabin_name", "rule_name", "min_advance_days",
                    "is_refundable", "is_changeable")


def dim_flight(flight_instance: DataFrame, scheduled_flight: DataFrame, aircraft: DataFrame,
               aircraft_model: DataFrame, as_of: str, history_days: int = 365) -> DataFrame:
    """J3: instance ⋈ scheduled, left aircraft, left model; flights from
    ``as_of - history_days`` on (the reference uses CURRENT_DATE - 365)."""
    fi = flight_instance.where(F.col("flight_date") >= F.date_sub(F.lit(as_of).cast("date"), history_days))
    sf = scheduled_flight.select("scheduled_flight_id", "flight_number", "route_id")
    a = aircraft.select("aircraft_id", "registration", F.col("model_code").alias("_model"))
    am = F.broadcast(aircraft_model.select(F.col("model_code")))
    j = (fi.join(sf, "scheduled_flight_id")
         .join(a, "aircraft_id", "left")
         .join(am, F.col("_model") == am.model_code, "left"))
    return j.select(
        F.col("flight_instance_id").alias("flight_key"), "flight_number",
        F.col("route_id").alias("route_key"), X.date_key("flight_date").alias("departure_date_key"),
        "departure_utc", F.col("model_code").alias("aircraft_model"),
        F.col("registration").alias("aircraft_registration"), F.col("status").alias("flight_status"))


def dim_channel(reservation: DataFrame, agency: DataFrame) -> DataFrame:
    """A11: DISTINCT (channel, agency name) + is_indirect; one default WEB row
    when there are no reservations. ``channel_key`` is deterministic: the rank
    of (channel, agency name) with NULL first. The distinct set is bounded by
    the number of agencies, so the final ranking runs on a tiny input."""
    ag = agency.select("agency_id", F.col("legal_name").alias("agency_name"))
    pairs = (reservation.select("channel", "agency_id").distinct()
             .join(ag, "agency_id", "left")
             .select("channel", "agency_name", F.lit(False).alias("_default")).distinct())
    default = reservation.sparkSession.range(1).select(
        F.lit("WEB").alias("channel"), F.lit(None).cast("string").alias("agency_name"), F.lit(True).alias("_default"))
    everything = Window.partitionBy()
    allp = (pairs.unionByName(default)
            .withColumn("_real", F.count(F.when(~F.col("_default"), 1)).over(everything))
            .where(~F.col("_default") | (F.col("_real") == 0)))
    w = Window.orderBy(F.col("channel"), F.col("agency_name").asc_nulls_first())
    return allp.select(F.row_number().over(w).cast("int").alias("channel_key"), "channel", "agency_name",
                       X.is_indirect("channel").alias("is_indirect"))


def extend_channels(stored: DataFrame | None, current: DataFrame) -> DataFrame:
    """The stored dimension with the pairs it lacks: a key once given never
    changes, new pairs are numbered after the greatest one. Facts take their
    keys from the result, never from a fresh ranking."""
    if stored is None:
        return current
    both = (current["channel"] == stored["channel"]) & current["agency_name"].eqNullSafe(stored["agency_name"])
    fresh = current.join(stored, both, "left_anti")
    top = stored.agg(F.max("channel_key")).first()[0] or 0
    number = F.row_number().over(Window.orderBy("channel_key"))      # one row per new agency
    return stored.unionByName(fresh.withColumn("channel_key", (F.lit(top) + number).cast("int")).select(*stored.columns))


def with_channel_key(df: DataFrame, channels: DataFrame, channel: str = "channel",
                     agency_name: str = "agency_name") -> DataFrame:
    """J12: key of (channel, agency) if present, else of (channel, NULL)."""
    ch = channels.select(F.col("channel").alias("_c1"), F.col("agency_name").alias("_a1"), F.col("channel_key").alias("_k1"))
    fb = channels.where(F.col("agency_name").isNull()).select(F.col("channel").alias("_c2"), F.col("channel_key").alias("_k2"))
    j = (df.join(ch, (F.col(channel) == F.col("_c1")) & F.col(agency_name).eqNullSafe(F.col("_a1")), "left")
         .join(fb, F.col(channel) == F.col("_c2"), "left"))
    return (j.withColumn("channel_key", F.coalesce(F.col("_k1"), F.col("_k2")))
            .drop("_c1", "_a1", "_k1", "_c2", "_k2"))
