"""Business marts over the star: A5 occupancy_by_route, A6 revenue_by_fare,
A7 cancellation_patterns, A8 lead_time_by_class.

Averages are computed as exact decimal sum / count and then rounded half-up,
like PostgreSQL's numeric AVG + ROUND, never through double. Dimensions are
bounded (routes: origin × destination airports, fares: joined by key, dates:
one row per calendar day) and joined after the fact is pre-filtered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.functions import exprs as X


def _avg(c: F.Column, scale: int, mult: int = 1) -> F.Column:
    """round(avg(c) * mult, scale) over non-null c, half-up, exact."""
    total = F.sum(c.cast("decimal(20,4)")) * F.lit(mult)
    return X.exact_avg(total, F.count(c), scale)


# A5
def occupancy_by_route(occupancy: DataFrame, dim_route: DataFrame, dim_date: DataFrame) -> DataFrame:
    r = dim_route.select("route_key", "route_label", "origin_city", "destination_city")
    d = dim_date.select(F.col("date_key").alias("departure_date_key"), "year", "month", "is_high_season")
    j = occupancy.join(r, "route_key").join(d, "departure_date_key")
    return (j.groupBy("route_label", "origin_city", "destination_city", "year", "month",
                      "is_high_season", "cabin_code")
            .agg(F.count(F.lit(1)).alias("flights"),
                 F.sum("capacity").alias("seats_offered"),
                 F.sum("seats_sold").alias("seats_sold"),
                 _avg(F.col("load_factor"), 2, 100).alias("avg_load_factor_pct"),
                 F.sum("revenue_amount").alias("revenue")))


# A6
def revenue_by_fare(ticket_fact: DataFrame, dim_fare: DataFrame, dim_date: DataFrame) -> DataFrame:
    t = ticket_fact.where(~F.col("is_cancelled"))
    f = dim_fare.select("fare_key", "cabin_name", "fare_class_code", "fare_class_name",
                        "rule_name", "min_advance_days")
    d = dim_date.select(F.col("date_key").alias("issue_date_key"), "year", "month")
    j = t.join(f, "fare_key").join(d, "issue_date_key")
    return (j.groupBy("cabin_name", "fare_class_code", "fare_class_name", "rule_name",
                      "min_advance_days", "year", "month")
            .agg(F.count(F.lit(1)).alias("tickets"),
                 F.sum("seats").alias("seats"),
                 F.sum("fare_amount").alias("fare_revenue"),
                 F.sum("tax_amount").alias("tax_collected"),
                 F.sum("ancillary_amount").alias("ancillary_revenue"),
                 F.sum("commission_amount").alias("commissions_paid"),
                 F.sum("total_amount").alias("total_revenue"),
                 _avg(F.col("fare_amount"), 2).alias("avg_fare"),
                 _avg(F.col("days_before_departure"), 1).alias("avg_days_before_departure")))


# A7
def cancellation_patterns(lifecycle: DataFrame, dim_channel: DataFrame, dim_route: DataFrame,
                          dim_date: DataFrame) -> DataFrame:
    c = dim_channel.select("channel_key", "channel", "agency_name")
    r = dim_route.select("route_key", "route_label")
    d = dim_date.select(F.col("date_key").alias("created_date_key"), "year", "month")
    j = (lifecycle.join(c, "channel_key").join(r, "route_key", "left")
         .join(d, "created_date_key"))
    canc = F.col("was_cancelled")
    n = F.count(F.lit(1))
    n_canc = F.count(F.when(canc, F.lit(1)))
    return (j.groupBy("channel", "agency_name", "route_label", "year", "month")
            .agg(n.alias("reservations"),
                 n_canc.alias("cancelled"),
                 F.count(F.when(F.col("expired_without_payment"), F.lit(1))).alias("expired_unpaid"),
                 X.exact_avg(n_canc * F.lit(100), n, 2).alias("cancellation_rate_pct"),
                 _avg(F.when(F.col("was_confirmed"), F.col("minutes_to_confirm")), 1).alias("avg_minutes_to_confirm"),
                 _avg(F.when(canc, F.col("days_before_departure_at_cancel")), 1).alias("avg_days_before_dep_at_cancel"),
                 F.sum(F.when(canc, F.col("total_amount"))).alias("cancelled_value")))


# A8
def lead_time_by_class(ticket_fact: DataFrame, dim_fare: DataFrame) -> DataFrame:
    """Average purchase lead days per fare class next to its advance rule
    (expected order: promo > standard > flexible)."""
    t = ticket_fact.where(~F.col("is_cancelled")).select("fare_key", "days_before_departure")
    f = dim_fare.select("fare_key", "fare_class_code", "rule_name", "min_advance_days")
    return (t.join(f, "fare_key")
            .groupBy("fare_class_code", "rule_name", "min_advance_days")
            .agg(F.count(F.lit(1)).alias("tickets"),
                 _avg(F.col("days_before_departure"), 1).alias("avg_days_before_departure"),
                 F.min("days_before_departure").alias("min_days_before_departure"),
                 F.max("days_before_departure").alias("max_days_before_departure")))
