"""The reference's small seed network as in-code DataFrames (tests only).

Fixed values restated from the reference seed: 2 cabins, 6 airports with
their minimum connection times, 12 directed routes, 3 seat maps, 12
aircraft, 4 fare rules and classes, 14 daily schedules and 2 agencies.
Flights, inventory and fares are derived from them by the library's own
jobs (M1, J16, M3), exactly as the seed script derives them.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from skyfold.operators import inventory as I
from skyfold.sources.tables import values

# ---------------------------------------------------------------------------
# Fixed values of the reference seed.
# ---------------------------------------------------------------------------
AIRPORTS = [
    ("BOG", "SKBO", "El Dorado", "Bogotá", "CO", "America/Bogota", 60),
    ("MDE", "SKRG", "José María Córdova", "Rionegro", "CO", "America/Bogota", 45),
    ("CTG", "SKCG", "Rafael Núñez", "Cartagena", "CO", "America/Bogota", 40),
    ("CLO", "SKCL", "Alfonso Bonilla Aragón", "Cali", "CO", "America/Bogota", 45),
    ("BAQ", "SKBQ", "Ernesto Cortissoz", "Barranquilla", "CO", "America/Bogota", 40),
    ("SMR", "SKSM", "Simón Bolívar", "Santa Marta", "CO", "America/Bogota", 35),
]
ROUTES = [
    ("BOG", "MDE", 240), ("MDE", "BOG", 240), ("BOG", "CTG", 660), ("CTG", "BOG", 660),
    ("MDE", "CTG", 480), ("CTG", "MDE", 480), ("BOG", "CLO", 300), ("CLO", "BOG", 300),
    ("CTG", "SMR", 190), ("SMR", "CTG", 190), ("BOG", "BAQ", 700), ("BAQ", "BOG", 700),
]
AIRCRAFT = [
    ("HK-4801", "AT72", 1), ("HK-4802", "AT72", 1), ("HK-4803", "AT72", 1),
    ("HK-4810", "A320", 2), ("HK-4811", "A320", 2), ("HK-4812", "A320", 2), ("HK-4813", "A320", 2),
    ("HK-4814", "A320", 2),
    ("HK-4820", "A20N", 3), ("HK-4821", "A20N", 3), ("HK-4822", "A20N", 3), ("HK-4823", "A20N", 3),
]
FARE_RULES = [
    (1, "Promo anticipada 21d", 21, False, "0", False, "0"),
    (2, "Estándar 7d", 7, False, "0", True, "120000"),
    (3, "Flexible", 0, True, "180000", True, "0"),
    (4, "Ejecutiva flexible", 0, True, "0", True, "0"),
]
FARE_CLASSES = [("P", "ECO", "Económica promo", 1), ("Y", "ECO", "Económica estándar", 2),
                ("B", "ECO", "Económica flexible", 3), ("J", "BUS", "Ejecutiva", 4)]
SCHEDULES = [
    (1, "AV8101", "BOG", "MDE", "06:30", "07:25", 2), (2, "AV8102", "BOG", "MDE", "14:00", "14:55", 2),
    (3, "AV8103", "MDE", "BOG", "08:15", "09:10", 2), (4, "AV8104", "MDE", "BOG", "18:40", "19:35", 2),
    (5, "AV8201", "BOG", "CTG", "07:10", "08:40", 3), (6, "AV8202", "CTG", "BOG", "09:30", "11:00", 3),
    (7, "AV8301", "MDE", "CTG", "10:00", "11:15", 1), (8, "AV8302", "CTG", "MDE", "12:00", "13:15", 1),
    (9, "AV8401", "BOG", "CLO", "06:00", "07:05", 1), (10, "AV8402", "CLO", "BOG", "08:00", "09:05", 1),
    (11, "AV8501", "CTG", "SMR", "15:00", "15:45", 1), (12, "AV8502", "SMR", "CTG", "16:30", "17:15", 1),
    (13, "AV8601", "BOG", "BAQ", "11:20", "12:50", 3), (14, "AV8602", "BAQ", "BOG", "13:40", "15:10", 3),
]
AGENCIES = [(1, "Viajes El Dorado S.A.S.", "900123456-1", "8.00", "5.00", "50000000", "0", "COP", "ACTIVE"),
            (2, "Caribe Tours Ltda.", "900987654-2", "5.00", "4.00", "20000000", "0", "COP", "ACTIVE")]
VALID_FROM, VALID_TO = "2026-01-01", "2027-12-31"
# ---------------------------------------------------------------------------


class SeedModel:
    """Operational tables of the seed network, flights materialised from
    ``start`` for 61 days (the reference uses CURRENT_DATE)."""

    def __init__(self, spark: SparkSession, start: str):
        self.spark = spark
        self.start = start
        self.airport = values(spark, AIRPORTS, "iata_code string, icao_code string, name string, city string, "
                                               "country_code string, timezone string, min_connection_min int")
        self.route = values(spark, [(i + 1, o, d, km, True) for i, (o, d, km) in enumerate(ROUTES)],
                            "route_id int, origin_iata string, destination_iata string, distance_km int, "
                            "is_active boolean")
        self.aircraft = values(spark, [(i + 1, reg, model, sm, "ACTIVE") for i, (reg, model, sm) in enumerate(AIRCRAFT)],
                               "aircraft_id int, registration string, model_code string, seat_map_id int, status string")
        self.fare_rule = values(spark, FARE_RULES, "fare_rule_id int, name string, min_advance_days int, "
                                                   "is_refundable boolean, refund_penalty string, "
                                                   "is_changeable boolean, change_penalty string")
        self.fare_class = values(spark, FARE_CLASSES, "fare_class_code string, cabin_code string, name string, rank int")
        self.cabin = values(spark, [("BUS", "Ejecutiva", 1), ("ECO", "Económica", 2)],
                            "cabin_code string, name string, boarding_priority int")
        self.agency = values(spark, AGENCIES, "agency_id int, legal_name string, tax_id string, "
                                              "net_fare_discount_pct string, commission_pct string, "
                                              "credit_limit string, credit_used string, currency string, status string") \
            .withColumn("net_fare_discount_pct", F.col("net_fare_discount_pct").cast("decimal(5,2)")) \
            .withColumn("commission_pct", F.col("commission_pct").cast("decimal(5,2)")) \
            .withColumn("credit_limit", F.col("credit_limit").cast("decimal(14,2)")) \
            .withColumn("credit_used", F.col("credit_used").cast("decimal(14,2)"))
        sched = values(spark, SCHEDULES, "scheduled_flight_id int, flight_number string, o string, d string, "
                                         "dep string, arr string, seat_map_id int")
        r = self.route.select("route_id", F.col("origin_iata").alias("o"), F.col("destination_iata").alias("d"))
        self.scheduled_flight = sched.join(r, ["o", "d"]).select(
            "scheduled_flight_id", "flight_number", "route_id", F.col("dep").alias("departure_time_local"),
            F.col("arr").alias("arrival_time_local"), F.lit(0).alias("arrival_day_offset"),
            F.lit("1234567").alias("days_of_week"), F.lit(VALID_FROM).cast("date").alias("valid_from"),
            F.lit(VALID_TO).cast("date").alias("valid_to"), "seat_map_id")
        self.seats = I.seat_map_seats(I.seat_layouts(spark))
        self.capacity = I.seat_map_capacity(self.seats)
        self.flight_instance = I.materialize_flights(self.scheduled_flight, self.route, self.airport,
                                                     self.aircraft, start)
        self.flight_inventory = I.flight_inventory_init(self.flight_instance, self.capacity)
        self.fare = I.fare_grid(self.route, VALID_FROM, VALID_TO)
