"""Seat maps, materialisation of flights and seat inventory.

S5 seat_map_seats, A3 seat_map_capacity, J9 assign_aircraft,
M1 materialize_flights, J16 flight_inventory_init, J15/P20/M3 fare_grid,
M4 seed_scarcity, A12 scarce_inventory, F6 oversell_check,
A4/J17 inventory_reconciliation, E5 inventory_from_events,
X2 seat_map_status, E5 inventory_curve, X8 capacity_cut_impact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyfold.functions import exprs as X
from skyfold.operators.ranking import prefix_sum, running_level
from skyfold.sources.tables import values

#: Ticket ids that one running sum of a flight cabin covers (4,295 reservations of the supplied ids).
TICKETS_PER_BUCKET = 1 << 32

# ---------------------------------------------------------------------------
# Seat layouts of the reference seed and its fare-class grid.
# (seat_map_id, model, cabin, first row, last row, letters, exit rows)
# ---------------------------------------------------------------------------
SEAT_LAYOUTS = [
    (1, "AT72", "ECO", 1, 17, "ACDF", [9]),
    (2, "A320", "BUS", 1, 3, "ACDF", []),
    (2, "A320", "ECO", 10, 34, "ABCDEF", [14, 15]),
    (3, "A20N", "BUS", 1, 3, "ACDF", []),
    (3, "A20N", "ECO", 10, 36, "ABCDEF", [14, 15]),
]
WINDOW_LETTERS = ("A", "F")
AISLE_LETTERS = ("C", "D")
# (fare class, fare rule id, price factor per km)
FARE_CLASS_GRID = [("P", 1, "380.0"), ("Y", 2, "620.0"), ("B", 3, "940.0"), ("J", 4, "2100.0")]
MATERIALIZE_DAYS = 61
AIRCRAFT_ROTATION = 4
# ---------------------------------------------------------------------------


def seat_layouts(spark: SparkSession) -> DataFrame:
    return values(spark, SEAT_LAYOUTS,
                  "seat_map_id int, model_code string, cabin_code string, row_from int, row_to int, "
                  "letters string, exit_rows array<int>")


# S5
def seat_map_seats(layouts: DataFrame) -> DataFrame:
    """Rows × letters of each layout, with window / aisle / exit-row flags."""
    rows = layouts.withColumn("row_num", F.explode(F.sequence("row_from", "row_to")))
    seats = rows.withColumn("seat_letter", F.explode(F.split(F.col("letters"), "(?!$)")))
    return seats.select(
        "seat_map_id", F.concat(F.col("row_num").cast("string"), F.col("seat_letter")).alias("seat_number"),
        "cabin_code", F.col("row_num").cast("short").alias("row_num"), "seat_letter",
        F.col("seat_letter").isin(*WINDOW_LETTERS).alias("is_window"),
        F.col("seat_letter").isin(*AISLE_LETTERS).alias("is_aisle"),
        F.array_contains("exit_rows", F.col("row_num")).alias("is_exit_row"))


# A3
def seat_map_capacity(seats: DataFrame) -> DataFrame:
    return seats.groupBy("seat_map_id", "cabin_code").agg(F.count(F.lit(1)).cast("int").alias("capacity"))


# J9
def assign_aircraft(instances: DataFrame, aircraft: DataFrame, rotation: int = AIRCRAFT_ROTATION) -> DataFrame:
    """Per flight-date: the ACTIVE aircraft of the schedule's seat map that
    comes first by ((aircraft_id + scheduled_flight_id + day of year) mod
    rotation, aircraft_id); NULL when the seat map has no active aircraft.

    The sort key depends on the aircraft only through ``aircraft_id mod
    rotation``, so the winner is the smallest id of one residue class:
    candidates per flight are the <= ``rotation`` per-(seat map, residue)
    minima, never the whole fleet. ``instances`` needs scheduled_flight_id,
    flight_date and seat_map_id."""
    best = (aircraft.where(F.col("status") == "ACTIVE")
            .groupBy("seat_map_id", (F.col("aircraft_id") % rotation).alias("residue"))
            .agg(F.min("aircraft_id").alias("cand_id"))
            .groupBy("seat_map_id")
            .agg(F.collect_list(F.struct("residue", "cand_id")).alias("_cands")))
    # <= rotation entries per seat map, and seat maps are fleet configurations:
    # a bounded table, broadcast so the instances are never shuffled.
    shift = (F.col("scheduled_flight_id") + F.dayofyear("flight_date")) % rotation
    j = instances.join(F.broadcast(best), "seat_map_id", "left")
    ranked = F.transform(F.col("_cands"), lambda c: F.struct(
        ((c["residue"] + shift) % rotation).alias("k"), c["cand_id"].alias("cand_id")))
    return (j.withColumn("aircraft_id", F.array_min(ranked)["cand_id"].cast("int"))
            .drop("_cands"))


# M1
def materialize_flights(scheduled_flight: DataFrame, route: DataFrame, airport: DataFrame,
                        aircraft: DataFrame, start: str, days: int = MATERIALIZE_DAYS) -> DataFrame:
    """Flight instances for start … start + days - 1: schedules that run on
    the weekday and are valid on the date, local times converted to UTC at
    the origin / destination airport zones, aircraft by J9."""
    d0 = F.lit(start).cast("date")
    tz = airport.select("iata_code", "timezone")
    s = (scheduled_flight.join(route.select("route_id", "origin_iata", "destination_iata"), "route_id")
         .join(F.broadcast(tz.withColumnRenamed("iata_code", "origin_iata").withColumnRenamed("timezone", "tz_o")),
               "origin_iata")
         .join(F.broadcast(tz.withColumnRenamed("iata_code", "destination_iata").withColumnRenamed("timezone", "tz_d")),
               "destination_iata"))
    days_col = F.explode(F.sequence(d0, F.date_add(d0, days - 1))).alias("flight_date")
    inst = (s.select("*", days_col)
            .where(X.runs_on_day("days_of_week", "flight_date")
                   & F.col("flight_date").between(F.col("valid_from"), F.col("valid_to"))))
    inst = inst.select(
        (F.col("scheduled_flight_id") * 100000 + F.datediff("flight_date", F.lit("1970-01-01"))).alias("flight_instance_id"),
        "scheduled_flight_id", "flight_date", "seat_map_id",
        X.local_to_utc("flight_date", "departure_time_local", "tz_o").alias("departure_utc"),
        X.local_to_utc("flight_date", "arrival_time_local", "tz_d", "arrival_day_offset").alias("arrival_utc"))
    assigned = assign_aircraft(inst, aircraft)
    return assigned.withColumn("status", F.lit("SCHEDULED"))


# J16 / M2
def flight_inventory_init(instances: DataFrame, capacity: DataFrame) -> DataFrame:
    """One inventory row per (instance, cabin of its seat map); sold = held = 0."""
    cap = F.broadcast(capacity)  # one row per (seat map, cabin)
    return (instances.select("flight_instance_id", "seat_map_id").join(cap, "seat_map_id")
            .select("flight_instance_id", "cabin_code", "capacity",
                    F.lit(0).alias("seats_sold"), F.lit(0).alias("seats_held"),
                    F.lit("1.00").cast("decimal(4,2)").alias("oversell_factor"), F.lit(0).alias("version")))


# J15 / P20 / M3
def fare_grid(route: DataFrame, valid_from: str, valid_to: str, currency: str = "COP",
              tax_pct: str = "19.00") -> DataFrame:
    """One fare per (route, class): round(distance × class factor, -3).
    The class list is a literal array exploded per route (no join)."""
    grid = F.array(*[F.struct(F.lit(c).alias("fare_class_code"), F.lit(r).alias("fare_rule_id"),
                              F.lit(f).cast("decimal(8,1)").alias("factor")) for c, r, f in FARE_CLASS_GRID])
    g = route.select("route_id", "distance_km", F.explode(grid).alias("g"))
    out = g.select("route_id", "g.fare_class_code", "g.fare_rule_id",
                   F.lit(currency).alias("currency"),
                   X.price_grid("distance_km", "g.factor").alias("base_amount"),
                   F.lit(tax_pct).cast("decimal(5,2)").alias("tax_pct"),
                   F.lit(valid_from).cast("date").alias("valid_from"),
                   F.lit(valid_to).cast("date").alias("valid_to"))
    # deterministic key from the natural key, no global sort
    return out.withColumn("fare_id", (F.col("route_id") * 10 + F.col("fare_rule_id")).cast("int"))


# M4
def seed_scarcity(inventory: DataFrame, targets: DataFrame, seats_left: int = 1) -> DataFrame:
    """Join-driven update: targeted (flight, cabin) rows get sold =
    capacity - seats_left and held = 0; all other rows unchanged."""
    t = targets.select("flight_instance_id", "cabin_code", F.lit(True).alias("_hit")).distinct()
    j = inventory.join(t, ["flight_instance_id", "cabin_code"], "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    return (j.withColumn("seats_sold", F.when(hit, F.col("capacity") - seats_left).otherwise(F.col("seats_sold")))
            .withColumn("seats_held", F.when(hit, F.lit(0)).otherwise(F.col("seats_held")))
            .drop("_hit"))


# A12
def scarce_inventory(avail: DataFrame, seats_left: int = 1) -> DataFrame:
    return avail.where(F.col("seats_available") == seats_left)


# F6
def oversell_check(inventory: DataFrame) -> DataFrame:
    """Rows where sold + held > floor(capacity × factor); must be empty."""
    committed = F.col("seats_sold") + F.col("seats_held")
    return (inventory.where(committed > X.sellable_capacity("capacity", "oversell_factor"))
            .select("flight_instance_id", "cabin_code", "capacity", "seats_sold", "seats_held",
                    committed.alias("committed")))


# A4 + J17
def committed_seats(segment: DataFrame, itinerary: DataFrame, reservation: DataFrame,
                    seats: DataFrame | None = None) -> DataFrame:
    """Seats on ACTIVE segments per (flight, cabin) by reservation status.
    Seats per segment: the segment's ``seats`` column, or, when ``seats`` (a
    per-reservation table from J7) is given, the reservation's seated passengers."""
    s = segment.where(F.col("status") == "ACTIVE")
    cols = ["itinerary_id", "flight_instance_id", "cabin_code"] + (["seats"] if seats is None else [])
    s = s.select(*cols)
    j = (s.join(itinerary.select("itinerary_id", "reservation_id"), "itinerary_id")
         .join(reservation.select("reservation_id", F.col("status").alias("res_status")), "reservation_id"))
    if seats is not None:
        j = j.join(seats, "reservation_id")
    return (j.groupBy("flight_instance_id", "cabin_code")
            .agg(F.sum(F.when(F.col("res_status") == "CONFIRMED", F.col("seats"))).alias("confirmed_seats"),
                 F.sum(F.when(F.col("res_status") == "HELD", F.col("seats"))).alias("held_seats")))


def inventory_reconciliation(inventory: DataFrame, committed: DataFrame) -> DataFrame:
    j = inventory.join(committed, ["flight_instance_id", "cabin_code"], "left")
    ac = F.coalesce("confirmed_seats", F.lit(0)).cast("long")
    ah = F.coalesce("held_seats", F.lit(0)).cast("long")
    return j.select("flight_instance_id", "cabin_code", "seats_sold", "seats_held",
                    ac.alias("actual_confirmed"), ah.alias("actual_held"),
                    ((F.col("seats_sold") != ac) | (F.col("seats_held") != ah)).alias("is_mismatch"))


# E5
TRANSITION_DELTAS = [
    # (prior status or None, new status, held delta, sold delta)
    (None, "HELD", 1, 0), ("EXPIRED", "HELD", 1, 0), ("CANCELLED", "HELD", 1, 0),
    ("HELD", "CONFIRMED", -1, 1),
    ("HELD", "CANCELLED", -1, 0), ("CONFIRMED", "CANCELLED", 0, -1),
    ("HELD", "EXPIRED", -1, 0),
]


def with_prior_status(reservation_event: DataFrame) -> DataFrame:
    """Each status event with the status the reservation had before it
    (the to_status of the previous status event, by time then id), computed
    per (reservation, day) so a hot reservation is not one task."""
    from skyfold.operators.ranking import prior_value
    ev = reservation_event.where(F.col("to_status").isNotNull())
    return prior_value(ev, ["reservation_id"], ["occurred_at", "event_id"], "to_status", F.to_date("occurred_at"),
                       "prior_status")


def _delta(prior: F.Column, new: F.Column, which: int) -> F.Column:
    expr = None
    for p, n, dh, ds in TRANSITION_DELTAS:
        cond = (prior.isNull() if p is None else prior == p) & (new == n)
        val = F.lit(dh if which == 0 else ds)
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr.otherwise(F.lit(0))


def inventory_from_events(reservation_event: DataFrame, segment: DataFrame, itinerary: DataFrame) -> DataFrame:
    """Counters replayed from the audit log: per reservation the net signed
    held / sold effect of its legal transitions (illegal moves count 0),
    then times the seats of each of its segments, summed per (flight, cabin).
    The per-reservation pre-aggregation happens before the segment join."""
    ev = with_prior_status(reservation_event)
    net = (ev.groupBy("reservation_id")
           .agg(F.sum(_delta(F.col("prior_status"), F.col("to_status"), 0)).alias("held_units"),
                F.sum(_delta(F.col("prior_status"), F.col("to_status"), 1)).alias("sold_units")))
    seg = (segment.select("itinerary_id", "flight_instance_id", "cabin_code", "seats")
           .join(itinerary.select("itinerary_id", "reservation_id"), "itinerary_id"))
    j = seg.join(net, "reservation_id")
    agg = (j.groupBy("flight_instance_id", "cabin_code")
           .agg(F.sum(F.col("held_units") * F.col("seats")).alias("seats_held"),
                F.sum(F.col("sold_units") * F.col("seats")).alias("seats_sold")))
    return agg.withColumn("is_negative", (F.col("seats_held") < 0) | (F.col("seats_sold") < 0))


def inventory_curve(reservation_event: DataFrame, segment: DataFrame, itinerary: DataFrame) -> DataFrame:
    """E5 over time: per (flight, cabin) and instant at which a counter moved, the seats held and sold
    after it, the least they have been so far, and whether either has been below zero by then
    (``dipped``). Moves of one instant count together; a hot flight is summed day by day."""
    ev = with_prior_status(reservation_event)
    ev = ev.select("reservation_id", "occurred_at", _delta(F.col("prior_status"), F.col("to_status"), 0).alias("h"),
                   _delta(F.col("prior_status"), F.col("to_status"), 1).alias("s")).where("h != 0 or s != 0")
    ev = ev.groupBy("reservation_id", "occurred_at").agg(F.sum("h").alias("h"), F.sum("s").alias("s"))
    seg = (segment.select("itinerary_id", "flight_instance_id", "cabin_code", "seats")
           .join(itinerary.select("itinerary_id", "reservation_id"), "itinerary_id")
           .groupBy("reservation_id", "flight_instance_id", "cabin_code").agg(F.sum("seats").alias("seats")))
    keys = ["flight_instance_id", "cabin_code"]
    moves = (seg.join(ev, "reservation_id").groupBy(*keys, "occurred_at")
             .agg(F.sum(F.col("h") * F.col("seats")).alias("held"), F.sum(F.col("s") * F.col("seats")).alias("sold")))
    d = running_level(moves, keys, ["occurred_at"], ["held", "sold"], F.to_date("occurred_at"))
    return d.select(*keys, "occurred_at", F.col("held_level").alias("seats_held"), F.col("sold_level").alias("seats_sold"),
                    F.col("held_lowest").alias("lowest_held"), F.col("sold_lowest").alias("lowest_sold"),
                    ((F.col("held_lowest") < 0) | (F.col("sold_lowest") < 0)).alias("dipped"))


# X8
def capacity_cut_impact(inventory: DataFrame, flight_instance: DataFrame, scheduled_flight: DataFrame,
                        capacity: DataFrame) -> DataFrame:
    """Flights whose committed seats exceed the capacity of the seat map
    their schedule is (re)assigned to."""
    fi = flight_instance.select("flight_instance_id", "scheduled_flight_id")
    sf = scheduled_flight.select("scheduled_flight_id", "seat_map_id")
    cap = F.broadcast(capacity.withColumnRenamed("capacity", "new_capacity"))
    j = (inventory.join(fi, "flight_instance_id").join(sf, "scheduled_flight_id")
         .join(cap, ["seat_map_id", "cabin_code"], "left"))
    new_cap = F.coalesce("new_capacity", F.lit(0))
    committed = F.col("seats_sold") + F.col("seats_held")
    return (j.where(committed > new_cap)
            .select("flight_instance_id", "cabin_code", "seat_map_id", F.col("capacity").alias("old_capacity"),
                    new_cap.alias("new_capacity"), committed.alias("committed"),
                    (committed - new_cap).alias("seats_to_reaccommodate")))


# X2
def seat_map_status(flight_instance: DataFrame, scheduled_flight: DataFrame, seats: DataFrame,
                    taken: DataFrame) -> DataFrame:
    """Every seat of every flight instance (its schedule's seat map) as FREE
    or TAKEN, with the ticket holding it, and every seat sold beyond the map
    as UNSEATED. ``taken``: flight_instance_id, cabin_code, ticket_id, seats.
    Seats are handed out per (flight, cabin) in ticket order, in seat order
    (row, letter): ticket k holds the ranks (seats of earlier tickets, + its
    own seats]; a rank past the cabin's seats has no seat number. So a ticket
    is in the result once per seat it paid for.

    Neither a grid of all seats nor a range join is made: tickets name their
    ranks, what a cabin has left names its own, and both look their seat up by
    (seat map, cabin, rank). Tickets meet their flight before they name ranks,
    and the seats of the maps (no more than the layouts hold) are broadcast, so
    that a row per seat is never shuffled. Earlier tickets' seats are summed in
    buckets of ticket ids, so that a hot flight is no single task."""
    w_seat = Window.partitionBy("seat_map_id", "cabin_code").orderBy("row_num", "seat_letter")
    ranked = seats.select("seat_map_id", "cabin_code", "seat_number", F.row_number().over(w_seat).cast("long").alias("seat_rank"))
    room = F.broadcast(ranked.groupBy("seat_map_id", "cabin_code").agg(F.max("seat_rank").alias("room")))
    fl = (flight_instance.select("flight_instance_id", "scheduled_flight_id")
          .join(scheduled_flight.select("scheduled_flight_id", "seat_map_id"), "scheduled_flight_id")
          .drop("scheduled_flight_id"))
    t = taken.where("seats > 0").select("flight_instance_id", "cabin_code", "ticket_id", F.col("seats").cast("long").alias("seats"))
    t = prefix_sum(t, ["flight_instance_id", "cabin_code"], ["ticket_id"], "seats", F.floor(F.col("ticket_id") / TICKETS_PER_BUCKET), "lo")
    held = t.join(fl, "flight_instance_id", "left").select("flight_instance_id", "cabin_code", "ticket_id", F.explode(
        F.sequence(F.col("lo") + 1, F.col("lo") + F.col("seats"))).alias("seat_rank"), "seat_map_id")
    used = taken.groupBy("flight_instance_id", "cabin_code").agg(F.sum("seats").alias("used"))
    left = fl.join(room, "seat_map_id").join(used, ["flight_instance_id", "cabin_code"], "left").withColumn("used", F.coalesce("used", F.lit(0)).cast("long"))
    free = left.where("used < room").select("flight_instance_id", "cabin_code", F.lit(None).cast(taken.schema["ticket_id"].dataType).alias("ticket_id"),
                                            F.explode(F.sequence(F.col("used") + 1, F.col("room"))).alias("seat_rank"), "seat_map_id")
    j = held.unionByName(free).join(F.broadcast(ranked), ["seat_map_id", "cabin_code", "seat_rank"], "left")
    status = F.when(F.col("ticket_id").isNull(), F.lit("FREE")).when(F.col("seat_number").isNull(), F.lit("UNSEATED")).otherwise(F.lit("TAKEN"))
    return j.select("flight_instance_id", "cabin_code", "seat_number", "seat_rank", status.alias("status"), "ticket_id")
