"""Flight shopping as batch jobs: many requests at once, top-k per request.

J19 flight_availability, F1 available_flights, J10 cheapest_eligible_fare,
J11 one_stop_connections, O1 search_direct, O2 search_one_stop,
O3 search_offers, O5 next_sellable_flight, O6 offer_documents,
X1 flexible_dates, X5 two_stop_connections.

Scale notes
-----------
* Cheapest fare (J10): the inequality ``min_advance_days <= days to flight``
  is turned into a lookup in a *fare ladder*: per (route, cabin, currency,
  validity) and advance-days step, the cheapest fare among all fares with at
  most that many advance days (a running min). Flights join the ladder on the
  equi key (route, cabin, currency) and keep the one step whose range holds
  their lead time, so the fan-out is bounded by the number of distinct
  advance rules, not by the number of fares.
* Connections (J11): the time-range self-join gets equi keys by bucketing the
  first leg's connection window [arrival + MCT, arrival + 12 h] into the (at
  most two) UTC days it touches; the second leg joins on (hub, departure day)
  and the exact range is a residual filter. Hub skew is left to AQE.
* Top-k per request uses ``row_number`` over the request, which Spark plans
  as a window group limit (partial top-k before the shuffle).
* Offers are matched day by day (``itineraries.py``): neither chains nor a request's
  candidates are rows of a shuffle, and requests that ask the same thing at the same fares
  are searched once. Chains of three flights likewise (``connections.py``).
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyfold.functions import exprs as X
from skyfold.operators.connections import legs_around
from skyfold.operators.itineraries import best_itineraries, cheapest_days, for_each_request

REQUEST_COLS = ("request_id", "origin", "destination", "flight_date", "cabin_code",
                "passengers", "currency", "search_date")


# J19
def flight_availability(flight_instance: DataFrame, scheduled_flight: DataFrame, route: DataFrame,
                        inventory: DataFrame) -> DataFrame:
    """Instance ⋈ schedule ⋈ route ⋈ inventory with seats_available (P12);
    cancelled flights are not listed."""
    fi = flight_instance.where(F.col("status") != "CANCELLED").select(
        "flight_instance_id", "scheduled_flight_id", "flight_date", "departure_utc", "arrival_utc",
        F.col("status").alias("flight_status"))
    sf = scheduled_flight.select("scheduled_flight_id", "flight_number", "route_id")
    r = route.select("route_id", "origin_iata", "destination_iata")
    inv = inventory.select("flight_instance_id", "cabin_code", "capacity", "seats_sold", "seats_held",
                           "oversell_factor")
    j = fi.join(sf.join(r, "route_id"), "scheduled_flight_id").join(inv, "flight_instance_id")
    return j.select(
        "flight_instance_id", "flight_date", "departure_utc", "arrival_utc", "flight_status",
        "flight_number", "route_id", "origin_iata", "destination_iata", "cabin_code", "capacity",
        "seats_sold", "seats_held",
        X.seats_available("capacity", "oversell_factor", "seats_sold", "seats_held").alias("seats_available"))


# F1
def available_flights(avail: DataFrame, passengers: int | str = 1) -> DataFrame:
    """Searchable: SCHEDULED and at least ``passengers`` seats (a number or a column name)."""
    need = F.col(passengers) if isinstance(passengers, str) else F.lit(passengers)
    return avail.where((F.col("flight_status") == "SCHEDULED") & (F.col("seats_available") >= need))


# J10
def fare_ladder(fare: DataFrame, fare_class: DataFrame, fare_rule: DataFrame,
                fare_class_code: str | None = None, by_class: bool = False) -> DataFrame:
    """Per (route, cabin[, class], currency, validity) and advance step: the
    cheapest fare among fares needing at most that many advance days;
    ``next_adv`` is the next step (NULL for the last)."""
    fc = fare_class.select("fare_class_code", "cabin_code")
    fr = fare_rule.select("fare_rule_id", "min_advance_days")
    f = fare.join(fc, "fare_class_code").join(fr, "fare_rule_id")
    f = f.where(X.optional_filter("fare_class_code", fare_class_code))
    key = ["route_id", "cabin_code", "currency", "valid_from", "valid_to"] + (["_class"] if by_class else [])
    f = f.withColumn("_class", F.col("fare_class_code")) if by_class else f
    best = F.struct("base_amount", "fare_id", "fare_class_code", "tax_pct")
    steps = f.groupBy(*key, "min_advance_days").agg(F.min(best).alias("step_best"))
    w = Window.partitionBy(*key).orderBy("min_advance_days")
    return (steps.withColumn("best", F.min("step_best").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("next_adv", F.lead("min_advance_days").over(w))
            .drop("step_best"))


def cheapest_eligible_fare(keys: DataFrame, ladder: DataFrame, by_class: bool = False) -> DataFrame:
    """J10 for distinct (route_id, cabin_code[, fare_class_code], currency,
    flight_date, as_of) keys: cheapest fare with matching currency, as_of
    within validity and min_advance_days <= flight_date - as_of; ties by
    fare_id. Keys without an eligible fare get no row (the reference's inner
    LATERAL). ``by_class`` needs a ladder built with ``by_class=True``."""
    kc = ["route_id", "cabin_code", "currency", "flight_date", "as_of"]
    k = keys.select(*kc, *([F.col("fare_class_code").alias("_class")] if by_class else [])).distinct()
    lead = F.datediff(F.col("flight_date"), F.col("as_of"))
    jk = ["route_id", "cabin_code", "currency"] + (["_class"] if by_class else [])
    j = (k.join(ladder, jk)
         .where(F.col("as_of").between(F.col("valid_from"), F.col("valid_to"))
                & (F.col("min_advance_days") <= lead)
                & (F.col("next_adv").isNull() | (lead < F.col("next_adv")))))
    g = j.groupBy(*kc, *(["_class"] if by_class else [])).agg(F.min("best").alias("b"))
    return g.select(*kc, F.col("b.fare_id").alias("fare_id"), F.col("b.fare_class_code").alias("fare_class_code"),
                    F.col("b.base_amount").alias("base_amount"), F.col("b.tax_pct").alias("tax_pct"))


def unit_price(base: str | F.Column, tax_pct: str | F.Column) -> F.Column:
    """Unrounded base × (1 + tax / 100): the reference's ORDER BY key."""
    return X.col(base) * (F.lit(1) + X.col(tax_pct) / F.lit(100))


REQUEST_KEY = REQUEST_COLS[1:]


def fold_requests(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct searches (a request_id of its own each, the least that asks it), and
    (request_id, search_id) of every request."""
    searches = requests.groupBy(*REQUEST_KEY).agg(F.min("request_id").alias("request_id"))
    members = requests.select(*REQUEST_COLS).join(searches.withColumnRenamed("request_id", "search_id"), list(REQUEST_KEY))
    return searches.select(*REQUEST_COLS), members.select("request_id", "search_id")


def unfold_results(results: DataFrame, members: DataFrame) -> DataFrame:
    """The rows of each search for every request that asks it."""
    return results.withColumnRenamed("request_id", "search_id").join(members, "search_id").drop("search_id")


# J11
def _connection_window(l1: DataFrame, airport: DataFrame, max_hours: int) -> DataFrame:
    hub = F.broadcast(airport.select(F.col("iata_code").alias("_hub"), "min_connection_min"))
    l1 = l1.join(hub, l1.l1_dest == hub._hub).drop("_hub")
    lo = F.col("l1_arr") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("min_connection_min").cast("int"))
    hi = F.col("l1_arr") + F.make_dt_interval(F.lit(0), F.lit(max_hours))
    return (l1.withColumn("win_lo", lo).withColumn("win_hi", hi)
            .withColumn("day", F.explode(F.sequence(F.to_date("win_lo"), F.to_date("win_hi")))))


def one_stop_connections(flights: DataFrame, airport: DataFrame, max_hours: int = X.MAX_CONNECTION_HOURS,
                         extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """Pairs (l1, l2): l2 leaves the hub l1 lands at, MCT <= gap <= max_hours
    (equality valid), and does not return to l1's origin. ``flights`` needs
    flight_instance_id, origin_iata, destination_iata, departure_utc,
    arrival_utc (+ ``extra_keys`` that both legs must share, e.g. cabin)."""
    base = ["flight_instance_id", "origin_iata", "destination_iata", "departure_utc", "arrival_utc", "flight_date"]
    l1 = flights.select(*[F.col(c).alias(n) for c, n in zip(base, ["l1_id", "l1_orig", "l1_dest", "l1_dep", "l1_arr", "l1_date"])],
                        *extra_keys)
    l2 = flights.select(*[F.col(c).alias(n) for c, n in zip(base, ["l2_id", "l2_orig", "l2_dest", "l2_dep", "l2_arr", "l2_date"])],
                        *[F.col(k).alias(f"_{k}") for k in extra_keys]).withColumn("_day", F.to_date("l2_dep"))
    l1w = _connection_window(l1, airport, max_hours)
    # equi keys: hub airport and departure day (+ shared extra keys)
    cond = (l1w.l1_dest == l2.l2_orig) & (l1w.day == l2._day)
    for k in extra_keys:
        cond = cond & (l1w[k] == l2[f"_{k}"])
    j = l1w.join(l2, cond).where(
        (F.col("l2_dest") != F.col("l1_orig")) & F.col("l2_dep").between(F.col("win_lo"), F.col("win_hi")))
    return (j.withColumn("connection_minutes", X.minutes_between("l1_arr", "l2_dep"))
            .drop("day", "_day", "win_lo", "win_hi", "min_connection_min", *[f"_{k}" for k in extra_keys]))


def _top(df: DataFrame, order: list, k: int) -> DataFrame:
    w = Window.partitionBy("request_id").orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


# O1
def search_direct(requests: DataFrame, avail: DataFrame, ladder: DataFrame, limit: int = 50) -> DataFrame:
    """Direct offers per request, cheapest unrounded unit price first, then
    departure; at most ``limit`` per request. Requests that ask the same at the same fares are
    one search, whose rows are worked out once."""
    found = best_itineraries(requests, avail, ladder, None, (0,), limit, 0).drop("stops")
    return for_each_request(found.withColumn("sort_price", unit_price("l1_base", "l1_tax")))


# O2
def search_one_stop(requests: DataFrame, avail: DataFrame, ladder: DataFrame, airport: DataFrame,
                    limit: int = 50, max_hours: int = X.MAX_CONNECTION_HOURS) -> DataFrame:
    """One-stop offers per request: first leg on the date, second leg on the
    date or the next, MCT of the hub <= gap <= max_hours; cheapest total
    unrounded price first, then elapsed time; at most ``limit`` per request."""
    return for_each_request(_timed(best_itineraries(requests, avail, ladder, airport, (1,), limit, max_hours), 2).drop("stops"))


def _timed(c: DataFrame, legs: int) -> DataFrame:
    """The rows of ``best_itineraries`` for chains of ``legs`` flights with sums over the chain."""
    price = [unit_price(f"l{i}_base", f"l{i}_tax") for i in range(1, legs + 1)]
    c = c.withColumn("sort_price", reduce(add, price)).withColumn("elapsed_s", F.unix_seconds(f"l{legs}_arr") - F.unix_seconds("l1_dep"))
    for i, name in zip(range(1, legs), ("connection_minutes", "connection2_minutes")):
        c = c.withColumn(name, X.minutes_between(f"l{i}_arr", f"l{i + 1}_dep"))
    return c


# O2 with one stop more
def search_two_stop(requests: DataFrame, avail: DataFrame, ladder: DataFrame, airport: DataFrame,
                    limit: int = 50, max_hours: int = X.MAX_CONNECTION_HOURS) -> DataFrame:
    """Two-stop offers per request: the first leg on the date, each later leg at most a day after the
    one before by flight date, four different airports, MCT of each hub <= gap <= max_hours, seats and
    an eligible fare on every leg; cheapest total unrounded price first, then elapsed time, then
    flight ids; at most ``limit`` per request.

    Given the middle leg, first and last leg are free of each other, so chains are counted per class of
    equal price as sums of products; only the cheapest classes that hold ``limit`` chains are combined."""
    c = _timed(best_itineraries(requests, avail, ladder, airport, (2,), limit, max_hours), 3).drop("stops")
    return for_each_request(c.withColumn("hub1", F.col("l1_dest")).withColumn("hub2", F.col("l2_dest")))


def _priced(df: DataFrame, legs: list[str]) -> DataFrame:
    for p in legs:
        fare, tax = X.tax_split(f"{p}_base", f"{p}_tax")
        df = df.withColumn(f"{p}_fare", fare).withColumn(f"{p}_taxamt", tax)
    fare_sum = sum((F.col(f"{p}_fare") for p in legs[1:]), F.col(f"{legs[0]}_fare"))
    tax_sum = sum((F.col(f"{p}_taxamt") for p in legs[1:]), F.col(f"{legs[0]}_taxamt"))
    pax = F.col("passengers").cast("decimal(5,0)")
    last = legs[-1]
    return df.select(
        "request_id", F.lit(len(legs) - 1).alias("stops"),
        F.col("l1_id").alias("first_flight_id"),
        (F.col("l2_id") if len(legs) > 1 else F.lit(None).cast("bigint")).alias("second_flight_id"),
        (F.col("l3_id") if len(legs) > 2 else F.lit(None).cast("bigint")).alias("third_flight_id"),
        F.col("l1_dep").alias("departure_utc"), F.col(f"{last}_arr").alias("arrival_utc"),
        X.duration_minutes("l1_dep", f"{last}_arr").alias("total_duration_minutes"),
        (F.col("connection_minutes") if len(legs) > 1 else F.lit(None).cast("int")).alias("connection_minutes"),
        (F.col("connection2_minutes") if len(legs) > 2 else F.lit(None).cast("int")).alias("connection2_minutes"),
        (fare_sum * pax).cast(X.MONEY_TOTAL).alias("fare_amount"),
        (tax_sum * pax).cast(X.MONEY_TOTAL).alias("tax_amount"),
        ((fare_sum + tax_sum) * pax).cast(X.MONEY_TOTAL).alias("total_amount"),
        (fare_sum + tax_sum).cast(X.MONEY_TOTAL).alias("price_per_passenger"), "currency", "cabin_code")


# O3
def search_offers(direct: DataFrame, one_stop: DataFrame, two_stop: DataFrame | None = None, limit: int = 40) -> DataFrame:
    """Direct, one-stop and (if given) two-stop offers with rounded money (half-even) times
    passengers, best ``limit`` per request by (total, duration); remaining
    ties by stops and flight ids (the reference keeps list order)."""
    offers = _priced(direct, ["l1"]).unionByName(_priced(one_stop, ["l1", "l2"]))
    if two_stop is not None:
        offers = offers.unionByName(_priced(two_stop, ["l1", "l2", "l3"]))
    return _top(offers, [F.col("total_amount"), F.col("total_duration_minutes"), F.col("stops"), F.col("first_flight_id"),
                         F.col("second_flight_id").asc_nulls_first(), F.col("third_flight_id").asc_nulls_first()], limit)


def _offers(c: DataFrame, legs: int) -> DataFrame:
    """``_priced`` of chains of several kinds, ``legs`` flights at most, with their ranks and segments (also as JSON, which
    is made once for all requests of a search)."""
    has = lambda i: F.col("stops") >= i - 1
    zero = F.lit(0).cast(X.MONEY)
    split = [X.tax_split(f"l{i}_base", f"l{i}_tax") for i in range(1, legs + 1)]
    fare_sum, tax_sum = (reduce(add, [split[0][k], *[F.when(has(i), split[i - 1][k]).otherwise(zero) for i in range(2, legs + 1)]]) for k in (0, 1))
    pax = F.col("passengers").cast("decimal(5,0)")
    last = F.coalesce(*[F.when(has(i), F.col(f"l{i}_arr")) for i in range(legs, 0, -1)])
    leg_id = lambda i: F.col(f"l{i}_id") if i <= legs else F.lit(None).cast("bigint")
    gap = lambda i: X.minutes_between(f"l{i}_arr", f"l{i + 1}_dep") if i < legs else F.lit(None).cast("int")
    segments = F.array_compact(F.array(*[F.when(has(i), F.struct(
        F.lit(i - 1).alias("seq"), leg_id(i).alias("flight_instance_id"), F.col(f"l{i}_num").alias("flight_number"), F.col(f"l{i}_orig").alias("origin"),
        F.col(f"l{i}_dest").alias("destination"), F.col(f"l{i}_dep").alias("departure_utc"), F.col(f"l{i}_arr").alias("arrival_utc"), "cabin_code",
        F.col(f"l{i}_seats").alias("seats_available"))) for i in range(1, legs + 1)]))
    return c.select(
        "request_ids", "stops", leg_id(1).alias("first_flight_id"), leg_id(2).alias("second_flight_id"), leg_id(3).alias("third_flight_id"),
        F.col("l1_dep").alias("departure_utc"), last.alias("arrival_utc"), X.duration_minutes(F.col("l1_dep"), last).alias("total_duration_minutes"),
        gap(1).alias("connection_minutes"), gap(2).alias("connection2_minutes"),
        (fare_sum * pax).cast(X.MONEY_TOTAL).alias("fare_amount"), (tax_sum * pax).cast(X.MONEY_TOTAL).alias("tax_amount"),
        ((fare_sum + tax_sum) * pax).cast(X.MONEY_TOTAL).alias("total_amount"),
        (fare_sum + tax_sum).cast(X.MONEY_TOTAL).alias("price_per_passenger"), "currency", "cabin_code", "rank", segments.alias("segments"),
        F.to_json(segments).alias("segments_json"))


def search_itineraries(requests: DataFrame, avail: DataFrame, ladder: DataFrame, airport: DataFrame,
                       max_stops: int = 1, limit: int = 40, per_kind: int = 50, segments: bool = False) -> DataFrame:
    """O1 to O3 for any number of requests: each distinct search is made once, with up to ``max_stops``
    (0, 1 or 2) stops, and its best ``limit`` offers go to every request that asks it. One pass makes
    all kinds and ranks them; with ``segments``, the flights of an offer come along (O6)."""
    if max_stops not in (0, 1, 2):
        raise ValueError("max_stops is 0, 1 or 2")
    c = best_itineraries(requests, avail, ladder, airport, tuple(range(max_stops + 1)), per_kind, X.MAX_CONNECTION_HOURS, limit)
    offers = for_each_request(_offers(c, max_stops + 1))
    return offers if segments else offers.drop("segments", "segments_json")


# O6
def offer_documents(offers: DataFrame, avail: DataFrame) -> DataFrame:
    """Nested offer: ordered ``segments`` array of structs and ``connection_minutes`` array, one row
    per offer. Offers that bring their segments need no look at ``avail``."""
    minutes = F.array_compact(F.array("connection_minutes", "connection2_minutes"))
    if "segments" in offers.columns:
        return offers.withColumn("connection_minutes", minutes)
    seg = avail.select(F.col("flight_instance_id").alias("_fid"), "cabin_code", "flight_number",
                       F.col("origin_iata").alias("origin"), F.col("destination_iata").alias("destination"),
                       "departure_utc", "arrival_utc", "seats_available")
    legs = offers.select("request_id", "rank", F.posexplode(F.array_compact(
        F.array("first_flight_id", "second_flight_id", "third_flight_id"))).alias("seq", "_fid"), "cabin_code")
    j = legs.join(seg, ["_fid", "cabin_code"])
    docs = (j.groupBy("request_id", "rank")
            .agg(F.sort_array(F.collect_list(F.struct("seq", F.col("_fid").alias("flight_instance_id"),
                                                       "flight_number", "origin", "destination", "departure_utc",
                                                       "arrival_utc", "cabin_code", "seats_available"))).alias("segments")))
    return offers.join(docs, ["request_id", "rank"]).withColumn("connection_minutes", minutes)


def _repeats(df: DataFrame, keys: list[str]) -> bool:
    return not df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).isEmpty()


def itinerary_documents(requests: DataFrame, avail: DataFrame, ladder: DataFrame, airport: DataFrame, max_stops: int = 1) -> DataFrame:
    """O6 of ``search_itineraries``. Where request ids or flights repeat, an offer's document lists
    every row of its flights for every row of its request, which takes the joins."""
    once = not _repeats(requests, ["request_id"]) and not _repeats(avail, ["flight_instance_id", "cabin_code"])
    docs = offer_documents(search_itineraries(requests, avail, ladder, airport, max_stops, segments=once), avail)
    return docs if once else docs.withColumn("segments_json", F.to_json("segments"))


# O5
def next_sellable_flight(flight_instance: DataFrame, inventory: DataFrame, as_of: str,
                         days_ahead: int = 2) -> DataFrame:
    """Per cabin: earliest SCHEDULED flight from as_of + days_ahead (by date, then id)."""
    fi = flight_instance.where((F.col("status") == "SCHEDULED")
                               & (F.col("flight_date") >= F.date_add(F.lit(as_of).cast("date"), days_ahead)))
    j = fi.join(inventory.select("flight_instance_id", "cabin_code", "capacity"), "flight_instance_id")
    best = F.min(F.struct("flight_date", "flight_instance_id", "capacity"))
    return (j.groupBy("cabin_code").agg(best.alias("b"))
            .select("cabin_code", "b.flight_instance_id", "b.flight_date", "b.capacity"))


# X1
def flexible_dates(requests: DataFrame, avail: DataFrame, ladder: DataFrame, days: int = 3) -> DataFrame:
    """Cheapest direct unit fare per request and day within ± ``days``.

    A day's first flight with enough seats has more of them than every earlier flight of its route; only
    such flights meet the requests of the dates that reach their day, inside the tasks of these dates."""
    sched = avail.where(F.col("flight_status") == "SCHEDULED")
    earlier = (Window.partitionBy("origin_iata", "destination_iata", "flight_date", "cabin_code", "route_id")
               .orderBy("departure_utc", "flight_instance_id").rowsBetween(Window.unboundedPreceding, -1))
    first = (sched.withColumn("_most", F.max("seats_available").over(earlier))
             .where(F.col("_most").isNull() | (F.col("seats_available") > F.col("_most"))))
    found = cheapest_days(requests, first.select(*sched.columns), ladder, days).select(
        "request_ids", "shift", F.date_add("flight_date", F.col("shift")).alias("flight_date"),
        F.col("l1_id").alias("flight_instance_id"), unit_price("l1_base", "l1_tax").alias("unit_price"))
    return for_each_request(found)


# X5
def two_stop_connections(flights: DataFrame, airport: DataFrame, max_hours: int = X.MAX_CONNECTION_HOURS) -> DataFrame:
    """J11 applied twice: (l1, l2, l3) chains; each hop obeys its hub's MCT
    and the window; the third leg does not return to the first origin. Flights are
    shuffled, pairs are not: a middle leg meets its first and last legs inside a task."""
    around = legs_around(flights, airport, max_hours)
    chains = around.select("l2_id", F.explode("firsts").alias("f"), "lasts").select("l2_id", "f", F.explode("lasts").alias("l"))
    return (chains.where(F.col("l.dest") != F.col("f.orig"))
            .select(F.col("f.id").alias("l1_id"), "l2_id", F.col("l.id").alias("l3_id"), F.col("f.orig").alias("l1_orig"), F.col("l.dest").alias("l3_dest"),
                    F.col("f.dep").alias("l1_dep"), F.col("l.arr").alias("l3_arr"),
                    F.col("f.minutes").alias("connection1_minutes"), F.col("l.minutes").alias("connection2_minutes")))
