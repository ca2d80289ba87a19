"""Reservation-state jobs, re-aimed from a transactional write path to batch
jobs over tables: W1, W3, F7, A9, A10, A13, E1–E4, E6–E10, J14, J20, O7, P22.

Running sums that could meet a hot key (one flight or one agency holding a
large share of rows) use ``prefix_sum``: an exclusive running sum computed
per (key, time bucket) plus the totals of earlier buckets, so no single
window task ever holds a whole key.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyfold.functions import exprs as X
from skyfold.operators import search as S
from skyfold.operators.ranking import large_keys, prefix_sum, prefix_sum_by_size, prior_value
from skyfold.session import checkpoint_dir, ship_package, work_dir

# Legal moves of a reservation (code of the reference: B2B also starts HELD).
LEGAL_TRANSITIONS = [(None, "HELD"), ("HELD", "CONFIRMED"), ("HELD", "CANCELLED"),
                     ("HELD", "EXPIRED"), ("CONFIRMED", "CANCELLED")]


# W1
def itinerary_validation(segment: DataFrame, flights: DataFrame, airport: DataFrame, now: str,
                         max_hours: int = X.MAX_CONNECTION_HOURS) -> DataFrame:
    """Per itinerary: the first failing leg (by sequence) and its rule, or OK.
    ``flights``: flight_instance_id, status, departure_utc, arrival_utc,
    origin_iata, destination_iata."""
    s = (segment.select("itinerary_id", "sequence_no", "flight_instance_id").join(flights, "flight_instance_id")
         .withColumn("_leg", F.struct("destination_iata", "arrival_utc")))
    mct = F.broadcast(airport.select(F.col("iata_code").alias("_hub"), F.col("min_connection_min").alias("_mct")))
    # previous leg per itinerary, in buckets of 64 legs (no itinerary is one task)
    s = prior_value(s, ["itinerary_id"], ["sequence_no"], "_leg", F.floor(F.col("sequence_no") / 64), "_prev")
    s = (s.withColumn("prev_dest", F.col("_prev.destination_iata")).withColumn("prev_arr", F.col("_prev.arrival_utc"))
         .drop("_leg", "_prev")
         .join(mct, F.col("prev_dest") == F.col("_hub"), "left"))
    gap_s = F.unix_seconds("departure_utc") - F.unix_seconds("prev_arr")
    reason = (F.when(F.col("status") != "SCHEDULED", F.lit("NOT_SCHEDULED"))
              .when(F.col("departure_utc") <= F.lit(now).cast("timestamp"), F.lit("DEPARTED"))
              .when(F.col("prev_dest").isNull(), F.lit(None))
              .when(F.col("prev_dest") != F.col("origin_iata"), F.lit("NOT_CONTINUOUS"))
              .when(gap_s < F.col("_mct") * 60, F.lit("SHORT_CONNECTION"))
              .when(gap_s > max_hours * 3600, F.lit("LONG_CONNECTION")))
    s = s.withColumn("reason", reason)
    first_fail = F.min(F.when(F.col("reason").isNotNull(), F.struct("sequence_no", "reason")))
    return (s.groupBy("itinerary_id")
            .agg(F.count(F.lit(1)).alias("segments"), first_fail.alias("_f"))
            .select("itinerary_id", "segments", F.col("_f.sequence_no").alias("failed_sequence_no"),
                    F.coalesce(F.col("_f.reason"), F.lit("OK")).alias("result")))


def _legal(prior: Column, new: Column) -> Column:
    cond = None
    for p, n in LEGAL_TRANSITIONS:
        c = (prior.isNull() if p is None else prior == p) & (new == n)
        cond = c if cond is None else (cond | c)
    return F.coalesce(cond, F.lit(False))     # unknown prior -> not a legal move, never NULL


# W3
def transition_audit(reservation_event: DataFrame) -> DataFrame:
    """Status events with the previous to_status; flags a from_status that
    does not match it and moves that are not legal."""
    ev = reservation_event.where(F.col("to_status").isNotNull())
    ev = prior_value(ev, ["reservation_id"], ["occurred_at", "event_id"], "to_status", F.to_date("occurred_at"),
                     "previous_status")
    return ev.select("event_id", "reservation_id", "occurred_at", "previous_status", "from_status", "to_status",
                     F.col("from_status").eqNullSafe(F.col("previous_status")).alias("from_matches"),
                     _legal(F.col("previous_status"), F.col("to_status")).alias("is_legal"))


# F7 / O4
def expired_holds(reservation: DataFrame, as_of: str, limit: int | None = None) -> DataFrame:
    """HELD reservations whose hold expired before as_of: all of them, or the
    oldest ``limit`` (a worker's batch)."""
    r = reservation.where((F.col("status") == "HELD")
                          & (F.col("hold_expires_at") < F.lit(as_of).cast("timestamp")))
    if limit is None:
        return r
    return r.orderBy("hold_expires_at", "reservation_id").limit(limit)


# A9
def seat_demand(segment: DataFrame, itinerary: DataFrame, seats: DataFrame,
                only_active: bool = True) -> DataFrame:
    """Per reservation and (flight, cabin): seated passengers times the
    number of its segments on that (flight, cabin)."""
    s = segment.where(F.col("status") == "ACTIVE") if only_active else segment
    s = s.select("itinerary_id", "flight_instance_id", "cabin_code").join(
        itinerary.select("itinerary_id", "reservation_id"), "itinerary_id")
    return (s.join(seats, "reservation_id")
            .groupBy("reservation_id", "flight_instance_id", "cabin_code")
            .agg(F.sum("seats").cast("int").alias("demand")))


# E2 + A10
def quote_segments(requests: DataFrame, avail: DataFrame, fare: DataFrame, fare_class: DataFrame,
                   fare_rule: DataFrame, agency: DataFrame) -> DataFrame:
    """Quote each requested segment: cheapest eligible fare of its (route,
    cabin[, class]) as of the request day, net fare after the agency's
    discount (P14), tax on the net (P13). Unquotable segments stay, with a
    reason. ``requests``: reservation_id, segment_id, flight_instance_id,
    cabin_code, fare_class_code (nullable), currency, as_of, agency_id."""
    fl = avail.select("flight_instance_id", "cabin_code", "route_id", "flight_date").distinct()
    r = requests.join(fl, ["flight_instance_id", "cabin_code"], "left")
    ladder_cls = S.fare_ladder(fare, fare_class, fare_rule, by_class=True)
    ladder_any = S.fare_ladder(fare, fare_class, fare_rule)
    keyed = r.where(F.col("route_id").isNotNull())
    with_cls = S.cheapest_eligible_fare(keyed.where(F.col("fare_class_code").isNotNull()), ladder_cls, by_class=True)
    any_cls = S.cheapest_eligible_fare(keyed.where(F.col("fare_class_code").isNull()), ladder_any)
    k = ["route_id", "cabin_code", "currency", "flight_date", "as_of"]
    f_cols = ["fare_id", "base_amount", "tax_pct"]
    q_cls = r.join(with_cls.select(*k, "fare_class_code", *f_cols), [*k, "fare_class_code"], "left") \
        .where(F.col("fare_class_code").isNotNull())
    q_any = (r.where(F.col("fare_class_code").isNull()).drop("fare_class_code")
             .join(any_cls.select(*k, "fare_class_code", *f_cols), k, "left"))
    q = q_cls.unionByName(q_any)
    ag = agency.select("agency_id", "net_fare_discount_pct")
    q = q.join(ag, "agency_id", "left")
    net = X.net_fare("base_amount", "net_fare_discount_pct")
    _, tax = X.tax_split(net, "tax_pct")
    reason = (F.when(F.col("route_id").isNull(), F.lit("NO_INVENTORY"))
              .when(F.col("fare_id").isNull(), F.lit("NO_ELIGIBLE_FARE")))
    return q.select("reservation_id", "segment_id", "flight_instance_id", "cabin_code", "fare_class_code",
                    "fare_id", "base_amount", net.alias("net_fare"), tax.alias("tax_amount"), reason.alias("reason"))


def reservation_total(quotes: DataFrame, seats: DataFrame) -> DataFrame:
    """A10: Σ (net + tax) × seated passengers over quoted segments."""
    q = quotes.where(F.col("reason").isNull()).join(seats, "reservation_id")
    return (q.groupBy("reservation_id")
            .agg(F.sum((F.col("net_fare") + F.col("tax_amount")) * F.col("seats")).cast(X.MONEY_TOTAL)
                 .alias("total_amount"), F.count(F.lit(1)).alias("quoted_segments")))


#: Waiting requests that one task decides in arrival order, each round.
CHAIN = 50_000
#: Legs of one (flight, cabin) that one running sum covers; those of larger ones are summed day by day.
HOT_LEGS = 100_000


def _admit_in_order(legs):
    """(requested_at, request_id, fits) of a block of waiting requests, first come first served.
    ``lower``: demand accepted before a leg outside the block."""
    taken: dict = {}
    out = []
    legs = legs.sort_values(["requested_at", "request_id"], kind="stable")
    for place, own in legs.groupby(["requested_at", "request_id"], sort=False):
        rows = list(zip(own["flight_instance_id"], own["cabin_code"], own["demand"], own["lower"], own["remaining"]))
        fits = all(low + taken.get((f, c), 0) + d <= left for f, c, d, low, left in rows)
        if fits:
            for f, c, d, _, _ in rows:
                taken[f, c] = taken.get((f, c), 0) + d
        out.append((*place, fits))
    return legs.iloc[0:0][["requested_at", "request_id"]].assign(fits=False) if not out else type(legs)(out, columns=["requested_at", "request_id", "fits"])


# E1
def seat_admission(requests: DataFrame, remaining: DataFrame, bucket: Column | None = None) -> DataFrame:
    """All-or-nothing admission in arrival order, computed in exact parallel
    rounds. ``requests``: request_id, requested_at, flight_instance_id,
    cabin_code, demand (one row per leg). ``remaining``: flight_instance_id,
    cabin_code, remaining seats.

    Per round and per (flight, cabin), in (requested_at, request_id) order:
    lower = demand already accepted before me, upper = lower + demand still
    undecided before me. A request is accepted when upper + d <= remaining on
    all its legs, refused when lower + d > remaining on any, else it waits.

    Requests can wait for each other in long chains, so each round then takes
    the earliest ``CHAIN`` requests that still wait. Everything they can
    depend on is decided or among them, so one pass over this bounded block in
    arrival order settles all of it, however long its chains. Rounds go on
    until none waits; accepted sets equal a sequential loop.

    A leg carries ``lower`` from round to round, so that a round reads only the
    legs that still waited and those its last block accepted. Each step is a
    packed copy on the shared folder."""
    spark = requests.sparkSession
    ship_package(spark)
    folder = work_dir(spark, f"admission/{uuid.uuid4().hex}")

    def stored(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("errorifexists").option("compression", "zstd").parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    bucket = bucket if bucket is not None else F.to_date("requested_at")
    key, order = ["flight_instance_id", "cabin_code"], ["requested_at", "request_id"]
    requests = stored("requests", requests.select(*order, *key, "demand"))
    large = large_keys(requests, key, HOT_LEGS)
    legs = (requests.join(remaining.select(*key, "remaining"), key, "left")
            .withColumn("remaining", F.coalesce("remaining", F.lit(0)))
            .withColumn("lower", F.lit(0).cast("long")).withColumn("state", F.lit("U")))
    accepted = F.when(F.col("state") == "A", F.col("demand")).otherwise(0)
    waiting_demand = F.when(F.col("state") == "U", F.col("demand")).otherwise(0)
    whole = Window.partitionBy("request_id")

    def settle(df: DataFrame, rnd: int) -> DataFrame:
        return df.where(F.col("state") != "U").select(*order, "state", F.lit(rnd).alias("decided_round"), "demand")

    settled: list[DataFrame] = []
    rnd, waiting = 0, None
    while True:
        rnd += 1
        acc = legs.withColumn("_acc", accepted).withColumn("_und", waiting_demand)
        acc = prefix_sum_by_size(acc, key, order, ["_acc", "_und"], bucket, ["_acc_before", "_und_before"], large).where(F.col("state") == "U")
        acc = acc.withColumn("lower", F.col("lower") + F.col("_acc_before"))
        acc = acc.withColumn("_fits", F.min(F.col("lower") + F.col("_und_before") + F.col("demand") <= F.col("remaining")).over(whole)) \
                 .withColumn("_over", F.max(F.col("lower") + F.col("demand") > F.col("remaining")).over(whole))
        acc = acc.withColumn("state", F.when(F.col("_fits"), F.lit("A")).when(F.col("_over"), F.lit("R")).otherwise(F.lit("U")))
        bulk = stored(f"bulk-{rnd}", acc.select(*order, *key, "demand", "remaining", "lower", "state"))
        settled.append(settle(bulk, rnd))
        if bulk.where(F.col("state") == "U").isEmpty():
            break
        # what was accepted before each leg that waits, by this round's verdicts too
        after = prefix_sum_by_size(bulk.where(F.col("state") != "R").withColumn("_acc", accepted), key, order, "_acc", bucket, "_acc_before", large)
        waits = stored(f"waits-{rnd}", after.where(F.col("state") == "U").withColumn("lower", F.col("lower") + F.col("_acc_before")).select(*bulk.columns))
        block = waits.select(*order).distinct().orderBy(*order).limit(CHAIN)
        legs_in = waits.join(block, order, "left_semi").select(*order, *key, "demand", "remaining", "lower")
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in legs_in.select(*order).schema)
        passed = legs_in.groupBy(F.lit(0).alias("block")).applyInPandas(_admit_in_order, f"{kinds}, fits boolean")
        decided = waits.join(passed, order, "left").withColumn(
            "state", F.when(F.col("fits").isNull(), F.col("state")).when(F.col("fits"), F.lit("A")).otherwise(F.lit("R")))
        decided = stored(f"decided-{rnd}", decided.select(*bulk.columns))
        settled.append(settle(decided, rnd))
        undecided = decided.where(F.col("state") == "U").select("request_id").distinct().count()
        if not undecided:
            break
        if undecided == waiting:
            raise RuntimeError(f"seat admission: round {rnd} decided none of {undecided} requests")
        waiting = undecided
        legs = decided.where(F.col("state") != "R")
    out = reduce(DataFrame.unionByName, settled)
    return (out.groupBy("request_id", "requested_at")
            .agg(F.first("state").alias("state"), F.max("decided_round").alias("decided_round"),
                 F.count(F.lit(1)).alias("legs"), F.sum("demand").alias("seats"))
            .withColumn("accepted", F.col("state") == "A").drop("state"))


def seat_admission_sequential(requests: list[dict], remaining: dict) -> dict:
    """Plain sequential loop (test oracle for E1, small inputs only)."""
    left = dict(remaining)
    by_req: dict = {}
    for r in requests:
        by_req.setdefault((r["requested_at"], r["request_id"]), []).append(r)
    out = {}
    for (_, rid), legs in sorted(by_req.items()):
        ok = all(left.get((leg["flight_instance_id"], leg["cabin_code"]), 0) >= leg["demand"] for leg in legs)
        if ok:
            for leg in legs:
                left[(leg["flight_instance_id"], leg["cabin_code"])] -= leg["demand"]
        out[rid] = ok
    return out


# E3
def issue_tickets(reservation: DataFrame, segment: DataFrame, itinerary: DataFrame,
                  reservation_passenger: DataFrame, agency: DataFrame) -> DataFrame:
    """Tickets of CONFIRMED reservations: ACTIVE segments × seated passengers
    (an equi-join on reservation_id), frozen quoted amounts, commission at the
    agency's percentage (half-even), number = pnr-segment-passenger."""
    r = reservation.where(F.col("status") == "CONFIRMED").select("reservation_id", "pnr", "agency_id", "currency")
    s = (segment.where(F.col("status") == "ACTIVE")
         .select("segment_id", "itinerary_id", "quoted_fare_id", "quoted_fare_amount", "quoted_tax_amount")
         .join(itinerary.select("itinerary_id", "reservation_id"), "itinerary_id"))
    pax = reservation_passenger.where(F.col("passenger_type") != "INF").select("reservation_id", "passenger_ref")
    ag = agency.select("agency_id", "commission_pct")
    j = s.join(r, "reservation_id").join(pax, "reservation_id").join(ag, "agency_id", "left")
    return j.select(
        X.ticket_number("pnr", "segment_id", "passenger_ref").alias("ticket_number"),
        "reservation_id", "passenger_ref", "segment_id", F.col("quoted_fare_id").alias("fare_id"),
        F.col("quoted_fare_amount").alias("fare_amount"), F.col("quoted_tax_amount").alias("tax_amount"),
        X.commission("quoted_fare_amount", "commission_pct").alias("commission_amount"),
        "currency", F.lit("ISSUED").alias("status"))


# E4
def cancelled_itineraries(requests: DataFrame, reservation: DataFrame, itinerary: DataFrame) -> DataFrame:
    """One row per itinerary of a HELD or CONFIRMED reservation that has a request: whether a request
    (itinerary_id NULL: the whole reservation) hits it while it is ACTIVE. Several requests of one
    reservation count together."""
    req = requests.groupBy("reservation_id").agg(F.max(F.col("itinerary_id").isNull()).alias("_whole"))
    one = requests.where("itinerary_id IS NOT NULL").select("reservation_id", "itinerary_id").distinct().withColumn("_named", F.lit(True))
    live = reservation.where(F.col("status").isin("HELD", "CONFIRMED")).select("reservation_id", "status", "agency_id", "total_amount")
    it = itinerary.select("reservation_id", "itinerary_id", (F.col("status") == "ACTIVE").alias("_active"))
    hit = F.col("_active") & (F.col("_whole") | F.coalesce("_named", F.lit(False)))
    return (live.join(req, "reservation_id").join(it, "reservation_id").join(one, ["reservation_id", "itinerary_id"], "left")
            .select("reservation_id", "itinerary_id", "status", "agency_id", "total_amount", "_active", hit.alias("hit")))


def cancelled_segments(hits: DataFrame, segment: DataFrame) -> DataFrame:
    """Row-level effect: the ACTIVE segments that become CANCELLED, with the reservation's prior status."""
    return (segment.where(F.col("status") == "ACTIVE").select("itinerary_id", "segment_id", "flight_instance_id", "cabin_code")
            .join(hits.where("hit").select("itinerary_id", "reservation_id", F.col("status").alias("prior_status")), "itinerary_id"))


def apply_cancellations(requests: DataFrame, reservation: DataFrame, itinerary: DataFrame,
                        segment: DataFrame, seats: DataFrame) -> DataFrame:
    """Cancel whole reservations (itinerary_id NULL) or single itineraries.
    ACTIVE segments and itineraries that are hit become CANCELLED; the
    reservation only when no ACTIVE itinerary remains; reservations already
    CANCELLED or EXPIRED are unchanged. Seats released go back to sold or
    held by the reservation's prior status."""
    hits = cancelled_itineraries(requests, reservation, itinerary)
    per_res = (hits.groupBy("reservation_id", "status", "agency_id", "total_amount")
               .agg(F.max(F.col("_active") & ~F.col("hit")).alias("still_active"),
                    F.count(F.when(F.col("hit"), 1)).alias("itineraries_cancelled")))
    released = (cancelled_segments(hits, segment).join(seats, "reservation_id").groupBy("reservation_id")
                .agg(F.count(F.lit(1)).alias("segments_cancelled"), F.sum("seats").alias("seats_released")))
    out = per_res.join(released, "reservation_id", "left")
    new_status = F.when(F.col("still_active"), F.col("status")).otherwise(F.lit("CANCELLED"))
    return out.select(
        "reservation_id", F.col("status").alias("previous_status"), new_status.alias("new_status"), "itineraries_cancelled",
        F.coalesce("segments_cancelled", F.lit(0)).alias("segments_cancelled"),
        F.coalesce("seats_released", F.lit(0)).alias("seats_released"),
        F.when(F.col("status") == "CONFIRMED", F.lit("seats_sold")).otherwise(F.lit("seats_held")).alias("released_from"),
        F.when((new_status == "CANCELLED") & F.col("agency_id").isNotNull(), F.col("total_amount"))
         .alias("credit_returned"))


def release_seats(requests: DataFrame, reservation: DataFrame, itinerary: DataFrame, segment: DataFrame,
                  seats: DataFrame) -> DataFrame:
    """Inventory effect of the same requests: seats released per (flight, cabin), by counter (sold / held)."""
    cut = cancelled_segments(cancelled_itineraries(requests, reservation, itinerary), segment).join(seats, "reservation_id")
    return (cut.groupBy("flight_instance_id", "cabin_code")
            .agg(F.sum(F.when(F.col("prior_status") == "CONFIRMED", F.col("seats")).otherwise(0)).alias("sold_released"),
                 F.sum(F.when(F.col("prior_status") == "HELD", F.col("seats")).otherwise(0)).alias("held_released")))


# E6
def state_as_of(reservation_event: DataFrame, at: str) -> DataFrame:
    """Status of every reservation at instant ``at``, from the log alone."""
    ev = reservation_event.where(F.col("to_status").isNotNull()
                                 & (F.col("occurred_at") <= F.lit(at).cast("timestamp")))
    return (ev.groupBy("reservation_id")
            .agg(F.max_by("to_status", F.struct("occurred_at", "event_id")).alias("status"),
                 F.max("occurred_at").alias("since"), F.count(F.lit(1)).alias("status_events")))


# E7
def dedupe_payments(payment_event: DataFrame) -> DataFrame:
    """One effect per psp_event_id: the first delivery by (received_at, id).
    An aggregate, so duplicates collapse map-side before the shuffle."""
    best = F.min(F.struct("received_at", "payment_event_id", "payment_id", "event_type", "payload"))
    return (payment_event.groupBy("psp_event_id").agg(best.alias("b"), F.count(F.lit(1)).alias("deliveries"))
            .select("psp_event_id", "b.payment_event_id", "b.payment_id", "b.received_at", "deliveries"))


# E8
def upsert_passengers(passenger: DataFrame) -> DataFrame:
    """One passenger per (document type, number): latest names win, latest
    non-null email kept, birth date and phone stay as first inserted."""
    t = F.struct("created_at", "passenger_id")
    return (passenger.groupBy("document_type", "document_number")
            .agg(F.min_by("passenger_id", t).alias("passenger_id"),
                 F.max_by("first_name", t).alias("first_name"),
                 F.max_by("last_name", t).alias("last_name"),
                 F.max_by("email", F.when(F.col("email").isNotNull(), t)).alias("email"),
                 F.min_by("birth_date", t).alias("birth_date"),
                 F.min_by("phone", t).alias("phone"),
                 F.count(F.lit(1)).alias("versions")))


# E9
def agency_credit_ledger(reservation: DataFrame, agency: DataFrame, release_on_expiry: bool = False) -> DataFrame:
    """Debit the total at a B2B hold, credit it back at full cancellation
    (and at expiry when ``release_on_expiry``), running balance per agency in
    time order, breach when used > limit. Every credit repays an earlier
    debit of the same amount, so the running sum never goes below 0 and the
    reference's GREATEST(x, 0) is the identity here."""
    b2b = reservation.where(F.col("agency_id").isNotNull()).select(
        "agency_id", "reservation_id", "status", "total_amount", "created_at", "updated_at")
    debit = b2b.select("agency_id", "reservation_id", F.col("created_at").alias("entry_at"), F.lit(0).alias("kind"),
                       F.col("total_amount").alias("amount"))
    back = ["CANCELLED", "EXPIRED"] if release_on_expiry else ["CANCELLED"]
    credit = b2b.where(F.col("status").isin(*back)).select(
        "agency_id", "reservation_id", F.col("updated_at").alias("entry_at"), F.lit(1).alias("kind"),
        (-F.col("total_amount")).alias("amount"))
    entries = debit.unionByName(credit)
    led = prefix_sum(entries, ["agency_id"], ["entry_at", "kind", "reservation_id"], "amount", F.to_date("entry_at"),
                     "_before")
    ag = agency.select("agency_id", "credit_limit")
    return (led.join(ag, "agency_id")
            .withColumn("credit_used", (F.col("_before") + F.col("amount")).cast(X.MONEY_TOTAL))
            .withColumn("is_breach", F.col("credit_used") > F.col("credit_limit"))
            .drop("_before"))


# E10
def expire_holds(reservation: DataFrame, segment: DataFrame, itinerary: DataFrame, inventory: DataFrame,
                 seats: DataFrame, as_of: str) -> DataFrame:
    """All expired holds -> EXPIRED; their seats leave seats_held (clamped
    at 0). Segments stay ACTIVE and agency credit is not returned (as the
    reference). Returns the updated inventory rows."""
    exp = expired_holds(reservation, as_of).select("reservation_id")
    dem = seat_demand(segment, itinerary, seats).join(exp, "reservation_id")
    rel = dem.groupBy("flight_instance_id", "cabin_code").agg(F.sum("demand").alias("held_released"))
    j = inventory.join(rel, ["flight_instance_id", "cabin_code"])
    return j.select("flight_instance_id", "cabin_code", "capacity", "seats_sold",
                    F.col("seats_held").alias("seats_held_before"), "held_released",
                    X.floor_at_zero(F.col("seats_held") - F.col("held_released")).alias("seats_held"))


# J13
def key_semi_join(df: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` whose key is in ``wanted`` (``IN (pairs)`` / ``= ANY``);
    a semi join never duplicates rows, whatever ``wanted`` repeats."""
    return df.join(wanted.select(*keys), keys, "left_semi")


# J14
def unknown_flights(requested: DataFrame, flight_instance: DataFrame, inventory: DataFrame) -> DataFrame:
    """Requested (flight, cabin) pairs with no flight, or no inventory row."""
    req = requested.select("flight_instance_id", "cabin_code").distinct()
    no_flight = req.join(flight_instance.select("flight_instance_id"), "flight_instance_id", "left_anti") \
        .withColumn("reason", F.lit("UNKNOWN_FLIGHT"))
    known = key_semi_join(req, flight_instance, ["flight_instance_id"])
    no_inv = known.join(inventory.select("flight_instance_id", "cabin_code"), ["flight_instance_id", "cabin_code"],
                        "left_anti").withColumn("reason", F.lit("NO_INVENTORY"))
    return no_flight.unionByName(no_inv)


# J20
def reservation_by_name(lookups: DataFrame, reservation: DataFrame, reservation_passenger: DataFrame,
                        passenger: DataFrame) -> DataFrame:
    """Reservations found by PNR only when a passenger's last name matches
    after upper/trim; a mismatch returns nothing, like not found."""
    names = (reservation_passenger.select("reservation_id", "passenger_id")
             .join(passenger.select("passenger_id", X.normalise_code("last_name").alias("_ln")), "passenger_id")
             .select("reservation_id", "_ln"))
    lk = lookups.select(X.normalise_code("pnr").alias("pnr"), X.normalise_code("last_name").alias("_ln"))
    r = reservation.select("reservation_id", "pnr", "status")
    hit = lk.join(r, "pnr").join(names, ["reservation_id", "_ln"], "left_semi")
    return hit.select("pnr", "reservation_id", "status").distinct()


# O7
def reservation_document(reservation: DataFrame, reservation_passenger: DataFrame, passenger: DataFrame,
                         itinerary: DataFrame, segment: DataFrame, ticket: DataFrame) -> DataFrame:
    """Nested reservation: passengers[], itineraries[segments[]], tickets[],
    each in its order; ticket total = fare + tax. One aggregate per child
    table, then left joins to the parent."""
    pax = (reservation_passenger.join(passenger.select("passenger_id", "first_name", "last_name"), "passenger_id", "left")
           .groupBy("reservation_id")
           .agg(F.sort_array(F.collect_list(F.struct("passenger_ref", "passenger_type", "first_name", "last_name")))
                .alias("passengers")))
    segs = (segment.groupBy("itinerary_id")
            .agg(F.sort_array(F.collect_list(F.struct("sequence_no", "segment_id", "flight_instance_id", "cabin_code",
                                                      "fare_class_code", "status"))).alias("segments")))
    its = (itinerary.join(segs, "itinerary_id", "left").groupBy("reservation_id")
           .agg(F.sort_array(F.collect_list(F.struct("sequence_no", "itinerary_id", "status", "segments")))
                .alias("itineraries")))
    tk = (ticket.groupBy("reservation_id")
          .agg(F.sort_array(F.collect_list(F.struct("ticket_id", "ticket_number", "status",
                                                    (F.col("fare_amount") + F.col("tax_amount")).alias("total"))))
               .alias("tickets")))
    return (reservation.select("reservation_id", "pnr", "status", "channel", "total_amount", "currency")
            .join(pax, "reservation_id", "left").join(its, "reservation_id", "left").join(tk, "reservation_id", "left"))


# P22
def pnr_code(reservation_id: Column, salt: int) -> Column:
    """Six characters of the PNR alphabet from an MD5 of the key and a salt (not sequential, so PNRs
    cannot be enumerated)."""
    digest = F.md5(F.concat_ws(":", reservation_id.cast("string"), F.lit(str(salt))).cast("binary"))
    number = F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
    return X.pnr_from_number(F.pmod(number, F.lit(32 ** X.PNR_LENGTH)))


def pnr_assign(reservation: DataFrame) -> DataFrame:
    """A unique PNR per reservation. In round ``salt`` every reservation without a code draws one; the
    least id of those that drew a free code keeps it, settled codes never change hands, and the others
    go on. Rounds end when all are settled; more reservations than codes are an error."""
    spark = reservation.sparkSession
    checkpoint_dir(spark)
    waiting = reservation.select("reservation_id").distinct().checkpoint()
    left = waiting.count()
    if left > 32 ** X.PNR_LENGTH:
        raise ValueError(f"{left} reservations exceed the {32 ** X.PNR_LENGTH} codes")
    settled = None
    salt = 0
    while left:
        drawn = waiting.withColumn("pnr", pnr_code(F.col("reservation_id"), salt))
        if settled is not None:
            drawn = drawn.join(settled.select("pnr"), "pnr", "left_anti")
        won = drawn.groupBy("pnr").agg(F.min("reservation_id").alias("reservation_id")) \
                   .select("reservation_id", "pnr", F.lit(salt).alias("salt")).checkpoint()
        settled = won if settled is None else settled.unionByName(won)
        waiting = waiting.join(won.select("reservation_id"), "reservation_id", "left_anti").checkpoint()
        left, salt = waiting.count(), salt + 1
    return settled if settled is not None else waiting.select("reservation_id", F.lit("").alias("pnr"), F.lit(0).alias("salt"))


# A13
def request_latency_summary(log: DataFrame, group: list[str], width: float = 16.0) -> DataFrame:
    """Per group: created / rejected / error counts, median (linear
    interpolation, like an exact percentile), p95 as element
    min(int(n × 0.95), n − 1) of the sorted latencies (0-based), max.
    ``log``: group columns, outcome, latency_ms.

    The log is first counted per (group, latency). Positions are running sums
    of those counts in buckets of ``width`` ms — boundaries fixed by value, so
    they do not depend on how Spark deals the rows — and no group is sorted in
    one task. Rows without a latency count, but have no position."""
    counts = log.where(F.col("latency_ms").isNotNull()).groupBy(*group, "latency_ms").agg(F.count(F.lit(1)).alias("_c"))
    first = prefix_sum(counts, group, ["latency_ms"], "_c", F.floor(F.col("latency_ms") / width), "_first")
    total = log.groupBy(*group).agg(
        F.count(F.when(F.col("outcome") == "created", 1)).alias("created"),
        F.count(F.when(F.col("outcome") == "rejected", 1)).alias("rejected"),
        F.count(F.when(F.col("outcome") == "error", 1)).alias("errors"),
        F.count(F.lit(1)).alias("requests"), F.count("latency_ms").alias("_n"), F.max("latency_ms").alias("max_ms"))
    middle = (F.col("_n") - 1) / F.lit(2.0)
    j = first.join(total.select(*group, "_n"), group)

    def at(position: Column) -> Column:
        inside = (position >= F.col("_first")) & (position < F.col("_first") + F.col("_c"))
        return F.max(F.when(inside, F.col("latency_ms")))

    values = j.groupBy(*group).agg(
        at(F.floor(middle)).alias("_lo"), at(F.ceil(middle)).alias("_hi"),
        at(F.least(F.floor(F.col("_n") * F.lit(0.95)), F.col("_n") - 1)).alias("p95_ms"))
    part = middle - F.floor(middle)
    return total.join(values, group, "left").select(
        *group, "created", "rejected", "errors", "requests",
        (F.col("_lo") * (1 - part) + F.col("_hi") * part).alias("p50_ms"), "p95_ms", "max_ms")
