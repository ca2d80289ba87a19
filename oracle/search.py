"""Flight shopping in DuckDB SQL: brute-force statements of the same results
(all candidate pairs, correlated-style cheapest fare by row_number)."""

from __future__ import annotations

from oracle.model import cte

AS_OF = "DATE '1998-01-01'"


def he(a: str, b: str) -> str:
    """Half-even integer division, a >= 0, b > 0."""
    q, r = f"(({a}) // ({b}))", f"(({a}) % ({b}))"
    return (f"(CASE WHEN 2 * {r} > ({b}) THEN {q} + 1 WHEN 2 * {r} = ({b}) THEN {q} + ({q} % 2) "
            f"ELSE {q} END)")


cte("flight_availability", """
SELECT fi.flight_instance_id, fi.flight_date, fi.departure_utc, fi.arrival_utc, fi.status AS flight_status,
       sf.flight_number, r.route_id, r.origin_iata, r.destination_iata, inv.cabin_code, inv.capacity,
       inv.seats_sold, inv.seats_held,
       CAST(floor(inv.capacity * inv.oversell_factor) AS INTEGER) - inv.seats_sold - inv.seats_held AS seats_available
FROM flight_instance fi JOIN scheduled_flight sf ON sf.scheduled_flight_id = fi.scheduled_flight_id
JOIN route r ON r.route_id = sf.route_id JOIN flight_inventory inv ON inv.flight_instance_id = fi.flight_instance_id
WHERE fi.status <> 'CANCELLED'""", ("flight_instance", "scheduled_flight", "route", "flight_inventory"))

cte("available_flights", "SELECT * FROM flight_availability WHERE flight_status = 'SCHEDULED' AND seats_available >= 1",
    ("flight_availability",))


def fare_pick(keys: str) -> str:
    """Cheapest eligible fare per key row of ``keys`` (route_id, cabin_code, flight_date, as_of)."""
    return f"""
SELECT * FROM (
  SELECT k.route_id, k.cabin_code, k.flight_date, k.as_of, f.fare_id, f.fare_class_code, f.base_amount, f.tax_pct,
         CAST(f.base_amount * 100 AS BIGINT) * (10000 + CAST(f.tax_pct * 100 AS BIGINT)) AS price_e6,
         row_number() OVER (PARTITION BY k.route_id, k.cabin_code, k.flight_date, k.as_of
                            ORDER BY f.base_amount, f.fare_id) AS rn
  FROM (SELECT DISTINCT route_id, cabin_code, flight_date, as_of FROM {keys}) k
  JOIN fare f ON f.route_id = k.route_id AND f.currency = 'COP'
  JOIN fare_class fc ON fc.fare_class_code = f.fare_class_code AND fc.cabin_code = k.cabin_code
  JOIN fare_rule fr ON fr.fare_rule_id = f.fare_rule_id
  WHERE k.as_of BETWEEN f.valid_from AND f.valid_to AND fr.min_advance_days <= k.flight_date - k.as_of) x
WHERE rn = 1"""


cte("cef_keys", f"SELECT route_id, cabin_code, flight_date, {AS_OF} AS as_of FROM flight_availability",
    ("flight_availability",))
cte("cheapest_eligible_fare", fare_pick("cef_keys"), ("cef_keys", "fare", "fare_class", "fare_rule"))

cte("conn_flights", """
SELECT fi.flight_instance_id, fi.flight_date, fi.status, fi.departure_utc, fi.arrival_utc, r.origin_iata, r.destination_iata
FROM flight_instance fi JOIN scheduled_flight sf ON sf.scheduled_flight_id = fi.scheduled_flight_id
JOIN route r ON r.route_id = sf.route_id""", ("flight_instance", "scheduled_flight", "route"))

cte("one_stop_connections", """
SELECT a.flight_instance_id AS l1_id, b.flight_instance_id AS l2_id, a.destination_iata AS hub_iata,
       (epoch_us(b.departure_utc) - epoch_us(a.arrival_utc)) // 60000000 AS connection_minutes
FROM conn_flights a JOIN airport h ON h.iata_code = a.destination_iata
JOIN conn_flights b ON b.origin_iata = a.destination_iata AND b.destination_iata <> a.origin_iata
 AND b.departure_utc >= a.arrival_utc + to_minutes(CAST(h.min_connection_min AS BIGINT))
 AND b.departure_utc <= a.arrival_utc + INTERVAL 12 HOUR""", ("conn_flights", "airport"))

cte("sched_conns", """
SELECT a.flight_instance_id AS l1_id, b.flight_instance_id AS l2_id, a.origin_iata AS l1_orig,
       b.destination_iata AS l2_dest,
       (epoch_us(b.departure_utc) - epoch_us(a.arrival_utc)) // 60000000 AS connection_minutes
FROM conn_flights a JOIN airport h ON h.iata_code = a.destination_iata
JOIN conn_flights b ON b.origin_iata = a.destination_iata AND b.destination_iata <> a.origin_iata
 AND b.departure_utc >= a.arrival_utc + to_minutes(CAST(h.min_connection_min AS BIGINT))
 AND b.departure_utc <= a.arrival_utc + INTERVAL 12 HOUR
WHERE a.status = 'SCHEDULED' AND b.status = 'SCHEDULED'""", ("conn_flights", "airport"))
cte("two_stop_connections", """
SELECT c1.l1_id, c1.l2_id, c2.l2_id AS l3_id, c1.connection_minutes AS connection1_minutes,
       c2.connection_minutes AS connection2_minutes
FROM sched_conns c1 JOIN sched_conns c2 ON c2.l1_id = c1.l2_id
WHERE c2.l2_dest <> c1.l1_orig""", ("sched_conns",))

cte("search_requests", """
SELECT l.ticket_id AS request_id, r.origin_iata AS origin, r.destination_iata AS destination,
       fi.flight_date, l.cabin_code, pax.passengers, 'COP' AS currency, CAST(l.created_at AS DATE) AS search_date
FROM lines l JOIN flight_instance fi ON fi.flight_instance_id = l.flight_instance_id
JOIN scheduled_flight sf ON sf.scheduled_flight_id = fi.scheduled_flight_id
JOIN route r ON r.route_id = sf.route_id
JOIN (SELECT reservation_id, count(*) AS passengers FROM reservation_passenger
      WHERE passenger_type <> 'INF' GROUP BY reservation_id) pax ON pax.reservation_id = l.reservation_id""", ("lines", "flight_instance", "scheduled_flight", "route", "reservation_passenger"))

cte("sd_cand", """
SELECT q.request_id, q.passengers, q.search_date, a.flight_instance_id AS l1_id, a.route_id AS l1_route,
       a.flight_date AS l1_date, a.cabin_code, a.departure_utc AS l1_dep, a.arrival_utc AS l1_arr,
       a.seats_available AS l1_seats
FROM search_requests q JOIN flight_availability a
  ON a.origin_iata = q.origin AND a.destination_iata = q.destination AND a.flight_date = q.flight_date
 AND a.cabin_code = q.cabin_code
WHERE a.flight_status = 'SCHEDULED' AND a.seats_available >= q.passengers""", ("search_requests", "flight_availability"))

cte("sd_keys", "SELECT l1_route AS route_id, cabin_code, l1_date AS flight_date, search_date AS as_of FROM sd_cand",
    ("sd_cand",))
cte("sd_fares", fare_pick("sd_keys"), ("sd_keys", "fare", "fare_class", "fare_rule"))

cte("search_direct", """
SELECT * FROM (
  SELECT c.*, f.fare_id AS l1_fare_id, f.fare_class_code AS l1_class, f.base_amount AS l1_base, f.tax_pct AS l1_tax,
         f.price_e6 AS price_e6,
         row_number() OVER (PARTITION BY c.request_id ORDER BY f.price_e6, c.l1_dep, c.l1_id) AS rank
  FROM sd_cand c JOIN sd_fares f ON f.route_id = c.l1_route AND f.cabin_code = c.cabin_code
   AND f.flight_date = c.l1_date AND f.as_of = c.search_date) x
WHERE rank <= 50""", ("sd_cand", "sd_fares"))

cte("so_cand", """
SELECT q.request_id, q.passengers, q.search_date, q.cabin_code,
       a.flight_instance_id AS l1_id, a.route_id AS l1_route, a.flight_date AS l1_date, a.origin_iata AS l1_orig,
       a.departure_utc AS l1_dep, a.arrival_utc AS l1_arr, a.seats_available AS l1_seats,
       b.flight_instance_id AS l2_id, b.route_id AS l2_route, b.flight_date AS l2_date,
       b.departure_utc AS l2_dep, b.arrival_utc AS l2_arr, b.seats_available AS l2_seats,
       (epoch_us(b.departure_utc) - epoch_us(a.arrival_utc)) // 60000000 AS connection_minutes
FROM search_requests q
JOIN flight_availability a ON a.origin_iata = q.origin AND a.flight_date = q.flight_date AND a.cabin_code = q.cabin_code
JOIN airport h ON h.iata_code = a.destination_iata
JOIN flight_availability b ON b.origin_iata = a.destination_iata AND b.destination_iata = q.destination
 AND b.cabin_code = q.cabin_code
WHERE a.flight_status = 'SCHEDULED' AND b.flight_status = 'SCHEDULED'
  AND a.seats_available >= q.passengers AND b.seats_available >= q.passengers
  AND b.flight_date BETWEEN q.flight_date AND q.flight_date + 1
  AND b.destination_iata <> a.origin_iata
  AND b.departure_utc >= a.arrival_utc + to_minutes(CAST(h.min_connection_min AS BIGINT))
  AND b.departure_utc <= a.arrival_utc + INTERVAL 12 HOUR""", ("search_requests", "flight_availability", "airport"))

cte("so_keys", """
SELECT l1_route AS route_id, cabin_code, l1_date AS flight_date, search_date AS as_of FROM so_cand
UNION ALL SELECT l2_route, cabin_code, l2_date, search_date FROM so_cand""", ("so_cand",))
cte("so_fares", fare_pick("so_keys"), ("so_keys", "fare", "fare_class", "fare_rule"))

cte("search_one_stop", """
SELECT * FROM (
  SELECT c.*, f1.fare_id AS l1_fare_id, f2.fare_id AS l2_fare_id, f1.base_amount AS l1_base, f1.tax_pct AS l1_tax,
         f2.base_amount AS l2_base, f2.tax_pct AS l2_tax,
         row_number() OVER (PARTITION BY c.request_id
                            ORDER BY f1.price_e6 + f2.price_e6, epoch(c.l2_arr) - epoch(c.l1_dep), c.l1_id, c.l2_id) AS rank
  FROM so_cand c
  JOIN so_fares f1 ON f1.route_id = c.l1_route AND f1.cabin_code = c.cabin_code AND f1.flight_date = c.l1_date
   AND f1.as_of = c.search_date
  JOIN so_fares f2 ON f2.route_id = c.l2_route AND f2.cabin_code = c.cabin_code AND f2.flight_date = c.l2_date
   AND f2.as_of = c.search_date) x
WHERE rank <= 50""", ("so_cand", "so_fares"))


def _tax_cents(p: str) -> str:
    return he(f"CAST({p}_base * 100 AS BIGINT) * CAST({p}_tax * 100 AS BIGINT)", "10000")


def _connects(before: str, after: str, hub: str) -> str:
    return (f"{after}.departure_utc >= {before}.arrival_utc + to_minutes(CAST({hub}.min_connection_min AS BIGINT))"
            f" AND {after}.departure_utc <= {before}.arrival_utc + INTERVAL 12 HOUR")


cte("st_cand", f"""
SELECT q.request_id, q.passengers, q.search_date, q.cabin_code,
       a.flight_instance_id AS l1_id, a.route_id AS l1_route, a.flight_date AS l1_date, a.departure_utc AS l1_dep, a.seats_available AS l1_seats,
       b.flight_instance_id AS l2_id, b.route_id AS l2_route, b.flight_date AS l2_date, b.seats_available AS l2_seats,
       c.flight_instance_id AS l3_id, c.route_id AS l3_route, c.flight_date AS l3_date, c.arrival_utc AS l3_arr, c.seats_available AS l3_seats,
       (epoch_us(b.departure_utc) - epoch_us(a.arrival_utc)) // 60000000 AS connection_minutes,
       (epoch_us(c.departure_utc) - epoch_us(b.arrival_utc)) // 60000000 AS connection2_minutes
FROM search_requests q
JOIN flight_availability a ON a.origin_iata = q.origin AND a.flight_date = q.flight_date AND a.cabin_code = q.cabin_code
JOIN airport h ON h.iata_code = a.destination_iata
JOIN flight_availability b ON b.origin_iata = a.destination_iata AND b.cabin_code = q.cabin_code
 AND b.flight_date BETWEEN a.flight_date AND a.flight_date + 1 AND {_connects('a', 'b', 'h')}
JOIN airport k ON k.iata_code = b.destination_iata
JOIN flight_availability c ON c.origin_iata = b.destination_iata AND c.destination_iata = q.destination AND c.cabin_code = q.cabin_code
 AND c.flight_date BETWEEN b.flight_date AND b.flight_date + 1 AND {_connects('b', 'c', 'k')}
WHERE a.flight_status = 'SCHEDULED' AND b.flight_status = 'SCHEDULED' AND c.flight_status = 'SCHEDULED'
  AND a.seats_available >= q.passengers AND b.seats_available >= q.passengers AND c.seats_available >= q.passengers
  AND a.destination_iata <> q.destination AND b.destination_iata NOT IN (q.origin, q.destination)""",
    ("search_requests", "flight_availability", "airport"))

cte("st_keys", """
SELECT l1_route AS route_id, cabin_code, l1_date AS flight_date, search_date AS as_of FROM st_cand
UNION ALL SELECT l2_route, cabin_code, l2_date, search_date FROM st_cand
UNION ALL SELECT l3_route, cabin_code, l3_date, search_date FROM st_cand""", ("st_cand",))
cte("st_fares", fare_pick("st_keys"), ("st_keys", "fare", "fare_class", "fare_rule"))

cte("search_two_stop", """
SELECT * FROM (
  SELECT c.*, """ + ", ".join(f"f{i}.fare_id AS l{i}_fare_id, f{i}.base_amount AS l{i}_base, f{i}.tax_pct AS l{i}_tax" for i in (1, 2, 3)) + """,
         row_number() OVER (PARTITION BY c.request_id
                            ORDER BY f1.price_e6 + f2.price_e6 + f3.price_e6, epoch(c.l3_arr) - epoch(c.l1_dep), c.l1_id, c.l2_id, c.l3_id) AS rank
  FROM st_cand c """ + " ".join(
    f"JOIN st_fares f{i} ON f{i}.route_id = c.l{i}_route AND f{i}.cabin_code = c.cabin_code AND f{i}.flight_date = c.l{i}_date AND f{i}.as_of = c.search_date"
    for i in (1, 2, 3)) + """) x
WHERE rank <= 50""", ("st_cand", "st_fares"))


cte("so_offers_all", f"""
SELECT request_id, 0 AS stops, l1_id AS first_flight_id, CAST(NULL AS BIGINT) AS second_flight_id, CAST(NULL AS BIGINT) AS third_flight_id,
       (epoch(l1_arr) - epoch(l1_dep)) // 60 AS total_duration_minutes, CAST(NULL AS BIGINT) AS connection_minutes, CAST(NULL AS BIGINT) AS connection2_minutes,
       CAST(l1_base * 100 AS BIGINT) AS fare_c, {_tax_cents('l1')} AS tax_c, passengers
FROM search_direct
UNION ALL
SELECT request_id, 1, l1_id, l2_id, NULL, (epoch(l2_arr) - epoch(l1_dep)) // 60, connection_minutes, NULL,
       CAST(l1_base * 100 AS BIGINT) + CAST(l2_base * 100 AS BIGINT), {_tax_cents('l1')} + {_tax_cents('l2')}, passengers
FROM search_one_stop
UNION ALL
SELECT request_id, 2, l1_id, l2_id, l3_id, (epoch(l3_arr) - epoch(l1_dep)) // 60, connection_minutes, connection2_minutes,
       CAST(l1_base * 100 AS BIGINT) + CAST(l2_base * 100 AS BIGINT) + CAST(l3_base * 100 AS BIGINT), {_tax_cents('l1')} + {_tax_cents('l2')} + {_tax_cents('l3')}, passengers
FROM search_two_stop""", ("search_direct", "search_one_stop", "search_two_stop"))

cte("search_offers", """
SELECT * FROM (
  SELECT request_id, stops, first_flight_id, second_flight_id, third_flight_id, total_duration_minutes, connection_minutes, connection2_minutes,
         CAST(fare_c * passengers AS DOUBLE) / 100 AS fare_amount, CAST(tax_c * passengers AS DOUBLE) / 100 AS tax_amount,
         CAST((fare_c + tax_c) * passengers AS DOUBLE) / 100 AS total_amount,
         CAST(fare_c + tax_c AS DOUBLE) / 100 AS price_per_passenger,
         row_number() OVER (PARTITION BY request_id ORDER BY (fare_c + tax_c) * passengers, total_duration_minutes,
                            stops, first_flight_id, second_flight_id NULLS FIRST, third_flight_id NULLS FIRST) AS rank
  FROM so_offers_all) x
WHERE rank <= 40""", ("so_offers_all",))

cte("next_sellable_flight", f"""
SELECT cabin_code, flight_instance_id, flight_date, capacity FROM (
  SELECT inv.cabin_code, fi.flight_instance_id, fi.flight_date, inv.capacity,
         row_number() OVER (PARTITION BY inv.cabin_code ORDER BY fi.flight_date, fi.flight_instance_id) AS rn
  FROM flight_instance fi JOIN flight_inventory inv ON inv.flight_instance_id = fi.flight_instance_id
  WHERE fi.status = 'SCHEDULED' AND fi.flight_date >= {AS_OF} + 2) x WHERE rn = 1""",
    ("flight_instance", "flight_inventory"))

cte("fx_cand", """
SELECT q.request_id, s AS shift, q.passengers, q.search_date, CAST(q.flight_date + CAST(s AS INTEGER) AS DATE) AS flight_date,
       a.flight_instance_id AS l1_id, a.route_id AS l1_route, a.flight_date AS l1_date, a.cabin_code,
       a.departure_utc AS l1_dep
FROM search_requests q CROSS JOIN range(-3, 4) t(s)
JOIN flight_availability a ON a.origin_iata = q.origin AND a.destination_iata = q.destination
 AND a.flight_date = q.flight_date + CAST(s AS INTEGER) AND a.cabin_code = q.cabin_code
WHERE a.flight_status = 'SCHEDULED' AND a.seats_available >= q.passengers""",
    ("search_requests", "flight_availability"))
cte("fx_keys", "SELECT l1_route AS route_id, cabin_code, l1_date AS flight_date, search_date AS as_of FROM fx_cand",
    ("fx_cand",))
cte("fx_fares", fare_pick("fx_keys"), ("fx_keys", "fare", "fare_class", "fare_rule"))
cte("flexible_dates", """
SELECT request_id, shift, flight_date, flight_instance_id, unit_price FROM (
  SELECT c.request_id, c.shift, c.flight_date, c.l1_id AS flight_instance_id,
         CAST(f.price_e6 AS DOUBLE) / 1000000 AS unit_price,
         row_number() OVER (PARTITION BY c.request_id, c.shift ORDER BY f.price_e6, c.l1_dep, c.l1_id) AS rn
  FROM fx_cand c JOIN fx_fares f ON f.route_id = c.l1_route AND f.cabin_code = c.cabin_code
   AND f.flight_date = c.l1_date AND f.as_of = c.search_date) x
WHERE rn = 1""", ("fx_cand", "fx_fares"))

cte("offer_legs", """
SELECT request_id, rank, 0 AS seq, first_flight_id AS flight_id FROM search_offers
UNION ALL SELECT request_id, rank, 1, second_flight_id FROM search_offers WHERE second_flight_id IS NOT NULL
UNION ALL SELECT request_id, rank, 2, third_flight_id FROM search_offers WHERE third_flight_id IS NOT NULL""", ("search_offers",))

cte("offer_segments", """
SELECT l.request_id, l.rank, '[' || string_agg(
         '{"seq":' || l.seq || ',"flight_instance_id":' || a.flight_instance_id || ',"flight_number":"' || a.flight_number
         || '","origin":"' || a.origin_iata || '","destination":"' || a.destination_iata
         || '","departure_utc":"' || strftime(a.departure_utc, '%Y-%m-%dT%H:%M:%S.000Z')
         || '","arrival_utc":"' || strftime(a.arrival_utc, '%Y-%m-%dT%H:%M:%S.000Z')
         || '","cabin_code":"' || a.cabin_code || '","seats_available":' || a.seats_available || '}', ',' ORDER BY l.seq) || ']' AS segments_json
FROM offer_legs l JOIN search_requests q ON q.request_id = l.request_id
JOIN flight_availability a ON a.flight_instance_id = l.flight_id AND a.cabin_code = q.cabin_code
GROUP BY 1, 2""", ("offer_legs", "search_requests", "flight_availability"))

cte("offer_documents", """
SELECT o.request_id, o.rank, o.stops, o.total_amount, s.segments_json
FROM search_offers o JOIN offer_segments s ON s.request_id = o.request_id AND s.rank = o.rank""",
    ("search_offers", "offer_segments"))
