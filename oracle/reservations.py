"""Reservation-state jobs in DuckDB SQL."""

from __future__ import annotations

from oracle.model import pnr, cte
from oracle.search import he

NOW = "TIMESTAMP '1998-01-01 00:00:00'"

cte("seated", """
SELECT r.reservation_id, coalesce(p.n, 0) AS seats FROM reservation r
LEFT JOIN (SELECT reservation_id, count(*) AS n FROM reservation_passenger WHERE passenger_type <> 'INF'
           GROUP BY 1) p ON p.reservation_id = r.reservation_id""", ("reservation", "reservation_passenger"))

cte("itinerary_validation", f"""
SELECT itinerary_id, count(*) AS segments,
       min(sequence_no) FILTER (WHERE reason IS NOT NULL) AS failed_sequence_no,
       coalesce(arg_min(reason, sequence_no) FILTER (WHERE reason IS NOT NULL), 'OK') AS result
FROM (
  SELECT s.itinerary_id, s.sequence_no,
         CASE WHEN f.status <> 'SCHEDULED' THEN 'NOT_SCHEDULED'
              WHEN f.departure_utc <= {NOW} THEN 'DEPARTED'
              WHEN prev_dest IS NULL THEN NULL
              WHEN prev_dest <> f.origin_iata THEN 'NOT_CONTINUOUS'
              WHEN epoch(f.departure_utc) - epoch(prev_arr) < h.min_connection_min * 60 THEN 'SHORT_CONNECTION'
              WHEN epoch(f.departure_utc) - epoch(prev_arr) > 12 * 3600 THEN 'LONG_CONNECTION' END AS reason
  FROM (SELECT s.*, lag(f.destination_iata) OVER w AS prev_dest, lag(f.arrival_utc) OVER w AS prev_arr
        FROM itinerary_segment s JOIN conn_flights f ON f.flight_instance_id = s.flight_instance_id
        WINDOW w AS (PARTITION BY s.itinerary_id ORDER BY s.sequence_no)) s
  JOIN conn_flights f ON f.flight_instance_id = s.flight_instance_id
  LEFT JOIN airport h ON h.iata_code = s.prev_dest) v
GROUP BY itinerary_id""", ("itinerary_segment", "conn_flights", "airport"))

cte("transition_audit", """
SELECT event_id, reservation_id, previous_status, from_status, to_status,
       from_status IS NOT DISTINCT FROM previous_status AS from_matches,
       coalesce((previous_status IS NULL AND to_status = 'HELD')
                OR (previous_status = 'HELD' AND to_status IN ('CONFIRMED', 'CANCELLED', 'EXPIRED'))
                OR (previous_status = 'CONFIRMED' AND to_status = 'CANCELLED'), FALSE) AS is_legal
FROM (SELECT *, lag(to_status) OVER (PARTITION BY reservation_id ORDER BY occurred_at, event_id) AS previous_status
      FROM reservation_event WHERE to_status IS NOT NULL) e""", ("reservation_event",))

cte("expired_holds", f"""
SELECT reservation_id, pnr, hold_expires_at FROM reservation
WHERE status = 'HELD' AND hold_expires_at < {NOW}""", ("reservation",))

cte("seat_demand", """
SELECT i.reservation_id, s.flight_instance_id, s.cabin_code, sum(st.seats) AS demand
FROM itinerary_segment s JOIN itinerary i ON i.itinerary_id = s.itinerary_id
JOIN seated st ON st.reservation_id = i.reservation_id
WHERE s.status = 'ACTIVE' GROUP BY 1, 2, 3""", ("itinerary_segment", "itinerary", "seated"))

cte("q_req", """
SELECT s.itinerary_id AS reservation_id, s.segment_id, s.flight_instance_id, s.cabin_code,
       CASE WHEN s.segment_id % 2 = 0 THEN s.fare_class_code END AS fare_class_code,
       CAST(r.created_at AS DATE) AS as_of, r.agency_id
FROM itinerary_segment s JOIN reservation r ON r.reservation_id = s.itinerary_id
WHERE r.status = 'HELD'""", ("itinerary_segment", "reservation"))

cte("q_flights", "SELECT DISTINCT flight_instance_id, cabin_code, route_id, flight_date FROM flight_availability",
    ("flight_availability",))

cte("quote_segments", f"""
SELECT reservation_id, segment_id, fare_id, base_amount, net_c, {he('net_c * tax_bp', '10000')} AS tax_c,
       CAST(net_c AS DOUBLE) / 100 AS net_fare,
       CAST({he('net_c * tax_bp', '10000')} AS DOUBLE) / 100 AS tax_amount,
       CASE WHEN route_id IS NULL THEN 'NO_INVENTORY' WHEN fare_id IS NULL THEN 'NO_ELIGIBLE_FARE' END AS reason
FROM (
  SELECT q.*, qf.route_id, p.fare_id, p.base_amount, CAST(p.tax_pct * 100 AS BIGINT) AS tax_bp,
         {he('CAST(p.base_amount * 100 AS BIGINT) * (10000 - coalesce(CAST(CASE WHEN q.agency_id IS NOT NULL THEN 800 END AS BIGINT), 0))', '10000')} AS net_c
  FROM q_req q
  LEFT JOIN q_flights qf ON qf.flight_instance_id = q.flight_instance_id AND qf.cabin_code = q.cabin_code
  LEFT JOIN (
    SELECT * FROM (
      SELECT q2.segment_id, f.fare_id, f.base_amount, f.tax_pct,
             row_number() OVER (PARTITION BY q2.segment_id ORDER BY f.base_amount, f.fare_id) AS rn
      FROM q_req q2 JOIN q_flights qf2 ON qf2.flight_instance_id = q2.flight_instance_id AND qf2.cabin_code = q2.cabin_code
      JOIN fare f ON f.route_id = qf2.route_id AND f.currency = 'COP'
      JOIN fare_class fc ON fc.fare_class_code = f.fare_class_code AND fc.cabin_code = q2.cabin_code
      JOIN fare_rule fr ON fr.fare_rule_id = f.fare_rule_id
      WHERE q2.as_of BETWEEN f.valid_from AND f.valid_to AND fr.min_advance_days <= qf2.flight_date - q2.as_of
        AND (q2.fare_class_code IS NULL OR f.fare_class_code = q2.fare_class_code)) z WHERE rn = 1) p
    ON p.segment_id = q.segment_id) x""", ("q_req", "q_flights", "fare", "fare_class", "fare_rule"))

cte("reservation_total", """
SELECT q.reservation_id, CAST(sum((q.net_c + q.tax_c) * st.seats) AS DOUBLE) / 100 AS total_amount,
       count(*) AS quoted_segments
FROM quote_segments q JOIN seated st ON st.reservation_id = q.reservation_id
WHERE q.reason IS NULL GROUP BY 1""", ("quote_segments", "seated"))

cte("issue_tickets", f"""
SELECT r.pnr || '-' || s.segment_id || '-' || p.passenger_ref AS ticket_number, r.reservation_id, p.passenger_ref,
       s.segment_id, s.quoted_fare_id AS fare_id, s.quoted_fare_amount AS fare_amount, s.quoted_tax_amount AS tax_amount,
       CAST({he('CAST(s.quoted_fare_amount * 100 AS BIGINT) * (CASE WHEN r.agency_id IS NOT NULL THEN 500 ELSE 0 END)', '10000')}
            AS DOUBLE) / 100 AS commission_amount
FROM reservation r JOIN itinerary i ON i.reservation_id = r.reservation_id
JOIN itinerary_segment s ON s.itinerary_id = i.itinerary_id
JOIN reservation_passenger p ON p.reservation_id = r.reservation_id
WHERE r.status = 'CONFIRMED' AND s.status = 'ACTIVE' AND p.passenger_type <> 'INF'""",
    ("reservation", "itinerary", "itinerary_segment", "reservation_passenger"))

cte("apply_cancellations", """
SELECT r.reservation_id, r.status AS previous_status, 'CANCELLED' AS new_status,
       it.n AS itineraries_cancelled,
       coalesce(c.n, 0) AS segments_cancelled, coalesce(c.seats, 0) AS seats_released,
       CASE WHEN r.status = 'CONFIRMED' THEN 'seats_sold' ELSE 'seats_held' END AS released_from,
       CASE WHEN r.agency_id IS NOT NULL THEN r.total_amount END AS credit_returned
FROM (SELECT DISTINCT reservation_id FROM reservation_event WHERE to_status = 'CANCELLED') q
JOIN reservation r ON r.reservation_id = q.reservation_id
JOIN (SELECT reservation_id, count(*) FILTER (WHERE status = 'ACTIVE') AS n FROM itinerary GROUP BY 1) it ON it.reservation_id = r.reservation_id
LEFT JOIN (SELECT i.reservation_id, count(*) AS n, sum(st.seats) AS seats
           FROM itinerary_segment s JOIN itinerary i ON i.itinerary_id = s.itinerary_id
           JOIN seated st ON st.reservation_id = i.reservation_id
           WHERE s.status = 'ACTIVE' GROUP BY 1) c ON c.reservation_id = r.reservation_id
WHERE r.status IN ('HELD', 'CONFIRMED')""", ("reservation_event", "reservation", "itinerary", "itinerary_segment", "seated"))

cte("state_as_of", """
SELECT reservation_id, arg_max(to_status, (occurred_at, event_id)) AS status, max(occurred_at) AS since,
       count(*) AS status_events
FROM reservation_event WHERE to_status IS NOT NULL AND occurred_at <= TIMESTAMP '2024-01-16 00:00:00'
GROUP BY reservation_id""", ("reservation_event",))

cte("dedupe_payments", """
SELECT psp_event_id, arg_min(payment_event_id, (received_at, payment_event_id)) AS payment_event_id,
       arg_min(payment_id, (received_at, payment_event_id)) AS payment_id, min(received_at) AS received_at,
       count(*) AS deliveries
FROM payment_event GROUP BY psp_event_id""", ("payment_event",))

cte("passenger_x", """
SELECT rp.passenger_id, 'PAX' || rp.passenger_ref || '-' || (r.reservation_id % 7) AS first_name, r.c_name AS last_name,
       CAST(r.created_at AS DATE) - CAST(r.o_custkey % 20000 + 7000 AS INTEGER) AS birth_date,
       'CC' AS document_type, r.o_custkey || '-' || rp.passenger_ref AS document_number,
       CASE WHEN r.reservation_id % 4 = 0 THEN NULL ELSE 'p' || r.reservation_id || '@mail.test' END AS email,
       '+57' || r.o_custkey AS phone, r.created_at
FROM reservation_passenger rp JOIN reservation r ON r.reservation_id = rp.reservation_id""",
    ("reservation_passenger", "reservation"))

cte("upsert_passengers", """
SELECT document_type, document_number,
       arg_min(passenger_id, (created_at, passenger_id)) AS passenger_id,
       arg_max(first_name, (created_at, passenger_id)) AS first_name,
       arg_max(last_name, (created_at, passenger_id)) AS last_name,
       arg_max(email, (created_at, passenger_id)) FILTER (WHERE email IS NOT NULL) AS email,
       arg_min(birth_date, (created_at, passenger_id)) AS birth_date,
       arg_min(phone, (created_at, passenger_id)) AS phone,
       count(*) AS versions
FROM passenger_x GROUP BY document_type, document_number""", ("passenger_x",))

cte("agency_credit_ledger", """
SELECT agency_id, reservation_id, entry_at, kind, amount,
       sum(amount) OVER (PARTITION BY agency_id ORDER BY entry_at, kind, reservation_id
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS credit_used,
       sum(amount) OVER (PARTITION BY agency_id ORDER BY entry_at, kind, reservation_id
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) > 50000000 AS is_breach
FROM (SELECT agency_id, reservation_id, created_at AS entry_at, 0 AS kind, total_amount AS amount
      FROM reservation WHERE agency_id IS NOT NULL
      UNION ALL
      SELECT agency_id, reservation_id, created_at, 1, -total_amount
      FROM reservation WHERE agency_id IS NOT NULL AND status = 'CANCELLED') e""", ("reservation",))

cte("expire_holds", f"""
SELECT inv.flight_instance_id, inv.cabin_code, inv.capacity, inv.seats_sold, inv.seats_held AS seats_held_before,
       rel.n AS held_released, greatest(inv.seats_held - rel.n, 0) AS seats_held
FROM flight_inventory inv JOIN (
  SELECT d.flight_instance_id, d.cabin_code, sum(d.demand) AS n FROM seat_demand d
  JOIN reservation r ON r.reservation_id = d.reservation_id
  WHERE r.status = 'HELD' AND r.hold_expires_at < {NOW} GROUP BY 1, 2) rel
  ON rel.flight_instance_id = inv.flight_instance_id AND rel.cabin_code = inv.cabin_code""",
    ("flight_inventory", "seat_demand", "reservation"))

cte("unknown_flights", """
SELECT q.flight_instance_id, q.cabin_code,
       CASE WHEN fi.flight_instance_id IS NULL THEN 'UNKNOWN_FLIGHT' ELSE 'NO_INVENTORY' END AS reason
FROM (SELECT DISTINCT s.flight_instance_id, c.cabin_code FROM itinerary_segment s,
      (VALUES ('BUS'), ('ECO')) c(cabin_code)) q
LEFT JOIN flight_instance fi ON fi.flight_instance_id = q.flight_instance_id
LEFT JOIN flight_inventory inv ON inv.flight_instance_id = q.flight_instance_id AND inv.cabin_code = q.cabin_code
WHERE fi.flight_instance_id IS NULL OR inv.flight_instance_id IS NULL""",
    ("itinerary_segment", "flight_instance", "flight_inventory"))

cte("reservation_by_name", """
SELECT DISTINCT r.pnr, r.reservation_id, r.status
FROM (SELECT upper(trim(' ' || lower(pnr))) AS pnr, upper(trim(lower(c_name) || '  ')) AS ln
      FROM reservation WHERE reservation_id % 3 = 0
      UNION ALL
      SELECT upper(trim(pnr)), upper(trim(c_name || 'X')) FROM reservation WHERE reservation_id % 3 = 1) l
JOIN reservation r ON r.pnr = l.pnr
WHERE EXISTS (SELECT 1 FROM reservation_passenger rp JOIN passenger_x p ON p.passenger_id = rp.passenger_id
              WHERE rp.reservation_id = r.reservation_id AND upper(trim(p.last_name)) = l.ln)""",
    ("reservation", "reservation_passenger", "passenger_x"))

cte("request_latency_summary", """
SELECT day, count(*) FILTER (WHERE outcome = 'created') AS created, count(*) FILTER (WHERE outcome = 'rejected') AS rejected,
       count(*) FILTER (WHERE outcome = 'error') AS errors, count(*) AS requests,
       quantile_cont(latency_ms, 0.5) AS p50_ms,
       max(latency_ms) FILTER (WHERE idx = least(floor(n * 0.95), n - 1)) AS p95_ms, max(latency_ms) AS max_ms
FROM (SELECT *, row_number() OVER (PARTITION BY day ORDER BY latency_ms) - 1 AS idx,
             count(*) OVER (PARTITION BY day) AS n
      FROM (SELECT CAST(ts AS DATE) AS day,
                   CASE WHEN event_type = 'purchase' THEN 'created' WHEN event_type = 'error' THEN 'error'
                        ELSE 'rejected' END AS outcome, value AS latency_ms FROM events) a) b
GROUP BY day""")

_CODES = 32 ** 6


def _drawn(salt: int) -> str:
    return pnr(f"CAST('0x' || substr(md5(reservation_id || ':{salt}'), 1, 15) AS BIGINT) % {_CODES}")


cte("pnr_assign", f"""
WITH zero AS (SELECT min(reservation_id) AS reservation_id, pnr FROM (SELECT reservation_id, {_drawn(0)} AS pnr FROM reservation) a
              GROUP BY pnr),
one AS (SELECT min(reservation_id) AS reservation_id, pnr
        FROM (SELECT reservation_id, {_drawn(1)} AS pnr FROM reservation
              WHERE reservation_id NOT IN (SELECT reservation_id FROM zero)) b
        WHERE pnr NOT IN (SELECT pnr FROM zero) GROUP BY pnr)
SELECT reservation_id, pnr, 0 AS salt FROM zero UNION ALL SELECT reservation_id, pnr, 1 FROM one""", ("reservation",))

cte("document_passengers", """
SELECT rp.reservation_id, '"passengers":[' || string_agg(
         '{"passenger_ref":' || rp.passenger_ref || ',"passenger_type":"' || rp.passenger_type || '","first_name":"' || p.first_name
         || '","last_name":"' || p.last_name || '"}', ',' ORDER BY rp.passenger_ref) || ']' AS body
FROM reservation_passenger rp JOIN passenger_x p ON p.passenger_id = rp.passenger_id GROUP BY 1""",
    ("reservation_passenger", "passenger_x"))

cte("document_segments", """
SELECT itinerary_id, ',"segments":[' || string_agg(
         '{"sequence_no":' || sequence_no || ',"segment_id":' || segment_id || ',"flight_instance_id":' || flight_instance_id
         || ',"cabin_code":"' || cabin_code || '","fare_class_code":"' || fare_class_code || '","status":"' || status || '"}',
         ',' ORDER BY sequence_no) || ']' AS body
FROM itinerary_segment GROUP BY 1""", ("itinerary_segment",))

cte("document_itineraries", """
SELECT i.reservation_id, '"itineraries":[' || string_agg(
         '{"sequence_no":1,"itinerary_id":' || i.itinerary_id || ',"status":"' || i.status || '"'
         || coalesce(s.body, '') || '}', ',' ORDER BY i.itinerary_id) || ']' AS body
FROM itinerary i LEFT JOIN document_segments s ON s.itinerary_id = i.itinerary_id GROUP BY 1""",
    ("itinerary", "document_segments"))

cte("document_tickets", """
SELECT reservation_id, '"tickets":[' || string_agg(
         '{"ticket_id":' || ticket_id || ',"ticket_number":"' || ticket_number || '","status":"' || status || '","total":'
         || CAST(fare_amount + tax_amount AS DECIMAL(18, 2)) || '}', ',' ORDER BY ticket_id) || ']' AS body
FROM ticket GROUP BY 1""", ("ticket",))

cte("reservation_document", """
SELECT r.reservation_id, r.pnr, r.status, '{' || concat_ws(',', p.body, i.body, t.body) || '}' AS document
FROM reservation r LEFT JOIN document_passengers p ON p.reservation_id = r.reservation_id
LEFT JOIN document_itineraries i ON i.reservation_id = r.reservation_id
LEFT JOIN document_tickets t ON t.reservation_id = r.reservation_id""",
    ("reservation", "document_passengers", "document_itineraries", "document_tickets"))
