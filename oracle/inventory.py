"""Seat maps, materialisation and inventory in DuckDB SQL."""

from __future__ import annotations

from oracle.model import cte

AS_OF = "DATE '1998-01-01'"

cte("layouts", """
SELECT * FROM (VALUES (1, 'ECO', 1, 17, 'ACDF', [9]), (2, 'BUS', 1, 3, 'ACDF', []),
                      (2, 'ECO', 10, 34, 'ABCDEF', [14, 15]), (3, 'BUS', 1, 3, 'ACDF', []),
                      (3, 'ECO', 10, 36, 'ABCDEF', [14, 15]))
       t(seat_map_id, cabin_code, row_from, row_to, letters, exit_rows)""")

cte("seats", """
SELECT seat_map_id, CAST(r AS VARCHAR) || l AS seat_number, cabin_code, r AS row_num, l AS seat_letter,
       l IN ('A', 'F') AS is_window, l IN ('C', 'D') AS is_aisle, list_contains(exit_rows, r) AS is_exit_row
FROM (SELECT seat_map_id, cabin_code, r, exit_rows, unnest(string_split(letters, '')) AS l
      FROM (SELECT *, unnest(range(row_from, row_to + 1)) AS r FROM layouts) x) y""", ("layouts",))

cte("layout_capacity", "SELECT seat_map_id, cabin_code, count(*) AS capacity FROM seats GROUP BY 1, 2", ("seats",))

cte("seat_map_seats", "SELECT a.aircraft_id, s.* FROM aircraft a JOIN seats s ON s.seat_map_id = a.seat_map_id",
    ("aircraft", "seats"))

cte("seat_map_capacity", """
SELECT aircraft_id, seat_map_id, cabin_code, count(*) AS capacity FROM seat_map_seats GROUP BY 1, 2, 3""",
    ("seat_map_seats",))

cte("m_inst", f"""
SELECT sf.scheduled_flight_id * 100000 + (d - DATE '1970-01-01') AS flight_instance_id, sf.scheduled_flight_id,
       d AS flight_date, sf.seat_map_id,
       CAST(CAST(d AS VARCHAR) || ' ' || sf.departure_time_local || ':00' AS TIMESTAMP) AS departure_utc,
       CAST(CAST(d AS VARCHAR) || ' ' || sf.arrival_time_local || ':00' AS TIMESTAMP) AS arrival_utc
FROM scheduled_flight sf JOIN route r ON r.route_id = sf.route_id,
     (SELECT CAST(unnest(generate_series({AS_OF}, {AS_OF} + 60, INTERVAL 1 DAY)) AS DATE) AS d) days
WHERE d BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'
  AND strpos('1234567', CAST(isodow(d) AS VARCHAR)) > 0""", ("scheduled_flight", "route"))

# The rotation's order of two aircraft depends on their ids modulo 4, so the first of each residue class is enough.
cte("m_first", """
SELECT seat_map_id, min(aircraft_id) AS aircraft_id FROM aircraft WHERE status = 'ACTIVE'
GROUP BY seat_map_id, aircraft_id % 4""", ("aircraft",))

cte("m_pick", """
SELECT flight_instance_id, aircraft_id FROM (
  SELECT i.flight_instance_id, a.aircraft_id,
         row_number() OVER (PARTITION BY i.flight_instance_id
                            ORDER BY (a.aircraft_id + i.scheduled_flight_id + dayofyear(i.flight_date)) % 4,
                                     a.aircraft_id) AS rn
  FROM m_inst i JOIN m_first a ON a.seat_map_id = i.seat_map_id) z
WHERE rn = 1""", ("m_inst", "m_first"))

cte("materialize_flights", """
SELECT i.flight_instance_id, i.scheduled_flight_id, i.flight_date, i.departure_utc, i.arrival_utc,
       pick.aircraft_id, 'SCHEDULED' AS status
FROM m_inst i LEFT JOIN m_pick pick ON pick.flight_instance_id = i.flight_instance_id""", ("m_inst", "m_pick"))

cte("assign_aircraft", "SELECT scheduled_flight_id, flight_date, aircraft_id FROM materialize_flights",
    ("materialize_flights",))

cte("flight_inventory_init", """
SELECT m.flight_instance_id, c.cabin_code, c.capacity, 0 AS seats_sold, 0 AS seats_held
FROM m_inst m JOIN layout_capacity c ON c.seat_map_id = m.seat_map_id""", ("m_inst", "layout_capacity"))

cte("fare_grid", """
SELECT r.route_id * 10 + g.rule AS fare_id, r.route_id, g.code AS fare_class_code, g.rule AS fare_rule_id,
       round(CAST(r.distance_km AS DECIMAL(12,2)) * g.factor, -3) AS base_amount, CAST(19.00 AS DECIMAL(5,2)) AS tax_pct
FROM route r, (VALUES ('P', 1, CAST(380.0 AS DECIMAL(8,1))), ('Y', 2, CAST(620.0 AS DECIMAL(8,1))),
                      ('B', 3, CAST(940.0 AS DECIMAL(8,1))), ('J', 4, CAST(2100.0 AS DECIMAL(8,1)))) g(code, rule, factor)""",
    ("route",))

cte("seed_scarcity", """
SELECT inv.flight_instance_id, inv.cabin_code, inv.capacity,
       CASE WHEN t.flight_instance_id IS NOT NULL THEN inv.capacity - 1 ELSE inv.seats_sold END AS seats_sold,
       CASE WHEN t.flight_instance_id IS NOT NULL THEN 0 ELSE inv.seats_held END AS seats_held
FROM flight_inventory inv LEFT JOIN next_sellable_flight t
  ON t.flight_instance_id = inv.flight_instance_id AND t.cabin_code = inv.cabin_code""",
    ("flight_inventory", "next_sellable_flight"))

cte("scarce_inventory", "SELECT * FROM flight_availability WHERE seats_available = 1", ("flight_availability",))

cte("oversell_check", """
SELECT flight_instance_id, cabin_code, capacity, seats_sold, seats_held, seats_sold + seats_held AS committed
FROM flight_inventory WHERE seats_sold + seats_held > floor(capacity * oversell_factor)""", ("flight_inventory",))

cte("inventory_reconciliation", """
SELECT inv.flight_instance_id, inv.cabin_code, inv.seats_sold, inv.seats_held,
       coalesce(a.c, 0) AS actual_confirmed, coalesce(a.h, 0) AS actual_held,
       inv.seats_sold <> coalesce(a.c, 0) OR inv.seats_held <> coalesce(a.h, 0) AS is_mismatch
FROM flight_inventory inv LEFT JOIN (
  SELECT s.flight_instance_id, s.cabin_code, sum(s.seats) FILTER (WHERE r.status = 'CONFIRMED') AS c,
         sum(s.seats) FILTER (WHERE r.status = 'HELD') AS h
  FROM itinerary_segment s JOIN itinerary i ON i.itinerary_id = s.itinerary_id
  JOIN reservation r ON r.reservation_id = i.reservation_id
  WHERE s.status = 'ACTIVE' GROUP BY 1, 2) a
  ON a.flight_instance_id = inv.flight_instance_id AND a.cabin_code = inv.cabin_code""",
    ("flight_inventory", "itinerary_segment", "itinerary", "reservation"))

cte("inventory_from_events", """
SELECT s.flight_instance_id, s.cabin_code, sum(n.hu * s.seats) AS seats_held, sum(n.su * s.seats) AS seats_sold,
       sum(n.hu * s.seats) < 0 OR sum(n.su * s.seats) < 0 AS is_negative
FROM itinerary_segment s JOIN itinerary i ON i.itinerary_id = s.itinerary_id
JOIN (SELECT reservation_id,
             sum(CASE WHEN (prior IS NULL OR prior IN ('EXPIRED', 'CANCELLED')) AND to_status = 'HELD' THEN 1
                      WHEN prior = 'HELD' AND to_status IN ('CONFIRMED', 'CANCELLED', 'EXPIRED') THEN -1
                      ELSE 0 END) AS hu,
             sum(CASE WHEN prior = 'HELD' AND to_status = 'CONFIRMED' THEN 1
                      WHEN prior = 'CONFIRMED' AND to_status = 'CANCELLED' THEN -1 ELSE 0 END) AS su
      FROM (SELECT reservation_id, to_status,
                   lag(to_status) OVER (PARTITION BY reservation_id ORDER BY occurred_at, event_id) AS prior
            FROM reservation_event WHERE to_status IS NOT NULL) e
      GROUP BY reservation_id) n ON n.reservation_id = i.reservation_id
GROUP BY s.flight_instance_id, s.cabin_code""", ("itinerary_segment", "itinerary", "reservation_event"))

cte("capacity_cut_impact", """
SELECT inv.flight_instance_id, inv.cabin_code, sf.seat_map_id, inv.capacity AS old_capacity,
       coalesce(c.capacity, 0) AS new_capacity, inv.seats_sold + inv.seats_held AS committed,
       inv.seats_sold + inv.seats_held - coalesce(c.capacity, 0) AS seats_to_reaccommodate
FROM flight_inventory inv JOIN flight_instance fi ON fi.flight_instance_id = inv.flight_instance_id
JOIN scheduled_flight sf ON sf.scheduled_flight_id = fi.scheduled_flight_id
LEFT JOIN layout_capacity c ON c.seat_map_id = sf.seat_map_id AND c.cabin_code = inv.cabin_code
WHERE inv.seats_sold + inv.seats_held > coalesce(c.capacity, 0)""",
    ("flight_inventory", "flight_instance", "scheduled_flight", "layout_capacity"))

cte("sold_seats", """
SELECT flight_instance_id, cabin_code, ticket_id, hi - seats + unnest(range(1, seats + 1)) AS seat_rank
FROM (SELECT sg.flight_instance_id, sg.cabin_code, t.ticket_id, t.seats,
             sum(t.seats) OVER (PARTITION BY sg.flight_instance_id, sg.cabin_code ORDER BY t.ticket_id
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hi
      FROM ticket t JOIN reservation r ON r.reservation_id = t.reservation_id
      JOIN itinerary_segment sg ON sg.segment_id = t.segment_id
      WHERE t.status <> 'CANCELLED' AND r.status = 'CONFIRMED') x""", ("ticket", "reservation", "itinerary_segment"))
cte("seat_grid", """
SELECT fi.flight_instance_id, s.cabin_code, s.seat_number,
       row_number() OVER (PARTITION BY fi.flight_instance_id, s.cabin_code ORDER BY s.row_num, s.seat_letter) AS seat_rank
FROM flight_instance fi JOIN scheduled_flight sf ON sf.scheduled_flight_id = fi.scheduled_flight_id
JOIN seats s ON s.seat_map_id = sf.seat_map_id""", ("flight_instance", "scheduled_flight", "seats"))
cte("seat_map_status", """
SELECT coalesce(g.flight_instance_id, t.flight_instance_id) AS flight_instance_id, coalesce(g.cabin_code, t.cabin_code) AS cabin_code,
       g.seat_number, coalesce(g.seat_rank, t.seat_rank) AS seat_rank, t.ticket_id,
       CASE WHEN g.seat_rank IS NULL THEN 'UNSEATED' WHEN t.ticket_id IS NULL THEN 'FREE' ELSE 'TAKEN' END AS status
FROM seat_grid g FULL OUTER JOIN sold_seats t
  ON t.flight_instance_id = g.flight_instance_id AND t.cabin_code = g.cabin_code AND t.seat_rank = g.seat_rank""", ("seat_grid", "sold_seats"))

cte("inventory_curve", """
SELECT flight_instance_id, cabin_code, occurred_at, seats_held, seats_sold, lowest_held, lowest_sold, lowest_held < 0 OR lowest_sold < 0 AS dipped
FROM (SELECT *, min(seats_held) OVER w AS lowest_held, min(seats_sold) OVER w AS lowest_sold
      FROM (SELECT flight_instance_id, cabin_code, occurred_at, sum(h) OVER w AS seats_held, sum(s) OVER w AS seats_sold
            FROM (SELECT g.flight_instance_id, g.cabin_code, e.occurred_at, sum(e.h * g.seats) AS h, sum(e.s * g.seats) AS s
                  FROM itinerary_segment g JOIN itinerary i ON i.itinerary_id = g.itinerary_id
                  JOIN (SELECT reservation_id, occurred_at,
                               CASE WHEN (prior IS NULL OR prior IN ('EXPIRED', 'CANCELLED')) AND to_status = 'HELD' THEN 1
                                    WHEN prior = 'HELD' AND to_status IN ('CONFIRMED', 'CANCELLED', 'EXPIRED') THEN -1 ELSE 0 END AS h,
                               CASE WHEN prior = 'HELD' AND to_status = 'CONFIRMED' THEN 1
                                    WHEN prior = 'CONFIRMED' AND to_status = 'CANCELLED' THEN -1 ELSE 0 END AS s
                        FROM (SELECT reservation_id, occurred_at, to_status,
                                     lag(to_status) OVER (PARTITION BY reservation_id ORDER BY occurred_at, event_id) AS prior
                              FROM reservation_event WHERE to_status IS NOT NULL) p) e ON e.reservation_id = i.reservation_id
                  WHERE e.h <> 0 OR e.s <> 0
                  GROUP BY ALL) a
            WINDOW w AS (PARTITION BY flight_instance_id, cabin_code ORDER BY occurred_at)) b
      WINDOW w AS (PARTITION BY flight_instance_id, cabin_code ORDER BY occurred_at)) c""", ("itinerary_segment", "itinerary", "reservation_event"))
