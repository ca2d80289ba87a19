"""The flight model of FIXTURES.md §C written as DuckDB SQL (CTEs).

Used only by ``oracle_sql()``: an independent statement of the same
definitions the Spark adapter implements, over the pre-registered views
region nation customer supplier part orders lineitem events.
"""

from __future__ import annotations

ALPHABET = "ABCDEFGHJKLMNPQRSTUVWXYZ23456789"


def money(x: str, ty: str = "DECIMAL(12,2)") -> str:
    return f"CAST(CAST(CAST(round(({x})*100) AS BIGINT) AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS {ty})"


def pnr(k: str) -> str:
    parts = [f"substr('{ALPHABET}', CAST((({k}) // {32 ** p}) % 32 AS INTEGER) + 1, 1)" for p in range(5, -1, -1)]
    return " || ".join(parts)


def hu(num: str, den: str) -> str:
    """Half-up (away from zero) integer division of exact integers, den > 0."""
    return f"(sign({num}) * ((2 * abs({num}) + ({den})) // (2 * ({den}))))"


def rdiv(num: str, den: str, scale: int) -> str:
    """round(num / den, scale) half-up as DOUBLE, num and den exact integers."""
    return f"(CAST({hu(f'({num}) * {10 ** scale}', den)} AS DOUBLE) / {10 ** scale})"


def date_key(x: str) -> str:
    return f"CAST(strftime({x}, '%Y%m%d') AS INTEGER)"


def code(no: str) -> str:
    return f"('N' || lpad(CAST({no} AS VARCHAR), 2, '0'))"


CTES: dict[str, str] = {}
DEPS: dict[str, tuple[str, ...]] = {}


def cte(name: str, sql: str, deps: tuple[str, ...] = ()) -> None:
    CTES[name] = sql
    DEPS[name] = deps


cte("airport", f"""
SELECT {code('n_nationkey')} AS iata_code, n_nationkey AS airport_no, n_name AS city,
       r_name AS country_code, 'UTC' AS timezone, 35 + 5 * (n_nationkey % 6) AS min_connection_min
FROM nation JOIN region ON r_regionkey = n_regionkey""")

cte("fbase", """
SELECT suppkey, m, origin_no, dest_no, dist AS distance_km, dep AS departure_utc,
       dep + to_minutes(CAST(45 + dist // 10 AS BIGINT)) AS arrival_utc,
       origin_no * 25 + dest_no AS route_id,
       suppkey * 1000 + m AS flight_instance_id,
       suppkey * 1000 + origin_no * 25 + dest_no AS scheduled_flight_id
FROM (
  SELECT *, abs(origin_no - dest_no) * 37 + 190 AS dist,
         CAST(make_date(CAST(1995 + m // 12 AS BIGINT), CAST(m % 12 + 1 AS BIGINT), 1) AS TIMESTAMP)
           + to_days(CAST((suppkey * 37 + m) % 7 AS INTEGER))
           + to_minutes(CAST((suppkey * 53 + m * 17) % 1440 AS BIGINT)) AS dep
  FROM (
    SELECT suppkey, m, s_nationkey AS origin_no,
           CASE WHEN (suppkey * 7 + m) % 25 = s_nationkey THEN ((suppkey * 7 + m) % 25 + 1) % 25
                ELSE (suppkey * 7 + m) % 25 END AS dest_no
    FROM (SELECT DISTINCT l_suppkey AS suppkey,
                 CAST((year(l_shipdate) - 1995) * 12 + month(l_shipdate) - 1 AS INTEGER) AS m
          FROM lineitem) fb
    JOIN supplier ON s_suppkey = fb.suppkey) g) h""")

cte("route", f"""
SELECT DISTINCT route_id, {code('origin_no')} AS origin_iata, {code('dest_no')} AS destination_iata,
       distance_km FROM fbase""", ("fbase",))

cte("flight_instance", """
SELECT flight_instance_id, scheduled_flight_id, CAST(departure_utc AS DATE) AS flight_date,
       departure_utc, arrival_utc,
       CASE WHEN (suppkey + m) % 10 = 0 THEN NULL ELSE suppkey END AS aircraft_id,
       CASE WHEN flight_instance_id % 50 = 0 THEN 'CANCELLED' ELSE 'SCHEDULED' END AS status
FROM fbase""", ("fbase",))

cte("scheduled_flight", """
SELECT scheduled_flight_id, 'F' || suppkey AS flight_number, route_id, suppkey % 3 + 1 AS seat_map_id,
       0 AS arrival_day_offset, DATE '1995-01-01' AS valid_from, DATE '2001-12-31' AS valid_to,
       min(strftime(departure_utc, '%H:%M')) AS departure_time_local,
       min(strftime(arrival_utc, '%H:%M')) AS arrival_time_local
FROM fbase GROUP BY scheduled_flight_id, suppkey, route_id""", ("fbase",))

cte("aircraft", """
SELECT s_suppkey AS aircraft_id, 'HK-' || s_suppkey AS registration,
       CASE s_suppkey % 3 WHEN 0 THEN 'AT72' WHEN 1 THEN 'A320' ELSE 'A20N' END AS model_code,
       s_suppkey % 3 + 1 AS seat_map_id,
       CASE WHEN s_suppkey % 10 = 9 THEN 'MAINTENANCE' ELSE 'ACTIVE' END AS status
FROM supplier""")

cte("aircraft_model", "SELECT * FROM (VALUES ('AT72'), ('A320'), ('A20N')) t(model_code)")
cte("cabin", "SELECT * FROM (VALUES ('BUS', 'Ejecutiva'), ('ECO', 'Económica')) t(cabin_code, name)")

CABIN_OF = "CASE WHEN p_type IN ('PROMO', 'LARGE') THEN 'BUS' ELSE 'ECO' END"

cte("fare_rule", """
SELECT DISTINCT p_size AS fare_rule_id, 'ADV' || p_size || 'd' AS name, p_size AS min_advance_days,
       p_size % 2 = 0 AS is_refundable, p_size % 3 <> 0 AS is_changeable,
       CAST(p_size * 1000 AS DECIMAL(12,2)) AS refund_penalty
FROM part""")

cte("fare_class", f"""
SELECT DISTINCT p_brand || ':' || {CABIN_OF} AS fare_class_code, {CABIN_OF} AS cabin_code, p_brand AS name
FROM part""")

cte("fare", f"""
SELECT p_partkey AS fare_id, p_partkey % 625 AS route_id, p_brand || ':' || {CABIN_OF} AS fare_class_code,
       p_size AS fare_rule_id, 'COP' AS currency, {money('p_retailprice')} AS base_amount,
       CAST(19.00 AS DECIMAL(5,2)) AS tax_pct, DATE '1995-01-01' AS valid_from, DATE '2001-12-31' AS valid_to
FROM part""")

cte("agency", """
SELECT CAST(row_number() OVER (ORDER BY c_mktsegment) AS INTEGER) AS agency_id, c_mktsegment AS legal_name,
       CAST(8.00 AS DECIMAL(5,2)) AS net_fare_discount_pct, CAST(5.00 AS DECIMAL(5,2)) AS commission_pct,
       CAST(50000000 AS DECIMAL(14,2)) AS credit_limit, CAST(0 AS DECIMAL(14,2)) AS credit_used
FROM (SELECT DISTINCT c_mktsegment FROM customer) s""")

cte("orders_x", """
SELECT o_orderkey, o_custkey, c_name, c_mktsegment, CAST(o_orderdate AS TIMESTAMP) AS created_at, o_totalprice,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'COUNTER'
            WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM') THEN 'B2B' ELSE 'WEB' END AS channel,
       CASE WHEN o_orderstatus = 'F' THEN 'CONFIRMED' WHEN o_orderstatus = 'O' THEN 'HELD'
            WHEN o_orderkey % 2 = 0 THEN 'CANCELLED' ELSE 'EXPIRED' END AS status
FROM orders JOIN customer ON c_custkey = o_custkey""")

cte("reservation", f"""
SELECT o_orderkey AS reservation_id, {pnr('o_orderkey')} AS pnr, channel, a.agency_id, status,
       'COP' AS currency, {money('o_totalprice', 'DECIMAL(14,2)')} AS total_amount,
       CASE WHEN status = 'HELD' THEN created_at + INTERVAL 20 MINUTE END AS hold_expires_at,
       created_at, o_custkey, c_name
FROM orders_x LEFT JOIN agency a ON a.legal_name = orders_x.c_mktsegment AND orders_x.channel = 'B2B'""",
    ("orders_x", "agency"))

cte("reservation_passenger", """
SELECT o_orderkey AS reservation_id, ref AS passenger_ref, o_orderkey * 10 + ref AS passenger_id,
       CASE ref WHEN 1 THEN 'ADT' WHEN 2 THEN 'CHD' ELSE 'INF' END AS passenger_type
FROM (SELECT o_orderkey, unnest(range(1, CAST(o_orderkey % 3 + 2 AS BIGINT))) AS ref FROM orders) x""")

cte("lines", f"""
SELECT (l_orderkey * 1000000 + line_seq) AS ticket_id, l_orderkey AS reservation_id, line_seq, l_linenumber,
       l_suppkey * 1000 + CAST((year(l_shipdate) - 1995) * 12 + month(l_shipdate) - 1 AS INTEGER) AS flight_instance_id,
       {CABIN_OF} AS cabin_code, p_brand || ':' || {CABIN_OF} AS fare_class_code, l_partkey AS fare_id,
       {money('l_extendedprice')} AS fare_amount,
       {money('l_extendedprice * l_tax')} AS tax_amount,
       {money('l_extendedprice * l_discount')} AS discount_amount,
       CASE WHEN o.channel = 'B2B' THEN {money('l_extendedprice * CAST(0.05 AS DOUBLE)')}
            ELSE CAST(0 AS DECIMAL(12,2)) END AS commission_amount,
       CAST(l_quantity AS INTEGER) AS seats,
       CASE l_returnflag WHEN 'R' THEN 'CANCELLED' WHEN 'A' THEN 'USED' ELSE 'ISSUED' END AS ticket_status,
       l_linestatus, o.created_at, o.status AS reservation_status, o.channel
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_orderkey, l_partkey, l_suppkey,
             l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
             l_shipdate) AS line_seq FROM lineitem) l
JOIN orders_x o ON o.o_orderkey = l.l_orderkey
JOIN part p ON p.p_partkey = l.l_partkey""", ("orders_x",))

cte("ticket", f"""
SELECT ticket_id, {pnr('reservation_id')} || '-' || line_seq || '-1' AS ticket_number, reservation_id, 1 AS passenger_ref,
       ticket_id AS segment_id, fare_id, fare_amount, tax_amount, discount_amount, commission_amount,
       'COP' AS currency, ticket_status AS status, created_at AS issued_at,
       CASE WHEN ticket_status = 'CANCELLED' THEN created_at + to_days(CAST(l_linenumber AS INTEGER)) END AS cancelled_at,
       seats
FROM lines""", ("lines",))

cte("itinerary_segment", """
SELECT ticket_id AS segment_id, reservation_id AS itinerary_id, line_seq AS sequence_no, flight_instance_id,
       cabin_code, fare_class_code, fare_id AS quoted_fare_id, fare_amount AS quoted_fare_amount,
       tax_amount AS quoted_tax_amount,
       CASE WHEN ticket_status = 'CANCELLED' THEN 'CANCELLED' ELSE 'ACTIVE' END AS status, seats
FROM lines""", ("lines",))

cte("itinerary", """
SELECT itinerary_id, itinerary_id AS reservation_id,
       CASE WHEN bool_or(status = 'ACTIVE') THEN 'ACTIVE' ELSE 'CANCELLED' END AS status
FROM itinerary_segment GROUP BY itinerary_id""", ("itinerary_segment",))

cte("ancillary", """
SELECT ticket_id AS ancillary_id, ticket_id, CAST(seats * 10 AS DECIMAL(12,2)) AS amount,
       CASE WHEN l_linestatus = 'O' THEN 'ACTIVE' ELSE 'CANCELLED' END AS status
FROM lines WHERE l_linenumber <= 2""", ("lines",))

cte("flight_inventory", """
SELECT flight_instance_id, cabin_code,
       CASE WHEN cabin_code = 'BUS' THEN 90 WHEN (flight_instance_id // 1000) % 3 = 0 THEN 68
            WHEN (flight_instance_id // 1000) % 3 = 1 THEN 150 ELSE 162 END AS capacity,
       CAST(coalesce(sum(CASE WHEN reservation_status = 'CONFIRMED' THEN seats ELSE 0 END), 0) AS INTEGER) AS seats_sold,
       CAST(coalesce(sum(CASE WHEN reservation_status = 'HELD' THEN seats ELSE 0 END), 0) AS INTEGER) AS seats_held,
       CAST(1.00 AS DECIMAL(4,2)) AS oversell_factor
FROM lines GROUP BY flight_instance_id, cabin_code""", ("lines",))

cte("reservation_event", """
SELECT event_id, user_id AS reservation_id, ts AS occurred_at, event_type,
       CASE WHEN event_type IN ('purchase', 'error') THEN 'HELD' WHEN event_type = 'click' THEN 'CONFIRMED' END AS from_status,
       CASE event_type WHEN 'signup' THEN 'HELD' WHEN 'purchase' THEN 'CONFIRMED'
                       WHEN 'click' THEN 'CANCELLED' WHEN 'error' THEN 'EXPIRED' END AS to_status,
       props AS payload, value AS amount
FROM events""")

cte("payment_event", """
SELECT event_id AS payment_event_id, user_id AS payment_id,
       CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS psp_event_id,
       props AS payload, ts AS received_at
FROM events WHERE event_type = 'purchase'""")

cte("admission_requests", """
SELECT reservation_id AS request_id, created_at AS requested_at, flight_instance_id, cabin_code,
       CAST(sum(seats) AS INTEGER) AS demand
FROM lines WHERE reservation_status = 'HELD'
GROUP BY reservation_id, created_at, flight_instance_id, cabin_code""", ("lines",))


def _closure(names: list[str], extra: dict[str, tuple[str, tuple[str, ...]]]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        deps = extra[n][1] if n in extra else DEPS[n]
        for d in deps:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_model(body: str, uses: list[str], extra: list[tuple[str, str, tuple[str, ...]]] = ()) -> str:
    """``WITH <model ctes...>, <extra ctes...> <body>`` with dependencies resolved."""
    ex = {n: (sql, deps) for n, sql, deps in extra}
    order = _closure(list(uses) + [n for n, _, _ in extra], ex)
    parts = [f"{n} AS ({ex[n][0] if n in ex else CTES[n]})" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + body
