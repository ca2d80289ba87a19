"""Star schema and marts in DuckDB SQL, for ``oracle_sql()``.


* ``leg_of``     a flight with its number, route and day
* ``sold_leg``   a ticket with the flight it is for
* ``seller``     a reservation with the rank of its (channel, agency) pair
* ``event_times`` the first time of each status of a reservation

Averages that are rounded half up are computed on integers (cents, or units
of 1e-4), which facts carry as extra columns.
"""

from __future__ import annotations

from oracle.model import cte, date_key, hu, rdiv

AS_OF = "DATE '1998-01-01'"

cte("leg_of", """
SELECT flight_instance_id, flight_date AS day_out, departure_utc, status, aircraft_id, flight_number, route_id
FROM (SELECT scheduled_flight_id, flight_number, route_id FROM scheduled_flight) plan
     INNER JOIN (SELECT scheduled_flight_id, flight_instance_id, flight_date, departure_utc, status, aircraft_id
                 FROM flight_instance) one USING (scheduled_flight_id)""", ("scheduled_flight", "flight_instance"))

cte("sold_leg", """
SELECT ticket.*, flight_instance_id, cabin_code FROM ticket
INNER JOIN (SELECT segment_id, flight_instance_id, cabin_code FROM itinerary_segment) leg USING (segment_id)""",
    ("ticket", "itinerary_segment"))

cte("seller", """
SELECT reservation_id, channel, legal_name AS agency_name,
       dense_rank() OVER (ORDER BY channel, legal_name NULLS FIRST) AS channel_key
FROM reservation LEFT JOIN agency USING (agency_id)""", ("reservation", "agency"))

cte("event_times", """
SELECT reservation_id, first_at['HELD'] AS held_at, first_at['CONFIRMED'] AS confirmed_at,
       first_at['CANCELLED'] AS cancelled_at, first_at['EXPIRED'] AS expired_at, event_count
FROM (SELECT reservation_id, CAST(sum(n) AS BIGINT) AS event_count,
             map_from_entries(list((to_status, since)) FILTER (WHERE to_status IS NOT NULL)) AS first_at
      FROM (SELECT reservation_id, to_status, min(occurred_at) AS since, count(*) AS n
            FROM reservation_event GROUP BY ALL) per_status
      GROUP BY reservation_id) m""", ("reservation_event",))

cte("first_status_times", "SELECT * FROM event_times", ("event_times",))

cte("trip_summary", """
WITH flown AS (
  SELECT itinerary_id, segment_id, route_id, day_out
  FROM itinerary_segment INNER JOIN leg_of USING (flight_instance_id))
SELECT reservation_id, min(route_id) AS route_id, min(day_out) AS first_departure, count(segment_id) AS segments
FROM flown INNER JOIN (SELECT itinerary_id, reservation_id FROM itinerary) trip USING (itinerary_id)
GROUP BY reservation_id""", ("itinerary_segment", "leg_of", "itinerary"))

# dimensions -------------------------------------------------------------------------
cte("dim_date", f"""
WITH span AS (
  SELECT least((SELECT min(o_orderdate) FROM orders), (SELECT min(l_shipdate) FROM lineitem)) AS a,
         greatest((SELECT max(o_orderdate) FROM orders), (SELECT max(l_shipdate) FROM lineitem)) AS b),
days AS (SELECT CAST(make_date(year(a), 1, 1) + to_days(CAST(i AS INTEGER)) AS DATE) AS x
         FROM span, range(0, 1 + date_diff('day', make_date(year(a), 1, 1), make_date(year(b), 12, 31))) g(i))
SELECT {date_key('x')} AS date_key, x AS full_date, year(x) AS year, quarter(x) AS quarter, month(x) AS month,
       strftime(x, '%B') AS month_name, day(x) AS day, isodow(x) AS day_of_week, strftime(x, '%A') AS day_name,
       isodow(x) > 5 AS is_weekend, list_contains([1, 6, 7, 12], month(x)) AS is_high_season
FROM days""")

cte("dim_route", """
WITH place AS (SELECT iata_code, city FROM airport)
SELECT route_id AS route_key, origin_iata, here.city AS origin_city, destination_iata, there.city AS destination_city,
       concat(origin_iata, '-', destination_iata) AS route_label, distance_km,
       ['corta', 'media', 'larga'][1 + CAST(distance_km >= 400 AS INTEGER) + CAST(distance_km >= 900 AS INTEGER)] AS distance_band
FROM route, place AS here, place AS there
WHERE origin_iata = here.iata_code AND destination_iata = there.iata_code""", ("route", "airport"))

cte("dim_fare", """
WITH classes AS (
  SELECT fare_class_code, fare_class.name AS fare_class_name, cabin_code, cabin.name AS cabin_name
  FROM cabin INNER JOIN fare_class USING (cabin_code)),
rules AS (SELECT fare_rule_id, name AS rule_name, min_advance_days, is_refundable, is_changeable FROM fare_rule)
SELECT fare_id AS fare_key, fare_class_code, fare_class_name, cabin_code, cabin_name, rule_name, min_advance_days,
       is_refundable, is_changeable
FROM classes INNER JOIN fare USING (fare_class_code) INNER JOIN rules USING (fare_rule_id)""",
    ("fare", "fare_class", "cabin", "fare_rule"))

cte("dim_flight", f"""
WITH plane AS (
  SELECT aircraft_id, registration, CASE WHEN model_code IN (SELECT model_code FROM aircraft_model) THEN model_code END AS model
  FROM aircraft)
SELECT flight_instance_id AS flight_key, flight_number, route_id AS route_key, {date_key('day_out')} AS departure_date_key,
       departure_utc, model AS aircraft_model, registration AS aircraft_registration, status AS flight_status
FROM leg_of LEFT JOIN plane USING (aircraft_id)
WHERE date_diff('day', {AS_OF}, day_out) >= -365""", ("leg_of", "aircraft", "aircraft_model"))

cte("dim_channel", """
SELECT CAST(channel_key AS INTEGER) AS channel_key, any_value(channel) AS channel, any_value(agency_name) AS agency_name,
       any_value(channel) = 'B2B' AS is_indirect
FROM seller GROUP BY channel_key""", ("seller",))

# facts ------------------------------------------------------------------------------
cte("fact_ticket_sale", f"""
WITH extra AS (SELECT ticket_id, CAST(sum(amount) AS DECIMAL(12,2)) AS bought
               FROM ancillary WHERE status = 'ACTIVE' GROUP BY ticket_id),
priced AS (SELECT sold_leg.*, coalesce(bought, 0) AS bought FROM sold_leg LEFT JOIN extra USING (ticket_id))
SELECT ticket_id AS ticket_key, ticket_number, flight_instance_id AS flight_key, route_id AS route_key, fare_id AS fare_key,
       channel_key, {date_key('issued_at')} AS issue_date_key, {date_key('day_out')} AS departure_date_key,
       fare_amount, tax_amount, discount_amount, commission_amount,
       CAST(bought AS DECIMAL(12,2)) AS ancillary_amount,
       CAST(bought + tax_amount + fare_amount AS DECIMAL(12,2)) AS total_amount, seats,
       date_diff('day', CAST(issued_at AS DATE), day_out) AS days_before_departure, priced.currency,
       priced.status AS ticket_status, priced.status = 'CANCELLED' AS is_cancelled, pnr AS reservation_pnr,
       CAST(fare_amount * 100 AS BIGINT) AS fare_cents, issued_at
FROM priced INNER JOIN leg_of USING (flight_instance_id) INNER JOIN seller USING (reservation_id)
     INNER JOIN (SELECT reservation_id, pnr FROM reservation) booking USING (reservation_id)""",
    ("ancillary", "sold_leg", "leg_of", "seller", "reservation"))

cte("fact_flight_occupancy", f"""
WITH income AS (SELECT flight_instance_id, cabin_code, sum(tax_amount + fare_amount) AS money
                FROM sold_leg WHERE status IS DISTINCT FROM 'CANCELLED' GROUP BY ALL),
cabin_of AS (
  SELECT flight_instance_id, cabin_code, capacity, seats_sold, seats_held, coalesce(money, 0) AS money
  FROM flight_inventory LEFT JOIN income USING (flight_instance_id, cabin_code)),
units AS (
  SELECT *, CASE capacity WHEN 0 THEN 0 ELSE {hu('CAST(seats_sold AS BIGINT) * 10000', 'capacity')} END AS lf_units,
         CAST(money * 100 AS BIGINT) AS rev_cents
  FROM cabin_of)
SELECT flight_instance_id AS flight_key, cabin_code, route_id AS route_key, {date_key('day_out')} AS departure_date_key,
       capacity, seats_sold, seats_held, lf_units, lf_units / 10000.0::DOUBLE AS load_factor,
       CAST(money AS DECIMAL(14,2)) AS revenue_amount, rev_cents,
       CASE capacity WHEN 0 THEN 0 ELSE {rdiv('rev_cents', 'capacity', 0)} / 100 END AS revenue_per_seat
FROM units INNER JOIN leg_of USING (flight_instance_id)
WHERE abs(date_diff('day', {AS_OF}, day_out)) <= 365""", ("sold_leg", "flight_inventory", "leg_of"))

cte("fact_reservation_lifecycle", f"""
WITH people AS (SELECT reservation_id, count(*) AS passengers FROM reservation_passenger GROUP BY ALL),
known AS (
  SELECT reservation_id, pnr, created_at, reservation.status, total_amount, currency, seller.channel_key,
         held_at, confirmed_at, cancelled_at, expired_at, event_count, route_id, first_departure, segments, passengers
  FROM reservation INNER JOIN seller USING (reservation_id) LEFT JOIN event_times USING (reservation_id)
       LEFT JOIN trip_summary USING (reservation_id) LEFT JOIN people USING (reservation_id))
SELECT reservation_id AS reservation_key, pnr, channel_key, route_id AS route_key,
       {date_key('created_at')} AS created_date_key, {date_key('first_departure')} AS departure_date_key,
       status AS final_status, ifnull(passengers, 0) AS passengers, ifnull(segments, 0) AS segments, total_amount, currency,
       (epoch_us(confirmed_at) - epoch_us(held_at)) // 60000000 AS minutes_to_confirm,
       (epoch_us(cancelled_at) - epoch_us(created_at)) // 60000000 AS minutes_to_cancel,
       date_diff('day', CAST(cancelled_at AS DATE), first_departure) AS days_before_departure_at_cancel,
       held_at IS NOT NULL AS was_held, confirmed_at IS NOT NULL AS was_confirmed,
       cancelled_at IS NOT NULL AS was_cancelled, expired_at IS NOT NULL AS expired_without_payment,
       ifnull(event_count, 0) AS event_count, CAST(total_amount * 100 AS BIGINT) AS total_cents
FROM known""", ("reservation", "seller", "event_times", "trip_summary", "reservation_passenger"))

# marts ------------------------------------------------------------------------------
cte("occupancy_by_route", f"""
WITH monthly AS (
  SELECT route_key, cabin_code, year, month, is_high_season, count(*) AS flights, sum(capacity) AS seats_offered,
         sum(fact_flight_occupancy.seats_sold) AS seats_sold, sum(lf_units) AS load, sum(revenue_amount) AS revenue
  FROM fact_flight_occupancy INNER JOIN dim_date ON date_key = departure_date_key GROUP BY ALL)
SELECT route_label, origin_city, destination_city, year, month, is_high_season, cabin_code, flights, seats_offered,
       seats_sold, {rdiv('load', 'flights', 0)} / 100 AS avg_load_factor_pct, revenue
FROM monthly INNER JOIN dim_route USING (route_key)""", ("fact_flight_occupancy", "dim_route", "dim_date"))

cte("kept_ticket", """
SELECT fact_ticket_sale.*, cabin_name, fare_class_code, fare_class_name, rule_name, min_advance_days
FROM fact_ticket_sale INNER JOIN dim_fare USING (fare_key) WHERE is_cancelled IS FALSE""", ("fact_ticket_sale", "dim_fare"))

cte("revenue_by_fare", f"""
WITH sums AS (
  SELECT cabin_name, fare_class_code, fare_class_name, rule_name, min_advance_days, year, month, count(*) AS tickets,
         sum(seats) AS seats, sum(fare_amount) AS fare_revenue, sum(tax_amount) AS tax_collected,
         sum(ancillary_amount) AS ancillary_revenue, sum(commission_amount) AS commissions_paid,
         sum(total_amount) AS total_revenue, sum(fare_cents) AS cents, sum(days_before_departure) AS days
  FROM kept_ticket INNER JOIN dim_date ON date_key = issue_date_key GROUP BY ALL)
SELECT * EXCLUDE (cents, days), {rdiv('cents', 'tickets', 0)} / 100 AS avg_fare,
       {rdiv('days', 'tickets', 1)} AS avg_days_before_departure
FROM sums""", ("kept_ticket", "dim_date"))

cte("lead_time_by_class", f"""
WITH lead AS (
  SELECT fare_class_code, rule_name, min_advance_days, list(days_before_departure) AS days FROM kept_ticket GROUP BY ALL)
SELECT fare_class_code, rule_name, min_advance_days, len(days) AS tickets,
       {rdiv('list_sum(days)', 'len(days)', 1)} AS avg_days_before_departure,
       list_min(days) AS min_days_before_departure, list_max(days) AS max_days_before_departure
FROM lead""", ("kept_ticket",))

cte("cancellation_patterns", f"""
WITH life AS (
  SELECT channel_key, route_key, year, month, was_cancelled, expired_without_payment, total_amount,
         CASE WHEN was_confirmed THEN minutes_to_confirm END AS wait,
         CASE WHEN was_cancelled THEN days_before_departure_at_cancel END AS ahead
  FROM fact_reservation_lifecycle INNER JOIN dim_date ON date_key = created_date_key),
sums AS (
  SELECT channel_key, route_key, year, month, count(*) AS reservations, count_if(was_cancelled) AS cancelled,
         count_if(expired_without_payment) AS expired_unpaid, sum(wait) AS waits, count(wait) AS n_wait,
         sum(ahead) AS aheads, count(ahead) AS n_ahead, sum(CASE WHEN was_cancelled THEN total_amount END) AS cancelled_value
  FROM life GROUP BY ALL)
SELECT channel, agency_name, route_label, year, month, reservations, cancelled, expired_unpaid,
       {rdiv('cancelled * 100', 'reservations', 2)} AS cancellation_rate_pct,
       CASE WHEN n_wait > 0 THEN {rdiv('waits', 'n_wait', 1)} END AS avg_minutes_to_confirm,
       CASE WHEN n_ahead > 0 THEN {rdiv('aheads', 'n_ahead', 1)} END AS avg_days_before_dep_at_cancel, cancelled_value
FROM sums INNER JOIN dim_channel USING (channel_key) LEFT JOIN dim_route USING (route_key)""",
    ("fact_reservation_lifecycle", "dim_channel", "dim_route", "dim_date"))
