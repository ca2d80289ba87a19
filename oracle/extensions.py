"""Second-wave jobs in DuckDB SQL."""

from __future__ import annotations

from oracle import reservations, star  # noqa: F401
from oracle.model import cte

cte("agency_settlement", """
SELECT c.agency_name, d.year, d.month,
       count(*) FILTER (WHERE NOT t.is_cancelled) AS tickets,
       coalesce(sum(t.total_amount) FILTER (WHERE NOT t.is_cancelled), 0) AS sales,
       coalesce(sum(t.commission_amount) FILTER (WHERE NOT t.is_cancelled), 0) AS commission,
       count(*) FILTER (WHERE t.is_cancelled) AS cancelled_tickets,
       coalesce(sum(t.total_amount) FILTER (WHERE t.is_cancelled), 0) AS cancelled_value,
       coalesce(sum(t.total_amount) FILTER (WHERE NOT t.is_cancelled), 0)
         - coalesce(sum(t.commission_amount) FILTER (WHERE NOT t.is_cancelled), 0) AS balance_due
FROM fact_ticket_sale t JOIN dim_channel c ON c.channel_key = t.channel_key AND c.is_indirect
JOIN dim_date d ON d.date_key = t.issue_date_key
GROUP BY c.agency_name, d.year, d.month""", ("fact_ticket_sale", "dim_channel", "dim_date"))

cte("refund_due", """
SELECT t.ticket_id, t.fare_id, fr.is_refundable, t.fare_amount + t.tax_amount AS paid_amount,
       fr.refund_penalty AS penalty,
       CASE WHEN fr.is_refundable THEN greatest(t.fare_amount + t.tax_amount - fr.refund_penalty, 0) ELSE 0 END AS refund_amount
FROM ticket t JOIN fare f ON f.fare_id = t.fare_id JOIN fare_rule fr ON fr.fare_rule_id = f.fare_rule_id
WHERE t.status = 'CANCELLED'""", ("ticket", "fare", "fare_rule"))

cte("anonymise_passengers", """
SELECT CASE WHEN old THEN NULL ELSE p.passenger_id END AS passenger_id,
       CASE WHEN old THEN NULL ELSE p.birth_date END AS birth_date, CASE WHEN old THEN NULL ELSE p.phone END AS phone,
       CASE WHEN old THEN NULL ELSE p.document_type END AS document_type,
       CASE WHEN old THEN NULL ELSE p.first_name END AS first_name,
       CASE WHEN old THEN NULL ELSE p.last_name END AS last_name,
       CASE WHEN old THEN NULL ELSE p.document_number END AS document_number,
       CASE WHEN old THEN NULL ELSE p.email END AS email,
       l.last_travel, old AS is_anonymised
FROM passenger_x p
LEFT JOIN (SELECT rp.passenger_id, max(fi.flight_date) AS last_travel
           FROM reservation_passenger rp JOIN itinerary i ON i.reservation_id = rp.reservation_id
           JOIN itinerary_segment s ON s.itinerary_id = i.itinerary_id
           JOIN flight_instance fi ON fi.flight_instance_id = s.flight_instance_id
           GROUP BY rp.passenger_id) l ON l.passenger_id = p.passenger_id,
LATERAL (SELECT coalesce(l.last_travel < DATE '1998-01-01', FALSE) AS old) o""",
    ("passenger_x", "reservation_passenger", "itinerary", "itinerary_segment", "flight_instance"))

cte("payment_reconciliation", """
SELECT r.reservation_id, r.pnr, r.hold_expires_at, r.total_amount, p.payment_events, p.first_payment_at
FROM reservation r JOIN (SELECT payment_id AS reservation_id, count(*) AS payment_events,
                                min(received_at) AS first_payment_at
                         FROM payment_event GROUP BY 1) p ON p.reservation_id = r.reservation_id
WHERE r.status = 'HELD' AND r.hold_expires_at < TIMESTAMP '1998-01-01 00:00:00'""", ("reservation", "payment_event"))

_CARD_CELLS = [("reservation_event", "payload", "event_id", "payload"), ("reservation", "contact_email", "reservation_id", "'c' || o_custkey || '@mail.test'"),
               ("reservation", "pnr", "reservation_id", "pnr")] + [("passenger", c, "passenger_id", c) for c in ("first_name", "last_name", "email", "phone")]
_CARD_TABLES = {"passenger": "passenger_x"}
cte("card_cells", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST({k} AS VARCHAR) AS row_key, CAST({v} AS VARCHAR) AS value FROM {_CARD_TABLES.get(t, t)}"
    for t, c, k, v in _CARD_CELLS), ("reservation_event", "reservation", "passenger_x"))
cte("card_number_scan", r"""
SELECT table_name, column_name, row_key, '****' || right(d, 4) AS masked FROM (
  SELECT DISTINCT table_name, column_name, row_key, array_to_string(g[i:i + k - 1], '') AS d FROM (
    SELECT *, unnest(range(1, len(g) - i + 2)) AS k FROM (
      SELECT *, unnest(range(1, len(g) + 1)) AS i FROM (
        SELECT table_name, column_name, row_key, string_split_regex(r, '[ -]') AS g FROM (
          SELECT table_name, column_name, row_key, unnest(regexp_extract_all(value, '[0-9]+(?:[ -][0-9]+)*')) AS r FROM card_cells) a
        WHERE length(regexp_replace(r, '[ -]', '', 'g')) >= 13) b) c) e) f
WHERE length(d) BETWEEN 13 AND 19
  AND list_sum([CASE WHEN (length(d) - p) % 2 = 1 THEN (2 * CAST(d[p] AS INTEGER)) // 10 + (2 * CAST(d[p] AS INTEGER)) % 10
                     ELSE CAST(d[p] AS INTEGER) END for p in range(1, length(d) + 1)]) % 10 = 0""", ("card_cells",))
