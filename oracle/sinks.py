"""Loading logic in DuckDB SQL."""

from __future__ import annotations

from oracle import star  # noqa: F401  (the star CTEs must exist first)
from oracle.model import CTES, DEPS, cte

BOUND = "TIMESTAMP '1997-12-31 23:00:00'"
STAR = ("dim_date", "dim_route", "dim_fare", "dim_flight", "dim_channel", "fact_ticket_sale",
        "fact_flight_occupancy", "fact_reservation_lifecycle")

cte("incremental_tickets", f"SELECT * FROM fact_ticket_sale WHERE issued_at > {BOUND}", ("fact_ticket_sale",))
cte("watermark_advance", f"""
SELECT 'fact_ticket_sale' AS table_name,
       coalesce(greatest(TIMESTAMP '1998-01-01 00:00:00', max(issued_at)), TIMESTAMP '1998-01-01 00:00:00') AS last_loaded_at
FROM fact_ticket_sale WHERE issued_at > {BOUND}""", ("fact_ticket_sale",))

cte("occ_old", CTES["fact_flight_occupancy"].replace("DATE '1998-01-01'", "DATE '1997-01-01'"),
    DEPS["fact_flight_occupancy"])
cte("upsert_occupancy", """
SELECT coalesce(o.flight_key, n.flight_key) AS flight_key, coalesce(o.cabin_code, n.cabin_code) AS cabin_code,
       CASE WHEN o.flight_key IS NOT NULL THEN o.route_key ELSE n.route_key END AS route_key,
       CASE WHEN o.flight_key IS NOT NULL THEN o.departure_date_key ELSE n.departure_date_key END AS departure_date_key,
       CASE WHEN n.flight_key IS NOT NULL THEN n.capacity ELSE o.capacity END AS capacity,
       CASE WHEN n.flight_key IS NOT NULL THEN n.seats_sold ELSE o.seats_sold END AS seats_sold,
       CASE WHEN n.flight_key IS NOT NULL THEN n.seats_held ELSE o.seats_held END AS seats_held,
       CASE WHEN n.flight_key IS NOT NULL THEN n.load_factor ELSE o.load_factor END AS load_factor,
       CASE WHEN n.flight_key IS NOT NULL THEN n.revenue_amount ELSE o.revenue_amount END AS revenue_amount,
       CASE WHEN n.flight_key IS NOT NULL THEN n.revenue_per_seat ELSE o.revenue_per_seat END AS revenue_per_seat
FROM occ_old o FULL OUTER JOIN fact_flight_occupancy n ON n.flight_key = o.flight_key AND n.cabin_code = o.cabin_code""",
    ("occ_old", "fact_flight_occupancy"))

cte("insert_if_absent_channel", "SELECT channel, agency_name, is_indirect FROM dim_channel", ("dim_channel",))

cte("star_row_counts", "\nUNION ALL\n".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in STAR),
    STAR)
cte("catalog_report", "SELECT table_name, row_count, row_count > 0 AS is_loaded FROM star_row_counts",
    ("star_row_counts",))
cte("etl_run_log", """
SELECT 1 AS run_id, 'SUCCESS' AS status, sum(row_count) AS rows_written,
       '{' || string_agg('"' || table_name || '":' || row_count, ',' ORDER BY table_name) || '}' AS detail
FROM star_row_counts""", ("star_row_counts",))
