"""Data-quality jobs in DuckDB SQL, generated from the declared rule lists."""

from __future__ import annotations

from oracle.model import cte
from skyfold.operators.quality import FOREIGN_KEYS, RANGE_RULES, UNIQUE_KEYS, enum_predicates


def _rules_sql(rules) -> tuple[str, tuple[str, ...]]:
    parts = [f"SELECT '{t}' AS table_name, '{n}' AS rule, count(*) AS rows_checked, "
             f"count(*) FILTER (WHERE NOT coalesce(({p}), TRUE)) AS violations FROM {t}" for t, n, p in rules]
    return "\nUNION ALL\n".join(parts), tuple(sorted({t for t, _, _ in rules}))


cte("dq_range_checks", *_rules_sql(RANGE_RULES))
cte("dq_enum_checks", *_rules_sql(enum_predicates()))

_u = []
for _t, _n, _cols in UNIQUE_KEYS:
    _c = ", ".join(_cols)
    _nn = " AND ".join(f"{c} IS NOT NULL" for c in _cols)
    _u.append(f"SELECT '{_t}' AS table_name, '{_n}' AS key_name, count(*) FILTER (WHERE n > 1) AS duplicate_keys, "
              f"coalesce(sum(n) FILTER (WHERE n > 1), 0) AS duplicate_rows "
              f"FROM (SELECT {_c}, count(*) AS n FROM {_t} WHERE {_nn} GROUP BY {_c}) g")
cte("dq_unique_checks", "\nUNION ALL\n".join(_u), tuple(sorted({t for t, _, _ in UNIQUE_KEYS})))

_f = []
for _name, _child, _cc, _parent, _pc in FOREIGN_KEYS:
    _nn = " AND ".join(f"c.{a} IS NOT NULL" for a in _cc)
    _eq = " AND ".join(f"p.{b} = c.{a}" for a, b in zip(_cc, _pc))
    _f.append(f"SELECT '{_name}' AS fk_name, '{_child}' AS child_table, '{_parent}' AS parent_table, count(*) AS orphans "
              f"FROM {_child} c WHERE {_nn} AND NOT EXISTS (SELECT 1 FROM {_parent} p WHERE {_eq})")
cte("dq_foreign_keys", "\nUNION ALL\n".join(_f),
    tuple(sorted({x for _, c, _, p, _ in FOREIGN_KEYS for x in (c, p)})))

cte("star_vs_source", """
SELECT coalesce(s.flight_key, t.flight_key) AS flight_key, s.source_tickets, s.source_total, s.source_seats,
       t.star_tickets, t.star_total, t.star_seats,
       coalesce(s.source_tickets, 0) = coalesce(t.star_tickets, 0)
       AND coalesce(s.source_total, 0) = coalesce(t.star_total, 0)
       AND coalesce(s.source_seats, 0) = coalesce(t.star_seats, 0) AS is_match
FROM (SELECT sg.flight_instance_id AS flight_key, count(*) AS source_tickets,
             sum(tk.fare_amount + tk.tax_amount + coalesce(a.total, 0)) AS source_total, sum(tk.seats) AS source_seats
      FROM ticket tk JOIN itinerary_segment sg ON sg.segment_id = tk.segment_id
      LEFT JOIN (SELECT ticket_id, sum(amount) AS total FROM ancillary WHERE status = 'ACTIVE' GROUP BY 1) a
             ON a.ticket_id = tk.ticket_id
      GROUP BY 1) s
FULL OUTER JOIN (SELECT flight_key, count(*) AS star_tickets, sum(total_amount) AS star_total, sum(seats) AS star_seats
                 FROM fact_ticket_sale GROUP BY 1) t ON t.flight_key = s.flight_key""",
    ("ticket", "itinerary_segment", "ancillary", "fact_ticket_sale"))
