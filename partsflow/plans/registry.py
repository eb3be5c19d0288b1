"""Registered queries: one per operator of the inventory.

``QUERIES[name](flow)`` returns the Spark DataFrame; ``ORACLES[name]`` the
equivalent DuckDB statement over the same tables (absent where a column is
not reproducible, i.e. the ingest timestamp of the bronze tables).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partsflow.oracle import compose
from partsflow.oracle import sql as S
from partsflow.operators import sampling as SM
from partsflow.plans import analytics as A, fractions
from partsflow.plans.batch import DIMENSIONS, PART_CDC, Flow
from partsflow.plans.silver import SILVER
from partsflow.schemas import FEEDS, SILVER_SOURCE

QUERIES: dict[str, Callable[[Flow], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _reg(name: str, fn: Callable[[Flow], DataFrame], oracle: str | None) -> None:
    QUERIES[name] = fn
    if oracle is not None:
        ORACLES[name] = oracle


# ---- feeds (G1-G11) ----------------------------------------------------------
_FEED_QUERIES = {
    "feed_demand": "demand_signals", "feed_po": "purchase_orders", "feed_receivers": "receivers",
    "feed_invoices": "invoices", "feed_work_orders": "work_orders", "feed_quotes": "customer_quotes",
    "feed_labor": "labor_schedules",
}
for _q, _folder in _FEED_QUERIES.items():
    _reg(_q, lambda f, folder=_folder: f.feed(folder), compose.stage(f"feed_{_folder}"))

for _q, _folder, _cond_sql in (
        ("feed_parts", "parts_cdc", "batch = 1"),
        ("feed_part_updates", "parts_cdc", "batch > 1"),
        ("feed_customers", "customers_cdc", "batch = 1"),
        ("feed_customer_updates", "customers_cdc", "batch > 1")):
    _reg(_q, lambda f, folder=_folder, cond=_cond_sql: f.feed(folder).where(F.expr(cond)),
         compose.statement(f"SELECT * FROM feed_{_folder} WHERE {_cond_sql}", [f"feed_{_folder}"]))

# ---- row-validity filters (P1-P9) -------------------------------------------
_FILTER_QUERIES = {
    "filter_parts": "silver_parts", "filter_customers": "silver_customers",
    "filter_demand": "silver_demand_signals", "filter_po": "silver_purchase_orders",
    "filter_receivers": "silver_receivers", "filter_invoices": "silver_invoices",
    "filter_wo": "silver_work_orders", "filter_quotes": "silver_customer_quotes",
    "filter_labor": "silver_labor_schedules",
}
for _q, _silver in _FILTER_QUERIES.items():
    _src = SILVER_SOURCE[_silver]
    _reg(_q, lambda f, s=_silver: f.valid(s),
         compose.statement(f"SELECT * FROM typed_{_src} WHERE {S.SILVER_PREDICATE[_silver]}", [f"typed_{_src}"]))

# ---- silver tables (filter + projection) ------------------------------------
for _silver in SILVER:
    _reg(_silver, lambda f, s=_silver: f.silver(s), compose.stage(_silver))

# ---- roundings on raw products and fractions (C5, C6, C9, C10) ---------------
_reg("silver_po_fractions", lambda f: fractions.purchase_orders(f.t.lineitem), fractions.PURCHASE_ORDERS_SQL)
_reg("silver_labor_fractions", lambda f: fractions.labor_schedules(f.t.lineitem), fractions.LABOR_SCHEDULES_SQL)

# ---- dimensions (D1-D4) ------------------------------------------------------
for _dim in DIMENSIONS:
    _reg(_dim, lambda f, d=_dim: f.dim(d), compose.stage(_dim))

# ---- facts (F1, F2 with joins L1-L8) ----------------------------------------
for _fact in ("fact_demand_fulfillment", "fact_work_order_completion"):
    _reg(_fact, lambda f, x=_fact: f.fact(x), compose.stage(_fact))

# ---- consumer queries (Q1-Q6) and CDC reports --------------------------------
_reg("q_part_current", lambda f: A.part_current(f.dim("dim_part_type1")),
     compose.statement(*S.ANALYTICS_SQL["q_part_current"][::-1]))
# Point look-ups: the filter reaches the scan of the stored dimension.
LOOKUP_PART = "PART-00007"
for _name, _dim, _look in (("q_part_current", "dim_part_type1", A.part_current), ("q_part_history", "dim_part_type2", A.part_history)):
    _reg(f"{_name}_by_key", lambda f, d=_dim, q=_look: q(f.dim(d), [LOOKUP_PART]),
         f"SELECT * FROM ({compose.statement(*S.ANALYTICS_SQL[_name][::-1])}) WHERE part_id = '{LOOKUP_PART}'")
_reg("q_part_history", lambda f: A.part_history(f.dim("dim_part_type2")),
     compose.statement(*S.ANALYTICS_SQL["q_part_history"][::-1]))
_reg("q_customer_current", lambda f: A.customer_current(f.dim("dim_customer_type2")),
     compose.statement(*S.ANALYTICS_SQL["q_customer_current"][::-1]))
_reg("q_customer_tier_journey", lambda f: A.customer_tier_journey(f.dim("dim_customer_type2")),
     compose.statement(*S.ANALYTICS_SQL["q_customer_tier_journey"][::-1]))
_reg("q_part_price_asof", lambda f: A.part_price_asof(f.dim("dim_part_type2")),
     compose.statement(*S.ANALYTICS_SQL["q_part_price_asof"][::-1]))
_reg("q_scd_compare", lambda f: A.scd_compare(f.dim("dim_part_type1"), f.dim("dim_part_type2")),
     compose.statement(*S.ANALYTICS_SQL["q_scd_compare"][::-1]))
_reg("scd_deletes", lambda f: A.scd_deletes(f.silver("silver_parts"), f.dim("dim_part_type2"), PART_CDC),
     compose.statement(*S.ANALYTICS_SQL["scd_deletes"][::-1]))

_LATE_SQL = f"""
, ev AS (SELECT part_id, _sequence, _op, batch FROM typed_parts_cdc
         WHERE {S.SILVER_PREDICATE['silver_parts']} AND _sequence IS NOT NULL),
pb AS (SELECT part_id, batch, max(_sequence) AS m FROM ev GROUP BY part_id, batch),
prior AS (SELECT a.part_id, a.batch, max(b.m) AS max_prior_sequence
          FROM pb a JOIN pb b ON a.part_id = b.part_id AND b.batch < a.batch GROUP BY a.part_id, a.batch)
SELECT ev.part_id, ev._sequence, ev._op, ev.batch, prior.max_prior_sequence
FROM ev JOIN prior ON ev.part_id = prior.part_id AND ev.batch = prior.batch
WHERE prior.max_prior_sequence > ev._sequence"""


def _late_oracle() -> str:
    # The report's helper CTEs follow the stage CTEs.
    base = compose.statement("SELECT 1", ["typed_parts_cdc"])
    head = base[: base.rfind("SELECT 1")].rstrip()
    return head + _LATE_SQL


_reg("scd_out_of_order", lambda f: A.late_events(f.valid("silver_parts"), ["part_id"]), _late_oracle())

_RULE_SQL = """
SELECT q.quote_id, q.wo_id, q.availability_constraint, q.labor_constraint,
       CASE WHEN pd >= greatest(pd, ld) THEN 'PARTS' ELSE 'LABOR' END AS binding_constraint,
       q.quote_date + CAST(greatest(pd, ld) + {lo} AS INTEGER) AS earliest_completion_date,
       q.quote_date + CAST(greatest(pd, ld) + {hi} AS INTEGER) AS latest_completion_date,
       q.expected_completion_date,
       q.expected_completion_date BETWEEN q.quote_date + CAST(greatest(pd, ld) + {lo} AS INTEGER)
                                      AND q.quote_date + CAST(greatest(pd, ld) + {hi} AS INTEGER) AS within_rule
FROM (SELECT q.*, {parts} AS pd, {labor} AS ld
      FROM silver_customer_quotes q LEFT JOIN dim_part_type1 dp ON dp.part_id = q.part_id) q"""


def _rule_oracle() -> str:
    from partsflow.plans import values as V
    parts = S._delay("q.availability_constraint", V.PARTS_DELAY,
                     f"coalesce(CAST(dp.lead_time_days AS BIGINT), {V.UNKNOWN_LEAD_DAYS})")
    labor = S._delay("q.labor_constraint", V.LABOR_DELAY, "NULL")
    body = _RULE_SQL.format(lo=V.SLACK_DAYS[0], hi=V.SLACK_DAYS[1], parts=parts, labor=labor)
    return compose.statement(body, ["silver_customer_quotes", "dim_part_type1"])


_reg("rule_completion_date",
     lambda f: A.completion_rule(f.silver("silver_customer_quotes"), f.dim("dim_part_type1")), _rule_oracle())

# ---- sampling (G15, G16) -----------------------------------------------------
N_PART_UPDATES = 80  # parts picked for a price revision
_KEY = "CAST(substr(part_id, 6) AS BIGINT)"


def _sample_parts(f: Flow) -> DataFrame:
    parts = f.dim("dim_part_type1").select("part_id", "part_name", "piece_part_price")
    return SM.sample_without_replacement(parts, N_PART_UPDATES, F.expr(_KEY), seed=99)


def _sample_pos(f: Flow) -> DataFrame:
    pos = f.silver("silver_purchase_orders").select("po_id", "part_id", "expected_receipt_date", "ordered_qty")
    n = f.silver("silver_receivers").count()  # one scalar: the size of the draw
    return SM.sample_with_replacement(pos, n, ["po_id"], seed=46)


_reg("sample_part_updates", _sample_parts, compose.statement(f"""
SELECT part_id, part_name, piece_part_price FROM dim_part_type1
ORDER BY {SM.seeded_number_sql(_KEY, 99)}, {_KEY} LIMIT {N_PART_UPDATES}""", ["dim_part_type1"]))
_reg("sample_po_with_replacement", _sample_pos, compose.statement(f"""
SELECT d.draw, p.po_id, p.part_id, p.expected_receipt_date, p.ordered_qty
FROM (SELECT unnest(range((SELECT count(*) FROM silver_receivers))) AS draw) d
JOIN (SELECT *, row_number() OVER (ORDER BY po_id) - 1 AS idx FROM silver_purchase_orders) p
  ON p.idx = {SM.seeded_number_sql('d.draw', 46)} % (SELECT count(*) FROM silver_purchase_orders)""",
    ["silver_receivers", "silver_purchase_orders"]))

BRONZE_QUERIES = {FEEDS[folder].bronze.name: folder for folder in FEEDS}
