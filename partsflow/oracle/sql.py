"""Reference SQL (DuckDB dialect) for every registered query.

The statements recompute each result from the given tables with plain SQL:
feeds -> declared types -> silver -> dimensions -> facts, as common table
expressions.  They are used by the correctness check (DuckDB on the same
Parquet files) and by the tests.

Engine notes kept in the text:
* money is built in integer cents, so double->decimal casts are exact;
* ``date_diff`` returns BIGINT in DuckDB, ``datediff`` INT in Spark: cast;
* DOUBLE->INT truncates in Spark and rounds in DuckDB: ``trunc`` first.
"""

from __future__ import annotations

from partsflow.plans import values as V
from partsflow.plans.feeds import SEQ_DELETE, SEQ_LATE, SEQ_REINSERT, SEQ_UPDATE


# ---------------------------------------------------------------------------
# small SQL builders
# ---------------------------------------------------------------------------
def mix(x: str, a: int, b: int, m) -> str:
    return f"((({x}) * {a} + {b}) % ({m}))"


def pick(bucket: str, weighted, last) -> str:
    arms = " ".join(f"WHEN {bucket} < {b} THEN {lit(v)}" for b, v in V.cumulative(weighted))
    return f"(CASE {arms} ELSE {lit(last)} END)"


def lit(v) -> str:
    return f"'{v}'" if isinstance(v, str) else str(v)


def element(values, idx: str) -> str:
    return "([" + ", ".join(lit(v) for v in values) + f"])[({idx}) + 1]"


def cents(x: str) -> str:
    return f"CAST(ROUND(({x}) * 100.0) AS BIGINT)"


def money(x: str) -> str:
    return f"(CAST(({x}) AS DOUBLE) / CAST(100 AS DOUBLE))"


def half_up(x: str, p: str) -> str:
    return f"((({x}) * ({p}) + 50) // 100)"


def days_before(day: str, n: str) -> str:
    return f"(DATE '{day}' - CAST(({n}) AS INTEGER))"


LEAD = lambda k: f"CAST({pick(mix(k, 7919, 13, 100), V.LEAD_TIMES, V.LEAD_TIMES[-1][0])} AS BIGINT)"
N_PARTS = "(SELECT count(*) FROM part)"
N_TECH = "(SELECT max(user_id) + 1 FROM events)"


def _subcategory(k: str) -> str:
    arms = " ".join(
        f"WHEN {k} % 10 = {i} THEN {element(V.PART_SUBCATS[c], f'{k} % {len(V.PART_SUBCATS[c])}')}"
        for i, c in enumerate(V.PART_CATEGORIES))
    return f"(CASE {arms} END)"


# ---------------------------------------------------------------------------
# feeds
# ---------------------------------------------------------------------------
def feed_parts_sql() -> str:
    k = "p_partkey"
    base = cents("p_retailprice")
    cat = element(V.PART_CATEGORIES, f"{k} % 10")
    sub = _subcategory(k)
    name = f"(p_name || ' #' || CAST({k} AS VARCHAR))"
    price_c = (f"(CASE WHEN kind = 2 THEN (CASE WHEN {k} % 4 <> 0 THEN {half_up(base, '130')} "
               f"ELSE {half_up(base, '90')} END) WHEN kind = 4 THEN {base} + 100 ELSE {base} END)")
    cost0 = half_up(base, f"{mix(k, 31, 7, 30)} + 55")
    return f"""
SELECT printf('PART-%05d', {k}) AS part_id,
       printf('PW-%s-%05d', substr({cat}, 1, 3), {k}) AS part_number,
       CASE WHEN {k} % 13 = 5 THEN '  ' || {name} || '  ' ELSE {name} END AS part_name,
       CASE WHEN {k} % 11 = 3 THEN lower(' ' || {cat} || ' ') ELSE {cat} END AS category,
       CASE WHEN {k} % 7 = 2 THEN lower({sub}) ELSE {sub} END AS subcategory,
       CASE WHEN (kind <= 1 AND {k} % 97 = 0) OR (kind = 3 AND {k} % 150 = 57) THEN NULL
            ELSE {money(price_c)} END AS piece_part_price,
       {money(f"CASE WHEN kind = 5 THEN {half_up(cost0, '110')} ELSE {cost0} END")} AS standard_cost,
       {LEAD(k)} AS lead_time_days,
       printf('SUPP-%03d', {k} % {V.N_SUPPLIERS} + 1) AS supplier_id,
       CASE WHEN {k} % 41 = 0 THEN NULL ELSE {pick(mix(k, 104729, 7, 100), V.UNITS, 'FT')} END AS unit_of_measure,
       CASE WHEN {k} % 43 = 0 THEN NULL ELSE TRUE END AS is_active,
       CASE WHEN kind <= 1 THEN (CASE WHEN {k} % 89 = 0 THEN 'insert' ELSE 'INSERT' END)
            WHEN kind = 3 THEN 'DELETE' WHEN kind = 4 THEN 'INSERT' ELSE 'UPDATE' END AS _op,
       CAST({k} + 1 + CASE kind WHEN 2 THEN {SEQ_UPDATE} WHEN 3 THEN {SEQ_DELETE}
            WHEN 4 THEN {SEQ_REINSERT} WHEN 5 THEN {SEQ_LATE} ELSE 0 END AS BIGINT) AS _sequence,
       CAST(CASE WHEN kind <= 1 THEN {days_before('2025-07-04', mix(k, 7919, 3, 179) + ' + 1')}
                 WHEN kind = 2 THEN {days_before('2025-12-31', mix(k, 31, 11, 29) + ' + 1')}
                 WHEN kind = 3 THEN {days_before('2025-12-31', mix(k, 37, 1, 29) + ' + 1')}
                 WHEN kind = 4 THEN DATE '2025-12-31'
                 ELSE {days_before('2025-10-01', mix(k, 13, 2, 30))} END AS TIMESTAMP) AS updated_at,
       CASE WHEN kind <= 1 THEN 1 WHEN kind = 5 THEN 3 ELSE 2 END AS batch
FROM part CROSS JOIN (VALUES (0), (1), (2), (3), (4), (5)) AS kinds(kind)
WHERE CASE kind WHEN 0 THEN TRUE WHEN 1 THEN {k} % 40 = 0 WHEN 2 THEN {k} % 6 = 0
                WHEN 3 THEN {k} % 50 = 7 WHEN 4 THEN {k} % 100 = 7 ELSE {k} % 35 = 5 END
"""


def feed_customers_sql() -> str:
    k = "c_custkey"
    tier = pick(mix(k, 7919, 17, 100), V.CUSTOMER_TIERS, "ENTERPRISE")
    upgrade = "CASE " + " ".join(f"WHEN {tier} = '{a}' THEN '{b}'" for a, b in V.TIER_UPGRADE.items()) + " END"
    tier_now = f"(CASE WHEN kind IN (1, 4) THEN {upgrade} ELSE {tier} END)"
    mult = pick(mix(k, 7919, 17, 100), [(m, w) for (_, w), m in zip(V.CUSTOMER_TIERS, (10, 30, 70, 200))], 200)
    return f"""
SELECT printf('CUST-%05d', {k}) AS customer_id,
       CASE WHEN {k} % 13 = 5 THEN '  ' || c_name || '  ' ELSE c_name END AS customer_name,
       CASE WHEN kind = 2 THEN printf('%d %s', {mix(k, 131, 9, 9900)} + 100, n_name)
            ELSE printf('%d %s', {mix(k, 7919, 1, 9900)} + 100, c_mktsegment) END AS address,
       CASE WHEN {k} % 17 = 4 THEN ' ' || n_name || ' ' ELSE n_name END AS city,
       CASE WHEN {k} % 7 = 1 THEN printf('s%02d', c_nationkey) ELSE printf('S%02d', c_nationkey) END AS state,
       CASE WHEN kind = 2 THEN printf('%05d', {mix(k, 611, 5, 89999)} + 10000)
            ELSE printf('%05d', {mix(k, 104729, 3, 89999)} + 10000) END AS zip,
       CASE WHEN kind = 0 AND {k} % 9 = 2 THEN lower({tier_now}) ELSE {tier_now} END AS customer_tier,
       printf('AM-%03d', {k} % 20) AS account_manager,
       CASE WHEN {k} % 11 = 6 THEN lower(r_name) || ' ' ELSE r_name END AS region,
       {money(f"{cents('c_acctbal')} * {mult}")} AS annual_revenue,
       CASE WHEN {k} % 43 = 0 THEN NULL ELSE {k} % 37 <> 0 END AS is_active,
       CASE WHEN kind = 0 THEN (CASE WHEN {k} % 89 = 0 THEN NULL ELSE 'INSERT' END)
            WHEN kind = 3 THEN 'DELETE' ELSE 'UPDATE' END AS _op,
       CAST({k} + 1 + CASE WHEN kind IN (1, 2, 4) THEN {SEQ_UPDATE} WHEN kind = 3 THEN {SEQ_DELETE} ELSE 0 END
            AS BIGINT) AS _sequence,
       CAST(CASE WHEN kind = 0 THEN {days_before('2025-12-31', mix(k, 31, 5, 364) + ' + 1')}
                 WHEN kind = 3 THEN {days_before('2025-12-31', mix(k, 19, 2, 29) + ' + 1')}
                 ELSE {days_before('2025-12-31', mix(k, 17, 3, 29) + ' + 1')} END AS TIMESTAMP) AS updated_at,
       CASE WHEN kind = 0 THEN 1 ELSE 2 END AS batch
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
CROSS JOIN (VALUES (0), (1), (2), (3), (4)) AS kinds(kind)
WHERE CASE kind WHEN 0 THEN TRUE WHEN 1 THEN {k} % 8 = 0 WHEN 2 THEN {k} % 8 = 4
                WHEN 3 THEN {k} % 60 = 11 ELSE {k} % 80 = 0 END
"""


def feed_demand_sql() -> str:
    k = "event_id"
    fq = "CAST(least(greatest(CAST(floor(value) AS BIGINT), 1), 500) AS BIGINT)"
    fq = f"(CASE WHEN {k} % 53 = 0 THEN CAST(0 AS BIGINT) ELSE {fq} END)"
    return f"""
SELECT printf('SIG-%07d', {k}) AS signal_id,
       printf('PART-%05d', ({k} * 7919 + 11) % {N_PARTS}) AS part_id,
       CAST(ts AS DATE) AS forecast_date,
       {fq} AS forecasted_qty,
       CASE WHEN {k} % 29 = 0 THEN NULL ELSE ({fq} * ({mix(k, 131, 7, 31)} + 85)) // 100 END AS actual_qty,
       {pick(mix(k, 104729, 5, 100), V.SIGNAL_TYPES, 'BASELINE')} AS signal_type,
       CAST({mix(k, 7919, 0, 10000)} AS DOUBLE) / CAST(10000 AS DOUBLE) AS confidence_score,
       {element(V.REGIONS, 'user_id % 5')} AS region,
       ts AS created_at
FROM events
"""


def feed_po_sql() -> str:
    k = "o_orderkey"
    status = pick(mix(k, 104729, 1, 100), V.PO_STATUSES, "CANCELLED")
    price = "coalesce(price_c, 5000)"
    return f"""
SELECT printf('PO-%07d', {k}) AS po_id,
       printf('SIG-%07d', {k}) AS signal_id,
       printf('PART-%05d', pk) AS part_id,
       printf('SUPP-%03d', {k} % {V.N_SUPPLIERS} + 1) AS supplier_id,
       CAST(o_orderdate AS DATE) AS po_date,
       CAST(o_orderdate AS DATE) + CAST({LEAD('pk')} AS INTEGER) AS expected_receipt_date,
       CAST(CASE WHEN {k} % 71 = 0 THEN 0 ELSE {mix(k, 7919, 5, 40)} + 1 END AS BIGINT) AS ordered_qty,
       {money(half_up(price, f"{mix(k, 131, 3, 21)} + 90"))} AS unit_price,
       CASE WHEN {k} % 9 = 4 THEN lower({status}) ELSE {status} END AS po_status,
       printf('BUYER-%03d', {k} % 15) AS buyer_id,
       o_orderdate AS created_at
FROM (SELECT o_orderkey, o_orderdate, ({k} * 7919 + 11) % {N_PARTS} AS pk FROM orders) o
LEFT JOIN (SELECT p_partkey, {cents('p_retailprice')} AS price_c FROM part) p ON o.pk = p.p_partkey
"""


def _line_key() -> str:
    return "(l_orderkey * 8 + l_linenumber)"


def _receiver_id() -> str:
    return "printf('RCV-%07d-%d-%d', l_orderkey, l_linenumber, l_partkey)"


def feed_receivers_sql() -> str:
    x = _line_key()
    st = "(CASE l_returnflag WHEN 'R' THEN 'REJECTED' WHEN 'A' THEN 'PARTIAL_ACCEPT' ELSE 'ACCEPTED' END)"
    delay = pick(mix(x, 7919, 3, 100), V.RECEIPT_DELAYS, 14)
    return f"""
SELECT {_receiver_id()} AS receiver_id,
       printf('PO-%07d', l_orderkey) AS po_id,
       printf('PART-%05d', l_partkey) AS part_id,
       CAST(l_shipdate AS DATE) + CAST({delay} AS INTEGER) AS received_date,
       CAST(trunc(l_quantity) AS BIGINT) AS received_qty,
       printf('WH-%04d', l_suppkey) AS warehouse_location,
       CASE WHEN {x} % 101 = 0 THEN NULL WHEN l_linenumber = 7 THEN lower({st}) ELSE {st} END AS quality_status,
       printf('INSP-%03d', l_suppkey % 10) AS inspector_id,
       l_shipdate AS created_at
FROM lineitem
"""


def feed_invoices_sql() -> str:
    x = _line_key()
    status = f"(CASE WHEN l_linestatus = 'F' THEN 'PAID' WHEN {mix(x, 17, 1, 10)} < 7 THEN 'PENDING' ELSE 'OVERDUE' END)"
    terms = pick(mix(x, 7919, 29, 100), V.PAYMENT_TERMS, 90)
    inv_date = f"(CAST(l_shipdate AS DATE) + CAST({mix(x, 131, 1, 7)} AS INTEGER))"
    amount = half_up(cents("l_extendedprice"), "100 - CAST(ROUND(l_discount * 100) AS BIGINT)")
    return f"""
SELECT printf('INV-%07d-%d-%d', l_orderkey, l_linenumber, l_partkey) AS invoice_id,
       printf('PO-%07d', l_orderkey) AS po_id,
       {_receiver_id()} AS receiver_id,
       printf('SUPP-%03d', l_suppkey % {V.N_SUPPLIERS} + 1) AS supplier_id,
       {inv_date} AS invoice_date,
       {money(amount)} AS invoice_amount,
       CASE WHEN {x} % 9 = 3 THEN lower({status}) ELSE {status} END AS payment_status,
       CASE WHEN l_linestatus = 'F' THEN {inv_date} + CAST({terms} AS INTEGER) END AS payment_date,
       CASE WHEN l_linestatus = 'F' THEN CAST({terms} AS DOUBLE) END AS days_to_payment,
       l_shipdate AS created_at
FROM lineitem
"""


def _priority() -> str:
    return ("(CASE o_orderpriority WHEN '1-URGENT' THEN 'URGENT' WHEN '2-HIGH' THEN 'HIGH' "
            "WHEN '3-MEDIUM' THEN 'MEDIUM' ELSE 'LOW' END)")


def _wo_dates(k: str) -> tuple[str, str]:
    window = "(CASE " + " ".join(f"WHEN {_priority()} = '{p}' THEN {d}" for p, d in V.PRIORITY_WINDOW.items()) + " END)"
    scheduled = f"(DATE '2024-01-01' + CAST(({k} // {N_TECH}) % 30 AS INTEGER))"
    created = f"({scheduled} - CAST({mix(k, 31, 1, window)} + 1 AS INTEGER))"
    return created, scheduled


def feed_work_orders_sql() -> str:
    k = "o_orderkey"
    created, scheduled = _wo_dates(k)
    wo_type = pick(mix(k, 7919, 7, 100), V.WO_TYPES, "INSPECTION")
    status = pick(mix(k, 104729, 2, 100), V.WO_STATUSES, "CANCELLED")
    return f"""
SELECT printf('WO-%07d', {k}) AS wo_id,
       CASE WHEN {k} % 101 = 0 THEN NULL ELSE printf('CUST-%05d', o_custkey) END AS customer_id,
       printf('PART-%05d', ({k} * 104729 + 3) % {N_PARTS}) AS part_id,
       printf('TECH-%04d', {k} % {N_TECH}) AS technician_id,
       {created} AS created_date,
       {scheduled} AS scheduled_date,
       {wo_type} AS wo_type,
       CASE WHEN {k} % 9 = 7 THEN lower({_priority()}) ELSE {_priority()} END AS priority,
       CASE WHEN {k} % 9 = 1 THEN lower({status}) ELSE {status} END AS wo_status,
       printf('Service work order #%d - %s', {k}, {wo_type}) AS description,
       r_name AS region,
       CAST({created} AS TIMESTAMP) AS created_at
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey
"""


def _delay(constraint: str, table: dict, fallback: str) -> str:
    return "(CASE " + " ".join(f"WHEN {constraint} = '{n}' THEN {d}" for n, d in table.items()) + f" ELSE {fallback} END)"


def feed_quotes_sql() -> str:
    k = "o_orderkey"
    qx = f"({k} * 4 + j)"
    created, _ = _wo_dates(k)
    quote_date = f"({created} + CAST({mix(qx, 131, 5, 3)} AS INTEGER))"
    avail = pick(mix(qx, 7919, 1, 100), V.AVAILABILITY, "SPECIAL_ORDER")
    labor = pick(mix(qx, 104729, 4, 100), V.LABOR_AVAILABILITY, "NEXT_WEEK")
    delay = f"greatest({_delay(avail, V.PARTS_DELAY, LEAD('pk'))}, {_delay(labor, V.LABOR_DELAY, 'NULL')})"
    slack = f"({mix(qx, 17, 3, V.SLACK_DAYS[1] - V.SLACK_DAYS[0] + 1)} + {V.SLACK_DAYS[0]})"
    parts_c = f"((coalesce(price_c, 5000) * ({mix(qx, 7919, 1, 201)} + 100)) // 100)"
    labor_c = f"({mix(qx, 104729, 9, 16000)} + 4000)"
    status = pick(mix(qx, 31, 8, 100), V.QUOTE_STATUSES, "EXPIRED")
    return f"""
SELECT printf('QT-%07d-%d', {k}, j) AS quote_id,
       printf('WO-%07d', {k}) AS wo_id,
       printf('CUST-%05d', o_custkey) AS customer_id,
       printf('PART-%05d', pk) AS part_id,
       {quote_date} AS quote_date,
       {money(parts_c)} AS parts_cost,
       {money(labor_c)} AS labor_cost,
       {money(f"CASE WHEN {qx} % 97 = 0 THEN 0 ELSE {parts_c} + {labor_c} END")} AS total_amount,
       {quote_date} + CAST({delay} + {slack} AS INTEGER) AS expected_completion_date,
       {avail} AS availability_constraint,
       {labor} AS labor_constraint,
       CASE WHEN {qx} % 9 = 5 THEN lower({status}) ELSE {status} END AS quote_status,
       CAST({quote_date} AS TIMESTAMP) AS created_at
FROM (SELECT o_orderkey, o_custkey, o_orderpriority, ({k} * 104729 + 3) % {N_PARTS} AS pk, js.j
      FROM orders JOIN (VALUES (1), (2), (3)) AS js(j) ON js.j <= o_orderkey % 3 + 1) o
LEFT JOIN (SELECT p_partkey, {cents('p_retailprice')} AS price_c FROM part) p ON o.pk = p.p_partkey
"""


def feed_labor_sql() -> str:
    k = "event_id"
    a = mix(k, 7919, 1, 10)
    avail = f"(CASE WHEN {a} < 8 THEN 80 WHEN {a} = 8 THEN 60 ELSE 40 END)"
    booked = f"(CASE WHEN {k} % 50 = 0 THEN {avail} + 15 ELSE ({avail} * {mix(k, 131, 7, 101)}) // 100 END)"
    avail_out = f"(CASE WHEN {k} % 97 = 0 THEN -10 ELSE {avail} END)"
    name = "printf('Tech %04d', user_id)"
    region = element(V.REGIONS, "user_id % 5")
    return f"""
SELECT printf('SCHED-%07d', {k}) AS schedule_id,
       printf('TECH-%04d', user_id) AS technician_id,
       CASE WHEN user_id % 7 = 3 THEN '  ' || {name} || '  ' ELSE {name} END AS technician_name,
       CAST(ts AS DATE) AS schedule_date,
       CAST({avail_out} AS DOUBLE) / CAST(10 AS DOUBLE) AS available_hours,
       CAST({booked} AS DOUBLE) / CAST(10 AS DOUBLE) AS booked_hours,
       CASE WHEN user_id % 3 = 1 THEN lower({region}) ELSE {region} END AS region,
       {element(V.SKILL_LEVELS, 'user_id % 4')} AS skill_level,
       ts AS created_at
FROM events
"""


FEED_SQL = {
    "parts_cdc": feed_parts_sql,
    "customers_cdc": feed_customers_sql,
    "demand_signals": feed_demand_sql,
    "purchase_orders": feed_po_sql,
    "receivers": feed_receivers_sql,
    "invoices": feed_invoices_sql,
    "work_orders": feed_work_orders_sql,
    "customer_quotes": feed_quotes_sql,
    "labor_schedules": feed_labor_sql,
}

# Declared types applied at ingest (see schemas.FEEDS); columns not listed keep
# their physical type.
TYPED_COLUMNS = {
    "parts_cdc": {"lead_time_days": "CAST(lead_time_days AS INTEGER)"},
    "demand_signals": {"forecasted_qty": "CAST(forecasted_qty AS INTEGER)",
                       "actual_qty": "CAST(actual_qty AS INTEGER)"},
    "purchase_orders": {"ordered_qty": "CAST(ordered_qty AS INTEGER)"},
    "receivers": {"received_qty": "CAST(received_qty AS INTEGER)"},
    "invoices": {"days_to_payment": "CAST(trunc(days_to_payment) AS INTEGER)"},
}

FEED_COLUMNS = {
    "parts_cdc": ["part_id", "part_number", "part_name", "category", "subcategory", "piece_part_price",
                  "standard_cost", "lead_time_days", "supplier_id", "unit_of_measure", "is_active", "_op",
                  "_sequence", "updated_at", "batch"],
    "customers_cdc": ["customer_id", "customer_name", "address", "city", "state", "zip", "customer_tier",
                      "account_manager", "region", "annual_revenue", "is_active", "_op", "_sequence",
                      "updated_at", "batch"],
    "demand_signals": ["signal_id", "part_id", "forecast_date", "forecasted_qty", "actual_qty", "signal_type",
                       "confidence_score", "region", "created_at"],
    "purchase_orders": ["po_id", "signal_id", "part_id", "supplier_id", "po_date", "expected_receipt_date",
                        "ordered_qty", "unit_price", "po_status", "buyer_id", "created_at"],
    "receivers": ["receiver_id", "po_id", "part_id", "received_date", "received_qty", "warehouse_location",
                  "quality_status", "inspector_id", "created_at"],
    "invoices": ["invoice_id", "po_id", "receiver_id", "supplier_id", "invoice_date", "invoice_amount",
                 "payment_status", "payment_date", "days_to_payment", "created_at"],
    "work_orders": ["wo_id", "customer_id", "part_id", "technician_id", "created_date", "scheduled_date",
                    "wo_type", "priority", "wo_status", "description", "region", "created_at"],
    "customer_quotes": ["quote_id", "wo_id", "customer_id", "part_id", "quote_date", "parts_cost", "labor_cost",
                        "total_amount", "expected_completion_date", "availability_constraint",
                        "labor_constraint", "quote_status", "created_at"],
    "labor_schedules": ["schedule_id", "technician_id", "technician_name", "schedule_date", "available_hours",
                        "booked_hours", "region", "skill_level", "created_at"],
}


def typed_sql(folder: str) -> str:
    casts = TYPED_COLUMNS.get(folder, {})
    cols = ", ".join(f"{casts[c]} AS {c}" if c in casts else c for c in FEED_COLUMNS[folder])
    return f"SELECT {cols} FROM feed_{folder}"


# ---------------------------------------------------------------------------
# silver
# ---------------------------------------------------------------------------
SILVER_SQL = {
    "silver_parts": ("parts_cdc", """
SELECT part_id, part_number, trim(part_name) AS part_name, upper(trim(category)) AS category,
       upper(trim(subcategory)) AS subcategory, CAST(piece_part_price AS DECIMAL(12,2)) AS piece_part_price,
       CAST(standard_cost AS DECIMAL(12,2)) AS standard_cost, CAST(lead_time_days AS INTEGER) AS lead_time_days,
       supplier_id, coalesce(unit_of_measure, 'EA') AS unit_of_measure, coalesce(is_active, TRUE) AS is_active,
       _op, _sequence, updated_at
FROM typed_parts_cdc
WHERE part_id IS NOT NULL AND piece_part_price >= 0 AND _op IN ('INSERT', 'UPDATE', 'DELETE')"""),
    "silver_customers": ("customers_cdc", """
SELECT customer_id, trim(customer_name) AS customer_name, trim(address) AS address, trim(city) AS city,
       upper(trim(state)) AS state, trim(zip) AS zip, upper(trim(customer_tier)) AS customer_tier,
       trim(account_manager) AS account_manager, upper(trim(region)) AS region,
       CAST(annual_revenue AS DECIMAL(14,2)) AS annual_revenue, coalesce(is_active, TRUE) AS is_active,
       _op, _sequence, updated_at
FROM typed_customers_cdc
WHERE customer_id IS NOT NULL AND _op IN ('INSERT', 'UPDATE', 'DELETE')"""),
    "silver_demand_signals": ("demand_signals", """
SELECT signal_id, part_id, CAST(forecast_date AS DATE) AS forecast_date,
       CAST(forecasted_qty AS INTEGER) AS forecasted_qty, CAST(actual_qty AS INTEGER) AS actual_qty,
       CAST(actual_qty - forecasted_qty AS INTEGER) AS forecast_variance, signal_type,
       CAST(confidence_score AS DECIMAL(5,4)) AS confidence_score, region, created_at
FROM typed_demand_signals
WHERE signal_id IS NOT NULL AND part_id IS NOT NULL AND forecasted_qty > 0"""),
    "silver_purchase_orders": ("purchase_orders", """
SELECT po_id, signal_id, part_id, supplier_id, CAST(po_date AS DATE) AS po_date,
       CAST(expected_receipt_date AS DATE) AS expected_receipt_date, CAST(ordered_qty AS INTEGER) AS ordered_qty,
       CAST(unit_price AS DECIMAL(12,2)) AS unit_price,
       CAST(ordered_qty * unit_price AS DECIMAL(14,2)) AS po_total_value,
       upper(po_status) AS po_status, buyer_id, created_at
FROM typed_purchase_orders
WHERE po_id IS NOT NULL AND part_id IS NOT NULL AND ordered_qty > 0"""),
    "silver_receivers": ("receivers", """
SELECT receiver_id, po_id, part_id, CAST(received_date AS DATE) AS received_date,
       CAST(received_qty AS INTEGER) AS received_qty, warehouse_location, upper(quality_status) AS quality_status,
       inspector_id, created_at
FROM typed_receivers
WHERE receiver_id IS NOT NULL AND po_id IS NOT NULL AND received_qty > 0 AND quality_status <> 'REJECTED'"""),
    "silver_invoices": ("invoices", """
SELECT invoice_id, po_id, receiver_id, supplier_id, CAST(invoice_date AS DATE) AS invoice_date,
       CAST(invoice_amount AS DECIMAL(14,2)) AS invoice_amount, upper(payment_status) AS payment_status,
       CAST(payment_date AS DATE) AS payment_date, CAST(days_to_payment AS INTEGER) AS days_to_payment, created_at
FROM typed_invoices
WHERE invoice_id IS NOT NULL AND po_id IS NOT NULL AND invoice_amount > 0"""),
    "silver_work_orders": ("work_orders", """
SELECT wo_id, customer_id, part_id, technician_id, CAST(created_date AS DATE) AS created_date,
       CAST(scheduled_date AS DATE) AS scheduled_date, wo_type, upper(priority) AS priority,
       upper(wo_status) AS wo_status, description, region, created_at
FROM typed_work_orders
WHERE wo_id IS NOT NULL AND customer_id IS NOT NULL"""),
    "silver_customer_quotes": ("customer_quotes", """
SELECT quote_id, wo_id, customer_id, part_id, CAST(quote_date AS DATE) AS quote_date,
       CAST(parts_cost AS DECIMAL(12,2)) AS parts_cost, CAST(labor_cost AS DECIMAL(12,2)) AS labor_cost,
       CAST(total_amount AS DECIMAL(14,2)) AS total_amount,
       CAST(expected_completion_date AS DATE) AS expected_completion_date, availability_constraint,
       labor_constraint, upper(quote_status) AS quote_status,
       CAST(date_diff('day', quote_date, expected_completion_date) AS INTEGER) AS days_to_completion, created_at
FROM typed_customer_quotes
WHERE quote_id IS NOT NULL AND wo_id IS NOT NULL AND total_amount > 0"""),
    "silver_labor_schedules": ("labor_schedules", """
SELECT schedule_id, technician_id, trim(technician_name) AS technician_name,
       CAST(schedule_date AS DATE) AS schedule_date, CAST(available_hours AS DECIMAL(5,2)) AS available_hours,
       CAST(booked_hours AS DECIMAL(5,2)) AS booked_hours,
       CAST(available_hours - booked_hours AS DECIMAL(5,2)) AS remaining_hours,
       upper(region) AS region, skill_level, created_at
FROM typed_labor_schedules
WHERE schedule_id IS NOT NULL AND technician_id IS NOT NULL AND available_hours >= 0"""),
}

SILVER_PREDICATE = {name: sql.split("WHERE", 1)[1].strip() for name, (_, sql) in SILVER_SQL.items()}

PART_DIM_COLS = ("part_id, part_number, part_name, category, subcategory, piece_part_price, standard_cost, "
                 "lead_time_days, supplier_id, unit_of_measure, is_active, updated_at")
CUSTOMER_DIM_COLS = ("customer_id, customer_name, address, city, state, zip, customer_tier, account_manager, "
                     "region, annual_revenue, is_active, updated_at")


def _scd_sql(source: str, key: str, cols: str) -> dict[str, str]:
    order = "(_op = 'DELETE') DESC, updated_at DESC NULLS LAST"
    collapsed = (f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key}, _sequence ORDER BY {order}) "
                 f"AS rn FROM {source} WHERE _sequence IS NOT NULL) WHERE rn = 1")
    type1 = (f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY _sequence DESC, "
             f"{order}) AS rn FROM {source} WHERE _sequence IS NOT NULL) WHERE rn = 1 AND _op <> 'DELETE'")
    type2 = (f"SELECT {cols}, _sequence AS __START_AT, "
             f"lead(_sequence) OVER (PARTITION BY {key} ORDER BY _sequence) AS __END_AT, _op "
             f"FROM ({collapsed})")
    type2 = f"SELECT * EXCLUDE (_op) FROM ({type2}) WHERE _op <> 'DELETE'"
    return {"type1": type1, "type2": type2, "collapsed": collapsed}


_PART_SCD = _scd_sql("silver_parts", "part_id", PART_DIM_COLS)
_CUST_SCD = _scd_sql("silver_customers", "customer_id", CUSTOMER_DIM_COLS)

DIM_SQL = {
    "dim_part_type1": ("silver_parts", _PART_SCD["type1"]),
    "dim_part_type2": ("silver_parts", _PART_SCD["type2"]),
    "dim_customer_type1": ("silver_customers", _CUST_SCD["type1"]),
    "dim_customer_type2": ("silver_customers", _CUST_SCD["type2"]),
}

FACT_SQL = {
    "fact_demand_fulfillment": (
        ["silver_purchase_orders", "silver_demand_signals", "silver_receivers", "silver_invoices", "dim_part_type1"],
        """
SELECT ds.signal_id, po.po_id, r.receiver_id, inv.invoice_id, po.part_id, po.supplier_id,
       ds.forecast_date, ds.forecasted_qty, ds.actual_qty, ds.forecast_variance, ds.signal_type,
       ds.confidence_score, ds.region AS demand_region,
       po.po_date, po.expected_receipt_date, po.ordered_qty, po.unit_price, po.po_total_value, po.po_status,
       r.received_date, r.received_qty, r.warehouse_location, r.quality_status,
       CAST(date_diff('day', po.expected_receipt_date, r.received_date) AS INTEGER) AS receipt_variance_days,
       inv.invoice_date, inv.invoice_amount, inv.payment_status, inv.payment_date, inv.days_to_payment,
       dp.part_name, dp.category, dp.subcategory, dp.lead_time_days
FROM silver_purchase_orders po
LEFT JOIN silver_demand_signals ds ON ds.signal_id = po.signal_id
LEFT JOIN silver_receivers r ON r.po_id = po.po_id
LEFT JOIN silver_invoices inv ON inv.po_id = po.po_id
LEFT JOIN dim_part_type1 dp ON dp.part_id = po.part_id"""),
    "fact_work_order_completion": (
        ["silver_work_orders", "silver_customer_quotes", "silver_labor_schedules", "dim_part_type1",
         "dim_customer_type1"],
        """
SELECT wo.wo_id, q.quote_id, wo.customer_id, wo.part_id, wo.technician_id,
       wo.created_date, wo.scheduled_date, wo.wo_type, wo.priority, wo.wo_status, wo.region,
       q.quote_date, q.parts_cost, q.labor_cost, q.total_amount, q.expected_completion_date,
       q.days_to_completion, q.quote_status, q.availability_constraint, q.labor_constraint,
       ls.available_hours, ls.booked_hours, ls.remaining_hours, ls.skill_level,
       dp.part_name, dp.category, dp.piece_part_price AS current_piece_part_price, dp.lead_time_days,
       dc.customer_name, dc.customer_tier, dc.region AS customer_region, dc.annual_revenue
FROM silver_work_orders wo
LEFT JOIN silver_customer_quotes q ON q.wo_id = wo.wo_id
LEFT JOIN silver_labor_schedules ls ON ls.technician_id = wo.technician_id AND ls.schedule_date = wo.scheduled_date
LEFT JOIN dim_part_type1 dp ON dp.part_id = wo.part_id
LEFT JOIN dim_customer_type1 dc ON dc.customer_id = wo.customer_id"""),
}

# Consumer queries over the dimensions.
ANALYTICS_SQL = {
    "q_part_current": (["dim_part_type1"],
                       "SELECT part_id, part_name, piece_part_price FROM dim_part_type1"),
    "q_part_history": (["dim_part_type2"],
                       "SELECT part_id, part_name, piece_part_price, __START_AT, __END_AT FROM dim_part_type2 "
                       "ORDER BY part_id, __START_AT"),
    "q_customer_current": (["dim_customer_type2"],
                           "SELECT customer_id, customer_name, customer_tier, __START_AT FROM dim_customer_type2 "
                           "WHERE __END_AT IS NULL ORDER BY customer_id"),
    "q_customer_tier_journey": (["dim_customer_type2"],
                                "SELECT customer_id, customer_name, customer_tier, address, __START_AT, __END_AT "
                                "FROM dim_customer_type2 WHERE __END_AT IS NULL ORDER BY customer_id LIMIT 20"),
    "q_part_price_asof": (["dim_part_type2"], """
SELECT v.part_id, v.__START_AT AS changed_at, v.piece_part_price AS new_price, p.piece_part_price AS previous_price
FROM dim_part_type2 v
LEFT JOIN dim_part_type2 p ON p.part_id = v.part_id AND p.__START_AT <= v.__START_AT - 1
     AND (p.__END_AT IS NULL OR v.__START_AT - 1 < p.__END_AT)"""),
    "q_scd_compare": (["dim_part_type1", "dim_part_type2"], """
SELECT h.part_id, h.n_versions, h.n_open, c.piece_part_price AS type1_price, h.open_price
FROM (SELECT part_id, CAST(count(*) AS BIGINT) AS n_versions,
             CAST(count(*) FILTER (WHERE __END_AT IS NULL) AS BIGINT) AS n_open,
             max(piece_part_price) FILTER (WHERE __END_AT IS NULL) AS open_price
      FROM dim_part_type2 GROUP BY part_id) h
LEFT JOIN dim_part_type1 c ON c.part_id = h.part_id"""),
    "scd_deletes": (["silver_parts", "dim_part_type2"], f"""
SELECT d.part_id, d._sequence AS deleted_at, v.__START_AT AS closed_version_start,
       v.piece_part_price AS last_price
FROM ({_PART_SCD['collapsed']}) d
LEFT JOIN dim_part_type2 v ON v.part_id = d.part_id AND v.__END_AT = d._sequence
WHERE d._op = 'DELETE'"""),
}
