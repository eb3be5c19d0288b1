"""Silver projections over raw products and fractional quantities.

The feeds carry money in whole cents, on which half-up, half-even and cutting agree.
Here the purchase-order and labor projections run on feed-shaped rows of ``lineitem``
whose prices are unrounded products, whose quantities have fractions and whose hours
have eighths, so that a wrong rounding, or one rounding too many, changes rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partsflow.operators.clean import clean
from partsflow.plans.silver import SILVER
from partsflow.sources.files import typed_feed

_PO = """
concat('PO-', l_orderkey, '-', l_linenumber) AS po_id, CAST(NULL AS {string}) AS signal_id, concat('PART-', l_partkey) AS part_id,
concat('SUP-', l_suppkey) AS supplier_id, CAST(l_shipdate AS DATE) AS po_date, CAST(l_shipdate AS DATE) AS expected_receipt_date,
{qty} AS ordered_qty, l_extendedprice * l_tax AS unit_price, lower(l_linestatus) AS po_status, l_returnflag AS buyer_id, {ts} AS created_at"""
_LABOR = """
concat('LS-', l_orderkey, '-', l_linenumber) AS schedule_id, concat('T-', l_suppkey) AS technician_id, concat(' ', l_returnflag, ' ') AS technician_name,
CAST(l_shipdate AS DATE) AS schedule_date, l_quantity * l_discount + l_linenumber / 8.0{e} AS available_hours, l_quantity * l_tax + l_linenumber / 4.0{e} AS booked_hours,
lower(l_linestatus) AS region, l_returnflag AS skill_level, {ts} AS created_at"""


def _feed(lineitem: DataFrame, columns: str, folder: str, silver: str) -> DataFrame:
    spelled = columns.format(string="STRING", qty="l_quantity * l_discount", ts="CAST(l_shipdate AS TIMESTAMP_NTZ)", e="D")
    raw = lineitem.select(F.expr(f"struct({spelled})").alias("r")).select("r.*")
    return clean(typed_feed(raw, folder), SILVER[silver])


def purchase_orders(lineitem: DataFrame) -> DataFrame:
    return _feed(lineitem, _PO, "purchase_orders", "silver_purchase_orders")


def labor_schedules(lineitem: DataFrame) -> DataFrame:
    return _feed(lineitem, _LABOR, "labor_schedules", "silver_labor_schedules")


def _decimal(x: str, p: int) -> str:
    return f"CAST(CAST({x} AS VARCHAR) AS DECIMAL({p},2))"  # half up on the decimal text


PURCHASE_ORDERS_SQL = f"""
SELECT po_id, signal_id, part_id, supplier_id, po_date, expected_receipt_date, ordered_qty, {_decimal('unit_price', 12)} AS unit_price,
       {_decimal('ordered_qty * unit_price', 14)} AS po_total_value, upper(po_status) AS po_status, buyer_id, created_at
FROM (SELECT {_PO.format(string='VARCHAR', qty='CAST(trunc(l_quantity * l_discount) AS INTEGER)', ts='l_shipdate')} FROM lineitem)
WHERE ordered_qty > 0"""
LABOR_SCHEDULES_SQL = f"""
SELECT schedule_id, technician_id, trim(technician_name) AS technician_name, schedule_date, {_decimal('available_hours', 5)} AS available_hours,
       {_decimal('booked_hours', 5)} AS booked_hours, {_decimal('available_hours - booked_hours', 5)} AS remaining_hours, upper(region) AS region, skill_level, created_at
FROM (SELECT {_LABOR.format(ts='l_shipdate', e='::DOUBLE')} FROM lineitem)
WHERE available_hours >= 0"""
