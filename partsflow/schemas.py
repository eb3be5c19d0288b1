"""Declared schemas and table metadata of the nine feeds and the derived tables.

``FEEDS`` holds, per landing folder, the declared column types (the ingest
"schema hints"), the clustering columns and the table comment.  Timestamps are
declared ``TIMESTAMP_NTZ``: the landing files carry zone-less wall-clock
values, and keeping them zone-less makes results independent of the session
time zone.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class TableMeta:
    name: str
    cluster_by: tuple[str, ...]
    comment: str
    properties: dict[str, str] = field(default_factory=dict)
    watch: tuple[tuple[str, ...], ...] = ()  # keys whose frequent values are kept beside the table


@dataclass(frozen=True)
class FeedSpec:
    folder: str
    bronze: TableMeta
    hints: str  # DDL of the declared columns

    @property
    def hinted(self) -> list[tuple[str, str]]:
        return [(f.name, f.dataType.simpleString()) for f in StructType.fromDDL(self.hints).fields]


def _bronze(name: str, cluster: tuple[str, ...], comment: str) -> TableMeta:
    return TableMeta(name, cluster, comment, {"quality": "bronze", "layer": "ingestion"})


FEEDS: dict[str, FeedSpec] = {
    "parts_cdc": FeedSpec(
        "parts_cdc",
        _bronze("bronze_parts", ("part_id",), "Raw parts change events (insert / update / delete)."),
        "part_id STRING, part_number STRING, part_name STRING, category STRING, "
        "subcategory STRING, piece_part_price DOUBLE, standard_cost DOUBLE, lead_time_days INT, "
        "supplier_id STRING, unit_of_measure STRING, is_active BOOLEAN, _op STRING, "
        "_sequence BIGINT, updated_at TIMESTAMP_NTZ",
    ),
    "customers_cdc": FeedSpec(
        "customers_cdc",
        _bronze("bronze_customers", ("customer_id",), "Raw customer change events."),
        "customer_id STRING, customer_name STRING, address STRING, city STRING, state STRING, "
        "zip STRING, customer_tier STRING, account_manager STRING, region STRING, "
        "annual_revenue DOUBLE, is_active BOOLEAN, _op STRING, _sequence BIGINT, "
        "updated_at TIMESTAMP_NTZ",
    ),
    "demand_signals": FeedSpec(
        "demand_signals",
        _bronze("bronze_demand_signals", ("part_id", "forecast_date"), "Raw demand forecast signals."),
        "signal_id STRING, part_id STRING, forecast_date DATE, forecasted_qty INT, actual_qty INT, "
        "signal_type STRING, confidence_score DOUBLE, region STRING, created_at TIMESTAMP_NTZ",
    ),
    "purchase_orders": FeedSpec(
        "purchase_orders",
        _bronze("bronze_purchase_orders", ("po_id", "part_id"), "Raw purchase orders."),
        "po_id STRING, signal_id STRING, part_id STRING, supplier_id STRING, po_date DATE, "
        "expected_receipt_date DATE, ordered_qty INT, unit_price DOUBLE, po_status STRING, "
        "buyer_id STRING, created_at TIMESTAMP_NTZ",
    ),
    "receivers": FeedSpec(
        "receivers",
        _bronze("bronze_receivers", ("receiver_id", "po_id"), "Raw goods receipts."),
        "receiver_id STRING, po_id STRING, part_id STRING, received_date DATE, received_qty INT, "
        "warehouse_location STRING, quality_status STRING, inspector_id STRING, "
        "created_at TIMESTAMP_NTZ",
    ),
    "invoices": FeedSpec(
        "invoices",
        _bronze("bronze_invoices", ("invoice_id", "po_id"), "Raw supplier invoices."),
        "invoice_id STRING, po_id STRING, receiver_id STRING, supplier_id STRING, "
        "invoice_date DATE, invoice_amount DOUBLE, payment_status STRING, payment_date DATE, "
        "days_to_payment INT, created_at TIMESTAMP_NTZ",
    ),
    "work_orders": FeedSpec(
        "work_orders",
        _bronze("bronze_work_orders", ("wo_id", "customer_id"), "Raw field work orders."),
        "wo_id STRING, customer_id STRING, part_id STRING, technician_id STRING, "
        "created_date DATE, scheduled_date DATE, wo_type STRING, priority STRING, "
        "wo_status STRING, description STRING, region STRING, created_at TIMESTAMP_NTZ",
    ),
    "customer_quotes": FeedSpec(
        "customer_quotes",
        _bronze("bronze_customer_quotes", ("quote_id", "customer_id"), "Raw customer quotes."),
        "quote_id STRING, wo_id STRING, customer_id STRING, part_id STRING, quote_date DATE, "
        "parts_cost DOUBLE, labor_cost DOUBLE, total_amount DOUBLE, "
        "expected_completion_date DATE, availability_constraint STRING, "
        "labor_constraint STRING, quote_status STRING, created_at TIMESTAMP_NTZ",
    ),
    "labor_schedules": FeedSpec(
        "labor_schedules",
        _bronze("bronze_labor_schedules", ("technician_id", "schedule_date"), "Raw technician schedules."),
        "schedule_id STRING, technician_id STRING, technician_name STRING, schedule_date DATE, "
        "available_hours DOUBLE, booked_hours DOUBLE, region STRING, skill_level STRING, "
        "created_at TIMESTAMP_NTZ",
    ),
}

# Feeds whose landing folder is partitioned by load batch (``batch=N``).
BATCHED_FEEDS = ("parts_cdc", "customers_cdc")

# Which bronze table feeds which silver table.
SILVER_SOURCE: dict[str, str] = {
    "silver_parts": "parts_cdc",
    "silver_customers": "customers_cdc",
    "silver_demand_signals": "demand_signals",
    "silver_purchase_orders": "purchase_orders",
    "silver_receivers": "receivers",
    "silver_invoices": "invoices",
    "silver_work_orders": "work_orders",
    "silver_customer_quotes": "customer_quotes",
    "silver_labor_schedules": "labor_schedules",
}


def _silver(name, cluster, comment, *watch):
    return TableMeta(name, cluster, comment, {"quality": "silver", "layer": "transformation"}, watch)


def _gold(name, cluster, comment, **props):
    return TableMeta(name, cluster, comment, {"quality": "gold", **props})


TABLES: dict[str, TableMeta] = {
    "silver_parts": _silver("silver_parts", ("part_id",), "Cleaned parts change events.", ("part_id",)),
    "silver_customers": _silver("silver_customers", ("customer_id",), "Cleaned customer change events.", ("customer_id",)),
    "silver_demand_signals": _silver("silver_demand_signals", ("part_id", "forecast_date"), "Cleaned demand signals.", ("signal_id",)),
    "silver_purchase_orders": _silver("silver_purchase_orders", ("po_id", "part_id"), "Cleaned purchase orders."),
    "silver_receivers": _silver("silver_receivers", ("receiver_id", "po_id"), "Cleaned goods receipts.", ("po_id",)),
    "silver_invoices": _silver("silver_invoices", ("invoice_id", "po_id"), "Cleaned supplier invoices.", ("po_id",)),
    "silver_work_orders": _silver("silver_work_orders", ("wo_id", "customer_id"), "Cleaned field work orders."),
    "silver_customer_quotes": _silver("silver_customer_quotes", ("quote_id", "customer_id"), "Cleaned customer quotes.", ("wo_id",)),
    "silver_labor_schedules": _silver("silver_labor_schedules", ("technician_id", "schedule_date"), "Cleaned technician schedules.", ("technician_id", "schedule_date")),
    "dim_part_type1": _gold("dim_part_type1", ("part_id",), "Part dimension, current state.", layer="dimension", scd_type="1"),
    "dim_part_type2": _gold("dim_part_type2", ("part_id",), "Part dimension, full version history.", layer="dimension", scd_type="2"),
    "dim_customer_type1": _gold("dim_customer_type1", ("customer_id",), "Customer dimension, current state.", layer="dimension", scd_type="1"),
    "dim_customer_type2": _gold("dim_customer_type2", ("customer_id",), "Customer dimension, full version history.", layer="dimension", scd_type="2"),
    "fact_demand_fulfillment": _gold("fact_demand_fulfillment", ("part_id", "po_date"), "Demand to payment fact.", layer="fact"),
    "fact_work_order_completion": _gold("fact_work_order_completion", ("customer_id", "wo_id"), "Work order to quote fact.", layer="fact"),
}
