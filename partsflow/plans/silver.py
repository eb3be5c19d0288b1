"""Silver specifications: validity predicate + output columns per table."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import lru_cache

from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType

from partsflow.functions.scalar import default, to_decimal, trimmed, upper_trimmed
from partsflow.operators.clean import CleanSpec

col = F.col

CDC_OPS = ("INSERT", "UPDATE", "DELETE")


@lru_cache(maxsize=1)
def _build() -> dict[str, CleanSpec]:
    # Column expressions need an active SparkContext, so they are built on
    # first use rather than at import.
    return {
        "silver_parts": CleanSpec(
            "silver_parts",
            col("part_id").isNotNull() & (col("piece_part_price") >= 0) & col("_op").isin(*CDC_OPS),
            [
                col("part_id"),
                col("part_number"),
                trimmed("part_name").alias("part_name"),
                upper_trimmed("category").alias("category"),
                upper_trimmed("subcategory").alias("subcategory"),
                to_decimal("piece_part_price", 12, 2).alias("piece_part_price"),
                to_decimal("standard_cost", 12, 2).alias("standard_cost"),
                col("lead_time_days").cast(IntegerType()).alias("lead_time_days"),
                col("supplier_id"),
                default("unit_of_measure", "EA").alias("unit_of_measure"),
                default("is_active", True).alias("is_active"),
                col("_op"),
                col("_sequence"),
                col("updated_at"),
            ],
        ),
        "silver_customers": CleanSpec(
            "silver_customers",
            col("customer_id").isNotNull() & col("_op").isin(*CDC_OPS),
            [
                col("customer_id"),
                trimmed("customer_name").alias("customer_name"),
                trimmed("address").alias("address"),
                trimmed("city").alias("city"),
                upper_trimmed("state").alias("state"),
                trimmed("zip").alias("zip"),
                upper_trimmed("customer_tier").alias("customer_tier"),
                trimmed("account_manager").alias("account_manager"),
                upper_trimmed("region").alias("region"),
                to_decimal("annual_revenue", 14, 2).alias("annual_revenue"),
                default("is_active", True).alias("is_active"),
                col("_op"),
                col("_sequence"),
                col("updated_at"),
            ],
        ),
        "silver_demand_signals": CleanSpec(
            "silver_demand_signals",
            col("signal_id").isNotNull() & col("part_id").isNotNull() & (col("forecasted_qty") > 0),
            [
                col("signal_id"),
                col("part_id"),
                col("forecast_date").cast(DateType()).alias("forecast_date"),
                col("forecasted_qty").cast(IntegerType()).alias("forecasted_qty"),
                col("actual_qty").cast(IntegerType()).alias("actual_qty"),
                (col("actual_qty") - col("forecasted_qty")).cast(IntegerType()).alias("forecast_variance"),
                col("signal_type"),
                to_decimal("confidence_score", 5, 4).alias("confidence_score"),
                col("region"),
                col("created_at"),
            ],
            raw="forecasted_qty > 0",
        ),
        "silver_purchase_orders": CleanSpec(
            "silver_purchase_orders",
            col("po_id").isNotNull() & col("part_id").isNotNull() & (col("ordered_qty") > 0),
            [
                col("po_id"),
                col("signal_id"),
                col("part_id"),
                col("supplier_id"),
                col("po_date").cast(DateType()).alias("po_date"),
                col("expected_receipt_date").cast(DateType()).alias("expected_receipt_date"),
                col("ordered_qty").cast(IntegerType()).alias("ordered_qty"),
                to_decimal("unit_price", 12, 2).alias("unit_price"),
                to_decimal(col("ordered_qty") * col("unit_price"), 14, 2).alias("po_total_value"),
                F.upper("po_status").alias("po_status"),
                col("buyer_id"),
                col("created_at"),
            ],
            raw="ordered_qty > 0",
        ),
        "silver_receivers": CleanSpec(
            "silver_receivers",
            col("receiver_id").isNotNull() & col("po_id").isNotNull() & (col("received_qty") > 0)
            & (col("quality_status") != "REJECTED"),
            [
                col("receiver_id"),
                col("po_id"),
                col("part_id"),
                col("received_date").cast(DateType()).alias("received_date"),
                col("received_qty").cast(IntegerType()).alias("received_qty"),
                col("warehouse_location"),
                F.upper("quality_status").alias("quality_status"),
                col("inspector_id"),
                col("created_at"),
            ],
            raw="received_qty > 0",
        ),
        "silver_invoices": CleanSpec(
            "silver_invoices",
            col("invoice_id").isNotNull() & col("po_id").isNotNull() & (col("invoice_amount") > 0),
            [
                col("invoice_id"),
                col("po_id"),
                col("receiver_id"),
                col("supplier_id"),
                col("invoice_date").cast(DateType()).alias("invoice_date"),
                to_decimal("invoice_amount", 14, 2).alias("invoice_amount"),
                F.upper("payment_status").alias("payment_status"),
                col("payment_date").cast(DateType()).alias("payment_date"),
                col("days_to_payment").cast(IntegerType()).alias("days_to_payment"),
                col("created_at"),
            ],
        ),
        "silver_work_orders": CleanSpec(
            "silver_work_orders",
            col("wo_id").isNotNull() & col("customer_id").isNotNull(),
            [
                col("wo_id"),
                col("customer_id"),
                col("part_id"),
                col("technician_id"),
                col("created_date").cast(DateType()).alias("created_date"),
                col("scheduled_date").cast(DateType()).alias("scheduled_date"),
                col("wo_type"),
                F.upper("priority").alias("priority"),
                F.upper("wo_status").alias("wo_status"),
                col("description"),
                col("region"),
                col("created_at"),
            ],
        ),
        "silver_customer_quotes": CleanSpec(
            "silver_customer_quotes",
            col("quote_id").isNotNull() & col("wo_id").isNotNull() & (col("total_amount") > 0),
            [
                col("quote_id"),
                col("wo_id"),
                col("customer_id"),
                col("part_id"),
                col("quote_date").cast(DateType()).alias("quote_date"),
                to_decimal("parts_cost", 12, 2).alias("parts_cost"),
                to_decimal("labor_cost", 12, 2).alias("labor_cost"),
                to_decimal("total_amount", 14, 2).alias("total_amount"),
                col("expected_completion_date").cast(DateType()).alias("expected_completion_date"),
                col("availability_constraint"),
                col("labor_constraint"),
                F.upper("quote_status").alias("quote_status"),
                F.datediff(col("expected_completion_date"), col("quote_date")).alias("days_to_completion"),
                col("created_at"),
            ],
        ),
        "silver_labor_schedules": CleanSpec(
            "silver_labor_schedules",
            col("schedule_id").isNotNull() & col("technician_id").isNotNull() & (col("available_hours") >= 0),
            [
                col("schedule_id"),
                col("technician_id"),
                trimmed("technician_name").alias("technician_name"),
                col("schedule_date").cast(DateType()).alias("schedule_date"),
                to_decimal("available_hours", 5, 2).alias("available_hours"),
                to_decimal("booked_hours", 5, 2).alias("booked_hours"),
                to_decimal(col("available_hours") - col("booked_hours"), 5, 2).alias("remaining_hours"),
                F.upper("region").alias("region"),
                col("skill_level"),
                col("created_at"),
            ],
        ),
    }


SILVER_NAMES = ("silver_parts", "silver_customers", "silver_demand_signals", "silver_purchase_orders",
                "silver_receivers", "silver_invoices", "silver_work_orders", "silver_customer_quotes",
                "silver_labor_schedules")


class _Specs(Mapping):
    """Read-only mapping name -> CleanSpec, built lazily."""

    def __getitem__(self, name: str) -> CleanSpec:
        return _build()[name]

    def __iter__(self) -> Iterator[str]:
        return iter(SILVER_NAMES)

    def __len__(self) -> int:
        return len(SILVER_NAMES)


SILVER: Mapping[str, CleanSpec] = _Specs()
