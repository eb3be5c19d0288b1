"""The two wide facts: chains of left equi-joins from one root table.

Join strategy:

* every join is an equi-join, so it plans as a hash or sort-merge join (never
  a nested loop);
* dimension sides (one row per key) use a plain left join: Spark broadcasts
  them only when its size check passes (``autoBroadcastJoinThreshold``
  statically, AQE's measured size at run time), else sort-merge joins; they come
  first, so the exchanges of a sort-merge join carry the root's rows and never the
  fan-out (the keys are the root's, so the order of the joins changes no row);
* the transactional sides (signals, receipts, invoices, quotes, schedules)
  use ``operators.joins.left_join`` with the hot keys that the stored table
  carries (``hot``: side -> keys and buckets): only those are spread over
  several tasks, and without any the join is plain; AQE's skew handling
  splits hot keys on the left side (e.g. the receipts of one purchase order
  feeding the invoice join), so the receipt x invoice product of one order
  is spread, not computed by one task;
* the two ``po_id`` joins are adjacent, so one exchange on ``po_id`` serves
  both when they sort-merge.

Columns of each side are prefixed before joining, so every reference is by
an unambiguous name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partsflow.operators.joins import left_join

col = F.col


def _prefixed(df: DataFrame, p: str) -> DataFrame:
    return df.select(*[col(c).alias(f"{p}__{c}") for c in df.columns])


def _dim_join(left: DataFrame, dim: DataFrame, left_key: str, dim_key: str) -> DataFrame:
    return left.join(dim, left[left_key] == dim[dim_key], "left")


def fact_demand_fulfillment(po: DataFrame, ds: DataFrame, r: DataFrame, inv: DataFrame,
                            dim_part: DataFrame, chunk: int | None = None,
                            hot: dict[str, DataFrame | None] | None = None) -> DataFrame:
    hot = hot or {}
    x = _dim_join(_prefixed(po, "po"), _prefixed(dim_part, "dp"), "po__part_id", "dp__part_id")
    x = left_join(x, _prefixed(ds, "ds"), [("po__signal_id", "ds__signal_id")], chunk, ["ds__signal_id"], hot.get("ds"))
    x = left_join(x, _prefixed(r, "r"), [("po__po_id", "r__po_id")], chunk, ["r__receiver_id"], hot.get("r"))
    x = left_join(x, _prefixed(inv, "inv"), [("po__po_id", "inv__po_id")], chunk, ["inv__invoice_id"], hot.get("inv"))
    return x.select(
        col("ds__signal_id").alias("signal_id"), col("po__po_id").alias("po_id"),
        col("r__receiver_id").alias("receiver_id"), col("inv__invoice_id").alias("invoice_id"),
        col("po__part_id").alias("part_id"), col("po__supplier_id").alias("supplier_id"),
        col("ds__forecast_date").alias("forecast_date"), col("ds__forecasted_qty").alias("forecasted_qty"),
        col("ds__actual_qty").alias("actual_qty"), col("ds__forecast_variance").alias("forecast_variance"),
        col("ds__signal_type").alias("signal_type"), col("ds__confidence_score").alias("confidence_score"),
        col("ds__region").alias("demand_region"),
        col("po__po_date").alias("po_date"), col("po__expected_receipt_date").alias("expected_receipt_date"),
        col("po__ordered_qty").alias("ordered_qty"), col("po__unit_price").alias("unit_price"),
        col("po__po_total_value").alias("po_total_value"), col("po__po_status").alias("po_status"),
        col("r__received_date").alias("received_date"), col("r__received_qty").alias("received_qty"),
        col("r__warehouse_location").alias("warehouse_location"), col("r__quality_status").alias("quality_status"),
        F.datediff(col("r__received_date"), col("po__expected_receipt_date")).alias("receipt_variance_days"),
        col("inv__invoice_date").alias("invoice_date"), col("inv__invoice_amount").alias("invoice_amount"),
        col("inv__payment_status").alias("payment_status"), col("inv__payment_date").alias("payment_date"),
        col("inv__days_to_payment").alias("days_to_payment"),
        col("dp__part_name").alias("part_name"), col("dp__category").alias("category"),
        col("dp__subcategory").alias("subcategory"), col("dp__lead_time_days").alias("lead_time_days"),
    )


def fact_work_order_completion(wo: DataFrame, q: DataFrame, ls: DataFrame, dim_part: DataFrame,
                               dim_customer: DataFrame, chunk: int | None = None,
                               hot: dict[str, DataFrame | None] | None = None) -> DataFrame:
    hot = hot or {}
    x = _dim_join(_prefixed(wo, "wo"), _prefixed(dim_part, "dp"), "wo__part_id", "dp__part_id")
    x = _dim_join(x, _prefixed(dim_customer, "dc"), "wo__customer_id", "dc__customer_id")
    x = left_join(x, _prefixed(q, "q"), [("wo__wo_id", "q__wo_id")], chunk, ["q__quote_id"], hot.get("q"))
    x = left_join(x, _prefixed(ls, "ls"), [("wo__technician_id", "ls__technician_id"),
                                           ("wo__scheduled_date", "ls__schedule_date")], chunk, ["ls__schedule_id"], hot.get("ls"))
    return x.select(
        col("wo__wo_id").alias("wo_id"), col("q__quote_id").alias("quote_id"),
        col("wo__customer_id").alias("customer_id"), col("wo__part_id").alias("part_id"),
        col("wo__technician_id").alias("technician_id"),
        col("wo__created_date").alias("created_date"), col("wo__scheduled_date").alias("scheduled_date"),
        col("wo__wo_type").alias("wo_type"), col("wo__priority").alias("priority"),
        col("wo__wo_status").alias("wo_status"), col("wo__region").alias("region"),
        col("q__quote_date").alias("quote_date"), col("q__parts_cost").alias("parts_cost"),
        col("q__labor_cost").alias("labor_cost"), col("q__total_amount").alias("total_amount"),
        col("q__expected_completion_date").alias("expected_completion_date"),
        col("q__days_to_completion").alias("days_to_completion"), col("q__quote_status").alias("quote_status"),
        col("q__availability_constraint").alias("availability_constraint"),
        col("q__labor_constraint").alias("labor_constraint"),
        col("ls__available_hours").alias("available_hours"), col("ls__booked_hours").alias("booked_hours"),
        col("ls__remaining_hours").alias("remaining_hours"), col("ls__skill_level").alias("skill_level"),
        col("dp__part_name").alias("part_name"), col("dp__category").alias("category"),
        col("dp__piece_part_price").alias("current_piece_part_price"),
        col("dp__lead_time_days").alias("lead_time_days"),
        col("dc__customer_name").alias("customer_name"), col("dc__customer_tier").alias("customer_tier"),
        col("dc__region").alias("customer_region"), col("dc__annual_revenue").alias("annual_revenue"),
    )
