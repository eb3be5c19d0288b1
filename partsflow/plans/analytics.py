"""Consumer queries over the dimensions and facts.

Point look-ups from the documentation (``WHERE part_id = ...``) are the
``ids`` argument; without it the query covers every key.  Filters on the key
reach the Parquet scan of a written dimension, whose files are clustered on
that key, so row-group statistics skip most of the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partsflow.operators.cdc import END_AT, START_AT, CdcSpec, as_of, collapse_events
from partsflow.operators.ordered import running_max_before
from partsflow.plans import values as V
from partsflow.plans.feeds import completion_delay

col = F.col


def _only(df: DataFrame, key: str, ids: Sequence[str] | None) -> DataFrame:
    return df.where(col(key).isin(*ids)) if ids else df


def part_current(dim1: DataFrame, ids: Sequence[str] | None = None) -> DataFrame:
    """Q1: current value per part (type 1)."""
    return _only(dim1, "part_id", ids).select("part_id", "part_name", "piece_part_price")


def part_history(dim2: DataFrame, ids: Sequence[str] | None = None) -> DataFrame:
    """Q2: full version history, ordered by version start."""
    return (_only(dim2, "part_id", ids)
            .select("part_id", "part_name", "piece_part_price", START_AT, END_AT)
            .orderBy("part_id", START_AT))


def customer_current(dim2: DataFrame) -> DataFrame:
    """Q3: open type-2 rows."""
    return (dim2.where(col(END_AT).isNull())
            .select("customer_id", "customer_name", "customer_tier", START_AT)
            .orderBy("customer_id"))


def customer_tier_journey(dim2: DataFrame, n: int = 20) -> DataFrame:
    """Q4: the first ``n`` open customer versions (top-n by customer id;
    per-task top-n then a merge, no global sort)."""
    return (dim2.where(col(END_AT).isNull())
            .select("customer_id", "customer_name", "customer_tier", "address", START_AT, END_AT)
            .orderBy("customer_id").limit(n))


def part_price_asof(dim2: DataFrame) -> DataFrame:
    """Q5: time-travel pricing.  For every version, the price that was valid
    just before it started (NULL for a first version or after a delete)."""
    probes = dim2.select("part_id", col(START_AT).alias("changed_at"),
                         col("piece_part_price").alias("new_price"),
                         (col(START_AT) - F.lit(1)).alias("__before"))
    out = as_of(probes, dim2, ["part_id"], "__before", ["piece_part_price"], prefix="previous_")
    return out.select("part_id", "changed_at", "new_price", col("previous_piece_part_price").alias("previous_price"))


def scd_compare(dim1: DataFrame, dim2: DataFrame) -> DataFrame:
    """Q6: versions per part next to the type-1 value (partial aggregation)."""
    hist = dim2.groupBy("part_id").agg(
        F.count(F.lit(1)).alias("n_versions"),
        F.count(F.when(col(END_AT).isNull(), F.lit(1))).alias("n_open"),
        F.max(F.when(col(END_AT).isNull(), col("piece_part_price"))).alias("open_price"))
    cur = dim1.select("part_id", col("piece_part_price").alias("type1_price"))
    return hist.join(cur, "part_id", "left").select("part_id", "n_versions", "n_open", "type1_price", "open_price")


def scd_deletes(silver_parts: DataFrame, dim2: DataFrame, spec: CdcSpec) -> DataFrame:
    """Delete events with the version each one closed (NULL when the key was
    unknown or already deleted)."""
    dels = collapse_events(silver_parts, spec).where(col("__del")).select("part_id", "_sequence")
    v = dim2.select(col("part_id").alias("__k"), col(END_AT).alias("__end"),
                    col(START_AT).alias("closed_version_start"), col("piece_part_price").alias("last_price"))
    return (dels.join(v, (dels["part_id"] == v["__k"]) & (dels["_sequence"] == v["__end"]), "left")
            .select("part_id", col("_sequence").alias("deleted_at"), "closed_version_start", "last_price"))


def late_events(events: DataFrame, keys: Sequence[str], seq: str = "_sequence", batch: str = "batch",
                extra: Sequence[str] = ("_op",)) -> DataFrame:
    """Events that arrived in a later load batch than an event of the same key
    with a higher sequence (out-of-order arrivals)."""
    keys = list(keys)
    ev = events.where(col(seq).isNotNull())
    prior = running_max_before(ev.select(*keys, batch, seq), keys, batch, seq, "max_prior_sequence")
    return (ev.select(*keys, seq, *extra, batch)
            .join(prior, [*keys, batch], "inner")
            .where(col("max_prior_sequence") > col(seq))
            .select(*keys, seq, *extra, batch, "max_prior_sequence"))


def completion_rule(quotes: DataFrame, dim_part: DataFrame) -> DataFrame:
    """Completion-date rule check: the binding constraint (parts lead time or
    labor availability) plus 1..4 days of slack bounds the completion date."""
    parts = dim_part.select(col("part_id").alias("__pid"), col("lead_time_days").alias("__lead"))
    q = quotes.join(parts, quotes["part_id"] == parts["__pid"], "left")
    lead = F.coalesce(col("__lead").cast("bigint"), F.lit(V.UNKNOWN_LEAD_DAYS).cast("bigint"))
    parts_delay = completion_delay(col("availability_constraint"), F.lit(None), lead)
    delay = completion_delay(col("availability_constraint"), col("labor_constraint"), lead)
    earliest = F.date_add(col("quote_date"), (delay + F.lit(V.SLACK_DAYS[0])).cast("int"))
    latest = F.date_add(col("quote_date"), (delay + F.lit(V.SLACK_DAYS[1])).cast("int"))
    return q.select(
        "quote_id", "wo_id", "availability_constraint", "labor_constraint",
        F.when(parts_delay >= delay, F.lit("PARTS")).otherwise(F.lit("LABOR")).alias("binding_constraint"),
        earliest.alias("earliest_completion_date"), latest.alias("latest_completion_date"),
        "expected_completion_date",
        col("expected_completion_date").between(earliest, latest).alias("within_rule"),
    )
