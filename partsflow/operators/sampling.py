"""Sampling operators: exact-size draws with replacement, k rows without.

``dense_index`` numbers the rows 0..n-1 in the order of given columns without
a single-task window: ``orderBy`` range-partitions and sorts, each row's
position inside its partition comes from ``monotonically_increasing_id`` and
the partition offsets from a per-partition count -- a table with one row per
partition, so its broadcast is bounded by the partition count.  The numbered
rows are checkpointed (reliable checkpoint in ``spark.checkpoint.dir``)
before the offsets are computed, so both uses see one materialisation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partsflow.session import shared_root

HISTOGRAM_BITS = 16
_POS_BITS = 33  # monotonically_increasing_id = partition_id << 33 | row position


def dense_index(df: DataFrame, order_by: Sequence[str], out: str = "__idx") -> DataFrame:
    """Add ``out`` = 0-based rank of the row in ``order_by`` order (ties in
    arbitrary but fixed order)."""
    shared_root(df.sparkSession)  # checkpoint folder from the session (set only if unset)
    s = (df.orderBy(*order_by)
         .withColumn("__pid", F.spark_partition_id())
         .withColumn("__pos", F.monotonically_increasing_id()
                     - F.shiftleft(F.spark_partition_id().cast("bigint"), _POS_BITS))).checkpoint(eager=True)
    counts = s.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.withColumn(
        "__off", F.coalesce(F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)),
                            F.lit(0)))
    return (s.join(F.broadcast(offsets.select("__pid", "__off")), "__pid")  # one row per partition
            .withColumn(out, F.col("__off") + F.col("__pos")).drop("__pid", "__pos", "__off"))


def seeded_number(key: Column, seed: int) -> Column:
    """60 pseudo-random bits of ``key``: the first 15 hexadecimal digits of
    md5('seed:key'), which any SQL engine can compute."""
    text = F.concat(F.lit(f"{seed}:"), key.cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def seeded_number_sql(key: str, seed: int) -> str:
    """``seeded_number`` as DuckDB SQL."""
    return f"CAST('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 15) AS BIGINT)"


def draw_index(draw: Column, population: Column, seed: int) -> Column:
    """Index in [0, population) for draw number ``draw``: independent of the
    other draws, so indexes repeat as in drawing with replacement; NULL for an
    empty population (ANSI mode would raise on a zero modulus)."""
    return F.when(population > F.lit(0), F.pmod(seeded_number(draw, seed), population))


def sample_with_replacement(population: DataFrame, n: int, order_by: Sequence[str], seed: int,
                            draw_col: str = "draw") -> DataFrame:
    """Exactly ``n`` rows drawn uniformly with replacement from ``population``
    (unlike ``DataFrame.sample``, whose size is only expected)."""
    spark = population.sparkSession
    indexed = dense_index(population, order_by, "__idx")
    size = population.select(F.count(F.lit(1))).scalar()
    draws = spark.range(n).select(F.col("id").alias(draw_col), draw_index(F.col("id"), size, seed).alias("__idx"))
    return draws.join(indexed, "__idx").drop("__idx")


def sample_without_replacement(df: DataFrame, k: int, key: Column, seed: int) -> DataFrame:
    """``k`` distinct rows (all, if fewer): the first ``k`` in a seeded order of ``key``
    (ties by the key itself), by threshold selection.

    A histogram of the leading bits of the seeded number (2**HISTOGRAM_BITS counts, the
    only thing that reaches the driver) tells the bucket in which the k-th row lies.
    Rows up to that bucket, about ``k`` and a bucket's rows, are kept; only the bucket
    itself is ordered.  The population is read twice and never sorted or stored."""
    shared_root(df.sparkSession)
    bucket = F.shiftright("__o", 60 - HISTOGRAM_BITS)
    drawn = df.withColumn("__o", seeded_number(key, seed)).withColumn("__k", key)
    counts = sorted(tuple(r) for r in drawn.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect())
    before, edge = 0, None
    for b, n in counts:
        if before + n > k:
            edge = b
            break
        before += n
    if edge is None:
        return df
    near = drawn.where(bucket <= edge).checkpoint(eager=True)
    last = near.where(bucket == edge).orderBy("__o", "__k").limit(k - before)
    return near.where(bucket < edge).unionByName(last).drop("__o", "__k")
