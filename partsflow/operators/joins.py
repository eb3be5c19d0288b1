"""Left outer equi-join that stays balanced when one right-side key is huge.

For ``left LEFT JOIN right`` Spark's adaptive skew handling may split only
the *left* side of a skewed partition.  When the hot key is on the right
(one purchase order with a third of all receipts) its rows would all reach
one task.  ``left_join`` avoids that exactly:

1. ``hot`` = right keys with many rows and the number of salt buckets of each,
   either given (``hot_keys.HotKeys.buckets``: from the sketch stored beside the
   table, no job) or counted: keys with more than ``chunk`` rows, a partially
   aggregated count.  Either bounds the number of keys (``KEPT``;
   ``rows(right) / chunk``), which makes the explicit broadcast of ``hot`` safe.
2. right rows of a hot key get salt ``pmod(xxhash64(row), buckets)``; other
   rows salt 0.
3. left rows of a hot key are repeated once per bucket; other rows once.
4. equi-join on (key, salt), left outer; a hot key always has matches, so
   the NULL-extended rows produced for its empty buckets are dropped.

The result equals the plain left join row for row.  Without a hot key (none given,
``chunk=None``) it is the plain left join, and two joins on one key share an exchange.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partsflow.session import shared_root

DEFAULT_CHUNK = 1 << 22  # rows of one right key handled by one task


def left_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]],
              chunk: int | None = DEFAULT_CHUNK, spread_by: Sequence[str] | None = None,
              hot: DataFrame | None = None) -> DataFrame:
    """``left LEFT JOIN right ON left.l = right.r [AND ...]`` for ``on`` =
    [(l, r), ...]; column names of the two sides must be distinct.

    ``spread_by``: right columns hashed to pick a hot row's bucket (default:
    all right columns; name a row id to keep column pruning effective).
    ``hot``: hot right keys (__hk0.., __buckets), each with a row in ``right``.
    """
    if chunk is None and hot is None:
        return left.join(right, reduce(lambda a, b: a & b, [left[lc] == right[rc] for lc, rc in on]), "left")
    lk = [lc for lc, _ in on]
    rk = [rc for _, rc in on]
    hot = F.broadcast(_counted(right, rk, chunk) if hot is None else hot)

    def flag(df: DataFrame, keys: list[str]) -> DataFrame:
        cond = reduce(lambda a, b: a & b, [df[k] == hot[f"__hk{i}"] for i, k in enumerate(keys)])
        return df.join(hot, cond, "left").drop(*[f"__hk{i}" for i in range(len(keys))])

    r = flag(right, rk)
    r = r.withColumn("__rsalt", F.when(F.col("__buckets").isNull(), F.lit(0))
                     .otherwise(F.pmod(F.xxhash64(*[F.col(c) for c in (spread_by or right.columns)]),
                                       F.col("__buckets")))
                     .cast("int")).drop("__buckets")
    lft = flag(left, lk)
    lft = lft.withColumn("__lsalt", F.explode(
        F.when(F.col("__buckets").isNull(), F.array(F.lit(0)))
        .otherwise(F.sequence(F.lit(0), F.col("__buckets") - F.lit(1)))))
    cond = reduce(lambda a, b: a & b, [lft[lc] == r[rc] for lc, rc in on]) & (lft["__lsalt"] == r["__rsalt"])
    out = lft.join(r, cond, "left")
    out = out.where(F.col("__buckets").isNull() | F.col("__rsalt").isNotNull())
    return out.drop("__buckets", "__lsalt", "__rsalt")


def _counted(right: DataFrame, keys: list[str], chunk: int) -> DataFrame:
    """Keys with more than ``chunk`` rows, by a job.  Small and bounded: materialised once
    (reliable checkpoint in the shared checkpoint folder) so both sides use one result."""
    shared_root(right.sparkSession)
    return (right.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in keys]))
            .groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
            .where(F.col("__n") > F.lit(chunk))
            .select(*[F.col(c).alias(f"__hk{i}") for i, c in enumerate(keys)],
                    F.ceil(F.col("__n") / F.lit(chunk)).cast("int").alias("__buckets"))).checkpoint(eager=True)
