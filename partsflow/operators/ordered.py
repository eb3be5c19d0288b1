"""Ordered look-ups within a key, without one task per key.

``lead``/``lag``/running aggregates over ``Window.partitionBy(key)`` put every
row of a key into one task, so a key that holds a third of the data becomes a
single task.  The functions here give the same answers with bounded groups:

positions are split into buckets of ``2**s0`` consecutive values; inside a
bucket an ordinary window does the work; what a row needs from *earlier*
buckets is the running maximum of per-bucket totals, which is the same
problem one level up (buckets of buckets, ``2**(s1 - s0)`` ...).  After the
last shift the remaining bucket ids of a key span at most
``2**(64 - s_last)`` values, so the final per-key window is bounded too.
With the default shifts ``(21, 42)`` no window partition holds more than
2**21 (level windows) or 2**22 (final window) distinct positions -- a few
million rows, one task's worth -- whatever the skew.  Bucket summaries are much smaller than the
input, and every step is a plain window / partial aggregate / equi-join that
Spark distributes.

The bucketed plan is the caller's choice (``bucketed=True``); without it one
window per key is used, which is cheaper where no key holds more rows than a
task can sort.  Building either plan starts no job.

Contract: key columns are non-NULL; ``pos`` is a non-NULL BIGINT; rows should
be distinct on (keys, pos) -- a pile of equal positions would share a bucket
(callers de-duplicate first).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_SHIFTS = (21, 42)


def _frame(keys: Sequence[str], pos: str, inclusive: bool, extra: Sequence[str] = ()):
    w = Window.partitionBy(*keys, *extra).orderBy(F.col(pos))
    return w.rangeBetween(Window.unboundedPreceding, 0 if inclusive else -1)


def prefix_max(df: DataFrame, keys: Sequence[str], pos: str, value: str, out: str,
               inclusive: bool = True, shifts: Sequence[int] = DEFAULT_SHIFTS,
               bucketed: bool = False, _level: int = 0) -> DataFrame:
    """Add ``out`` = max(``value``) over rows of the same keys whose position
    is ``<= pos`` (``inclusive``) or ``< pos``.  NULL values are ignored; the
    result is NULL when no earlier row has a value."""
    keys = list(keys)
    if not bucketed:
        shifts = ()
    if not shifts:
        return df.withColumn(out, F.max(value).over(_frame(keys, pos, inclusive)))
    step = shifts[0]
    b, inner, total, carry = (f"__b{_level}", f"__in{_level}", f"__t{_level}", f"__c{_level}")
    d = (df.withColumn(b, F.shiftright(F.col(pos), step))
           .withColumn(inner, F.max(value).over(_frame(keys, pos, inclusive, [b]))))
    totals = d.groupBy(*keys, b).agg(F.max(value).alias(total))
    carried = prefix_max(totals, keys, b, total, carry, inclusive=False,
                         shifts=[s - step for s in shifts[1:]], bucketed=True, _level=_level + 1)
    d = d.join(carried.select(*keys, b, carry), [*keys, b], "left")
    return d.withColumn(out, F.greatest(F.col(inner), F.col(carry))).drop(b, inner, carry)


def next_position(df: DataFrame, keys: Sequence[str], pos: str, out: str,
                  shifts: Sequence[int] = DEFAULT_SHIFTS, bucketed: bool = False) -> DataFrame:
    """Add ``out`` = smallest ``pos`` of the same keys that is greater than
    this row's ``pos`` (NULL for the last row) -- ``lead(pos)`` for rows that
    are distinct on (keys, pos).  Computed as a prefix maximum on negated
    positions so that the bounded-group plan above applies."""
    neg = "__negpos"
    d = df.withColumn(neg, -F.col(pos))
    d = prefix_max(d, keys, neg, neg, out, inclusive=False, shifts=shifts, bucketed=bucketed)
    return d.withColumn(out, -F.col(out)).drop(neg)


def latest_at_or_before(points: DataFrame, marks: DataFrame, keys: Sequence[str],
                        point_pos: str, mark_pos: str, out: str,
                        shifts: Sequence[int] = DEFAULT_SHIFTS,
                        bucketed: bool = False) -> DataFrame:
    """For each distinct (keys, ``point_pos``) of ``points`` the greatest
    ``mark_pos`` of ``marks`` with the same keys and ``mark_pos <= point_pos``.

    Returns one row per distinct point: keys, ``point_pos``, ``out``.
    """
    keys = list(keys)
    p = points.select(*keys, F.col(point_pos).alias("__pos")).distinct() \
        .withColumn("__mark", F.lit(None).cast("bigint")).withColumn("__is_point", F.lit(True))
    m = marks.select(*keys, F.col(mark_pos).alias("__pos")).distinct() \
        .withColumn("__mark", F.col("__pos")).withColumn("__is_point", F.lit(False))
    u = prefix_max(p.unionByName(m), keys, "__pos", "__mark", out, inclusive=True, shifts=shifts,
                   bucketed=bucketed)
    return u.where("__is_point").select(*keys, F.col("__pos").alias(point_pos), out)


def running_max_before(df: DataFrame, keys: Sequence[str], pos: str, value: str, out: str,
                       shifts: Sequence[int] = DEFAULT_SHIFTS,
                       bucketed: bool = False) -> DataFrame:
    """Per (keys, pos): max(value) over strictly earlier positions of the key.

    Rows are first reduced to one per (keys, pos) (partial aggregation), so
    equal positions never pile up in one group.
    """
    keys = list(keys)
    per_pos = df.groupBy(*keys, pos).agg(F.max(value).alias("__v"))
    return prefix_max(per_pos, keys, pos, "__v", out, inclusive=False, shifts=shifts,
                      bucketed=bucketed).drop("__v")
