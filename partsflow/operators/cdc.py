"""Change-data-capture apply: slowly changing dimensions of type 1 and 2.

Input: a DataFrame of change events -- key columns, a sequence column (later
event = larger number), an operation column and the payload.  Output:

* ``scd1``  -- one row per live key holding the payload of its latest event;
  keys whose latest event is a delete are absent.
* ``scd2``  -- one row per non-delete event: ``__START_AT`` = its sequence,
  ``__END_AT`` = the next sequence of the same key (any event, deletes
  included) or NULL for the open version.

Both are pure functions of the *set* of events, so late, duplicated or
re-ordered arrivals give the same result as an in-order replay (recomputing
is what makes incremental application idempotent, see ``streaming.cdc``).

Rules for unspecified cases (kept identical in both types, so that the open
type-2 rows always equal the type-1 rows):

* events with a NULL sequence are ignored;
* several events with the same key and sequence count as one: a delete wins,
  then the greatest tie-break columns (``updated_at``), then the greatest
  payload;
* a delete of an unknown or already deleted key only closes what is open;
* an update of an unknown key creates the key (upsert).

Scale: type 1 keeps one row per key and task before its shuffle.  Type 2 needs
one exchange by key: the events of a key are sorted once and both windows read
that order.  Keys known to hold more events than a task should sort (``hot``, from the
sketch beside the stored table) take ``ordered.next_position`` instead, whose groups
are bounded; ``bucketed=True`` sends every key that way.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partsflow.operators.ordered import DEFAULT_SHIFTS, latest_at_or_before, next_position

START_AT = "__START_AT"
END_AT = "__END_AT"


@dataclass(frozen=True)
class CdcSpec:
    keys: Sequence[str]
    sequence_by: str = "_sequence"
    apply_as_deletes: str = "_op = 'DELETE'"
    except_columns: Sequence[str] = ("_op", "_sequence")
    tie_break: Sequence[str] = ()  # columns whose greatest value wins among equal (keys, sequence)
    shifts: Sequence[int] = field(default=DEFAULT_SHIFTS)
    bucketed: bool = False  # True: bounded ordered look-ups, for keys with more events than a task can sort

    def is_delete(self) -> Column:
        return F.coalesce(F.expr(self.apply_as_deletes), F.lit(False))


def _payload(df: DataFrame, spec: CdcSpec) -> list[str]:
    return [c for c in df.columns if c not in spec.keys and c != spec.sequence_by]


def _winner_first(df: DataFrame, spec: CdcSpec) -> Column:
    """Descending order whose first event of a (keys, sequence) wins (see module rules)."""
    parts = [F.col("__del"), *[F.col(c).alias(f"__tb{i}") for i, c in enumerate(spec.tie_break)],
             *[F.col(c) for c in _payload(df, spec)]]
    return F.struct(*parts).desc()


def _sequenced(df: DataFrame, spec: CdcSpec) -> DataFrame:
    return df.where(F.col(spec.sequence_by).isNotNull()).withColumn("__del", spec.is_delete())


def _output_columns(df: DataFrame, spec: CdcSpec) -> list[str]:
    return [c for c in df.columns if c not in spec.except_columns]


def collapse_events(df: DataFrame, spec: CdcSpec) -> DataFrame:
    """One event per (keys, sequence), NULL sequences dropped; adds ``__del``."""
    w = Window.partitionBy(*spec.keys, spec.sequence_by).orderBy(_winner_first(df, spec))
    return (_sequenced(df, spec).withColumn("__n", F.row_number().over(w)).where(F.col("__n") == 1).drop("__n"))


def scd1_state(df: DataFrame, spec: CdcSpec) -> DataFrame:
    """Latest event per key, deletes kept as tombstones (``__del``).

    This is the stored form of a type-1 dimension: when every key of a
    storage bucket is deleted the bucket still has rows, so an overwrite of
    that bucket removes the old state.  Spark keeps the first row of each key
    in every task before the shuffle (window group limit), so a hot key sends
    one row a task.
    """
    w = Window.partitionBy(*spec.keys).orderBy(F.col(spec.sequence_by).desc(), _winner_first(df, spec))
    return (_sequenced(df, spec).withColumn("__n", F.row_number().over(w)).where(F.col("__n") == 1).drop("__n"))


def scd1(df: DataFrame, spec: CdcSpec) -> DataFrame:
    """Current state per key (type 1)."""
    return scd1_state(df, spec).where(~F.col("__del")).select(*_output_columns(df, spec))


def _scd2_bounded(df: DataFrame, spec: CdcSpec) -> DataFrame:
    return next_position(collapse_events(df, spec), spec.keys, spec.sequence_by, END_AT, shifts=spec.shifts, bucketed=True)


def _scd2_by_key(df: DataFrame, spec: CdcSpec) -> DataFrame:
    # One exchange by key serves both windows, and the sort of the first,
    # by (keys, sequence, winner), is an order that the second can use.
    by_key = df.repartition(*[F.col(k) for k in spec.keys])
    w = Window.partitionBy(*spec.keys).orderBy(spec.sequence_by)
    return collapse_events(by_key, spec).withColumn(END_AT, F.lead(spec.sequence_by).over(w))


def scd2_state(df: DataFrame, spec: CdcSpec, hot: DataFrame | None = None) -> DataFrame:
    """Every collapsed event with ``__START_AT``/``__END_AT`` and ``__del``
    (delete events kept as markers; see ``scd1_state`` for why).

    ``hot``: keys (__hk0.., a bounded number of rows) whose events no task should
    sort alone."""
    if spec.bucketed:
        ev = _scd2_bounded(df, spec)
    elif hot is None:
        ev = _scd2_by_key(df, spec)
    else:
        same = [df[k].eqNullSafe(hot[f"__hk{i}"]) for i, k in enumerate(spec.keys)]
        rest, large = (df.join(F.broadcast(hot), same, kind) for kind in ("left_anti", "left_semi"))
        by_key, bounded = _scd2_by_key(rest, spec), _scd2_bounded(large, spec)
        ev = by_key.unionByName(bounded)
    return ev.withColumn(START_AT, F.col(spec.sequence_by))


def scd2(df: DataFrame, spec: CdcSpec, hot: DataFrame | None = None) -> DataFrame:
    """Full version history per key (type 2)."""
    return (scd2_state(df, spec, hot).where(~F.col("__del"))
            .select(*_output_columns(df, spec), START_AT, END_AT))


def dim_columns(source_columns: Sequence[str], spec: CdcSpec, scd_type: int) -> list[str]:
    """Output columns of a dimension built from events with ``source_columns``."""
    cols = [c for c in source_columns if c not in spec.except_columns]
    return cols + ([START_AT, END_AT] if scd_type == 2 else [])


def as_of(probes: DataFrame, versions: DataFrame, keys: Sequence[str], at: str,
          columns: Sequence[str], prefix: str = "", shifts: Sequence[int] = DEFAULT_SHIFTS,
          bucketed: bool = False) -> DataFrame:
    """Left as-of join: attach to every probe row the type-2 version of its key
    valid at sequence ``at`` (``__START_AT <= at < __END_AT``, open end = now).

    No range join: the version start is found with a bounded ordered look-up
    on the distinct probe points, then both sides are joined on equality.
    Probe rows without a valid version get NULLs.
    """
    keys = list(keys)
    found = latest_at_or_before(probes.select(*keys, at), versions, keys, at, START_AT, "__vstart",
                                shifts=shifts, bucketed=bucketed)
    picked = [F.col(f"__v.{c}").alias(prefix + c) for c in columns]
    v = versions.alias("__v")
    matched = (found.alias("__f")
               .join(v, [F.col(f"__f.{k}") == F.col(f"__v.{k}") for k in keys]
                     + [F.col("__f.__vstart") == F.col(f"__v.{START_AT}")], "inner")
               .where(F.col(f"__v.{END_AT}").isNull() | (F.col(f"__f.{at}") < F.col(f"__v.{END_AT}")))
               .select(*[F.col(f"__f.{k}").alias(f"__k{i}") for i, k in enumerate(keys)],
                       F.col(f"__f.{at}").alias("__at"), *picked))
    cond = [probes[k] == matched[f"__k{i}"] for i, k in enumerate(keys)] + [probes[at] == matched["__at"]]
    out = probes.join(matched, cond, "left")
    return out.drop(*[f"__k{i}" for i in range(len(keys))], "__at")
