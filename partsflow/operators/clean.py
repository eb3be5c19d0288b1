"""Row-validity filter + typed projection.

``clean`` is the whole silver-layer operator: one ``filter`` followed by one
``select``.  Both are stateless and narrow, so the same call works on a batch
DataFrame and on a streaming one, pushes the predicate into the Parquet scan
and never shuffles.

Order matters and is kept: the predicate sees the *raw* values (a lower-case
``'rejected'`` passes ``<> 'REJECTED'`` and is upper-cased afterwards) and
derived columns are computed from raw inputs in the same ``select`` (one
rounding at the end).  A NULL operand makes the predicate NULL and drops the
row (three-valued logic), exactly like SQL ``WHERE``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame


@dataclass(frozen=True)
class CleanSpec:
    name: str
    predicate: Column
    columns: Sequence[Column]
    raw: str | None = None  # what ``predicate`` implies for the columns as they lie in the files


def validity_filter(df: DataFrame, predicate: Column) -> DataFrame:
    """Keep rows where ``predicate`` is TRUE (NULL and FALSE are dropped)."""
    return df.filter(predicate)


def clean(df: DataFrame, spec: CleanSpec) -> DataFrame:
    """Filter on raw values, then project to the declared output columns."""
    return df.filter(spec.predicate).select(*spec.columns)
