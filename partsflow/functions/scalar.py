"""Column-expression helpers.

All helpers return ``Column`` expressions built from ``pyspark.sql.functions``
only, so they stay inside whole-stage codegen (no Python UDF anywhere).
The integer helpers are used by the feed builders: every derived value is a
deterministic function of a row's own integer keys, so any engine that does
exact 64-bit integer arithmetic computes the same feed.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --------------------------------------------------------------------------
# Normalisation (silver layer)
# --------------------------------------------------------------------------
def trimmed(x: str | Column) -> Column:
    """Strip ASCII spaces on both ends (tabs stay, like SQL TRIM)."""
    return F.trim(c(x))


def upper_trimmed(x: str | Column) -> Column:
    return F.upper(F.trim(c(x)))


def to_decimal(x: str | Column, precision: int, scale: int) -> Column:
    """Cast to DECIMAL(p,s): HALF_UP on the decimal text of a double."""
    return c(x).cast(DecimalType(precision, scale))


def default(x: str | Column, value: Any) -> Column:
    return F.coalesce(c(x), F.lit(value))


# --------------------------------------------------------------------------
# Integer arithmetic used to derive feeds
# --------------------------------------------------------------------------
def mix(x: str | Column, a: int, b: int, m: int | Column) -> Column:
    """``pmod(x * a + b, m)``: a cheap, engine-independent spread of a key."""
    m_col = m if isinstance(m, Column) else F.lit(m)
    return F.pmod(c(x) * F.lit(a) + F.lit(b), m_col)


def idiv(x: str | Column, d: int) -> Column:
    """Integer division of a non-negative BIGINT (exact below 2**53)."""
    return F.floor(c(x) / F.lit(d)).cast("bigint")


def pick(bucket: Column, table: Sequence[tuple[int, Any]], last: Any) -> Column:
    """Weighted choice: first value whose upper bound exceeds ``bucket``."""
    expr = None
    for bound, value in table:
        cond = bucket < F.lit(bound)
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    return expr.otherwise(F.lit(last))


def element(values: Sequence[Any], idx: Column) -> Column:
    """0-based lookup into a fixed list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx.cast("int") + F.lit(1))


def cents(x: str | Column) -> Column:
    """Money value (2 decimals, DOUBLE) → exact BIGINT cents."""
    return F.round(c(x) * F.lit(100.0)).cast("bigint")


def from_cents(x: Column) -> Column:
    """BIGINT cents → DOUBLE money; the nearest double to the 2-dp value."""
    return x.cast("double") / F.lit(100.0)


def scale_half_up(x: Column, percent: int | Column) -> Column:
    """Non-negative ``x * percent / 100`` rounded half up, in integers."""
    p = percent if isinstance(percent, Column) else F.lit(percent)
    return idiv(x * p + F.lit(50), 100)


def days_before(day: str, n: Column) -> Column:
    return F.date_sub(F.lit(day).cast("date"), n.cast("int"))


def ts_ntz(x: Column) -> Column:
    return x.cast("timestamp_ntz")


def zpad(x: str | Column, width: int) -> Column:
    """``%0{width}d`` of a non-negative integer without ``String.format``:
    zero-padded to ``width`` digits, longer numbers printed in full."""
    v = c(x)
    s = v.cast("string")
    return F.when(v < F.lit(10 ** width), F.lpad(s, width, "0")).otherwise(s)


def code(prefix: str, x: str | Column, width: int) -> Column:
    """Identifier ``prefix`` + zero-padded number, e.g. ``PO-0000042``."""
    return F.concat(F.lit(prefix), zpad(x, width))


def clamped_lognormal(mu: float, sigma: float, low: float, high: float, seed: int) -> Column:
    """Log-normal draw ``exp(mu + sigma * N(0,1))`` clipped to [low, high]
    (per-partition seeded, like every Spark random column)."""
    return F.least(F.greatest(F.exp(F.lit(mu) + F.lit(sigma) * F.randn(seed)), F.lit(low)), F.lit(high))
