"""Frequent keys of a stored table, from a mergeable sketch taken while it is written.

A table's metadata names the keys that joins and histories group by (``watch``).  The
write carries, as observed metrics, a frequent-items sketch of each: no pass over the
data and no job of its own.  The sketch and the keys it finds are put beside the data
(``_hot_keys.json`` in the table's folder, so an overwrite takes it away, too); an
append merges its sketch into the stored one.  Readers get the hot keys without a job.

A sketch of ``TRACKED`` items finds every key that holds more than about 4.7 /
``TRACKED`` of all rows, its count too low by at most that share.  Counts choose how
far a key is spread; results never depend on them.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from partsflow.sinks.commits import Files

TRACKED = 16_384
KEPT = 1_000  # keys listed beside a table
MIN_CHUNK = 1 << 20  # a key of fewer rows is never spread
NAME = "_hot_keys.json"
NULL, SEPARATOR = "\x00", "\x1f"

_SKETCH = "sketch struct<sketch binary, maxItemsTracked int, itemDataType string, itemDataTypeDDL string>"


def _key(columns: Sequence[str]) -> Column:
    """The key as one string; NULL if any column is (such rows join nothing)."""
    text = F.concat_ws(SEPARATOR, *[F.col(c).cast("string") for c in columns])
    null = F.greatest(*[F.col(c).isNull().cast("int") for c in columns], F.lit(0)) == 1
    return F.when(null, F.lit(NULL)).otherwise(text)


def observed(df: DataFrame, watch: Sequence[Sequence[str]]) -> tuple[DataFrame, Observation]:
    """``df`` with a sketch of each watched key; put it last before the write."""
    seen = Observation()
    sketches = [F.call_function("approx_top_k_accumulate", _key(w), F.lit(TRACKED)).alias(f"k{i}") for i, w in enumerate(watch)]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *sketches), seen


def _estimate(spark: SparkSession, sketches: list) -> tuple[dict, list]:
    """(stored form of the merged sketch, [[key values, count], ...])."""
    rows = spark.createDataFrame([(tuple(s),) for s in sketches], _SKETCH).coalesce(1)
    one = rows.selectExpr(f"approx_top_k_combine(sketch, {TRACKED}) AS s").selectExpr("s", f"approx_top_k_estimate(s, {KEPT}) AS top").first()
    s = one["s"]
    stored = [base64.b64encode(bytes(s["sketch"])).decode(), s["maxItemsTracked"], s["itemDataType"], s["itemDataTypeDDL"]]
    return stored, [[r["item"].split(SEPARATOR), r["count"]] for r in one["top"] if r["item"] != NULL]


def store(spark: SparkSession, path: str, watch: Sequence[Sequence[str]], seen: Observation, merge: bool = False) -> None:
    """Put the keys that a finished write has seen beside its data; ``merge`` adds them
    to those of the earlier writes."""
    files, at = Files(spark), f"{path.rstrip('/')}/{NAME}"
    before = json.loads(files.read(at)) if merge and files.exists(at) else None
    got = seen.get
    out = {"rows": got["rows"] + (before["rows"] if before else 0), "keys": {}}
    for i, columns in enumerate(watch):
        name, sketches = ",".join(columns), [tuple(got[f"k{i}"])]
        if before and name in before["keys"]:
            raw, *rest = before["keys"][name]["sketch"]
            sketches.append((base64.b64decode(raw), *rest))
        stored, items = _estimate(spark, sketches) if out["rows"] else (None, [])
        out["keys"][name] = {"sketch": stored, "items": items}
    files.write(at, json.dumps(out))


class HotKeys:
    """What is stored beside a table; without it, no key counts as hot."""

    def __init__(self, spark: SparkSession, path: str):
        files, at = Files(spark), f"{path.rstrip('/')}/{NAME}"
        found = json.loads(files.read(at)) if files.exists(at) else {"rows": 0, "keys": {}}
        self.spark, self.rows, self._keys = spark, found["rows"], found["keys"]

    def chunk(self) -> int:
        """Rows of one key that a task should take: twice an even share, ``MIN_CHUNK`` at least."""
        return max(MIN_CHUNK, 2 * self.rows // int(self.spark.conf.get("spark.sql.shuffle.partitions")))

    def over(self, columns: Sequence[str], chunk: int | None = None) -> list[tuple[list[str], int]]:
        """(key values as strings, rows) of the keys with more rows than ``chunk``."""
        chunk = self.chunk() if chunk is None else chunk
        return [(k, n) for k, n in self._keys.get(",".join(columns), {"items": []})["items"] if n > chunk]

    def buckets(self, table: DataFrame, columns: Sequence[str], chunk: int | None = None) -> DataFrame | None:
        """For ``joins.left_join``: the hot keys in the types of ``table`` and over how many
        buckets to spread each; at most ``KEPT`` rows, None if there are none."""
        chunk = self.chunk() if chunk is None else chunk
        hot = self.over(columns, chunk)
        if not hot:
            return None
        names = [f"__hk{i}" for i in range(len(columns))]
        rows = self.spark.createDataFrame([(*k, -(-n // chunk)) for k, n in hot], ", ".join(f"{n} string" for n in names) + ", __buckets int")
        return rows.select(*[F.col(n).cast(table.schema[c].dataType).alias(n) for n, c in zip(names, columns)], "__buckets")
