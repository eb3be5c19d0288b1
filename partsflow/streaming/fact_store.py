"""Facts refreshed by change.

A fact is a chain of left joins from one root table.  New rows of any input touch
root keys: those of the root rows that the new rows can join (a root row touches
itself, a changed dimension row the root rows that refer to it).  A refresh computes
the fact anew for the touched roots only, over inputs reduced to the keys that these
roots refer to, and publishes the result: for a touched root it stands for all older
rows, so a NULL-extended row that has gained a match goes, too.

Storage: a refresh writes ``data/v<version>-<id>`` with ``rows`` (the fact rows) and
``roots`` (the touched keys), and publishes a commit record that lists the segments,
oldest first.  A row is live unless a later segment has its root.  ``FAN`` segments
of a tier are folded into one of the next.

What is touched is found by one file stream for each input, which stages the
distinct keys of each micro-batch under its number.  Staged keys are deleted after
the refresh that used them is published, so a refresh that breaks off is repeated
with them; to compute a root once more changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partsflow.sinks.commits import CommitLog

FAN = 8
VERSION = "__v"


@dataclass(frozen=True)
class FactSpec:
    name: str
    root: str  # the root table
    key: str  # its key; all rows of a key are computed together
    root_column: str  # the key's column in the fact
    #: input -> (its columns, the root's columns that refer to them); the root itself included
    refers: dict[str, tuple[tuple[str, ...], tuple[str, ...]]]
    #: inputs that are joined as they are (dimensions): input that touches -> name of the joined table
    dimensions: dict[str, str]
    build: Callable[[dict[str, DataFrame]], DataFrame]


class FactStore:
    def __init__(self, spark: SparkSession, root: str, spec: FactSpec):
        self.spark, self.root, self.spec = spark, root.rstrip("/"), spec
        self.commits = CommitLog(spark, f"{self.root}/commits")

    # ------------------------------------------------------------------ staging
    def stage(self, source: str, rows: DataFrame, batch: int) -> None:
        """Keep the keys of new rows of an input until the next refresh."""
        keys = rows.select(*self.spec.refers[source][0]).dropna().distinct()
        keys.write.mode("overwrite").parquet(f"{self.root}/touched/{source}/{batch}")

    def _staged(self) -> dict[str, list[str]]:
        files = self.commits.files
        found = {s: [f"{self.root}/touched/{s}/{n}" for n in files.names(f"{self.root}/touched/{s}")
                     if files.exists(f"{self.root}/touched/{s}/{n}/_SUCCESS")] for s in self.spec.refers}
        return {s: paths for s, paths in found.items() if paths}

    # ------------------------------------------------------------------ refresh
    def refresh(self, tables: dict[str, DataFrame]) -> int:
        """Compute the touched roots anew; the number of them.  ``tables`` holds the root,
        the inputs and the dimensions by name."""
        staged = self._staged()
        if not staged:
            return 0
        spec, root = self.spec, tables[self.spec.root]
        touched = None
        for source, paths in staged.items():
            own, referring = spec.refers[source]
            keys = self.spark.read.schema(T.StructType([root.schema[c] for c in referring])).parquet(*paths) if own == referring else \
                self.spark.read.parquet(*paths).toDF(*referring)
            keys = keys.distinct()
            if referring != (spec.key,):
                keys = root.join(keys, list(referring), "left_semi").select(spec.key)
            touched = keys if touched is None else touched.union(keys)
        record = self.commits.latest() or {"version": 0, "schema": None, "segments": []}
        version = record["version"] + 1
        path = f"data/v{version:012d}-{uuid.uuid4().hex[:8]}"
        touched.distinct().write.parquet(f"{self.root}/{path}/roots")
        roots = self.spark.read.parquet(f"{self.root}/{path}/roots")
        n = roots.count()
        if n:
            part = root.join(roots, spec.key, "left_semi")
            reduced = {spec.root: part}
            for source, (own, referring) in spec.refers.items():
                if source == spec.root:
                    continue
                if source in spec.dimensions:
                    reduced[spec.dimensions[source]] = tables[spec.dimensions[source]]
                else:
                    wanted = part.select(*[F.col(r).alias(c) for c, r in zip(own, referring)]).distinct()
                    reduced[source] = tables[source].join(wanted, list(own), "left_semi")
            rows = spec.build(reduced)
            rows.write.parquet(f"{self.root}/{path}/rows")
            count = self.spark.read.schema(rows.schema).parquet(f"{self.root}/{path}/rows").count()
            self.commits.publish({"version": version, "schema": rows.schema.jsonValue(),
                                  "segments": [*record["segments"], {"path": path, "v": version, "level": 0, "roots": n, "rows": count}]})
        for paths in staged.values():
            for p in paths:
                self.commits.files.delete(p)
        if n:
            self.fold()
        return n

    # ------------------------------------------------------------------ reading
    def _live(self, segments: list[dict], schema: T.StructType) -> DataFrame:
        """Rows of ``segments`` that no later one of them replaces, with their version."""
        parts = [self.spark.read.schema(schema).parquet(f"{self.root}/{s['path']}/rows").withColumn(VERSION, F.lit(s["v"])) for s in segments]
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p)
        if len(segments) == 1:
            return rows
        key = T.StructType([T.StructField("__root", schema[self.spec.root_column].dataType)])
        newer = None
        for s in segments[1:]:
            k = self.spark.read.parquet(f"{self.root}/{s['path']}/roots").toDF("__root").select(F.col("__root").cast(key[0].dataType), F.lit(s["v"]).alias("__last"))
            newer = k if newer is None else newer.union(k)
        newer = newer.groupBy("__root").agg(F.max("__last").alias("__last"))
        return (rows.join(newer, rows[self.spec.root_column] == newer["__root"], "left")
                .where(F.col("__last").isNull() | (F.col(VERSION) >= F.col("__last"))).drop("__root", "__last"))

    def rows(self) -> DataFrame:
        """The fact as of the newest commit."""
        record = self.commits.latest()
        if record is None:
            raise ValueError(f"{self.spec.name} has not been computed yet")
        return self._live(record["segments"], T.StructType.fromJson(record["schema"])).drop(VERSION)

    # -------------------------------------------------------------- maintenance
    def fold(self) -> bool:
        """Fold ``FAN`` neighbouring segments of one tier into one of the next."""
        record = self.commits.latest()
        segments = record["segments"]
        for level in sorted({s["level"] for s in segments}):
            tier = [s for s in segments if s["level"] == level]
            if len(tier) < FAN:
                continue
            version = record["version"] + 1
            path = f"data/v{version:012d}-{uuid.uuid4().hex[:8]}"
            self._live(tier, T.StructType.fromJson(record["schema"])).drop(VERSION).write.parquet(f"{self.root}/{path}/rows")
            self.spark.read.parquet(*[f"{self.root}/{s['path']}/roots" for s in tier]).distinct().write.parquet(f"{self.root}/{path}/roots")
            one = {"path": path, "v": tier[-1]["v"], "level": level + 1, "roots": sum(s["roots"] for s in tier), "rows": sum(s["rows"] for s in tier)}
            at = segments.index(tier[0])
            self.commits.publish({**record, "version": version, "segments": [*segments[:at], one, *segments[at + len(tier):]]})
            return True
        return False

    def vacuum(self) -> list[str]:
        """Delete folders that the newest two records don't name (no refresh may be under way)."""
        record, files = self.commits.latest(), self.commits.files
        first = max(1, record["version"] - 1) if record else 1
        kept = set()
        for v in range(first, (record or {"version": 0})["version"] + 1):
            if files.exists(f"{self.commits.root}/{v:012d}.json"):
                kept |= {s["path"] for s in self.commits.read(v)["segments"]}
        gone = [f"data/{n}" for n in files.names(f"{self.root}/data") if f"data/{n}" not in kept]
        for path in gone:
            files.delete(f"{self.root}/{path}")
        self.commits.forget_before(first)
        return gone
