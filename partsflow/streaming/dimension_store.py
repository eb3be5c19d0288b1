"""Stored dimensions of one entity, maintained by interval splice.

The store holds every version of every key in two kinds of rows: **open** rows (the
last version of a key, one a key; a delete is a version, too) and **closed** rows
(``__START_AT`` <= sequence < ``__END_AT``).  Open rows are the type-1 state; open
and closed rows are the type-2 state.  The closed versions of a key and its open
one cut the sequences from the key's first (kept on the open row) into intervals.

A micro-batch touches only the interval that an event falls into:

* at or after the start of the open row: the open row and the events after it;
* before the key's first sequence: nothing but the first sequence itself;
* between them (late): the one closed row that holds the sequence, looked up in
  the segments whose sequence range can hold it.

Each touched interval is cut at its events: the row that holds them ends at the
first, each event at the next, the last where the interval ended.  Nothing else is
read or written, so a batch in order reads the open rows of its buckets and no
history.

Storage: rows are written to new folders (``data/v<version>-<id>/kind=/__bucket=``)
and never changed.  A commit record, published last, lists for each bucket the
folders that make it up, with row count and sequence range, and the change log's
folders with the count of each bucket.  Rows carry the version that wrote them; a
row of the same identity (open: key, closed: key and start) from a later version
stands for an earlier one.  Small folders are folded into larger ones in tiers, so a
record has some ``FAN`` entries a tier and a bucket, however many batches there were.

A writer lost at any point leaves folders that no record names.  A bucket whose
folder is gone is noticed and recomputed from the change log.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partsflow.operators.cdc import END_AT, START_AT, CdcSpec, _winner_first, collapse_events, scd2_state
from partsflow.operators.ordered import latest_at_or_before
from partsflow.sinks.commits import CommitLog

BUCKET = "__bucket"
BATCH_ID = "__batch_id"
FIRST, VERSION, KIND = "__first", "__v", "kind"
OPEN, CLOSED = "open", "closed"
FAN = 8  # folders of one tier (open rows: of a bucket) that are folded into one


class DimensionStore:
    def __init__(self, spark: SparkSession, root: str, spec: CdcSpec, n_buckets: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.spec = spec
        self.commits = CommitLog(spark, f"{self.root}/commits")
        self.n_buckets = n_buckets
        self.read_rows: dict[str, int] = {}  # stored rows in the folders that the last batch read

    # ------------------------------------------------------------------ record
    def record(self) -> dict:
        got = self.commits.latest()
        if got is None:
            if self.n_buckets is None:
                raise ValueError(f"no dimension store at {self.root}")
            return {"version": 0, "n_buckets": self.n_buckets, "events": None, "log": [], "state": [], "replaced": {}}
        if self.n_buckets is not None and got["n_buckets"] != self.n_buckets:
            raise ValueError(f"{self.root.rpartition('/')[2]} is stored in {got['n_buckets']} buckets, not {self.n_buckets}")
        self.n_buckets = got["n_buckets"]
        return got

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.spec.keys]), F.lit(self.n_buckets)).cast("int")

    @staticmethod
    def _event_schema(record: dict) -> T.StructType:
        return T.StructType.fromJson(record["events"])

    def _sequence_type(self, record: dict) -> T.DataType:
        return self._event_schema(record)[self.spec.sequence_by].dataType

    def _row_schema(self, record: dict) -> T.StructType:
        sequence = self._sequence_type(record)
        return (T.StructType(list(self._event_schema(record).fields)).add("__del", "boolean").add(START_AT, sequence)
                .add(END_AT, sequence).add(FIRST, sequence).add(VERSION, "long"))

    # ------------------------------------------------------------------ reading
    def _folder(self, entry: dict) -> str:
        return f"{self.root}/{entry['path']}/{KIND}={entry['kind']}/{BUCKET}={entry['b']}"

    def _rows(self, record: dict, entries: list[dict]) -> DataFrame:
        schema = self._row_schema(record)
        if not entries:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[self._folder(e) for e in entries])

    def _newest(self, rows: DataFrame, identity: list[str]) -> DataFrame:
        w = Window.partitionBy(*identity).orderBy(F.col(VERSION).desc())
        return rows.withColumn("__n", F.row_number().over(w)).where(F.col("__n") == 1).drop("__n")

    def _resolved(self, record: dict, entries: list[dict]) -> DataFrame:
        """Rows of ``entries`` (one kind) without those that a later version replaces.
        Only buckets in which that can happen pay for it."""
        if not entries:
            return self._rows(record, [])
        kind, folders = entries[0]["kind"], {}
        for e in entries:
            folders[e["b"]] = folders.get(e["b"], 0) + 1
        mixed = {b for b, n in folders.items() if (n > 1 if kind == OPEN else str(b) in record["replaced"])}
        plain = self._rows(record, [e for e in entries if e["b"] not in mixed])
        if not mixed:
            return plain
        identity = [*self.spec.keys] if kind == OPEN else [*self.spec.keys, START_AT]
        newest = self._newest(self._rows(record, [e for e in entries if e["b"] in mixed]), identity)
        return newest if len(mixed) == len(folders) else plain.unionByName(newest)

    def _entries(self, record: dict, kind: str, buckets: Iterable[int] | None = None) -> list[dict]:
        wanted = None if buckets is None else set(buckets)
        return [e for e in record["state"] if e["kind"] == kind and (wanted is None or e["b"] in wanted)]

    def dimension(self, scd_type: int, record: dict | None = None) -> DataFrame:
        """The dimension of that type: payload (and interval) of the live rows."""
        record = record or self.record()
        rows = self._resolved(record, self._entries(record, OPEN))
        if scd_type == 2:
            rows = rows.unionByName(self._resolved(record, self._entries(record, CLOSED)))
        events = [f.name for f in self._event_schema(record).fields if f.name not in self.spec.except_columns]
        return rows.where(~F.col("__del")).select(*events, *([START_AT, END_AT] if scd_type == 2 else []))

    def select_sql(self, scd_type: int, record: dict | None = None) -> str:
        """The dimension as a SQL query over the folders of the newest commit, for a
        view; it holds until ``vacuum`` has deleted those folders."""
        record = record or self.record()
        events = [f.name for f in self._event_schema(record).fields]
        shown = [c for c in events if c not in self.spec.except_columns] + ([START_AT, END_AT] if scd_type == 2 else [])
        types = {f.name: f.dataType.simpleString() for f in self._row_schema(record).fields}
        parts = []
        for kind in (OPEN, CLOSED) if scd_type == 2 else (OPEN,):
            folders: dict[str, list[int]] = {}
            for e in self._entries(record, kind):
                folders.setdefault(e["path"], []).append(e["b"])
            rows = []
            for path, buckets in folders.items():  # some FAN a tier
                at = f"{self.root}/{path}/{KIND}={kind}/{BUCKET}={{{','.join(map(str, sorted(buckets)))}}}"
                held = set(self.spark.read.parquet(at).columns)
                rows.append(f"SELECT {', '.join(f'`{c}`' if c in held else f'CAST(NULL AS {t}) AS `{c}`' for c, t in types.items())} FROM parquet.`{at}`")
            if not rows:
                continue
            identity = ", ".join(f"`{c}`" for c in [*self.spec.keys, *([START_AT] if kind == CLOSED else [])])
            union = " UNION ALL ".join(rows)
            if len(rows) > 1 and (kind == OPEN or record["replaced"]):
                union = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {identity} ORDER BY {VERSION} DESC) AS __n FROM ({union})) WHERE __n = 1"
            parts.append(f"SELECT {', '.join(f'`{c}`' for c in shown)} FROM ({union}) WHERE NOT __del")
        return " UNION ALL ".join(parts)

    def change_log(self, buckets: Iterable[int] | None = None, record: dict | None = None) -> DataFrame:
        """Every event applied so far, with ``__bucket`` and ``__batch_id``."""
        record = record or self.record()
        schema = T.StructType(list(self._event_schema(record).fields)).add(BUCKET, "integer").add(BATCH_ID, "long")
        wanted = None if buckets is None else set(buckets)
        paths = [f"{self.root}/{e['path']}" for e in record["log"] if wanted is None or any(int(b) in wanted for b in e["counts"])]
        if not paths:
            return self.spark.createDataFrame([], schema)
        log = self.spark.read.schema(schema).parquet(*paths)
        return log if wanted is None else log.where(F.col(BUCKET).isin(sorted(wanted)))

    # ------------------------------------------------------------------ writing
    def _new_folder(self, area: str, version: int) -> str:
        return f"{area}/v{version:012d}-{uuid.uuid4().hex[:8]}"

    def _write_rows(self, rows: DataFrame, version: int, level: int) -> list[dict]:
        """Entries of a new folder with ``rows`` (with their kind).  Rebalancing keeps a
        bucket's rows together up to Spark's advisory size and splits it beyond."""
        path = self._new_folder("data", version)
        (rows.withColumn(BUCKET, self._bucket()).hint("rebalance", KIND, BUCKET)
         .sortWithinPartitions(KIND, BUCKET, *self.spec.keys, START_AT)
         .write.partitionBy(KIND, BUCKET).parquet(f"{self.root}/{path}"))
        if not any(n.startswith(f"{KIND}=") for n in self.commits.files.names(f"{self.root}/{path}")):
            return []
        schema = T.StructType().add(START_AT, rows.schema[START_AT].dataType).add(END_AT, rows.schema[END_AT].dataType).add(KIND, "string").add(BUCKET, "integer")
        stats = self.spark.read.schema(schema).parquet(f"{self.root}/{path}").groupBy(KIND, BUCKET).agg(
            F.count("*").alias("n"), F.min(START_AT).alias("lo"), F.max(END_AT).alias("hi"))
        return [{"b": r[BUCKET], "kind": r[KIND], "path": path, "rows": r["n"], "lo": r["lo"], "hi": r["hi"], "level": level, "v": version}
                for r in stats.collect()]  # two rows a bucket at most

    def _with_kind(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(KIND, F.when(F.col(END_AT).isNull(), OPEN).otherwise(CLOSED))

    def _write_log(self, events: DataFrame, version: int, level: int, batches: dict) -> dict | None:
        path = self._new_folder("log", version)
        events.hint("rebalance").sortWithinPartitions(BUCKET).write.parquet(f"{self.root}/{path}")
        mark = F.bit_xor(F.xxhash64(*[F.col(c) for c in events.columns]))
        stats = self.spark.read.schema(events.schema).parquet(f"{self.root}/{path}").groupBy(BUCKET).agg(F.count("*").alias("n"), mark.alias("x")).collect()
        if not stats:
            return None
        fingerprint = 0
        for r in stats:
            fingerprint ^= r["x"]
        rows = sum(r["n"] for r in stats)
        return {"path": path, "rows": rows, "level": level, "counts": {str(r[BUCKET]): r["n"] for r in stats},
                "batches": batches or {}, "fingerprint": [rows, fingerprint]}

    # ------------------------------------------------------------------ a batch
    def _merged_schema(self, record: dict, batch: T.StructType) -> dict:
        known = {f.name: f for f in self._event_schema(record).fields} if record["events"] else {}
        for f in batch.fields:
            if f.name in known and known[f.name].dataType != f.dataType:
                raise ValueError(f"column {f.name} was {known[f.name].dataType.simpleString()}, now {f.dataType.simpleString()}")
        return T.StructType([*known.values(), *[f for f in batch.fields if f.name not in known]]).jsonValue()

    def apply(self, batch: DataFrame, batch_id: int) -> bool:
        """Splice the events of a micro-batch into the store.  False if there are none,
        or the very same micro-batch is in the log already (a replay); a late replay of
        an older one changes nothing but the log."""
        record = self.record()
        version = record["version"] + 1
        new = {**record, "version": version, "events": self._merged_schema(record, batch.schema)}
        events = batch.select(*[f.name for f in self._event_schema(new).fields if f.name in batch.columns],
                              *[F.lit(None).cast(f.dataType).alias(f.name) for f in self._event_schema(new).fields if f.name not in batch.columns])
        logged = events.withColumn(BUCKET, self._bucket()).withColumn(BATCH_ID, F.lit(batch_id).cast("long"))
        entry = self._write_log(logged, version, 0, {})
        if entry is None:
            return False
        if any(e["batches"].get(str(batch_id)) == entry["fingerprint"] for e in record["log"]):
            self.commits.files.delete(f"{self.root}/{entry['path']}")
            self.repair()
            return False
        entry["batches"] = {str(batch_id): entry["fingerprint"]}
        touched = [int(b) for b in entry["counts"]]
        lost = self.lost(record, touched)
        if lost:
            self.repair()
            return self.apply(batch, batch_id)
        own = self.spark.read.schema(logged.schema).parquet(f"{self.root}/{entry['path']}").drop(BUCKET, BATCH_ID)
        kept: list[DataFrame] = []  # computed once for the jobs of this batch; recomputed if lost
        try:
            rows, replaced = self._splice(own, new, touched, kept)
            entries = self._write_rows(self._with_kind(rows.withColumn(VERSION, F.lit(version).cast("long"))), version, 0)
        finally:
            for df in kept:
                df.unpersist()
        new["log"] = [*record["log"], entry]
        new["state"] = [*record["state"], *entries]
        new["replaced"] = dict(record["replaced"])
        for b, n in replaced.items():
            new["replaced"][str(b)] = new["replaced"].get(str(b), 0) + n
        self.commits.publish(new)
        self.fold()
        return True

    def _splice(self, events: DataFrame, record: dict, touched: list[int], kept: list[DataFrame]) -> tuple[DataFrame, dict[int, int]]:
        """(rows of the touched intervals, closed rows replaced in each bucket)."""
        keys, seq = [*self.spec.keys], self.spec.sequence_by
        columns = [f.name for f in self._event_schema(record).fields]
        opened = self._entries(record, OPEN, touched)
        self.read_rows = {OPEN: sum(e["rows"] for e in opened), CLOSED: 0}
        one = collapse_events(events, self.spec).withColumn("__least", F.min(seq).over(Window.partitionBy(*keys)))
        firsts = one.select(*keys, "__least").distinct()
        held = self._resolved(record, opened).join(firsts, keys).select(
            *columns, "__del", F.col(START_AT).alias("__a"), F.lit(None).cast(self._sequence_type(record)).alias("__b"), F.least(FIRST, "__least").alias(FIRST),
            F.col(FIRST).alias("__was")).persist()
        placed = one.join(held.select(*keys, F.col("__a").alias("__o"), "__was"), keys, "left").persist()
        kept += [placed, held]
        late = (F.col(seq) >= F.col("__was")) & (F.col(seq) < F.col("__o"))
        first = F.least("__was", "__least").alias(FIRST)
        early = F.col(seq) < F.col("__was")
        direct = placed.where(~F.coalesce(late, F.lit(False))).select(
            *columns, "__del", F.when(~F.coalesce(early, F.lit(False)), F.col("__o")).alias("__a"),
            F.when(early, F.col("__was")).alias("__b"), first)
        parts, replaced = [held.drop("__was"), direct], {}
        # What is late, by bucket: that decides which segments are looked at.
        closed = self._entries(record, CLOSED, touched)
        if closed:
            spans = {r[BUCKET]: (r["lo"], r["hi"]) for r in placed.where(late).withColumn(BUCKET, self._bucket()).groupBy(BUCKET).agg(
                F.min(seq).alias("lo"), F.max(seq).alias("hi")).collect()}  # a row a bucket at most
            look = [e for e in closed if e["b"] in spans and e["lo"] <= spans[e["b"]][1] and e["hi"] > spans[e["b"]][0]]
            if look:
                self.read_rows[CLOSED] = sum(e["rows"] for e in look)
                points = placed.where(late).select(*columns, "__del", first)
                history = self._resolved(record, look)
                starts = latest_at_or_before(points.select(*keys, seq), history, keys, seq, START_AT, "__a", shifts=self.spec.shifts, bucketed=self.spec.bucketed)
                holds = history.join(starts.select(*keys, F.col("__a").alias(START_AT)).distinct(), [*keys, START_AT]).select(
                    *columns, "__del", F.col(START_AT).alias("__a"), F.col(END_AT).alias("__b"))
                ends = holds.select(*keys, "__a", "__b")
                parts += [holds.withColumn(FIRST, F.lit(None).cast(self._sequence_type(record))),
                          points.join(starts, [*keys, seq]).join(ends, [*keys, "__a"]).select(*columns, "__del", "__a", "__b", FIRST)]
                replaced = {r[BUCKET]: r["n"] for r in holds.withColumn(BUCKET, self._bucket()).groupBy(BUCKET).agg(F.count("*").alias("n")).collect()}
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p)
        # Equal sequences: the same winner as in the batch operators; then each row ends at the next.
        winner = Window.partitionBy(*keys, "__a", seq).orderBy(_winner_first(rows.select(*columns, "__del"), self.spec))
        order = Window.partitionBy(*keys, "__a").orderBy(seq)
        rows = (rows.withColumn("__n", F.row_number().over(winner)).where(F.col("__n") == 1)
                .withColumn(END_AT, F.coalesce(F.lead(seq).over(order), F.col("__b"))).withColumn(START_AT, F.col(seq)))
        # Intervals before the first one of a key and the open one are apart; the open row keeps the key's first.
        return rows.select(*columns, "__del", START_AT, END_AT, F.when(F.col(END_AT).isNull(), F.col(FIRST)).alias(FIRST)), replaced

    # ------------------------------------------------------------- maintenance
    def fold(self) -> bool:
        """Fold small folders: open rows of a bucket with ``FAN`` folders or with more
        replaced rows than others, closed rows in tiers of ``FAN``, and the log likewise."""
        record = self.record()
        version, state, rows, dropped, levels = record["version"] + 1, record["state"], [], [], {}
        buckets = sorted({e["b"] for e in state})
        replaced = dict(record["replaced"])
        for kind in (OPEN, CLOSED):
            groups: dict[tuple, list[dict]] = {}
            for b in buckets:
                own = self._entries(record, kind, [b])
                if kind == OPEN:
                    if len(own) >= FAN or (len(own) > 1 and sum(e["rows"] for e in own) >= 2 * max(e["rows"] for e in own)):
                        groups[b, 0] = own
                elif len(own) > 1 and replaced.get(str(b), 0) * 8 > sum(e["rows"] for e in own):
                    groups[b, max(e["level"] for e in own)] = own
                else:
                    for level in sorted({e["level"] for e in own}):
                        tier = [e for e in own if e["level"] == level]
                        if len(tier) >= FAN:
                            groups[b, level + 1] = tier
                if kind == CLOSED and any(len(g) == len(own) for (x, _), g in groups.items() if x == b):
                    replaced.pop(str(b), None)  # all closed rows of the bucket are folded into one folder
            for (b, level), own in groups.items():
                dropped += own
                levels[kind, b] = max(level, levels.get((kind, b), 0))
            if groups:
                identity = [*self.spec.keys] if kind == OPEN else [*self.spec.keys, START_AT]
                entries = [e for own in groups.values() for e in own]
                rows.append(self._newest(self._rows(record, entries), identity).withColumn(KIND, F.lit(kind)))
        log = record["log"]
        for level in sorted({e["level"] for e in log}):
            tier = [e for e in log if e["level"] == level]
            if len(tier) >= FAN:
                schema = T.StructType(list(self._event_schema(record).fields)).add(BUCKET, "integer").add(BATCH_ID, "long")
                whole = self.spark.read.schema(schema).parquet(*[f"{self.root}/{e['path']}" for e in tier])
                merged = self._write_log(whole, version, level + 1, tier[-1]["batches"])  # the last batch can be replayed
                log = [e for e in log if e["level"] != level] + [merged]
                break
        if not rows and log is record["log"]:
            return False
        entries = []
        if rows:
            both = rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1])
            entries = self._write_rows(both, version, 0)
            for e in entries:
                e["level"] = levels[e["kind"], e["b"]]
        gone = {id(e) for e in dropped}
        self.commits.publish({**record, "version": version, "log": log, "replaced": replaced,
                              "state": [e for e in state if id(e) not in gone] + entries})
        return True

    def lost(self, record: dict | None = None, buckets: Iterable[int] | None = None) -> list[int]:
        """Buckets of which a folder named by the record is gone."""
        record = record or self.record()
        wanted = None if buckets is None else set(buckets)
        return sorted({e["b"] for e in record["state"] if (wanted is None or e["b"] in wanted) and not self.commits.files.exists(self._folder(e))})

    def damaged(self) -> list[int]:
        """Buckets with a folder that is gone or holds other than the recorded number of rows."""
        record = self.record()
        lost = set(self.lost(record))
        for e in record["state"]:
            if e["b"] not in lost and self.spark.read.schema(self._row_schema(record)).parquet(self._folder(e)).count() != e["rows"]:
                lost.add(e["b"])
        return sorted(lost)

    def repair(self) -> list[int]:
        """Recompute the buckets that are lost; the list of them."""
        lost = self.lost()
        if lost:
            self.rebuild(lost)
        return lost

    def rebuild(self, buckets: Iterable[int] | None = None) -> None:
        """Recompute buckets (default: all) from the change log with the batch operators."""
        record = self.record()
        version = record["version"] + 1
        events = self.change_log(buckets, record).drop(BUCKET, BATCH_ID)
        state = scd2_state(events, self.spec).withColumn(FIRST, F.min(START_AT).over(Window.partitionBy(*self.spec.keys)))
        rows = state.select(*events.columns, "__del", START_AT, END_AT, F.when(F.col(END_AT).isNull(), F.col(FIRST)).alias(FIRST),
                            F.lit(version).cast("long").alias(VERSION))
        entries = self._write_rows(self._with_kind(rows), version, 0)
        redone = None if buckets is None else set(buckets)
        kept = [] if redone is None else [e for e in record["state"] if e["b"] not in redone]
        replaced = {} if redone is None else {b: n for b, n in record["replaced"].items() if int(b) not in redone}
        self.commits.publish({**record, "version": version, "state": [*kept, *entries], "replaced": replaced})

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete folders that none of the newest ``keep`` records names (no batch may be
        under way); the folders deleted.  Readers of older records must have ended."""
        newest = self.record()["version"]
        kept, first = set(), max(1, newest - keep + 1)
        for v in range(first, newest + 1):
            if self.commits.files.exists(f"{self.commits.root}/{v:012d}.json"):
                record = self.commits.read(v)
                kept |= {e["path"] for e in (*record["state"], *record["log"])}
        gone = [f"{area}/{n}" for area in ("data", "log") for n in self.commits.files.names(f"{self.root}/{area}") if f"{area}/{n}" not in kept]
        for path in gone:
            self.commits.files.delete(f"{self.root}/{path}")
        self.commits.forget_before(first)
        return gone

