"""Triggered incremental pipeline: landing -> bronze -> silver -> dimensions -> facts.

* **bronze**: file-stream source per feed (each landing file read once; the
  set of seen files lives in the checkpoint), declared casts, lineage columns;
  appended to a Parquet table.
* **silver**: stream over the bronze table, ``clean`` (filter + projection),
  appended to a Parquet table.  Stateless and narrow: no shuffle.
* **dimensions**: ``foreachBatch`` over the silver change streams: each
  micro-batch is spliced into the entity's ``DimensionStore`` (type 1 and type 2
  are two readings of one store) and published by a commit record.
* **facts**: batch joins over the silver tables and type-1 dimensions,
  overwritten on every run (``run_facts``), or refreshed by change
  (``refresh_facts``: only root keys that new rows touch are computed anew).

Every stream uses ``trigger(availableNow=True)``: a run processes what has
landed since the previous run and stops.  All checkpoints and tables live
below the given roots (shared storage on a cluster), so a lost executor or a
restarted driver resumes from the last committed micro-batch.  A replayed
micro-batch is recognised in the change log or spliced once more, with the same
result.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partsflow.operators.cdc import END_AT, START_AT, CdcSpec
from partsflow.operators.clean import clean
from partsflow.plans import facts as FX
from partsflow.plans.batch import DIMENSIONS
from partsflow.plans.silver import SILVER
from partsflow.schemas import FEEDS, SILVER_SOURCE, TABLES
from partsflow.session import apply_engine_conf
from partsflow.sinks.commits import Files
from partsflow.sinks.tables import register_table, register_view, write_table
from partsflow.sources.files import raw_data_path, stream_feed
from partsflow.streaming.dimension_store import BATCH_ID, BUCKET, DimensionStore
from partsflow.streaming.fact_store import FactSpec, FactStore

NOTE = "_dimension.json"

@dataclass(frozen=True)
class Layout:
    """Where one pipeline keeps its tables and checkpoints."""

    root: str

    def table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/tables/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/checkpoints/{name}"

    def dimension_store(self, entity: str) -> str:
        return f"{self.root.rstrip('/')}/dimensions/{entity}"


def _run_available_now(streams: list[tuple[DataFrame, str, str]]) -> None:
    """Run independent (stream, table path, checkpoint) triggers side by side."""
    running = [df.writeStream.format("parquet").outputMode("append")
               .option("path", path).option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start() for df, path, checkpoint in streams]
    for q in running:
        q.awaitTermination()
    for q in running:
        if q.exception():
            raise q.exception()


def run_bronze(spark: SparkSession, landing_root: str, layout: Layout, max_files_per_trigger: int | None = None,
               folders: Iterable[str] | None = None) -> None:
    """Ingest the new files of the feeds (default: all)."""
    _run_available_now([(stream_feed(spark, landing_root, folder, max_files_per_trigger),
                         layout.table(FEEDS[folder].bronze.name), layout.checkpoint(FEEDS[folder].bronze.name)) for folder in folders or FEEDS])


def stream_table(spark: SparkSession, path: str) -> DataFrame:
    """Stream the rows appended to a Parquet table written by a file sink."""
    schema = spark.read.option("mergeSchema", "true").parquet(path).schema
    return spark.readStream.schema(schema).parquet(path)


def run_silver(spark: SparkSession, layout: Layout, names: Iterable[str] | None = None) -> None:
    """Clean the new rows of the bronze tables (default: all silver tables)."""
    _run_available_now([(clean(stream_table(spark, layout.table(FEEDS[SILVER_SOURCE[name]].bronze.name)), SILVER[name]),
                         layout.table(name), layout.checkpoint(name)) for name in names or SILVER])


class CdcApply:
    """``foreachBatch`` handler maintaining the dimensions of one entity.

    Type-1 and type-2 dimensions are readings of one ``DimensionStore``; a table
    folder holds only a note that names store and type, so a dimension that is added
    later is there at once.  The bucket count is part of the store; another raises.
    """

    def __init__(self, spark: SparkSession, layout: Layout, entity: str, spec: CdcSpec,
                 dims: dict[str, int], n_buckets: int = 64):
        self.spec = spec
        self.dims = dims
        self.layout = layout
        self.store = DimensionStore(spark, layout.dimension_store(entity), spec, n_buckets)

    def _note_dimensions(self) -> None:
        for dim, scd_type in self.dims.items():
            path = f"{self.layout.table(dim)}/{NOTE}"
            if not self.store.commits.files.exists(path):
                note = {"store": self.store.root, "type": scd_type, "keys": list(self.spec.keys), "sequence_by": self.spec.sequence_by,
                        "except_columns": list(self.spec.except_columns)}
                self.store.commits.files.write(path, json.dumps(note))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.store.apply(batch, batch_id)
        self._note_dimensions()


def read_dimension(spark: SparkSession, path: str, except_columns=("_op", "_sequence")) -> DataFrame:
    """A stored dimension as of the newest commit: live rows only, without event and
    storage columns.  ``path`` may also be a plain Parquet folder of ``scd1_state`` or
    ``scd2_state`` rows."""
    files = Files(spark)
    if not files.exists(f"{path}/{NOTE}"):
        df = spark.read.parquet(path)
        return df.where(~F.col("__del")).drop("__del", BUCKET, *except_columns)
    note = json.loads(files.read(f"{path}/{NOTE}"))
    spec = CdcSpec(keys=note["keys"], sequence_by=note["sequence_by"], except_columns=note["except_columns"])
    return DimensionStore(spark, note["store"], spec).dimension(note["type"])


def _dimensions_by_source() -> dict[str, tuple[CdcSpec, dict[str, int]]]:
    """silver table -> (CDC spec, {dimension: SCD type})."""
    out: dict[str, tuple[CdcSpec, dict[str, int]]] = {}
    for dim, (source, spec, scd_type) in DIMENSIONS.items():
        out.setdefault(source, (spec, {}))[1][dim] = scd_type
    return out


def run_dimensions(spark: SparkSession, layout: Layout, n_buckets: int = 64, sources: Iterable[str] | None = None) -> None:
    """Splice the new silver rows of the change feeds (default: all) into their dimensions."""
    for source, (spec, dims) in _dimensions_by_source().items():
        if sources is not None and source not in sources:
            continue
        handler = CdcApply(spark, layout, source, spec, dims, n_buckets)
        q = (stream_table(spark, layout.table(source)).writeStream
             .foreachBatch(handler)
             .option("checkpointLocation", layout.checkpoint(f"cdc_{source}"))
             .trigger(availableNow=True).start())
        q.awaitTermination()
        if q.exception():
            raise q.exception()
        if handler.store.commits.latest() is not None:
            handler.store.repair()
            handler.store.vacuum()


def rebuild_dimensions(spark: SparkSession, layout: Layout) -> None:
    """Recompute every dimension from its change log (after damage that counts of
    rows show, see ``DimensionStore.damaged``; lost folders are repaired anyway)."""
    for source, (spec, _) in _dimensions_by_source().items():
        DimensionStore(spark, layout.dimension_store(source), spec).rebuild()


def run_facts(spark: SparkSession, layout: Layout) -> None:
    silver = {name: spark.read.parquet(layout.table(name)) for name in SILVER}
    dim1 = {d: read_dimension(spark, layout.table(d)) for d in ("dim_part_type1", "dim_customer_type1")}
    f1 = FX.fact_demand_fulfillment(silver["silver_purchase_orders"], silver["silver_demand_signals"],
                                    silver["silver_receivers"], silver["silver_invoices"], dim1["dim_part_type1"])
    write_table(f1, layout.table("fact_demand_fulfillment"), TABLES["fact_demand_fulfillment"])
    f2 = FX.fact_work_order_completion(silver["silver_work_orders"], silver["silver_customer_quotes"],
                                       silver["silver_labor_schedules"], dim1["dim_part_type1"],
                                       dim1["dim_customer_type1"])
    write_table(f2, layout.table("fact_work_order_completion"), TABLES["fact_work_order_completion"])


def _demand(t: dict[str, DataFrame]) -> DataFrame:
    return FX.fact_demand_fulfillment(t["silver_purchase_orders"], t["silver_demand_signals"], t["silver_receivers"], t["silver_invoices"],
                                      t["dim_part_type1"])


def _work_orders(t: dict[str, DataFrame]) -> DataFrame:
    return FX.fact_work_order_completion(t["silver_work_orders"], t["silver_customer_quotes"], t["silver_labor_schedules"],
                                         t["dim_part_type1"], t["dim_customer_type1"])


def _refers(**columns: tuple) -> dict[str, tuple[tuple[str, ...], tuple[str, ...]]]:
    return {f"silver_{name}": (c[0], c[-1]) for name, c in columns.items()}


FACTS = {spec.name: spec for spec in (
    FactSpec("fact_demand_fulfillment", "silver_purchase_orders", "po_id", "po_id",
             _refers(purchase_orders=(("po_id",),), demand_signals=(("signal_id",),), receivers=(("po_id",),), invoices=(("po_id",),),
                     parts=(("part_id",),)),
             {"silver_parts": "dim_part_type1"}, _demand),
    FactSpec("fact_work_order_completion", "silver_work_orders", "wo_id", "wo_id",
             _refers(work_orders=(("wo_id",),), customer_quotes=(("wo_id",),),
                     labor_schedules=(("technician_id", "schedule_date"), ("technician_id", "scheduled_date")),
                     parts=(("part_id",),), customers=(("customer_id",),)),
             {"silver_parts": "dim_part_type1", "silver_customers": "dim_customer_type1"}, _work_orders))}


def fact_store(spark: SparkSession, layout: Layout, name: str) -> FactStore:
    return FactStore(spark, f"{layout.root.rstrip('/')}/facts/{name}", FACTS[name])


def refresh_facts(spark: SparkSession, layout: Layout, names: Iterable[str] | None = None) -> dict[str, int]:
    """Bring the facts up to date with what has changed since the last refresh; the
    number of root keys computed anew.  ``fact_store(...).rows()`` reads a fact.  (The
    other way, ``run_facts``, computes whole tables.)"""
    out = {}
    for name in names or FACTS:
        spec, store = FACTS[name], fact_store(spark, layout, name)
        for source in spec.refers:
            q = (stream_table(spark, layout.table(source)).select(*spec.refers[source][0]).writeStream
                 .foreachBatch(lambda batch, i, s=source, st=store: st.stage(s, batch, i))
                 .option("checkpointLocation", layout.checkpoint(f"touched_{name}_{source}")).trigger(availableNow=True).start())
            q.awaitTermination()
            if q.exception():
                raise q.exception()
        tables = {s: spark.read.parquet(layout.table(s)) for s in spec.refers if s not in spec.dimensions}
        tables |= {d: read_dimension(spark, layout.table(d)) for d in spec.dimensions.values()}
        out[name] = store.refresh(tables)
        store.vacuum()
    return out


def register_tables(spark: SparkSession, layout: Layout) -> list[str]:
    """Catalog entries with comment and properties: tables over bronze, silver and facts,
    views of the dimensions as of now (register again after a run)."""
    names = [FEEDS[f].bronze.name for f in FEEDS] + list(SILVER) + [
        "fact_demand_fulfillment", "fact_work_order_completion"]
    metas = {**{FEEDS[f].bronze.name: FEEDS[f].bronze for f in FEEDS}, **TABLES}
    for name in names:
        register_table(spark, metas[name], layout.table(name))
    for source, (spec, dims) in _dimensions_by_source().items():
        store = DimensionStore(spark, layout.dimension_store(source), spec)
        for dim, scd_type in dims.items():
            register_view(spark, TABLES[dim], store.select_sql(scd_type))
    return [*names, *DIMENSIONS]


def run_pipeline(spark: SparkSession, landing_root: str | None, root: str, n_buckets: int = 64,
                 register: bool = False, max_files_per_trigger: int | None = None) -> Layout:
    """One triggered update of the whole flow, in fixed stage order.

    ``landing_root`` defaults to the ``raw_data_path`` setting.
    """
    apply_engine_conf(spark)
    landing_root = raw_data_path(spark, landing_root)
    layout = Layout(root)
    run_bronze(spark, landing_root, layout, max_files_per_trigger)
    run_silver(spark, layout)
    run_dimensions(spark, layout, n_buckets)
    run_facts(spark, layout)
    if register:
        register_tables(spark, layout)
    return layout


__all__ = ["Layout", "CdcApply", "run_pipeline", "read_dimension", "rebuild_dimensions", "START_AT", "END_AT", "BUCKET", "BATCH_ID"]
