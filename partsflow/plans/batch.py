"""Batch evaluation of the whole flow over the given tables.

``Flow`` hands out lazily built DataFrames for every stage (feed, typed feed,
silver, dimensions, facts).  Nothing is collected; each accessor returns a
plan that Catalyst optimises end to end (filters and column pruning reach the
source scans).  ``run_batch`` materialises the stages as clustered Parquet
tables, which is what a scheduled job does; downstream stages then read the
written tables instead of recomputing them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from partsflow.operators.cdc import CdcSpec, scd1, scd2
from partsflow.operators.clean import clean, validity_filter
from partsflow.operators.hot_keys import HotKeys
from partsflow.plans import facts as FX
from partsflow.plans.feeds import Tables, build_feed
from partsflow.plans.silver import SILVER
from partsflow.schemas import SILVER_SOURCE, TABLES
from partsflow.sinks.tables import write_table
from partsflow.sources.files import read_feed, typed_feed

PART_CDC = CdcSpec(keys=("part_id",), tie_break=("updated_at",))
CUSTOMER_CDC = CdcSpec(keys=("customer_id",), tie_break=("updated_at",))

DIMENSIONS = {
    "dim_part_type1": ("silver_parts", PART_CDC, 1),
    "dim_part_type2": ("silver_parts", PART_CDC, 2),
    "dim_customer_type1": ("silver_customers", CUSTOMER_CDC, 1),
    "dim_customer_type2": ("silver_customers", CUSTOMER_CDC, 2),
}


#: Sides of the facts that can be hot on the right: table and key.
DEMAND_SIDES = {"ds": ("silver_demand_signals", ("signal_id",)), "r": ("silver_receivers", ("po_id",)), "inv": ("silver_invoices", ("po_id",))}
WORK_ORDER_SIDES = {"q": ("silver_customer_quotes", ("wo_id",)), "ls": ("silver_labor_schedules", ("technician_id", "schedule_date"))}


def apply_cdc(events: DataFrame, spec: CdcSpec, scd_type: int, hot: DataFrame | None = None) -> DataFrame:
    return scd1(events, spec) if scd_type == 1 else scd2(events, spec, hot)


class Flow:
    """Stage accessors over one set of source tables.

    With ``store`` set, silver tables and dimensions are written once as
    clustered Parquet tables below ``store`` (a shared folder) and read back:
    downstream stages then scan the stored tables, as the pipeline's facts
    and consumer queries do, and their lineage stops at the stored table.
    ``overrides`` maps a stage name to an already materialised frame.
    ``landing`` gives the root of the landing folders; with ``by_feed`` it takes a feed's
    name and lands that one, so a query writes only the feeds that it reads.
    """

    STORED_PREFIXES = ("silver_", "dim_")

    def __init__(self, tables: Tables, overrides: dict[str, DataFrame] | None = None,
                 store: str | None = None, join_chunk: int | None = None,
                 landing: Callable[..., str] | None = None, by_feed: bool = False):
        self.t = tables
        self.join_chunk = join_chunk
        self.landing = landing
        self.by_feed = by_feed
        self.spark = tables.spark
        self.store = store.rstrip("/") if store else None
        self._memo: dict[str, DataFrame] = dict(overrides or {})

    def _get(self, key: str, build) -> DataFrame:
        if key not in self._memo:
            df = build()
            if self.store and key.startswith(self.STORED_PREFIXES):
                path = f"{self.store}/{key}"
                write_table(df, path, TABLES[key])
                df = self.spark.read.parquet(path)
            self._memo[key] = df
        return self._memo[key]

    def feed(self, folder: str) -> DataFrame:
        return self._get(f"feed:{folder}", lambda: build_feed(self.t, folder))

    def _landed(self, folder: str) -> str:
        """Root of the landing folders, with this feed in it."""
        return self.landing(folder) if self.by_feed else self.landing()

    def typed(self, folder: str) -> DataFrame:
        """The bronze payload: read back from the landing folders when the flow
        has them (as silver reads bronze), else the feed with declared types."""
        if self.landing is not None:
            return self._get(f"typed:{folder}", lambda: read_feed(self.spark, self._landed(folder), folder, metadata=False))
        return self._get(f"typed:{folder}", lambda: typed_feed(self.feed(folder), folder))

    def _source(self, silver_name: str) -> DataFrame:
        """What a silver table is made from: of landed files, without the rows that the
        predicate's pushable part drops in the scan."""
        folder, raw = SILVER_SOURCE[silver_name], SILVER[silver_name].raw
        if self.landing is None or raw is None:
            return self.typed(folder)
        return self._get(f"raw:{silver_name}", lambda: read_feed(self.spark, self._landed(folder), folder, metadata=False, raw=raw))

    def valid(self, silver_name: str) -> DataFrame:
        """Typed feed rows that pass the silver validity predicate."""
        return validity_filter(self._source(silver_name), SILVER[silver_name].predicate)

    def silver(self, name: str) -> DataFrame:
        return self._get(name, lambda: clean(self._source(name), SILVER[name]))

    def dim(self, name: str) -> DataFrame:
        source, spec, scd_type = DIMENSIONS[name]
        return self._get(name, lambda: apply_cdc(self.silver(source), spec, scd_type, self._hot_entities(source, spec)))

    def _hot_entities(self, source: str, spec: CdcSpec) -> DataFrame | None:
        keys = self.hot_keys(source)
        return keys.buckets(self.silver(source), spec.keys, self.join_chunk) if keys is not None else None

    def hot_keys(self, table: str) -> HotKeys | None:
        """The hot keys kept beside a stored silver table (None: the flow stores none)."""
        if not self.store:
            return None
        self.silver(table)
        return HotKeys(self.spark, f"{self.store}/{table}")

    def _hot_sides(self, sides: dict[str, tuple[str, tuple[str, ...]]]) -> dict[str, DataFrame | None]:
        found = {side: (self.hot_keys(table), table, columns) for side, (table, columns) in sides.items()}
        return {side: keys.buckets(self.silver(table), columns, self.join_chunk) for side, (keys, table, columns) in found.items() if keys is not None}

    def fact(self, name: str) -> DataFrame:
        if name == "fact_demand_fulfillment":
            return self._get(name, lambda: FX.fact_demand_fulfillment(
                self.silver("silver_purchase_orders"), self.silver("silver_demand_signals"),
                self.silver("silver_receivers"), self.silver("silver_invoices"), self.dim("dim_part_type1"),
                None if self.store else self.join_chunk, self._hot_sides(DEMAND_SIDES)))
        if name == "fact_work_order_completion":
            return self._get(name, lambda: FX.fact_work_order_completion(
                self.silver("silver_work_orders"), self.silver("silver_customer_quotes"),
                self.silver("silver_labor_schedules"), self.dim("dim_part_type1"),
                self.dim("dim_customer_type1"), None if self.store else self.join_chunk, self._hot_sides(WORK_ORDER_SIDES)))
        raise KeyError(name)


def run_batch(spark: SparkSession, source_root: str, out_root: str) -> dict[str, str]:
    """Materialise silver, dimensions and facts as clustered Parquet tables.

    Each stage is written once and read back by the next stage, which also
    cuts the lineage between stages (a lost executor recomputes from the last
    written table, not from the sources).
    """
    flow = Flow(Tables(spark, source_root), store=out_root)
    for name in SILVER:
        flow.silver(name)
    for name in DIMENSIONS:
        flow.dim(name)
    paths = {name: f"{flow.store}/{name}" for name in (*SILVER, *DIMENSIONS)}
    for name in ("fact_demand_fulfillment", "fact_work_order_completion"):
        paths[name] = f"{flow.store}/{name}"
        write_table(flow.fact(name), paths[name], TABLES[name])
    return paths
