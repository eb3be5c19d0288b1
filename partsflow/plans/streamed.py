"""Registered queries that run the streams: bronze ingestion and incremental dimensions.

Each builds its tables once a session below the shared checkpoint folder.  The
change feeds land one load batch after the other, and each is ingested, cleaned and
spliced before the next lands, so the dimensions are the result of several
micro-batches with late and repeated events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partsflow.oracle import compose
from partsflow.plans.batch import DIMENSIONS
from partsflow.plans.feeds import Tables, build_feed
from partsflow.plans.landing import landing_for
from partsflow.schemas import FEEDS, SILVER_SOURCE
from partsflow.session import scratch_dir
from partsflow.sinks.tables import write_feed_batches
from partsflow.streaming.pipeline import Layout, read_dimension, run_bronze, run_dimensions, run_silver

LOAD_BATCHES = (1, 2, 3)
BUCKETS = 8

_LAYOUTS: dict[tuple, Layout] = {}


def bronze(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """The bronze table of a feed, ingested by its file stream; lineage as what can be
    compared: the feed folder of ``_source_file`` and that ``_ingested_at`` is set."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), folder)
    if key not in _LAYOUTS:
        layout = Layout(scratch_dir(spark, f"bronze-{folder}"))
        run_bronze(spark, landing_for(spark, sf_dir, [folder]), layout, folders=[folder])
        _LAYOUTS[key] = layout
    table = spark.read.parquet(_LAYOUTS[key].table(FEEDS[folder].bronze.name))
    payload = [c for c in table.columns if c not in ("_source_file", "_ingested_at")]
    return table.select(*payload, F.regexp_extract("_source_file", r"/([^/]+)(?:/batch=\d+)?/[^/]+$", 1).alias("source_feed"),
                        F.col("_ingested_at").isNotNull().alias("ingested"))


def bronze_oracle(folder: str) -> str:
    return compose.statement(f"SELECT *, '{folder}' AS source_feed, true AS ingested FROM typed_{folder}", [f"typed_{folder}"])


def dimension(spark: SparkSession, sf_dir: str, dim: str) -> DataFrame:
    """A dimension maintained by the streams over the load batches."""
    source = DIMENSIONS[dim][0]
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), source)
    if key not in _LAYOUTS:
        layout, folder = Layout(scratch_dir(spark, f"stream-{source}")), SILVER_SOURCE[source]
        landing = f"{layout.root}/landing"
        feed = build_feed(Tables(spark, sf_dir), folder)
        for batch in LOAD_BATCHES:
            write_feed_batches(feed.where(F.col("batch") == batch), f"{landing}/{folder}", n_files=None)
            run_bronze(spark, landing, layout, folders=[folder])
            run_silver(spark, layout, names=[source])
            run_dimensions(spark, layout, BUCKETS, sources=[source])
        _LAYOUTS[key] = layout
    return read_dimension(spark, _LAYOUTS[key].table(dim))


STREAM_QUERIES = {f"stream_{dim}": dim for dim in DIMENSIONS}
STREAM_ORACLES = {**{FEEDS[folder].bronze.name: bronze_oracle(folder) for folder in FEEDS},
                  **{name: compose.stage(dim) for name, dim in STREAM_QUERIES.items()}}
