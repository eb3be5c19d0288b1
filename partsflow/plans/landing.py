"""Landing zone: write the nine feeds as raw Parquet folders.

Transactional feeds are written as one folder of ``n_files`` files; the two
change feeds are written per load batch into ``<feed>/batch=N`` so that a
streaming reader picks batch 2 up incrementally after batch 1 and partition
discovery exposes the ``batch`` column.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from partsflow.plans.feeds import Tables, build_feed
from partsflow.schemas import BATCHED_FEEDS, FEEDS
from partsflow.session import scratch_dir
from partsflow.sinks.tables import write_feed_batches, write_feed_files

# The lines of an order land side by side: their ids share prefixes, so the landed files and
# the exchanges behind them compress better.  Sorted as narrow source rows, inside a task.
ORDER = {"lineitem": ("l_orderkey", "l_linenumber")}

_LANDINGS: dict[tuple[str, str], tuple[str, set[str]]] = {}


def write_landing(tables: Tables, root: str, batches: tuple[int, ...] | None = None,
                  n_files: int | None = None, folders: Iterable[str] | None = None) -> str:
    """Write the feeds ``folders`` (None = all) below ``root``.  ``batches`` limits the
    change feeds to the given load batches (None = all); transactional feeds are written
    only with the first batch.  ``n_files`` fixes the file count per folder; None
    keeps one file per task, which is what a large input needs."""
    for folder in FEEDS if folders is None else folders:
        df = build_feed(tables, folder)
        path = f"{root.rstrip('/')}/{folder}"
        if folder in BATCHED_FEEDS:
            if batches is not None:
                df = df.where(F.col("batch").isin(*batches))
            # One pass; dynamic partition overwrite replaces only the batch
            # folders present in this write (e.g. batch=2 leaves batch=1).
            write_feed_batches(df, path, n_files=n_files)
        elif batches is None or 1 in batches:
            write_feed_files(df, path, n_files=n_files)
    return root


def landing_for(spark: SparkSession, source_root: str, folders: Iterable[str] | None = None) -> str:
    """Landing zone for a source folder with the feeds ``folders`` (None = all); each feed
    is written whole, once per session, when it is first asked for."""
    key = (spark.sparkContext.applicationId, source_root.rstrip("/"))
    root, landed = _LANDINGS.setdefault(key, (scratch_dir(spark, "landing"), set()))
    for folder in FEEDS if folders is None else folders:
        if folder not in landed:
            write_landing(Tables(spark, source_root, order=ORDER), root, folders=[folder])
            landed.add(folder)
    return root
