"""Parquet table writers: clustered layout, load-batch folders, catalog metadata.

``cluster_by`` becomes a physical layout: rows are range-partitioned on the
clustering columns and sorted inside each file, so Parquet row-group min/max
statistics let later filters on those columns skip files and row groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partsflow.operators import hot_keys
from partsflow.schemas import TableMeta


def clustered(df: DataFrame, cluster_by: tuple[str, ...] | list[str], n_files: int | None = None) -> DataFrame:
    """Range-partition on the clustering columns and sort within files.  A hash of the
    row comes last in the ranges, so the rows of one key can go to several files."""
    cols = list(cluster_by)
    if not cols:
        return df
    spread = [*cols, F.xxhash64(*[F.col(c) for c in df.columns])]
    out = df.repartitionByRange(n_files, *spread) if n_files else df.repartitionByRange(*spread)
    return out.sortWithinPartitions(*cols)


def write_table(df: DataFrame, path: str, meta: TableMeta | None = None, mode: str = "overwrite",
                n_files: int | None = None, partition_by: list[str] | None = None) -> None:
    """Write ``df`` as Parquet with the table's clustered layout; the frequent values of
    the keys that the table watches are put beside it (``operators.hot_keys``)."""
    if meta is not None:
        df = clustered(df, meta.cluster_by, n_files)
    elif n_files:
        df = df.repartition(n_files)
    seen = None
    if meta is not None and meta.watch:  # behind the exchange, so that sampling for it doesn't count
        df, seen = hot_keys.observed(df, meta.watch)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    if seen is not None:
        hot_keys.store(df.sparkSession, path, meta.watch, seen, merge=mode == "append")


def write_feed_files(df: DataFrame, path: str, n_files: int | None = 16) -> None:
    """Landing writer: ``n_files`` files (None: one per task), replacing the folder."""
    (df.repartition(n_files) if n_files else df).write.mode("overwrite").parquet(path)


def write_feed_batch(df: DataFrame, path: str, batch: int, n_files: int = 8) -> None:
    """Landing writer for one load batch: ``path/batch=N`` only is replaced."""
    df.repartition(n_files).write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch}")


def write_feed_batches(df: DataFrame, path: str, n_files: int | None = 8, batch_col: str = "batch") -> None:
    """Landing writer for change feeds: ``path/batch=N`` folders in one pass.

    Requires ``spark.sql.sources.partitionOverwriteMode=dynamic`` (set by the
    session helpers) so that only the batches present are replaced.
    """
    # Round-robin, not hashed on the batch: one batch holds most rows.
    ((df.repartition(n_files) if n_files else df).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(batch_col).parquet(path))


def _drop(spark: SparkSession, name: str) -> None:
    """Remove a catalog entry, be it a table or a view (never the data below it)."""
    if spark.catalog.tableExists(name):
        spark.sql(f"DROP {'VIEW' if spark.catalog.getTable(name).tableType == 'VIEW' else 'TABLE'} {name}")


def register_table(spark: SparkSession, meta: TableMeta, path: str) -> None:
    """Catalog entry with comment and properties over an existing Parquet path."""
    props = ", ".join(f"'{k}' = '{v}'" for k, v in sorted(meta.properties.items()))
    comment = meta.comment.replace("'", "\\'")
    _drop(spark, meta.name)
    spark.sql(
        f"CREATE TABLE {meta.name} USING parquet LOCATION '{path}' "
        f"COMMENT '{comment}'" + (f" TBLPROPERTIES ({props})" if props else ""))


def register_view(spark: SparkSession, meta: TableMeta, query: str) -> None:
    """Catalog view with comment and properties."""
    props = ", ".join(f"'{k}' = '{v}'" for k, v in sorted(meta.properties.items()))
    comment = meta.comment.replace("'", "\\'")
    _drop(spark, meta.name)
    spark.sql(f"CREATE VIEW {meta.name} COMMENT '{comment}'" + (f" TBLPROPERTIES ({props})" if props else "") + f" AS {query}")
