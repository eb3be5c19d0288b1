"""Landing-folder sources (batch and streaming).

A feed folder holds Parquet files, possibly below ``batch=N`` sub-folders.
The readers:

* take the *physical* schema from the files once and cast the declared
  ("hinted") columns in the projection -- a narrower read schema would make
  the Parquet reader fail on BIGINT/DOUBLE columns declared INT;
* keep every other column (``col("*")`` semantics), including the ``batch``
  partition column that partition discovery adds;
* add the lineage columns ``_source_file`` (``_metadata.file_path``) and
  ``_ingested_at`` (``current_timestamp()``, one value per micro-batch).

Streaming reads use the file source: every new file is ingested once, the
set of seen files lives in the query checkpoint, and ``availableNow``
triggers give the triggered (not continuous) update.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from partsflow.schemas import FEEDS, FeedSpec


def declared_projection(schema: StructType, spec: FeedSpec) -> list[Column]:
    """All physical columns, the hinted ones cast to their declared type."""
    hinted = dict(spec.hinted)
    cols = []
    for field in schema.fields:
        if field.name in hinted:
            cols.append(F.col(field.name).cast(hinted[field.name]).alias(field.name))
        else:
            cols.append(F.col(field.name))
    # Declared columns that are absent from the files read as NULL.
    present = {f.name for f in schema.fields}
    for name, typ in spec.hinted:
        if name not in present:
            cols.append(F.lit(None).cast(typ).alias(name))
    return cols


def ingest_metadata() -> list[Column]:
    return [F.col("_metadata.file_path").alias("_source_file"),
            F.current_timestamp().alias("_ingested_at")]


def feed_path(root: str, folder: str) -> str:
    return f"{root.rstrip('/')}/{folder}"


def physical_schema(spark: SparkSession, path: str) -> StructType:
    """Merged schema of all files (their footers are read in parallel), so a
    column that first appears in a later file is there; with partition columns."""
    return spark.read.option("mergeSchema", "true").parquet(path).schema


# ---- files of one feed with different types ----------------------------------
INTEGRAL = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
FRACTIONAL = (T.FloatType(), T.DoubleType())
RESCUED = "_rescued"


def common_type(types: list[T.DataType]) -> T.DataType:
    """The narrowest type that holds the values of all: integers as BIGINT, with floating
    point as DOUBLE, dates with timestamps as timestamps; otherwise text."""
    kinds = set(types)
    if len(kinds) == 1:
        return types[0]
    if kinds <= {*INTEGRAL}:
        return T.LongType()
    if kinds <= {*INTEGRAL, *FRACTIONAL}:
        return T.DoubleType()
    if kinds <= {T.DateType(), T.TimestampNTZType()}:
        return T.TimestampNTZType()
    return T.StringType()


def _agree(a: StructType, b: StructType) -> bool:
    types = {f.name: f.dataType for f in a.fields}
    return all(types.get(f.name, f.dataType) == f.dataType for f in b.fields)


def _union(a: StructType, b: StructType) -> StructType:
    names = set(a.names)
    return StructType([*a.fields, *[f for f in b.fields if f.name not in names]])


def schema_groups(spark: SparkSession, path: str) -> list[tuple[StructType, list[str]]]:
    """The files below ``path`` in groups whose schemas can be merged.

    Spark merges the footers of a set of files in parallel; only a set that can't be
    merged is halved, so there are about as many merges as changes of type, times the
    logarithm of the number of files.  File names come to the driver (as they do to
    plan any scan)."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    groups: list[tuple[StructType, list[str]]] = []
    todo = [sorted(r["path"] for r in listed.select("path").collect())]
    while todo:
        files = todo.pop()
        if not files:
            continue
        try:
            schema = spark.read.option("mergeSchema", "true").option("basePath", path).parquet(*files).schema
        except Exception as fault:  # Spark has several classes for it
            if len(files) == 1 or "CANNOT_MERGE" not in str(fault):
                raise
            half = len(files) // 2
            todo += [files[half:], files[:half]]
            continue
        for i, (known, own) in enumerate(groups):
            if _agree(known, schema):
                groups[i] = (_union(known, schema), own + files)
                break
        else:
            groups.append((schema, files))
    return groups


def reconciled(spark: SparkSession, path: str, declared: dict[str, str]) -> DataFrame:
    """The files below ``path``, whatever types they give a column: each group is cast to
    the declared type, or else to the common one, and the groups are united.  No row is
    lost: a value that its column's type can't hold is NULL there and stands, as text,
    in the map ``_rescued`` under the column's name (NULL if there is none)."""
    groups = schema_groups(spark, path)
    types: dict[str, list[T.DataType]] = {}
    for schema, _ in groups:
        for f in schema.fields:
            types.setdefault(f.name, []).append(f.dataType)
    target = {name: StructType.fromDDL(f"x {declared[name]}")["x"].dataType if name in declared else common_type(kinds) for name, kinds in types.items()}
    out = None
    for schema, files in groups:
        df = spark.read.schema(schema).option("basePath", path).parquet(*files)
        # A cast to an integer cuts fractions as everywhere; what doesn't fit or parse is kept.
        casts = {f.name: F.col(f.name).try_cast(target[f.name]) for f in schema.fields}
        failed = [F.when(F.col(f.name).isNotNull() & casts[f.name].isNull(), F.struct(F.lit(f.name).alias("key"), F.col(f.name).cast("string").alias("value")))
                  for f in schema.fields if f.dataType != target[f.name]]
        lost = F.filter(F.array(*failed), lambda x: x.isNotNull()) if failed else None
        rescued = F.when(F.size(lost) > 0, F.map_from_entries(lost)) if failed else F.lit(None).cast("map<string,string>")
        columns = [casts[f.name].alias(f.name) if f.dataType != target[f.name] else F.col(f.name) for f in schema.fields]
        part = df.select(*columns, rescued.alias(RESCUED), F.col("_metadata.file_path").alias("_source_file"))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def read_feed(spark: SparkSession, root: str, folder: str, metadata: bool = True, raw: str | None = None) -> DataFrame:
    """Batch read of a landing folder with declared casts (+ lineage).  ``raw``: a
    predicate on the columns as they lie in the files; in front of the casts it
    reaches the scan, behind a narrowing cast a predicate doesn't."""
    spec = FEEDS[folder]
    try:
        df = spark.read.option("mergeSchema", "true").parquet(feed_path(root, folder))
    except Exception as fault:
        if "CANNOT_MERGE" not in str(fault):
            raise
        df = reconciled(spark, feed_path(root, folder), dict(spec.hinted))
        df = df if raw is None else df.where(raw)
        payload = StructType([f for f in df.schema.fields if f.name != "_source_file"])
        return df.select(*declared_projection(payload, spec), *(["_source_file", F.current_timestamp().alias("_ingested_at")] if metadata else []))
    cols = declared_projection(df.schema, spec)
    if raw is not None:
        df = df.where(raw)
    return df.select(*cols, *(ingest_metadata() if metadata else []))


def stream_feed(spark: SparkSession, root: str, folder: str,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Incremental read of a landing folder (each file exactly once)."""
    spec = FEEDS[folder]
    path = feed_path(root, folder)
    try:
        schema = physical_schema(spark, path)
    except Exception as fault:
        if "CANNOT_MERGE" not in str(fault):
            raise
        schema = _readable_schema(spark, path)
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.parquet(path)
    return df.select(*declared_projection(df.schema, spec), *ingest_metadata())


def _readable_schema(spark: SparkSession, path: str) -> StructType:
    """One schema with which Spark's reader reads all files: it widens integers to BIGINT
    and, up to INT, to DOUBLE, but no BIGINT to DOUBLE and nothing to text."""
    groups = schema_groups(spark, path)
    types: dict[str, list[T.DataType]] = {}
    for schema, _ in groups:
        for f in schema.fields:
            types.setdefault(f.name, []).append(f.dataType)
    out = StructType()
    for name, kinds in types.items():
        wide = common_type(kinds)
        if any(k != wide and (k == T.LongType() or wide == T.StringType()) for k in kinds):
            raise ValueError(f"column {name} is {', '.join(sorted({k.simpleString() for k in kinds}))} in files of {path}: "
                             "no stream reads them together; read_feed does")
        out = out.add(name, wide)
    return out


def typed_feed(df: DataFrame, folder: str) -> DataFrame:
    """Apply the declared types to an in-memory feed (no file lineage)."""
    return df.select(*declared_projection(df.schema, FEEDS[folder]))


def raw_data_path(spark: SparkSession, root: str | None = None) -> str:
    """Landing root: the explicit argument, else the ``raw_data_path`` setting."""
    if root:
        return root
    conf = spark.conf.get("raw_data_path", None)
    if not conf:
        raise ValueError("landing root not given and raw_data_path is not set")
    return conf


def read_batch(spark: SparkSession, root: str, folder: str, batch: int, metadata: bool = True) -> DataFrame:
    """Static read of one load batch of a change feed (``<feed>/batch=N``);
    the filter on the partition column prunes the other folders."""
    return read_feed(spark, root, folder, metadata).where(F.col("batch") == batch)
