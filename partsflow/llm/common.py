"""Small helpers that several operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from partsflow.session import scratch_dir

FILTER_WORDS = 16_384  # 64-bit words of may_hold's bitmap: 128 kB, whatever the input
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: cuts the
    lineage, survives lost executors, and gives Spark a measured size.  The shuffle
    files of the write go with it."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    before = spark.conf.get(SHUFFLES_GO, "false")
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        df.write.parquet(path, **options)
    finally:
        spark.conf.set(SHUFFLES_GO, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete the folders of materialised tables that nothing reads any more: call
    it when what was made from them is itself written."""
    for df in tables:
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df._scratch_path)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` doesn't have (extra input columns never clash)."""
    return f"__{stem}_{uuid.uuid4().hex[:8]}"


def add_dense_index(df: DataFrame, order: list, name: str = "idx", start: int = 0) -> DataFrame:
    """Global position (from ``start``) of each row in the order of ``order``.

    Range-partitioned sort; the position is the row's place in its partition
    plus the row counts of the earlier partitions (one number per partition
    reaches the driver).  The sorted rows are materialised first, so that a
    recomputed partition cannot number its rows differently.
    """
    from pyspark.sql import Window

    spark = df.sparkSession
    part = fresh(df, "part")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(df.repartitionByRange(n, *order).withColumn(part, F.spark_partition_id()), "ranged")
    counts = sorted((r[0], r[1]) for r in ranged.groupBy(part).count().collect())
    offsets, total = {}, start
    for p, c in counts:
        offsets[p] = total
        total += c
    if not offsets:
        return ranged.drop(part).withColumn(name, F.lit(0).cast("long"))
    lookup = F.create_map(*[F.lit(x) for kv in offsets.items() for x in kv])
    w = Window.partitionBy(part).orderBy(*order)
    return (ranged.withColumn(name, (F.row_number().over(w) - 1 + lookup[F.col(part)]).cast("long")).drop(part))


def may_hold(keys: DataFrame, key: str) -> Column:
    """A test for ``keys`` (column k) that may say yes wrongly, never no wrongly:
    a bitmap of fixed size.  Beyond some hundred thousand keys it says yes more
    often, and the join behind it does the whole work."""
    bits = (keys.groupBy(F.pmod("k", F.lit(FILTER_WORDS)).cast("int").alias("w"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(pmod(shiftright(k, 20), 64) as int)))").alias("b")).collect())
    words = [0] * FILTER_WORDS
    for r in bits:
        words[r["w"]] = r["b"]
    table = F.split(F.lit(",".join(map(str, words))), ",").cast("array<bigint>")
    word = F.get(table, F.pmod(key, F.lit(FILTER_WORDS)).cast("int"))
    return word.bitwiseAND(F.expr(f"shiftleft(1L, cast(pmod(shiftright({key}, 20), 64) as int))")) != 0
