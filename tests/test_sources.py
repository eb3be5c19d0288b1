"""Landing sources and sinks: declared casts, partition folders, layout, catalog metadata."""

import contextlib
import io

from conftest import SF_SMALL
from pyspark.sql import functions as F

from partsflow.functions.scalar import clamped_lognormal
from partsflow.operators.sampling import dense_index, sample_with_replacement, sample_without_replacement
from partsflow.plans.feeds import Tables, build_feed
from partsflow.plans.landing import write_landing
from partsflow.schemas import TABLES
from partsflow.sinks.tables import register_table, write_table
from partsflow.sources.files import raw_data_path, read_batch, read_feed


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_declared_types_lineage_and_batch_folders(spark, scratch):
    t = Tables(spark, SF_SMALL)
    write_landing(t, scratch, n_files=2)
    parts = read_feed(spark, scratch, "parts_cdc")
    types = dict(parts.dtypes)
    assert types["lead_time_days"] == "int"          # BIGINT on disk, INT declared
    assert types["updated_at"] == "timestamp_ntz" and types["batch"] == "int"
    assert parts.where(F.col("_source_file").contains("batch=")).count() == parts.count()
    inv = read_feed(spark, scratch, "invoices")
    assert dict(inv.dtypes)["days_to_payment"] == "int"  # DOUBLE on disk
    one = read_batch(spark, scratch, "parts_cdc", 2)
    assert "PartitionFilters: [isnotnull(batch" in _plan(one)
    assert one.count() == build_feed(t, "parts_cdc").where("batch = 2").count()


def test_raw_data_path_from_configuration(spark):
    spark.conf.set("raw_data_path", "/landing/x")
    assert raw_data_path(spark) == "/landing/x"
    assert raw_data_path(spark, "/other") == "/other"
    spark.conf.unset("raw_data_path")


def test_clustered_layout_and_catalog_metadata(spark, scratch):
    df = spark.range(1000).select(F.format_string("P%04d", (F.col("id") * 7919) % 1000).alias("part_id"),
                                  F.col("id"))
    meta = TABLES["dim_part_type1"]
    path = f"{scratch}/dim"
    write_table(df, path, meta, n_files=4)
    # range-partitioned and sorted: files hold disjoint, ordered key ranges
    files = spark.read.parquet(path).withColumn("f", F.input_file_name()).groupBy("f").agg(
        F.min("part_id").alias("lo"), F.max("part_id").alias("hi")).orderBy("lo").collect()
    assert len(files) == 4
    assert all(a.hi < b.lo for a, b in zip(files, files[1:]))
    register_table(spark, meta, path)
    props = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {meta.name}").collect()}
    assert props["scd_type"] == "1" and props["layer"] == "dimension" and props["quality"] == "gold"
    desc = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {meta.name}").collect()}
    assert desc["Comment"] == meta.comment
    assert spark.table(meta.name).count() == 1000


def test_sampling_sizes_and_distinctness(spark):
    pop = spark.range(37).withColumnRenamed("id", "k")
    idx = dense_index(pop.repartition(5), ["k"])
    assert sorted((r["k"], r["__idx"]) for r in idx.collect()) == [(i, i) for i in range(37)]
    s = sample_with_replacement(pop, 100, ["k"], seed=46)
    assert s.count() == 100 and s.select("draw").distinct().count() == 100
    assert s.where((F.col("k") < 0) | (F.col("k") >= 37)).count() == 0
    w = sample_without_replacement(pop, 10, F.col("k"), seed=99)
    assert w.count() == 10 and w.distinct().count() == 10
    empty = pop.where("k < 0")
    assert sample_with_replacement(empty, 5, ["k"], seed=1).count() == 0


def test_samples_are_samples(spark):
    pop = spark.range(1, 2001).withColumnRenamed("id", "k")
    got = sorted(r["k"] for r in sample_without_replacement(pop, 80, F.col("k"), seed=99).collect())
    # Not a prefix: each half of the keys has its share.
    assert len(set(got)) == 80 and got[-1] > 1900 and 20 <= sum(k <= 1000 for k in got) <= 60
    assert got != sorted(r["k"] for r in sample_without_replacement(pop, 80, F.col("k"), seed=98).collect())
    # With replacement: multiplicities vary as they should, and any row can come, whatever the population's factors.
    for n in (1479, 1000):
        drawn = sample_with_replacement(pop.where(F.col("k") <= n), 4 * n, ["k"], seed=46).groupBy("k").count().collect()
        assert 0.97 * n <= len(drawn) < n and max(r["count"] for r in drawn) >= 10


def test_clamped_lognormal_bounds(spark):
    v = spark.range(5000).select(clamped_lognormal(4.5, 1.0, 5.0, 2500.0, seed=42).alias("p"))
    r = v.agg(F.min("p").alias("lo"), F.max("p").alias("hi")).first()
    assert r.lo >= 5.0 and r.hi <= 2500.0


def test_ansi_overflow_on_declared_cast_fails_loudly(spark):
    import pytest
    from pyspark.errors import ArithmeticException

    from partsflow.sources.files import typed_feed
    df = spark.createDataFrame([("p", 1 << 40)], "part_id string, lead_time_days bigint")
    with pytest.raises(ArithmeticException):
        typed_feed(df, "parts_cdc").collect()


def test_threshold_selection_equals_the_ordered_prefix(spark):
    """The first k of the seeded order, with repeated keys, k of 0, at a bucket's edge, and beyond the population."""
    import hashlib
    from collections import Counter

    from partsflow.operators import sampling

    keys = [i % 700 for i in range(1500)]
    pop = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, i int").repartition(5)
    order = sorted((int(hashlib.md5(f"7:{k}".encode()).hexdigest()[:15], 16), k) for k in keys)
    old = sampling.HISTOGRAM_BITS
    try:
        for bits in (2, 16):
            sampling.HISTOGRAM_BITS = bits
            for k in (0, 1, 37, 1499, 1500, 9999):
                got = sample_without_replacement(pop, k, F.col("k"), seed=7)
                assert got.columns == ["k", "i"]
                found = got.collect()
                assert Counter(r["k"] for r in found) == Counter(x for _, x in order[:k])
                assert len({r["i"] for r in found}) == len(found)
    finally:
        sampling.HISTOGRAM_BITS = old
    # Uniform: over 300 seeds each of 20 rows is picked about as often.
    small = spark.range(20).select(F.col("id").alias("k"))
    picked = Counter(x for s in range(300) for x in [min((int(hashlib.md5(f"{s}:{k}".encode()).hexdigest()[:15], 16), k) for k in range(20))[1]])
    assert set(picked) == set(range(20)) and max(picked.values()) < 40
    assert sample_without_replacement(small, 1, F.col("k"), seed=5).first()["k"] == min(
        (int(hashlib.md5(f"5:{k}".encode()).hexdigest()[:15], 16), k) for k in range(20))[1]


def test_a_name_can_change_between_table_and_view(spark, scratch):
    from partsflow.schemas import TableMeta
    from partsflow.sinks.tables import register_view

    spark.range(3).write.parquet(f"{scratch}/t")
    meta = TableMeta("table_or_view", (), "three numbers", {"layer": "test"})
    for register, source in ((register_table, f"{scratch}/t"), (register_view, "SELECT 7 AS id"), (register_table, f"{scratch}/t"), (register_table, f"{scratch}/t")):
        register(spark, meta, source)
        assert spark.table("table_or_view").count() == (1 if register is register_view else 3)
    spark.sql("DROP TABLE table_or_view")
    assert spark.read.parquet(f"{scratch}/t").count() == 3
