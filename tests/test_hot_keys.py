"""Frequent keys kept beside tables, and joins and histories that spread them."""

import random
from collections import Counter

import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from partsflow.operators.cdc import END_AT, START_AT, CdcSpec, scd2, scd2_state
from partsflow.operators.hot_keys import NAME, HotKeys
from partsflow.operators.joins import left_join
from partsflow.plans.batch import Flow
from partsflow.plans.feeds import Tables
from partsflow.schemas import TableMeta
from partsflow.sinks.tables import write_table

META = TableMeta("t", ("id",), "test", {}, (("k",), ("a", "d")))


def table(spark, n=30_000, hot="hot"):
    """A third of the rows have one key, others five rows each; some keys are null."""
    i = F.col("id")
    return spark.range(n).select(
        i, F.when(i % 3 == 0, F.lit(hot)).when(i % 100 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), (i / 5).cast("int"))).alias("k"),
        F.when(i % 4 == 0, F.lit(7)).otherwise(i.cast("int")).alias("a"), F.when(i % 4 == 0, F.lit("2025-01-02")).otherwise(F.lit("2025-01-03")).cast("date").alias("d"))


def test_keys_are_found_while_the_table_is_written(spark, scratch):
    write_table(table(spark), f"{scratch}/t", META)
    keys = HotKeys(spark, f"{scratch}/t")
    assert keys.rows == 30_000 and keys.over(["k"], 1000) == [(["hot"], 10_000)]
    assert keys.over(["a", "d"], 1000) == [(["7", "2025-01-02"], 7500)]
    stored = spark.read.parquet(f"{scratch}/t")
    [hot] = keys.buckets(stored, ["a", "d"], 1000).collect()
    assert tuple(hot) == (7, __import__("datetime").date(2025, 1, 2), 8)
    assert keys.buckets(stored, ["k"]) is None  # none over MIN_CHUNK
    assert keys.over(["other"], 0) == [] and HotKeys(spark, f"{scratch}/none").over(["k"], 0) == []
    assert stored.count() == 30_000  # the note is no part of the data


def test_appends_merge_and_an_overwrite_forgets(spark, scratch):
    path = f"{scratch}/t"
    write_table(table(spark, hot="first"), path, META)
    write_table(table(spark, 6000, "second"), path, META, mode="append")
    write_table(table(spark, 6000, "first"), path, META, mode="append")
    keys = HotKeys(spark, path)
    assert keys.rows == 42_000 and keys.over(["k"], 1500) == [(["first"], 12_000), (["second"], 2000)]
    write_table(table(spark, 3000, "third"), path, META)
    assert HotKeys(spark, path).over(["k"], 500) == [(["third"], 1000)]
    write_table(table(spark, 0), path, META)
    assert HotKeys(spark, path).over(["k"], 0) == []
    table(spark, 30).write.mode("overwrite").parquet(path)  # by another writer: no stale keys stay
    import os
    assert not os.path.exists(f"{path}/{NAME}")


def largest_share(df):
    counts = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(counts) / sum(counts)


@pytest.fixture()
def no_coalescing(spark):
    for name in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.autoBroadcastJoinThreshold"):
        spark.conf.set(name, "-1" if "Threshold" in name else "false")
    yield
    from partsflow.session import apply_engine_conf
    apply_engine_conf(spark)


def test_a_hot_right_key_spreads_over_tasks(spark, scratch, no_coalescing):
    write_table(table(spark).select("id", "k", "a", "d"), f"{scratch}/t", META)
    right = spark.read.parquet(f"{scratch}/t").select(F.col("k").alias("rk"), F.col("id").alias("rid"))
    left = spark.createDataFrame([("hot", 1), ("hot", 2), ("k7", 3), ("absent", 4), (None, 5)], "lk string, lid int")
    hot = HotKeys(spark, f"{scratch}/t").buckets(spark.read.parquet(f"{scratch}/t"), ["k"], 500)
    plain = left_join(left, right, [("lk", "rk")], chunk=None)
    spread = left_join(left, right, [("lk", "rk")], chunk=None, spread_by=["rid"], hot=hot)
    assert rows(spread) == rows(plain) and plain.count() > 20_000
    assert largest_share(plain) > 0.9  # one task computes the hot key
    assert largest_share(spread) < 0.4  # 20 buckets over 8 tasks


def test_building_facts_starts_no_job(spark, scratch):
    flow = Flow(Tables(spark, SF_SMALL), store=f"{scratch}/flow", join_chunk=3)
    for name in ("silver_parts", "silver_customers"):
        flow.silver(name)
    for dim in ("dim_part_type1", "dim_part_type2", "dim_customer_type1"):
        flow.dim(dim)
    for t in ("purchase_orders", "demand_signals", "receivers", "invoices", "work_orders", "customer_quotes", "labor_schedules"):
        flow.silver(f"silver_{t}")
    spark.sparkContext.setJobGroup("facts", "facts")
    built = {n: flow.fact(n) for n in ("fact_demand_fulfillment", "fact_work_order_completion")}
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("facts")) == []
    spark.sparkContext.setJobGroup("other", "other")
    plain = Flow(Tables(spark, SF_SMALL))
    for name, fact in built.items():
        assert "__lsalt" in fact._jdf.queryExecution().analyzed().toString()  # some keys of the feeds are over 3 rows
        assert rows(fact) == rows(plain.fact(name)), name
    assert rows(flow.dim("dim_part_type2")) == rows(plain.dim("dim_part_type2"))


def test_a_key_with_half_of_the_events_is_no_task_of_its_own(spark, no_coalescing):
    rng = random.Random(2)
    spec = CdcSpec(keys=["k"], shifts=(6, 12))
    # the hot key has late repeats of its sequences, too
    ev = [("hot", float(i % 9), rng.choice(["UPDATE", "UPDATE", "DELETE"]), rng.randrange(4000)) for i in range(4000)]
    ev += [(f"k{rng.randrange(400)}", float(i % 5), "UPDATE", rng.choice([None, *range(60)])) for i in range(4000)]
    df = spark.createDataFrame(ev, "k string, price double, _op string, _sequence long").repartition(6)
    hot = spark.createDataFrame([("hot", 4)], "__hk0 string, __buckets int")
    assert rows(scd2(df, spec, hot)) == rows(scd2(df, spec))
    held = scd2_state(df, spec, hot).where("k = 'hot'")
    assert largest_share(held) < 0.5 and largest_share(scd2_state(df, spec).where("k = 'hot'")) == 1.0
    assert Counter(r[START_AT] for r in held.collect()).most_common(1)[0][1] == 1 and held.where(F.col(END_AT).isNull()).count() == 1
