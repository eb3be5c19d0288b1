"""Incremental (streaming) pipeline equals the batch operators."""

from conftest import SF_SMALL, rows

from partsflow.plans.batch import DIMENSIONS, Flow
from partsflow.plans.feeds import Tables
from partsflow.plans.landing import write_landing
from partsflow.plans.silver import SILVER
from partsflow.schemas import FEEDS
from partsflow.streaming.pipeline import read_dimension, run_pipeline


def test_two_runs_equal_batch(spark, scratch):
    t = Tables(spark, SF_SMALL)
    landing = f"{scratch}/landing"
    write_landing(t, landing, batches=(1,), n_files=3)
    layout = run_pipeline(spark, landing, f"{scratch}/pipe", n_buckets=8)
    # After batch 1 only inserts are applied: type 2 has one version per key.
    d1 = read_dimension(spark, layout.table("dim_part_type1"))
    d2 = read_dimension(spark, layout.table("dim_part_type2"))
    assert d1.count() == d2.count()

    write_landing(t, landing, batches=(2, 3), n_files=3)
    run_pipeline(spark, landing, f"{scratch}/pipe", n_buckets=8)

    batch = Flow(t)
    for name in SILVER:
        got = spark.read.parquet(layout.table(name))
        assert rows(got) == rows(batch.silver(name)), name
    for name in DIMENSIONS:
        got = read_dimension(spark, layout.table(name))
        assert rows(got) == rows(batch.dim(name)), name
    for name in ("fact_demand_fulfillment", "fact_work_order_completion"):
        got = spark.read.parquet(layout.table(name))
        assert rows(got) == rows(batch.fact(name)), name
    # Bronze keeps lineage and ingest time on every row.
    b = spark.read.parquet(layout.table(FEEDS["parts_cdc"].bronze.name))
    assert b.where("_source_file IS NULL OR _ingested_at IS NULL").count() == 0
    assert {r[0] for r in b.select("batch").distinct().collect()} == {1, 2, 3}


def test_rerun_without_new_files_is_a_no_op(spark, scratch):
    t = Tables(spark, SF_SMALL)
    landing = f"{scratch}/landing"
    write_landing(t, landing, n_files=2)
    layout = run_pipeline(spark, landing, f"{scratch}/pipe", n_buckets=4)
    before = rows(read_dimension(spark, layout.table("dim_customer_type2")))
    n_bronze = spark.read.parquet(layout.table("bronze_parts")).count()
    spark.conf.set("raw_data_path", landing)  # landing root from configuration
    run_pipeline(spark, None, f"{scratch}/pipe", n_buckets=4, register=True)
    spark.conf.unset("raw_data_path")
    assert rows(read_dimension(spark, layout.table("dim_customer_type2"))) == before
    assert spark.table("fact_work_order_completion").count() == \
        spark.read.parquet(layout.table("fact_work_order_completion")).count()
    assert rows(spark.sql("SELECT * FROM dim_customer_type2")) == before
    # Recovery: rebuilding the dimensions from the change log gives the same rows.
    from partsflow.streaming.pipeline import rebuild_dimensions
    incremental = {d: rows(read_dimension(spark, layout.table(d))) for d in ("dim_part_type2", "dim_customer_type1")}
    rebuild_dimensions(spark, layout)
    for d, expect in incremental.items():
        assert rows(read_dimension(spark, layout.table(d))) == expect, d
    assert spark.read.parquet(layout.table("bronze_parts")).count() == n_bronze


def test_cdc_apply_over_random_micro_batches_with_replay(spark, scratch):
    import random

    from test_cdc import SCHEMA, brute_scd

    from partsflow.operators.cdc import END_AT, START_AT, CdcSpec
    from partsflow.streaming.pipeline import CdcApply, Layout

    rnd = random.Random(21)
    rows_ = [(rnd.choice("ABCDEFGHIJ"), float(rnd.randint(1, 9)), rnd.choice(["INSERT", "UPDATE", "DELETE"]),
              rnd.randint(1, 80)) for _ in range(200)]
    rnd.shuffle(rows_)
    cuts = sorted(rnd.sample(range(1, len(rows_)), 3))
    parts = [rows_[a:b] for a, b in zip([0] + cuts, cuts + [len(rows_)])]
    layout = Layout(scratch)
    apply = CdcApply(spark, layout, "ev", CdcSpec(keys=["k"], tie_break=("updated_at",)), {"d1": 1, "d2": 2}, n_buckets=3)
    for i, chunk in enumerate(parts):
        apply(spark.createDataFrame([(*r, None) for r in chunk], SCHEMA), i)
    apply(spark.createDataFrame([(*r, None) for r in parts[1]], SCHEMA), 1)  # replayed micro-batch
    t1, t2 = brute_scd(rows_)
    d1 = read_dimension(spark, layout.table("d1"))
    d2 = read_dimension(spark, layout.table("d2"))
    assert {(r.k, r.price) for r in d1.collect()} == t1
    assert {(r.k, r.price, r[START_AT], r[END_AT]) for r in d2.collect()} == t2
    # The change log alone rebuilds the same state (recovery path).
    from partsflow.operators.cdc import scd1_state, scd2_state
    from partsflow.streaming import pipeline as P
    rebuilt = Layout(f"{scratch}/rebuilt")
    events = apply.store.change_log().drop(P.BUCKET, P.BATCH_ID)
    spec = CdcSpec(keys=["k"], tie_break=("updated_at",))
    for name, kind in (("d1", 1), ("d2", 2)):
        st = scd1_state(events, spec) if kind == 1 else scd2_state(events, spec)
        extra = [START_AT, END_AT] if kind == 2 else []
        st.select(*events.columns, "__del", *extra).write.parquet(rebuilt.table(name))
    assert rows(read_dimension(spark, rebuilt.table("d1"))) == rows(d1)
    assert rows(read_dimension(spark, rebuilt.table("d2"))) == rows(d2)


def test_batch_one_type1_equals_type2(spark, scratch):
    from partsflow.operators.cdc import END_AT, START_AT
    t = Tables(spark, SF_SMALL)
    write_landing(t, f"{scratch}/landing", batches=(1,), n_files=2)
    layout = run_pipeline(spark, f"{scratch}/landing", f"{scratch}/pipe", n_buckets=4)
    for entity in ("part", "customer"):
        d1 = read_dimension(spark, layout.table(f"dim_{entity}_type1"))
        d2 = read_dimension(spark, layout.table(f"dim_{entity}_type2"))
        assert d2.where(f"{END_AT} IS NOT NULL").count() == 0
        assert rows(d2.drop(START_AT, END_AT)) == rows(d1)


def _apply(spark, layout, chunks, n_buckets=8, dims=None, start=0):
    from partsflow.operators.cdc import CdcSpec
    from partsflow.streaming.pipeline import CdcApply

    handler = CdcApply(spark, layout, "ev", CdcSpec(keys=["k"]), dims or {"d1": 1, "d2": 2}, n_buckets)
    for i, chunk in enumerate(chunks):
        handler(spark.createDataFrame(chunk, "k string, price double, _op string, _sequence long"), start + i)


def test_cdc_state_is_safe(spark, scratch):
    import shutil

    import pytest
    from partsflow.streaming.pipeline import Layout

    layout = Layout(scratch)
    first = [(f"k{i}", 1.0, "INSERT", 1) for i in range(8)]
    second = [(f"k{i}", 2.0, "UPDATE", 2) for i in range(3)]
    _apply(spark, layout, [first, second])
    want = [rows(read_dimension(spark, layout.table(d))) for d in ("d1", "d2")]
    assert sum(want[0].values()) == 8 and sum(want[1].values()) == 11
    with pytest.raises(ValueError, match="8 buckets, not 3"):
        _apply(spark, layout, [second], n_buckets=3, start=2)
    # A lost bucket folder: reading fails, the replay brings it back.
    lost = next(p for p in (__import__("pathlib").Path(layout.dimension_store("ev"))).glob("data/*/kind=open/__bucket=*")
                if spark.read.parquet(str(p)).where("k < 'k3'").count())
    shutil.rmtree(lost)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_dimension(spark, layout.table("d2")).count()
    # A dimension added later, and one whose state is lost, come from the whole log.
    shutil.rmtree(layout.table("d1"))
    _apply(spark, layout, [second], dims={"d1": 1, "d2": 2, "d3": 2}, start=1)
    assert [rows(read_dimension(spark, layout.table(d))) for d in ("d1", "d2")] == want
    assert rows(read_dimension(spark, layout.table("d3"))) == want[1]


def test_column_of_a_later_file_reaches_bronze(spark, scratch):
    from partsflow.schemas import FEEDS as F_
    from partsflow.sources.files import read_feed
    from partsflow.streaming.pipeline import Layout, _run_available_now, stream_table
    from partsflow.sources.files import stream_feed

    layout, path = Layout(f"{scratch}/p"), f"{scratch}/landing/demand_signals"
    def load():
        _run_available_now([(stream_feed(spark, f"{scratch}/landing", "demand_signals"), layout.table("b"), layout.checkpoint("b"))])
    spark.createDataFrame([("s1",)], "signal_id string").write.parquet(path)
    load()
    spark.createDataFrame([("s2", 5)], "signal_id string, extra int").write.mode("append").parquet(path)
    load()
    got = spark.read.option("mergeSchema", "true").parquet(layout.table("b"))
    assert {(r["signal_id"], r["extra"]) for r in got.collect()} == {("s1", None), ("s2", 5)}
    assert "extra" in stream_table(spark, layout.table("b")).columns
    assert {r["extra"] for r in read_feed(spark, f"{scratch}/landing", "demand_signals").collect()} == {None, 5}


def test_hints_with_parameters():
    from partsflow.schemas import FeedSpec
    assert FeedSpec("x", None, "a STRING, b DECIMAL(12,2)").hinted == [("a", "string"), ("b", "decimal(12,2)")]
