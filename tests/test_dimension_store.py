"""The dimension store against the batch operators: splices, late events, replay, faults."""

import random
from collections import Counter
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from partsflow.operators.cdc import CdcSpec, scd1, scd2
from partsflow.sinks.commits import CommitLog
from partsflow.streaming import dimension_store as DS
from partsflow.streaming.dimension_store import CLOSED, OPEN, DimensionStore

SCHEMA = "k string, price double, _op string, _sequence long"
SPEC = CdcSpec(keys=["k"])


def frame(spark, events):
    return spark.createDataFrame(events, SCHEMA)


def check(spark, store, events):
    df = frame(spark, events)
    assert rows(store.dimension(1)) == rows(scd1(df, SPEC))
    assert rows(store.dimension(2)) == rows(scd2(df, SPEC))


@pytest.mark.parametrize("seed,fan", [(1, 8), (2, 2)])
def test_random_batches_equal_the_batch_operators(spark, scratch, monkeypatch, seed, fan):
    """In-order, late, early, equal and NULL sequences, unknown keys, deletes, replays; folds after every few batches."""
    monkeypatch.setattr(DS, "FAN", fan)
    rng = random.Random(seed)
    store, seen = DimensionStore(spark, f"{scratch}/s", SPEC, n_buckets=3), []
    for i in range(4):
        lo = rng.choice([0, 10 * i, 10 * i])
        batch = [(rng.choice("ABCDEF"), float(rng.randint(1, 4)), rng.choice(["INSERT", "UPDATE", "DELETE", None]),
                  rng.choice([None] + [rng.randint(lo, 10 * i + 12) for _ in range(12)])) for _ in range(rng.choice([1, 6, 25]))]
        assert store.apply(frame(spark, batch), i)
        seen += batch
        if i == 1:
            assert not store.apply(frame(spark, batch), i)  # the last micro-batch again
        if i % 2:
            check(spark, store, seen)
    store.apply(frame(spark, seen[:20]), 0)  # an old one again
    check(spark, store, seen)
    store.vacuum()
    check(spark, store, seen)
    assert not store.damaged()
    before = rows(store.dimension(2))
    store.rebuild()
    assert rows(store.dimension(2)) == before
    assert Counter(map(tuple, store.change_log().drop(DS.BUCKET, DS.BATCH_ID).collect())) == Counter(seen + seen[:20])


def test_a_batch_in_order_reads_no_history(spark, scratch, monkeypatch):
    monkeypatch.setattr(DS, "FAN", 3)
    store, seen, read, n_entries = DimensionStore(spark, f"{scratch}/s", SPEC, n_buckets=2), [], [], []
    for i in range(6):
        batch = [(f"k{j}", float(i), "UPDATE", 100 * i + j) for j in range(12)]
        store.apply(frame(spark, batch), i)
        seen += batch
        read.append(dict(store.read_rows))
        n_entries.append(len(store.record()["state"]))
    assert all(r[CLOSED] == 0 for r in read)  # the history has grown to 60 rows meanwhile
    assert max(r[OPEN] for r in read) <= 2 * 12  # keys, and what replaced rows wait to be folded
    assert max(n_entries) <= 2 * (3 + 2 * 3) and len(store.record()["log"]) < 5
    # A late event looks only at segments whose sequences can hold it.
    late = [("k3", 9.0, "UPDATE", 550)]
    assert store.apply(frame(spark, late), 6) is True
    assert store.read_rows[CLOSED] == 0  # after the start of k3's open row
    late2 = [("k3", 8.0, "UPDATE", 250)]
    store.apply(frame(spark, late2), 7)
    assert 0 < store.read_rows[CLOSED] < 60
    store.apply(frame(spark, [("k4", 7.0, "UPDATE", -5)]), 8)  # before all of the key: no history either
    assert store.read_rows[CLOSED] == 0
    check(spark, store, seen + late + late2 + [("k4", 7.0, "UPDATE", -5)])


def test_a_stop_before_the_switch_leaves_the_old_state(spark, scratch, monkeypatch):
    store = DimensionStore(spark, f"{scratch}/s", SPEC, n_buckets=2)
    first, second = [("a", 1.0, "INSERT", 1), ("b", 1.0, "INSERT", 1)], [("a", 2.0, "UPDATE", 2), ("c", 1.0, "INSERT", 2)]
    store.apply(frame(spark, first), 0)
    with monkeypatch.context() as m:
        def stop(self, record):
            raise KeyboardInterrupt
        m.setattr(CommitLog, "publish", stop)
        with pytest.raises(KeyboardInterrupt):
            store.apply(frame(spark, second), 1)
    check(spark, store, first)  # all data of the batch is written, none of it shows
    assert store.apply(frame(spark, second), 1)
    check(spark, store, first + second)
    assert len(store.vacuum(keep=1)) >= 2  # folders of the broken attempt
    check(spark, store, first + second)


def test_a_reader_keeps_its_version_while_a_batch_is_published(spark, scratch):
    store = DimensionStore(spark, f"{scratch}/s", SPEC, n_buckets=2)
    first, second = [("a", 1.0, "INSERT", 1)], [("a", 2.0, "UPDATE", 2)]
    store.apply(frame(spark, first), 0)
    reader = store.dimension(2)
    store.apply(frame(spark, second), 1)
    assert rows(reader) == rows(scd2(frame(spark, first), SPEC))
    check(spark, store, first + second)


def test_lost_and_damaged_buckets(spark, scratch):
    import shutil
    store = DimensionStore(spark, f"{scratch}/s", SPEC, n_buckets=4)
    events = [(f"k{i}", float(s), "UPDATE", s) for i in range(12) for s in (1, 2, 3)]
    store.apply(frame(spark, events[::2]), 0)
    store.apply(frame(spark, events[1::2]), 1)
    folder = next(Path(scratch, "s").glob("data/*/kind=closed/__bucket=*"))
    shutil.rmtree(folder)
    lost = int(folder.name.split("=")[1])
    assert store.lost() == [lost]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        store.dimension(2).count()
    assert store.repair() == [lost] and store.lost() == []
    check(spark, store, events)
    entry = next(e for e in store.record()["state"] if e["kind"] == OPEN)
    part = next(Path(store._folder(entry)).glob("*.parquet"))
    part.unlink()  # one file of a folder: counted, not noticed by its name
    assert store.lost() == [] and store.damaged() == [entry["b"]]
    store.rebuild(store.damaged())
    check(spark, store, events)


def test_writers_and_hints(spark, scratch):
    log = CommitLog(spark, f"{scratch}/c")
    assert log.latest() is None
    for v in (1, 2, 3):
        log.publish({"version": v})
    with pytest.raises(FileExistsError):  # another writer was first
        log.publish({"version": 3})
    for hint in ("1", "", "nonsense", "99"):
        log.files.write(f"{scratch}/c/_hint", hint)
        assert log.latest() == {"version": 3}
    log.forget_before(3)
    assert log.latest() == {"version": 3}
    assert not [p for p in Path(scratch, "c").iterdir() if p.name.endswith(".part")]


def test_new_columns_empty_batches_and_other_types(spark, scratch):
    store = DimensionStore(spark, f"{scratch}/s", SPEC, n_buckets=2)
    assert not store.apply(frame(spark, []), 0)
    store.apply(frame(spark, [("a", 1.0, "INSERT", 1)]), 1)
    wide = spark.createDataFrame([("a", 2.0, "UPDATE", 2, "x")], SCHEMA + ", note string")
    store.apply(wide, 2)
    assert {(r["price"], r["note"]) for r in store.dimension(2).collect()} == {(1.0, None), (2.0, "x")}
    store.apply(frame(spark, [("b", 1.0, "INSERT", 1)]), 3)  # the old schema again
    assert store.dimension(1).where("note IS NULL").count() == 1
    with pytest.raises(ValueError, match="price"):
        store.apply(spark.createDataFrame([("a", "x", "UPDATE", 3)], "k string, price string, _op string, _sequence long"), 4)
    with pytest.raises(ValueError, match="2 buckets, not 5"):
        DimensionStore(spark, f"{scratch}/s", SPEC, n_buckets=5).apply(wide, 5)


def test_a_large_bucket_is_written_by_several_tasks(spark, scratch):
    store = DimensionStore(spark, f"{scratch}/s", SPEC, n_buckets=1)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store.apply(spark.range(40_000).select(F.concat(F.lit("k"), "id").alias("k"), F.rand(1).alias("price"), F.lit("INSERT").alias("_op"), F.lit(1).cast("long").alias("_sequence")), 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(list(Path(scratch, "s").glob("data/*/kind=open/__bucket=0/*.parquet"))) > 1
    assert store.dimension(1).count() == 40_000


def test_views_read_the_newest_commit(spark, scratch):
    from partsflow.schemas import TableMeta
    from partsflow.sinks.tables import register_view
    store = DimensionStore(spark, f"{scratch}/s", SPEC, n_buckets=2)
    events = [[("a", 1.0, "INSERT", 1), ("b", 1.0, "INSERT", 1), ("c", 1.0, "INSERT", 1)], [("a", 2.0, "UPDATE", 9), ("b", 3.0, "DELETE", 9)],
              [("a", 5.0, "UPDATE", 4), ("d", 1.0, "INSERT", 2)]]
    for i, batch in enumerate(events):
        store.apply(frame(spark, batch), i)
    store.apply(spark.createDataFrame([("e", 2.0, "UPDATE", 2, "x")], SCHEMA + ", note string"), 3)
    for scd_type in (1, 2):
        register_view(spark, TableMeta(f"view_of_type{scd_type}", (), "it's a view", {"layer": "dimension"}), store.select_sql(scd_type))
        assert rows(spark.table(f"view_of_type{scd_type}")) == rows(store.dimension(scd_type))
    described = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE EXTENDED view_of_type2").collect()}
    assert described["Comment"] == "it's a view" and "layer=dimension" in described["Table Properties"]
    for scd_type in (1, 2):
        spark.sql(f"DROP VIEW view_of_type{scd_type}")
