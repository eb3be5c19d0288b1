"""Files of one feed that give a column different types."""

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partsflow.sources.files import RESCUED, common_type, read_feed, schema_groups, stream_feed
from partsflow.streaming.pipeline import Layout, _run_available_now

FEED = "purchase_orders"


def land(spark, root, values, kind, sub="", extra=None):
    df = spark.createDataFrame([(f"{kind}{i}", v) for i, v in enumerate(values)], f"po_id string, ordered_qty {kind}")
    if extra:
        df = df.withColumn(extra, F.lit(kind))
    df.coalesce(1).write.mode("append").parquet(f"{root}/{FEED}{sub}")


def test_int_bigint_double_and_text_are_read_together(spark, scratch):
    land(spark, scratch, [1, None], "int")
    land(spark, scratch, [2, 3_000_000_000], "bigint", extra="note")
    land(spark, scratch, [4.9, None], "double")
    land(spark, scratch, ["5", "many", None], "string")
    land(spark, scratch, [6], "bigint")
    got = read_feed(spark, scratch, FEED)
    assert dict(got.dtypes)["ordered_qty"] == "int" and {"_source_file", "_ingested_at", "note", "unit_price"} <= set(got.columns)
    found = {(r["po_id"], r["ordered_qty"], (r[RESCUED] or {}).get("ordered_qty")) for r in got.collect()}
    assert found == {("int0", 1, None), ("int1", None, None), ("bigint0", 2, None), ("bigint1", None, "3000000000"), ("double0", 4, None),
                     ("double1", None, None), ("string0", 5, None), ("string1", None, "many"), ("string2", None, None), ("bigint0", 6, None)}
    assert got.count() == 10 and got.where("_source_file IS NULL OR _ingested_at IS NULL").count() == 0
    assert len(schema_groups(spark, f"{scratch}/{FEED}")) == 4
    assert rows(read_feed(spark, scratch, FEED, metadata=False, raw="ordered_qty > 4").select("po_id")) == rows(
        spark.createDataFrame([("string0",), ("bigint0",)], "po_id string"))


def test_feeds_that_agree_are_read_as_before(spark, scratch):
    land(spark, scratch, [1], "bigint")
    land(spark, scratch, [2], "bigint", extra="note")
    got = read_feed(spark, scratch, FEED)
    assert RESCUED not in got.columns and got.count() == 2


def test_partition_columns_stay(spark, scratch):
    for batch, kind in ((1, "int"), (2, "bigint")):
        spark.createDataFrame([("p", 7)], f"part_id string, lead_time_days {kind}").write.parquet(f"{scratch}/parts_cdc/batch={batch}")
    got = read_feed(spark, scratch, "parts_cdc")
    assert {(r["part_id"], r["lead_time_days"], r["batch"]) for r in got.collect()} == {("p", 7, 1), ("p", 7, 2)}


def test_a_stream_widens_and_names_what_it_cannot(spark, scratch):
    land(spark, scratch, [1, 2], "int")
    land(spark, scratch, [3], "bigint")
    layout = Layout(f"{scratch}/pipe")

    def load():
        _run_available_now([(stream_feed(spark, scratch, FEED), layout.table("b"), layout.checkpoint("b"))])

    load()
    land(spark, scratch, [4], "int")
    load()
    assert sorted(r["ordered_qty"] for r in spark.read.parquet(layout.table("b")).collect()) == [1, 2, 3, 4]
    land(spark, scratch, ["x"], "string")
    with pytest.raises(ValueError, match="ordered_qty is"):
        stream_feed(spark, scratch, FEED)


def test_common_types():
    i, n, d, f, s = T.IntegerType(), T.LongType(), T.DoubleType(), T.FloatType(), T.StringType()
    assert [common_type(x) for x in ([i], [i, n], [i, d], [f, n], [i, s], [T.DateType(), T.TimestampNTZType()], [T.BooleanType(), i])] == \
        [i, n, d, d, s, T.TimestampNTZType(), s]
