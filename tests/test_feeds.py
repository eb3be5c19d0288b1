"""The feeds over rows of their own."""

import datetime

from conftest import rows

from partsflow.plans import values as V
from partsflow.plans.batch import Flow
from partsflow.plans.feeds import Tables


def part_table(spark, root, n=140):
    parts = [(k, f"part {k}", f"Brand#{k % 5}", "PROMO BRUSHED TIN", 1, 900.0 + k) for k in range(n)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{root}/part.parquet")
    return Tables(spark, root)


def test_subcategory_and_part_number_follow_the_category(spark, scratch):
    flow = Flow(part_table(spark, scratch))
    got = flow.feed("parts_cdc").collect()
    assert {r["batch"] for r in got} == {1, 2, 3}  # inserts and both batches of updates
    for r in got:
        k = int(r["part_id"][5:])
        category = V.PART_CATEGORIES[k % 10]
        subs = V.PART_SUBCATS[category]
        assert r["subcategory"].upper() == subs[k % len(subs)], r
        assert r["part_number"] == f"PW-{category[:3]}-{k:05d}", r
    for r in flow.silver("silver_parts").collect():
        assert r["subcategory"] in V.PART_SUBCATS[r["category"]], r


def test_a_query_lands_only_the_feeds_that_it_reads(spark, scratch):
    import os

    import __spark_entry__ as E
    from partsflow.plans.landing import landing_for
    from partsflow.schemas import FEEDS

    part_table(spark, scratch)  # no other table is there
    got = E.queries()["q_part_current"](spark, scratch)
    assert got.count() > 0
    root = landing_for(spark, scratch, [])
    landed = lambda: sorted(n for n in os.listdir(root) if n in FEEDS)
    assert landed() == ["parts_cdc"]
    events = [(e, datetime.datetime(2024, 1, 1 + e % 28), e % 7, "x", float(e), None) for e in range(60)]
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{scratch}/events.parquet")
    assert landing_for(spark, scratch, ["demand_signals"]) == root and landed() == ["demand_signals", "parts_cdc"]
    assert rows(spark.read.parquet(f"{root}/demand_signals")) == rows(Flow(Tables(spark, scratch)).feed("demand_signals"))


def test_lines_of_an_order_land_side_by_side(spark, scratch):
    from pathlib import Path

    from partsflow.plans.landing import landing_for

    day = datetime.datetime(2024, 1, 5)
    lines = [((i * 37) % 90, i % 11, i % 5, i // 90 + 1, 3.0, 10.5, 0.05, 0.01, "N", "F", day) for i in range(270)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
                                 "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz").coalesce(1).write.parquet(f"{scratch}/lineitem.parquet")
    root = landing_for(spark, scratch, ["invoices", "receivers"])
    plain = Flow(Tables(spark, scratch))
    for feed in ("invoices", "receivers"):
        landed = spark.read.parquet(f"{root}/{feed}")
        assert rows(landed) == rows(plain.feed(feed)) and landed.count() == 270
        for file in Path(root, feed).glob("*.parquet"):
            ids = [r[0] for r in spark.read.parquet(str(file)).select("po_id").collect()]
            assert ids == sorted(ids)
