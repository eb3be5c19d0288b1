"""Silver validity predicates and projections on hand-made edge rows."""

from decimal import Decimal

from pyspark.sql import functions as F

from partsflow.operators.clean import clean
from partsflow.plans.silver import SILVER


def _parts(spark, rows):
    cols = ("part_id string, part_number string, part_name string, category string, subcategory string, "
            "piece_part_price double, standard_cost double, lead_time_days bigint, supplier_id string, "
            "unit_of_measure string, is_active boolean, _op string, _sequence bigint, updated_at timestamp_ntz")
    return spark.createDataFrame(rows, cols)


def _part(pid, price=1.0, op="INSERT", name="n", cat="C", unit="EA", active=True):
    return (pid, "PN", name, cat, "s", price, 1.0, 7, "S", unit, active, op, 1, None)


def test_parts_predicate_three_valued(spark):
    rows = [_part(None), _part("neg", price=-1.0), _part("null", price=None), _part("zero", price=0.0),
            _part("lower", op="insert"), _part("trunc", op="TRUNCATE"), _part("nullop", op=None),
            _part("del_nullprice", price=None, op="DELETE"), _part("ok", op="UPDATE")]
    got = {r.part_id for r in clean(_parts(spark, rows), SILVER["silver_parts"]).collect()}
    assert got == {"zero", "ok"}


def test_parts_projection_defaults_and_normalisation(spark):
    rows = [_part("p", name=" \tpadded  ", cat="  window_hardware ", unit=None, active=None, price=1.005)]
    r = clean(_parts(spark, rows), SILVER["silver_parts"]).collect()[0]
    assert r.part_name == "\tpadded"           # spaces trimmed, tab kept
    assert r.category == "WINDOW_HARDWARE"
    assert r.unit_of_measure == "EA" and r.is_active is True
    assert r.piece_part_price == Decimal("1.01")  # HALF_UP on the decimal text
    assert r.lead_time_days == 7 and isinstance(r.lead_time_days, int)


def test_receivers_filter_runs_before_upper(spark):
    cols = ("receiver_id string, po_id string, part_id string, received_date date, received_qty bigint, "
            "warehouse_location string, quality_status string, inspector_id string, created_at timestamp_ntz")
    rows = [("r1", "p", "x", None, 3, "w", "rejected", "i", None),
            ("r2", "p", "x", None, 3, "w", "REJECTED", "i", None),
            ("r3", "p", "x", None, 3, "w", None, "i", None),
            ("r4", "p", "x", None, 0, "w", "ACCEPTED", "i", None)]
    got = {(r.receiver_id, r.quality_status)
           for r in clean(spark.createDataFrame(rows, cols), SILVER["silver_receivers"]).collect()}
    assert got == {("r1", "REJECTED")}


def test_po_total_uses_raw_price(spark):
    cols = ("po_id string, signal_id string, part_id string, supplier_id string, po_date date, "
            "expected_receipt_date date, ordered_qty bigint, unit_price double, po_status string, "
            "buyer_id string, created_at timestamp_ntz")
    rows = [("po", "s", "p", "x", None, None, 3, 1.005, "open", "b", None)]
    r = clean(spark.createDataFrame(rows, cols), SILVER["silver_purchase_orders"]).collect()[0]
    assert r.unit_price == Decimal("1.01") and r.po_total_value == Decimal("3.01")  # 3 * 1.005 = 3.0149.. as DOUBLE
    assert r.po_status == "OPEN"


def test_demand_variance_and_labor_negative_remaining(spark):
    cols = ("signal_id string, part_id string, forecast_date date, forecasted_qty bigint, actual_qty bigint, "
            "signal_type string, confidence_score double, region string, created_at timestamp_ntz")
    rows = [("s1", "p", None, 10, None, "T", 0.5, "west", None), ("s2", "p", None, 0, 3, "T", 0.5, "w", None),
            ("s3", "p", None, 10, 7, "T", 0.12345, "west", None)]
    got = {r.signal_id: (r.forecast_variance, r.confidence_score, r.region)
           for r in clean(spark.createDataFrame(rows, cols), SILVER["silver_demand_signals"]).collect()}
    assert got == {"s1": (None, Decimal("0.5000"), "west"), "s3": (-3, Decimal("0.1235"), "west")}
    cols = ("schedule_id string, technician_id string, technician_name string, schedule_date date, "
            "available_hours double, booked_hours double, region string, skill_level string, "
            "created_at timestamp_ntz")
    rows = [("a", "t", " T ", None, 4.0, 5.5, "west", "S", None), ("b", "t", "T", None, -1.0, 0.0, "w", "S", None)]
    out = clean(spark.createDataFrame(rows, cols), SILVER["silver_labor_schedules"]).collect()
    assert [(r.schedule_id, r.remaining_hours, r.region, r.technician_name) for r in out] == \
        [("a", Decimal("-1.50"), "WEST", "T")]


def test_filter_is_pushed_to_parquet_scan(spark, scratch):
    import contextlib
    import io
    import re
    path = f"{scratch}/parts"
    _parts(spark, [_part("a"), _part("b", price=-2.0)]).write.parquet(path)
    df = clean(spark.read.parquet(path), SILVER["silver_parts"])
    buf = io.StringIO()
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    with contextlib.redirect_stdout(buf):
        df.explain()
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", buf.getvalue()).group(1)
    for f in ("IsNotNull(part_id)", "IsNotNull(piece_part_price)", "GreaterThanOrEqual(piece_part_price,0.0)",
              "In(_op, [DELETE,INSERT,UPDATE])"):
        assert f in pushed, pushed
    assert {r.part_id for r in df.collect()} == {"a"}
    assert df.where(F.col("part_id") == "a").count() == 1


def test_quantity_predicates_reach_the_scan_of_landed_files(spark):
    import re

    from conftest import SF_SMALL
    from partsflow.plans.batch import Flow
    from partsflow.plans.feeds import Tables
    from partsflow.plans.landing import landing_for

    flow = Flow(Tables(spark, SF_SMALL), landing=lambda: landing_for(spark, SF_SMALL))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    for name, column in (("silver_demand_signals", "forecasted_qty"), ("silver_purchase_orders", "ordered_qty"), ("silver_receivers", "received_qty")):
        plan = flow.silver(name)._jdf.queryExecution().executedPlan().toString()
        assert f"GreaterThan({column},0" in re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan).group(1), plan


def test_fractions_tell_wrong_roundings_apart(spark):
    """In the registered rows each other way to round changes some."""
    from conftest import SF_SMALL
    from partsflow.plans import fractions

    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    raw = lines.select(F.expr("concat('PO-', l_orderkey, '-', l_linenumber)").alias("po_id"), (F.col("l_quantity") * F.col("l_discount")).alias("q"),
                       (F.col("l_extendedprice") * F.col("l_tax")).alias("p"))
    po = fractions.purchase_orders(lines).join(raw, "po_id")
    differ = lambda x: po.where(x).count() > 0
    assert differ(F.col("ordered_qty") != F.round("q"))  # C6 cuts
    assert differ(F.col("unit_price") != (F.floor(F.col("p") * 100) / 100).cast("decimal(12,2)"))  # C5 rounds
    assert differ(F.col("po_total_value") != (F.col("ordered_qty") * F.col("unit_price")).cast("decimal(14,2)"))  # C9: the raw price
    labor = fractions.labor_schedules(lines)
    assert labor.where("remaining_hours != available_hours - booked_hours").count() > 0  # C10: rounded once
    assert labor.where("remaining_hours < 0").count() > 0


def test_rows_of_one_clustering_key_go_to_several_files(spark, scratch):
    from pathlib import Path

    from partsflow.sinks.tables import clustered

    df = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, F.lit("one")).otherwise(F.col("id").cast("string")).alias("k"), "id")
    clustered(df, ["k"], n_files=8).write.parquet(f"{scratch}/t")
    sizes = [spark.read.parquet(str(p)).where("k = 'one'").count() for p in Path(scratch, "t").glob("*.parquet")]
    assert sum(sizes) == 10_000 and max(sizes) < 5_000
