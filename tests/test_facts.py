"""Fact grain and skew handling on the real feeds."""

from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from partsflow.plans.batch import Flow
from partsflow.plans.feeds import Tables


def test_facts_equal_with_hot_key_salting(spark):
    t = Tables(spark, SF_SMALL)
    plain, salted = Flow(t), Flow(t, join_chunk=2)  # every key with > 2 rows is split
    for name in ("fact_demand_fulfillment", "fact_work_order_completion"):
        assert rows(salted.fact(name)) == rows(plain.fact(name)), name


def test_demand_fact_grain_is_po_x_receipt_x_invoice(spark):
    f = Flow(Tables(spark, SF_SMALL))
    fact = f.fact("fact_demand_fulfillment")
    po = f.silver("silver_purchase_orders")
    r = f.silver("silver_receivers").groupBy("po_id").agg(F.count(F.lit(1)).alias("nr"))
    i = f.silver("silver_invoices").groupBy("po_id").agg(F.count(F.lit(1)).alias("ni"))
    expect = (po.join(r, "po_id", "left").join(i, "po_id", "left")
              .select(F.sum(F.greatest(F.coalesce("nr", F.lit(1)), F.lit(1))
                            * F.greatest(F.coalesce("ni", F.lit(1)), F.lit(1))).alias("n")).first().n)
    assert fact.count() == expect
    # every PO appears; signal_id comes from the signal side (NULL when missing)
    assert fact.select("po_id").distinct().count() == po.count()
    assert fact.where(F.col("signal_id").isNull()).count() > 0


def test_run_batch_materialises_every_stage(spark, scratch):
    from partsflow.plans.batch import run_batch
    paths = run_batch(spark, SF_SMALL, f"{scratch}/tables")
    assert len(paths) == 9 + 4 + 2
    flow = Flow(Tables(spark, SF_SMALL))
    for name in ("dim_part_type2", "fact_work_order_completion"):
        stored = spark.read.parquet(paths[name])
        computed = flow.dim(name) if name.startswith("dim") else flow.fact(name)
        assert rows(stored) == rows(computed), name


def test_point_lookups(spark):
    from partsflow.plans import analytics as A
    flow = Flow(Tables(spark, SF_SMALL))
    d1, d2 = flow.dim("dim_part_type1"), flow.dim("dim_part_type2")
    hist = A.part_history(d2, ["PART-00180"]).collect()
    # part 180: insert, late cost restatement (arrives last), price update -> three versions
    assert [r["__START_AT"] for r in hist] == [181, 500_000_000_181, 1_000_000_000_181]
    assert [r["__END_AT"] for r in hist] == [500_000_000_181, 1_000_000_000_181, None]
    cur = A.part_current(d1, ["PART-00180"]).collect()
    assert len(cur) == 1 and cur[0].piece_part_price == hist[-1].piece_part_price
    # part 0: its insert is spoiled (NULL price, lower-case op), so it first appears by its update
    h0 = A.part_history(d2, ["PART-00000"]).collect()
    assert [(r["__START_AT"], r["__END_AT"]) for r in h0] == [(1_000_000_000_001, None)]
    # part 7: deleted then re-inserted -> two versions, the first closed by the delete
    h7 = A.part_history(d2, ["PART-00007"]).collect()
    assert len(h7) == 2 and h7[0]["__END_AT"] < h7[1]["__START_AT"]


def test_dimensions_join_the_root_before_the_fan_out(spark):
    """A sort-merge join with a large dimension moves the root's rows, not receipts x invoices."""
    from partsflow.operators.clean import clean
    from partsflow.plans import facts as FX
    from partsflow.plans.batch import DIMENSIONS, apply_cdc
    from partsflow.plans.silver import SILVER
    from partsflow.schemas import FEEDS, SILVER_SOURCE

    s = {name: clean(spark.createDataFrame([], FEEDS[SILVER_SOURCE[name]].hints), SILVER[name]) for name in SILVER}
    dim = {name: apply_cdc(s[source], spec, kind) for name, (source, spec, kind) in DIMENSIONS.items()}
    demand = FX.fact_demand_fulfillment(s["silver_purchase_orders"], s["silver_demand_signals"], s["silver_receivers"], s["silver_invoices"], dim["dim_part_type1"])
    work = FX.fact_work_order_completion(s["silver_work_orders"], s["silver_customer_quotes"], s["silver_labor_schedules"], dim["dim_part_type1"], dim["dim_customer_type1"])
    for fact, dims, sides in ((demand, ["dp__part_id"], ["r__po_id", "inv__po_id"]), (work, ["dp__part_id", "dc__customer_id"], ["q__wo_id", "ls__technician_id"])):
        joins = [line for line in fact._jdf.queryExecution().analyzed().toString().splitlines() if "Join LeftOuter" in line]
        at = lambda key: next(i for i, line in enumerate(joins) if f"{key}#" in line)
        assert min(map(at, dims)) > max(map(at, sides)), joins  # outer joins stand first
