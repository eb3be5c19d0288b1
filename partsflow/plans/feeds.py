"""Feed builders: the nine landing feeds derived from the given tables.

Each builder is a narrow Spark job over one source table (plus a lookup join
on the part catalogue where a price is needed).  Every derived value is an
integer-arithmetic function of the row's keys (see ``functions.scalar.mix``),
so the feeds are reproducible by any SQL engine and grow with the inputs:

========================  =================================================
feed                      derived from
========================  =================================================
parts_cdc                 ``part``  (insert, update, delete, re-insert, late)
customers_cdc             ``customer ⋈ nation ⋈ region``
demand_signals            ``events``
purchase_orders           ``orders`` (+ part price)
receivers                 ``lineitem``
invoices                  ``lineitem``
work_orders               ``orders ⋈ customer ⋈ nation ⋈ region``
customer_quotes           ``orders`` (1-3 quotes per order, + part price)
labor_schedules           ``events``
========================  =================================================

Multi-event rows (CDC) come from ``explode`` over a small fixed array of event
kinds: one scan, no union, no join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partsflow.functions.scalar import (cents, code, days_before, element, from_cents, idiv, mix, pick,
                                        scale_half_up, ts_ntz, zpad)
from partsflow.plans import values as V

SEQ_UPDATE = 1_000_000_000_000
SEQ_DELETE = 2_000_000_000_000
SEQ_REINSERT = 3_000_000_000_000
SEQ_LATE = 500_000_000_000


class Tables:
    """Lazy access to the given parquet tables of one scale-factor folder.

    A source that yields fewer scan splits than the session's default
    parallelism (a small file with a single row group) is spread round-robin
    over that many partitions, so the narrow feed pipelines use every core.
    Large sources already have at least that many splits and are read as
    they are -- the extra exchange only ever moves small inputs.

    ``order`` names columns by which the rows of a table are sorted inside each task.
    """

    def __init__(self, spark: SparkSession, root: str, spread: bool = True, order: dict[str, tuple[str, ...]] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.spread = spread
        self.order = order or {}
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:
            df = self.spark.read.parquet(f"{self.root}/{name}.parquet")
            if self.spread:
                want = self.spark.sparkContext.defaultParallelism
                if df.rdd.getNumPartitions() < want:
                    df = df.repartition(want)
            if name in self.order:
                df = df.sortWithinPartitions(*self.order[name])
            self._cache[name] = df
        return self._cache[name]

    def n_parts(self) -> Column:
        """Scalar subquery: number of catalogue parts (part keys are dense)."""
        return self.part.select(F.count(F.lit(1))).scalar()

    def n_technicians(self) -> Column:
        """Scalar subquery: technicians are the event users 0..max(user_id)."""
        return self.events.select(F.max("user_id") + F.lit(1)).scalar()


# ---------------------------------------------------------------------------
# shared rules (pure functions of a key)
# ---------------------------------------------------------------------------
def lead_time_of(part_key: Column) -> Column:
    """Lead time in days of a catalogue part, weighted over the fixed list."""
    return pick(mix(part_key, 7919, 13, 100), [(b, v) for b, v in V.cumulative(V.LEAD_TIMES)],
                V.LEAD_TIMES[-1][0]).cast("bigint")


def fmt_part(part_key: Column) -> Column:
    return code("PART-", part_key, 5)


def _subcategory(k: Column) -> Column:
    cat_i = F.pmod(k, F.lit(len(V.PART_CATEGORIES)))
    expr = None
    for i, cat in enumerate(V.PART_CATEGORIES):
        subs = V.PART_SUBCATS[cat]
        val = element(subs, F.pmod(k, F.lit(len(subs))))
        expr = F.when(cat_i == i, val) if expr is None else expr.when(cat_i == i, val)
    return expr


# ---------------------------------------------------------------------------
# parts_cdc
# ---------------------------------------------------------------------------
def parts_cdc(t: Tables) -> DataFrame:
    """Part change events.  Kinds: 0 insert, 1 duplicate insert, 2 price
    update, 3 delete, 4 re-insert after delete, 5 late cost restatement."""
    k = F.col("p_partkey")
    kind = F.col("kind")
    base = cents("p_retailprice")
    cat = element(V.PART_CATEGORIES, F.pmod(k, F.lit(10)))
    applies = (F.when(kind == 0, True)
               .when(kind == 1, F.pmod(k, F.lit(40)) == 0)
               .when(kind == 2, F.pmod(k, F.lit(6)) == 0)
               .when(kind == 3, F.pmod(k, F.lit(50)) == 7)
               .when(kind == 4, F.pmod(k, F.lit(100)) == 7)
               .otherwise(F.pmod(k, F.lit(35)) == 5))
    price_c = (F.when(kind == 2, F.when(F.pmod(k, F.lit(4)) != 0, scale_half_up(base, 130))
                      .otherwise(scale_half_up(base, 90)))
               .when(kind == 4, base + F.lit(100))
               .otherwise(base))
    price_null = (((kind <= 1) & (F.pmod(k, F.lit(97)) == 0))
                  | ((kind == 3) & (F.pmod(k, F.lit(150)) == 57)))
    cost_c = scale_half_up(base, mix(k, 31, 7, 30) + F.lit(55))
    cost_c = F.when(kind == 5, scale_half_up(cost_c, 110)).otherwise(cost_c)
    seq = (k + F.lit(1) + F.when(kind == 2, F.lit(SEQ_UPDATE)).when(kind == 3, F.lit(SEQ_DELETE))
           .when(kind == 4, F.lit(SEQ_REINSERT)).when(kind == 5, F.lit(SEQ_LATE))
           .otherwise(F.lit(0)))
    op = (F.when(kind <= 1, F.when(F.pmod(k, F.lit(89)) == 0, F.lit("insert")).otherwise(F.lit("INSERT")))
          .when(kind == 3, F.lit("DELETE")).when(kind == 4, F.lit("INSERT"))
          .otherwise(F.lit("UPDATE")))
    updated = (F.when(kind <= 1, days_before("2025-07-04", mix(k, 7919, 3, 179) + F.lit(1)))
               .when(kind == 2, days_before("2025-12-31", mix(k, 31, 11, 29) + F.lit(1)))
               .when(kind == 3, days_before("2025-12-31", mix(k, 37, 1, 29) + F.lit(1)))
               .when(kind == 4, F.lit("2025-12-31").cast("date"))
               .otherwise(days_before("2025-10-01", mix(k, 13, 2, 30))))
    batch = F.when(kind <= 1, F.lit(1)).when(kind == 5, F.lit(3)).otherwise(F.lit(2))
    category = F.when(F.pmod(k, F.lit(11)) == 3, F.lower(F.concat(F.lit(" "), cat, F.lit(" ")))).otherwise(cat)
    subcat = _subcategory(k)
    name = F.concat(F.col("p_name"), F.lit(" #"), k.cast("string"))
    return (t.part.select("p_partkey", "p_name", "p_retailprice")
            .withColumn("kind", F.explode(F.array(*[F.lit(i) for i in range(6)])))
            .where(applies)
            .select(
                fmt_part(k).alias("part_id"),
                F.concat(F.lit("PW-"), F.substring(cat, 1, 3), F.lit("-"), zpad(k, 5)).alias("part_number"),
                F.when(F.pmod(k, F.lit(13)) == 5, F.concat(F.lit("  "), name, F.lit("  ")))
                .otherwise(name).alias("part_name"),
                category.alias("category"),
                F.when(F.pmod(k, F.lit(7)) == 2, F.lower(subcat)).otherwise(subcat).alias("subcategory"),
                F.when(price_null, F.lit(None)).otherwise(from_cents(price_c)).alias("piece_part_price"),
                from_cents(cost_c).alias("standard_cost"),
                lead_time_of(k).alias("lead_time_days"),
                code("SUPP-", F.pmod(k, F.lit(V.N_SUPPLIERS)) + F.lit(1), 3).alias("supplier_id"),
                F.when(F.pmod(k, F.lit(41)) == 0, F.lit(None).cast("string"))
                .otherwise(pick(mix(k, 104729, 7, 100), V.cumulative(V.UNITS), "FT")).alias("unit_of_measure"),
                F.when(F.pmod(k, F.lit(43)) == 0, F.lit(None).cast("boolean")).otherwise(F.lit(True)).alias("is_active"),
                op.alias("_op"),
                seq.cast("bigint").alias("_sequence"),
                ts_ntz(updated).alias("updated_at"),
                batch.alias("batch"),
            ))


# ---------------------------------------------------------------------------
# customers_cdc
# ---------------------------------------------------------------------------
def _tier(k: Column) -> Column:
    return pick(mix(k, 7919, 17, 100), V.cumulative(V.CUSTOMER_TIERS), "ENTERPRISE")


def _tier_upgrade(tier: Column) -> Column:
    expr = None
    for src, dst in V.TIER_UPGRADE.items():
        expr = F.when(tier == src, F.lit(dst)) if expr is None else expr.when(tier == src, F.lit(dst))
    return expr


def customers_cdc(t: Tables) -> DataFrame:
    """Customer change events.  Kinds: 0 insert, 1 tier upgrade, 2 address
    change, 3 delete, 4 exact duplicate of a tier upgrade."""
    k = F.col("c_custkey")
    kind = F.col("kind")
    applies = (F.when(kind == 0, True)
               .when(kind == 1, F.pmod(k, F.lit(8)) == 0)
               .when(kind == 2, F.pmod(k, F.lit(8)) == 4)
               .when(kind == 3, F.pmod(k, F.lit(60)) == 11)
               .otherwise(F.pmod(k, F.lit(80)) == 0))
    tier = _tier(k)
    tier_now = F.when((kind == 1) | (kind == 4), _tier_upgrade(tier)).otherwise(tier)
    tier_out = F.when((kind == 0) & (F.pmod(k, F.lit(9)) == 2), F.lower(tier_now)).otherwise(tier_now)
    mult = pick(mix(k, 7919, 17, 100), [(b, m) for (b, _), m in
                                         zip(V.cumulative(V.CUSTOMER_TIERS), (10, 30, 70, 200))], 200)
    address = F.when(kind == 2, F.concat((mix(k, 131, 9, 9900) + F.lit(100)).cast("string"), F.lit(" "), F.col("n_name"))) \
        .otherwise(F.concat((mix(k, 7919, 1, 9900) + F.lit(100)).cast("string"), F.lit(" "), F.col("c_mktsegment")))
    zip_code = F.when(kind == 2, zpad(mix(k, 611, 5, 89999) + F.lit(10000), 5)) \
        .otherwise(zpad(mix(k, 104729, 3, 89999) + F.lit(10000), 5))
    seq = (k + F.lit(1) + F.when((kind == 1) | (kind == 2) | (kind == 4), F.lit(SEQ_UPDATE))
           .when(kind == 3, F.lit(SEQ_DELETE)).otherwise(F.lit(0)))
    op = (F.when(kind == 0, F.when(F.pmod(k, F.lit(89)) == 0, F.lit(None).cast("string")).otherwise(F.lit("INSERT")))
          .when(kind == 3, F.lit("DELETE")).otherwise(F.lit("UPDATE")))
    updated = (F.when(kind == 0, days_before("2025-12-31", mix(k, 31, 5, 364) + F.lit(1)))
               .when(kind == 3, days_before("2025-12-31", mix(k, 19, 2, 29) + F.lit(1)))
               .otherwise(days_before("2025-12-31", mix(k, 17, 3, 29) + F.lit(1))))
    name = F.col("c_name")
    city = F.col("n_name")
    region = F.col("r_name")
    src = (t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
           .join(t.nation.select("n_nationkey", "n_name", "n_regionkey"),
                 F.col("c_nationkey") == F.col("n_nationkey"), "left")
           .join(t.region.select("r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey"), "left"))
    return (src.withColumn("kind", F.explode(F.array(*[F.lit(i) for i in range(5)])))
            .where(applies)
            .select(
                code("CUST-", k, 5).alias("customer_id"),
                F.when(F.pmod(k, F.lit(13)) == 5, F.concat(F.lit("  "), name, F.lit("  "))).otherwise(name)
                .alias("customer_name"),
                address.alias("address"),
                F.when(F.pmod(k, F.lit(17)) == 4, F.concat(F.lit(" "), city, F.lit(" "))).otherwise(city).alias("city"),
                F.when(F.pmod(k, F.lit(7)) == 1, code("s", F.col("c_nationkey"), 2))
                .otherwise(code("S", F.col("c_nationkey"), 2)).alias("state"),
                zip_code.alias("zip"),
                tier_out.alias("customer_tier"),
                code("AM-", F.pmod(k, F.lit(20)), 3).alias("account_manager"),
                F.when(F.pmod(k, F.lit(11)) == 6, F.concat(F.lower(region), F.lit(" "))).otherwise(region)
                .alias("region"),
                from_cents(cents("c_acctbal") * mult).alias("annual_revenue"),
                F.when(F.pmod(k, F.lit(43)) == 0, F.lit(None).cast("boolean"))
                .otherwise(F.pmod(k, F.lit(37)) != 0).alias("is_active"),
                op.alias("_op"),
                seq.cast("bigint").alias("_sequence"),
                ts_ntz(updated).alias("updated_at"),
                F.when(kind == 0, F.lit(1)).otherwise(F.lit(2)).alias("batch"),
            ))


# ---------------------------------------------------------------------------
# demand_signals
# ---------------------------------------------------------------------------
def signal_part_key(key: Column, n_parts: Column) -> Column:
    """Part of a demand signal / purchase order with the same number."""
    return F.pmod(key * F.lit(7919) + F.lit(11), n_parts)


def demand_signals(t: Tables) -> DataFrame:
    k = F.col("event_id")
    fq = F.least(F.greatest(F.floor("value"), F.lit(1)), F.lit(500)).cast("bigint")
    fq = F.when(F.pmod(k, F.lit(53)) == 0, F.lit(0).cast("bigint")).otherwise(fq)
    actual = idiv(fq * (mix(k, 131, 7, 31) + F.lit(85)), 100)
    return t.events.select(
        code("SIG-", k, 7).alias("signal_id"),
        fmt_part(signal_part_key(k, t.n_parts())).alias("part_id"),
        F.col("ts").cast("date").alias("forecast_date"),
        fq.alias("forecasted_qty"),
        F.when(F.pmod(k, F.lit(29)) == 0, F.lit(None).cast("bigint")).otherwise(actual).alias("actual_qty"),
        pick(mix(k, 104729, 5, 100), V.cumulative(V.SIGNAL_TYPES), "BASELINE").alias("signal_type"),
        (mix(k, 7919, 0, 10000).cast("double") / F.lit(10000.0)).alias("confidence_score"),
        element(V.REGIONS, F.pmod("user_id", F.lit(5))).alias("region"),
        F.col("ts").alias("created_at"),
    )


# ---------------------------------------------------------------------------
# purchase_orders
# ---------------------------------------------------------------------------
def _with_part_price(df: DataFrame, t: Tables, key_col: str) -> DataFrame:
    """Left lookup of the catalogue price (in cents) for ``key_col``.

    The catalogue side is one row per part; Spark broadcasts it only when its
    measured size is under the broadcast threshold, else it sort-merge joins.
    """
    cat = t.part.select(F.col("p_partkey").alias("_pk"), cents("p_retailprice").alias("_price_c"))
    return df.join(cat, F.col(key_col) == F.col("_pk"), "left").drop("_pk")


def purchase_orders(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    src = t.orders.select("o_orderkey", "o_orderdate").withColumn("_part", signal_part_key(k, t.n_parts()))
    src = _with_part_price(src, t, "_part")
    price = F.coalesce(F.col("_price_c"), F.lit(5000))
    qty = F.when(F.pmod(k, F.lit(71)) == 0, F.lit(0)).otherwise(mix(k, 7919, 5, 40) + F.lit(1)).cast("bigint")
    status = pick(mix(k, 104729, 1, 100), V.cumulative(V.PO_STATUSES), "CANCELLED")
    po_date = F.col("o_orderdate").cast("date")
    return src.select(
        code("PO-", k, 7).alias("po_id"),
        code("SIG-", k, 7).alias("signal_id"),
        fmt_part(F.col("_part")).alias("part_id"),
        code("SUPP-", F.pmod(k, F.lit(V.N_SUPPLIERS)) + F.lit(1), 3).alias("supplier_id"),
        po_date.alias("po_date"),
        F.date_add(po_date, lead_time_of(F.col("_part")).cast("int")).alias("expected_receipt_date"),
        qty.alias("ordered_qty"),
        from_cents(scale_half_up(price, mix(k, 131, 3, 21) + F.lit(90))).alias("unit_price"),
        F.when(F.pmod(k, F.lit(9)) == 4, F.lower(status)).otherwise(status).alias("po_status"),
        code("BUYER-", F.pmod(k, F.lit(15)), 3).alias("buyer_id"),
        F.col("o_orderdate").alias("created_at"),
    )


# ---------------------------------------------------------------------------
# receivers and invoices (one per line item)
# ---------------------------------------------------------------------------
def _line_key() -> Column:
    return F.col("l_orderkey") * F.lit(8) + F.col("l_linenumber")


def receiver_id_of() -> Column:
    return F.concat(code("RCV-", "l_orderkey", 7), F.lit("-"), F.col("l_linenumber").cast("string"), F.lit("-"),
                    F.col("l_partkey").cast("string"))


def receivers(t: Tables) -> DataFrame:
    x = _line_key()
    status = (F.when(F.col("l_returnflag") == "R", F.lit("REJECTED"))
              .when(F.col("l_returnflag") == "A", F.lit("PARTIAL_ACCEPT"))
              .otherwise(F.lit("ACCEPTED")))
    status = (F.when(F.pmod(x, F.lit(101)) == 0, F.lit(None).cast("string"))
              .when(F.col("l_linenumber") == 7, F.lower(status)).otherwise(status))
    delay = pick(mix(x, 7919, 3, 100), [(b, d) for b, d in V.cumulative(V.RECEIPT_DELAYS)], 14)
    return t.lineitem.select(
        receiver_id_of().alias("receiver_id"),
        code("PO-", F.col("l_orderkey"), 7).alias("po_id"),
        fmt_part(F.col("l_partkey")).alias("part_id"),
        F.date_add(F.col("l_shipdate").cast("date"), delay).alias("received_date"),
        F.col("l_quantity").cast("bigint").alias("received_qty"),
        code("WH-", F.col("l_suppkey"), 4).alias("warehouse_location"),
        status.alias("quality_status"),
        code("INSP-", F.pmod("l_suppkey", F.lit(10)), 3).alias("inspector_id"),
        F.col("l_shipdate").alias("created_at"),
    )


def invoices(t: Tables) -> DataFrame:
    x = _line_key()
    paid = F.col("l_linestatus") == "F"
    unpaid = F.when(mix(x, 17, 1, 10) < 7, F.lit("PENDING")).otherwise(F.lit("OVERDUE"))
    status = F.when(paid, F.lit("PAID")).otherwise(unpaid)
    status = F.when(F.pmod(x, F.lit(9)) == 3, F.lower(status)).otherwise(status)
    terms = pick(mix(x, 7919, 29, 100), V.cumulative(V.PAYMENT_TERMS), 90)
    inv_date = F.date_add(F.col("l_shipdate").cast("date"), mix(x, 131, 1, 7).cast("int"))
    amount = scale_half_up(cents("l_extendedprice"), F.lit(100) - F.round(F.col("l_discount") * 100).cast("bigint"))
    return t.lineitem.select(
        F.concat(code("INV-", "l_orderkey", 7), F.lit("-"), F.col("l_linenumber").cast("string"), F.lit("-"),
                 F.col("l_partkey").cast("string"))
        .alias("invoice_id"),
        code("PO-", F.col("l_orderkey"), 7).alias("po_id"),
        receiver_id_of().alias("receiver_id"),
        code("SUPP-", F.pmod("l_suppkey", F.lit(V.N_SUPPLIERS)) + F.lit(1), 3).alias("supplier_id"),
        inv_date.alias("invoice_date"),
        from_cents(amount).alias("invoice_amount"),
        status.alias("payment_status"),
        F.when(paid, F.date_add(inv_date, terms)).alias("payment_date"),
        F.when(paid, terms.cast("double")).alias("days_to_payment"),
        F.col("l_shipdate").alias("created_at"),
    )


# ---------------------------------------------------------------------------
# work orders and quotes (one work order per order)
# ---------------------------------------------------------------------------
def wo_part_key(key: Column, n_parts: Column) -> Column:
    return F.pmod(key * F.lit(104729) + F.lit(3), n_parts)


def _priority() -> Column:
    p = F.col("o_orderpriority")
    return (F.when(p == "1-URGENT", F.lit("URGENT")).when(p == "2-HIGH", F.lit("HIGH"))
            .when(p == "3-MEDIUM", F.lit("MEDIUM")).otherwise(F.lit("LOW")))


def _wo_dates(k: Column, n_tech: Column) -> tuple[Column, Column]:
    """(created_date, scheduled_date) of work order ``k``: scheduled on one of
    30 days from 2024-01-01, created up to the priority window before."""
    window = F.lit(None).cast("int")
    for prio, days in V.PRIORITY_WINDOW.items():
        window = F.when(_priority() == prio, F.lit(days)).otherwise(window)
    scheduled = F.date_add(F.lit("2024-01-01").cast("date"),
                           F.pmod(F.floor(k / n_tech), F.lit(30)).cast("int"))
    created = F.date_sub(scheduled, (mix(k, 31, 1, window) + F.lit(1)).cast("int"))
    return created, scheduled


def work_orders(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    n_tech = t.n_technicians()
    created, scheduled = _wo_dates(k, n_tech)
    prio = _priority()
    src = (t.orders.select("o_orderkey", "o_custkey", "o_orderpriority")
           .join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"), "left")
           .join(t.nation.select("n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
           .join(t.region.select("r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey"), "left"))
    # Stage the shared sub-expressions once (kept as a separate projection).
    staged = src.select(
        "o_orderkey", "o_custkey", "r_name", prio.alias("_prio"), created.alias("_created"),
        scheduled.alias("_scheduled"), pick(mix(k, 7919, 7, 100), V.cumulative(V.WO_TYPES), "INSPECTION").alias("_type"),
        pick(mix(k, 104729, 2, 100), V.cumulative(V.WO_STATUSES), "CANCELLED").alias("_status"),
        F.pmod(k, n_tech).alias("_tech"), wo_part_key(k, t.n_parts()).alias("_part"))
    c = F.col
    return staged.select(
        code("WO-", k, 7).alias("wo_id"),
        F.when(F.pmod(k, F.lit(101)) == 0, F.lit(None).cast("string"))
        .otherwise(code("CUST-", c("o_custkey"), 5)).alias("customer_id"),
        fmt_part(c("_part")).alias("part_id"),
        code("TECH-", c("_tech"), 4).alias("technician_id"),
        c("_created").alias("created_date"),
        c("_scheduled").alias("scheduled_date"),
        c("_type").alias("wo_type"),
        F.when(F.pmod(k, F.lit(9)) == 7, F.lower(c("_prio"))).otherwise(c("_prio")).alias("priority"),
        F.when(F.pmod(k, F.lit(9)) == 1, F.lower(c("_status"))).otherwise(c("_status")).alias("wo_status"),
        F.concat(F.lit("Service work order #"), k.cast("string"), F.lit(" - "), c("_type")).alias("description"),
        c("r_name").alias("region"),
        ts_ntz(c("_created")).alias("created_at"),
    )


def _delay_of(constraint: Column, delays: dict, lead: Column | None = None) -> Column:
    expr = F.lit(None).cast("bigint") if lead is None else lead
    for name, days in delays.items():
        expr = F.when(constraint == name, F.lit(days).cast("bigint")).otherwise(expr)
    return expr


def completion_delay(availability: Column, labor: Column, lead: Column) -> Column:
    """Days from quote to completion before slack: the binding constraint."""
    return F.greatest(_delay_of(availability, V.PARTS_DELAY, lead), _delay_of(labor, V.LABOR_DELAY))


def customer_quotes(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    c = F.col
    n_tech = t.n_technicians()
    src = (t.orders.select("o_orderkey", "o_custkey", "o_orderpriority")
           .withColumn("_part", wo_part_key(k, t.n_parts()))
           .withColumn("j", F.explode(F.sequence(F.lit(1), F.pmod(k, F.lit(3)) + F.lit(1)))))
    src = _with_part_price(src, t, "_part")
    qx = c("_qx")
    created, _ = _wo_dates(k, n_tech)
    # Stage the shared sub-expressions once (kept as separate projections).
    s1 = src.select("o_orderkey", "o_custkey", "_part", "_price_c", "j",
                    (k * F.lit(4) + c("j")).alias("_qx"), created.alias("_created"))
    s2 = s1.select(
        "*",
        F.date_add(c("_created"), mix(qx, 131, 5, 3).cast("int")).alias("_qd"),
        pick(mix(qx, 7919, 1, 100), V.cumulative(V.AVAILABILITY), "SPECIAL_ORDER").alias("_avail"),
        pick(mix(qx, 104729, 4, 100), V.cumulative(V.LABOR_AVAILABILITY), "NEXT_WEEK").alias("_labor"),
        pick(mix(qx, 31, 8, 100), V.cumulative(V.QUOTE_STATUSES), "EXPIRED").alias("_status"),
        idiv(F.coalesce(c("_price_c"), F.lit(5000)) * (mix(qx, 7919, 1, 201) + F.lit(100)), 100).alias("_parts_c"),
        (mix(qx, 104729, 9, 16000) + F.lit(4000)).alias("_labor_c"))
    delay = completion_delay(c("_avail"), c("_labor"), lead_time_of(c("_part")))
    slack = mix(qx, 17, 3, V.SLACK_DAYS[1] - V.SLACK_DAYS[0] + 1) + F.lit(V.SLACK_DAYS[0])
    total_c = F.when(F.pmod(qx, F.lit(97)) == 0, F.lit(0)).otherwise(c("_parts_c") + c("_labor_c"))
    return s2.select(
        F.concat(code("QT-", k, 7), F.lit("-"), c("j").cast("string")).alias("quote_id"),
        code("WO-", k, 7).alias("wo_id"),
        code("CUST-", c("o_custkey"), 5).alias("customer_id"),
        fmt_part(c("_part")).alias("part_id"),
        c("_qd").alias("quote_date"),
        from_cents(c("_parts_c")).alias("parts_cost"),
        from_cents(c("_labor_c")).alias("labor_cost"),
        from_cents(total_c).alias("total_amount"),
        F.date_add(c("_qd"), (delay + slack).cast("int")).alias("expected_completion_date"),
        c("_avail").alias("availability_constraint"),
        c("_labor").alias("labor_constraint"),
        F.when(F.pmod(qx, F.lit(9)) == 5, F.lower(c("_status"))).otherwise(c("_status")).alias("quote_status"),
        ts_ntz(c("_qd")).alias("created_at"),
    )


# ---------------------------------------------------------------------------
# labor_schedules (one slot per event; a technician-day can repeat)
# ---------------------------------------------------------------------------
def labor_schedules(t: Tables) -> DataFrame:
    k = F.col("event_id")
    u = F.col("user_id")
    avail = F.when(mix(k, 7919, 1, 10) < 8, F.lit(80)).when(mix(k, 7919, 1, 10) == 8, F.lit(60)).otherwise(F.lit(40))
    booked = F.when(F.pmod(k, F.lit(50)) == 0, avail + F.lit(15)).otherwise(idiv(avail * mix(k, 131, 7, 101), 100))
    avail = F.when(F.pmod(k, F.lit(97)) == 0, F.lit(-10)).otherwise(avail)
    name = code("Tech ", u, 4)
    region = element(V.REGIONS, F.pmod(u, F.lit(5)))
    return t.events.select(
        code("SCHED-", k, 7).alias("schedule_id"),
        code("TECH-", u, 4).alias("technician_id"),
        F.when(F.pmod(u, F.lit(7)) == 3, F.concat(F.lit("  "), name, F.lit("  "))).otherwise(name)
        .alias("technician_name"),
        F.col("ts").cast("date").alias("schedule_date"),
        (avail.cast("double") / F.lit(10.0)).alias("available_hours"),
        (booked.cast("double") / F.lit(10.0)).alias("booked_hours"),
        F.when(F.pmod(u, F.lit(3)) == 1, F.lower(region)).otherwise(region).alias("region"),
        element(V.SKILL_LEVELS, F.pmod(u, F.lit(4))).alias("skill_level"),
        F.col("ts").alias("created_at"),
    )


FEED_BUILDERS = {
    "parts_cdc": parts_cdc,
    "customers_cdc": customers_cdc,
    "demand_signals": demand_signals,
    "purchase_orders": purchase_orders,
    "receivers": receivers,
    "invoices": invoices,
    "work_orders": work_orders,
    "customer_quotes": customer_quotes,
    "labor_schedules": labor_schedules,
}


def build_feed(t: Tables, folder: str) -> DataFrame:
    return FEED_BUILDERS[folder](t)
