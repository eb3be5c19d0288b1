"""Facts refreshed by change equal facts computed whole."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from partsflow.plans.batch import Flow
from partsflow.plans.feeds import Tables
from partsflow.sinks.commits import CommitLog
from partsflow.streaming import fact_store as FS
from partsflow.streaming.fact_store import FactSpec, FactStore

ROOT, ITEM, SLOT = "po string, sig string, part string", "item string, po string", "who string, day int, hours int"
SPEC = FactSpec("f", "root", "po", "po", {"root": (("po",), ("po",)), "items": (("po",), ("po",)), "signals": (("sig",), ("sig",)), "parts": (("part",), ("part",))},
                {"parts": "dim"}, lambda t: t["root"].join(t["items"], "po", "left").join(t["signals"], "sig", "left").join(t["dim"], "part", "left"))
SCHEMAS = {"root": ROOT, "items": ITEM, "signals": "sig string, qty int", "dim": "part string, price int"}


def frames(spark, data):
    return {t: spark.createDataFrame(data[t], SCHEMAS[t]) for t in SCHEMAS}


@pytest.mark.parametrize("seed,fan", [(1, 8), (2, 2)])
def test_random_refreshes_equal_the_whole(spark, scratch, monkeypatch, seed, fan):
    """Roots without matches gain them, repeated rows, unknown and NULL references, changed dimension rows."""
    monkeypatch.setattr(FS, "FAN", fan)
    rng = random.Random(seed)
    data = {t: [] for t in SCHEMAS}
    store = FactStore(spark, f"{scratch}/f", SPEC)
    pick = lambda p, n: rng.choice([f"{p}{rng.randrange(n)}"] * 9 + [None])
    for i in range(5):
        new = {"root": [(f"po{rng.randrange(12)}", pick("s", 6), pick("p", 4)) for _ in range(rng.randrange(4))],
               "items": [(f"i{rng.randrange(99)}", pick("po", 15)) for _ in range(rng.randrange(6))],
               "signals": [(f"s{i}{j}"[:2], rng.randrange(9)) for j in range(rng.randrange(2))],
               "parts": [(f"p{rng.randrange(4)}", 10 * i + j) for j in range(rng.randrange(2))]}
        for t in ("root", "items", "signals"):
            data[t] += new[t]
        data["dim"] = list({**dict(data["dim"]), **dict(new["parts"])}.items())
        for t, part in new.items():
            if part:
                store.stage(t, spark.createDataFrame(part, SCHEMAS["dim" if t == "parts" else t]), i)
        n = store.refresh(frames(spark, data))
        assert n <= len({r[0] for r in data["root"]} | {r[1] for r in data["items"]})
        if i and store.commits.latest():
            assert rows(store.rows()) == rows(SPEC.build(frames(spark, data))), i
    store.vacuum()
    assert rows(store.rows()) == rows(SPEC.build(frames(spark, data)))
    assert store.refresh(frames(spark, data)) == 0  # nothing is staged


def test_a_refresh_that_breaks_off_is_repeated(spark, scratch, monkeypatch):
    data = {"root": [("po1", "s1", "p1"), ("po2", None, None)], "items": [], "signals": [], "dim": []}
    store = FactStore(spark, f"{scratch}/f", SPEC)
    store.stage("root", frames(spark, data)["root"], 0)
    assert store.refresh(frames(spark, data)) == 2
    before = rows(store.rows())
    data["items"] = [("i1", "po1")]
    store.stage("items", frames(spark, data)["items"], 0)
    with monkeypatch.context() as m:
        def stop(self, record):
            raise KeyboardInterrupt
        m.setattr(CommitLog, "publish", stop)
        with pytest.raises(KeyboardInterrupt):
            store.refresh(frames(spark, data))
    assert rows(store.rows()) == before
    assert store.refresh(frames(spark, data)) == 1  # only po1 is computed anew; its NULL-extended row goes
    assert rows(store.rows()) == rows(SPEC.build(frames(spark, data)))
    assert store.rows().where("item IS NULL").count() == 1


def test_pipeline_refresh_equals_whole_facts(spark, scratch):
    """Silver tables that grow file by file, dimensions that change: both facts, refreshed twice."""
    from conftest import SF_SMALL
    from partsflow.streaming.pipeline import FACTS, CdcApply, Layout, _dimensions_by_source, fact_store, refresh_facts

    flow, layout = Flow(Tables(spark, SF_SMALL)), Layout(f"{scratch}/pipe")
    sources = sorted({s for spec in FACTS.values() for s in spec.refers})
    cut = {s: flow.silver(s).withColumn("__h", F.pmod(F.xxhash64(*flow.silver(s).columns), F.lit(20))) for s in sources}
    seen = []
    for batch, part in enumerate(("__h > 0", "__h = 0")):
        for s in sources:
            new = cut[s].where(part).drop("__h")
            new.write.mode("append").parquet(layout.table(s))
        for s, (spec, dims) in _dimensions_by_source().items():
            CdcApply(spark, layout, s, spec, dims, 2)(spark.read.parquet(layout.table(s)), batch)
        seen.append(refresh_facts(spark, layout))
    for name in FACTS:
        assert rows(fact_store(spark, layout, name).rows()) == rows(flow.fact(name)), name
        assert 0 < seen[1][name] < seen[0][name]
