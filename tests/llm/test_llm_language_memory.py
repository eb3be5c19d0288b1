"""What a worker of the language identifier holds."""

import random

from pyspark.sql import functions as F

from partsflow.llm import langid


def test_texts_go_to_the_workers_once_and_unused_memory_goes(spark):
    rng = random.Random(41)
    model = langid.Model({lang: ["".join(rng.choice(part) for _ in range(400))] for lang, part in (("a", "abc "), ("b", "xyz "))})
    rows = [(i, "".join(rng.choice("abc " if i % 2 else "xyz ") for _ in range(60)), "old") for i in range(50)]
    rows += [(None, None, None), (7, "", "old"), (7, "1 2", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string").coalesce(1)

    def remember(batches):
        import sys
        import types
        sys.modules.setdefault("partsflow_worker_memo", types.ModuleType("partsflow_worker_memo")).words = "x"
        yield from batches

    def remembered(batches):
        import sys
        for b in batches:
            yield b.assign(doc_id=int("partsflow_worker_memo" in sys.modules))[["doc_id"]]

    docs.mapInPandas(remember, docs.schema).count()
    out = langid.identify(docs, model, piece_chars=100)
    assert out.columns == ["doc_id", "text", "lang_pred", "score"]
    plan = out._jdf.queryExecution().analyzed().toString()
    assert "MapInArrow" in plan and " AS __t" not in plan
    got = out.collect()
    assert [r["doc_id"] for r in got] == [r[0] for r in rows] and [r["text"] for r in got] == [r[1] for r in rows]
    assert [r["lang_pred"] for r in got] == ["a" if i % 2 else "b" for i in range(50)] + ["und"] * 3
    left = out.select("doc_id").mapInPandas(remembered, "doc_id long").agg(F.max("doc_id")).first()[0]
    assert left == 0
    none = langid.identify(docs.limit(0), model, keep=["doc_id"])
    assert none.columns == ["doc_id", "lang_pred", "score"] and none.count() == 0
