"""The rows of one hot key are dealt to shards without meeting in one task."""

import re

from partsflow.llm import sharding


def test_largest_row_of_a_hot_key_needs_no_window(spark):
    rows = [(None if i % 2 else 7, "x" * (i % 90)) for i in range(300)] + [(3, "y" * 5000), (4, None)]
    out = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), 1000)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Window \[max\(", plan)
    total = {}
    for r in out.collect():
        total.setdefault(r["shard_id"], []).append(r["n_bytes"])
    assert sum(map(len, total.values())) == len(rows)
    assert all(sum(v) <= 1000 or len(v) == 1 for v in total.values())
