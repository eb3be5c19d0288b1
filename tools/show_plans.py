"""Print the physical-operator skeleton of selected queries (final AQE plans).

Usage: python tools/show_plans.py [sf_dir] name ...
Runs each query once (noop sink) so the adaptive plan is final, then prints
the operator lines of ``explain()`` (exchanges, joins, aggregates, windows,
scans with pushed filters), without attribute ids.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEEP = re.compile(r"(Exchange|Join|Aggregate|Window|FileScan|Generate|Union|Expand|TakeOrdered|Sort |"
                  r"ShuffleQueryStage|BroadcastQueryStage|AQEShuffleRead|Filter)")


def skeleton(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    out = []
    for line in buf.getvalue().splitlines():
        if "Initial Plan" in line:
            break
        if KEEP.search(line):
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r", \[plan_id=\d+\]|\[id=#?\d+\]", "", line)
            line = re.sub(r"Location: [^,]*, ", "", line)
            line = re.sub(r"ReadSchema: struct<([^>]{0,120})[^>]*>", r"ReadSchema: struct<\1...>", line)
            out.append(line[:260])
    return "\n".join(out)


if __name__ == "__main__":
    # Plans of the computation itself: an unstored flow, feeds read from landed folders.
    from partsflow.plans.batch import Flow
    from partsflow.plans.feeds import Tables
    from partsflow.plans.landing import landing_for
    from partsflow.plans.registry import QUERIES
    from partsflow.session import get_session
    sf = sys.argv[1]
    spark = get_session("local[8]", 16, extra={"spark.sql.maxMetadataStringLength": "300"})
    spark.sparkContext.setLogLevel("ERROR")
    flow = Flow(Tables(spark, sf), landing=lambda: landing_for(spark, sf))
    for name in sys.argv[2:]:
        title = name
        if name.endswith(":no-broadcast"):
            name = name.split(":")[0]
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        print(f"### {title}\n```\n{skeleton(QUERIES[name](flow))}\n```\n", flush=True)
