"""Approximate nearest neighbours by shifted space-filling curves.

Vectors are projected several times to a few random dimensions, shifted, and
ordered along a Hilbert curve.  Spark range-partitions and numbers each ordering;
a query is compared with the vectors at most ``window`` places away from it in
each, in blocks, and the candidates of all curves are merged and ranked by the
exact inner product.

The window is measured, not guessed: for a bounded sample of queries (SAMPLE) the
true neighbours are found among all vectors, and the window is the smallest that
holds the share TARGET of them on at least one curve.  Every vector is indexed.
On data without any structure the window grows towards all vectors, and the
search towards an exact one; on clustered data it is small.

Equal vectors are indexed once, under their smallest id, with as many of their
smallest ids as an answer can hold, so a vector that many rows share costs one place.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from partsflow.llm.common import add_dense_index, materialize

CURVES = 8
DIMENSIONS = 8  # of 8 bits: one 64-bit key
BITS = 8
BLOCK = 4096
SAMPLE = 96     # queries that measure the window
TARGET = 0.96


def hilbert_keys(x: np.ndarray, bits: int) -> np.ndarray:
    """(n, p) grid coordinates of ``bits`` bits -> unsigned keys along the Hilbert curve."""
    p = x.shape[1]
    c = [x[:, i].astype(np.uint64) for i in range(p)]
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        q, low = np.uint64(1 << level), np.uint64((1 << level) - 1)
        for i in range(p):
            on = (c[i] & q) != 0
            t = np.where(on, np.uint64(0), (c[0] ^ c[i]) & low)
            c[0] = np.where(on, c[0] ^ low, c[0] ^ t)
            if i:
                c[i] = c[i] ^ t
    for i in range(1, p):
        c[i] = c[i] ^ c[i - 1]
    t = np.zeros_like(c[0])
    for level in range(bits - 1, 0, -1):
        t = np.where((c[p - 1] >> np.uint64(level)) & one != 0, t ^ np.uint64((1 << level) - 1), t)
    key = np.zeros_like(c[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(p):
            key = (key << one) | (((c[i] ^ t) >> np.uint64(bit)) & one)
    return key


def curve_keys(v: np.ndarray, curve: int, seed: int) -> np.ndarray:
    """Signed sort keys of vectors on one curve: direction, projected, shifted."""
    d = v.shape[1]
    rng = np.random.default_rng([seed, curve, d])
    axes = np.linalg.qr(rng.standard_normal((max(d, DIMENSIONS), DIMENSIONS)))[0][:d]
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    y = unit @ axes * math.sqrt(d)
    # The logistic curve spreads the coordinates over the grid; the shift moves its cells.
    u = (1 / (1 + np.exp(-1.7 * y)) + rng.random(DIMENSIONS) * 0.5) / 1.5
    grid = np.clip((u * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1)
    return (hilbert_keys(grid, BITS) ^ np.uint64(1 << 63)).view(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest scores, ties to the smaller id."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= edge)
    else:
        at = np.flatnonzero(scores > -np.inf)
    at = at[scores[at] > -np.inf]
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v): rows with an id and a vector of the commonest length without null
    or non-finite components that isn't zero."""
    v = F.col(vec_col).cast("array<double>")
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    # Adding 0.0 makes -0.0 equal to 0.0.
    rows = df.where(F.col(id_col).isNotNull()).where(F.coalesce(ok, F.lit(False))).select(
        F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: x + F.lit(0.0)).alias("v"))
    top = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (top["d"] if top else 0))


def _pairs_schema() -> str:
    return "q long, c long, score double"


def nearest(df: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", seed: int = 17) -> DataFrame:
    """(query_id, rank, id_col, score): the k nearest found of each row for which
    ``is_query`` (a function of the id column) holds, by largest inner product in
    double precision, ties to the smaller id; the query's own id is left out.

    Rows without an id, and null, zero, non-finite or odd-length vectors take no
    part.  Equal vectors are all candidates.  With k other vectors or fewer all are
    returned.  Rows that repeat an id count as one candidate if their vectors are
    equal; an empty table gives no rows.  Other columns are not read.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = materialize(usable(df, id_col, vec_col).distinct(), "ann-rows")
    # The smallest ids of each vector; Spark keeps only k + 1 a task before its shuffle.
    same = Window.partitionBy("v")
    first = rows.withColumn("n", F.row_number().over(same.orderBy("id"))).where(F.col("n") <= k + 1)
    members = materialize(first.withColumn("cls", F.min("id").over(same)).select("cls", "id", F.when(F.col("n") == 1, F.col("v")).alias("v")), "ann-members")
    base = materialize(members.where(F.col("v").isNotNull()).select("cls", "v"), "ann-vectors")
    queries = materialize(rows.where(is_query(F.col("id"))).join(base, "v").select(F.col("id").alias("query_id"), F.col("cls").alias("q")), "ann-queries")
    n = base.count()
    out_cols = [F.col("query_id"), F.col("rank"), F.col("id").alias(id_col), F.col("score")]

    def keyed(batches):
        for b in batches:
            v = np.array(b["v"].tolist(), dtype=np.float64)
            for curve in range(CURVES):
                yield pd.DataFrame({"curve": np.int32(curve), "key": curve_keys(v, curve, seed), "cls": b["cls"]})

    placed = add_dense_index(base.mapInPandas(keyed, "curve int, key long, cls long"), ["curve", "key", "cls"], "i")
    placed = materialize(placed.select("cls", "curve", (F.col("i") - F.col("curve") * n).alias("place")), "ann-places")
    wanted = queries.select("q").distinct()
    asked = materialize(base.join(wanted, base["cls"] == wanted["q"]).select("q", "v"), "ann-asked")
    n_asked = asked.count()
    window = _window(base, asked, placed, n, k, n_asked)
    if window >= n:  # every vector is in every window: one ordering holds them all
        placed = placed.where("curve = 0")

    # Blocks of places, and chunks of the queries that meet a block: both bounded.
    chunks = max(1, math.ceil(n_asked * min(1.0, (2 * window + BLOCK) / max(n, 1)) / BLOCK))
    points = (placed.join(base, "cls").withColumn("block", F.floor(F.col("place") / BLOCK).cast("long"))
              .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))).select("curve", "block", "chunk", "place", "cls", "v"))
    probes = (placed.join(asked, placed["cls"] == asked["q"]).select("curve", "place", "q", "v")
              .withColumn("block", F.explode(F.sequence(F.floor(F.greatest(F.col("place") - window, F.lit(0)) / BLOCK).cast("long"),
                                                        F.floor(F.least(F.col("place") + window, F.lit(max(n - 1, 0))) / BLOCK).cast("long"))))
              .withColumn("chunk", F.pmod(F.xxhash64("q"), F.lit(chunks)).cast("int")))

    def compare(p: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        got = []
        if len(p) and len(q):
            pv, qv = np.array(p["v"].tolist()), np.array(q["v"].tolist())
            ids, place = p["cls"].to_numpy(), p["place"].to_numpy()
            for at in range(0, len(q), 256):
                score = qv[at:at + 256] @ pv.T
                score[np.abs(q["place"].to_numpy()[at:at + 256, None] - place[None, :]) > window] = -np.inf
                for i, row in enumerate(score):
                    best = _best(row, ids, k + 1)
                    got.append(pd.DataFrame({"q": q["q"].iat[at + i], "c": ids[best], "score": row[best]}))
        return pd.concat(got) if got else pd.DataFrame({"q": [], "c": [], "score": []})

    on = ["curve", "block", "chunk"]
    points = points.toDF(*points.columns)  # new column identities: both sides come from ``placed``
    probes = probes.toDF(*probes.columns)
    found = points.groupBy(*on).cogroup(probes.groupBy(*on)).applyInPandas(compare, _pairs_schema())
    found = found.groupBy("q", "c").agg(F.max("score").alias("score"))
    by_score = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    full = (found.join(members.select(F.col("cls").alias("c"), "id"), "c").withColumn("n", F.row_number().over(by_score))
            .where(F.col("n") <= k + 1).select("q", "id", "score"))
    full = materialize(full.repartition(parts, "q"), "ann-found")
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (queries.join(full, "q").where("id <> query_id").withColumn("rank", F.row_number().over(own).cast("int"))
            .where(F.col("rank") <= k).select(*out_cols))


def exact_pairs(base: DataFrame, asked: list[tuple[int, list[float]]], k: int) -> DataFrame:
    """(q, c, score): the k best of all vectors for a bounded list of queries; the
    vectors go by in blocks."""
    shared = base.sparkSession.sparkContext.broadcast(asked)

    def run(batches):
        ids = [a[0] for a in shared.value]
        qv = np.array([a[1] for a in shared.value])
        for b in batches:
            cls = b["cls"].to_numpy()
            score = qv @ np.array(b["v"].tolist()).T
            for i, row in enumerate(score):
                best = _best(row, cls, k)
                yield pd.DataFrame({"q": ids[i], "c": cls[best], "score": row[best]})

    w = Window.partitionBy("q").orderBy(F.desc("score"), "c")
    return base.mapInPandas(run, _pairs_schema()).withColumn("n", F.row_number().over(w)).where(F.col("n") <= k).drop("n")


def _window(base: DataFrame, asked: DataFrame, placed: DataFrame, n: int, k: int, n_asked: int) -> int:
    if n <= BLOCK or not n_asked:
        return n
    sample = [(r["q"], list(r["v"])) for r in asked.orderBy(F.xxhash64("q"), "q").limit(SAMPLE).collect()]
    truth = exact_pairs(base, sample, k + 1).where("q <> c").select("q", "c")
    one = placed.select(F.col("cls").alias("q"), "curve", F.col("place").alias("at_q"))
    two = placed.select(F.col("cls").alias("c"), "curve", F.col("place").alias("at_c"))
    away = (truth.join(one, "q").join(two, ["c", "curve"]).groupBy("q", "c").agg(F.min(F.abs(F.col("at_q") - F.col("at_c"))).alias("away")))
    got = away.agg(F.percentile("away", TARGET)).first()[0]
    return min(n, int(math.ceil(got))) if got is not None else n
