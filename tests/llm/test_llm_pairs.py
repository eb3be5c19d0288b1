"""Operators on repeats and pairs against brute-force versions on small tables."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from partsflow.llm import linededup, nearest, simhash, suffixdedup
from partsflow.llm.components import connected_components

DOC = "doc_id long, text string, fingerprint string, component_id long, kept int, k int, line string"


def table(spark, rows):
    """Documents with extra columns whose names clash with those that operators use."""
    return spark.createDataFrame([(i, t, "f", 1, 2, 3, "l") for i, t in rows], DOC).repartition(3)


def grow(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


def roots(n, links):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_components_of_chain_star_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3), (201, 200), (200, 201)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# ------------------------------------------------------------------- SimHash
def slow_fingerprint(text):
    import xxhash
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    sh = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_golay_keys_meet_up_to_distance_four():
    rng = np.random.default_rng(1)
    leader = simhash.golay_leaders()
    words = np.arange(1 << 23, dtype=np.int64)[::997]
    code = simhash.nearest_codeword(words, leader)
    assert len(leader) == 2048 and len(set(code.tolist())) > 3000
    x = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    for flips in range(5):
        y = x.copy()
        for bits in range(flips):
            y ^= np.uint64(1) << rng.integers(0, 64, len(x)).astype(np.uint64)
        one, two = (set(zip(*map(np.ndarray.tolist, simhash.fuzzy_keys(v, leader)))) for v in (x, y))
        assert {r for r, _ in one & two} == set(range(len(x)))


@pytest.mark.parametrize("tile", [3, 512])
def test_simhash_groups_equal_brute_force(spark, tile, monkeypatch):
    monkeypatch.setattr(simhash, "MAX_TILE", tile)
    rng = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    base = [grow(rng, words, 400) for _ in range(4)]
    rows = [(None, "a b"), (5, None), (6, ""), (7, " \t\n"), (8, "One Two"), (9, "one two"), (9, "one two"), (3, "x" * 100_000)]
    for i in range(60):
        w = rng.choice(base).split(" ")
        for _ in range(rng.randrange(3)):
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((100 + i, " ".join(w)))
    got = simhash.simhash_groups(table(spark, rows)).collect()
    fp = [slow_fingerprint(t) for _, t in rows]
    root = roots(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (fp[i] ^ fp[j]).bit_count() <= 4])
    low = {}
    for (i, _), r in zip(rows, root):
        if i is not None:
            low[r] = min(low.get(r, i), i)
    assert Counter(map(tuple, got)) == Counter((i, f"{f:016x}", low.get(r)) for (i, _), f, r in zip(rows, fp, root))
    kept = simhash.simhash_dedup(table(spark, rows))
    assert kept.columns == table(spark, rows).columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert ids == {i for i, _ in rows if i is None} | {i for (i, _), r in zip(rows, root) if i is not None and low[r] == i}
    assert simhash.simhash_groups(table(spark, rows).limit(0)).count() == 0


# ---------------------------------------------------------------- line dedup
def slow_lines(rows):
    """Texts after dedup, by (id, text)."""
    def shingles(line):
        return frozenset(line[i:i + 5] for i in range(max(1, len(line) - 4)))
    last = 2**63
    place = lambda i, n: (last if i is None else i, n)
    lines = [(place(i, n), x) for i, t in rows if t is not None for n, x in enumerate(t.split("\n")) if x.strip(" \t\r\x0b\x0c")]
    first = {}
    for at, x in lines:
        first[x] = min(first.get(x, at), at)
    names = list(first)
    sets = [shingles(x) for x in names]
    root = roots(len(names), [(a, b) for a in range(len(names)) for b in range(a)
                              if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])])
    keep = {}
    for x, r in zip(names, root):
        keep[r] = min(keep.get(r, first[x]), first[x])
    of = dict(zip(names, root))
    return [(i, t if t is None else "\n".join(x for n, x in enumerate(t.split("\n"))
             if not x.strip(" \t\r\x0b\x0c") or keep[of[x]] == place(i, n))) for i, t in rows]


@pytest.mark.parametrize("small,rounds", [(8, 6), (2, 1)])
def test_line_dedup_equals_brute_force(spark, small, rounds, monkeypatch):
    monkeypatch.setattr(linededup, "SMALL", small)
    monkeypatch.setattr(linededup, "ROUNDS", rounds)
    rng = random.Random(3)
    words = [f"word{i}" for i in range(80)]
    base = [grow(rng, words, 50) for _ in range(3)]
    rows = [(1, None), (2, ""), (3, "\n \n"), (None, "same\nsame"), (4, "same\n\nother"), (4, "same\n\nother"), (5, "z" * 30_000 + "\nsame")]
    for i in range(40):
        out = []
        for _ in range(3):
            w = rng.choice(base).split(" ")
            for _ in range(rng.randrange(4)):
                w[rng.randrange(len(w))] = rng.choice(words)
            out.append(" ".join(w))
        rows.append((10 + i, "\n".join(out)))
    got = linededup.line_dedup(table(spark, rows), n_lines="n_lines", n_removed="n_removed")
    assert got.columns == table(spark, rows).columns + ["n_lines", "n_removed"]
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter(slow_lines(rows))
    assert linededup.line_dedup(table(spark, rows).limit(0)).count() == 0


# --------------------------------------------------------- repeated strings
def slow_removal(rows, length=50):
    last = 2**63
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        i = last if i is None else i
        for p in range(len(b) - length + 1):
            first[b[p:p + length]] = min(first.get(b[p:p + length], i), i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < (last if i is None else i):
                gone[p:p + length] = b"\1" * length
        spans = sum(1 for p in range(len(b)) if gone[p] and not (p and gone[p - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, y in zip(b, gone) if not y)).hexdigest()))
    return out


@pytest.mark.parametrize("gram", [16, 20, 34])
def test_substring_dedup_equals_brute_force(spark, gram):
    rng = random.Random(gram)
    words = ["alpha ", "be ", "gamma ", "d ", "epsilon zeta ", "===", "é "]
    base = ["".join(rng.choice(words) for _ in range(50)) for _ in range(5)]
    texts = [None, "", "=" * 200, "=" * 120 + "x" + "=" * 70, "x" * 49, "x" * 50, base[0], base[0], "ab" * 5000]
    for _ in range(70):
        a, b = rng.choice(base), rng.choice(base)
        texts.append(a[:rng.randrange(len(a))] + rng.choice(["", "Q", "zz"]) + b[rng.randrange(len(b)):])
    rows = [(i * 3 % 97, t) for i, t in enumerate(texts)] + [(None, base[1]), (0, texts[0])]
    got = suffixdedup.substring_dedup(table(spark, rows), gram=gram).collect()
    mine = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in got)
    assert mine == Counter(slow_removal(rows))
    assert suffixdedup.substring_dedup(table(spark, rows).limit(0)).count() == 0


# --------------------------------------------------------- nearest neighbours
def test_hilbert_curve_visits_every_cell_by_unit_steps():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = nearest.hilbert_keys(grid, 3)
    assert sorted(keys.tolist()) == list(range(512))
    assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def slow_nearest(rows, k=20):
    ok = [(i, np.array(v)) for i, v in rows if i is not None and v is not None and len(v) == 8 and None not in v
          and np.isfinite(np.array(v, float)).all() and any(v)]
    out = defaultdict(list)
    for q, x in ok:
        if q % 20 == 0:
            best = sorted(((-float(x @ y), i) for i, y in ok if i != q))[:k]
            out[q] = [(n + 1, i, round(-s, 9)) for n, (s, i) in enumerate(best)]
    return out


def test_nearest_small_tables_are_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(90)]
    rows += [(100 + i, [1.0] * 8) for i in range(45)]  # equal vectors, more than an answer holds
    rows += [(200, None), (220, [0.0] * 8), (240, [float("nan")] * 8), (260, [None] * 8), (280, [1.0, 2.0]), (None, [1.0] * 8), (300, [float("inf")] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit("x")).withColumn("q", F.lit(1))
    is_query = lambda i: F.pmod(i, F.lit(20)) == 0
    got = defaultdict(list)
    for r in nearest.nearest(df, is_query).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], round(r["score"], 9)))
    assert got == slow_nearest(rows)
    few = df.where("vec_id < 3")
    assert nearest.nearest(few, is_query).count() == 2
    assert nearest.nearest(df.limit(0), is_query).count() == 0


def test_nearest_recall_with_narrow_windows(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK", 256)
    seen = []
    measure = nearest._window
    monkeypatch.setattr(nearest, "_window", lambda *a: seen.append(measure(*a)) or seen[-1])
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((40, 8)) * 3
    rows = [(i, (centres[i % 40] + rng.standard_normal(8) * 0.3).tolist()) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(set)
    for r in nearest.nearest(df, lambda i: F.pmod(i, F.lit(20)) == 0).collect():
        got[r["query_id"]].add(r["vec_id"])
    truth = slow_nearest(rows)
    hit = sum(len(got[q] & {i for _, i, _ in best}) for q, best in truth.items())
    assert seen[0] < 3000 and hit >= 0.9 * 20 * len(truth)
