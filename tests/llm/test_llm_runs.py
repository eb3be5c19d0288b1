"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from partsflow.llm import queries, runs
from partsflow.llm.common import read_table


def slow_lyndon(w):
    out = []
    for i in range(len(w)):
        best = 1
        for j in range(i + 1, len(w) + 1):
            s = w[i:j]
            if all(s < s[k:] for k in range(1, len(s))):
                best = j - i
        out.append(best)
    return out


def slow_runs(w, least):
    out = []
    for q in range(1, len(w) // 2 + 1):
        s = 0
        while s + q < len(w):
            e = s + q
            while e < len(w) and w[e] == w[e - q]:
                e += 1
            n = e - s
            if n >= max(least, 2 * q) and not any(all(w[x] == w[x + d] for x in range(s, e - d)) for d in range(1, q)):
                out.append((s, n, q))
            s = e - q + 1
    return sorted(set(out), key=lambda r: (r[0], r[2]))


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def slow_collapsed(w, found):
    gone = {x for s, n, q in found for x in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


@pytest.mark.parametrize("letters", [1, 2, 3, 5])
def test_lyndon_arrays_equal_brute_force(letters):
    rng = random.Random(letters)
    for _ in range(120):
        w = [rng.randint(1, letters) for _ in range(rng.randrange(1, 26))]
        assert runs.lyndon_lengths([0, *w])[1:] == slow_lyndon(w), w
    two = [rng.randint(1, letters) for _ in range(20)]
    assert runs.lyndon_lengths([0, *two[:9], 0, *two[9:]]) == [1, *slow_lyndon(two[:9]), 1, *slow_lyndon(two[9:])]


@pytest.mark.parametrize("least", [2, 3, 5, 12, "equal hashes"])
def test_runs_of_strings_equal_brute_force(least, monkeypatch):
    if least == "equal hashes":  # what hashes find wrongly is compared word by word
        monkeypatch.setattr(runs, "MODULI", (5, 3))
        least = 3
    rng = random.Random(least)
    strings = []
    for _ in range(150):
        k = rng.choice([1, 2, 3, 4])
        w = [rng.randrange(k) for _ in range(rng.randrange(40))]
        if rng.random() < 0.5 and w:
            w = (w[:rng.randrange(1, len(w) + 1)] * 6)[:50]
        strings.append(w)
    a, b = [1], [2, 1]
    while len(b) < 60:  # a Fibonacci string: as many runs as a string can have, nearly
        a, b = b, b + a
    strings += [b, [], [7], [7] * 90]
    bounds = np.cumsum([0, *map(len, strings)])
    got = runs.runs_of(np.array([x for w in strings for x in w]), bounds, least).tolist()
    want = [[s + int(at), n, q] for at, w in zip(bounds, strings) for s, n, q in slow_runs(w, least)]
    assert sorted(got) == sorted(want)


def edge_rows():
    rng = random.Random(9)
    texts = [None, "", " \t\n", "a " * 11, "a " * 12, "b\n" * 4000, "x\x0by\x0cx\ry x y x y x y x y   x y", "one two three " * 4 + "one",
             "p " + "one two three four five six seven " * 2, ("a b a b a b " * 3 + "c ") * 3, "é à é à é à é à é à é à é"]
    for _ in range(60):
        k = rng.choice(["ab", "abc", "abcdefgh"])
        part = [rng.choice(k) for _ in range(rng.randrange(1, 30))]
        texts.append(" ".join((part * rng.randrange(1, 7) + [rng.choice(k) for _ in range(rng.randrange(9))])))
    rows = [(i, t, "clash", 1, 2, 3) for i, t in enumerate(texts)]
    return rows + [(None, texts[9], "n", 1, 2, 3), (9, texts[9], "c", 1, 2, 3), (9, texts[9], "c", 1, 2, 3)]


@pytest.mark.parametrize("size,least", [(runs.GROUP_BYTES, 12), (100, 12), (runs.GROUP_BYTES, 3)])
def test_runs_of_texts_equal_brute_force(spark, size, least, monkeypatch):
    monkeypatch.setattr(runs, "GROUP_BYTES", size)
    rows = edge_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string, start int, collapsed int, period int").repartition(3)
    out = runs.periodic_runs(df, min_length=least, n_words_col="n")
    assert out.columns == ["doc_id", "text", "start", "period", "runs", "collapsed", "n"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        w = words_of(r["text"])
        want = slow_runs(w, least) if len(w) < 400 else [(0, len(w), 1)]
        assert [tuple(x) for x in r["runs"]] == want, r["text"]
        assert r["n"] == len(w) and r["collapsed"] == slow_collapsed(w, want)
    assert runs.periodic_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        runs.periodic_runs(df, min_length=1)


def test_very_long_text(spark):
    rng = random.Random(1)
    w = [str(rng.randrange(10_000)) for _ in range(60_000)]
    w[20_000:40_000] = (w[20_000:27_000] * 3)[:20_000]
    [r] = runs.periodic_runs(spark.createDataFrame([(" ".join(w),)], "text string")).collect()
    assert [(20_000, 20_000, 7_000)] == [tuple(x) for x in r["runs"]]
    assert r["collapsed"] == slow_collapsed(w, [(20_000, 20_000, 7_000)])


def rebuilt(doc_id, w):
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if h % 10 or not n:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in read_table(spark, sf, "documents").collect()}
    got = queries.QUERIES["op12_runs"](spark, sf).collect()
    assert len(got) == len(texts)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    some = 0
    for r in got:
        w = rebuilt(r["doc_id"], words_of(texts[r["doc_id"]]))
        if len(w) > 2500:
            continue  # brute force is quadratic
        found = slow_runs(w, 12)
        some += bool(found)
        best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=None)
        first = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"]) == (len(found), *first)
        assert r["runs_sha256"] == sha("".join(f"{s},{n},{q}\n" for s, n, q in found))
        assert r["collapsed_sha256"] == sha(slow_collapsed(w, found))
    assert some > 10


def test_made_periodic_without_id_or_words(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    rows = [(ids[0], ""), (ids[1], None), (ids[2], " a  b\tc "), (None, "a b")]
    got = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", queries._made_periodic().alias("t")).collect()
    assert {r["doc_id"]: r["t"] for r in got} == {ids[0]: "", ids[1]: None, ids[2]: " ".join(rebuilt(ids[2], ["a", "b", "c"])), None: "a b"}
