"""The conversation trie against brute force and its SQL."""

import hashlib
import random
import zlib
from collections import Counter

import duckdb
import pytest

from partsflow.llm import convtrie, queries

TURNS = "conv_id long, turn long, role string, text string, depth int, owner string, path string"


def slow_trie(paths):
    """paths: conv -> list of (role, text)."""
    members, ends = {}, {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members.setdefault(tuple(p[:d]), []).append(c)
        ends.setdefault(tuple(p), []).append(c)
    kids = Counter(k[:-1] for k in members if k)
    out = Counter()
    for k, m in members.items():
        below = [x for x in members if x[:len(k)] == k]
        out[(min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids[k], sum(1 for x in below if not kids[x]),
             sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x),
             hashlib.sha256(",".join(map(str, sorted(ends.get(k, [])))).encode()).hexdigest())] += 1
    return out


def slow_paths(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0), hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest(), role or "", text or ""))
    return {c: [x[2:] for x in sorted(v)] for c, v in own.items()}


def slow_rebuilt(own):
    out = {}
    for c, p in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + p[h:]
    return out


def conversations(seed, n=160):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(600), n):
        if c % 3:  # some share their beginnings, many are copies
            text = [rng.choice(["hi", "hello 😀", ""])] + [rng.choice(["a", "bb", "ccc"]) for _ in range(rng.choice([0, 1, 2, 6]))]
        else:
            text = ["same", "conversation", "again"]
        rows += [(c, i, rng.choice(["user"] * 5 + ["system", None]) if c % 3 else "user", t) for i, t in enumerate(text)]
    rows += [(1000, None, "user", "null turn"), (1000, 0, "user", None), (1000, 0, "a", "tie"), (1000, 0, "a", "tie"), (1001, 5, "user", "x" * 200_000),
             (None, 0, "user", "no conversation"), (1002, 0, "us", "erhi"), (1003, 0, "user", "hi")]
    rows += [(2000 + c, i, "user", str(i % 7)) for c in range(3) for i in range(700)]  # long paths
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "o", "p") for r in rows], TURNS).repartition(3)


@pytest.mark.parametrize("shards,sampled,skeleton,chunk", [(1, 20, 8_000_000, 16_000), (7, 20, 8_000_000, 16_000), (40, 20, 8_000_000, 8), (40, 2, 3000, 30)])
def test_trie_equals_brute_force(spark, shards, sampled, skeleton, chunk, monkeypatch):
    for name, value in (("SAMPLED", sampled), ("SKELETON_BYTES", skeleton), ("CHUNK", chunk)):
        monkeypatch.setattr(convtrie, name, value)
    rows = conversations(shards)
    got = convtrie.prefix_trie(convtrie.sequences(frame(spark, rows)), shards=shards)
    short = lambda paths: {c: p[:60] if c >= 2000 else p for c, p in paths.items()}
    if shards == 1:
        want = slow_trie(slow_paths(rows))
    else:  # the brute force is cubic in the depth
        rows = [r for r in rows if not (r[0] or 0) >= 2000 or r[1] < 60]
        got = convtrie.prefix_trie(convtrie.sequences(frame(spark, rows)), shards=shards)
        want = slow_trie(short(slow_paths(rows)))
    assert Counter(map(tuple, got.collect())) == want


def test_copies_of_one_conversation_are_spread(spark):
    rows = [(c, i, "user", t) for c in range(4000) for i, t in enumerate(["only", "one", "text"])]
    got = convtrie.prefix_trie(convtrie.sequences(frame(spark, rows)), shards=16).collect()
    assert Counter(map(tuple, got)) == slow_trie(slow_paths(rows))
    paths = convtrie.sequences(frame(spark, rows)).selectExpr("conv_id", "unhex(array_join(transform(steps, s -> s.key), '')) as path")
    cuts = convtrie.choose_splitters(paths, 16)
    sizes = Counter(convtrie.bisect_right(cuts, (bytes(r["path"]), r["conv_id"])) for r in paths.collect())
    assert len(sizes) == 16 and max(sizes.values()) < 4000 / 4


def test_empty_table_and_turnless_conversations(spark):
    df = frame(spark, [(1, 0, "user", "x")])
    assert convtrie.prefix_trie(convtrie.sequences(df.limit(0))).count() == 0
    seqs = convtrie.sequences(df).selectExpr("conv_id", "slice(steps, 1, 0) as steps")
    assert Counter(map(tuple, convtrie.prefix_trie(seqs).collect())) == slow_trie({1: []})


@pytest.mark.parametrize("rows", [conversations(5, 120)[:900], [(199, 0, "u", "a"), (200, 0, "u", "b"), (205, 0, "u", "b")]])
def test_query_equals_brute_force_and_sql(spark, rows, tmp_path):
    rows = [r for r in rows if not (r[0] or 0) >= 2000 or r[1] < 40]
    frame(spark, rows).select("conv_id", "turn", "role", "text").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    got = Counter(map(tuple, queries.op13_trie(spark, str(tmp_path)).collect()))
    assert got == slow_trie(slow_rebuilt(slow_paths(rows)))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert Counter(con.execute(queries.OP13_SQL).fetchall()) == got


def test_query_equals_sql_on_given_table(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op13_trie(spark, sf)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    cur = con.execute(queries.OP13_SQL)
    assert [d[0] for d in cur.description] == got.columns
    assert Counter(cur.fetchall()) == Counter(map(tuple, got.collect()))
