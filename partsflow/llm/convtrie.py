"""The prefix trie of conversations, by a splitter skeleton.

A conversation is a path of turns; every distinct prefix is a node.  Conversations
are range-partitioned by (path, id) at splitters from a sample.  Only a node whose
path is a prefix of a splitter's path can have members in two shards: these nodes
are the skeleton, the trie of the splitter paths, which is broadcast.  A task sorts
its shard and reads it once, with the current path on a stack: a node off the
skeleton is finished where its last member passes; of a skeleton node each shard
gives a partial aggregate.  The partials of a node are combined in shard order, and
the skeleton, of bounded size, is summed up from its leaves.

A turn stands in a path as the 128-bit hash of its role and text, so neither texts
nor whole paths as text are shuffled.  Copies of one conversation, however many,
are dealt over shards by their ids.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from partsflow.llm.common import materialize

KEY = 16  # bytes of a turn in a path
SAMPLED = 20  # sampled conversations a shard
SKELETON_BYTES = 8_000_000  # of splitter paths, so the skeleton has at most a 16th as many nodes
LONGEST_SPLITTER = 1_000_000  # bytes of its path
CHUNK = 16_000  # characters of ids in one row of a skeleton node's partial

NODE = ("conv_id long, depth int, parent_conv_id long, parent_owner int, owner int, shard int, chunk int, "
        "n_convs long, n_children long, n_leaves long, saved long, size long, ends binary, ids string")
SUM = "owner int, depth int, conv_id long, n_convs long, n_children long, n_leaves long, saved long, size long, ends binary"
DONE = "owner int, depth int, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved long, ends binary"


def sequences(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """(conv_id, steps): the turns of each conversation in order of ``turn_col``, null
    first (equal turns: by their hash), each as (key, size): the hash of role and text
    (null: empty) as hexadecimal digits and the code points of the text.  Rows without
    a conversation id belong to no conversation; repeated rows are turns of their own."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    step = F.struct(F.col(turn_col).alias("turn"), F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("key"),
                    F.length(text).cast("int").alias("size"))
    rows = turns.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("conv_id"), step.alias("s"))
    return rows.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list("s")), lambda s: F.struct(s["key"].alias("key"), s["size"].alias("size"))).alias("steps"))


def _common(a: bytes, b: bytes) -> int:
    """Turns that two paths have in common at their start."""
    low, high = 0, min(len(a), len(b)) // KEY
    if a[:high * KEY] == b[:high * KEY]:
        return high
    while low < high:
        mid = (low + high + 1) // 2
        if a[:mid * KEY] == b[:mid * KEY]:
            low = mid
        else:
            high = mid - 1
    return low


class Skeleton:
    """The trie of sorted splitters (path, id); node: (first splitter with its path, depth)."""

    def __init__(self, splitters: list[tuple[bytes, int]]):
        self.splitters = splitters
        self.owner: list[np.ndarray] = []
        for k, (path, _) in enumerate(splitters):
            own = np.full(len(path) // KEY + 1, k, dtype=np.int32)
            if k:
                n = _common(splitters[k - 1][0], path) + 1
                own[:n] = self.owner[-1][:n]
            self.owner.append(own)

    def owners(self, shard: int, path: bytes) -> np.ndarray | list:
        """Owners of the skeleton nodes of a path in a shard, by depth from 0."""
        best: np.ndarray | list = []
        for k in (shard - 1, shard):  # the splitters around the shard
            if 0 <= k < len(self.splitters):
                n = _common(self.splitters[k][0], path) + 1
                if n > len(best):
                    best = self.owner[k][:n]
        return best


def choose_splitters(paths: DataFrame, shards: int) -> list[tuple[bytes, int]]:
    """Up to ``shards`` - 1 splitters from a sample of ``paths`` (conv_id, path) by a hash
    of the id.  The sample's size is bounded in rows and bytes; it sets sizes of shards only."""
    n, size = paths.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("path")), F.lit(0))).first()
    every = max(1, n // (SAMPLED * shards), size // SKELETON_BYTES)
    sample = paths.where((F.pmod(F.xxhash64("conv_id"), F.lit(every)) == 0) & (F.octet_length("path") <= LONGEST_SPLITTER)).select("path", "conv_id")
    rows = sorted((bytes(r["path"]), r["conv_id"]) for r in sample.collect()) if shards > 1 else []
    picked = sorted({rows[k * len(rows) // shards] for k in range(1, shards)}) if rows else []
    while sum(len(p) + KEY for p, _ in picked) > SKELETON_BYTES:
        picked = picked[1::2]
    return picked


class _Node:
    __slots__ = ("owner", "size", "n", "least", "children", "leaves", "saved", "sha", "ids", "chars", "chunk", "waiting")

    def __init__(self, owner: int, size: int):
        self.owner, self.size = owner, size  # owner -1: off the skeleton
        self.n = self.children = self.leaves = self.saved = self.chars = self.chunk = 0
        self.least, self.sha, self.ids = None, None, []
        self.waiting: list[tuple] = []  # finished children that wait for the smallest member


class _Shard:
    """One pass over the sorted conversations of a shard."""

    def __init__(self, shard: int, skeleton: Skeleton):
        self.shard, self.skeleton, self.path, self.stack, self.rows = shard, skeleton, b"", [], []

    def add(self, path: bytes, conv: int, sizes: list[int]) -> None:
        if not self.stack or path != self.path:
            keep = _common(self.path, path) + 1 if self.stack else 0
            while len(self.stack) > keep:
                self._pop()
            owners = self.skeleton.owners(self.shard, path)
            for depth in range(len(self.stack), len(path) // KEY + 1):
                self.stack.append(_Node(int(owners[depth]) if depth < len(owners) else -1, sizes[depth - 1] if depth else 0))
            self.path = path
        node = self.stack[-1]
        node.n += 1
        node.least = conv if node.least is None else min(conv, node.least)
        if node.owner < 0:
            if node.sha is None:
                node.sha = hashlib.sha256(str(conv).encode())
            else:
                node.sha.update(f",{conv}".encode())
            return
        node.ids.append(str(conv))
        node.chars += len(node.ids[-1]) + 1
        if node.chars >= CHUNK:
            self._partial(node, len(self.stack) - 1, whole=False)

    def close(self) -> None:
        while self.stack:
            self._pop()

    def _partial(self, node: _Node, depth: int, whole: bool) -> None:
        sums = (node.n, node.children, node.leaves, node.saved) if whole else (0, 0, 0, 0)
        self.rows.append((node.least if whole else None, depth, None, None, node.owner, self.shard, node.chunk, *sums, node.size, None, ",".join(node.ids)))
        node.ids, node.chars, node.chunk = [], 0, node.chunk + 1

    def _pop(self) -> None:
        node = self.stack.pop()
        depth = len(self.stack)
        up = self.stack[-1] if self.stack else None
        if up is not None:
            up.n += node.n
            if node.least is not None:
                up.least = node.least if up.least is None else min(up.least, node.least)
        if node.owner >= 0:
            self._partial(node, depth, whole=True)
            return
        self.rows += [(r[0], r[1], node.least, *r[3:]) for r in node.waiting]
        leaves, saved = node.leaves or 1, node.saved + (node.n - 1) * node.size
        row = (node.least, depth, None, up.owner if up is not None and up.owner >= 0 else None, None, None, None, node.n, node.children, leaves, saved,
               node.size, node.sha.digest() if node.sha else None, None)
        if up is None:
            self.rows.append(row)
            return
        up.children += 1
        up.leaves += leaves
        up.saved += saved
        (self.rows if up.owner >= 0 else up.waiting).append(row)


def _columns(schema: str) -> list[tuple[str, pa.DataType]]:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    return [(name, kinds[kind]) for name, kind in (x.strip().split(" ") for x in schema.split(","))]


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    named = _columns(schema)
    return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, (_, kind) in zip(zip(*rows), named)], names=[n for n, _ in named])


def _finish_shards(skeleton):
    def run(batches):
        open_: _Shard | None = None
        for b in batches:
            sizes = b.column("sizes")
            flat, at = sizes.flatten().to_pylist(), (np.asarray(sizes.offsets) - sizes.offsets[0].as_py()).tolist()
            for i, (shard, path, conv) in enumerate(zip(*(b.column(x).to_pylist() for x in ("shard", "path", "conv_id")))):
                if open_ is None or open_.shard != shard:
                    if open_ is not None:
                        open_.close()
                        if open_.rows:
                            yield _batch(open_.rows, NODE)
                    open_ = _Shard(shard, skeleton.value)
                open_.add(path, conv, flat[at[i]:at[i + 1]])
                if len(open_.rows) >= 5000:
                    yield _batch(open_.rows, NODE)
                    open_.rows = []
        if open_ is not None:
            open_.close()
            if open_.rows:
                yield _batch(open_.rows, NODE)
    return run


def _combine(batches):
    """Partials sorted by node, shard and chunk -> one row a node."""
    key, sums, sha, least, first = None, None, None, None, True

    def done():
        return (key[0], key[1], least, *sums[:4], sums[4], None if first else sha.digest())

    for b in batches:
        out = []
        cols = (b.column(x).to_pylist() for x in ("owner", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved", "size", "ids"))
        for owner, depth, conv, n, children, leaves, saved, size, ids in zip(*cols):
            if (owner, depth) != key:
                if key is not None:
                    out.append(done())
                key, sums, sha, least, first = (owner, depth), [0, 0, 0, 0, size], hashlib.sha256(), None, True
            for i, x in enumerate((n, children, leaves, saved)):
                sums[i] += x
            if conv is not None:
                least = conv if least is None else min(conv, least)
            if ids:
                sha.update(ids.encode() if first else b"," + ids.encode())
                first = False
        if out:
            yield _batch(out, SUM)
    if key is not None:
        yield _batch([done()], SUM)


def _sum_up(skeleton):
    def run(batches):
        rows = [tuple(r.values()) for b in batches for r in b.to_pylist()]
        owner = skeleton.value.owner
        nodes = {r[:2]: list(r[2:]) for r in sorted(rows, key=lambda r: -r[1])}  # deepest first
        up = {(o, d): (int(owner[o][d - 1]), d - 1) for o, d in nodes if d}
        for k, r in nodes.items():
            _, n, _, leaves, _, size, _ = r
            r[3] = leaves or 1
            r[4] += (n - 1) * size
            if k in up:
                parent = nodes[up[k]]
                parent[2] += 1
                parent[3] += r[3]
                parent[4] += r[4]
        out = [(*k, r[0], nodes[up[k]][0] if k in up else None, *r[1:5], r[6]) for k, r in nodes.items()]
        for at in range(0, len(out), 10_000):
            yield _batch(out[at:at + 10_000], DONE)
    return run


def prefix_trie(seqs: DataFrame, shards: int | None = None) -> DataFrame:
    """The nodes of the trie of ``seqs`` (conv_id long, distinct and not null, steps
    array of (key, size) as ``sequences`` gives them; more columns are ignored):
    conv_id (smallest member), depth, parent_conv_id (null: root), n_convs, n_children,
    n_leaves and saved_tokens of the subtree, ends_sha256 of the members that end there.

    An empty table has no node; a conversation without steps ends at the root.  The
    sequences are shuffled once, as 16 bytes and a number a turn.  A path is one row,
    so a conversation has up to some 50 million turns; memory of a task goes with its
    longest path and the widest open node of its shard.  ``shards`` defaults to
    ``spark.sql.shuffle.partitions``.
    """
    spark = seqs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    paths = materialize(seqs.select("conv_id", F.unhex(F.array_join(F.transform("steps", lambda s: s["key"]), "")).alias("path"),
                                    F.transform("steps", lambda s: s["size"]).alias("sizes")), "trie-paths")
    splitters = choose_splitters(paths, shards)
    skeleton = spark.sparkContext.broadcast(Skeleton(splitters))

    def place(batches):
        cuts = skeleton.value.splitters
        for b in batches:
            shard = [bisect_right(cuts, x) for x in zip(b.column("path").to_pylist(), b.column("conv_id").to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shard, pa.int32())], names=["conv_id", "path", "sizes", "shard"])

    placed = (paths.mapInArrow(place, "conv_id long, path binary, sizes array<int>, shard int")
              .repartitionById(len(splitters) + 1, F.col("shard")).sortWithinPartitions("shard", "path", "conv_id"))
    found = materialize(placed.mapInArrow(_finish_shards(skeleton), NODE), "trie-nodes")
    partials = found.where("owner is not null")
    combined = (partials.repartition(F.col("owner"), F.col("depth")).sortWithinPartitions("owner", "depth", "shard", "chunk")
                .mapInArrow(_combine, SUM))
    # One task for the skeleton alone, at most SKELETON_BYTES / KEY nodes and a root.
    top = materialize(combined.repartition(1).mapInArrow(_sum_up(skeleton), DONE), "trie-skeleton")
    names = top.select(F.col("owner").alias("parent_owner"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("__up"))
    low = (found.where("owner is null").join(F.broadcast(names), ["parent_owner", "depth"], "left")
           .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "__up")))
    columns = [c for c, _ in _columns(DONE) if c != "owner"]
    none = hashlib.sha256(b"").hexdigest()
    out = low.select(*columns).unionByName(top.select(*columns))
    return out.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.coalesce(F.lower(F.hex("ends")), F.lit(none)).alias("ends_sha256"))
