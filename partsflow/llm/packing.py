"""Packing token sequences by Karmarkar-Karp multiway differencing.

A document's ids are cut into full windows and a rest; a rest is cut again into
pieces of at most ``grain`` ids, so that each window can be balanced from
several pieces.  Full pieces are windows of their own.  The other pieces are
grouped in input order, ``group_pieces`` a group, and each group is split into
windows by the largest differencing method: partial partitions are merged,
largest spread first, each time the fullest window of one with the emptiest of
the other.  If the fullest window exceeds the capacity, the group is done again
with one window more.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import sys
import types
import zlib
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from partsflow.llm.common import add_dense_index, materialize

REMEMBERED_WORDS = 400_000  # in each of two generations
JOINED = 1000  # new words encoded at once, between separators
SEPARATOR = "\0"
#: A plain word: letters of the Latin-1 range, then ASCII marks other than the apostrophe.
LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class WordTokenizer:
    """Ids of whole texts by the ``tokenizers`` library.  The vocabulary drops
    white space and never joins words over it, so each word between spaces, tabs
    and line ends is encoded once and remembered, as little-endian unsigned
    32-bit integers.  The memory is bounded: two generations of words."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._t = Tokenizer.from_file(path)
        self._t.encode_special_tokens = True  # their strings in a text are ordinary text
        self._encode = getattr(self._t, "encode_batch_fast", self._t.encode_batch)
        self._separator = self._t.encode(SEPARATOR, add_special_tokens=False).ids
        self._now: dict[str, bytes] = {"": b""}
        self._before: dict[str, bytes] = {}
        self._pieces: dict[str, bytes] = {"": b""}
        self._model = self._bare_model(Tokenizer, path)

    def _bare_model(self, kind, path: str):
        """The model behind a split at blanks; None if the vocabulary's steps are others than plain words assume."""
        from tokenizers.pre_tokenizers import WhitespaceSplit

        steps = json.loads(self._t.to_str())
        kinds = [[x["type"] for x in (steps[part] or {}).get(inner, [])]
                 for part, inner in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))]
        if kinds != [["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]]:
            return None
        # The byte alphabet: printable Latin-1 stands for itself, the other bytes for U+0100 onward.
        same = {*range(33, 127), *range(161, 173), *range(174, 256)}
        others = iter(range(256, 512))
        self._bytes = [chr(i if i in same else next(others)) for i in range(256)]
        bare = kind.from_file(path)
        bare.normalizer = None
        bare.pre_tokenizer = WhitespaceSplit()
        bare.encode_special_tokens = True
        encode = getattr(bare, "encode_batch_fast", bare.encode_batch)
        mark = encode(["0"], add_special_tokens=False)[0].ids  # no piece holds a digit
        return (encode, mark[0]) if len(mark) == 1 else None

    def _encode_plain(self, words: list[str]) -> None:
        encode, mark = self._model
        if len(self._pieces) > REMEMBERED_WORDS:
            self._pieces = {"": b""}
        known, whole = self._pieces, LETTERS.fullmatch
        found, new = [], {}
        for w in words:
            a = w.rstrip(MARKS)
            if a.isalpha() and (a.isascii() or whole(a)):
                b, a = w[len(a):], a.lower()
                found.append((w, a, b))
                if a not in known:
                    new[a] = None
                if b not in known:
                    new[b] = None
        new = list(new)
        shown = [p if p.isascii() else "".join(map(self._bytes.__getitem__, p.encode())) for p in new]
        groups = range(0, len(new), JOINED)
        for at, e in zip(groups, encode([" 0 ".join(shown[i:i + JOINED]) for i in groups], add_special_tokens=False)):
            ids = np.array(e.ids, dtype="<u4")
            ends = [*np.flatnonzero(ids == mark).tolist(), len(ids)]
            raw, start = ids.tobytes(), 0
            for p, end in zip(new[at:at + JOINED], ends):
                known[p] = raw[4 * start:4 * end]
                start = end + 1
        for w, a, b in found:
            self._now[w] = known[a] + known[b]

    def _encode_words(self, words: list[str]) -> None:
        plain = [w for w in words if SEPARATOR not in w] if len(self._separator) == 1 else []
        groups = [plain[i:i + JOINED] for i in range(0, len(plain), JOINED)]
        texts = [f" {SEPARATOR} ".join(g) for g in groups]
        for group, e in zip(groups, self._encode(texts, add_special_tokens=False)):
            ids = np.array(e.ids, dtype="<u4")
            for w, part in zip(group, np.split(ids, np.flatnonzero(ids == self._separator[0]))):
                self._now[w] = part.tobytes()
            for w in group[1:]:  # all but the first begin with the separator's id
                self._now[w] = self._now[w][4:]
        rest = [w for w in words if w not in self._now]
        for w, e in zip(rest, self._encode(rest, add_special_tokens=False)):
            self._now[w] = np.array(e.ids, dtype="<u4").tobytes()

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        words = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in texts]
        if len(self._now) > REMEMBERED_WORDS:
            self._before, self._now = self._now, {"": b""}
        new = []
        for w in set(chain.from_iterable(words)).difference(self._now):
            if w in self._before:
                self._now[w] = self._before[w]
            else:
                new.append(w)
        if self._model:
            self._encode_plain(new)
            new = [w for w in new if w not in self._now]
        self._encode_words(new)
        get = self._now.__getitem__
        return [np.frombuffer(b"".join(map(get, ws)), dtype="<u4") for ws in words]


def _tokenizer(path: str) -> WordTokenizer:
    """One tokenizer a worker process, kept from task to task with the words it remembers."""
    memo = sys.modules.setdefault("partsflow_worker_memo", types.ModuleType("partsflow_worker_memo"))
    kept = memo.__dict__.setdefault("word_tokenizers", {})
    if path not in kept:
        kept.clear()
        kept[path] = WordTokenizer(path)
    return kept[path]


def differencing(sizes: np.ndarray, k: int) -> np.ndarray:
    """Window of each item when ``sizes`` is split into ``k`` near-equal windows
    by Karmarkar-Karp multiway differencing."""
    n = len(sizes)
    left = [np.empty(0, np.int64)]
    right = [np.empty(0, np.int64)]
    # Node 0 is the empty window, nodes 1..n the items, then those of each merge.
    nodes = n + 1
    heap = []
    for i in np.argsort(-sizes, kind="stable"):
        # A partial partition: loads in falling order (the zeros at the end left out), nodes.
        heap.append((-int(sizes[i]), int(i), np.array([sizes[i]], dtype=np.int64), np.array([i + 1], dtype=np.int64)))
    heapq.heapify(heap)
    tick = n
    while len(heap) > 1:
        _, _, a, an = heapq.heappop(heap)
        _, _, b, bn = heapq.heappop(heap)
        if len(a) + len(b) <= k:  # no window of one meets a filled one of the other
            load, node = np.concatenate([a, b]), np.concatenate([an, bn])
        else:
            load, node = np.zeros(k, dtype=np.int64), np.zeros(k, dtype=np.int64)
            load[:len(a)], node[:len(a)] = a, an
            meet = k - len(b)  # b in rising order stands at the end
            both = np.arange(meet, len(a))
            load[meet:] += b[::-1]
            left.append(node[both])
            right.append(bn[::-1][both - meet])
            alone = np.arange(max(len(a), meet), k)
            node[alone] = bn[::-1][alone - meet]
            node[both] = np.arange(nodes, nodes + len(both))
            nodes += len(both)
        order = np.argsort(-load, kind="stable")
        load, node = load[order], node[order]
        spread = int(load[0]) - (int(load[-1]) if len(load) == k else 0)
        heapq.heappush(heap, (-spread, tick, load, node))
        tick += 1
    _, _, load, node = heap[0]
    window = np.zeros(nodes, dtype=np.int64)
    window[node] = np.arange(len(node))
    lefts, rights = np.concatenate(left), np.concatenate(right)
    for m in range(nodes - 1, n, -1):
        window[lefts[m - n - 1]] = window[m]
        window[rights[m - n - 1]] = window[m]
    return window[1:n + 1]


def windows(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Window of each item; as few windows as differencing fits into ``capacity``."""
    if not len(sizes):
        return np.empty(0, np.int64)
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        w = differencing(sizes, k)
        if np.bincount(w, weights=sizes).max() <= capacity:
            return w
        k += 1


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int | None = 1, capacity: int = 2048, grain: int = 512,
           id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(id_col, start, length, ids_crc32, doc_tokens[, ids]): each document cut
    into full windows and smaller pieces.  A null text is empty; without
    ``end_id`` an empty text has no piece."""
    def run(batches):
        t = _tokenizer(tokenizer_path)
        for b in batches:
            texts = [x or "" for x in b["t"]]
            for at in range(0, len(texts), 256):
                rows = []
                for doc, ids in zip(b["id"][at:at + 256], t.encode_batch(texts[at:at + 256])):
                    if end_id is not None:
                        ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    n, start = len(ids), 0
                    while start < n:
                        size = capacity if n - start >= capacity else min(grain, n - start)
                        raw = ids[start:start + size].tobytes()
                        rows.append((doc, start, size, zlib.crc32(raw), n) + ((raw,) if with_ids else ()))
                        start += size
                out = pd.DataFrame(rows, columns=names)
                out["id"] = out["id"].astype("Int64")
                yield out

    names = ["id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    schema = "id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")).mapInPandas(run, schema)


def pack(docs: DataFrame, tokenizer_path: str, end_id: int | None = 1, capacity: int = 2048, grain: int = 512,
         group_pieces: int = 2048, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: id_col, start, length, ids_crc32, doc_tokens,
    sequence_id, offset (and ``ids``, little-endian unsigned 32-bit).

    Every id of every document lies in one piece, every window is gapless from
    offset 0 and holds ``capacity`` ids at most.  Null and empty texts hold the
    end id alone; repeated rows and null ids are packed like others; an empty
    table gives no rows; other columns of ``docs`` are not read.
    """
    cut = materialize(pieces(docs, tokenizer_path, end_id, capacity, grain, id_col, text_col, with_ids), "pack-pieces")
    order = [F.col("id").asc_nulls_first(), F.col("start"), F.col("length"), F.col("ids_crc32")]
    small = add_dense_index(cut.where(F.col("length") < capacity), order, "i")
    small = small.withColumn("g", F.floor(F.col("i") / group_pieces).cast("long"))
    extra = [c for c in cut.columns if c not in ("id", "start", "length")]

    def split(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("i")
        size = group["length"].to_numpy(np.int64)
        w = windows(size, capacity)
        by = np.argsort(w, kind="stable")
        upto = np.cumsum(size[by]) - size[by]
        first = np.r_[True, w[by][1:] != w[by][:-1]]
        base = np.maximum.accumulate(np.where(first, upto, 0))
        out = group.iloc[by].drop(columns=["i"])
        out["sequence_id"] = out["g"] * group_pieces + w[by]
        out["offset"] = upto - base
        return out.drop(columns="g")

    schema = cut.schema.add("sequence_id", "long").add("offset", "long")
    packed = small.groupBy("g").applyInPandas(split, schema)
    n_small = small.agg(F.max("g")).first()[0]
    base = 0 if n_small is None else (n_small + 1) * group_pieces
    full = (add_dense_index(cut.where(F.col("length") == capacity), order, "sequence_id", base)
            .withColumn("offset", F.lit(0).cast("long")))
    cols = [F.col("id").alias(id_col), "start", "length", *extra, "sequence_id", "offset"]
    return packed.select(*cols).union(full.select(*cols))
