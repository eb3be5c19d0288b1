"""Byte-level BPE encoding and decoding.

A word is one match of the split pattern.  The commonest distinct words of the
corpus are encoded by Spark higher-order functions: a word is an array of bytes,
each written as two hexadecimal digits (so that joining pieces is string
concatenation), and a fold merges, one at a time, the adjacent pair of lowest
rank (the first of equals) until no pair has a rank.  A word that is itself in
the vocabulary is one id, as in the tiktoken library.  Ranks are a literal map
from piece to id, in hash buckets, because Spark searches a map entry by entry.

Those ``dictionary_words`` words are broadcast: a bound on their number and
length, not the corpus, sets the size.  Tasks look up each word of each whole
text there; a rarer word gets the same merges in the task itself (from a heap,
so that a word of megabytes costs n log n) and is remembered in a bounded memory.
Only word counts are shuffled.  Decoding concatenates the byte pieces of the ids.
"""

from __future__ import annotations

import base64
import heapq
import json
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from partsflow.llm.common import materialize

BUCKETS = 16_384
DICTIONARY_WORDS = 262_144
DICTIONARY_BYTES = 64  # longer words never enter the dictionary
MEMORY_WORDS = 200_000  # words that a task remembers beside it
NO_RANK = 2**31 - 1


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class RankMap:
    """The ranks as a literal array (by hash) of maps from hexadecimal piece to rank."""

    def __init__(self, ranks: dict[bytes, int]):
        import xxhash

        maps: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
        for piece, rank in ranks.items():
            key = piece.hex().upper()
            h = xxhash.xxh64_intdigest(key.encode(), 42)  # as Spark's xxhash64, which is signed
            maps[(h - (1 << 64) if h >> 63 else h) % BUCKETS][key] = rank
        self._literal = F.from_json(F.lit(json.dumps(maps)), "array<map<string,int>>")

    @staticmethod
    def rank(table: Column, piece: Column) -> Column:
        return F.element_at(F.get(table, F.pmod(F.xxhash64(piece), F.lit(BUCKETS)).cast("int")), piece)

    def fold(self, word: Column) -> Column:
        """Ids of one word by folding ranked merges over its bytes.  The literal is
        bound once: the planner looks at every occurrence of a literal many times."""
        return F.get(F.transform(F.array(self._literal), lambda table: self._fold(table, word)), F.lit(0))

    def _fold(self, table: Column, word: Column) -> Column:
        whole = F.hex(word.cast("binary"))
        n = F.octet_length(word)
        parts = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(whole, i * 2 + 1, F.lit(2)))

        def step(acc: Column, _: Column) -> Column:
            ranks = F.transform(F.slice(acc, 2, F.greatest(F.size(acc) - 1, F.lit(0))),
                                lambda y, i: F.coalesce(self.rank(table, F.concat(F.get(acc, i), y)), F.lit(NO_RANK)))

            def merge(r: Column) -> Column:
                at = F.array_position(r, F.array_min(r)).cast("int")
                return F.when(F.coalesce(F.array_min(r), F.lit(NO_RANK)) == NO_RANK, acc).otherwise(F.concat(
                    F.slice(acc, F.lit(1), at - 1), F.array(F.concat(F.get(acc, at - 1), F.get(acc, at))),
                    F.slice(acc, at + 2, F.greatest(F.size(acc) - at - 1, F.lit(0)))))

            return F.get(F.transform(F.array(ranks), merge), F.lit(0))

        merged = F.aggregate(F.sequence(F.lit(1), n), parts, step)
        one = self.rank(table, whole)
        return F.when(one.isNotNull(), F.array(one)).otherwise(F.transform(merged, lambda x: self.rank(table, x)))


def word_finder(pattern: str):
    """A function from a text to its words, the matches of ``pattern``.

    Texts of Latin-1 characters only are matched by the standard library, several
    times faster, with the letters, numbers and white space of that range spelled
    out; the others by the ``regex`` module.  Both give the same words."""
    import re
    import unicodedata

    import regex

    def latin(letter: str) -> str:
        return "".join(re.escape(chr(i)) for i in range(256) if unicodedata.category(chr(i))[0] == letter)

    blank = r"\t-\r \x85\xa0"
    narrow = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{blank}{latin('L')}{latin('N')}]")
    narrow = narrow.replace(r"\p{L}", f"[{latin('L')}]").replace(r"\p{N}", f"[{latin('N')}]")
    narrow = narrow.replace(r"\S", f"[^{blank}]").replace(r"\s", f"[{blank}]")
    wide = regex.compile(pattern).findall
    if "\\p" in narrow:  # a property that is not spelled out above
        return wide
    fast = re.compile(narrow).findall

    def find(text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return wide(text)
        return fast(text)

    return find


def heap_merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word by the same merges, in n log n steps."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    piece = [word[i:i + 1] for i in range(n)]
    nxt, prev = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(ranks[word[i:i + 2]], i, 1, 1) for i in range(n - 1) if word[i:i + 2] in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = nxt[i]
        if len(piece[i]) != a or j >= n or len(piece[j]) != b:
            continue  # one of the two has been merged since
        piece[i] += piece[j]
        piece[j] = b""
        nxt[i] = nxt[j]
        for x, y in ((i, nxt[i]), (prev[i], i)):
            if x >= 0 and y < n:
                prev[y] = x
                two = piece[x] + piece[y]
                if two in ranks:
                    heapq.heappush(heap, (ranks[two], x, len(piece[x]), len(piece[y])))
    return [ranks[p] for p in piece if p]


def word_counts(docs: DataFrame, pattern: str, text_col: str = "text") -> DataFrame:
    """(w, n): the words of up to DICTIONARY_BYTES bytes and how often each occurs."""
    def run(batches):
        find = word_finder(pattern)
        for b in batches:
            c: Counter = Counter()
            for t in b["t"]:
                if t:
                    c.update(find(t))
            words = [w for w in c if len(w) <= DICTIONARY_BYTES and len(w.encode()) <= DICTIONARY_BYTES]
            yield pd.DataFrame({"w": pd.Series(words, dtype=object), "n": pd.Series([c[w] for w in words], dtype="int64")})

    return (docs.select(F.col(text_col).alias("t")).mapInPandas(run, "w string, n long")
            .groupBy("w").agg(F.sum("n").alias("n")))


def dictionary(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text_col: str = "text",
               size: int = DICTIONARY_WORDS) -> DataFrame:
    """(w, ids) of the ``size`` commonest words (ties: the smaller word), folded by Spark."""
    top = materialize(word_counts(docs, pattern, text_col).orderBy(F.desc("n"), "w").limit(size), "bpe-words")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return top.repartition(parts, "w").select("w", RankMap(ranks).fold(F.col("w")).alias("ids"))


def encode(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", ids_col: str = "ids",
           decoded_col: str | None = None, keep: list[str] | None = None, dictionary_words: int = DICTIONARY_WORDS) -> DataFrame:
    """The columns ``keep`` (default: all but those two) with the ids of each whole
    text, as binary: little-endian unsigned 32-bit integers.  ``decoded_col``
    names an optional column with the bytes that the ids decode to.

    A null text is empty and has no ids; rows are independent, so repeated rows
    are treated alike; an empty table gives an empty one.
    """
    ranks = read_ranks(ranks_path)
    known = {r["w"]: np.array(r["ids"], dtype="<u4").tobytes() for r in
             dictionary(docs, ranks, pattern, text_col, dictionary_words).toLocalIterator()}
    shared = docs.sparkSession.sparkContext.broadcast((ranks, known))
    keep = [c for c in (docs.columns if keep is None else keep) if c not in (ids_col, decoded_col)]

    def run(batches):
        find = word_finder(pattern)
        ranks, known = shared.value
        pieces = [b""] * (max(ranks.values(), default=-1) + 1)
        for piece, rank in ranks.items():
            pieces[rank] = piece
        seen: dict[str, bytes] = {}

        def rare(w: str) -> bytes:
            got = seen.get(w)
            if got is None:
                got = np.array(heap_merge(w.encode("utf-8", "surrogatepass"), ranks), dtype="<u4").tobytes()
                if len(w) <= DICTIONARY_BYTES:
                    if len(seen) >= MEMORY_WORDS:
                        seen.clear()
                    seen[w] = got
            return got

        get = known.get
        for b in batches:
            for at in range(0, len(b), 500):
                part = b.iloc[at:at + 500]
                ids = [b"".join([get(w) or rare(w) for w in find(t or "")]) for t in part["__t"]]
                out = part.drop(columns="__t")
                out[ids_col] = pd.Series(ids, index=out.index, dtype=object)
                if decoded_col:
                    out[decoded_col] = pd.Series([decode(i, pieces) for i in ids], index=out.index, dtype=object)
                yield out

    schema = docs.select(*keep).schema.add(ids_col, "binary")
    if decoded_col:
        schema = schema.add(decoded_col, "binary")
    return docs.select(*keep, F.col(text_col).alias("__t")).mapInPandas(run, schema)


def decode(ids: bytes, pieces: list[bytes]) -> bytes:
    """The bytes of little-endian unsigned 32-bit ids."""
    return b"".join(map(pieces.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))
