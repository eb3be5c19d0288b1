"""Periodic runs of words, from Lyndon arrays by Baier grouping.

A run is a maximal stretch of words with smallest period q that is at least twice
as long as q.  Each run has a Lyndon root of length q under one of two opposite
orders of the words, and that root is the longest Lyndon word that starts at its
place.  So the longest Lyndon word at each place, under both orders, gives every
candidate (place, period); the longest common extensions of the place and the
place one period on, to both sides, give the run.

The Lyndon arrays come from the first phase of Baier's suffix sorter: suffixes are
grouped by their first word; groups are taken from the highest down, and each
moves, for each of its suffixes, the nearest suffix to the left that is in a lower
group into a new group just above its old one, whose context is longer by the
moved copies.  When all groups are done, the context of a suffix is its longest
Lyndon prefix.  The suffixes are never sorted further.

Words of a run of ``min_length`` words or more lie in repeated strings of
``(min_length + 1) // 2`` words of the same text, so only the stretches that such
strings cover are grouped; no run is lost, and none ends elsewhere, by that.
Extensions are found by halving on prefix hashes and then compared word by word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from partsflow.llm.common import fresh

GROUP_BYTES = 4_000_000  # bytes of the texts handled at once (a longer text alone)
MODULI = (2_147_483_647, 2_147_483_629)
BASES = (1_103_515_245, 1_664_525_003)
RUN = T.ArrayType(T.StructType().add("start", "long", False).add("length", "long", False).add("period", "long", False), False)


def lyndon_lengths(keys: list[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at each place of ``keys``.

    Keys are ordered as numbers; 0 separates strings, is below all and in no word.
    The first key is a separator."""
    order = sorted(set(keys))
    number = {k: g for g, k in enumerate(order)}
    group = [number[k] for k in keys]
    members: list[list[int]] = [[] for _ in order]
    for i, g in enumerate(group):
        members[g].append(i)
    context = [1] * len(order)
    below = list(range(-1, len(order) - 1))
    above = list(range(1, len(order) + 1))
    left = list(range(len(keys)))  # towards the nearest place of a group that is not done
    g = len(order) - 1
    while g > 0:  # group 0 holds the separators
        own = [i for i in members[g] if group[i] == g]
        for i in own:
            left[i] = i - 1
        copies: dict[int, int] = {}
        for i in own:
            j = left[i]
            while left[j] != j:
                left[j] = j = left[left[j]]
            left[i] = j
            if group[j]:
                copies[j] = copies.get(j, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for j, n in copies.items():
            moved.setdefault((n, group[j]), []).append(j)
        for n, h in sorted(moved, reverse=True):  # of one old group, more copies stand higher
            new, up = len(context), above[h]
            members.append(moved[n, h])
            context.append(context[h] + n * context[g])
            below.append(h)
            above.append(up)
            above[h] = new
            below[up] = new  # h is below g, so something is above it
            for j in moved[n, h]:
                group[j] = new
        g = below[g]
    return [context[x] for x in group]


class _Hashes:
    """Prefix hashes of a string: equal strings have equal hashes."""

    def __init__(self, word: np.ndarray):
        self._parts = []
        for p, b in zip(MODULI, BASES):
            power = np.ones(len(word) + 1, dtype=np.uint64)
            done, top = 1, b
            while done <= len(word):
                take = min(done, len(word) + 1 - done)
                power[done:done + take] = power[:take] * np.uint64(top) % np.uint64(p)
                done, top = done + take, top * top % p
            sums = np.zeros(len(word) + 1, dtype=np.uint64)
            np.cumsum((word.astype(np.uint64) + np.uint64(1)) * power[:-1] % np.uint64(p), out=sums[1:])
            self._parts.append((np.uint64(p), power, sums % np.uint64(p)))

    def same(self, x: np.ndarray, shift: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the ``n`` words at ``x`` and at ``x + shift`` have equal hashes."""
        ok = np.ones(len(x), dtype=bool)
        for p, power, sums in self._parts:
            a = (sums[x + n] + p - sums[x]) % p * power[shift] % p
            b = (sums[x + shift + n] + p - sums[x + shift]) % p
            ok &= a == b
        return ok


def _longest(limit: np.ndarray, same) -> np.ndarray:
    """The greatest n up to ``limit`` with same(index, n); same(_, 0) holds."""
    low, high = np.zeros_like(limit), limit.copy()
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        mid = (low[open_] + high[open_] + 1) // 2
        ok = same(open_, mid)
        low[open_[ok]] = mid[ok]
        high[open_[~ok]] = mid[~ok] - 1


def runs_of(word: np.ndarray, bounds: np.ndarray, min_length: int) -> np.ndarray:
    """(start, length, period) of the runs of at least ``min_length`` words in the
    strings word[bounds[i]:bounds[i + 1]], by start, then period.  Words are numbers from 0."""
    none = np.empty((0, 3), dtype=np.int64)
    if len(word) < 2:
        return none
    # Separators go in front of each string; place[i] is the place of word i among them.
    place = np.arange(len(word)) + np.repeat(np.arange(1, len(bounds)), np.diff(bounds))
    top = int(word.max()) + 2
    found = []
    for key in (word + 1, top - 1 - word):
        keys = np.zeros(len(word) + len(bounds) - 1, dtype=np.int64)
        keys[place] = key
        found.append(np.array(lyndon_lengths(keys.tolist()), dtype=np.int64)[place])
    at = np.arange(len(word))
    begin = np.repeat(bounds[:-1], np.diff(bounds))
    end = np.repeat(bounds[1:], np.diff(bounds))
    at, period = np.concatenate([at, at[found[1] != found[0]]]), np.concatenate([found[0], found[1][found[1] != found[0]]])
    # A candidate goes on to the right or to the left, or it is no run.
    right = (at + period < end[at]) & (word[at] == word[np.minimum(at + period, len(word) - 1)])
    left = (at > begin[at]) & (word[at - 1] == word[at + period - 1])
    may = (right | left) & (end[at] - begin[at] >= np.maximum(2 * period, min_length))
    at, period = at[may], period[may]
    if not len(at):
        return none
    hashes = _Hashes(word)
    ahead = _longest(end[at] - at - period, lambda i, n: hashes.same(at[i], period[i], n))
    back = _longest(at - begin[at], lambda i, n: hashes.same(at[i] - n, period[i], n))
    s, e = at - back, at + period + ahead
    long = e - s >= np.maximum(2 * period, min_length)
    s, e, at, period = s[long], e[long], at[long], period[long]
    runs, which = np.unique(np.stack([s, e - s, period], axis=1), axis=0, return_inverse=True)
    wrong = [i for i, (x, n, q) in enumerate(runs.tolist()) if not np.array_equal(word[x:x + n - q], word[x + q:x + n])]
    if wrong:  # two different strings had equal hashes
        again = np.isin(which.ravel(), wrong)
        exact = [_compared(word, int(begin[i]), int(end[i]), i, q) for i, q in zip(at[again].tolist(), period[again].tolist())]
        exact = [(x, n, q) for x, n, q in exact if n >= max(2 * q, min_length)]
        runs = np.unique(np.concatenate([np.delete(runs, wrong, axis=0), np.array(exact, dtype=np.int64).reshape(-1, 3)]), axis=0)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _compared(word: np.ndarray, begin: int, end: int, at: int, period: int) -> tuple[int, int, int]:
    """The run of ``period`` around ``at``, word by word."""
    s, e = at, at + period
    while e < end and word[e] == word[e - period]:
        e += 1
    while s > begin and word[s - 1] == word[s - 1 + period]:
        s -= 1
    return s, e - s, period


def repeated_stretches(word: np.ndarray, bounds: np.ndarray, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches that are covered by strings of
    ``gram`` words found twice or more in the same text (at times a few more: by hash)."""
    sizes = np.diff(bounds)
    text = np.repeat(np.arange(len(sizes), dtype=np.uint64), sizes)
    n = len(word) - gram + 1
    if n <= 1:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    mixed = (word.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    h = text[:n] * np.uint64(0xD6E8FEB86659FD93)
    for j in range(gram):
        h = (h + mixed[j:j + n]) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    start = np.flatnonzero(text[:n] == text[gram - 1:])  # strings within one text
    order = start[np.argsort(h[start])]
    same = h[order[1:]] == h[order[:-1]]
    hit = np.zeros(len(order), dtype=bool)
    hit[1:] |= same
    hit[:-1] |= same
    step = np.zeros(len(word) + 1, dtype=np.int64)
    starts = order[hit]
    step[starts] += 1
    np.add.at(step, starts + gram, -1)
    covered = np.cumsum(step[:-1]) > 0
    fresh_text = np.zeros(len(word), dtype=bool)
    fresh_text[bounds[:-1][sizes > 0]] = True
    before = np.concatenate([[False], covered[:-1]])
    after = np.concatenate([covered[1:], [False]])
    next_text = np.concatenate([fresh_text[1:], [True]])
    return np.flatnonzero(covered & (~before | fresh_text)), np.flatnonzero(covered & (~after | next_text)) + 1


class _Numbers(dict):
    def __missing__(self, word):
        n = len(self)
        self[word] = n
        return n


def periodic_runs(docs: DataFrame, min_length: int = 12, text_col: str = "text", runs_col: str = "runs",
                  collapsed_col: str = "collapsed", n_words_col: str | None = None) -> DataFrame:
    """``docs`` with ``runs_col``, the runs of at least ``min_length`` words as an array
    of (start, length, period) by start, then period, and ``collapsed_col``, the text
    with each run cut to its first period: a word that any run holds after its first
    ``period`` words goes, the others are joined by one space.  Words are stretches
    without ASCII white space, numbered from 0.  ``n_words_col`` names an optional count.

    Narrow: no shuffle, and each text is handled whole: a run may be as long as its
    text.  A null text has no words; rows are independent, so repeated rows are
    treated alike; an empty table gives an empty one; columns of the given names are
    replaced.  Memory goes with the longest text: some 20 bytes a word, and
    400 bytes a word of repeated stretches.
    """
    if min_length < 2:
        raise ValueError("min_length is at least 2")
    text, runs, collapsed, count = (fresh(docs, x) for x in ("t", "runs", "collapsed", "words"))
    keep = [c for c in docs.columns if c not in (runs_col, collapsed_col, n_words_col)]

    def handle(texts: list[bytes]) -> list[pa.Array]:
        words = [t.split() for t in texts]
        bounds = np.cumsum([0, *map(len, words)])
        numbers = _Numbers()
        flat = np.fromiter((numbers[w] for own in words for w in own), dtype=np.int64, count=int(bounds[-1]))
        starts, ends = repeated_stretches(flat, bounds, (min_length + 1) // 2)
        inner = np.cumsum(np.concatenate([[0], ends - starts]))
        source = np.arange(inner[-1]) + np.repeat(starts - inner[:-1], ends - starts)
        found = runs_of(np.unique(flat[source], return_inverse=True)[1], inner, min_length) if len(source) else np.empty((0, 3), np.int64)
        found[:, 0] = source[found[:, 0]]
        owner = np.searchsorted(bounds, found[:, 0], side="right") - 1
        step = np.zeros(len(flat) + 1, dtype=np.int64)
        np.add.at(step, found[:, 0] + found[:, 2], 1)
        np.add.at(step, found[:, 0] + found[:, 1], -1)
        gone = np.cumsum(step[:-1]) > 0
        kept = list(words)
        for i in np.unique(owner).tolist():
            kept[i] = [w for w, x in zip(words[i], gone[bounds[i]:bounds[i + 1]].tolist()) if not x]
        places = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
        rows = pa.StructArray.from_arrays([pa.array(found[:, 0] - bounds[owner]), pa.array(found[:, 1]), pa.array(found[:, 2])],
                                          fields=[pa.field(x, pa.int64(), False) for x in ("start", "length", "period")])
        item = pa.field("element", rows.type, False)
        lists = pa.ListArray.from_arrays(pa.array(places), rows).cast(pa.list_(item))
        joined = pa.array([b" ".join(x) for x in kept], pa.binary()).cast(pa.string())
        return [lists, joined, pa.array(np.diff(bounds))]

    def run(batches):
        for b in batches:
            texts, at = b.column(text).to_pylist(), 0
            rest = b.drop_columns([text])
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) <= GROUP_BYTES):
                    size += len(texts[end])
                    end += 1
                part = rest.slice(at, end - at)
                columns = handle(texts[at:end])[:3 if n_words_col else 2]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=[*part.schema.names, *[runs, collapsed, count][:len(columns)]])
                at = end

    source = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias(text))
    schema = T.StructType([f for f in source.schema.fields if f.name != text]).add(runs, RUN).add(collapsed, "string")
    if n_words_col:
        schema = schema.add(count, "long")
    out = source.mapInArrow(run, schema).withColumnRenamed(runs, runs_col).withColumnRenamed(collapsed, collapsed_col)
    return out.withColumnRenamed(count, n_words_col) if n_words_col else out
