"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into five blocks (13, 13, 13, 13, 12 bits).  Two
fingerprints at distance 4 or less agree on one whole block (pigeonhole), and
the other 51 or 52 bits, cut in two halves, hold 2 errors or fewer in one half.
The first 23 bits of a half are decoded in the binary Golay code (23, 12, 7):
the keys of a 23-bit word are the codewords nearest to the word itself and to
its 23 neighbours at distance 1 (one to six codewords).  Two words at distance 2
or less have a common neighbour, so they share a key.  One key is therefore
(block, half, value of the block, codeword): 25 bits, at most 60 keys for a
fingerprint, and every link of distance 4 or less shares at least one.

Only distinct fingerprints are keyed, so exact copies cost one row.  A key with
more than ``tile`` fingerprints is cut into tiles of pairs of chunks, so no task
holds an unbounded group, and a tile gives a star for each of its components,
not all pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from partsflow.llm.common import fresh, materialize
from partsflow.llm.components import connected_components

SEED = 42
BLOCKS = (13, 13, 13, 13, 12)
MAX_TILE = 512


# ---------------------------------------------------------------- fingerprints
def text_fingerprint(text: str | None, shingle: int = 4, piece: int = 65536) -> int:
    """Unsigned 64-bit SimHash of a whole text; null and wordless texts give 0."""
    import xxhash

    if not text:
        return 0
    # bytes.lower() and bytes.split() touch exactly A-Z and \x20 \x09-\x0D.
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    counts = np.zeros(64, dtype=np.int64)
    h = xxhash.xxh64_intdigest
    for at in range(0, n, piece):
        end = min(n, at + piece)
        values = np.fromiter((h(b" ".join(words[i:i + shingle]), SEED) for i in range(at, end)), dtype=np.uint64, count=end - at)
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in range(64) if 2 * counts[i] > n))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(id, fp): one row per input row; ``fp`` is the fingerprint as a signed long."""
    def run(batches):
        for b in batches:
            fp = np.array([text_fingerprint(t, shingle) for t in b["t"]], dtype=np.uint64).view(np.int64)
            yield pd.DataFrame({"id": b["id"], "fp": fp})

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    return src.mapInPandas(run, "id long, fp long")


# ------------------------------------------------------------------ Golay code
GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1


def syndrome(x: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words by the generator polynomial."""
    s = x.copy()
    for bit in range(22, 10, -1):
        s ^= ((s >> bit) & 1) * (GENERATOR << (bit - 11))
    return s


def golay_leaders() -> np.ndarray:
    """The error pattern of weight 3 or less for each of the 2048 syndromes."""
    errors = [0]
    errors += [1 << i for i in range(23)]
    errors += [1 << i | 1 << j for i in range(23) for j in range(i)]
    errors += [1 << i | 1 << j | 1 << k for i in range(23) for j in range(i) for k in range(j)]
    errors = np.array(errors, dtype=np.int64)
    leader = np.zeros(2048, dtype=np.int64)
    leader[syndrome(errors)] = errors  # a perfect code: each syndrome once
    return leader


def nearest_codeword(x: np.ndarray, leader: np.ndarray) -> np.ndarray:
    """12-bit index of the codeword within distance 3 of each 23-bit word."""
    return (x ^ leader[syndrome(x)]) >> 11  # systematic: the upper 12 bits name the codeword


def golay_keys(x: np.ndarray, leader: np.ndarray) -> np.ndarray:
    """(n, 24) codeword indices of the words and of their 23 neighbours."""
    near = np.concatenate([x[:, None], x[:, None] ^ (1 << np.arange(23, dtype=np.int64))[None, :]], axis=1)
    return nearest_codeword(near.ravel(), leader).reshape(near.shape)


def _segments() -> list[tuple[int, int, list[int], list[int]]]:
    """For each block: its first bit, its width, and the bits of the two halves of the rest."""
    out, at = [], 0
    for width in BLOCKS:
        rest = [i for i in range(64) if not at <= i < at + width]
        half = len(rest) // 2
        out.append((at, width, rest[:half][:23], rest[half:][:23]))
        at += width
    return out


def fuzzy_keys(fp: np.ndarray, leader: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of all fuzzy keys of unsigned fingerprints, without repeats."""
    rows, keys = [], []
    for b, (at, width, *halves) in enumerate(_segments()):
        block = (fp >> np.uint64(at)).astype(np.int64) & ((1 << width) - 1)
        for k, bits in enumerate(halves):
            word = np.zeros(len(fp), dtype=np.int64)
            for j, i in enumerate(bits):
                word |= ((fp >> np.uint64(i)).astype(np.int64) & 1) << j
            code = np.sort(golay_keys(word, leader), axis=1)
            new = np.ones(code.shape, dtype=bool)
            new[:, 1:] = code[:, 1:] != code[:, :-1]
            r, c = np.nonzero(new)
            rows.append(r)
            keys.append(((b * 2 + k) << 25) | (block[r] << 12) | code[r, c])
    return np.concatenate(rows), np.concatenate(keys)


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _stars(fp: np.ndarray, max_distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) that connect exactly what distance <= max_distance connects."""
    if len(fp) == 2:
        ok = _popcount(fp[:1] ^ fp[1:]) <= max_distance
        return fp[1:][ok], fp[:1][ok]
    near = _popcount(fp[:, None] ^ fp[None, :]) <= max_distance
    label = np.arange(len(fp))
    while True:
        new = np.where(near, label[None, :], len(fp)).min(axis=1)
        new = new[new]
        if (new == label).all():
            break
        label = new
    own = label != np.arange(len(fp))
    return fp[own], fp[label[own]]


def fuzzy_links(distinct: DataFrame, max_distance: int = 4, tile: int = MAX_TILE) -> DataFrame:
    """``distinct`` (fp) -> links (a, b) of fingerprints within ``max_distance``
    (4 or less) that connect the same components as all such pairs."""
    if max_distance > 4:
        raise ValueError("the keys are complete up to distance 4")
    leader = golay_leaders()

    def key_rows(batches):
        for b in batches:
            fp = b["fp"].to_numpy(np.int64)
            row, key = fuzzy_keys(fp.view(np.uint64), leader)
            yield pd.DataFrame({"key": key.astype(np.int64), "fp": fp[row]})

    keyed = distinct.select("fp").mapInPandas(key_rows, "key long, fp long")
    keyed = materialize(keyed, "simhash-keys")
    # Map-side combined counts drop the keys of one fingerprint and find the hot ones.
    counts = keyed.groupBy("key").count().where("count > 1")
    n = F.ceil(F.col("count") / F.lit(tile)).cast("int")
    tiles = (keyed.join(counts, "key").withColumn("n", n)
             .withColumn("c", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))
             .withColumn("t", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
             .select(F.xxhash64("key", F.least("c", "t"), F.greatest("c", "t")).alias("g"), "key", "fp"))

    def links(batches):
        held = None
        for b in batches:
            b = b if held is None else pd.concat([held, b], ignore_index=True)
            g = b["g"].to_numpy(np.int64)
            starts = np.flatnonzero(g[1:] != g[:-1]) + 1
            last = int(starts[-1]) if len(starts) else 0  # the last group may go on in the next batch
            held = b.iloc[last:]
            yield solve(g[:last], b["fp"].to_numpy(np.int64)[:last])
        if held is not None:
            yield solve(held["g"].to_numpy(np.int64), held["fp"].to_numpy(np.int64))

    def solve(g: np.ndarray, fp: np.ndarray) -> pd.DataFrame:
        out_a, out_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        if len(g):
            at = np.flatnonzero(np.r_[True, g[1:] != g[:-1], True])
            size = np.diff(at)
            two = at[:-1][size == 2]
            ok = _popcount(fp[two].view(np.uint64) ^ fp[two + 1].view(np.uint64)) <= max_distance
            out_a.append(fp[two][ok])
            out_b.append(fp[two + 1][ok])
            for lo, s in zip(at[:-1][size > 2], size[size > 2]):
                a, b = _stars(fp[lo:lo + s].view(np.uint64), max_distance)
                out_a.append(a.view(np.int64))
                out_b.append(b.view(np.int64))
        return pd.DataFrame({"a": np.concatenate(out_a), "b": np.concatenate(out_b)})

    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (tiles.repartition(parts, "g").sortWithinPartitions("g", "fp").select("g", "fp")
            .mapInPandas(links, "a long, b long").where("a <> b").distinct())


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle: int = 4, max_distance: int = 4) -> DataFrame:
    """(id_col, fingerprint, component_id): one row per input row.

    ``component_id`` is the smallest id reachable over links of ``max_distance``
    bits or fewer.  Null, empty and wordless texts have fingerprint zero and are
    linked like any other; rows with a null id keep their row, and their
    component has the smallest non-null id (null if there is none).
    """
    fps = materialize(fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    distinct = materialize(fps.groupBy("fp").agg(F.min("id").alias("low")), "simhash-distinct")
    comp = connected_components(fuzzy_links(distinct, max_distance))
    rooted = distinct.join(comp, distinct["fp"] == comp["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component"))
    by_fp = materialize(rooted.join(lowest, "root").select("fp", "component"), "simhash-roots")
    return (fps.join(by_fp, "fp")
            .select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    F.col("component").alias("component_id")))


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  shingle: int = 4, max_distance: int = 4) -> DataFrame:
    """``docs`` with one document of each component: that with the smallest id
    (of several rows with that id all stay; rows with a null id stay).  The texts
    don't pass through a shuffle unless the ids to drop outgrow a broadcast."""
    gone_col = fresh(docs, "gone")
    groups = simhash_groups(docs, id_col, text_col, shingle, max_distance)
    gone = materialize(groups.where(F.col(id_col) != F.col("component_id"))
                       .select(F.col(id_col).alias(gone_col)).distinct(), "simhash-gone")
    return docs.join(gone, docs[id_col] == gone[gone_col], "left_anti")
