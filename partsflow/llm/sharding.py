"""Sharding by extendible hashing.

A row's hash is the first 32 bits of md5(key).  A directory entry is a prefix of
those bits; it begins at depth 0, and only an entry whose rows exceed the byte
limit splits on its next bit.  The splits are found on a histogram of bytes by
hash (map-side combined), so the texts are read once and never moved to find
them.  At ``max_depth`` bits an entry may still be oversized (one huge row, or
one key repeated): its rows are then numbered and dealt to overflow shards of
that entry, as many as fit whatever their sizes; a row of over half the limit
has a shard alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from partsflow.llm.common import add_dense_index, fresh, materialize

MAX_DEPTH = 32


def hash32(key: Column) -> Column:
    """First 32 bits of md5(key as text); a null key hashes as the empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 8), 16, 10).cast("long")


def directory(sizes: DataFrame, limit: int, max_depth: int = MAX_DEPTH) -> DataFrame:
    """``sizes`` (h, bytes: totals by hash) -> (depth, prefix, bytes) of the leaves."""
    leaves = None
    live, depth = sizes.select("h", "bytes"), 0
    while True:
        prefix = F.shiftright("h", 32 - depth)
        total = materialize(live.groupBy(prefix.alias("prefix")).agg(F.sum("bytes").alias("bytes")), "shard-level")
        full = total.where(F.col("bytes") > limit) if depth < max_depth else total.limit(0)
        done = (total.where(F.col("bytes") <= limit) if depth < max_depth else total).select(F.lit(depth).alias("depth"), "prefix", "bytes")
        leaves = done if leaves is None else leaves.union(done)
        if depth >= max_depth or full.isEmpty():
            return leaves
        live = live.join(full.select(F.col("prefix").alias("p")), prefix == F.col("p"), "left_semi")
        depth += 1


def shard(docs: DataFrame, limit: int, key_col: str = "doc_id", text_col: str = "text",
          shard_col: str = "shard_id", bytes_col: str = "n_bytes", max_depth: int = MAX_DEPTH) -> DataFrame:
    """``docs`` with ``shard_col`` (the bits of the entry; ``bits.n`` for an
    overflow shard) and ``bytes_col`` (UTF-8 bytes of the text; null: 0).

    Every shard holds ``limit`` bytes at most, but for a shard of one larger row.
    Rows with a null key share the hash of the empty text; repeated rows stay
    apart; an empty table gives an empty one.  Columns of those two names are
    replaced, others are kept.
    """
    h, b, depth, prefix = fresh(docs, "h"), fresh(docs, "b"), fresh(docs, "depth"), fresh(docs, "prefix")
    over, entry, row, top = fresh(docs, "over"), fresh(docs, "entry"), fresh(docs, "row"), fresh(docs, "top")
    keep = [c for c in docs.columns if c not in (shard_col, bytes_col)]
    src = docs.select("*", hash32(F.col(key_col)).alias(h), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias(b))
    sizes = materialize(src.groupBy(F.col(h).alias("h")).agg(
        F.sum(b).alias("bytes"), F.max(F.when(F.col(b) * 2 <= limit, F.col(b))).alias("most")), "shard-sizes")
    leaves = materialize(directory(sizes, limit, max_depth), "shard-directory")
    depths = sorted(r["depth"] for r in leaves.select("depth").distinct().collect())
    # The hash tells the leaf: one equality join on the smallest depth whose prefix is a leaf.
    of_hash = None
    for d in depths:
        hit = sizes.withColumn("prefix", F.shiftright("h", 32 - d)).join(
            leaves.where(F.col("depth") == d), "prefix").select("h", "depth", "prefix", "most", leaves["bytes"].alias("total"))
        of_hash = hit if of_hash is None else of_hash.union(hit)
    if of_hash is None:
        return docs.select(*keep, F.lit("").alias(shard_col), F.lit(0).cast("long").alias(bytes_col))
    of_hash = materialize(of_hash, "shard-of-hash")
    of_hash = of_hash.select(F.col("h").alias(h), F.col("depth").alias(depth), F.col("prefix").alias(prefix),
                             "most", (F.col("total") > limit).alias(over))
    named = src.join(of_hash.drop("most"), h).withColumn(entry, F.substring(F.lpad(F.bin(F.col(h)), 32, "0"), F.lit(1), F.col(depth)))
    fits = named.where(~F.col(over)).select(*keep, F.col(entry).alias(shard_col), F.col(b).alias(bytes_col))
    if not of_hash.where(F.col(over)).limit(1).count():
        return fits
    # Overflow: runs of the limit's half cannot exceed it with rows of at most half; larger rows stand alone.
    # The largest row that shares a shard, by entry, comes from the histogram: no text moves for it.
    hot = of_hash.where(F.col(over))
    hot = materialize(hot.join(hot.groupBy(depth, prefix).agg(F.max("most").alias(top)), [depth, prefix]).select(h, top), "shard-hot")
    rows = named.where(F.col(over)).join(hot, h).withColumn(row, F.xxhash64(*[F.col(c).cast("string") for c in keep]))
    small = add_dense_index(rows.where(F.col(b) * 2 <= limit), [F.col(entry), F.col(row)], row + "i")
    per = F.lit(max(1, limit)) / F.greatest(F.col(top), F.lit(1))
    small = small.withColumn(over + "n", F.floor(F.col(row + "i") / F.greatest(F.floor(per), F.lit(1))).cast("string"))
    big = add_dense_index(rows.where(F.col(b) * 2 > limit), [F.col(entry), F.col(row)], row + "i")
    big = big.withColumn(over + "n", F.concat(F.lit("r"), F.col(row + "i").cast("string")))
    cols = [*keep, F.concat_ws(".", F.col(entry), F.col(over + "n")).alias(shard_col), F.col(b).alias(bytes_col)]
    return fits.union(small.select(*cols)).union(big.select(*cols))
