"""The registered queries of this package and their DuckDB statements.

Each query is thin: it applies an operator with production parameters to its
whole table and derives the digest columns of its contract.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from partsflow.llm.common import materialize, read_table

#: Of the registered queries only; a real run passes its own secret key.
PII_KEY = "registered-query"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from partsflow.llm.suffixdedup import substring_dedup

    kept = substring_dedup(read_table(spark, sf_dir, "documents"), length=50)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from partsflow.llm.nearest import nearest

    return nearest(read_table(spark, sf_dir, "embeddings"), lambda i: F.pmod(i, F.lit(20)) == 0, k=20)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from partsflow.llm.simhash import simhash_groups

    return simhash_groups(read_table(spark, sf_dir, "documents"), shingle=4, max_distance=4)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from partsflow.llm.bpe import encode

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = encode(docs, tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, ids_col="ids", decoded_col="decoded")
    return out.select("doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from partsflow.llm.quality import judge, learn, statistics

    stats = materialize(statistics(read_table(spark, sf_dir, "documents"), ["doc_id"]), "quality-stats")
    rules = learn(stats, read_table(spark, sf_dir, "labels"))
    return judge(stats, rules).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


#: Byte limit of a shard in op6.
SHARD_BYTES = 4_000_000


def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from partsflow.llm.sharding import shard

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return shard(docs, SHARD_BYTES).select("doc_id", "shard_id", "n_bytes")


OP6_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM documents),
levels AS (SELECT unnest(range(0, 33)) AS depth),
entries AS (
  SELECT depth, h >> (32 - depth) AS prefix, sum(n_bytes) AS total
  FROM d, levels GROUP BY 1, 2),
leaf AS (
  SELECT d.doc_id, d.n_bytes, d.h, min(e.depth) AS depth
  FROM d JOIN entries e ON e.prefix = d.h >> (32 - e.depth) AND e.total <= {SHARD_BYTES}
  GROUP BY 1, 2, 3)
SELECT doc_id, substr(lpad(bin(h), 32, '0'), 1, CAST(depth AS INTEGER)) AS shard_id, CAST(n_bytes AS BIGINT) AS n_bytes FROM leaf
"""


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from partsflow.llm.linededup import line_dedup

    kept = line_dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"), n_lines="n_lines", n_removed="n_removed")
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from partsflow.llm.pii import pseudonymize

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return (pseudonymize(docs, key=PII_KEY, kinds_col="kinds")
            .select("doc_id", "text", F.size("kinds").cast("long").alias("n_replaced"), "kinds"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from partsflow.llm.langid import identify, is_held_out, learn

    docs = read_table(spark, sf_dir, "documents")
    model = learn(docs, ~is_held_out("doc_id"))
    return (identify(docs.select("doc_id", "text"), model, keep=["doc_id"])
            .withColumn("held_out", is_held_out("doc_id")).select("doc_id", "held_out", "lang_pred", "score"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from partsflow.llm.packing import pack

    return pack(read_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=1, capacity=2048)


#: Token limit of op11.
TOKEN_LIMIT = 1024


def op11_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    from partsflow.llm.tokencounts import count_at, prefix_counts

    docs = read_table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n = count_at(F.col("counts"), F.length("text")).cast("long")
    return (prefix_counts(docs, tokenizer_path("byte_bpe_50k.json"))
            .select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), n.alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from partsflow.llm.runs import periodic_runs

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs(docs.withColumn("text", _made_periodic()), min_length=12)
    top = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.withColumn("top", top).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.start")).alias("start"), F.col("top.length"),
        (-F.col("top.period")).alias("period"),
        F.floor(1000 * F.col("top.length") / -F.col("top.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def _made_periodic() -> Column:
    """The text of op12: with h = crc32(doc_id), of each text with h % 10 = 0 the
    words from a on repeat the p words at a.  Other texts, and those without an id, stay."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split("text", r"[ \t-\r]+"), lambda w: w != "")

    def rebuilt(w: Column) -> Column:
        n = F.size(w)
        a = (g % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (3 + g % 8))).cast("int")
        return F.concat_ws(" ", F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p))))

    # Bound once, so that the words are not split again for each place.
    whole = F.get(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, rebuilt(w)).otherwise("")), F.lit(0))
    return F.when((h % 10 == 0) & F.col("text").isNotNull(), whole).otherwise(F.col("text"))


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from partsflow.llm.convtrie import prefix_trie, sequences

    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return prefix_trie(_rebuilt(sequences(turns), sequences(turns.where(F.col("conv_id") % 100 == 0))))


def _rebuilt(seqs: DataFrame, bases: DataFrame) -> DataFrame:
    """The conversations of op13: c begins with the first crc32(c) % 6 turns of c - c % 100."""
    heads = bases.select(F.col("conv_id").alias("__base"), F.slice("steps", 1, 5).alias("__head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int")
    joined = seqs.join(heads, F.col("conv_id") - F.col("conv_id") % 100 == F.col("__base"), "left")
    begin = F.slice(F.coalesce("__head", F.slice("steps", 1, 0)), F.lit(1), h)
    return joined.select("conv_id", F.concat(begin, F.slice("steps", h + 1, F.greatest(F.size("steps") - h, F.lit(0)))).alias("steps"))


#: The check value is spelled out bit by bit: a number of 0 or more is a byte to add, -1 a step of one bit.
OP13_SQL = """
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT c, max(pos) AS n, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
           flatten(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: [CAST(ord(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
         lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) % 6 AS h
  FROM t GROUP BY c),
heads AS (
  SELECT ids.c, ids.h, least(ids.h, coalesce(b.n, 0)) AS k FROM ids LEFT JOIN ids b ON b.c = ids.c - ids.c % 100),
turns AS (
  SELECT heads.c, t.pos AS d, t.role, t.text FROM heads JOIN t ON t.c = heads.c - heads.c % 100 AND t.pos <= heads.k
  UNION ALL
  SELECT heads.c, heads.k + t.pos - heads.h, t.role, t.text FROM heads JOIN t ON t.c = heads.c AND t.pos > heads.h),
visits AS (
  SELECT c, d, length(text) AS size, list(md5(length(role) || ':' || role || text)) OVER (PARTITION BY c ORDER BY d) AS path FROM turns
  UNION ALL
  SELECT c, 0, 0, CAST([] AS VARCHAR[]) FROM ids),
last AS (SELECT c, max(d) AS d FROM visits GROUP BY c),
nodes AS (
  SELECT path, any_value(v.d) AS d, min(v.c) AS conv_id, count(*) AS n, any_value(size) AS size,
         string_agg(CAST(v.c AS VARCHAR), ',' ORDER BY v.c) FILTER (WHERE last.d = v.d) AS ends
  FROM visits v JOIN last USING (c) GROUP BY path),
kids AS (SELECT path[1:d - 1] AS path, count(*) AS kids FROM nodes WHERE d > 0 GROUP BY 1),
full_nodes AS (SELECT nodes.*, coalesce(kids, 0) AS kids FROM nodes LEFT JOIN kids USING (path)),
subtrees AS (
  SELECT path[1:a] AS path, sum(CASE WHEN kids = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n - 1) * size) AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM full_nodes) GROUP BY 1)
SELECT x.conv_id, CAST(x.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, CAST(x.n AS BIGINT) AS n_convs, CAST(x.kids AS BIGINT) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(x.ends, '')) AS ends_sha256
FROM full_nodes x JOIN subtrees USING (path) LEFT JOIN nodes up ON x.d > 0 AND up.path = x.path[1:x.d - 1]
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix": op1_suffix,
    "op2_nearest": op2_nearest,
    "op3_simhash": op3_simhash,
    "op4_bpe": op4_bpe,
    "op5_quality": op5_quality,
    "op6_shards": op6_shards,
    "op7_lines": op7_lines,
    "op8_pii": op8_pii,
    "op9_language": op9_language,
    "op10_packing": op10_packing,
    "op11_tokens": op11_tokens,
    "op12_runs": op12_runs,
    "op13_trie": op13_trie,
}

ORACLES: dict[str, str] = {"op6_shards": OP6_SQL, "op13_trie": OP13_SQL}
