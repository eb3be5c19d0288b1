"""Operators on single texts: round trips, libraries, held-out accuracy, brute force."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from partsflow.llm import bpe, langid, packing, pii, quality, queries, sharding
from partsflow.llm.common import materialize, read_table

SF = "/root/testdata/sf0.001"
EDGE = [None, "", " ", "\n\t", "x" * 5000, "don't WE'LL 12³4 \x1c\x1f", "　 é漢字 x\x85q", "a" * 700 + " b", "<|endoftext|> y\0z \0 w"]


def edge_table(spark):
    rows = [(i, t, "e", 1, 2.0, 3, 4) for i, t in enumerate(EDGE)] + [(None, "null id", "e", 1, 2.0, 3, 4), (0, EDGE[5], "e", 1, 2.0, 3, 4), (0, EDGE[5], "e", 1, 2.0, 3, 4)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, start int, score double, kinds int, h int").repartition(3)


def random_texts(seed, chars, n=60, size=150):
    rng = random.Random(seed)
    return ["".join(rng.choice(chars) for _ in range(size)) for _ in range(n)]


# ------------------------------------------------------------------------ BPE
def test_bpe_equals_the_library_and_decodes(spark):
    import tiktoken
    path = P.path("byte_bpe_50k.tiktoken")
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    texts = EDGE + random_texts(1, "ab \n\té漢😀'st9_! ")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("ids", F.lit("clash"))
    for words in (0, 30):
        for r in bpe.encode(df, path, P.PATTERN, decoded_col="decoded", dictionary_words=words).collect():
            t = texts[r["doc_id"]] or ""
            assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == lib.encode_ordinary(t)
            assert bytes(r["decoded"]) == t.encode()
    folded = bpe.dictionary(df, bpe.read_ranks(path), P.PATTERN, size=400).collect()
    assert len(folded) > 100 and all(list(r["ids"]) == lib.encode_ordinary(r["w"]) for r in folded)
    assert bpe.encode(df.limit(0), path, P.PATTERN).count() == 0


# -------------------------------------------------------------------- quality
def slow_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    at = {}
    for i in range(len(words) - 7):
        at.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_quality_statistics_equal_brute_force(spark):
    rng = random.Random(6)
    texts = EDGE + [" ".join(rng.choice("abc") for _ in range(n)) for n in (7, 8, 9, 30, 200)] + random_texts(7, "ab# \n\r\x0b\xa0é|")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("n_words", F.lit("clash"))
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for r in quality.statistics(df, ["doc_id"]).collect():
        assert tuple(r[c] for c in cols) == slow_base(texts[r["doc_id"]]), texts[r["doc_id"]]


def test_quality_rules_learn_thresholds(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(600):
        bad = i % 3 == 0
        words = [f"w{rng.randrange(900)}" + ("##" if bad and rng.random() < 0.5 else "") for _ in range(60)]
        rows.append((i, " ".join(words)))
        labels += [(i, 0 if bad else 1), (i, 0 if bad else 1)]
    labels += [(None, 0), (3, None)]
    stats = materialize(quality.statistics(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"]), "t")
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    rules = quality.learn(stats, table)
    assert rules and all(len(r.conditions) <= quality.MAX_CONDITIONS for r in rules)
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(stats, rules).collect()}
    assert sum(kept[i] == (i % 3 != 0) for i in range(600)) >= 595
    assert quality.learn(stats, table.limit(0)) == []
    assert quality.judge(stats, []).where("kept <> (not base_failed)").count() == 0


# ------------------------------------------------------------------- sharding
@pytest.mark.parametrize("limit", [3000, 40_000])
def test_shards_equal_sql_and_fit(spark, limit):
    docs = read_table(spark, SF, "documents").select("doc_id", "text").where(F.octet_length("text") <= limit)
    got = {(r[0], r[1], r[2]) for r in sharding.shard(docs, limit).select("doc_id", "shard_id", "n_bytes").collect()}
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet') WHERE strlen(text) <= {limit}")
    assert got == set(con.sql(queries.OP6_SQL.replace(str(queries.SHARD_BYTES), str(limit))).fetchall())


def test_shards_split_one_hot_key(spark):
    rows = [(None if i % 2 else 7, "x" * (i % 90)) for i in range(200)] + [(3, "y" * 5000), (3, "y"), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard_id", F.lit(9))
    got = sharding.shard(df, 1000).collect()
    total = {}
    for r in got:
        total.setdefault(r["shard_id"], []).append(r["n_bytes"])
    assert len(got) == len(rows)
    assert all(sum(v) <= 1000 or len(v) == 1 for v in total.values())
    assert sharding.shard(df.limit(0), 1000).count() == 0


# ------------------------------------------------------------------------ PII
def test_pii_keeps_format_and_coreference(spark):
    text = ("Mr. John Smith met Frau Anna Müller. Call 743-555-3824 or +1 (743) 555-3824, DE89 3704 0044 0532 0130 00, "
            "123-45-6789, Г-н Иван Петров; JOHN@x.org john@X.org 4111-1111-1111-1111 10.1.2.3 token = \"00ffab1234567890\"")
    new, kinds = pii.replace(text, b"k", {})
    assert kinds == ["name", "name", "phone", "phone", "iban", "ssn", "name", "email", "email", "card", "ip", "token"]
    assert re.sub(r"\d", "0", new[new.index("Call"):new.index(", DE")]) == "Call 000-000-0000 or +0 (000) 000-0000"
    one, two = re.findall(r"(\d{3})\)? ?-?(\d{3})-(\d{4})", new)[:2]
    assert one == two and "+1 (" in new and new.split("@")[1][8:20] in {".example.com", ".example.net", ".example.org"}
    card = re.search(r"4\d{3}(?:-\d{4}){3}", new)[0].replace("-", "")
    assert pii._luhn(card[:-1]) == int(card[-1])
    first, other = new[4:].split(" ")[0], new.split("Frau ")[1].split(" ")[0]
    assert first in pii.FIRST["latin", "m"] and other in pii.FIRST["latin", "f"]
    assert new.split("Г-н ")[1].split(" ")[0] in pii.FIRST["cyrillic", "m"]
    clean = "In 2024-01-02 version 3.14.15 of 1,234,567 items (page 12) cost 99.50; v1.2.3.4.5 at 10:30."
    assert pii.replace(clean, b"k", {}) == (clean, [])


def test_pii_surrogates_stay_distinct(spark, monkeypatch):
    real = pii.surrogate
    # A tiny surrogate space, some of it real addresses, forces collisions.
    monkeypatch.setattr(pii, "surrogate", lambda key, kind, c, a: f"10.0.0.{pii._Stream(key, kind, c, a).below(60)}" if kind == "ip" else real(key, kind, c, a))
    rows = [(i, f"host 10.0.0.{i} and 10.0.0.{(i * 7) % 20}") for i in range(20)] + [(50, None), (51, ""), (None, "a@b.co"), (52, "a@b.co")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("k", F.lit(1)).withColumn("kind", F.lit("x"))
    out = pii.pseudonymize(df, "key", kinds_col="kinds")
    assert out.columns == ["doc_id", "text", "k", "kind", "kinds"]
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    seen = {}
    for i in range(20):
        for was, now in zip(re.findall(r"10[.\d]+", rows[i][1]), re.findall(r"10[.\d]+", got[i])):
            assert seen.setdefault(was, now) == now
    assert len(set(seen.values())) == len(seen) == 20 and not set(seen) & set(seen.values())
    assert got[50] is None and got[51] == "" and got[None] == got[52] != "a@b.co"
    assert pii.pseudonymize(df.limit(0), "key").count() == 0


# ---------------------------------------------------------------- language ID
def slow_phrases(sample, text):
    n = at = 0
    while at < len(text):
        end = at + 1
        while end <= len(text) and text[at:end] in sample:
            end += 1
        at = max(at + 1, end - 1)
        n += 1
    return n


def test_cross_parsing_equals_brute_force():
    rng = random.Random(9)
    model = langid.Model({"a": ["".join(rng.choice("abc ") for _ in range(300))], "b": ["".join(rng.choice("bcd ") for _ in range(300))]})
    plain = {lang: model.codes.encode([t])[0].tolist() for lang, t in (("a", ""), ("b", ""))}
    assert plain["a"] == plain["b"] == [0]
    rng = random.Random(9)
    samples = ["".join(rng.choice("abc ") for _ in range(300)), "".join(rng.choice("bcd ") for _ in range(300))]
    show = lambda t: "".join(map(chr, 65 + model.codes.encode([t])[0]))
    texts = ["abccba cab", "dddd bcd", "xyz abd", "", "a" * 1300]
    got = model.phrases(*model.codes.encode(texts))
    for t, row in zip(texts, got):
        s = show(t)
        blocks = [s[i:i + langid.BLOCK] for i in range(0, len(s), langid.BLOCK)]
        assert row.tolist() == [sum(slow_phrases(show(x), b) for b in blocks) for x in samples]


def test_language_held_out_accuracy_and_edges(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    model = langid.learn(docs, ~langid.is_held_out())
    got = langid.identify(docs, model, keep=["doc_id", "lang"]).withColumn("held", langid.is_held_out()).collect()
    held = [r for r in got if r["held"] and r["lang"]]
    assert all(r["held"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    edge = langid.identify(edge_table(spark), model)
    assert edge.columns == ["doc_id", "text", "ids", "start", "kinds", "h", "lang_pred", "score"]
    for r in edge.collect():
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1
    none = langid.learn(docs.limit(0), ~langid.is_held_out())
    assert {r["lang_pred"] for r in langid.identify(edge_table(spark), none).collect()} == {"und"}


# -------------------------------------------------------------------- packing
def test_differencing_balances():
    rng = np.random.default_rng(10)
    for n, k in ((1, 1), (1, 4), (5, 8), (300, 30)):
        sizes = rng.integers(1, 500, n)
        w = packing.differencing(sizes, k)
        assert len(w) == n and w.min() >= 0 and w.max() < k
        if n > 8 * k:
            load = np.bincount(w, weights=sizes, minlength=k)
            assert load.max() - load.min() <= 20
    assert np.bincount(packing.windows(np.array([900] * 5), 1000), weights=[900] * 5).tolist() == [900] * 5


def test_packing_covers_every_id_once(spark):
    from tokenizers import Tokenizer
    path = P.path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    lib.encode_special_tokens = True
    extra = [(100 + i, t) for i, t in enumerate(random_texts(11, "aB \n\té漢'st9_<|> "))] + [(200, "word " * 9000)]
    df = edge_table(spark).select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    docs = [(r[0], r[1]) for r in df.collect()]
    got = packing.pack(df, path, group_pieces=16, with_ids=True).toPandas()
    for doc, text in docs:
        if doc in (0, None):
            continue
        want = lib.encode(text or "", add_special_tokens=False).ids + [1]
        mine = got[got["doc_id"] == doc].sort_values("start")
        ids = np.concatenate([np.frombuffer(bytes(x), "<u4") for x in mine["ids"]]).tolist()
        assert ids == want and (mine["doc_tokens"] == len(want)).all()
        assert all(zlib.crc32(bytes(x)) == c for x, c in zip(mine["ids"], mine["ids_crc32"]))
    order = got.sort_values(["sequence_id", "offset"])
    assert (order.groupby("sequence_id")["length"].cumsum() - order["length"] == order["offset"]).all()
    assert order.groupby("sequence_id")["length"].sum().max() <= 2048
    total = sum(len(lib.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in docs)
    assert got["length"].sum() == total
    assert packing.pack(df.limit(0), path).count() == 0


# ------------------------------------------------------------------- pipeline
def test_pipeline_stages(spark):
    docs = read_table(spark, SF, "documents")
    extra = spark.createDataFrame([(900_001, None, "en", "s", 0), (900_002, "12345 !!", "en", "s", 8), (900_003, "Mail me: jo.doe@corp.org today please, dear reader of this line", "en", "s", 60)], docs.schema)
    docs = materialize(docs.union(extra), "p0")
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["language_stage", "line_stage", "near_stage", "pii_stage", "packing_stage"]
    sizes = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = materialize(stage(spark, docs, SF), "p1")
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
        sizes.append(out.count())
        assert out.select("doc_id").exceptAll(docs.select("doc_id")).count() == 0
        docs = out
    ids = {r[0] for r in docs.select("doc_id").collect()}
    assert not ids & {900_001, 900_002} and 900_003 in ids
    assert docs.where("text like '%jo.doe@corp.org%'").count() == 0 and docs.where("n_chars <> length(text)").count() == 0
    packed = corpus_pipeline.packing_stage(spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == sizes[-1]


def test_digests_of_contracts(spark):
    r = queries.op4_bpe(spark, SF).first()
    assert len(r["ids_sha256"]) == 64 and r["n_tokens"] >= 0
    r = queries.op1_suffix(spark, SF).where("n_removed = 0").first()
    text = read_table(spark, SF, "documents").where(F.col("doc_id") == r["doc_id"]).first()["text"]
    assert r["kept_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_word_tokenizer_equals_the_library_on_odd_words():
    import random

    import public_tokenizers
    from tokenizers import Tokenizer

    from partsflow.llm.packing import WordTokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    letters = "abZÀÖßµªºÿéñü'!_-<|>.,%0 9́İΣς×÷­ \x00\x0b\n漢`~^"
    rng = random.Random(3)
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 30))) for _ in range(3000)]
    texts += ["", "<|endoftext|>", "a<|endoftext|>", "it's we'll'S", "É!!!", "x" * 5000]
    ours = WordTokenizer(path)
    assert ours._model is not None
    for at in range(0, len(texts), 500):
        part = texts[at:at + 500]
        assert [list(i) for i in ours.encode_batch(part)] == [e.ids for e in library.encode_batch(part, add_special_tokens=False)]
