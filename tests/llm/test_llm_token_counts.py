"""Prefix token counts against the library, at every prefix."""

import random

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from partsflow.llm import queries, tokencounts
from partsflow.llm.common import read_table

PATH = P.path("byte_bpe_50k.json")
EDGE = [None, "", " ", "\n\t", "x" * 700, "z" * 300 + " \n\n b", "don't WE'LL they'll you're I've 'r 'l 12³4 \x1c\x1f", "　 é漢字 x\x85q",
        "a" * 200 + " b", "one<|endoftext|>  two <|endoftext", "  <|endoftext|><|endoftext|>\n\n<|x", "<|endoftext|>", "y\0z \0 w",
        "Ֆ՘ ࢏1 \U00010940x", "tabs\t\tand   spaces  \n \n end   "]


def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


def counts(lib, texts):
    return [len(e.ids) for e in lib.encode_batch(texts, add_special_tokens=False)]


def texts_of(seed, chars, n=25, size=90):
    rng = random.Random(seed)
    return ["".join(rng.choice(chars) for _ in range(rng.randrange(size))) for _ in range(n)]


@pytest.mark.parametrize("remembered", [tokencounts.REMEMBERED, 10])
def test_every_prefix_equals_the_library(spark, remembered, monkeypatch):
    monkeypatch.setattr(tokencounts, "REMEMBERED", remembered)
    lib = library()
    texts = EDGE + texts_of(1, "ab \n\té漢😀'srelv9_! ") + texts_of(2, "  \n'lle") + texts_of(3, ["<|endoftext|>", " ", "\n", "<|", "a", "the "])
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)] + [(None, "null id", "c", 1), (3, EDGE[6], "c", 1), (3, EDGE[6], "c", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, counts string, cuts int").repartition(3)
    out = tokencounts.prefix_counts(df, PATH, cuts_col="cuts")
    assert out.columns == ["doc_id", "text", "counts", "cuts"]
    got = out.select("text", "counts", "cuts").collect()
    assert len(got) == len(rows)
    for r in got:
        t = r["text"] or ""
        want = counts(lib, [t[:i] for i in range(len(t) + 1)])
        assert np.frombuffer(bytes(r["counts"]), ">i4").tolist() == want, repr(t)
        cuts = [max(i for i, n in enumerate(want) if n <= b) for b in range(want[-1] + 1)]
        assert np.frombuffer(bytes(r["cuts"]), ">i4").tolist() == cuts, repr(t)
    assert tokencounts.prefix_counts(df.limit(0), PATH).count() == 0


def test_questions_are_answered_from_the_tables(spark):
    texts = ["the quick brown fox can't jump", "", "a  b\n\nc"]
    df = tokencounts.prefix_counts(spark.createDataFrame([(t,) for t in texts], "text string"), PATH, cuts_col="cuts")
    lib = library()
    for n in (0, 3, 9, 10_000):
        for r in df.select("text", tokencounts.count_at(F.col("counts"), F.lit(n)).alias("n"),
                           tokencounts.longest_within(F.col("cuts"), F.lit(n)).alias("c")).collect():
            want = counts(lib, [r["text"][:i] for i in range(len(r["text"]) + 1)])
            assert r["n"] == want[min(n, len(r["text"]))]
            assert r["c"] == max(i for i, x in enumerate(want) if x <= n)


def test_long_text_is_counted_whole(spark):
    text = "word " * 60_000 + "=" * 50_000 + "ab" * 20_000
    [r] = tokencounts.prefix_counts(spark.createDataFrame([(text,)], "text string"), PATH).select(
        tokencounts.count_at(F.col("counts"), F.length("text")).alias("n")).collect()
    assert r["n"] == counts(library(), [text])[0]


def test_other_vocabularies_raise(spark):
    with pytest.raises(ValueError):
        tokencounts.prefix_counts(spark.createDataFrame([("x",)], "text string"), P.path("word_bpe_49k.json"))


def test_query_equals_the_library(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in read_table(spark, sf, "documents").collect()}
    got = queries.QUERIES["op11_tokens"](spark, sf).collect()
    assert len(got) == len(texts)
    want = dict(zip(texts, counts(library(), list(texts.values()))))
    for r in got:
        n = want[r["doc_id"]]
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(texts[r["doc_id"]].encode()), n, n > 1024)
