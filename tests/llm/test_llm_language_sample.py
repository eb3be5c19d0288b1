"""The bounded sample of the language identifier loses no language."""

import random

from pyspark.sql import functions as F

from partsflow.llm import langid

ENGLISH = "the quick brown fox jumps over the lazy dog while seven children watch from their house and laugh at it".split()
GERMAN = "der schnelle braune Fuchs springt über den faulen Hund während sieben Kinder aus ihrem Haus zusehen und lachen".split()


def text(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


def test_languages_of_long_texts_are_learned(spark):
    rng = random.Random(31)
    rows = [(i, text(rng, words, 1500), lang) for i, (words, lang) in enumerate([(ENGLISH, "en"), (GERMAN, "de")] * 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert df.where(F.length("text") <= langid.MAX_DOC_CHARS).count() == 0
    model = langid.learn(df, F.lit(True))
    assert model.langs == ["de", "en"]
    assert model.predict([text(rng, ENGLISH, 40), text(rng, GERMAN, 40)])[0] == ["en", "de"]


def test_rare_places_of_letters_and_null_ids_are_learned(spark):
    rng = random.Random(32)
    rows = [(i, "12 34 " * 10, "xx") for i in range(200)] + [(900, "7 " * 9000 + "Ω" + " 7" * 9000, "xx")]
    rows += [(None, text(rng, GERMAN, 30), "de"), (1000, text(rng, ENGLISH, 30), "en"), (1001, "", "no"), (1002, "12", "no"), (1003, "a b", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.learn(df, F.lit(True))
    assert model.langs == ["de", "en", "xx"]
    assert model.predict(["Ω", "Kinder springt"])[0] == ["xx", "de"]


def test_every_letter_of_the_samples_has_a_symbol():
    rng = random.Random(33)
    han = [chr(c) for c in range(0x4E00, 0x4E00 + 3000)]
    samples = {lang: ["".join(rng.choice(part) for _ in range(6000))] for lang, part in (("one", han[:1500]), ("two", han[1500:]))}
    model = langid.Model(samples)
    assert len(model.codes.alphabet) > 2 * langid.DENSE
    texts = [samples["one"][0][700:760], samples["two"][0][100:160], "".join(rng.choice(han[:1500]) for _ in range(60))]
    assert model.predict(texts)[0] == ["one", "two", "one"]
    # Parsed by the definition: the longest phrases that the sample holds.
    parts = [model.codes.encode([t])[0].tolist() for t in (*texts, "한국어 조선말 abc " + samples["one"][0][:9])]
    kept = [model.codes.encode([samples[lang][0]])[0].tolist() for lang in model.langs]
    for row, p in zip(model.phrases(*model.codes.encode([*texts, "한국어 조선말 abc " + samples["one"][0][:9]])), parts):
        for got, sample in zip(row, kept):
            known = "".join(map(chr, sample))
            n = at = 0
            while at < len(p):
                end = at + 1
                while end <= len(p) and "".join(map(chr, p[at:end])) in known:
                    end += 1
                at, n = max(at + 1, end - 1), n + 1
            assert got == n
    # Letters outside the samples end a phrase each.
    assert (model.phrases(*model.codes.encode(["한국어조선말"])) >= 6).all()
