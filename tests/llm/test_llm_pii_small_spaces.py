"""Surrogates where a format has few of them, and texts that hold no secret after all."""

import re

import pytest

from partsflow.llm import pii


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


def replaced(spark, texts, kinds=None):
    return {r["doc_id"]: r["text"] for r in pii.pseudonymize(frame(spark, texts), "key", kinds_col=kinds).collect()}


@pytest.mark.parametrize("form", ["Password: ________", "password: ........", "token = --------", "secret: _./-+_./-+", "pwd=________="])
def test_a_secret_needs_a_letter_or_digit(spark, form):
    assert pii.find(form) == []
    assert pii.find(form + "x")[0][2] == "token" if not form.endswith("=") else True
    assert replaced(spark, [form, "plain"]) == {0: form, 1: "plain"}


def test_more_entities_than_surrogates_of_their_length(spark):
    """100 secrets of one letter (26 forms of their length), in several texts each."""
    letters = [chr(97 + i) for i in range(26)] + [chr(65 + i) for i in range(26)] + [str(i) for i in range(10)]
    secrets = [f"....{c}..." for c in letters] + [f"...{c}...." for c in letters[:38]]
    texts = [f"token = {s} and {s}" for s in secrets] + [f"again token: {s}" for s in secrets] + ["mail a@b.co", "mail b@b.co"]
    got = replaced(spark, texts)
    new = {}
    for i, s in enumerate(secrets):
        first = re.match(r"token = (\S+) and", got[i])[1]
        assert got[len(secrets) + i] == f"again token: {first}"  # coreferent
        new[s] = first
    assert len(set(new.values())) == len(secrets)  # distinct
    assert not set(new.values()) & set(secrets)  # and no entity of the corpus
    assert all(re.fullmatch(r"\.{3,4}[A-Za-z0-9][.a-z]*", v) for v in new.values())
    assert got[2 * len(secrets)] != got[2 * len(secrets) + 1]


@pytest.mark.parametrize("kind,canon,raw", [("ssn", "123456789", "123-45-6789"), ("phone", "5551234567", "+1 555-123-4567"), ("ip", "10.0.0.1", "10.0.0.1"),
                                            ("card", "4111111111111111", "4111 1111 1111 1111"), ("iban", "GB82WEST12345698765432", "GB82 WEST 1234 5698 7654 32"),
                                            ("email", "a@b.co", "A@B.CO"), ("name", "m anna maria", "Anna MARIA"), ("token", "deadbeef", "deadbeef")])
def test_later_attempts_grow_and_are_shown_whole(kind, canon, raw):
    """Each attempt beyond the format gives a longer surrogate, and no character of it is lost in the text."""
    seen = set()
    for attempt in range(pii.ROOMY + 5):
        new = pii.surrogate(b"k", kind, canon, attempt)
        shown = pii.render(kind, raw, new)
        bare = lambda s: re.sub(r"[^\w]", "", s).lower()
        assert bare(shown).endswith(bare(new[2:] if kind == "name" else new))
        seen.add(shown)
        assert (len(new) > len(pii.surrogate(b"k", kind, canon, 0))) or attempt <= pii.ROOMY or kind in ("name", "ip")
    assert len(seen) >= pii.ROOMY


def test_very_long_text(spark):
    body = "plain words here, " * 550_000
    text = body + "write to me@home.org or token = ________ or " + body[:100]
    assert len(text) > 9_900_000
    got = replaced(spark, [text, "me@home.org"], kinds="kinds")
    mail = got[1]
    assert mail != "me@home.org" and got[0] == text.replace("me@home.org", mail)
