"""The word tokenizer of a worker process."""

import public_tokenizers as P

from partsflow.llm import packing


def test_a_worker_keeps_its_tokenizer():
    path = P.path("word_bpe_49k.json")
    t = packing._tokenizer(path)
    ids = t.encode_batch(["some words, some more"])
    assert packing._tokenizer(path) is t
    assert packing._tokenizer(path).encode_batch(["some words, some more"])[0].tolist() == ids[0].tolist()
