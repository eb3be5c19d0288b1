"""Look-ups of the prefix dynamic programming."""

import public_tokenizers as P

from partsflow.llm import tokencounts


def test_prefix_counts_look_only_where_tokens_can_begin():
    class Seen(set):
        asked = 0

        def __contains__(self, x):
            Seen.asked += 1
            return super().__contains__(x)

    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        v = tokencounts.Vocabulary(f.read())
    word = b"qzxjvkqwx" * 40
    want = v.prefix_counts(word)
    v.tokens = Seen(v.tokens)
    assert v.prefix_counts(word) == want and want[-1] == len(v.merge(word))
    assert Seen.asked < 6 * len(word)
