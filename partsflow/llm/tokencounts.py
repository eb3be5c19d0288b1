"""Token counts of every prefix, by dynamic programming.

The byte-level BPE encoding of a string is the only sequence of tokens whose
neighbours all go together (the two, joined, encode to just those two).  So one
left-to-right pass knows the last token, and with it the token count, of every
prefix of a piece: of the tokens that end there, the one that goes together with
the last token of the prefix before it.  No prefix is encoded a second time.

A text is cut into pieces as the library does.  The table of a distinct piece is
computed once and remembered in bounded memory; the table of a text is put
together from those of its pieces by array operations, with the few places mended
where a prefix is cut into other pieces than the text (inside a run of white
space, a contraction or a special token's string).

``prefix_counts`` stores for each text the exact count at every prefix, as
big-endian 32-bit integers, and, if asked, for each budget the longest prefix
within it.  ``count_at`` and ``longest_within`` answer from these columns by
built-in expressions.
"""

from __future__ import annotations

import json
import sys
import types
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from partsflow.llm.bpe import word_finder
from partsflow.llm.common import fresh

#: The fixed split of byte-level vocabularies of this kind (use_regex).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_CONTRACTIONS = ("'re", "'ve", "'ll")
REMEMBERED = 3_000_000  # table entries that a task keeps between groups of texts
GROUP_CHARS = 2_000_000  # characters of the texts handled at once (a longer text alone)
PAIRS = 1_000_000  # remembered pairs of tokens


class Vocabulary:
    """Tokens and merges of a ``tokenizers`` file with a byte-level BPE model."""

    def __init__(self, spec: str):
        d = json.loads(spec)
        pre, model = d.get("pre_tokenizer") or {}, d["model"]
        plain = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                 and not d.get("normalizer") and model.get("type") == "BPE"
                 and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback"))
                 and not any(t.get(k) for t in d.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip")))
        if not plain:
            raise ValueError("only byte-level BPE vocabularies without a normalizer are supported")
        self.specials = [t["content"] for t in d.get("added_tokens", [])]
        # The byte alphabet: printable Latin-1 stands for itself, the other bytes for U+0100 onward.
        same = {*range(33, 127), *range(161, 173), *range(174, 256)}
        others = iter(range(256, 512))
        to_byte = {chr(i if i in same else next(others)): i for i in range(256)}
        raw = lambda s: bytes(map(to_byte.__getitem__, s))
        special = set(self.specials)
        self.tokens = {raw(s) for s in model["vocab"] if s not in special}
        self.prefixes = {t[:i] for t in self.tokens for i in range(1, len(t) + 1)}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = {(raw(a), raw(b)): rank for rank, (a, b) in enumerate(merges)}
        self._pairs: dict[tuple[bytes, bytes], bool] = {}

    def merge(self, word: bytes) -> list[bytes]:
        """BPE of a short string: the pair of lowest rank first, the first of equals."""
        parts, rank = [word[i:i + 1] for i in range(len(word))], self.merges.get
        none = len(self.merges)
        while len(parts) > 1:
            ranks = [rank(p, none) for p in zip(parts, parts[1:])]
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def together(self, a: bytes, b: bytes) -> bool:
        """Whether ``a`` (may be empty) and ``b`` stay as they are side by side."""
        got = self._pairs.get((a, b))
        if got is None:
            if len(self._pairs) >= PAIRS:
                self._pairs.clear()
            got = self._pairs[a, b] = self.merge(a + b) == ([a, b] if a else [b])
        return got

    def prefix_counts(self, word: bytes) -> list[int]:
        """Token counts of the prefixes of 0 to len(word) bytes."""
        counts, last = [0], [b""]
        tokens, prefixes, pairs, together = self.tokens, self.prefixes, self._pairs, self.together
        low = 0  # no token that ends here or later begins before
        for end in range(1, len(word) + 1):
            while low < end and word[low:end] not in prefixes:
                low += 1
            for start in range(low, end):
                t = word[start:end]
                if t in tokens:
                    a = last[start]
                    ok = pairs.get((a, t))
                    if ok or (ok is None and together(a, t)):
                        counts.append(counts[start] + 1)
                        last.append(t)
                        break
            else:
                raise ValueError(f"the vocabulary lacks a token for byte {word[end - 1]}")
        return counts


class Splitter:
    """The library's pieces of a text, matched by regular expressions; a text with a
    character that the library classes otherwise is cut by the library itself."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_str(spec).pre_tokenizer.pre_tokenize_str
        self._find = word_finder(PATTERN)
        self._known: set[str] = set()
        self._other: set[str] = set()
        self._learn({chr(i) for i in range(256)})
        self._narrow = not self._other

    def _by_library(self, text: str) -> list[str]:
        return [text[a:b] for _, (a, b) in self._library(text)]

    def _learn(self, chars: set[str]) -> None:
        for c in chars:
            probe = f"a{c}1{c}!{c} b"
            if self._by_library(probe) != self._find(probe):
                self._other.add(c)
        self._known |= chars

    def __call__(self, text: str) -> list[str]:
        if not (self._narrow and text.isascii()):
            chars = set(text)
            if not chars <= self._known:
                self._learn(chars - self._known)
            if self._other and not self._other.isdisjoint(chars):
                return self._by_library(text)
        return self._find(text)


class Pieces(dict):
    """piece -> number; the numbered tables (count at each prefix of characters) lie
    one after the other in ``flat``.  A special token is the key (string,)."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.flat, self.at, self.length, self.total = array("i"), array("q"), array("q"), array("i")
        self.blank, self.opens_blank = bytearray(), bytearray()

    def __missing__(self, piece) -> int:
        if isinstance(piece, tuple):
            counts, text = [0] * (len(piece[0]) - 1) + [1], "x"
        else:
            text, word = piece, piece.encode("utf-8", "surrogatepass")
            counts = self.v.prefix_counts(word)
            if len(word) != len(text):  # prefixes end between characters
                counts = [n for i, n in enumerate(counts) if i == len(word) or word[i] & 0xC0 != 0x80]
            counts = counts[1:]
            if piece in LONG_CONTRACTIONS:  # cut short, the mark and the letter are pieces of their own
                counts[1] = self.v.prefix_counts(word[:1])[-1] + self.v.prefix_counts(word[1:2])[-1]
        self.at.append(len(self.flat))
        self.length.append(len(counts))
        self.total.append(counts[-1])
        self.flat.extend(counts)
        opens = self._is_blank(text[0])
        self.opens_blank.append(opens)
        self.blank.append(opens and self._is_blank(text))
        n = len(self)
        self[piece] = n
        return n

    @staticmethod
    def _is_blank(s: str) -> bool:
        # isspace() also holds for U+001C to U+001F, which the split takes for symbols
        return s.isspace() and not any("\x1c" <= c <= "\x1f" for c in s)


class Counter:
    """Prefix tables of texts."""

    def __init__(self, spec: str):
        self.v = Vocabulary(spec)
        self.split = Splitter(spec)
        self.pieces = Pieces(self.v)

    def _cut(self, text: str) -> tuple[list, list[tuple[int, int, int, int]]]:
        """Pieces of a text; mends (piece, characters into it, first piece of the segment, count from there)."""
        if not any(s in text for s in self.v.specials):
            return self.split(text), []
        import re

        out, mends = [], []
        marks = "|".join(map(re.escape, sorted(self.v.specials, key=len, reverse=True)))
        segment, begun = "", 0
        for i, part in enumerate(re.split(f"({marks})", text)):
            if i % 2 == 0:
                segment, begun = part, len(out)
                out += self.split(part)
                continue
            for j in range(1, len(part)):  # a special string that is cut short is ordinary text
                cut = self.split(segment + part[:j])
                mends.append((len(out), j, begun, sum(self.pieces.total[self.pieces[p]] for p in cut)))
            out.append((part,))
        return out, mends

    def tables(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Counts at the prefixes of 0 to n characters of each text, one after the other; where each text begins (and the end)."""
        p = self.pieces
        if len(p.flat) > REMEMBERED:
            p.reset()
        keys, first, mends = [], [0], []
        for t in texts:
            own, more = self._cut(t)
            mends += [(len(keys) + k, j, len(keys) + s, n) for k, j, s, n in more]
            keys += own
            first.append(len(keys))
        ids = np.fromiter(map(p.__getitem__, keys), dtype=np.int64, count=len(keys))
        # White space cut off behind the first character of the next piece is one run up to there.
        blank, opens = (np.frombuffer(bytes(x), dtype=np.uint8) for x in (p.blank, p.opens_blank))
        inner = np.ones(len(keys) + 1, dtype=bool)
        inner[first] = False
        joined = np.flatnonzero((blank[ids[:-1]] & opens[ids[1:]]).astype(bool) & inner[1:-1]) + 1 if len(keys) > 1 else np.empty(0, np.int64)
        runs = [(k, 1, k - 1, p.total[p[keys[k - 1] + keys[k][0]]]) for k in joined.tolist()]
        length, total, at, flat = (np.array(x, dtype=np.int64) for x in (p.length, p.total, p.at, p.flat))
        lens, tots = length[ids], total[ids]
        begins, before = np.cumsum(lens) - lens, np.cumsum(tots) - tots
        n = int(lens.sum())
        counts = flat[np.repeat(at[ids] - begins, lens) + np.arange(n)] + np.repeat(before, lens)
        for k, j, s, m in runs + mends:
            counts[begins[k] + j - 1] = before[s] + m
        # Per text: a zero in front, and counts from its own beginning.
        first = np.array(first)
        chars, tokens = np.append(begins, n)[first], np.append(before, tots.sum())[first]
        sizes = np.diff(chars)
        counts -= np.repeat(tokens[:-1], sizes)
        starts = chars + np.arange(len(chars))
        out = np.zeros(int(starts[-1]), dtype=np.int32)
        slots = np.ones(len(out), dtype=bool)
        slots[starts[:-1]] = False
        out[slots] = counts
        return out, starts


def _counter(spec: str) -> Counter:
    """One counter a worker process, kept from task to task."""
    memo = sys.modules.setdefault("partsflow_worker_memo", types.ModuleType("partsflow_worker_memo"))
    kept = memo.__dict__.setdefault("counters", {})
    if spec not in kept:
        kept.clear()
        kept[spec] = Counter(spec)
    return kept[spec]


def _binary(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    raw = np.ascontiguousarray(values, dtype=">i4")
    return pa.BinaryArray.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer((4 * starts).astype(np.int32)), pa.py_buffer(raw)])


def prefix_counts(docs: DataFrame, tokenizer_path: str, text_col: str = "text", counts_col: str = "counts",
                  cuts_col: str | None = None) -> DataFrame:
    """``docs`` with ``counts_col``, binary: the token count of the prefix of i
    characters (0 to the whole text) as big-endian 32-bit integer number i, as the
    ``tokenizers`` library gives it without added special tokens.  ``cuts_col``
    names an optional column of the same form: number b is the length in characters
    of the longest prefix of at most b tokens, b from 0 to the whole text's count.
    (A longer prefix may have fewer tokens, so that is not the first cut.)

    Narrow: no shuffle.  A null text counts as empty; rows are independent, so
    repeated rows are treated alike; an empty table gives an empty one; a column of
    the given name is replaced.  A text is handled whole, in time linear in its
    length, with some 60 bytes of memory a character; a text of over 500 million
    characters has a table beyond what a Spark value holds and raises.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    Vocabulary(spec)  # an unsupported file raises here, not in a task
    shared = docs.sparkSession.sparkContext.broadcast(spec)
    text, counts, cuts = fresh(docs, "t"), fresh(docs, "counts"), fresh(docs, "cuts")
    keep = [c for c in docs.columns if c not in (counts_col, cuts_col)]

    def run(batches):
        counter = _counter(shared.value)
        for b in batches:
            texts, at = b.column(text).to_pylist(), 0
            rest = b.drop_columns([text])
            while at < len(texts):
                end, chars = at, 0
                while end < len(texts) and (end == at or chars + len(texts[end]) <= GROUP_CHARS):
                    chars += len(texts[end])
                    end += 1
                if chars > 500_000_000:
                    raise ValueError("a text of over 500 million characters has no prefix table")
                table, starts = counter.tables(texts[at:end])
                part = rest.slice(at, end - at)
                columns = [*part.columns, _binary(table, starts)]
                names = [*part.schema.names, counts]
                if cuts_col:
                    found = []
                    for a, z in zip(starts.tolist(), starts[1:].tolist()):
                        least = np.minimum.accumulate(table[a:z][::-1])[::-1]
                        found.append(np.searchsorted(least, np.arange(table[z - 1] + 1), side="right") - 1)
                    sizes = np.cumsum([0, *map(len, found)])
                    columns.append(_binary(np.concatenate(found), sizes))
                    names.append(cuts)
                yield pa.RecordBatch.from_arrays(columns, names=names)
                at = end

    source = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias(text))
    schema = T.StructType([f for f in source.schema.fields if f.name != text]).add(counts, "binary")
    if cuts_col:
        schema = schema.add(cuts, "binary")
    out = source.mapInArrow(run, schema).withColumnRenamed(counts, counts_col)
    return out.withColumnRenamed(cuts, cuts_col) if cuts_col else out


def _entry(table: Column, i: Column) -> Column:
    return F.conv(F.hex(F.substring(table, (i * 4 + 1).cast("int"), F.lit(4))), 16, 10).cast("int")


def count_at(counts: Column, n_chars: Column) -> Column:
    """Token count of the prefix of ``n_chars`` characters (a longer one: the whole text)."""
    return _entry(counts, F.least(n_chars, (F.octet_length(counts) / 4).cast("int") - 1))


def longest_within(cuts: Column, budget: Column) -> Column:
    """Characters of the longest prefix of at most ``budget`` tokens."""
    return _entry(cuts, F.least(budget, (F.octet_length(cuts) / 4).cast("int") - 1))
