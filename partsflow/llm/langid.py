"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over a bounded sample of labelled
text.  A document is parsed, for each language, into the longest phrases that
occur in that sample (a letter that the sample lacks is a phrase of its own);
phrases * log2(sample length) / characters estimates the cross entropy, and the
language with the smallest estimate wins.

The automata are dense transition tables (states x commonest letters) with sorted
lists of the transitions by all other letters of the samples.  A task parses
many blocks of ``BLOCK`` characters in lock step with array operations: the
parse starts anew at each block, in every language alike, so whole texts of any
length are covered in bounded memory.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from partsflow.llm.common import fresh

BLOCK = 512
MAX_DOCS = 64        # labelled documents a language, at most
MAX_DOC_CHARS = 4000  # a slice of at most so many characters of each
MAX_CHARS = 24_000   # normalised characters a language, at most
DENSE = 250          # commonest letters of the samples, with a column in the dense tables


def is_held_out(id_col: str = "doc_id") -> Column:
    """crc32(id as text) mod 3 = 1; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


class Codes:
    """Characters to symbols: 0 a run of non-letters, 1.. the alphabet (every letter
    of the samples), last any other letter, which no automaton has."""

    def __init__(self, alphabet: list[str]):
        self.alphabet = alphabet
        self.n = len(alphabet) + 2
        self._lut: np.ndarray | None = None  # made on first use, in each worker

    def lut(self) -> np.ndarray:
        if self._lut is None:
            lut = np.zeros(0x110000, dtype=np.uint16 if self.n <= 1 << 16 else np.uint32)
            lut[[i for i in range(0x110000) if chr(i).isalpha()]] = self.n - 1
            for k, c in enumerate(self.alphabet):
                lut[ord(c)] = k + 1
            self._lut = lut
        return self._lut

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all texts, one after the other, and how many each text has.
        Each text begins with a 0, and runs of non-letters are one 0."""
        low = [" " + (t or "").lower() for t in texts]
        raw = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        sym = self.lut()[raw]
        lens = np.array([len(t) for t in low], dtype=np.int64)
        first = np.zeros(len(sym), dtype=bool)
        first[np.cumsum(lens) - lens] = True
        keep = (sym != 0) | first
        keep[1:] |= sym[:-1] != 0
        at = np.cumsum(lens) - lens
        counts = np.add.reduceat(keep.astype(np.int64), at) if len(at) else lens
        return sym[keep], counts


def suffix_automaton(codes: list[int], n_dense: int, n_symbols: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Transitions of the suffix automaton of a code sequence: a table for the
    symbols below ``n_dense``, with a last column of zeros for all others, and
    sorted keys (state * n_symbols + symbol) and targets for those.  Row 0 is the
    dead state, row 1 the root; 0 means that the longer string doesn't occur."""
    nxt: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in codes:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    table = np.zeros((len(nxt) + 1, n_dense + 1), dtype=np.int32)
    sparse: list[tuple[int, int]] = []
    for s, out in enumerate(nxt):
        for c, t in out.items():
            if c < n_dense:
                table[s + 1, c] = t + 1
            else:
                sparse.append(((s + 1) * n_symbols + c, t + 1))
    sparse.sort()
    return table, np.array([k for k, _ in sparse], dtype=np.int64), np.array([t for _, t in sparse], dtype=np.int32)


class Model:
    """Languages in sorted order, their automata and sample lengths."""

    def __init__(self, samples: dict[str, list[str]], max_chars: int = MAX_CHARS):
        counts: dict[str, int] = {}
        for texts in samples.values():
            for t in texts:
                for c in t.lower():
                    if c.isalpha():
                        counts[c] = counts.get(c, 0) + 1
        best = sorted(counts, key=lambda c: (-counts[c], c))
        self.codes = Codes(sorted(best[:DENSE]) + best[DENSE:])
        self.langs: list[str] = []
        self.tables: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.weight: list[float] = []
        for lang in sorted(samples):
            sym, _ = self.codes.encode(samples[lang])
            sym = sym[:max_chars]
            if (sym > 0).any():
                self.langs.append(lang)
                self.tables.append(suffix_automaton(sym.tolist(), min(len(best), DENSE) + 1, self.codes.n))
                self.weight.append(math.log2(len(sym) + 1))

    def state(self) -> tuple:
        """Plain values only, as Spark's broadcasts need."""
        return self.codes.alphabet, self.langs, self.tables, self.weight

    @classmethod
    def restore(cls, state: tuple) -> "Model":
        m = cls.__new__(cls)
        m.codes, m.langs, m.tables, m.weight = Codes(state[0]), *state[1:]
        return m

    def _next(self, i: int, state: np.ndarray | int, c: np.ndarray) -> np.ndarray:
        """States of automaton i after the symbols ``c``; 0 where there is none."""
        table, keys, targets = self.tables[i]
        dense = table.shape[1] - 1
        t = table[state, np.minimum(c, dense)]
        rare = np.flatnonzero(c >= dense) if len(keys) else keys
        if len(rare):
            key = (state[rare].astype(np.int64) if isinstance(state, np.ndarray) else state) * self.codes.n + c[rare]
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            t[rare] = np.where(keys[at] == key, targets[at], 0)
        return t

    def phrases(self, sym: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """(texts, languages): phrases of the cross parsing of each text."""
        out = np.zeros((len(counts), len(self.langs)), dtype=np.int64)
        if not len(sym) or not self.langs:
            return out
        # Blocks, longest first: at step j only the first active[j] still have a symbol.
        n_blocks = -(-counts // BLOCK)
        doc = np.repeat(np.arange(len(counts)), n_blocks)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
        start = np.repeat(np.cumsum(counts) - counts, n_blocks) + nth * BLOCK
        size = np.minimum(BLOCK, counts[doc] - nth * BLOCK)
        order = np.argsort(-size, kind="stable")
        doc, start, size = doc[order], start[order], size[order]
        active = np.searchsorted(-size, -np.arange(BLOCK), side="left")
        state = [np.zeros(len(doc), dtype=np.int32) for _ in self.langs]
        found = [np.zeros(len(doc), dtype=np.int64) for _ in self.langs]
        for j in range(int(size[0])):
            k = active[j]
            c = sym[start[:k] + j].astype(np.int64)
            for i in range(len(self.tables)):
                t = self._next(i, state[i][:k], c)
                dead = np.flatnonzero(t == 0)
                found[i][dead] += 1
                t[dead] = self._next(i, 1, c[dead])
                state[i][:k] = t
        for i in range(len(self.langs)):
            out[:, i] = np.bincount(doc, weights=found[i], minlength=len(counts)).astype(np.int64)
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Language and score of each text; ``und`` and 0 without a letter."""
        sym, counts = self.codes.encode(texts)
        at = np.cumsum(counts) - counts
        letters = np.add.reduceat((sym != 0).astype(np.int64), at) if len(at) else counts
        if not self.langs:
            return ["und"] * len(texts), [0.0] * len(texts)
        h = self.phrases(sym, counts) * np.array(self.weight)[None, :] / np.maximum(counts, 1)[:, None]
        best = h.argmin(axis=1)
        lang = [self.langs[b] if n else "und" for b, n in zip(best, letters)]
        if len(self.langs) == 1:
            score = np.where(letters > 0, 1.0, 0.0)
        else:
            two = np.partition(h, 1, axis=1)[:, :2]
            score = np.where(letters > 0, two[:, 1] / np.maximum(two.sum(axis=1), 1e-12), 0.0)
        return lang, score.tolist()


def learn(docs: DataFrame, learn_on: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on a bounded sample: for each language the ``MAX_DOCS`` labelled
    documents whose hashed ids are smallest (those with a letter first), of
    longer ones a slice of ``MAX_DOC_CHARS`` characters from a hashed place (from
    the first letter, if that slice has none), cut off at ``MAX_CHARS`` symbols.
    Every language with a letter in a labelled text is learned, whatever the
    lengths and ids; the sample is what reaches the driver."""
    usable = (docs.where(learn_on).where(F.col(lang_col).isNotNull() & (F.length(text_col) > 0))
              .select(F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), F.col(text_col).alias("t"),
                      F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)).alias("k")))
    order = [(~F.col("t").rlike(r"\p{L}")).alias("bare"), F.xxhash64(F.col("id").cast("string")), F.col("id"), F.col("k")]
    keys = usable.select("lang", "k", *[c.alias(f"o{i}") for i, c in enumerate(order)])
    ranked = keys.select("lang", "k", F.row_number().over(Window.partitionBy("lang").orderBy("o0", "o1", "o2", "o3")).alias("r"))
    place = {(r["k"], r["lang"]): r["r"] for r in ranked.where(F.col("r") <= MAX_DOCS).collect()}
    spare = F.greatest(F.length("t") - MAX_DOC_CHARS, F.lit(0)) + 1
    some = F.substring(F.col("t"), (F.pmod(F.col("k"), spare) + 1).cast("int"), F.lit(MAX_DOC_CHARS))
    lead = F.length(F.regexp_extract("t", r"(?s)^\P{L}*", 0))
    part = F.when(some.rlike(r"\p{L}"), some).otherwise(F.substring(F.col("t"), lead + 1, F.lit(MAX_DOC_CHARS)))
    rows = (usable.where(F.col("k").isin(sorted({k for k, _ in place}))).select("k", "lang", part.alias("t")).distinct().collect()
            if place else [])
    samples: dict[str, list[str]] = {}
    for r in sorted((r for r in rows if (r["k"], r["lang"]) in place), key=lambda r: (place[r["k"], r["lang"]], r["t"])):
        samples.setdefault(r["lang"], []).append(r["t"])
    return Model(samples)


def identify(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None,
             pred_col: str = "lang_pred", score_col: str = "score", piece_chars: int = 4_000_000) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default: all) with the prediction.

    Rows are independent: repeated rows give repeated results, an empty table an
    empty one; a null text, an empty one, or one without a letter is ``und`` with
    score 0.  The automata are broadcast; their size is bounded by MAX_CHARS a
    language, whatever the input.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in (pred_col, score_col)]
    shared = docs.sparkSession.sparkContext.broadcast(model.state())
    # The text goes to the workers once; names of their own, so that no input column clashes.
    text, pred, score = text_col if text_col in keep else fresh(docs, "t"), fresh(docs, "pred"), fresh(docs, "score")
    aside = text_col not in keep
    extra = [F.col(text_col).alias(text)] if aside else []

    def run(batches):
        sys.modules.pop("partsflow_worker_memo", None)  # what another operator's tasks remember in this worker
        m = Model.restore(shared.value)
        for b in batches:
            rest = b.drop_columns([text]) if aside else b
            sizes = pc.fill_null(pc.utf8_length(b.column(text)), 0).to_numpy(zero_copy_only=False)
            at = 0
            while at < b.num_rows:
                end, chars = at, 0
                while end < b.num_rows and (end == at or chars < piece_chars):
                    chars += int(sizes[end])
                    end += 1
                lang, points = m.predict(b.column(text).slice(at, end - at).to_pylist())
                part = rest.slice(at, end - at)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lang, pa.string()), pa.array(points, pa.float64())],
                                                 names=[*part.schema.names, pred, score])
                at = end

    schema = docs.select(*keep).schema.add(pred, "string").add(score, "double")
    out = docs.select(*keep, *extra).mapInArrow(run, schema)
    return out.withColumnRenamed(pred, pred_col).withColumnRenamed(score, score_col)
