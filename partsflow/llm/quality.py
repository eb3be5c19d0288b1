"""Quality rules: a learned decision list over native text statistics.

Statistics are DataFrame expressions over whole texts.  Sequential covering
learns from the labelled documents: a rule is a conjunction of thresholds; it
grows by the condition of highest information gain on two thirds of the labelled
documents, is pruned on the other third, and is accepted if it is precise there;
what it covers is set aside and the next rule is learned.  Each step reads one
small histogram (feature, bin, label) that Spark counts over all labelled rows.
The ordered rules become one ``CASE WHEN``.  No Python runs on executors.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from partsflow.llm.common import materialize

WINDOW = 8
BINS = 24
MAX_RULES = 10
MAX_CONDITIONS = 3
MIN_PRECISION = 0.95
MIN_SUPPORT = 3
BLANK = r"[ \t-\r]"
FEATURES = {
    "f_words": "cast(n_words as double)",
    "f_word_length": "word_chars / greatest(n_words, 1)",
    "f_symbols": "n_symbols / greatest(n_words, 1)",
    "f_dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "f_repeats": "n_repeat_words / greatest(n_words, 1)",
    "f_capitals": "n_capitals / greatest(word_chars, 1)",
    "f_marks": "n_marks / greatest(n_words, 1)",
}


def statistics(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` and the text statistics of each row (null text: none)."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    words = F.filter(F.split(t, BLANK + "+"), lambda w: w != "")
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^ \t-\r]"))

    def count_of(chars: str) -> Column:
        return (F.length("__t") - F.length(F.translate("__t", chars, ""))).cast("long")

    base = docs.select(*keep, t.alias("__t"), words.alias("__w"), lines.alias("__l"))
    size = F.size("__w")
    hashes = F.when(size >= WINDOW, F.transform(F.sequence(F.lit(1), size - (WINDOW - 1)),
                                                lambda i: F.xxhash64(F.slice("__w", i, WINDOW)))).otherwise(F.array().cast("array<bigint>"))
    one = base.select(
        *keep, size.cast("long").alias("n_words"),
        F.length(F.translate("__t", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        count_of("#*$%&|<>").alias("n_symbols"),
        F.size("__l").cast("long").alias("n_lines"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        count_of("ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_capitals"), count_of("!?").alias("n_marks"), hashes.alias("__h"))
    # Positions of the windows that occur twice or more: neighbours in the sorted (hash, position).
    two = one.withColumn("__s", F.when(F.size("__h") > F.size(F.array_distinct("__h")), F.sort_array(
        F.transform("__h", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    s = F.col("__s")
    same = F.filter(s, lambda e, j: (F.when(j > 0, F.get(s, j - 1)["x"]) == e["x"]) | (F.get(s, j + 1)["x"] == e["x"]))
    three = two.withColumn("__p", F.sort_array(F.transform(same, lambda e: e["i"])))
    p = F.col("__p")
    covered = F.aggregate(F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1), x + WINDOW) - x)),
                          F.lit(0), lambda a, x: a + x)
    return three.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("__h", "__s", "__p")


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def sql(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut!r}D"


@dataclass(frozen=True)
class Rule:
    """Rejects what meets all conditions."""

    conditions: tuple[Condition, ...]

    def sql(self) -> str:
        return "(" + " AND ".join(c.sql() for c in self.conditions) + ")"


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    """FOIL's gain of narrowing (p0, n0) to (p, n)."""
    if p == 0:
        return 0.0
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))


def learn(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> list[Rule]:
    """Ordered rules that reject documents like those labelled 0.

    Labels are combined by id first (the smallest counts), so repeated labels do
    no harm; null ids and labels are left out; without labels there are no rules.
    """
    names = list(FEATURES)
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).alias("__id")).agg(F.min(label_col).alias("__y")))
    rows = stats.join(known, stats[id_col] == known["__id"]).select(
        *[F.expr(e).alias(f) for f, e in FEATURES.items()], (F.col("__y") == 0).alias("bad"),
        (F.pmod(F.xxhash64(F.col("__id").cast("string")), F.lit(3)) < 2).alias("grow"))
    rows = materialize(rows, "quality-labelled")
    steps = [i / BINS for i in range(1, BINS)]
    cuts_row = rows.agg(*[F.percentile_approx(f, steps, 10_000).alias(f) for f in names],
                        *[F.percentile_approx(F.when(F.col("bad"), F.col(f)), steps, 10_000).alias("b" + f) for f in names]).first()
    if cuts_row[names[0]] is None:
        return []
    cuts = {f: sorted({*(cuts_row[f] or []), *(cuts_row["b" + f] or [])}) for f in names}

    def bin_of(f: str) -> Column:
        # Bin i: values above cuts[i - 1] and not above cuts[i].
        return F.size(F.filter(F.lit(cuts[f]), lambda c: c < F.col(f)))

    binned = materialize(rows.select("bad", "grow", *names, F.array(*[bin_of(f) for f in names]).alias("bins")), "quality-binned")

    def histogram(df: DataFrame) -> dict[tuple[int, int], list[int]]:
        got = (df.select("bad", F.posexplode("bins").alias("f", "bin")).groupBy("f", "bin")
               .agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")).collect())
        return {(r["f"], r["bin"]): [r["p"], r["n"]] for r in got}

    def narrowest(hist: dict, p0: int, n0: int) -> tuple[float, Condition, int, int] | None:
        best = None
        for k, f in enumerate(names):
            p = n = 0
            for i, cut in enumerate(cuts[f]):
                at = hist.get((k, i), (0, 0))
                p, n = p + at[0], n + at[1]
                for above, (pp, nn) in ((False, (p, n)), (True, (p0 - p, n0 - n))):
                    if pp >= MIN_SUPPORT and pp + nn < p0 + n0:
                        g = _gain(pp, nn, p0, n0)
                        if g > 1e-9 and (best is None or g > best[0] + 1e-9):
                            best = (g, Condition(f, above, float(cut)), pp, nn)
        return best

    rules: list[Rule] = []
    left = binned
    for _ in range(MAX_RULES):
        live, conditions = left.where("grow"), []
        counts = live.agg(F.count_if("bad"), F.count_if(~F.col("bad"))).first()
        p, n = counts[0], counts[1]
        if p < MIN_SUPPORT or n == 0 and not rules:
            break
        while n and len(conditions) < MAX_CONDITIONS:
            found = narrowest(histogram(live), p, n)
            if found is None:
                break
            _, c, p, n = found
            conditions.append(c)
            live = live.where(c.sql())
        if not conditions:
            break
        # Prune on the held-back third: the shortest prefix of highest precision.
        held = left.where("NOT grow")
        prefixes = [Rule(tuple(conditions[:i])) for i in range(1, len(conditions) + 1)]
        got = held.agg(*[F.count_if(F.expr(r.sql()) & F.col("bad") if b else F.expr(r.sql()) & ~F.col("bad"))
                         for r in prefixes for b in (True, False)]).first()
        score = [(got[2 * i] + 1) / (got[2 * i] + got[2 * i + 1] + 2) for i in range(len(prefixes))]
        i = max(range(len(prefixes)), key=lambda i: (round(score[i], 9), -i))
        hits, misses = got[2 * i], got[2 * i + 1]
        if hits == 0 or hits / (hits + misses) < MIN_PRECISION:
            break
        rules.append(prefixes[i])
        left = left.where(f"NOT {prefixes[i].sql()}")
    return rules


def verdict(rules: list[Rule]) -> Column:
    """True to keep: an ordered ``CASE WHEN`` over the feature columns."""
    out = None
    for r in rules:
        out = F.when(F.expr(r.sql()), F.lit(False)) if out is None else out.when(F.expr(r.sql()), F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def judge(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """``stats`` with base_failed and kept.  Null and empty texts have no words
    and fail the base; repeated rows are judged alike."""
    full = stats.select("*", *[F.expr(e).alias(f) for f, e in FEATURES.items()])
    out = full.withColumn("base_failed", base_failed())
    return out.withColumn("kept", ~F.col("base_failed") & verdict(rules)).drop(*FEATURES)
