"""PII: keyed, type-consistent surrogates.

Detected entities (email, phone, IPv4, payment card, social security number,
IBAN, secret token, titled person name) get surrogates derived from
HMAC-SHA256(key, kind, canonical form, attempt).  A mention keeps its format:
separators, length, letter case and script, country code, card network and check
digit, IBAN country; a name keeps title, script, and the gender of the title.
Mentions with the same canonical form (case, separators and titles aside) are
coreferent and get the same surrogate.

Distinctness is checked over the whole corpus: of the entities that share a
surrogate one keeps it, the others, and those whose surrogate is itself an entity
of the corpus, try again with the next attempt until none is left.  Where a format
has too few surrogates, later attempts are longer by keyed characters, one more at
each attempt, so the search ends whatever the corpus holds.  A secret without a
letter or digit (a form's ``Password: ________``) is none.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from itertools import count

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from partsflow.llm.common import fresh, materialize

# ------------------------------------------------------------------- detection
_EMAIL = re.compile(r"(?<![\w.+%-])[\w.+%-]{1,64}@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,62})\.)+[A-Za-z]{2,24}(?![\w-])")
_NUMBER = re.compile(
    r"(?P<ip>(?<![\d.])(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}(?!\.?\d))"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))"
    r"|(?P<card>(?<![\d-])\d{4}(?:[ -]?\d{4}){3}(?![\d-])|(?<![\d-])3\d{3}[ -]?\d{6}[ -]?\d{5}(?![\d-]))"
    r"|(?P<phone>(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4}(?![\w-])"
    r"|(?<![\w(])\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}(?![\w-])"
    r"|(?<![\w.+-])\d{3}[ .-]\d{3}[ .-]\d{4}(?![\w-]))", re.ASCII)
# Scans that begin with a plain character class are many times faster than the
# patterns with look-behind; those are then tried only where such a scan stops.
_RUN = re.compile(r"[+(]?\d[\d().+ -]*", re.ASCII)
_NEXT = re.compile(r"[+(]?\d+|[+(]", re.ASCII)
_WORD = re.compile(r"\w")
_IBAN = re.compile(r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)", re.ASCII)
_TOKEN = re.compile(
    r"(?i:\b(?:token|secret|api[_-]?key|apikey|access[_-]?key|password|passwd|pwd)\b[\"']?\s*[:=]\s*[\"']?)(?P<value>(?=[_\-./+]*[A-Za-z0-9])[A-Za-z0-9_\-./+]{8,}=*)"
    r"|(?<!\w)(?P<known>AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9_-]{20,}|xox[abp]-[A-Za-z0-9-]{10,})(?!\w)")
_TOKEN_HINTS = ("token", "secret", "key", "passw", "pwd", "akia", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk-", "xox")
# Titles and the gender that they give.
TITLES = {
    "m": ["Mr", "Herr", "Monsieur", "Sr", "Señor", "Don", "Signor", "Г-н", "Господин", "Κύριος"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Sra", "Srta", "Señora", "Doña", "Signora", "Г-жа", "Госпожа", "Κυρία"],
}
_GENDER = {t: g for g, ts in TITLES.items() for t in ts}
_TITLE = re.compile("|".join(sorted(map(re.escape, _GENDER), key=len, reverse=True)))
_NAME = re.compile(r"(?<!\w)(?P<title>" + "|".join(sorted(map(re.escape, _GENDER), key=len, reverse=True))
                   + r")\.?[ ](?P<name>(?:[^\W\d_a-zа-яα-ω][^\W\d_]+)(?:[- ][^\W\d_a-zа-яα-ω][^\W\d_]+){0,2})(?!\w)")

# First names a script and gender; family names are composed of syllables.
FIRST = {
    ("latin", "m"): ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Jonas", "Leo", "Martin", "Oscar", "Paul", "Simon", "Thomas", "Victor", "Walter"],
    ("latin", "f"): ["Alice", "Berta", "Clara", "Diana", "Emma", "Flora", "Helena", "Iris", "Julia", "Laura", "Marta", "Nora", "Olga", "Paula", "Rosa", "Sofia"],
    ("cyrillic", "m"): ["Алексей", "Борис", "Виктор", "Дмитрий", "Иван", "Максим", "Олег", "Павел"],
    ("cyrillic", "f"): ["Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Ольга", "Татьяна"],
    ("greek", "m"): ["Ανδρέας", "Γιώργος", "Δημήτρης", "Κώστας", "Νίκος", "Παύλος"],
    ("greek", "f"): ["Άννα", "Ελένη", "Ειρήνη", "Κατερίνα", "Μαρία", "Σοφία"],
}
SYLLABLES = {
    "latin": ["ba", "ber", "den", "dor", "fal", "gan", "hol", "kel", "lan", "lor", "mar", "mon", "nel", "per", "ros", "sol", "tan", "ver", "vin", "wes"],
    "cyrillic": ["ба", "бер", "вол", "дор", "кар", "кол", "лов", "мар", "мор", "нев", "пет", "рус", "сол", "тар", "чер"],
    "greek": ["αν", "βα", "γα", "δη", "κα", "λο", "μα", "νι", "πα", "ρι", "στα", "τσι"],
}


def _luhn(digits: str) -> int:
    """Check digit that completes ``digits``."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def _script(s: str) -> str:
    c = next((x for x in s if x.isalpha()), "a")
    return "cyrillic" if "\u0400" <= c <= "\u04ff" else "greek" if "\u0370" <= c <= "\u03ff" else "latin"


def _digits(s: str) -> str:
    return "".join(c for c in s if c.isdigit())


def canonical(kind: str, raw: str, title: str = "") -> str:
    """What coreferent mentions share."""
    if kind in ("phone", "card", "ssn"):
        d = _digits(raw)
        return d[-10:] if kind == "phone" and len(d) >= 10 else d
    if kind == "email":
        return raw.lower()
    if kind == "iban":
        return raw.replace(" ", "")
    if kind == "name":
        return f"{_GENDER[title]} {raw.lower()}"
    return raw


def find(text: str | None) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical form) of the entities of a text, without overlaps, in order."""
    if not text:
        return []
    hits: list[tuple[int, int, str, str]] = []
    if "@" in text:
        hits += [(m.start(), m.end(), "email", canonical("email", m[0])) for m in _EMAIL.finditer(text)]
    low = text.lower()
    if any(h in low for h in _TOKEN_HINTS):
        for m in _TOKEN.finditer(text):
            g = "value" if m["value"] else "known"
            hits.append((m.start(g), m.end(g), "token", m[g]))
    digits = False
    for run in _RUN.finditer(text):
        digits, pos = True, run.start()
        while pos < run.end():
            m = _NUMBER.match(text, pos)
            if m and (m.lastgroup != "phone" or 8 <= len(_digits(m[0])) <= 15):
                hits.append((pos, m.end(), m.lastgroup, canonical(m.lastgroup, m[0])))
                pos = m.end()
            else:  # go on at the next start of a number, a bracket or a plus
                skip = re.match(r"\d+|.", text[pos:run.end()], re.DOTALL).end()
                nxt = _NEXT.search(text, pos + skip, run.end())
                pos = nxt.start() if nxt else run.end()
    for m in _IBAN.finditer(text) if digits else ():
        whole = m[0].replace(" ", "")
        if 15 <= len(whole) <= 34 and not (m.start() and _WORD.match(text[m.start() - 1])):
            turned = "".join(str(int(c, 36)) for c in whole[4:] + whole[:4])
            if int(turned) % 97 == 1:
                hits.append((m.start(), m.end(), "iban", whole))
    for t in _TITLE.finditer(text):
        m = _NAME.match(text, t.start())
        if m:
            hits.append((m.start("name"), m.end("name"), "name", canonical("name", m["name"], m["title"])))
    # Earlier first, then longer; what overlaps an accepted one is left out.
    out, end = [], 0
    for h in sorted(hits, key=lambda h: (h[0], -h[1])):
        if h[0] >= end:
            out.append(h)
            end = h[1]
    return out


# ------------------------------------------------------------------ surrogates
class _Stream:
    """Numbers drawn from HMAC-SHA256 in counter mode."""

    def __init__(self, key: bytes, kind: str, canon: str, attempt: int):
        self._key, self._seed, self._n, self._pool = key, f"{kind}\x00{attempt}\x00{canon}".encode("utf-8", "surrogatepass"), 0, 0
        self._left = 1

    def below(self, n: int) -> int:
        if self._left < 1 << 40:
            self._pool = int.from_bytes(hmac.digest(self._key, self._seed + self._n.to_bytes(4, "big"), hashlib.sha256), "big")
            self._left, self._n = 1 << 256, self._n + 1
        self._pool, r = divmod(self._pool, n)
        self._left //= n
        return r


def _like(c: str, s: _Stream) -> str:
    if c.isdigit():
        return str(s.below(10))
    if "a" <= c <= "z":
        return chr(97 + s.below(26))
    if "A" <= c <= "Z":
        return chr(65 + s.below(26))
    if "а" <= c.lower() <= "я":
        x = chr(0x430 + s.below(32))
        return x.upper() if c.isupper() else x
    if c.isalpha():
        x = "aeioubcdglmnprst"[s.below(16)]
        return x.upper() if c.isupper() else x
    return c


def surrogate(key: bytes, kind: str, canon: str, attempt: int) -> str:
    """The canonical form that takes the place of ``canon``; from an attempt on that
    depends on how many forms its format has, it is longer than ``canon``."""
    s = _Stream(key, kind, canon, attempt)
    new = _formatted(s, kind, canon)
    short = kind in ("email", "token") and sum(c.isalnum() for c in canon.split("@")[0]) < 8
    extra = attempt - (NARROW if short else ROOMY)
    if extra <= 0:
        return new
    if kind in ("phone", "card", "ssn"):
        return new + "".join(str(s.below(10)) for _ in range(extra))
    if kind == "ip":
        return new + "".join(f".{1 + s.below(254)}" for _ in range(extra))
    if kind == "name":
        syllables = SYLLABLES[_script(canon[2:])]
        return new + "".join(syllables[s.below(len(syllables))] for _ in range(extra))
    more = "".join("abcdefghijklmnopqrstuvwxyz"[s.below(26)] for _ in range(extra))
    if kind == "email":
        local, at, host = new.partition("@")
        return local + more + at + host
    return new + (more.upper() if kind == "iban" else more)


#: Attempts within the format, for long and for short entities.
ROOMY, NARROW = 16, 2


def _formatted(s: _Stream, kind: str, canon: str) -> str:
    if kind == "email":
        local = canon.split("@")[0]
        host = "".join("abcdefghijklmnopqrstuvwxyz"[s.below(26)] for _ in range(8))
        # Reserved domains: the address can be no one's.
        return "".join(_like(c, s) for c in local) + "@" + host + (".example.com", ".example.net", ".example.org")[s.below(3)]
    if kind == "ip":
        return ".".join(str(1 + s.below(254)) for _ in range(4))
    if kind == "card":
        body = canon[0] + "".join(str(s.below(10)) for _ in canon[1:-1])
        check = _luhn(body)
        if _luhn(canon[:-1]) != int(canon[-1]):  # an invalid number stays invalid
            check = (check + 1 + s.below(9)) % 10
        return body + str(check)
    if kind == "phone":
        return str(2 + s.below(8)) + "".join(str(s.below(10)) for _ in canon[1:])
    if kind == "iban":
        body = "".join(_like(c, s) for c in canon[4:])
        turned = "".join(str(int(c, 36)) for c in body + canon[:2] + "00")
        return f"{canon[:2]}{98 - int(turned) % 97:02d}{body}"
    if kind == "name":
        gender, words = canon[0], re.split("[- ]", canon[2:])
        script = _script(canon[2:])
        names = FIRST[script, gender]
        new = [names[s.below(len(names))]] if len(words) > 1 else []
        while len(new) < len(words):
            syl = SYLLABLES[script]
            new.append("".join(syl[s.below(len(syl))] for _ in range(3 + s.below(3))).capitalize())
        return f"{gender} {' '.join(new)}".lower()
    if kind == "token" and re.fullmatch("[0-9a-f]+|[0-9A-F]+", canon):
        hexa = "0123456789abcdef" if canon.lower() == canon else "0123456789ABCDEF"
        return "".join(hexa[s.below(16)] for _ in canon)
    head = next((p for p in ("AKIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk-", "xoxa-", "xoxb-", "xoxp-") if kind == "token" and canon.startswith(p)), "")
    return head + "".join(_like(c, s) for c in canon[len(head):])


def render(kind: str, raw: str, new: str) -> str:
    """The surrogate in the format of the mention ``raw``."""
    if kind in ("phone", "card", "ssn", "iban"):
        chars = [c for c in raw if c.isalnum()]
        keep = len(chars) - len(new)  # a country code stands before the canonical digits
        fill = iter(chars[:keep] + list(new)) if keep >= 0 else iter(new)
        return "".join([next(fill) if c.isalnum() else c for c in raw] + list(fill))
    if kind == "email":
        return new.upper() if raw.isupper() else new
    if kind == "name":
        words = new[2:].split(" ")
        seps = re.findall("[- ]", raw)
        old = re.split("[- ]", raw)
        shown = [w.upper() if o.isupper() and len(o) > 1 else w.capitalize() for w, o in zip(words, old)]
        return "".join(w + s for w, s in zip(shown, seps + [""]))
    return new


def replace(text: str | None, key: bytes, attempts: dict[tuple[str, str], int]) -> tuple[str | None, list[str]]:
    """The text with surrogates, and the kinds replaced."""
    out, at, kinds = [], 0, []
    for start, end, kind, canon in find(text):
        new = surrogate(key, kind, canon, attempts.get((kind, canon), 0))
        out += [text[at:start], render(kind, text[start:end], new)]
        at = end
        kinds.append(kind)
    return ("".join(out) + text[at:], kinds) if kinds else (text, kinds)


# -------------------------------------------------------------------- on Spark
def mentions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(k, kind, canon): the distinct entities of each row; k names the row."""
    def run(batches):
        for b in batches:
            rows = [(k, kind, canon) for k, t in zip(b["k"], b["t"]) for kind, canon in sorted({h[2:] for h in find(t)})]
            yield pd.DataFrame(rows, columns=["k", "kind", "canon"])

    src = docs.select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("k"), F.col(text_col).alias("t"))
    return src.mapInPandas(run, "k long, kind string, canon string")


def assign(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, canon, attempt) of the entities that need an attempt above 0.

    After it no two entities of a kind share a surrogate, and no surrogate is an
    entity of the corpus.  There is no last attempt: longer surrogates always come
    to an end."""
    def run(attempt):
        def f(batches):
            for b in batches:
                b["new"] = [surrogate(key, k, c, attempt) for k, c in zip(b["kind"], b["canon"])]
                yield b
        return f

    known = entities.select("kind", F.col("canon").alias("new"))
    pending, taken, moved = entities.select("kind", "canon"), None, []
    for attempt in count():
        tried = materialize(pending.mapInPandas(run(attempt), "kind string, canon string, new string"), "pii-tried")
        free = tried.join(known, ["kind", "new"], "left_anti")
        if taken is not None:
            free = free.join(taken, ["kind", "new"], "left_anti")
        won = materialize(free.groupBy("kind", "new").agg(F.min("canon").alias("canon")), "pii-won")
        if attempt:
            moved.append(won.select("kind", "canon", F.lit(attempt).alias("attempt")))
        taken = won.select("kind", "new") if taken is None else taken.union(won.select("kind", "new"))
        pending = tried.join(won, ["kind", "canon"], "left_anti").select("kind", "canon")
        if pending.isEmpty():
            break
    out = entities.select("kind", "canon", F.lit(0).alias("attempt")).limit(0)
    for m in moved:
        out = out.union(m)
    return materialize(out, "pii-moved")


def pseudonymize(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text", kinds_col: str | None = None) -> DataFrame:
    """``docs`` with surrogates in the text; ``kinds_col`` names an optional column
    with the kinds replaced, in order.

    Null and empty texts, and texts without an entity, stay as they are; repeated
    rows are treated alike; ids are not used but to name rows, so null ids do no
    harm; an empty table gives an empty one; a text is handled whole, whatever its
    length.  Texts pass through no shuffle unless
    the entities with colliding surrogates outgrow a broadcast.
    """
    secret = key.encode()
    found = materialize(mentions(docs, id_col, text_col), "pii-mentions")
    moved = assign(found.select("kind", "canon").distinct(), secret)
    k, tries, kinds = fresh(docs, "k"), fresh(docs, "tries"), fresh(docs, "kinds")
    src = docs
    any_moved = not moved.isEmpty()
    if any_moved:
        per_row = found.join(moved, ["kind", "canon"]).distinct().groupBy("k").agg(F.collect_list(F.struct("kind", "canon", "attempt")).alias(tries))
        per_row = materialize(per_row.withColumnRenamed("k", k), "pii-rows")
        src = docs.withColumn(k, F.xxhash64(F.col(id_col), F.col(text_col))).join(per_row, k, "left").drop(k)

    def run(batches):
        for b in batches:
            attempts = [{(t["kind"], t["canon"]): t["attempt"] for t in x} if x is not None else {} for x in b[tries]] if any_moved else [{}] * len(b)
            done = [replace(t, secret, a) for t, a in zip(b[text_col], attempts)]
            b[text_col] = pd.Series([d[0] for d in done], dtype=object, index=b.index)
            if kinds_col:
                b[kinds] = pd.Series([d[1] for d in done], dtype=object, index=b.index)
            yield b.drop(columns=[tries]) if any_moved else b

    schema = docs.schema
    if kinds_col:
        schema = docs.select("*").schema.add(kinds, T.ArrayType(T.StringType()))
    out = src.mapInPandas(run, schema)
    return out.withColumnRenamed(kinds, kinds_col) if kinds_col else out
