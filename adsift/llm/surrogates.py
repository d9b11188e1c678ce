"""Surrogates for personal data: keyed, type-consistent replacements.

Mentions of emails, phone and card numbers, IP addresses, account numbers,
secrets and titled names are found in each text. An entity is a kind with a
canonical value (case and separators removed), so all mentions of it in the
corpus get the same surrogate, drawn by HMAC from the key. It looks like the
original: digits stay digits, letters stay letters of the same script and
case, separators stay, card numbers keep a valid check digit if they had one,
names fit gender and script. Names are replaced part by part, and a part found
with a title is replaced where it stands alone (also in capitals) in the same
text too.

Collisions are checked over the whole corpus: a surrogate that another entity
of the kind has, or that equals an entity of the corpus, is drawn again with
the next attempt; of entities that drew the same one the smallest keeps it.
Later attempts grow longer, so rounds end even for short formats.

Defined cases: a null text stays null and an empty one empty, without
entities; overlapping mentions: the longer one, then the earlier; repeated
rows get equal results; no rows give no rows. Results never hold originals.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.strategy import write_table
from .shared import FILE, ROW, as_scan, with_row_key

KEY = "surrogates-1"
GROW_AFTER = 6

# Titles with the gender they tell, syllables and endings of surrogate names by script.
TITLES = {
    "Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Sir": "m", "Herr": "m", "Frau": "f", "Monsieur": "m", "Madame": "f",
    "Señor": "m", "Señora": "f", "господин": "m", "госпожа": "f", "Dr": "n", "Prof": "n",
}
SYLLABLES = {
    "latin": "ba be bo ca co da de do fa fe ga ge ha ho ja jo ka ke la le lo ma me mo na ne no pa pe ra re ro sa se so ta te to va vi".split(),
    "cyrillic": "ба ве во га да де до за ка ко ла ле ло ма ми мо на не но па пе ра ре ро са се со та ти то фа".split(),
}
ENDINGS = {
    ("latin", "m"): "rd n s rt".split(), ("latin", "f"): "lla na ra tta".split(), ("latin", "n"): "mann son well ston".split(),
    ("cyrillic", "m"): "н р м".split(), ("cyrillic", "f"): "на ра ля".split(), ("cyrillic", "n"): "енко ук ич".split(),
}
# First and last letters of scripts whose names are replaced letter by letter.
RANGES = (("α", "ω"), ("א", "ת"), ("ا", "ي"), ("ぁ", "ん"), ("ァ", "ン"), ("一", "龥"), ("가", "힣"), ("अ", "ह"), ("ա", "ֆ"), ("ა", "ჰ"))

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
IP = re.compile(r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)")
CARD = re.compile(r"(?<![\d-])\d{4}([ -]?)\d{4}\1\d{4}\1\d{1,7}(?![\d-])")
# With a plus or a bracketed area code, in a national grouping (North America, France, United Kingdom, Germany), or after a word that
# tells one. Other rows of number groups are no phones, and neither are dates.
PHONE = re.compile(r"""(?<![\w+])(?<!\d[.-])(?:
    (?:\+?1[ .-]?)?\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}
  | \+1[ .-]?\d{3}[ .-]?\d{3}[ .-]?\d{4}
  | \+(?=(?:[ .()-]{0,2}\d){7})\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,5}(?:[ .-]\d{2,8}){1,5}
  | \+\d{8,15}
  | \((?:\d{2,3}|0\d{2,5})\)[ .-]?\d{3,8}(?:[ .-]\d{2,5}){0,3}
  | (?:1[.-])?[2-9]\d{2}([.-])\d{3}\1\d{4}
  | (?<!\d[ ])0[1-9]([ .-])\d{2}\2\d{2}\2\d{2}\2\d{2}(?![ .-]\d)
  | (?<!\d[ ])0\d{2,4}[ -]\d{3,4}[ -]\d{3,4}(?![ .-]\d)
  | (?<!\d[ ])0\d{2,4}[ /-]\d{5,8}(?![ .-]\d)
  )(?![\w])(?![.-]\d)""", re.VERBOSE)
CUED = re.compile(r"(?i)\b(?:tel|phone|telephone|telefon|téléphone|teléfono|тел|телефон|call|fax|mobile|mobil|cell|whatsapp)\b[.:]{0,2} ?"
                  r"((?:\(\d{2,4}\)[ .-]?|\d{2,5}[ .-])\d{2,4}(?:[ .-]\d{2,5}){1,3}|\d{7,12})(?![\w-])(?!\.\d)")
_DAY, _MONTH = r"(?:0?[1-9]|[12]\d|3[01])", r"(?:0?[1-9]|1[0-2])"
DATE = re.compile(rf"(?:\d{{4}}([ .-]){_MONTH}\1{_DAY}|{_DAY}([ .-]){_MONTH}\2\d{{4}}|{_MONTH}([ .-]){_DAY}\3\d{{4}})(?!\d)"
                  rf"|(?:{_DAY}([ .-]){_MONTH}\4\d\d|{_MONTH}([ .-]){_DAY}\5\d\d)$")
SSN = re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")
IBAN = re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b")
ACCESS = re.compile(r"\bAKIA[0-9A-Z]{16}\b")
# The key word may stand within a longer name and in quotes; a value in quotes reaches to the closing one.
SECRET = re.compile(r"""(?i)(?:password|passwd|secret|token|api[_-]?key)(?:s|[_.-][\w.-]{0,40}|(?-i:[A-Z0-9])\w{0,40})?\\*["']?\s*(?:=>|[=:])\s*"""
                    r"""(?:(?P<quote>\\*["'])(?P<quoted>[^\n]{1,4096}?)(?P=quote)|\\*["']?(?P<plain>[^\s,;]+))""")


def char_class(holds) -> str:
    """Ranges of a character class of the characters that ``holds`` is true for."""
    codes = [i for i in range(sys.maxunicode + 1) if holds(chr(i))]
    runs = [(a, b) for a, b in zip([i for i, before in zip(codes, [-2, *codes]) if i != before + 1],
                                   [i for i, after in zip(codes, [*codes[1:], -2]) if after != i + 1], strict=True)]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs)


# Vowel signs and other marks belong to a word, and so do the joiners between them.
MARKS = char_class(lambda c: unicodedata.category(c)[0] == "M") + "\u200c\u200d"
PART = rf"[^\W\d_a-zа-я](?:[^\W\d_]|[{MARKS}])*"
NAME = re.compile(r"\b(" + "|".join(TITLES) + rf")\.? ({PART}(?:[ -]{PART})?)")
DIGIT = re.compile(r"\d")


def bare(kind: str, raw: str) -> str:
    """The canonical value of a mention."""
    if kind in ("phone", "card", "ssn"):
        return re.sub(r"\D", "", raw)
    if kind == "iban":
        return raw.replace(" ", "")
    return raw if kind in ("access", "secret", "ip") else raw.lower()


def detect(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical value) of the mentions, in order and apart from each other."""
    found: list[tuple[int, int, str]] = []

    def add(kind: str, pattern: re.Pattern):
        found.extend((*m.span(), kind) for m in pattern.finditer(text))

    if "@" in text:
        add("email", EMAIL)
    if DIGIT.search(text):
        for kind, pattern in (("ip", IP), ("card", CARD), ("phone", PHONE), ("ssn", SSN), ("iban", IBAN)):
            add(kind, pattern)
        found.extend((*m.span(1), "phone") for m in CUED.finditer(text) if not DATE.match(m[1]) and not SSN.fullmatch(m[1]))
    if "AKIA" in text:
        add("access", ACCESS)
    if "=" in text or ":" in text:
        found.extend((*m.span("quoted" if m["quoted"] else "plain"), "secret") for m in SECRET.finditer(text))
    if any(t in text for t in TITLES):
        parts: dict[str, str] = {}
        for m in NAME.finditer(text):
            names = [n for n in re.split(r"[ -]", m[2]) if n]
            for i, name in enumerate(names):
                gender = "n" if i == len(names) - 1 else TITLES[m[1]]
                parts.setdefault(name, f"name-{gender}")
        parts |= {name.upper(): kind for name, kind in parts.items() if len(name) > 2 and name.upper() not in parts}
        if parts:
            alone = re.compile(rf"(?<![\w{MARKS}])(?:" + "|".join(map(re.escape, sorted(parts, key=lambda p: (-len(p), p)))) + rf")(?![\w{MARKS}])")
            found += [(*m.span(), parts[m[0]]) for m in alone.finditer(text)]
    taken, out = [], []
    for start, end, kind in sorted(found, key=lambda f: (f[0] - f[1], f[0], f[2])):
        if all(end <= s or start >= e for s, e in taken):
            taken.append((start, end))
            out.append((start, end, kind, bare(kind, text[start:end])))
    return sorted(out)


class Draw:
    """Keyed choices for one entity and attempt."""

    def __init__(self, key: str, kind: str, value: str, attempt: int, again: int = 0):
        self.seed = hmac.new(key.encode(), (f"{kind}\0{value}\0{attempt}" + (f"\0{again}" if again else "")).encode(), hashlib.sha256).digest()
        self.block, self.held = 0, b""

    def below(self, n: int) -> int:
        if len(self.held) < 4:
            self.held += hashlib.sha256(self.seed + self.block.to_bytes(4, "big")).digest()
            self.block += 1
        x, self.held = int.from_bytes(self.held[:4], "big"), self.held[4:]
        return x % n

    def letter(self, c: str) -> str:
        """A letter or digit of the same script and case."""
        if c.isdecimal():
            return str(self.below(10)) if c.isascii() else chr(ord(c) - int(c) + self.below(10))
        low = c.lower()
        for first, last in (("a", "z"), ("а", "я"), *RANGES):
            if first <= low <= last:
                new = chr(ord(first) + self.below(ord(last) - ord(first) + 1))
                return new.upper() if c.isupper() else new
        family = family_of(c)
        if family is None:
            return c
        letters = families()[family]
        if family[0] == "LATIN" or len(letters) < 2:
            new = chr(ord("a") + self.below(26))
            return new.upper() if c.isupper() else new
        return letters[self.below(len(letters))]


def family_of(c: str) -> tuple | None:
    """(script, case, mark or not) of a letter or of a script's own mark; None for any other character."""
    mark = unicodedata.category(c)[0] == "M"
    if not (mark or c.isalpha()):
        return None
    name = unicodedata.name(c, "")
    if mark and (not name or name.startswith(("COMBINING", "VARIATION"))):
        return None
    # Letters without a name: their 128 code points.
    return (SCRIPT_END.split(name)[0] if name else str(ord(c) >> 7), c.isupper(), c.islower(), mark)


SCRIPT_END = re.compile(r" (?:CAPITAL|SMALL|LETTER|SYLLABLE|SYLLABICS|CHARACTER|VOWEL|CONSONANT|LIGATURE|IDEOGRAPH|SIGN|MARK|HIEROGLYPH|MODIFIER)\b")


@lru_cache(maxsize=1)
def families() -> dict[tuple, list[str]]:
    out: dict[tuple, list[str]] = {}
    for i in range(sys.maxunicode + 1):
        if (family := family_of(chr(i))) is not None:
            out.setdefault(family, []).append(chr(i))
    return out


def check_digit(digits: str) -> str:
    """Luhn digit for the digits before it."""
    total = sum(d if i % 2 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, reversed(digits))))
    return str(-total % 10)


def script(word: str) -> str:
    return "cyrillic" if any("Ѐ" <= c <= "ӿ" for c in word) else "latin" if all(ord(c) < 0x250 for c in word) else "other"


def surrogate(key: str, kind: str, value: str, attempt: int) -> str:
    """Canonical surrogate of an entity, which does not hold the value."""
    for again in range(16):
        new = drawn(key, kind, value, attempt, again)
        if value not in new and value not in new.lower():
            return new
    # No character of the value can be drawn, as in a secret of signs alone: letters in their places.
    draw = Draw(key, kind, value, attempt, 16)
    return "".join(draw.letter("q") for _ in range(len(value) + max(0, attempt - GROW_AFTER)))


def drawn(key: str, kind: str, value: str, attempt: int, again: int) -> str:
    draw = Draw(key, kind, value, attempt, again)
    grown = max(0, attempt - GROW_AFTER)
    if kind.startswith("name-") and script(value) != "other":
        s, gender = script(value), kind[-1]
        syllables, endings = SYLLABLES[s], ENDINGS[s, gender]
        return "".join(syllables[draw.below(len(syllables))] for _ in range(2 + grown)) + endings[draw.below(len(endings))]
    if kind == "ip":
        return ".".join(str(1 + draw.below(254)) for _ in range(4))
    if kind == "card":
        body = value[0] + "".join(draw.letter(c) for c in value[1:-1])
        return body + (check_digit(body) if check_digit(value[:-1]) == value[-1] else draw.letter(value[-1]))
    if kind == "access":
        return "AKIA" + "".join(draw.letter(c) for c in value[4:])
    if kind == "email":
        local, _, domain = value.partition("@")
        name, dot, top = domain.rpartition(".")
        return "".join(map(draw.letter, local)) + "".join(draw.letter("a") for _ in range(grown)) + "@" + "".join(map(draw.letter, name)) + dot + top
    return "".join(map(draw.letter, value)) + "".join(draw.letter(value[-1]) for _ in range(grown))


def styled(raw: str, kind: str, new: str) -> str:
    """The canonical surrogate in the form of a mention: its separators and case."""
    if kind in ("phone", "card", "ssn", "iban"):
        left, out = iter(new), []
        for c in raw:
            out.append(next(left, "") if c.isalnum() else c)
        return "".join(out) + "".join(left)
    if kind.startswith("name-"):
        return new.upper() if raw.isupper() and len(raw) > 1 else new[:1].upper() + new[1:] if raw[:1].isupper() else new
    if kind == "email" and raw.isupper():
        return new.upper()
    return new


FOUND = pa.schema([(FILE, pa.string()), (ROW, pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("value", pa.string())])


def mentions(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """One row per mention: the row's place, start, end, kind, value."""
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(f, r, *m) for f, r, text in zip(*[c.to_pylist() for c in batch.columns], strict=True) for m in detect(text)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), FOUND, strict=True)], schema=FOUND)

    rows = with_row_key(docs, F.col(text_col).alias("text")).select(FILE, ROW, "text").where("text is not null")
    return rows.mapInArrow(found, f"{FILE} string, {ROW} long, start int, end int, kind string, value string")


def assign(entities: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, value), all different -> (kind, value, surrogate): different ones within a kind, none of them an entity's value."""
    def drawing(attempt: int):
        @F.pandas_udf("string")
        def draw(kind: pd.Series, value: pd.Series) -> pd.Series:
            return pd.Series([surrogate(key, k, v, attempt) for k, v in zip(kind, value, strict=True)], dtype=object)

        return draw("kind", "value")

    entities = write_table(entities, "entities")
    taken = entities.select(F.col("kind").alias("k"), F.col("value").alias("s"))
    settled, pending, attempt = None, entities, 0
    while not pending.isEmpty():
        tried = write_table(pending.select("kind", "value", drawing(attempt).alias("surrogate")), "drawn")
        free = tried.join(taken, (F.col("kind") == F.col("k")) & (F.col("surrogate") == F.col("s")), "left_anti")
        if settled is not None:
            used = settled.select(F.col("kind").alias("k"), F.col("surrogate").alias("s"))
            free = free.join(used, (F.col("kind") == F.col("k")) & (F.col("surrogate") == F.col("s")), "left_anti")
        won = write_table(free.groupBy("kind", "surrogate").agg(F.min("value").alias("value")).select("kind", "value", "surrogate"), "won")
        settled = won if settled is None else settled.unionByName(won)
        lost = tried.select("kind", "value").join(won.select(F.col("kind").alias("k"), F.col("value").alias("s")),
                                                  (F.col("kind") == F.col("k")) & (F.col("value") == F.col("s")), "left_anti")
        pending, attempt = write_table(lost, "pending"), attempt + 1
    return settled if settled is not None else entities.withColumn("surrogate", F.col("value"))


def replaced(docs: DataFrame, text_col: str = "text", key: str = KEY) -> DataFrame:
    """``docs`` with the text replaced, and columns n_entities and kinds (instead of own columns of these names)."""
    docs = as_scan(docs)
    found = write_table(mentions(docs, text_col), "mentions")
    given = assign(found.select("kind", "value").distinct(), key).select(F.col("kind").alias("k"), F.col("value").alias("v"), "surrogate")
    spans = (found.join(given, (F.col("kind") == F.col("k")) & (F.col("value") == F.col("v")))
             .groupBy(F.col(FILE).alias("f"), F.col(ROW).alias("r"))
             .agg(F.sort_array(F.collect_list(F.struct("start", "end", "kind", "surrogate"))).alias("spans")))

    names = [c for c in docs.columns if c.lower() not in ("n_entities", "kinds")]
    schema = T.StructType([*[docs.schema[c] for c in names], T.StructField("n_entities", T.LongType()), T.StructField("kinds", T.StringType())])
    place = names.index(text_col)

    def rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, kinds = [], [], []
            for t, marks in zip(batch.column(place).to_pylist(), batch.column(len(names)).to_pylist(), strict=True):
                at, parts = 0, []
                for m in marks or ():
                    parts += [t[at : m["start"]], styled(t[m["start"] : m["end"]], m["kind"], m["surrogate"])]
                    at = m["end"]
                texts.append("".join(parts) + t[at:] if parts else t)
                counts.append(len(marks or ()))
                kinds.append(",".join(sorted({m["kind"].partition("-")[0] for m in marks or ()})))
            columns = list(batch.columns[: len(names)])
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(kinds, pa.string())], names=schema.names)

    rows = with_row_key(docs, F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"))
    joined = rows.join(spans, (F.col(FILE) == F.col("f")) & (F.col(ROW) == F.col("r")), "left")
    # Numbered columns, so that none of the table's can clash with the spans.
    joined = joined.select(*[F.col("doc")[c].alias(f"c{i}") for i, c in enumerate(names)], F.col("spans").alias("marks"))
    return joined.mapInArrow(rewritten, schema)
