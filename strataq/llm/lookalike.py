"""Visually identical text with different characters, brought to one form.

Texts are taken apart (NFD), full-width forms, ligatures, number forms and spaces
become ordinary ones, ignorable characters go, and each run of letters is read as
a lattice: at every position stand all letters that look like the one written.
Viterbi finds the reading with the fewest changes of script, then the fewest
letters outside the Latin alphabet, then the best score under character bigrams of
the corpus.  The lattice depends on the looks alone, so equal-looking texts get the
same reading; different-looking ones share no letter at some position.  The result
is composed again (NFC).

Only texts with a character that could change reach Python; the others are their
own form and stay in the JVM.

Defined results
---------------
* null stays null; a text of ignorable characters only becomes '';
* case, accents, superscripts, signs, line ends and repeated spaces stay;
* a letter with several Latin looks (the palochka: l or I) is read by the bigrams
  around it, and as the first of them where these are equal;
* a word with letters that look like no Latin one keeps one script throughout;
* very long texts are read whole, word by word.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataq.operators.current import current_rows
from strataq.session import durable

# For each Latin letter the letters of other alphabets that look like it.
LOOKS = {
    "A": "ΑАᎪ", "B": "ΒВ", "C": "СϹᏟ", "D": "Ꭰ", "E": "ΕЕᎬ", "F": "Ϝ", "G": "Ԍ", "H": "ΗНᎻ", "I": "ΙІӀ", "J": "ЈͿᎫ",
    "K": "ΚКᏦ", "L": "Ꮮ", "M": "ΜМϺᎷ", "N": "Ν", "O": "ΟОՕ", "P": "ΡРᏢ", "Q": "Ԛ", "S": "ЅՏᏚ", "T": "ΤТᎢ", "U": "Ս",
    "V": "ѴᏙ", "W": "ԜᎳ", "X": "ΧХ", "Y": "ΥҮ", "Z": "ΖᏃ",
    "a": "аɑ", "c": "сϲ", "d": "ԁ", "e": "е", "g": "ɡց", "h": "һհ", "i": "і", "j": "јϳ", "l": "ӏӀǀ", "n": "ո",
    "o": "оοօ", "p": "р", "q": "ԛզ", "s": "ѕ", "u": "ս", "v": "νѵ", "w": "ԝ", "x": "х", "y": "уү",
}

#: Characters without any looks.
IGNORABLE = "­͏؜᠎​‌‍‎‏⁠⁡⁢⁣⁤﻿"
SPACES = "  " + "".join(map(chr, range(0x2000, 0x200B))) + "  　"
#: Ranges whose compatibility forms look the same: full-width forms, ligatures, Roman number forms, digraphs.
COMPATIBLE = ((0xFF01, 0xFF5E), (0xFFE0, 0xFFE6), (0xFB00, 0xFB06), (0x2160, 0x217F), (0x0132, 0x0133), (0x01C7, 0x01CC), (0x01F1, 0x01F3))

#: A Java pattern: a text without such a character is its own form.
ACTIVE = (
    "[\\u00AD\\u00A0\\u0132\\u0133\\u01C0\\u01C7-\\u01CC\\u01F1-\\u01F3\\u0251\\u0261\\u0300-\\u036F\\u0370-\\u058F\\u061C\\u1680\\u180E\\u13A0-\\u13FF"
    "\\u1AB0-\\u1AFF\\u1DC0-\\u1DFF\\u1F00-\\u1FFF\\u2000-\\u200F\\u202F\\u205F-\\u2064\\u20D0-\\u20FF\\u212A\\u212B\\u2126\\u2160-\\u217F\\u3000\\uFB00-\\uFB06\\uFEFF\\uFF01-\\uFF5E\\uFFE0-\\uFFE6]"
)

#: Texts of one look that one task meets.
HOT = 50_000

# Costs that no score of a word of ordinary length reaches.
SWITCH, FOREIGN = 1e9, 1e5
_WORD = re.compile(r"[^\W\d_](?:[̀-ͯ]|[^\W\d_])*")


@lru_cache(1)
def _tables() -> tuple[dict, dict, dict]:
    plain = {ord(c): None for c in IGNORABLE} | {ord(c): " " for c in SPACES}
    for a, b in COMPATIBLE:
        plain |= {x: unicodedata.normalize("NFKC", chr(x)) for x in range(a, b + 1)}
    classes: dict[str, list[str]] = {}
    for latin, others in LOOKS.items():
        for c in others:
            classes.setdefault(c, []).append(latin)
    # All letters that look like the written one, Latin first.
    lattice = {latin: [latin, *others] for latin, others in LOOKS.items()}
    for c, latins in classes.items():
        lattice[c] = [*latins, *dict.fromkeys(o for x in latins for o in LOOKS[x])]
    first = {ord(c): latins[0] for c, latins in classes.items()}
    return plain, lattice, first


@lru_cache(4096)
def script(c: str) -> str:
    x = ord(c)
    for name, a, b in (("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F), ("armenian", 0x530, 0x58F), ("cherokee", 0x13A0, 0x13FF)):
        if a <= x <= b:
            return name
    return "variant" if c in "ɑɡǀ" else "latin"


class Reader:
    """Reads texts in their one form; ``bigrams`` maps two letters to a log probability."""

    def __init__(self, bigrams: dict[str, float] | None = None):
        self.bigrams = bigrams or {}
        self.floor = min(self.bigrams.values(), default=0.0) - 1.0
        self.known: dict[str, str] = {}

    def word(self, w: str) -> str:
        if w.isascii():
            return w
        if w in self.known:
            return self.known[w]
        lattice = _tables()[1]
        best: list[tuple[float, str]] = [(0.0, "^")]  # cost, last letter
        back: list[list[tuple[str, int]]] = []  # by position and state: what is read, the state before
        for c in w:
            if unicodedata.combining(c):
                back.append([(c, i) for i in range(len(best))])
                continue
            step, steps = [], []
            for x in lattice.get(c, (c,)):
                kind = script(x)
                cost, at = min(
                    (cost - self.bigrams.get(last + x, self.floor) + (SWITCH if last != "^" and script(last) != kind else 0.0), i)
                    for i, (cost, last) in enumerate(best)
                )
                step.append((cost + (0.0 if kind == "latin" else FOREIGN), x))
                steps.append((x, at))
            best = step
            back.append(steps)
        at = min(range(len(best)), key=lambda i: best[i][0] - self.bigrams.get(best[i][1] + "$", self.floor))
        read = []
        for steps in reversed(back):
            c, at = steps[at]
            read.append(c)
        out = "".join(reversed(read))
        if len(self.known) < 200_000 and len(w) < 100:
            self.known[w] = out
        return out

    def read(self, text: str) -> str:
        if text.isascii():
            return text
        apart = unicodedata.normalize("NFD", text).translate(_tables()[0])
        return unicodedata.normalize("NFC", _WORD.sub(lambda m: self.word(m.group()), apart))


_ACTIVE = re.compile(ACTIVE)


def fold(text: str) -> str:
    """The looks alone, for comparisons within one job: the first Latin letter of each look."""
    if text.isascii() or not _ACTIVE.search(text):
        return text
    plain, _, first = _tables()
    return unicodedata.normalize("NFC", unicodedata.normalize("NFD", text).translate(plain).translate(first))


def bigrams(texts: DataFrame, column: str) -> dict[str, float]:
    """Log probabilities of letter pairs within the words of all texts.

    Words are counted before they are taken apart.  Only pairs of letters of the
    look-alike table and the Latin alphabet are kept, so at most (alphabet + 2)^2
    numbers, about 25,000, reach the driver.
    """
    letters = sorted({chr(c) for c in (*range(65, 91), *range(97, 123))} | {x for v in LOOKS.values() for x in v})
    wanted = "".join(letters)
    words = (
        texts.select(F.explode(F.expr(f"regexp_extract_all({column}, '[A-Za-z]+|[{wanted}]+', 0)")).alias("w"))
        .groupBy("w")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    letters_of = F.split(F.concat(F.lit("^"), "w", F.lit("$")), "")
    pairs = F.zip_with(F.slice(letters_of, F.lit(1), F.length("w") + 1), F.slice(letters_of, F.lit(2), F.length("w") + 1), lambda x, y: F.concat(x, y))
    counted = words.select(F.explode(pairs).alias("p"), "n").groupBy("p").agg(F.sum("n").alias("n")).collect()
    starts: dict[str, int] = {}
    for r in counted:
        starts[r.p[0]] = starts.get(r.p[0], 0) + r.n
    size = len(letters) + 2
    return {r.p: math.log((r.n + 0.5) / (starts[r.p[0]] + 0.5 * size)) for r in counted}


def one_form(text: Column, pairs: dict[str, float]) -> Column:
    """The one form of a text column."""

    @F.pandas_udf("string")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = Reader(pairs)
        for s in batches:
            yield s.map(lambda t: None if t is None else reader.read(t))

    return F.coalesce(read(F.when(text.rlike(ACTIVE), text)), text)


def _fields(elements: DataFrame, fields: dict[str, str]) -> DataFrame:
    each = F.array(*(F.struct(F.lit(name).alias("field"), F.col(path).alias("text")) for name, path in fields.items()))
    return elements.filter("id is not null").select("id", "loaded_at", F.inline(each))


ELEMENT_FIELDS = {"title": "title", "data.rule": "data.rule", "data.definition": "data.definition"}


def forms(elements: DataFrame, fields: dict[str, str] | None = None) -> DataFrame:
    """(id, field, text, form) of the current rows; null texts have no row."""
    fields = fields or ELEMENT_FIELDS
    pairs = bigrams(_fields(elements, fields).filter("text is not null"), "text")
    slots = {n: n.replace(".", "__") for n in fields}
    now = current_rows(elements, [F.col(p).alias(slots[n]) for n, p in fields.items()])
    each = F.array(*(F.struct(F.lit(n).alias("field"), F.col(slots[n]).alias("text")) for n in fields))
    rows = now.select("id", F.inline(each)).filter("text is not null")
    return rows.withColumn("form", one_form(F.col("text"), pairs))


def look_classes(elements: DataFrame, fields: dict[str, str] | None = None) -> DataFrame:
    """(id, field, class_id, n_texts): the look each text belongs to, and how many different texts have it.

    ``class_id`` is the smallest id with that look; texts whose look no other text has are left out.
    """
    rows = forms(elements, fields).withColumns(dict(zip(("f1", "f2"), _hashed(F.col("form")), strict=True)))
    own = durable(rows.select("id", "field", "f1", "f2", F.xxhash64(F.lit(23), "text").alias("t")))
    # Equal texts first, so a look that many have is counted by its different texts.
    texts = own.groupBy("field", "f1", "f2", "t").agg(F.min("id").alias("id"))
    classes = texts.groupBy("field", "f1", "f2").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("n_texts")).filter("n_texts > 1")
    return own.join(classes, ["field", "f1", "f2"]).select("id", "field", "class_id", "n_texts")


def _hashed(c: Column) -> list[Column]:
    # The hash of one column is the seed of the next: the salt stands first, else the second follows from the first.
    return [F.xxhash64(c), F.xxhash64(F.lit(17), c)]


def look_same(elements: DataFrame, fields: dict[str, str] | None = None, hot: int = HOT) -> DataFrame:
    """(id_a, id_b, field): current texts that look the same with other characters.

    Texts stay where they are read: 128-bit hashes of each text and of its form
    travel.  A pair has at least one text that is not its own form, so only such
    texts ask for partners; groups of equal texts are never paired.
    """
    fields = fields or ELEMENT_FIELDS
    pairs = bigrams(_fields(elements, fields).filter("text is not null"), "text")

    forms_ = {n: one_form(F.col(p), pairs) for n, p in fields.items()}
    held = []
    read = elements.filter("id is not null").select("id", "loaded_at", *(F.col(p).alias(f"t{i}") for i, p in enumerate(fields.values())), *(f.alias(f"f{i}") for i, f in enumerate(forms_.values())))
    for i, name in enumerate(fields):
        t, f = F.col(f"t{i}"), F.col(f"f{i}")
        held.append(
            F.when(t.isNotNull(), F.struct(F.lit(name).alias("field"), *(h.alias(k) for h, k in zip(_hashed(f) + _hashed(t), ("f1", "f2", "t1", "t2"), strict=True)))).alias(f"h{i}")
        )
    now = current_rows(read.select("id", "loaded_at", *held), [f"h{i}" for i in range(len(fields))])
    rows = now.select("id", F.inline(F.filter(F.array(*(f"h{i}" for i in range(len(fields)))), lambda x: x.isNotNull())))
    rows = durable(rows)
    key = ["field", "f1", "f2"]
    asks = rows.filter("f1 <> t1 or f2 <> t2")
    # A look that many texts share is met in parts: those who ask are spread, the others are met by each part.
    # There are at most as many such looks as rows by ``hot``.
    counted = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.expr("f1 <> t1 or f2 <> t2")).alias("n_asks"))
    crowded = F.broadcast(counted.filter((F.col("n") > hot) & (F.col("n_asks") > 0)).select(*key, F.least(F.ceil(F.col("n") / hot), F.col("n_asks")).cast("int").alias("parts")))
    parts = F.coalesce("parts", F.lit(1))
    asks = asks.join(crowded, key, "left").withColumn("part", F.pmod(F.xxhash64("id"), parts).cast("int")).drop("parts")
    others = rows.join(crowded, key, "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    met = asks.alias("a").join(others.alias("b"), [*key, "part"]).filter("a.id <> b.id and (a.t1 <> b.t1 or a.t2 <> b.t2)")
    return met.select(F.least("a.id", "b.id").alias("id_a"), F.greatest("a.id", "b.id").alias("id_b"), "field").distinct()
