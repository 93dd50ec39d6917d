"""Column functions on text: repairs, numbers, mentions and small formats.

All are null-safe: null in, null out, unless the docstring says otherwise.  Word
and space classes are spelled out, as engines differ on what ``\\w`` and ``\\s``
cover.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ligature characters and what they stand for.
LIGATURES = {"ﬁ": "fi", "ﬂ": "fl", "ﬀ": "ff", "ﬃ": "ffi", "ﬄ": "ffl"}
ENTITIES = {"&lt;": "<", "&gt;": ">", "&amp;": "&"}

# Words that come out with a gap where their ligature was.
LIGATURE_WORDS = (
    "specified", "defined", "classified", "identified", "modified", "certified", "simplified", "qualified", "satisfied", "configuration", "coefficient",
    "significant", "efficient",
)

SPACE = r"[\s\p{Z}]"
NUMBER = r"\d+\.\d+-\d+"
SECTION = r"\d+\.\d+(?:\.\d+)*"

# A lone "fi" joins the word after it; between words it goes where the rest of a broken word follows.
ORPHANS = [(r"(^|[^\p{L}\p{N}_])fi\s+([a-z])", "$1fi$2"), (r"\s+fi\s+(procedures|ned|gure|eld|lter|nish|nal|rst|re|ll|nd|le|x)", "$1")]

# How references to items are written.
MENTIONS = {
    "table": r"Table\s+(\d+\.\d+-\d+)",
    "figure": r"Figure\s+(\d+\.\d+-\d+[A-D]?)",
    "equation": r"Eq(?:uation)?\.\s*\((\d+\.\d+-\d+[a-z]?)\)",
    "section": r"Section\s+(\d+\.\d+(?:\.\d+)*)",
    "chapter": r"Chapter\s+(\d+)",
}

# How other standards are cited.
EXTERNAL = [
    r"\b(ASTM\s+[A-Z]\d+[a-z]?(?:/[A-Z]\d+[a-z]?)?)", r"\b(ANSI[/ ][\w.-]+)", r"\b(CAN/CSA[\w .-]+)", r"\b(ICC\s+\d+)",
    r"\b(ACI\s+\d+[\w.-]*)", r"\b(AISC\s+\d+[\w.-]*)", r"\b(AWS\s+[\w.]+)", r"\b(IBC[\s-]\d+)",
    r"\b(ASCE[\s/]SEI\s+[\d-]+)", r"\b(TMS\s+\d+)", r"\b(APA\s+[\w-]+)", r"\b(FEMA\s+[\w-]+)",
]


def _replaced(c: Column, pairs: dict[str, str]) -> Column:
    for old, new in pairs.items():
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def fix_text(c: Column) -> Column:
    """Ligatures and entities to characters, words joined over line ends, spaces single."""
    c = _replaced(c, LIGATURES | ENTITIES)
    c = F.regexp_replace(c, r"([\p{L}\p{N}_])- ([\p{L}\p{N}_])", "$1$2")
    return F.trim(F.regexp_replace(c, SPACE + "+", " "))


def gaps() -> list[tuple[str, str]]:
    """(pattern, word): how each word looks whose last "fi" became a gap."""
    return [(r"\s+".join(w.rsplit("fi", 1)), w) for w in LIGATURE_WORDS]


def repair_words(c: Column) -> Column:
    """Words whose ligature came out as a gap, put together again."""
    c = _replaced(c, LIGATURES)
    for gap, word in gaps():
        c = F.regexp_replace(c, gap, word)
    for before, after in ORPHANS:
        c = F.regexp_replace(c, before, after)
    return F.regexp_replace(F.regexp_replace(c, r"([\p{L}\p{N}_])- ([\p{L}\p{N}_])", "$1$2"), "  +", " ")


def first_filled(*columns: Column) -> Column:
    """The first that is neither null nor empty; '' if there is none."""
    return F.coalesce(*(F.when(c != "", c) for c in columns), F.lit(""))


def section_number(c: Column) -> Column:
    """The leading section number; null if there is none."""
    return F.nullif(F.regexp_extract(c, f"^{SECTION}", 0), F.lit(""))


def section_key(c: Column) -> Column:
    """A section as numbers, which order as sections do; parts that are no number count 999."""
    return F.transform(F.split(c, r"\."), lambda p: F.coalesce(p.try_cast("int"), F.lit(999)))


def section_prefixes(c: Column) -> Column:
    """The section and the sections around it, nearest first."""
    parts = F.split(c, r"\.")
    return F.transform(F.sequence(F.size(parts), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(parts, 1, n), "."))


def chapter_of_id(c: Column) -> Column:
    """The chapter an element id names; null if it is none."""
    return F.regexp_extract(c, r"^[A-Z0-9]+-\d+-(\d+)", 1).try_cast("int")


def mentions(c: Column, kinds: tuple[str, ...] = ("table", "figure", "equation", "section")) -> Column:
    """All references in a text as array<struct<kind, num>>, each once."""

    def of(kind: str) -> Column:
        return F.transform(F.regexp_extract_all(c, F.lit(MENTIONS[kind]), F.lit(1)), lambda n: F.struct(F.lit(kind).alias("kind"), n.alias("num")))

    each = [of(k) for k in kinds]
    return F.array_distinct(F.concat(*each))


def external_mentions(c: Column) -> Column:
    """Citations of other standards, family by family."""
    return F.concat(*(F.regexp_extract_all(c, F.lit(p), F.lit(1)) for p in EXTERNAL))


def standard_family(c: Column) -> Column:
    """The first two words before the first comma."""
    return F.trim(F.substring_index(F.substring_index(c, ",", 1), " ", 2))


def equations(c: Column, reach: int = 200) -> Column:
    """array<struct<num, chapter, expression>> of the numbered equations of a text.

    The expression goes from the last sentence end or semicolon before the number,
    at most ``reach`` characters back, through the number.
    """
    mark = r"\((\d+)\.\d+-\d+[a-z]?(?:\.SI)?\)"
    pieces = F.split(F.regexp_replace(c, f"({mark})", "\u0001$1\u0002"), "\u0002")

    def one(i: Column) -> Column:
        # What precedes the number is all text up to it, the earlier numbers included.
        before = F.array_join(F.slice(pieces, 1, i), "")
        upto = F.replace(before, F.lit("\u0001"), F.lit(""))
        num = F.substring_index(before, "\u0001", -1)
        head = F.rtrim(F.substring(upto, F.lit(1), F.length(upto) - F.length(num)))
        back = F.greatest(F.length(head) - F.length(F.substring_index(head, ". ", -1)) - 1, F.length(head) - F.length(F.substring_index(head, ";", -1)))
        cut = F.when(F.instr(head, ". ").eqNullSafe(0) & F.instr(head, ";").eqNullSafe(0), F.lit(0)).otherwise(back)
        start = F.greatest(cut, F.length(upto) - F.length(num) - reach, F.lit(0))
        return F.struct(
            F.regexp_extract(num, r"\((.+)\)", 1).alias("num"),
            F.regexp_extract(num, mark, 1).alias("chapter"),
            F.trim(F.substring(upto, start + 1, F.length(upto))).alias("expression"),
        )

    return F.when(F.size(pieces) > 1, F.transform(F.sequence(F.lit(1), F.size(pieces) - 1), one)).otherwise(F.expr("array()"))


def is_prose(c: Column) -> Column:
    """No sign of mathematics and two or more words of running text: a mention, no equation."""
    words = F.regexp_count(F.lower(c), F.lit(r"\b(?:shall|determined|using|accordance|permitted|including|satisfy)\b"))
    return ~c.rlike(r"[=<>≤≥+\-*/^√∑]") & (words >= 2)


def number_cell(c: Column) -> Column:
    """A table cell as a number; null where it is none (engines differ on forms like 1_000)."""
    return F.when(F.trim(c).rlike(r"^[+-]?\d+(?:\.\d*)?$"), F.trim(c).cast("double"))


def cell_value(c: Column) -> Column:
    """struct<number, integer, text>: a cell with a point as a number, another of digits as an integer, all else as text."""
    number = F.when(F.contains(c, F.lit(".")), number_cell(c))
    integer = F.when(F.trim(c).rlike(r"^[+-]?\d+$"), F.trim(c).try_cast("bigint"))
    return F.struct(number.alias("number"), integer.alias("integer"), F.when(number.isNull() & integer.isNull(), c).alias("text"))


def utc_now() -> Column:
    """The time of the query in ISO form, in UTC where the session's zone is."""
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def html_escape(c: Column) -> Column:
    return _replaced(c, {"&": "&amp;", "<": "&lt;", ">": "&gt;", '"': "&quot;"})


def slug(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[ -]", "")


def summarized(c: Column, most: int = 80) -> Column:
    """A text cut for a report."""
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most - 3), F.lit("..."))).otherwise(c)
