"""Classification of text blocks with patterns learned from their bold labels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The words and patterns that tell types apart; those in the functions below too.
REGULATORY = ("shall ", "shall not", "is permitted", "must be", "are required", "is required", "are permitted", "need not", "is not required")
REGULATORY_SHORT = REGULATORY[:5]
REGULATORY_MEDIUM = REGULATORY[:7]
NOTE_WORDS = ("User Note", "Commentary", "Note:", "USER NOTE", "COMMENTARY")
REFERENCE_FAMILIES = ("ASTM", "ANSI", "CAN/CSA", "ICC", "ACI", "AISC", "AWS", "IBC", "FEMA", "TMS", "APA")
PAGE_MARKS = r"^\d{1,4}$|^Downloaded from|^Page \d+|^- \d+ -$"
FURNITURE = ("page_header", "page_footer")
KINDS = ("skip", "section", "note", "exception", "reference", "definition", "sub_definition", "topic")
DEFINITION = r"(?s)^([A-Z][A-Z0-9 ,./()]+?)\s*:\s*(.+)"


def is_furniture(text: Column) -> Column:
    """Page numbers, download notes and page marks."""
    return text.rlike(PAGE_MARKS)


def definition_parts(text: Column) -> Column:
    """struct<term, body> of a definition written with a colon, else null."""
    return F.when(is_definition(text), F.struct(F.trim(F.regexp_extract(text, DEFINITION, 1)).alias("term"), F.trim(F.regexp_extract(text, DEFINITION, 2)).alias("body")))


def learn_patterns(blocks: DataFrame, doc: list[str], bold: str = "bold", text: str = "text", families: tuple[str, ...] = REFERENCE_FAMILIES, footers: tuple[str, ...] = ()) -> DataFrame:
    """(doc..., kind, marker): what the bold labels of each document tell, first match first.

    Labels shorter than two characters tell nothing.
    """
    b, t = F.col(bold), F.col(text)
    colon = F.instr(F.substring(t, F.lit(1), F.length(b) + 5), ":") > 0
    upper = (b == F.upper(b)) & b.rlike("[A-Za-z]")
    note = F.coalesce(*(F.when(F.startswith(b, F.lit(w)), F.lit(w)) for w in NOTE_WORDS))
    footer = F.lit(False)
    for f in footers:
        footer = footer | F.contains(b, F.lit(f))

    def pattern(kind: str, marker: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), marker.alias("marker"))

    family = F.regexp_extract(b, "^(" + "|".join(families) + ")", 0) != ""
    found = (
        F.when(b.rlike(r"^\d{1,4}$"), pattern("skip", b))
        .when(footer, pattern("skip", F.substring(b, 1, 30)))
        .when(b.rlike(r"^\d+\.\d+"), pattern("section", F.substring(b, 1, 20)))
        .when(F.startswith(b, F.lit("CHAPTER")), pattern("section", F.lit("CHAPTER")))
        .when(note.isNotNull(), pattern("note", note))
        .when(F.startswith(F.upper(b), F.lit("EXCEPTION")), pattern("exception", F.trim(F.substring_index(F.substring_index(b, ":", 1), ".", 1))))
        .when(family, pattern("reference", F.substring_index(F.substring_index(b, ",", 1), " ", 1)))
        .when(upper & colon & (F.length(b) < 80), pattern("definition", F.lit("ALLCAPS_COLON")))
        .when(b.rlike(r"^[A-Z][a-z].*[A-Z]\.?\s*$") & (F.length(b) < 40), pattern("sub_definition", F.substring(b, 1, 20)))
        .when(upper & ~colon & (F.length(b) < 60), pattern("topic", b))
    )
    return blocks.filter(F.length(b) >= 2).select(*doc, found.alias("p")).filter("p is not null").select(*doc, "p.kind", "p.marker").distinct()


def _starts(markers: str, *texts: Column) -> Column:
    def one(m: Column) -> Column:
        out = F.lit(False)
        for t in texts:
            out = out | F.startswith(t, m)
        return out

    return F.exists(F.coalesce(F.col(markers), F.expr("cast(array() as array<string>)")), one)


def has_phrase(text: Column, phrases: tuple[str, ...] = REGULATORY) -> Column:
    low = F.lower(text)
    out = F.lit(False)
    for p in phrases:
        out = out | F.contains(low, F.lit(p))
    return out


def is_definition(text: Column) -> Column:
    """An upper-case term of 3 to 79 characters before a colon and a body."""
    term = F.trim(F.regexp_extract(text, DEFINITION, 1))
    return text.rlike(DEFINITION) & F.length(term).between(3, 79) & (term == F.upper(term)) & term.rlike("[A-Za-z]")


def classify(
    blocks: DataFrame,
    patterns: DataFrame,
    doc: list[str],
    label: str = "label",
    bold: str = "bold",
    text: str = "text",
    refine: Callable[[Column], Column] | None = None,
    skip_by_prefix: bool = False,
) -> DataFrame:
    """Adds ``kind`` and ``note``; blocks of page furniture go.

    The patterns of a document are few; they are joined to its blocks by document,
    not broadcast, as their number grows with the documents.  A learned page number
    skips the blocks that are that number; ``skip_by_prefix`` all that start with it.
    ``refine`` is a hook on the resulting type.
    """
    arrays = patterns.groupBy(*doc).agg(*(F.collect_set(F.when(F.col("kind") == k, F.col("marker"))).alias(f"_{k}") for k in KINDS if k != "section"))
    b, t = F.col(bold), F.col(text)
    joined = blocks.join(arrays, doc, "left")
    none = F.expr("cast(array() as array<string>)")
    by_prefix = _starts("_skip", b, t)
    whole = F.exists(F.coalesce("_skip", none), lambda m: F.when(m.rlike("^[0-9]+$"), (b == m) | (t == m)).otherwise(F.startswith(b, m) | F.startswith(t, m)))
    kind = (
        F.when(F.col(label).isin("section_header", "title"), F.lit("heading"))
        .when(_starts("_note", b, t), "user_note")
        .when(F.exists(F.coalesce("_exception", none), lambda m: F.startswith(F.upper(b), F.upper(m))), "exception")
        .when((F.size(F.coalesce("_definition", none)) > 0) & is_definition(t), "definition")
        .when(F.exists(F.coalesce("_sub_definition", none), lambda m: F.startswith(b, F.substring(m, 1, 10))), "sub_definition")
        .when(b.rlike(r"^\d+\.\d+") | F.startswith(b, F.lit("CHAPTER")), "heading")
        .when(F.array_contains(F.coalesce("_topic", none), b), "topic")
        .when(_starts("_reference", b), "reference")
        .when(has_phrase(t), "provision")
        .otherwise("text_block")
    )
    kept = joined.filter(~F.col(label).isin(*FURNITURE) & (F.length(t) >= 2) & ~(by_prefix if skip_by_prefix else whole))
    out = kept.withColumn("_kind", kind)
    note = F.when(F.col("_kind").isin("sub_definition", "topic"), F.col("_kind"))
    merged = F.when(F.col("_kind") == "sub_definition", "definition").when(F.col("_kind") == "topic", "heading").otherwise(F.col("_kind"))
    return out.withColumn("kind", refine(merged) if refine else merged).withColumn("note", note).drop(*(f"_{k}" for k in KINDS), "_kind")


def classify_fixed(label: Column, bold: Column, text: Column) -> Column:
    """The classifier without learned patterns."""
    return (
        F.when(text.rlike(r"^\d{3}$") | F.startswith(text, F.lit("Downloaded from")), F.lit(None))
        .when(label.isin("section_header", "title"), "heading")
        .when(F.startswith(bold, F.lit("User Note")) | F.startswith(text, F.lit("User Note")), "user_note")
        .when(F.startswith(F.upper(bold), F.lit("EXCEPTION")), "exception")
        .when(is_definition(text), "definition")
        .when(bold.rlike(r"^\d+\.\d+") | F.startswith(bold, F.lit("CHAPTER")), "heading")
        .when(bold.rlike("^(" + "|".join(REFERENCE_FAMILIES) + ")"), "reference")
        .when(has_phrase(text, REGULATORY_SHORT), "provision")
        .otherwise("text_block")
    )


def classify_simple(label: Column, text: Column) -> Column:
    """Headings by their label, definitions, provisions; all else is a text block."""
    return F.when(label.isin("section_header", "title"), F.lit("heading")).when(is_definition(text), "definition").when(has_phrase(text, REGULATORY_SHORT), "provision").otherwise("text_block")


def classify_line(text: Column, bold: Column, size: Column, chapter: Column) -> Column:
    """A printed line by its font: heading, definition or text."""
    caps = (text == F.upper(text)) & text.rlike("[A-Za-z]")
    colon = F.contains(text, F.lit(":"))
    heads = ((size > 11) & bold) | (bold & caps & ~colon & (F.length(text) < 80))
    numbered = F.startswith(text, F.concat(chapter.cast("string"), F.lit("."))) | F.startswith(text, F.lit("CHAPTER"))
    return F.when(heads, F.lit("heading")).when(bold & colon & caps, "definition").when(numbered, "heading").when(bold & colon, "definition").otherwise("text")


def classify_by_font(label: Column, text: Column, bold: Column, size: Column) -> Column:
    """With font size and short equations in place of learned patterns."""
    equation = (F.length(text) < 120) & text.rlike(r"=") & ~has_phrase(text, REGULATORY_SHORT)
    return (
        F.when(label.isin("section_header", "title") | (bold & (size > 11)), F.lit("heading"))
        .when(is_definition(text), "definition")
        .when(equation, "formula")
        .when(has_phrase(text, REGULATORY_SHORT), "provision")
        .otherwise("text_block")
    )


def classify_by_place(text: Column, y0: Column, y1: Column, width: Column, height: Column, bold: Column) -> Column:
    """With the block's place on the page: margins and rotated watermarks give null."""
    margin = ((y0 < 30) | (y1 > 770)) & (F.length(text) < 150)
    rotated = (width < 15) & (height > 100)
    formula = (F.length(text) < 150) & text.rlike("=") & ~F.lower(text).rlike(r"\b(?:shall|must|may)\b")
    return (
        F.when(margin | rotated, F.lit(None))
        .when(bold & text.rlike(r"^\d+\.\d+"), "heading")
        .when(is_definition(text), "definition")
        .when(formula, "formula")
        .when(has_phrase(text, REGULATORY_MEDIUM), "provision")
        .otherwise("text_block")
    )
