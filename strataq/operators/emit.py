"""From classified blocks to element rows: payloads, titles and the rows that tables, figures, references and equations give.

Every operator is a projection, an explode or a join by key.  What a number or a text
is met with first counts; first is by page, then reading order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataq.functions.text import LIGATURES, _replaced, equations, fix_text, is_prose
from strataq.operators.classify import DEFINITION
from strataq.operators.sequence import first_only, split_heading

# How labels of items are written.
LABELS = {"table": r"Table\s+([\d.]+-\d+)", "figure": r"Figure\s+([\d.]+-\d+[A-D]?)"}
TITLE = 200


def titled(text: Column) -> Column:
    """The title of an element without one: the start of its text."""
    return F.substring(text, 1, TITLE)


def section_of(num: Column) -> Column:
    """The section a numbered item belongs to: its number without the last part."""
    return F.regexp_replace(num, r"-\d+[A-Da-d]?$", "")


def payload(kind: Column, note: Column, text: Column) -> Column:
    """struct<rule, term, definition, target>: what an element of this type is made of.

    A definition without a colon is divided after its first sentence if it is a
    sub-definition; else its start stands for the term.
    """
    sub = r"(?s)^(.+?\.)\s*(.*)"
    term = (
        F.when(text.rlike(DEFINITION), F.trim(F.regexp_extract(text, DEFINITION, 1)))
        .when((note == "sub_definition") & text.rlike(sub), F.trim(F.regexp_extract(text, sub, 1)))
        .otherwise(F.substring(text, 1, 50))
    )
    body = F.when(text.rlike(DEFINITION), F.trim(F.regexp_extract(text, DEFINITION, 2))).when((note == "sub_definition") & text.rlike(sub), F.trim(F.regexp_extract(text, sub, 2))).otherwise(text)
    defines, refers = kind == "definition", kind == "reference"
    return F.struct(
        F.when(~defines & ~refers, text).alias("rule"), F.when(defines, term).alias("term"), F.when(defines, body).alias("definition"), F.when(refers, text).alias("target")
    )


def heading_rows(headings: DataFrame, key: str = "id", text: str = "text", bold: str = "bold", least: int = 5) -> DataFrame:
    """(key, part, type, title, rule, parent_id, note): a heading, and its body as a text block below it.

    The body is what follows the bold part of the block; one of up to ``least``
    characters gives no row.
    """
    cut = headings.withColumn("_s", split_heading(F.col(text), F.col(bold)))
    none = F.lit(None).cast("string")

    def row(part: int, kind: str, said: Column, title: Column, parent: Column, note: Column) -> Column:
        return F.struct(F.lit(part).alias("part"), F.lit(kind).alias("type"), title.alias("title"), said.alias("rule"), parent.alias("parent_id"), note.alias("note"))

    head = row(0, "heading", F.col("_s.head"), F.col("_s.head"), none, none)
    body = F.when(F.length("_s.body") > least, row(1, "text_block", F.col("_s.body"), titled(F.col("_s.body")), F.col(key).cast("string"), F.lit("split_from_heading")))
    return cut.select(key, F.explode(F.array(head, body)).alias("r")).filter("r is not null").select(key, "r.*")


def references_new(labels: DataFrame, known: DataFrame, scope: list[str], order: list[str], target: str = "target", most: int = 20) -> DataFrame:
    """The labels whose first ``most`` characters no known reference of the scope has, each once."""
    start = F.substring(fix_text(F.col(target)), 1, most)
    held = known.select(*scope, F.substring(target, 1, most).alias("_start")).distinct()
    return first_only(labels.withColumn("_start", start).join(held, [*scope, "_start"], "left_anti"), [*scope, "_start"], order).drop("_start")


def reference_rows(blocks: DataFrame, known: DataFrame, scope: list[str], order: list[str], families: tuple[str, ...], text: str = "text") -> DataFrame:
    """(scope..., order..., citation, target): references that blocks name and no element holds yet."""
    named = blocks.filter(F.col(text).rlike("^(?:" + "|".join(families) + r")\b")).withColumn("target", fix_text(F.col(text)))
    return references_new(named, known, scope, order).withColumn("citation", F.trim(F.substring_index("target", ",", 1))).select(*scope, *order, "citation", "target")


def labels(blocks: DataFrame, kind: str, scope: list[str], order: list[str], text: str = "text") -> DataFrame:
    """(scope..., num, order..., caption): the first block of each number."""
    found = blocks.withColumn("num", F.nullif(F.regexp_extract(text, LABELS[kind], 1), F.lit(""))).filter("num is not null")
    return first_only(found, [*scope, "num"], order).select(*scope, "num", *order, F.col(text).alias("caption"))


def table_rows(tables: DataFrame, texts: DataFrame, page: list[str], order: list[str], chapter: str = "chapter") -> DataFrame:
    """Adds title, citation and section: those of the first text of the page that names a table."""
    named = texts.filter(F.col("text").rlike(r"Table\s+\d+\.\d+-\d+"))
    first = named.groupBy(*page).agg(F.min_by("text", F.struct(*order)).alias("_caption"))
    num = F.nullif(F.regexp_extract("_caption", r"Table\s+(\d+\.\d+-\d+)", 1), F.lit(""))
    met = tables.join(first, page, "left").withColumn("_num", num)
    title = F.coalesce(fix_text(titled(F.col("_caption"))), F.lit("Table"))
    citation = F.coalesce(F.concat(F.lit("Table "), "_num"), F.lit(""))
    section = F.coalesce(section_of(F.col("_num")), F.col(chapter).cast("string"))
    return met.withColumns({"title": title, "citation": citation, "section": section}).drop("_caption", "_num")


def figure_rows(bold: DataFrame, pictures: DataFrame, texts: DataFrame, scope: list[str], page: str, order: list[str]) -> DataFrame:
    """(scope..., num, section, citation, page, title): figures that bold labels name, then those that texts on pages with a picture name."""
    first = labels(bold, "figure", scope, [page, *order]).withColumn("_rank", F.lit(0))
    beside = texts.join(pictures.select(*scope, page).distinct(), [*scope, page], "left_semi")
    more = labels(beside, "figure", scope, [page, *order]).withColumn("_rank", F.lit(1))
    both = first_only(first.unionByName(more), [*scope, "num"], ["_rank"])
    said = fix_text(F.col("caption"))
    return both.select(*scope, "num", section_of(F.col("num")).alias("section"), F.concat(F.lit("Figure "), "num").alias("citation"), page, titled(said).alias("title"))


def missing_labels(blocks: DataFrame, elements: DataFrame, scope: list[str], order: list[str]) -> DataFrame:
    """(scope..., kind, num, section, order..., caption): labelled tables and figures that no element stands for."""

    def of(kind: str) -> DataFrame:
        number = F.nullif(F.regexp_extract("citation", r"([\d.]+-\d+[A-D]?)" if kind == "figure" else r"([\d.]+-\d+)", 1), F.lit(""))
        held = elements.filter(F.col("type") == kind).select(*scope, number.alias("num")).filter("num is not null").distinct()
        return labels(blocks, kind, scope, order).join(held, [*scope, "num"], "left_anti").withColumn("kind", F.lit(kind))

    found = of("table").unionByName(of("figure"))
    return found.select(*scope, "kind", "num", section_of(F.col("num")).alias("section"), *order, "caption")


def text_equations(rows: DataFrame, scope: list[str], order: list[str], chapter: str = "chapter", text: str = "text") -> DataFrame:
    """(scope..., num, order..., section, expression): the equations of the own chapter that rule and definition texts number, each where it is met first."""
    each = rows.select(*scope, *order, F.col(chapter).cast("string").alias("_ch"), F.posexplode(equations(F.col(text))).alias("_at", "_e")).filter("_e.chapter = _ch")
    first = first_only(each.select(*scope, *order, "_at", F.col("_e.num").alias("num"), F.col("_e.expression").alias("expression")), [*scope, "num"], [*order, "_at"])
    return first.filter(F.length("expression") >= 5).select(*scope, "num", *order, section_of(F.col("num")).alias("section"), "expression")


def page_equations(pages: DataFrame, known: DataFrame, scope: list[str], page: str, chapter: str = "chapter", text: str = "page_text") -> DataFrame:
    """(scope..., num, page, expression): equations of the chapter that page texts number and no element holds.

    Line ends bound an expression too; a mention in prose is none.
    """
    lines = pages.select(*scope, page, F.col(chapter).cast("string").alias("_ch"), F.posexplode(F.split(text, "\n")).alias("_line", "_t"))
    each = lines.select(*scope, page, "_ch", "_line", F.posexplode(equations(F.col("_t"))).alias("_at", "_e"))
    own = each.filter(F.startswith("_e.num", F.concat("_ch", F.lit("."))) & ~F.endswith("_e.num", F.lit(".SI")))
    new = own.withColumn("num", F.col("_e.num")).join(known.select(*scope, "num").distinct(), [*scope, "num"], "left_anti")
    first = first_only(new, [*scope, "num"], [page, "_line", "_at"])
    said = F.regexp_replace(_replaced(F.col("_e.expression"), LIGATURES), r"\s+", " ")
    return first.select(*scope, "num", page, said.alias("expression")).filter((F.length("expression") >= 5) & ~is_prose(F.col("expression")))


def united(*sources: DataFrame) -> DataFrame:
    """The rows of all sources; columns that one lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)


def kept_chapters(chapters: DataFrame, only: list[int] | None = None, title: str = "title", number: str = "chapter", skip_reserved: bool = True) -> DataFrame:
    """The chapters to work on: those listed, without reserved ones."""
    held = chapters if only is None else chapters.filter(F.col(number).isin(*only))
    return held.filter(~F.contains(F.coalesce(title, F.lit("")), F.lit("RESERVED"))) if skip_reserved else held


def preview(tables: DataFrame, columns: int = 7, rows: int = 4) -> DataFrame:
    """(id, columns, rows): the corner of each table, cell texts by row."""
    names = F.slice(F.transform("data.columns", lambda c: F.coalesce(c["name"], F.lit(""))), 1, columns)
    cells = F.transform(F.slice("data.rows", 1, rows), lambda r: F.transform(names, lambda n: F.coalesce(F.try_element_at(r, n), F.lit(""))))
    return tables.select("id", names.alias("columns"), cells.alias("rows"))


def page_stats(pages: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, n_chars, n_words, n_lines): what a parser found on each page."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.trim(x) != "")
    words = F.filter(F.split(t, r"[ \n\t\r]+"), lambda x: x != "")
    return pages.select(key, F.length(t).cast("bigint").alias("n_chars"), F.size(words).cast("bigint").alias("n_words"), F.size(lines).cast("bigint").alias("n_lines"))


def richest_pages(regions: DataFrame, page: list[str], kind: str = "kind", most: int = 3) -> DataFrame:
    """(page..., score): the pages with the most types and regions; the last page where scores tie."""
    score = F.count_distinct(kind) * 10 + F.count(F.lit(1))
    return regions.groupBy(*page).agg(score.alias("score")).orderBy(F.desc("score"), *(F.desc(F.col(p).cast("string")) for p in page)).limit(most)


def page_offset(elements: DataFrame, images: DataFrame, page: str = "page", index: str = "index") -> DataFrame:
    """One row: how far page numbers lie from image numbers; 0 where one side is empty."""
    both = elements.select(F.col(page).alias("p"), F.lit(None).cast("int").alias("i")).unionByName(images.select(F.lit(None).cast("int").alias("p"), F.col(index).cast("int").alias("i")))
    return both.agg(F.coalesce(F.min("p") - F.min("i"), F.lit(0)).alias("offset"))


def labelled_pages(labelled: DataFrame, images: DataFrame, page: list[str]) -> DataFrame:
    """Labelled pages, not predicted ones, whose image is there."""
    return labelled.filter(~F.coalesce("predicted", F.lit(False))).join(images.select(*page).distinct(), page, "left_semi")
