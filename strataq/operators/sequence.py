"""Operators on the reading order of a document.

Order is a column (``order``), never the place in a file.  Every window is
partitioned by document or page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataq.functions.text import section_key, section_number


def _before(doc: list[str], order: list[str]):
    return Window.partitionBy(*doc).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def _upto(doc: list[str], order: list[str]):
    return Window.partitionBy(*doc).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def fill_section(blocks: DataFrame, doc: list[str], order: list[str], text: str = "text", kind: str = "kind", chapter: str = "chapter", to: str = "in_section") -> DataFrame:
    """The section each block lies in.

    A heading with a leading number opens a section, another block only if its
    number starts with the chapter (as text: chapter 2 takes 26.1); before the first
    the section is the chapter.
    """
    num = section_number(F.col(text))
    opens = F.when((F.col(kind) == "heading") | F.startswith(num, F.col(chapter).cast("string")), num)
    return blocks.withColumn(to, F.coalesce(F.last(opens, True).over(_upto(doc, order)), F.col(chapter).cast("string")))


# The letter of each type in an id.
ID_LETTERS = {"heading": "H", "provision": "P", "definition": "D", "user_note": "N", "exception": "X", "reference": "R", "text_block": "T"}


def assign_ids(blocks: DataFrame, doc: list[str], order: list[str], standard: Column, section: str = "in_section", kind: str = "kind", to: str = "new_id") -> DataFrame:
    """Ids ``{standard}-{section}-{letter}{n}``, n counting within section and letter.

    Letters end in no digit, so two counts never give the same id.
    """
    letter = F.coalesce(F.create_map(*(F.lit(x) for kv in ID_LETTERS.items() for x in kv))[F.col(kind)], F.lit("T"))
    n = F.row_number().over(Window.partitionBy(*doc, section, "_letter").orderBy(*order))
    made = blocks.withColumn("_letter", letter).withColumn("_n", n)
    return made.withColumn(to, F.concat_ws("-", standard, section, F.concat("_letter", F.col("_n").cast("string")))).drop("_letter", "_n")


def merge_fragments(blocks: DataFrame, doc: list[str], order: list[str], text: str = "text", kind: str = "kind", short: int = 30) -> DataFrame:
    """Text blocks shorter than ``short`` are appended to the block before them.

    One without a block before it stays; one after a block without text is dropped.
    Gives doc..., order..., ``kind``, ``merged`` and ``n_parts`` of the kept blocks.
    """
    fragment = (F.col(kind) == "text_block") & (F.length(text) < short)
    w = Window.partitionBy(*doc).orderBy(*order)
    head = ~fragment | (F.row_number().over(w) == 1)
    islands = blocks.withColumn("_head", head).withColumn("_island", F.sum(F.col("_head").cast("int")).over(_upto(doc, order)))
    part = F.struct(*order, F.col(text).alias("_text"), F.col(kind).alias("_kind"))
    grouped = islands.groupBy(*doc, "_island").agg(F.array_sort(F.collect_list(part)).alias("_parts"))
    first = F.col("_parts")[0]
    joined = F.array_join(F.transform("_parts", lambda p: p["_text"]), " ")
    return grouped.select(
        *doc,
        *(first[o].alias(o) for o in order),
        first["_kind"].alias("kind"),
        F.when(first["_text"] != "", joined).otherwise(first["_text"]).alias("merged"),
        F.when(first["_text"] != "", F.size("_parts")).otherwise(1).alias("n_parts"),
    )


def first_only(df: DataFrame, keys: list[Column | str], order: list[str]) -> DataFrame:
    """The first row of each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def dedup_blocks(blocks: DataFrame, doc: list[str], order: list[str], kind: str = "kind", section: str = "section", text: str = "text", compat: bool = False) -> DataFrame:
    """First occurrence of (type, section, first 200 characters).

    Blocks without text (tables, figures) stay; ``compat`` keeps one of them a section.
    """
    key = F.substring(text, 1, 200)
    own = F.when((F.length(text) == 0) & F.lit(not compat), F.concat_ws("\u0001", *(F.col(o).cast("string") for o in order))).otherwise("")
    return first_only(blocks.withColumn("_own", own), [*doc, kind, section, key, "_own"], order).drop("_own")


def drop_near_empty(df: DataFrame, kind: str = "kind", text: str = "text", least: int = 5) -> DataFrame:
    return df.filter(F.col(kind).isin("table", "figure", "heading") | (F.length(text) >= least))


def resorted(df: DataFrame, doc: list[str], page: str, seq: str, appended: str) -> DataFrame:
    """Position by page, then order in the page; rows without one come first in their page."""
    w = Window.partitionBy(*doc).orderBy(page, F.coalesce(F.col(seq), F.lit(0)), appended)
    return df.withColumn("position", F.row_number().over(w))


def inversions(df: DataFrame, doc: list[str], order: list[str], section: str = "section") -> DataFrame:
    """(doc..., n_sections, n_inversions): neighbours whose sections go backwards."""
    numbered = df.filter(F.col(section).rlike(r"^\d+\.\d+")).withColumn("_key", section_key(F.col(section)))
    back = F.lag("_key").over(Window.partitionBy(*doc).orderBy(*order))
    return numbered.withColumn("_back", F.col("_key") < back).groupBy(*doc).agg(F.count(F.lit(1)).alias("n_sections"), F.count_if("_back").alias("n_inversions"))


# How a chapter begins on its first page.
CHAPTER = r"CHAPTER\s+(\d+)\s*\n\s*([A-Z][A-Z :,\-]+)"


def chapter_starts(pages: DataFrame, text: str = "text", head: int = 500) -> DataFrame:
    """The pages that begin a chapter, with its number and title, told from the first characters of each page."""
    top = F.substring(F.col(text), 1, head)
    found = pages.withColumn("chapter", F.regexp_extract(top, CHAPTER, 1).try_cast("int")).withColumn("title", F.trim(F.regexp_replace(F.regexp_extract(top, CHAPTER, 2), r"\s+$", "")))
    return found.filter("chapter is not null")


def chapter_ranges(starts: DataFrame, ends: DataFrame, doc: list[str], page: str = "page", cap: int = 50, last_page: str | None = None) -> DataFrame:
    """Each chapter's pages: up to the next chapter or boundary, ``cap`` pages at most.

    ``starts``: doc..., page, ...; ``ends``: doc..., page of other boundaries;
    ``last_page``: a column of ``starts`` with the last page of the document.
    """
    both = starts.withColumn("_start", F.lit(True)).unionByName(ends.withColumn("_start", F.lit(False)), allowMissingColumns=True)
    w = Window.partitionBy(*doc).orderBy(page).rangeBetween(1, Window.unboundedFollowing)
    nxt = F.min(page).over(w)
    ends_at = [nxt - 1, F.col(page) + cap - 1, *([F.col(last_page)] if last_page else [])]
    end = F.least(*ends_at)  # what is null doesn't bound
    return both.withColumn("end_page", end).filter("_start").drop("_start")


def headings_in_order(blocks: DataFrame, doc: list[str], order: list[str], section: str = "section") -> DataFrame:
    """The first heading of each section, numbered in section order."""
    first = first_only(blocks, [*doc, section], order)
    return first.withColumn("rank", F.row_number().over(Window.partitionBy(*doc).orderBy(section_key(F.col(section)), section)))


def islands(df: DataFrame, part: list[str], order: list[str], breaks: Column, to: str = "island") -> DataFrame:
    """Numbers runs of rows; a run begins at the first row and where ``breaks`` holds."""
    w = Window.partitionBy(*part).orderBy(*order)
    start = F.when(F.row_number().over(w) == 1, 1).otherwise(F.coalesce(breaks, F.lit(False)).cast("int"))
    return df.withColumn("_start", start).withColumn(to, F.sum("_start").over(_upto(part, order))).drop("_start")


def gap_islands(df: DataFrame, part: list[str], order: list[str], low: str, high: str, gap: float, to: str = "island") -> DataFrame:
    """A new run where ``low`` lies more than ``gap`` past the ``high`` before it."""
    w = Window.partitionBy(*part).orderBy(*order)
    held = df.withColumn("_high", F.lag(high).over(w))
    return islands(held, part, order, F.col(low) - F.col("_high") > gap, to).drop("_high")


def spaced_text(chars: DataFrame, part: list[str], order: list[str], text: str = "text", x0: str = "x0", x1: str = "x1", gap: float = 1.5, to: str = "line") -> DataFrame:
    """(part..., ``to``): characters joined, a space where they lie more than ``gap`` apart."""
    w = Window.partitionBy(*part).orderBy(*order)
    glued = F.concat(F.when(F.col(x0) - F.lag(x1).over(w) > gap, F.lit(" ")).otherwise(F.lit("")), F.col(text))
    parts = chars.withColumn("_glued", glued).groupBy(*part).agg(F.array_sort(F.collect_list(F.struct(*order, "_glued"))).alias("_p"))
    return parts.select(*part, F.array_join(F.transform("_p", lambda p: p["_glued"]), "").alias(to))


def anchored_lines(chars: DataFrame, page: list[str], top: str = "top", x0: str = "x0", tolerance: float = 1.5) -> DataFrame:
    """Adds ``line``: a line takes what lies within ``tolerance`` of its first character's top.

    The anchor is the line's first character, so runs can't be told from neighbours
    alone: a fold over each page's distinct tops, which are few, assigns them.
    """
    tops = chars.groupBy(*page).agg(F.array_sort(F.collect_set(top)).alias("_tops"))
    fold = f"""aggregate(_tops, cast(array() as array<struct<t:double,anchor:double>>),
        (acc, t) -> concat(acc, array(named_struct('t', cast(t as double), 'anchor',
            if(size(acc) > 0 and t - element_at(acc, -1).anchor < {tolerance}, element_at(acc, -1).anchor, cast(t as double))))))"""
    anchors = tops.select(*page, F.expr(f"inline({fold})")).withColumn("line", F.dense_rank().over(Window.partitionBy(*page).orderBy("anchor")))
    return chars.withColumn("t", F.col(top).cast("double")).join(anchors.drop("anchor"), [*page, "t"]).drop("t")


def column_gap(chars: DataFrame, page: list[str], x0: str = "x0", width: str = "width", window: int = 10) -> DataFrame:
    """(page..., split_at, two_columns): the emptiest strip in the middle of each page."""
    bins = chars.groupBy(*page, F.floor(x0).cast("int").alias("x")).agg(F.count(F.lit(1)).alias("n"), F.max(width).alias("w"))
    pages = bins.groupBy(*page).agg(F.max("w").alias("w"), F.sum("n").alias("total"))
    every = pages.select(*page, "w", F.explode(F.sequence(F.floor(F.col("w") * 0.35).cast("int"), F.floor(F.col("w") * 0.65).cast("int"))).alias("x"))
    filled = every.join(bins.drop("w"), [*page, "x"], "left").fillna(0, ["n"])
    ahead = Window.partitionBy(*page).orderBy("x").rowsBetween(0, window - 1)
    strips = filled.withColumn("inside", F.sum("n").over(ahead)).withColumn("full", F.count(F.lit(1)).over(ahead) == window).filter("full")
    best = strips.groupBy(*page).agg(F.min_by(F.struct("x", "inside"), F.struct("inside", "x")).alias("s"), F.max("w").alias("w"))
    at = best.select(*page, (F.col("s.x") + window // 2).alias("split_at"), F.col("s.inside").alias("inside"), "w")
    sides = bins.join(at.drop("w"), page).groupBy(*page).agg(
        F.max("split_at").alias("split_at"),
        F.max("inside").alias("inside"),
        F.max("w").alias("w"),
        F.sum(F.when(F.col("x") < F.col("split_at"), F.col("n")).otherwise(0)).alias("left"),
        F.sum(F.when(F.col("x") >= F.col("split_at"), F.col("n")).otherwise(0)).alias("right"),
    )
    left, right = F.col("left") / F.col("split_at"), F.col("right") / (F.col("w") - F.col("split_at"))
    two = (left > 2) & (right > 2) & (F.col("inside") / window < 0.1 * F.greatest(left, right))
    return sides.select(*page, "split_at", two.alias("two_columns"))


def bold_runs(chars: DataFrame, part: list[str], order: list[str], text: str = "text", bold: str = "bold", least: int = 3) -> DataFrame:
    """(part..., run, run_text): runs of bold characters of at least ``least`` characters."""
    w = Window.partitionBy(*part).orderBy(*order)
    held = chars.withColumn("_was", F.lag(bold).over(w))
    runs = islands(held, part, order, F.col(bold) != F.col("_was"), "run").filter(bold)
    joined = runs.groupBy(*part, "run").agg(F.array_sort(F.collect_list(F.struct(*order, text))).alias("_p"))
    out = joined.select(*part, "run", F.array_join(F.transform("_p", lambda p: p[text]), "").alias("run_text"))
    return out.filter(F.length("run_text") >= least)


def split_heading(heading: Column, bold: Column) -> Column:
    """struct<head, body>: a heading cut where its bold part ends; body null if it isn't cut."""
    b = F.trim(bold)
    at = F.instr(F.substring(heading, F.lit(1), F.length(b) + 20), b)
    cut = (F.length(bold) > 3) & (F.length(heading) > F.length(bold) + 10) & (at > 0)
    end = at + F.length(b) - 1
    return F.struct(
        F.when(cut, F.trim(F.substring(heading, F.lit(1), end))).otherwise(heading).alias("head"),
        F.when(cut, F.trim(F.substring(heading, end + 1, F.length(heading)))).alias("body"),
    )


def split_sections(text: Column, least: int = 80, chunk: int = 10) -> Column:
    """array<string>: one text per section heading of a block with two or more.

    A heading is a number and a capital letter.  What precedes the first heading
    stays as a text of its own.
    """
    parts = F.filter(F.split(text, r"(?=\b\d+\.\d+(?:\.\d+)* [A-Z])(?<![\d.])"), lambda p: F.length(F.trim(p)) >= chunk)
    many = (F.length(text) >= least) & (F.regexp_count(text, F.lit(r"(?<![\d.])\b\d+\.\d+(?:\.\d+)* [A-Z]")) >= 2)
    return F.when(many, F.transform(parts, lambda p: F.trim(p))).otherwise(F.array(text))


# Upper-case words before a colon that are no terms.
NO_TERMS = ("EXCEPTION", "EXCEPTIONS", "NOTE", "NOTES", "WHERE", "USER NOTE")


def embedded_definitions(text: Column) -> Column:
    """array<struct<term, body>> of the definitions inside a text."""
    piece = r"([A-Z][A-Z ]{2,}[A-Z]):\s*(.*?)(?=[A-Z][A-Z ]{2,}[A-Z]:|$)"
    found = F.regexp_extract_all(text, F.lit("(?s)" + piece), F.lit(0))
    made = F.transform(found, lambda p: F.struct(F.trim(F.substring_index(p, ":", 1)).alias("term"), F.trim(F.substring(p, F.instr(p, ":") + 1, F.length(p))).alias("body")))
    return F.filter(made, lambda d: ~d["term"].isin(*NO_TERMS) & (F.length(d["body"]) > 10))
