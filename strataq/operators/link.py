"""Links between elements: mentions to targets, texts to parents, rows to headings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataq.functions.text import section_prefixes
from strataq.session import durable


def citation_index(elements: DataFrame, scope: list[str], order: list[str], compat: bool = False, first: bool = False) -> DataFrame:
    """(scope..., kind, num, target): what each citation number names.

    The last element with a number wins, or the first.  ``compat`` puts tables, figures and
    equations in one namespace.  ``elements``: scope..., order..., id, type, citation.
    """
    num = F.nullif(F.regexp_extract("citation", r"(\d+\.\d+-\d+[A-Da-d]?)", 1), F.lit(""))
    kind = F.lit("any") if compat else F.when(F.col("type") == "formula", F.lit("equation")).otherwise(F.col("type"))
    numbered = elements.filter(F.col("type").isin("table", "figure", "formula")).withColumn("num", num).filter("num is not null")
    return numbered.groupBy(*scope, kind.alias("kind"), "num").agg((F.min_by if first else F.max_by)("id", F.struct(*order)).alias("target"))


def section_index(elements: DataFrame, scope: list[str], order: list[str]) -> DataFrame:
    """(scope..., kind 'section', num, target): the first element of each section."""
    some = elements.filter("section is not null")
    return some.groupBy(*scope, F.lit("section").alias("kind"), F.col("section").alias("num")).agg(F.min_by("id", F.struct(*order)).alias("target"))


def resolve_mentions(mentions: DataFrame, local: DataFrame, wide: DataFrame, near: list[str], far: list[str]) -> DataFrame:
    """Adds ``target``: from the index of the own chapter, else of the whole standard.

    A mention of the element itself is no link.  Both indexes are joined by key.
    """
    own = local.select(*near, "kind", "num", F.col("target").alias("_near"))
    all_ = wide.select(*far, "kind", "num", F.col("target").alias("_far"))
    met = mentions.join(own, [*near, "kind", "num"], "left").join(all_, [*far, "kind", "num"], "left")
    target = F.coalesce("_near", "_far")
    return met.withColumn("target", F.when(target != F.col("id"), target)).drop("_near", "_far")


def cross_references(resolved: DataFrame) -> DataFrame:
    """(id, targets): sorted distinct link targets of each element."""
    return resolved.filter("target is not null").groupBy("id").agg(F.array_sort(F.collect_set("target")).alias("targets"))


def reference_status(resolved: DataFrame, known_chapters: DataFrame, far: list[str], chapter: Column) -> DataFrame:
    """Adds ``to_chapter`` and ``status``: resolved, broken (chapter is there), pending (it isn't)."""
    there = known_chapters.select(*far, F.col("chapter").alias("to_chapter"), F.lit(True).alias("_there")).distinct()
    met = resolved.withColumn("to_chapter", chapter).join(there, [*far, "to_chapter"], "left")
    status = F.when(F.col("target").isNotNull(), "resolved").when(F.col("_there"), "broken").otherwise("pending")
    return met.withColumn("status", status).drop("_there")


def ancestor_heading(rows: DataFrame, headings: DataFrame, doc: list[str], order: list[str], section: str = "section") -> DataFrame:
    """Adds ``heading_id``: the heading of the own section, else of the nearest one around it.

    The last heading of a section counts.  A section has a handful of prefixes, so
    this is an equi-join of prefixes, not a scan of headings.
    """
    index = headings.groupBy(*doc, F.col(section).alias("_prefix")).agg(F.max_by("id", F.struct(*order)).alias("_heading"))
    sections = rows.select(*doc, section).distinct()
    each = sections.select(*doc, section, F.posexplode(section_prefixes(F.col(section))).alias("_far", "_prefix"))
    found = each.join(index, [*doc, "_prefix"]).groupBy(*doc, section).agg(F.min_by("_heading", "_far").alias("heading_id"))
    return rows.join(found, [*doc, section], "left")


def look_back(doc: list[str], order: list[str], candidate: Column, value: Column, reach: int | None = None) -> Column:
    """``value`` of the nearest row before that is a ``candidate``, within ``reach`` rows."""
    first = Window.unboundedPreceding if reach is None else -reach
    w = Window.partitionBy(*doc).orderBy(*order).rowsBetween(first, -1)
    return F.last(F.when(candidate, value), True).over(w)


def look_back_until(doc: list[str], order: list[str], candidate: Column, barrier: Column, value: Column, reach: int) -> Column:
    """As ``look_back``, but nothing beyond a ``barrier`` row is seen."""
    w = Window.partitionBy(*doc).orderBy(*order).rowsBetween(-reach, -1)
    met = F.last(F.when(candidate | barrier, F.struct(barrier.alias("stop"), value.alias("v"))), True).over(w)
    return F.when(~met["stop"], met["v"])


WHERE_REACH, LIST_REACH = 9, 14


def numbers_inside(citation: Column) -> Column:
    """All texts of the form ``n.n-n`` that a citation contains, parts of longer numbers among them."""
    whole = F.regexp_extract_all(citation, F.lit(r"\d+\.\d+-\d+"), F.lit(0))

    def parts(m: Column) -> Column:
        head, tail = F.substring_index(m, ".", 1), F.substring_index(m, "-", -1)
        middle = F.substring(m, F.length(head) + 1, F.length(m) - F.length(head) - F.length(tail))
        ends = F.transform(F.sequence(F.lit(1), F.length(tail)), lambda n: F.concat(middle, F.substring(tail, F.lit(1), n)))
        return F.flatten(F.transform(F.sequence(F.lit(1), F.length(head)), lambda n: F.transform(ends, lambda e: F.concat(F.substring(head, n, F.length(head)), e))))

    return F.array_distinct(F.flatten(F.transform(whole, parts)))


def associate(blocks: DataFrame, doc: list[str], order: list[str], kind: str = "kind", text: str = "text", section: str = "section", citation: str = "citation") -> DataFrame:
    """(id, parent, rule) of the text blocks: the element each belongs to, and why.

    In this order: "where ..." to a formula, or a provision or text block with a
    relation, up to 9 rows back and no further than a heading; "Figure n ..." to the
    first figure whose citation contains n; a list item to a provision or heading up
    to 14 rows back; the heading of the own or an outer section; the nearest heading.
    """
    # Read for the rows, the figures and the headings: worked out once.
    blocks = durable(blocks.select(*dict.fromkeys([*doc, *order, "id", kind, text, section, citation])))
    k, t = F.col(kind), F.col(text)
    relation = t.rlike("[=<>≤≥]")
    seen = blocks.withColumn("_where", look_back_until(doc, order, (k == "formula") | (k.isin("provision", "text_block") & relation), k == "heading", F.col("id"), WHERE_REACH))
    seen = seen.withColumn("_list", look_back(doc, order, k.isin("provision", "heading"), F.col("id"), LIST_REACH))
    seen = seen.withColumn("_last", look_back(doc, order, k == "heading", F.col("id")))
    texts = seen.filter(k == "text_block").withColumn("_fig", F.nullif(F.regexp_extract(t, r"^Figure\s+(\d+\.\d+-\d+)", 1), F.lit("")))
    # A citation contains a number if it is one of the numbers inside it, so figures are joined by key.
    figures = blocks.filter(k == "figure").select(*doc, F.explode(numbers_inside(F.col(citation))).alias("_fig"), F.struct(*order, F.col("id").alias("_id")).alias("_f"))
    named = figures.groupBy(*doc, "_fig").agg(F.min("_f")["_id"].alias("_figure"))
    joined = ancestor_heading(texts.join(named, [*doc, "_fig"], "left"), blocks.filter(k == "heading"), doc, order, section)
    choices = [
        ("where", F.lower(F.substring(t, 1, 5)) == "where", "_where"),
        ("figure", F.col("_fig").isNotNull(), "_figure"),
        ("list", t.rlike(r"^\(?(?:\d{1,2}|[a-z])[.)]\s"), "_list"),
        ("section", F.lit(True), "heading_id"),
        ("nearest", F.lit(True), "_last"),
    ]
    best = F.coalesce(*(F.when(test & F.col(c).isNotNull(), F.struct(F.col(c).alias("parent"), F.lit(name).alias("rule"))) for name, test, c in choices))
    return joined.select("id", best["parent"].alias("parent"), best["rule"].alias("rule"))


def children(elements: DataFrame, most: int | None = None, order: list[str] | None = None) -> DataFrame:
    """(parent_id, id, place): rows of each parent in order, the first ``most`` of them."""
    w = Window.partitionBy("parent_id").orderBy(*(order or ["id"]))
    placed = elements.filter("parent_id is not null").withColumn("place", F.row_number().over(w))
    return (placed if most is None else placed.filter(F.col("place") <= most)).select("parent_id", "id", "place")
