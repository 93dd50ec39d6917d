"""Quality of extracted elements: validity, coverage, fidelity, structure, gate, checkpoints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataq.functions.text import chapter_of_id, first_filled
from strataq.operators.sequence import inversions

# What the schema allows.
TYPES = ("table", "provision", "formula", "figure", "reference", "definition", "heading", "text_block", "user_note", "exception")
CONDITION_OPERATORS = ("==", "!=", ">", ">=", "<", "<=", "in", "not_in")
EXTRACTED_BY, QC_STATUS = ("auto", "manual"), ("pending", "passed", "failed")
ID_PATTERN = r"^[A-Z0-9]+-[0-9]+-[0-9.]+-[A-Za-z0-9.-]+$"
PAYLOAD = {
    "provision": ("rule",), "heading": ("rule",), "text_block": ("rule",), "user_note": ("rule",), "exception": ("rule",), "formula": ("expression",),
    "table": ("columns", "rows"), "figure": ("description",), "definition": ("term", "definition"), "reference": ("target",),
}


def rules() -> dict[str, Column]:
    """The named constraints of one element row; true where it keeps them."""
    d = F.col("data")
    rule = d["rule"].isNotNull() & d["conditions"].isNotNull()
    shapes = rule | (d["term"].isNotNull() & d["definition"].isNotNull()) | (d["columns"].isNotNull() & d["rows"].isNotNull())
    shapes = shapes | (d["expression"].isNotNull() & d["parameters"].isNotNull()) | d["target"].isNotNull() | (d["figure_type"].isNotNull() & d["description"].isNotNull())
    known = F.forall(F.coalesce(d["conditions"], F.expr("array()").cast(_CONDITIONS)), lambda c: c["operator"].isin(*CONDITION_OPERATORS) & c["parameter"].isNotNull())
    return {
        "id": F.coalesce(F.col("id").rlike(ID_PATTERN), F.lit(False)),
        "type": F.coalesce(F.col("type").isin(*TYPES), F.lit(False)),
        "source": F.col("source.standard").isNotNull() & F.col("source.chapter").isNotNull() & F.col("source.section").isNotNull(),
        "title": F.col("title").isNotNull(),
        "data": F.coalesce(shapes, F.lit(False)),
        "conditions": F.coalesce(known, F.lit(False)),
        "metadata": F.coalesce(F.col("metadata.extracted_by").isin(*EXTRACTED_BY) & F.col("metadata.qc_status").isin(*QC_STATUS), F.lit(False)),
    }


_CONDITIONS = "array<struct<parameter:string,operator:string,value_num:double,value_str:string,unit:string>>"


def validate(elements: DataFrame) -> DataFrame:
    """Adds ``errors``: the constraints each row breaks."""
    broken = F.array(*(F.when(~ok, F.lit(name)) for name, ok in rules().items()))
    return elements.withColumn("errors", F.filter(broken, lambda x: x.isNotNull()))


def light(elements: DataFrame) -> DataFrame:
    """Adds ``ok``: whether the fields that every element must have are there; payloads aren't looked at."""
    kept = rules()
    filled = F.col("data").isNotNull() & F.col("metadata.extracted_by").isNotNull() & F.col("metadata.qc_status").isNotNull()
    return elements.withColumn("ok", kept["id"] & kept["type"] & kept["source"] & kept["title"] & filled)


def validity(validated: DataFrame, by: list[str]) -> DataFrame:
    return validated.groupBy(*by).agg(F.count(F.lit(1)).alias("total"), F.count_if(F.size("errors") == 0).alias("passed"), F.count_if(F.size("errors") > 0).alias("failed"))


def has_payload() -> Column:
    """Whether the fields a type is made of are filled."""

    def filled(name: str) -> Column:
        c = F.col(f"data.{name}")
        return c.isNotNull() & (F.size(c) > 0) if name in ("columns", "rows") else c.isNotNull() & (F.trim(c) != "")

    out = F.when(F.lit(False), F.lit(True))
    for kind, names in PAYLOAD.items():
        test = filled(names[0])
        for n in names[1:]:
            test = test & filled(n)
        out = out.when(F.col("type") == kind, test)
    return out.otherwise(F.col("data").isNotNull())


def coverage(truth: DataFrame, found: DataFrame, by: list[str]) -> DataFrame:
    """(by..., kind, n_truth, n_found, n_both, missing, extra, score) over (by..., kind, num)."""
    keys = [*by, "kind", "num"]
    t = truth.select(*keys).distinct().withColumn("_t", F.lit(True))
    e = found.select(*keys).distinct().withColumn("_e", F.lit(True))
    met = t.join(e, keys, "full").withColumns({"_t": F.coalesce("_t", F.lit(False)), "_e": F.coalesce("_e", F.lit(False))})
    n, both = F.count_if("_t"), F.count_if(F.col("_t") & F.col("_e"))
    return met.groupBy(*by, "kind").agg(
        n.alias("n_truth"),
        F.count_if("_e").alias("n_found"),
        both.alias("n_both"),
        F.count_if(F.col("_t") & ~F.col("_e")).alias("n_missing"),
        F.count_if(F.col("_e") & ~F.col("_t")).alias("n_extra"),
        F.round(both / F.greatest(n, F.lit(1)), 4).alias("score"),
    )


def coverage_lists(truth: DataFrame, found: DataFrame, by: list[str]) -> DataFrame:
    """(by..., kind, missing, extra): the numbers on one side only, in order; lists as long as a document has numbers."""
    keys = [*by, "kind", "num"]
    t = truth.select(*keys).distinct().withColumn("_t", F.lit(True))
    e = found.select(*keys).distinct().withColumn("_e", F.lit(True))
    met = t.join(e, keys, "full").filter("_t is null or _e is null")
    only = lambda c: F.array_sort(F.collect_list(F.when(F.col(c), F.col("num"))))
    return met.groupBy(*by, "kind").agg(only("_t").alias("missing"), only("_e").alias("extra"))


def overall(coverage_: DataFrame, by: list[str]) -> DataFrame:
    """(by..., score): what of all numbers in the texts was found."""
    return coverage_.groupBy(*by).agg(F.round(F.sum("n_both") / F.greatest(F.sum("n_truth"), F.lit(1)), 4).alias("score"))


def fidelity(elements: DataFrame, pages: DataFrame, by: list[str], snippet: int = 60, least: int = 20) -> DataFrame:
    """(id, match): exact, spacing or none: whether a text's start stands on its page.

    ``elements``: id, by..., text; ``pages``: by..., page_text.
    """
    norm = F.trim(F.regexp_replace("text", r"\s+", " "))
    some = elements.filter(F.length("text") >= least).withColumn("_s", F.substring(norm, 1, snippet))
    met = some.join(pages.select(*by, F.regexp_replace("page_text", r"\s+", " ").alias("_p")), by, "left")
    bare = lambda c: F.replace(c, F.lit(" "), F.lit(""))
    match = F.when(F.contains("_p", F.col("_s")), "exact").when(F.contains(bare(F.col("_p")), bare(F.col("_s"))), "spacing").otherwise("none")
    return met.select("id", *by, match.alias("match"))


def structure(elements: DataFrame, doc: list[str], order: list[str], text: str = "text") -> DataFrame:
    """(doc..., n, n_duplicate_ids, n_inversions, n_empty, score)."""
    ids = elements.groupBy(*doc, "id").agg(F.count(F.lit(1)).alias("n"))
    dupes = ids.groupBy(*doc).agg(F.count_if(F.col("n") > 1).alias("n_duplicate_ids"))
    empty = (F.coalesce(F.col("section"), F.lit("")) == "").cast("int") + ((F.col("type") != "table") & (F.length(text) < 5)).cast("int")
    base = elements.groupBy(*doc).agg(F.count(F.lit(1)).alias("n"), F.sum(empty).alias("n_empty"))
    inv = inversions(elements, doc, order)
    met = base.join(dupes, doc).join(inv, doc, "left").fillna(0, ["n_sections", "n_inversions"])
    order_score = 1 - F.col("n_inversions") / F.greatest("n_sections", F.lit(1))
    full_score = 1 - F.col("n_empty") / F.col("n")
    dupe_score = F.when(F.col("n_duplicate_ids") > 0, 0.5).otherwise(1.0)
    return met.select(*doc, "n", "n_duplicate_ids", "n_inversions", "n_empty", F.round((order_score + full_score + dupe_score) / 3, 4).alias("score"))


def composite(coverage_: Column, fidelity_: Column, structure_: Column) -> Column:
    return F.round(0.4 * coverage_ + 0.4 * fidelity_ + 0.2 * structure_, 3)


#: The least scores of a release.
LEAST = {"composite": 0.95, "coverage": 0.85, "fidelity": 0.95}


def gate(elements: DataFrame, by: list[str], n_broken: DataFrame, n_symbols: DataFrame, scores: DataFrame) -> DataFrame:
    """(by..., check, passed): the release thresholds.

    ``n_broken``: by..., n_broken; ``n_symbols``: by..., n_symbols; ``scores``: by...,
    composite, coverage, fidelity, of which a missing one fails.
    """
    kind = F.col("type")
    some = lambda c: F.coalesce(F.size(c), F.lit(0)) > 0
    share = lambda c, of: F.count_if((kind == of) & c) / F.greatest(F.count_if(kind == of), F.lit(1))
    one = validate(elements).groupBy(*by).agg(
        (F.count_if(F.size("errors") > 0) == 0).alias("schema"),
        (F.count_if((kind == "text_block") & F.contains(F.lower("data.rule"), F.lit("shall "))) == 0).alias("no_shall_in_text_blocks"),
        ((F.count_if(kind == "formula") == 0) | (share(F.col("data.expression") != "", "formula") >= 0.5)).alias("equations"),
        ((F.count_if(kind == "formula") == 0) | (share(some(F.col("data.parameters")), "formula") >= 0.3)).alias("parameters"),
        ((F.count_if(kind == "provision") == 0) | (share(some(F.col("data.conditions")), "provision") >= 0.15)).alias("conditions"),
        (F.count_if(some(F.col("cross_references"))) > 0).alias("cross_references"),
        (F.count_if(kind == "reference") > 0).alias("references"),
        (F.count_distinct(F.when(kind.isin("heading", "provision", "text_block"), kind)) == 3).alias("core_types"),
    )
    checks = [c for c in one.columns if c not in by]
    met = one.join(n_broken, by, "left").join(n_symbols, by, "left")
    met = met.withColumn("broken_references", F.coalesce("n_broken", F.lit(0)) == 0).withColumn("symbols", F.coalesce("n_symbols", F.lit(0)) > 10)
    met = met.join(scores.select(*by, *LEAST), by, "left").withColumns({c: F.coalesce(F.col(c) >= x, F.lit(False)) for c, x in LEAST.items()})
    each = F.array(*(F.struct(F.lit(c).alias("check"), F.col(c).alias("passed")) for c in [*checks, "broken_references", "symbols", *LEAST]))
    return met.select(*by, F.inline(each))


def released(checks: DataFrame, by: list[str]) -> DataFrame:
    """(by..., check 'all', passed): whether every check passed."""
    return checks.groupBy(*by).agg(F.lit("all").alias("check"), F.bool_and("passed").alias("passed")).select(*by, "check", "passed")


def row_class(passed: Column, fidelity_: Column, unclassified: Column) -> Column:
    """How a report marks a row: pass, partial or fail."""
    return F.when(passed, "pass").when((fidelity_ >= 0.7) & (unclassified < 0.5), "partial").otherwise("fail")


def bar(share: Column, high: float = 0.8, middle: float = 0.5) -> Column:
    """How a report marks a share: good, fair or poor."""
    return F.when(share >= high, "good").when(share >= middle, "fair").otherwise("poor")


def checkpoint(elements: DataFrame, by: list[str], chapter: str) -> DataFrame:
    """Per chapter: counts, payload and validity shares, unclassified share, links in and out."""
    refs = F.filter("cross_references", lambda r: r.isNotNull())
    out = F.filter(refs, lambda r: F.coalesce(chapter_of_id(r) != F.col(chapter), F.lit(False)))
    held = validate(elements).withColumns({"_refs": F.coalesce(F.size(refs), F.lit(0)), "_out": F.coalesce(F.size(out), F.lit(0)), "_full": has_payload()})
    n = F.count(F.lit(1))
    return held.groupBy(*by).agg(
        n.alias("n_elements"),
        F.count_if("_full").alias("n_full"),
        F.count_if(F.size("errors") == 0).alias("n_valid"),
        F.count_if(F.col("type") == "text_block").alias("n_unclassified"),
        F.sum("_refs").cast("bigint").alias("n_refs"),
        F.sum("_out").cast("bigint").alias("n_refs_out"),
    )


def checkpoint_rollup(chapters: DataFrame, by: list[str]) -> DataFrame:
    """Sums and element-weighted shares at every level of ``by``, and over all."""
    n = F.sum("n_elements")
    return chapters.rollup(*by).agg(
        F.grouping_id().cast("int").alias("level"),
        n.alias("n_elements"),
        F.round(F.sum("n_full") / n, 4).alias("full"),
        F.round(F.sum("n_valid") / n, 4).alias("valid"),
        F.round(F.sum("n_unclassified") / n, 4).alias("unclassified"),
        F.sum("n_refs").alias("n_refs"),
        F.sum("n_refs_out").alias("n_refs_out"),
    )


def element_text() -> Column:
    """The text of an element for length checks."""
    return first_filled(*(F.col(f"data.{c}") for c in ("rule", "definition", "expression", "description")))
