"""Deterministic clean-up of element rows.  Each step is pure and idempotent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How operators are written.
OPERATORS = {"≤": "<=", "≥": ">=", "≠": "!=", "equals": "==", "greater than": ">", "less than": "<", "at least": ">=", "at most": "<=", "not equal": "!="}
CAPS_COLON = r"(?s)^([A-Z][A-Z0-9 ]+[A-Z0-9])\s*:\s*(.+)"


def normal_operator(c: Column) -> Column:
    known = F.create_map(*(F.lit(x) for kv in OPERATORS.items() for x in kv))
    return F.coalesce(known[c], known[F.lower(F.trim(c))], c)


def normalize_operators(df: DataFrame) -> DataFrame:
    fixed = F.transform("data.conditions", lambda c: c.withField("operator", normal_operator(c["operator"])))
    return df.withColumn("data", F.col("data").withField("conditions", fixed))


def coerce_nulls(df: DataFrame) -> DataFrame:
    """Null to '' where the schema wants a plain string.

    A typed row can't tell an absent field from a null one; payload fields are
    coerced where the type of the element has them.
    """
    d, kind = F.col("data"), F.col("type")

    def filled(path: str, when: Column) -> Column:
        return F.when(when & F.col(path).isNull(), F.lit("")).otherwise(F.col(path))

    provision = kind.isin("provision", "heading", "text_block", "user_note", "exception")
    definition, figure = kind == "definition", kind == "figure"
    d = (
        d.withField("rule", filled("data.rule", provision))
        .withField("then_text", filled("data.then_text", provision))
        .withField("term", filled("data.term", definition))
        .withField("definition", filled("data.definition", definition))
        .withField("expression", filled("data.expression", kind == "formula"))
        .withField("target", filled("data.target", kind == "reference"))
        .withField("figure_type", filled("data.figure_type", figure))
        .withField("description", filled("data.description", figure))
        .withField("columns", F.transform("data.columns", lambda c: c.withField("name", F.coalesce(c["name"], F.lit("")))))
        .withField("conditions", F.transform("data.conditions", lambda c: c.withField("parameter", F.coalesce(c["parameter"], F.lit("")))))
        .withField("parameters", F.transform_values("data.parameters", lambda _, v: v.withField("unit", F.coalesce(v["unit"], F.lit("")))))
    )
    source = F.col("source").withField("standard", F.coalesce("source.standard", F.lit(""))).withField("section", F.coalesce("source.section", F.lit("")))
    meta = F.col("metadata").withField("extracted_by", F.coalesce("metadata.extracted_by", F.lit(""))).withField("qc_status", F.coalesce("metadata.qc_status", F.lit("")))
    return df.withColumns({"title": F.coalesce("title", F.lit("")), "source": source, "metadata": meta, "data": d})


def drop_null_ranges(df: DataFrame) -> DataFrame:
    """A range with a null end is no range."""

    def cleared(_, v: Column) -> Column:
        return v.withField("range", F.when(~F.exists(v["range"], lambda x: x.isNull()), v["range"]))

    return df.withColumn("data", F.col("data").withField("parameters", F.transform_values("data.parameters", cleared)))


def normal_id(c: Column) -> Column:
    """Without spaces, the part before the first dash in upper case."""
    bare = F.replace(c, F.lit(" "), F.lit(""))
    first = F.substring_index(bare, "-", 1)
    return F.concat(F.upper(first), F.substring(bare, F.length(first) + 1, F.length(bare)))


def normalize_ids(df: DataFrame) -> DataFrame:
    return df.withColumn("id", normal_id(F.col("id")))


def defined(rule: Column) -> Column:
    """struct<term, definition> of a rule that defines something, else null."""
    body = F.trim(rule)

    def cut(words: str) -> Column:
        at = rf"(?is)^(.*?)\b{words}\b(.*)$"
        return F.when(
            rule.rlike(rf"(?i)\b{words}\b"),
            F.struct(F.regexp_replace(F.trim(F.regexp_extract(rule, at, 1)), "[.,;]+$", "").alias("term"), F.trim(F.regexp_extract(rule, at, 2)).alias("definition")),
        )

    caps = F.when(
        body.rlike(CAPS_COLON),
        F.struct(F.trim(F.regexp_extract(body, CAPS_COLON, 1)).alias("term"), F.trim(F.regexp_extract(body, CAPS_COLON, 2)).alias("definition")),
    )
    return F.when(body != "", F.coalesce(caps, cut("is defined as"), cut("means")))


def reclassify_definitions(df: DataFrame) -> DataFrame:
    """Provisions that define a term become definitions; conditions and exceptions stay."""
    found = F.when(F.col("type") == "provision", defined(F.col("data.rule")))
    held = df.withColumn("_d", found)
    kept = {"term": F.col("_d.term"), "definition": F.col("_d.definition"), "conditions": F.col("data.conditions"), "exceptions": F.col("data.exceptions")}
    fields = df.schema["data"].dataType.fields
    data = F.struct(*(kept.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in fields))
    return held.withColumns(
        {"type": F.when(F.col("_d").isNotNull(), "definition").otherwise(F.col("type")), "data": F.when(F.col("_d").isNotNull(), data).otherwise(F.col("data"))}
    ).drop("_d")


STEPS = (normalize_operators, coerce_nulls, drop_null_ranges, normalize_ids, reclassify_definitions)


def post_process(df: DataFrame) -> DataFrame:
    """All steps in order; unknown columns stay."""
    for step in STEPS:
        df = df.transform(step)
    return df


def fill_for_output(df: DataFrame) -> DataFrame:
    """What a written element must have: a description, a citation."""
    cited = F.coalesce("source.citation", F.concat(F.lit("Section "), F.col("source.section")))
    return df.withColumns({"description": F.coalesce("description", F.lit("")), "source": F.col("source").withField("citation", cited)})
