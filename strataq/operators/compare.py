"""Comparison of two runs, scoring against gold rows, and merging of reviewed decisions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataq.operators.copydiff import RTOL, Field, as_set, same_list, same_map, same_struct, same_text, same_value
from strataq.session import durable

Equal = Callable[[Column, Column], Column]

# Which fields of which types bear the exact wording; all others are helpers.
AUTHORITATIVE = {
    "formula": ("data.expression", "data.parameters"),
    "provision": ("data.rule",),
    "definition": ("data.term", "data.definition"),
    "reference": ("data.target",),
    "table": ("data.columns", "data.rows"),
}
ALWAYS = ("type", "source.standard", "source.chapter", "source.section", "source.citation")
RANK = {"authoritative": 0, "helper": 1, "descriptive": 2}


def exact_text(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def near(a: Column, b: Column) -> Column:
    """Numbers within the tolerance of the larger one; beside a nought of the first run, within the tolerance itself."""
    held = F.when(a == 0, F.abs(b) <= RTOL).otherwise(F.abs(a - b) <= RTOL * F.greatest(F.abs(a), F.abs(b)))
    return (a.isNull() & b.isNull()) | F.coalesce(held, F.lit(False))


def near_gold(gold: Column, found: Column) -> Column:
    """Numbers within the tolerance of the gold one; beside a gold nought, within the tolerance itself."""
    held = F.when(gold == 0, F.abs(found) <= RTOL).otherwise(F.abs(found - gold) <= RTOL * F.abs(gold))
    return (gold.isNull() & found.isNull()) | F.coalesce(held, F.lit(False))


def _whole(entries: Equal) -> Equal:
    """Null equals null only."""
    return lambda a, b: (a.isNull() & b.isNull()) | F.coalesce(a.isNotNull() & b.isNotNull() & entries(a, b), F.lit(False))


TEXTS = ("rule", "then_text", "else_text", "term", "definition", "expression", "target", "url", "figure_type", "description")


def payload(text: Equal, number: Equal) -> list[Field]:
    """The whole payload of an element, its texts and numbers compared so."""
    condition = same_struct(parameter=text, operator=text, value_num=number, value_str=text, unit=text)
    parameter = same_struct(unit=text, range=same_list(number), source=text)
    return [
        *(Field(f"data.{c}", text) for c in TEXTS),
        Field("data.conditions", same_list(condition)),
        Field("data.exceptions", same_list(text)),
        Field("data.columns", same_list(same_struct(name=text, unit=text))),
        Field("data.rows", same_list(same_map(text))),
        Field("data.parameters", _whole(same_map(parameter))),
        Field("data.reference_parameters", same_list(text)),
        Field("data.source_pdf_page", number),
    ]


RUN_FIELDS = [
    Field("type", same_value),
    *(Field(f"source.{c}", same_text) for c in ("standard", "section", "citation")),
    *(Field(f"source.{c}", same_value) for c in ("chapter", "page")),
    Field("title", exact_text),
    Field("description", exact_text),
    *payload(same_text, near),
    Field("cross_references", lambda x, y: as_set(x).eqNullSafe(as_set(y))),
]
#: Against gold rows texts count exactly.
GOLD_FIELDS = payload(exact_text, near_gold)


def severity(kind: Column, path: str) -> Column:
    """How much a difference in a field of an element of this type matters."""
    if path in ALWAYS:
        return F.lit("authoritative")
    if path == "description":
        return F.lit("descriptive")
    exact = [t for t, fields in AUTHORITATIVE.items() if path in fields or (t == "table" and path.startswith("data."))]
    out = F.when(kind.isin(*exact), "authoritative") if exact else F.when(F.lit(False), "")
    if path == "data.description":
        out = out.when(kind == "figure", "descriptive")
    return out.otherwise("helper")


def _held(df: DataFrame, fields: list[Field]) -> DataFrame:
    key = F.struct(
        F.col("type"),
        F.col("source.chapter").alias("chapter"),
        *(F.trim(F.regexp_replace(F.col(f"source.{c}"), r"\s+", " ")).alias(c) for c in ("standard", "section", "citation")),
    )
    whole = key["chapter"].isNotNull() & (key["type"] != "") & (key["standard"] != "") & (key["section"] != "") & (key["citation"] != "")
    return df.select("id", F.when(whole, key).alias("cite"), F.struct(*(f.column().alias(f.slot) for f in fields)).alias("v"))


def match_runs(a: DataFrame, b: DataFrame, fields: list[Field] = RUN_FIELDS) -> DataFrame:
    """(id_a, id_b, basis, a, b): pairs by id, then by citation, then what is left.

    A citation pairs leftovers only where it is unique on both sides.  Both inputs
    have one row an id; each is read once, and the rows side by side are written.
    """
    left, right = _held(a, fields), _held(b, fields)
    full = durable(left.select(F.col("id"), F.col("cite").alias("ca"), F.col("v").alias("a")).join(right.select(F.col("id"), F.col("cite").alias("cb"), F.col("v").alias("b")), "id", "full"))
    by_id = full.filter("a is not null and b is not null").select(F.col("id").alias("id_a"), F.col("id").alias("id_b"), F.lit("id").alias("basis"), "a", "b")
    rest = full.filter("a is null or b is null").select("id", F.coalesce("ca", "cb").alias("cite"), F.col("a").isNotNull().alias("left"), "a", "b")
    # One pass over the leftovers: a citation with one row on each side makes a pair.
    n = rest.filter("cite is not null").groupBy("cite").agg(F.count_if("left").alias("na"), F.count_if(~F.col("left")).alias("nb"))
    told = rest.join(n, "cite", "left").withColumn("pair", F.coalesce((F.col("na") == 1) & (F.col("nb") == 1), F.lit(False)))
    pairs = told.filter("pair").groupBy("cite").agg(
        F.max(F.when(F.col("left"), F.col("id"))).alias("id_a"),
        F.max(F.when(~F.col("left"), F.col("id"))).alias("id_b"),
        F.first("a", True).alias("a"),
        F.first("b", True).alias("b"),
    )
    alone = told.filter("not pair").select(
        F.when(F.col("left"), F.col("id")).alias("id_a"), F.when(~F.col("left"), F.col("id")).alias("id_b"), F.when(F.col("left"), "only_a").otherwise("only_b").alias("basis"), "a", "b"
    )
    return by_id.unionByName(pairs.select("id_a", "id_b", F.lit("citation").alias("basis"), "a", "b")).unionByName(alone)


def judged(matched: DataFrame, fields: list[Field] = RUN_FIELDS) -> DataFrame:
    """(id_a, id_b, basis, status, diffs) of all pairs and leftovers, each pair compared once.

    ``status``: agreed, helper_only, authoritative, only_a or only_b; ``diffs``: the
    differing fields with their severity, empty for leftovers.
    """
    found = F.array(*(F.when(~f.same(F.col(f"a.{f.slot}"), F.col(f"b.{f.slot}")), F.struct(F.lit(f.path).alias("field"), severity(F.col("a.type"), f.path).alias("severity"))) for f in fields))
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    held = matched.withColumn("diffs", F.when(both, F.filter(found, lambda x: x.isNotNull())).otherwise(F.filter(found, lambda x: F.lit(False))))
    exact = F.exists("diffs", lambda x: x["severity"] == "authoritative")
    status = F.when(F.col("b").isNull(), "only_a").when(F.col("a").isNull(), "only_b").when(F.size("diffs") == 0, "agreed").when(exact, "authoritative").otherwise("helper_only")
    return held.select("id_a", "id_b", "basis", status.alias("status"), "diffs")


def diff_fields(matched: DataFrame, fields: list[Field] = RUN_FIELDS) -> DataFrame:
    """(id_a, id_b, basis, field, severity): differing fields of the pairs."""
    return judged(matched, fields).select("id_a", "id_b", "basis", F.inline("diffs"))


def pair_status(matched: DataFrame, fields: list[Field] = RUN_FIELDS) -> DataFrame:
    """(id_a, id_b, basis, status): agreed, helper_only, authoritative, only_a or only_b."""
    return judged(matched, fields).drop("diffs")


def compare_summary(status: DataFrame) -> DataFrame:
    """One row: counts by basis and status, and the two rates of agreement."""
    n = {s: F.count_if(F.col("status") == s) for s in ("agreed", "helper_only", "authoritative", "only_a", "only_b")}
    matched = n["agreed"] + n["helper_only"] + n["authoritative"]
    rate = lambda c: F.coalesce(F.round(c / F.nullif(matched, F.lit(0)), 4), F.lit(0.0))
    return status.agg(
        F.count_if(F.col("basis") == "id").alias("by_id"),
        F.count_if(F.col("basis") == "citation").alias("by_citation"),
        *(c.alias(s) for s, c in n.items()),
        rate(n["agreed"]).alias("agreement"),
        rate(n["agreed"] + n["helper_only"]).alias("authoritative_agreement"),
    )


def score_gold(extracted: DataFrame, gold: DataFrame, fields: list[Field]) -> DataFrame:
    """(element_id, id_match, type_match, data_match, xref_match, score) of each gold row.

    ``fields``: the payload fields; those the gold row has count.  A gold row with
    none of them is met by an extracted row with none.
    """
    e = extracted.select(F.col("id"), F.struct("type", "cross_references", F.struct(*(f.column().alias(f.slot) for f in fields)).alias("v")).alias("e"))
    g = gold.select(F.col("id"), F.struct("type", "cross_references", F.struct(*(f.column().alias(f.slot) for f in fields)).alias("v")).alias("g"))
    met = g.join(e, "id", "left")
    has = [F.col(f"g.v.{f.slot}").isNotNull().cast("int") for f in fields]
    hit = [(F.col(f"g.v.{f.slot}").isNotNull() & f.same(F.col(f"g.v.{f.slot}"), F.col(f"e.v.{f.slot}"))).cast("int") for f in fields]
    more = [F.col(f"e.v.{f.slot}").isNotNull().cast("int") for f in fields]
    n, k, extra = (sum(x[1:], x[0]) for x in (has, hit, more))
    there = F.col("e").isNotNull()
    data = F.when(~there, 0.0).when(n == 0, (extra == 0).cast("double")).otherwise(k / n)
    kind = there & F.col("e.type").eqNullSafe(F.col("g.type"))
    refs = there & as_set(F.col("e.cross_references")).eqNullSafe(as_set(F.col("g.cross_references")))
    score = 0.1 * there.cast("double") + 0.2 * kind.cast("double") + 0.5 * data + 0.2 * refs.cast("double")
    return met.select(F.col("id").alias("element_id"), there.alias("id_match"), kind.alias("type_match"), F.round(data, 4).alias("data_match"), refs.alias("xref_match"), F.round(score, 4).alias("score"))


def calibration_report(scores: DataFrame) -> DataFrame:
    """One row: mean score and type rate of the matched gold rows, counts of found and missing."""
    hit = F.col("id_match")
    return scores.agg(
        F.count_if(hit).alias("n_compared"),
        F.count_if(~hit).alias("n_missing"),
        F.coalesce(F.round(F.avg(F.when(hit, F.col("score"))), 4), F.lit(0.0)).alias("accuracy"),
        F.coalesce(F.round(F.avg(F.when(hit, F.col("type_match").cast("int"))), 4), F.lit(0.0)).alias("type_accuracy"),
    )


def latest_decisions(decisions: DataFrame, keys: list[str], at: str = "decided_at", tie: str = "decision_id") -> DataFrame:
    """The last decision of each key."""
    rest = [c for c in decisions.columns if c not in keys]
    return decisions.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(at, tie)).alias("v")).select(*keys, "v.*")


def apply_decisions(base: DataFrame, alt: DataFrame, decisions: DataFrame, paths: list[str]) -> DataFrame:
    """(element_id, field_path, value, origin): what each decision sets its field to.

    Choice ``a`` takes the other run's value, ``b`` the base's, ``manual`` the value
    picked (none picked: no change).  Decisions on elements in neither run, on other
    fields than ``paths`` and with other choices change nothing.
    """
    last = latest_decisions(decisions.withColumn("element_id", F.trim("element_id")).filter("element_id <> ''"), ["element_id", "field_path"])

    def values(df: DataFrame, key: str, to: str) -> DataFrame:
        each = F.array(*(F.struct(F.lit(p).alias("field_path"), F.col(p).cast("string").alias(to)) for p in paths))
        return df.select(F.col("id").alias(key), F.inline(each))

    met = last.withColumn("a", F.coalesce("id_a", "element_id")).withColumn("b", F.coalesce("id_b", "element_id"))
    met = met.join(values(alt, "a", "_a").withColumn("_in_a", F.lit(True)), ["a", "field_path"], "left").join(values(base, "b", "_b").withColumn("_in_b", F.lit(True)), ["b", "field_path"], "left")
    known = base.select(F.col("id").alias("element_id")).union(alt.select("id")).distinct()
    c = F.col("choice")
    value = F.when(c == "manual", F.col("picked_value")).when(c == "a", F.col("_a")).when(c == "b", F.col("_b"))
    done = ((c == "manual") & F.col("picked_value").isNotNull()) | ((c == "a") & F.col("_in_a")) | ((c == "b") & F.col("_in_b"))
    return met.filter(done).join(known, "element_id", "left_semi").select("element_id", "field_path", value.alias("value"), c.alias("origin"))


def merged(base: DataFrame, alt: DataFrame, applied: DataFrame, paths: list[str]) -> DataFrame:
    """Base rows, and other-run rows that decisions name, with the decided fields set."""
    sets = applied.groupBy("element_id").agg(F.map_from_entries(F.collect_list(F.struct("field_path", "value"))).alias("set")).withColumnRenamed("element_id", "id")
    extra = alt.join(base.select("id"), "id", "left_anti").join(sets.select("id"), "id", "left_semi")
    rows = base.unionByName(extra).join(sets, "id", "left")
    for p in paths:
        top, _, inner = p.partition(".")
        kind = rows.select(p).schema[0].dataType
        new = F.when(F.map_contains_key(F.coalesce("set", F.expr("cast(map() as map<string,string>)")), F.lit(p)), F.element_at("set", p).cast(kind)).otherwise(F.col(p))
        rows = rows.withColumn(top, F.col(top).withField(inner, new) if inner else new)
    passed = F.col("metadata").withField("qc_status", F.when(F.col("set").isNotNull(), "passed").otherwise(F.col("metadata.qc_status")))
    return rows.withColumn("metadata", passed).drop("set")


def review_queue(matched: DataFrame, fields: list[Field] = RUN_FIELDS) -> DataFrame:
    """(id_a, id_b, status, n_diffs, fields) of the pairs that disagree, worst fields first."""
    rank = F.create_map(*(F.lit(x) for kv in RANK.items() for x in kv))
    ordered = F.array_sort(F.transform("diffs", lambda x: F.struct(rank[x["severity"]].alias("r"), x["field"].alias("field"))))
    open_ = judged(matched, fields).filter("status in ('authoritative', 'helper_only')")
    return open_.select("id_a", "id_b", "status", F.size("diffs").cast("bigint").alias("n_diffs"), F.array_join(F.transform(ordered, lambda x: x["field"]), ",").alias("fields"))


def review_rows(queue: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """The queue with both runs' rows beside each other; a pair that lacks one drops out."""
    left = a.select(F.col("id").alias("id_a"), F.struct("type", "title", "source", "data").alias("row_a"))
    right = b.select(F.col("id").alias("id_b"), F.struct("type", "title", "source", "data").alias("row_b"))
    return queue.join(left, "id_a").join(right, "id_b")
