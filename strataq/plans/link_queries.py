"""Link, condition and clean-up queries over the current elements."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from strataq.functions import text as T
from strataq.operators import clean as K
from strataq.operators import link as L
from strataq.operators.conditions import RULES, parse_conditions
from strataq.plans.corpus import CUR, WITH, blocks, current
from strataq.plans.text_queries import DOC, MENTIONS, ORDER, mentions_of
from strataq.session import durable
from strataq.sources import table

Q: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _cited(spark, d):
    return current(spark, d).select(F.col("source.standard").alias("doc"), F.col("source.chapter").alias("chapter"), "seq", "id", "type", F.col("source.section").alias("section"), F.col("source.citation").alias("citation"))


_CITED = "c AS (SELECT source.standard AS doc, source.chapter AS chapter, seq, id, type, source.section AS section, source.citation AS citation, lpad(seq::VARCHAR, 12, '0') || id AS o FROM cur)"
_NUM = r"nullif(regexp_extract(citation, '(\d+\.\d+-\d+[A-Da-d]?)', 1), '')"
_KINDSQL = "CASE WHEN type = 'formula' THEN 'equation' ELSE type END"
_INDEX = f"""
near AS (SELECT doc, chapter, {_KINDSQL} AS kind, {_NUM} AS num, arg_max(id, o) AS target FROM c WHERE type IN ('table', 'figure', 'formula') AND {_NUM} IS NOT NULL GROUP BY 1, 2, 3, 4
    UNION ALL SELECT doc, chapter, 'section', section, arg_min(id, o) FROM c WHERE section IS NOT NULL GROUP BY 1, 2, 3, 4),
far AS (SELECT doc, {_KINDSQL} AS kind, {_NUM} AS num, arg_min(id, lpad(chapter::VARCHAR, 6, '0') || o) AS target FROM c WHERE type IN ('table', 'figure', 'formula') AND {_NUM} IS NOT NULL GROUP BY 1, 2, 3
    UNION ALL SELECT doc, 'section', section, arg_min(id, lpad(chapter::VARCHAR, 6, '0') || o) FROM c WHERE section IS NOT NULL GROUP BY 1, 2, 3),
r AS (SELECT m.doc, m.chapter, m.id, m.kind, m.num, nullif(coalesce(near.target, far.target), m.id) AS target FROM m
    LEFT JOIN near ON m.doc = near.doc AND m.chapter = near.chapter AND m.kind = near.kind AND m.num = near.num
    LEFT JOIN far ON m.doc = far.doc AND m.kind = far.kind AND m.num = far.num)"""


def _resolved(spark, d):
    c = durable(_cited(spark, d))  # four indexes are made of it
    near = L.citation_index(c, DOC, ORDER).unionByName(L.section_index(c, DOC, ORDER))
    # Beyond the own chapter the first chapter that has the number counts.
    far = L.citation_index(c, ["doc"], ["chapter", *ORDER], first=True).unionByName(L.section_index(c, ["doc"], ["chapter", *ORDER]))
    return L.resolve_mentions(mentions_of(blocks(spark, d)), near, far, DOC, ["doc"])


@query(f"{WITH}, {MENTIONS}, {_CITED}, {_INDEX} SELECT id, string_agg(DISTINCT target, ',' ORDER BY target) AS targets FROM r WHERE target IS NOT NULL GROUP BY id")
def cross_references(spark, d):
    return L.cross_references(_resolved(spark, d)).withColumn("targets", F.array_join("targets", ","))


@query(f"""{WITH}, {MENTIONS}, {_CITED}, {_INDEX}, ch AS (SELECT DISTINCT doc, chapter FROM c)
    SELECT r.id, r.kind, r.num, r.target, split_part(r.num, '.', 1)::INT AS to_chapter, CASE WHEN r.target IS NOT NULL THEN 'resolved' WHEN ch.doc IS NOT NULL THEN 'broken' ELSE 'pending' END AS status
    FROM r LEFT JOIN ch ON r.doc = ch.doc AND split_part(r.num, '.', 1)::INT = ch.chapter""")
def unresolved_refs(spark, d):
    chapters = current(spark, d).select(F.col("source.standard").alias("doc"), F.col("source.chapter").alias("chapter"))
    found = L.reference_status(_resolved(spark, d), chapters, ["doc"], F.substring_index("num", ".", 1).cast("int"))
    return found.select("id", "kind", "num", "target", "to_chapter", "status")


@query(f"""{WITH}, {MENTIONS}, {_CITED}, {_INDEX}, ch AS (SELECT DISTINCT doc, chapter FROM c)
    SELECT r.doc, split_part(r.num, '.', 1)::INT AS to_chapter, CASE WHEN ch.doc IS NOT NULL THEN 'broken' ELSE 'pending' END AS status, count(*) AS n
    FROM r LEFT JOIN ch ON r.doc = ch.doc AND split_part(r.num, '.', 1)::INT = ch.chapter WHERE r.target IS NULL GROUP BY ALL""")
def unresolved_by_chapter(spark, d):
    return unresolved_refs(spark, d).filter("status <> 'resolved'").join(current(spark, d).select("id", F.col("source.standard").alias("doc")), "id").groupBy("doc", "to_chapter", "status").agg(F.count(F.lit(1)).alias("n"))


@query(f"""{WITH}, x AS (SELECT DISTINCT id, unnest(cross_references) AS t FROM cur)
    SELECT count(*) AS total, count_if(t IN (SELECT id FROM cur)) AS resolved, count_if(t NOT IN (SELECT id FROM cur)) AS dangling FROM x WHERE t IS NOT NULL""")
def xref_resolution(spark, d):
    now = current(spark, d)
    x = now.select("id", F.explode(F.array_distinct("cross_references")).alias("t")).filter("t is not null")
    met = x.join(now.select(F.col("id").alias("t"), F.lit(1).alias("hit")), "t", "left")
    return met.agg(F.count(F.lit(1)).alias("total"), F.count("hit").alias("resolved"), F.count_if(F.col("hit").isNull()).alias("dangling"))


_ANC = """
h AS (SELECT doc, chapter, section AS prefix, arg_max(id, o) AS hid FROM c WHERE type = 'heading' GROUP BY 1, 2, 3),
pre AS (SELECT DISTINCT doc, chapter, section, unnest(range(1, len(string_split(section, '.')) + 1)) AS n FROM c),
anc AS (SELECT p.doc, p.chapter, p.section, arg_max(h.hid, p.n) AS heading_id FROM pre p JOIN h ON h.doc = p.doc AND h.chapter = p.chapter
    AND h.prefix = array_to_string(string_split(p.section, '.')[1:p.n], '.') GROUP BY 1, 2, 3)"""


@query(f"{WITH}, {_CITED}, {_ANC} SELECT c.id, anc.heading_id FROM c LEFT JOIN anc ON c.doc = anc.doc AND c.chapter = anc.chapter AND c.section = anc.section")
def ancestor_heading(spark, d):
    c = _cited(spark, d)
    return L.ancestor_heading(c, c.filter("type = 'heading'"), DOC, ORDER).select("id", "heading_id")


_ROWS = """t AS (SELECT b.*, c.citation, c.o, CASE WHEN seq % 7 = 0 AND given = 'text_block' THEN 'where ' || text WHEN seq % 7 = 1 AND given = 'text_block' THEN '(a) ' || text
    WHEN seq % 7 = 2 AND given = 'text_block' THEN 'Figure ' || split_part(section, '.', 1) || '.1-1 ' || text ELSE text END AS body FROM b JOIN (SELECT id, citation, o FROM c) c USING (id))"""


@query(f"""{WITH}, {_CITED}, {_ANC}, {_ROWS},
    w AS (SELECT *, nullif(regexp_extract(body, '^Figure\\s+(\\d+\\.\\d+-\\d+)', 1), '') AS fig,
        last_value(CASE WHEN given = 'heading' THEN '!' WHEN given = 'formula' OR (given IN ('provision', 'text_block') AND regexp_matches(body, '[=<>≤≥]')) THEN id END IGNORE NULLS) OVER (PARTITION BY doc, chapter ORDER BY seq, id ROWS BETWEEN 9 PRECEDING AND 1 PRECEDING) AS wh,
        last_value(CASE WHEN given IN ('provision', 'heading') THEN id END IGNORE NULLS) OVER (PARTITION BY doc, chapter ORDER BY seq, id ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) AS li,
        last_value(CASE WHEN given = 'heading' THEN id END IGNORE NULLS) OVER (PARTITION BY doc, chapter ORDER BY seq, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS la FROM t),
    fg AS (SELECT w.doc, w.chapter, w.fig, arg_min(f.id, f.o) AS fid FROM (SELECT DISTINCT doc, chapter, fig FROM w WHERE given = 'text_block' AND fig IS NOT NULL) w JOIN t f ON f.doc = w.doc AND f.chapter = w.chapter AND f.given = 'figure' AND contains(f.citation, w.fig) GROUP BY 1, 2, 3),
    a AS (SELECT w.id, CASE WHEN lower(substring(body, 1, 5)) = 'where' AND wh IS NOT NULL AND wh <> '!' THEN {{'p': wh, 'r': 'where'}} WHEN fg.fid IS NOT NULL THEN {{'p': fg.fid, 'r': 'figure'}}
        WHEN regexp_matches(body, '^\\(?(?:\\d{{1,2}}|[a-z])[.)]\\s') AND li IS NOT NULL THEN {{'p': li, 'r': 'list'}} WHEN anc.heading_id IS NOT NULL THEN {{'p': anc.heading_id, 'r': 'section'}}
        WHEN la IS NOT NULL THEN {{'p': la, 'r': 'nearest'}} END AS x
        FROM w LEFT JOIN fg ON fg.doc = w.doc AND fg.chapter = w.chapter AND fg.fig = w.fig LEFT JOIN anc ON anc.doc = w.doc AND anc.chapter = w.chapter AND anc.section = w.section WHERE given = 'text_block')
    SELECT id, x.p AS parent, x.r AS rule FROM a""")
def parent_association(spark, d):
    b = blocks(spark, d).join(_cited(spark, d).select("id", "citation"), "id")
    tb, s = F.col("given") == "text_block", F.col("seq") % 7
    body = (
        F.when(tb & (s == 0), F.concat(F.lit("where "), "text"))
        .when(tb & (s == 1), F.concat(F.lit("(a) "), "text"))
        .when(tb & (s == 2), F.concat(F.lit("Figure "), F.substring_index("section", ".", 1), F.lit(".1-1 "), "text"))
        .otherwise(F.col("text"))
    )
    return L.associate(b.withColumn("text", body).withColumn("kind", F.col("given")), DOC, ORDER)


@query(f"{WITH} SELECT parent_id, id, row_number() OVER (PARTITION BY parent_id ORDER BY seq, id) AS place FROM cur WHERE parent_id IS NOT NULL QUALIFY place <= 50")
def parent_children(spark, d):
    return L.children(current(spark, d), 50, ["seq", "id"])


@query("SELECT id, source.chapter AS chapter FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC NULLS LAST, seq DESC NULLS LAST, source.chapter DESC NULLS LAST) AS r FROM elements WHERE id IS NOT NULL) WHERE r = 1")
def id_chapter_map(spark, d):
    """The chapter that was written last counts."""
    rows = table(spark, d, "elements").filter("id is not null").select("id", "source.chapter", "loaded_at", "seq")
    return rows.groupBy("id").agg(F.max_by("chapter", F.struct("loaded_at", "seq", "chapter")).alias("chapter"))


# --- conditions -----------------------------------------------------------

_TEXT = "CASE seq % 6 WHEN 0 THEN text || ' if h >= 60 ft or V > 150 mph' WHEN 1 THEN text || ' and equal to or greater than 30 m or less than 15 ft' WHEN 2 THEN text || ' in Risk Category III or Exposure C' WHEN 3 THEN text || ' for enclosed building or flexible structure or low-rise building' WHEN 4 THEN text || ' in a hurricane-prone region, wind-borne debris region' ELSE text END"


def _slot(p: str, s) -> str:
    return "NULL" if s is None else f"nullif(regexp_extract(m, '{p}', {s}), '')" if isinstance(s, int) else f"'{s}'"


def _sql_pattern(p: str) -> str:
    """The rule for the SQL engine, whose word ends and spaces are those of ASCII.

    The letter before a word is taken along, so a space before a missing unit is left for the next match.
    """
    p = p.replace(r"\s*(ft|m|mi/h|m/s|mph|Hz|%)?", r"(?:\s*(ft|m|mi/h|m/s|mph|Hz|%))?")
    return re.sub(r"^\\b", r"(?:^|[^\\p{L}\\p{N}_])", p).replace(r"\s", T.SPACE)


_COND = " UNION ".join(
    f"SELECT id, {_slot(p, r[1])} AS parameter, CASE WHEN {_slot(p, r[2])} = '=' THEN '==' ELSE {_slot(p, r[2])} END AS operator, "
    f"{f'try_cast({_slot(p, r[3])} AS DOUBLE)' if i < 5 else 'NULL::DOUBLE'} AS value_num, {'NULL' if i < 5 else _slot(p, r[3])} AS value_str, {_slot(p, r[4])} AS unit "
    f"FROM (SELECT id, unnest(regexp_extract_all(text, '{p}', 0)) AS m FROM p)"
    for i, r in enumerate(RULES)
    for p in [_sql_pattern(r[0])]
)


@query(f"{WITH}, p AS (SELECT id, {_TEXT} AS text FROM b WHERE given IN ('provision', 'exception')) {_COND}")
def parse_conditions_of_rules(spark, d):
    p = blocks(spark, d).filter("given in ('provision', 'exception')").selectExpr("id", f"{_TEXT} as text")
    return p.select("id", F.inline(parse_conditions(F.col("text"))))


# --- clean ----------------------------------------------------------------

_OPS = "CASE o " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in K.OPERATORS.items()) + " END"
_OPN = f"coalesce({_OPS}, {_OPS.replace('CASE o', 'CASE lower(trim(o))')}, o)"


@query(f"{WITH}, o AS (SELECT unnest(data.conditions).operator AS o FROM cur) SELECT o AS written, {_OPN} AS operator, count(*) AS n FROM o GROUP BY ALL")
def normalize_operators(spark, d):
    raw = current(spark, d).select("id", F.posexplode("data.conditions").alias("i", "c")).select("id", "i", F.col("c.operator").alias("written"))
    new = K.normalize_operators(current(spark, d)).select("id", F.posexplode("data.conditions").alias("i", "c")).select("id", "i", F.col("c.operator").alias("operator"))
    return raw.join(new, ["id", "i"]).groupBy("written", "operator").agg(F.count(F.lit(1)).alias("n"))


_PROV = "type IN ('provision', 'heading', 'text_block', 'user_note', 'exception')"


@query(f"""{WITH} SELECT id, coalesce(title, '') AS title, CASE WHEN {_PROV} THEN coalesce(data.rule, '') ELSE data.rule END AS rule, CASE WHEN {_PROV} THEN coalesce(data.then_text, '') ELSE data.then_text END AS then_text,
    CASE WHEN type = 'definition' THEN coalesce(data.term, '') ELSE data.term END AS term, CASE WHEN type = 'figure' THEN coalesce(data.description, '') ELSE data.description END AS fig_description, description FROM cur""")
def coerce_nulls(spark, d):
    return K.coerce_nulls(current(spark, d)).select("id", "title", "data.rule", "data.then_text", "data.term", F.col("data.description").alias("fig_description"), "description")


@query(f"""{WITH}, p AS (SELECT id, unnest(map_entries(data.parameters)) AS e FROM cur)
    SELECT id, e.key AS name, CASE WHEN len(list_filter(e.value.range, lambda x: x IS NULL)) = 0 THEN array_to_string(e.value.range, ';') END IS NOT NULL AS has_range FROM p""")
def drop_null_ranges(spark, d):
    p = K.drop_null_ranges(current(spark, d)).select("id", F.explode("data.parameters").alias("name", "v"))
    return p.select("id", "name", F.col("v.range").isNotNull().alias("has_range"))


@query("SELECT DISTINCT raw, upper(split_part(replace(raw, ' ', ''), '-', 1)) || substring(replace(raw, ' ', ''), length(split_part(replace(raw, ' ', ''), '-', 1)) + 1) AS id FROM (SELECT lower(element_id) AS raw FROM decisions WHERE element_id IS NOT NULL)")
def normalize_ids(spark, d):
    raw = table(spark, d, "decisions").filter("element_id is not null").select(F.lower("element_id").alias("raw")).distinct()
    return raw.select("raw", K.normal_id(F.col("raw")).alias("id"))


@query(f"""{WITH}, p AS (SELECT id, type, CASE seq % 4 WHEN 0 THEN 'WIND SPEED: ' || data.rule WHEN 1 THEN 'A wall, is defined as ' || data.rule WHEN 2 THEN 'Load means ' || data.rule ELSE data.rule END AS rule FROM cur),
    q AS (SELECT id, type, rule, CASE WHEN type <> 'provision' OR trim(rule) = '' THEN NULL
        WHEN regexp_matches(trim(rule), '^([A-Z][A-Z0-9 ]+[A-Z0-9])\\s*:\\s*(.+)', 's') THEN {{'t': trim(regexp_extract(trim(rule), '^([A-Z][A-Z0-9 ]+[A-Z0-9])\\s*:\\s*(.+)', 1, 's')), 'd': trim(regexp_extract(trim(rule), '^([A-Z][A-Z0-9 ]+[A-Z0-9])\\s*:\\s*(.+)', 2, 's'))}}
        WHEN regexp_matches(rule, '\\bis defined as\\b', 'i') THEN {{'t': regexp_replace(trim(regexp_extract(rule, '^(.*?)\\bis defined as\\b(.*)$', 1, 'is')), '[.,;]+$', ''), 'd': trim(regexp_extract(rule, '^(.*?)\\bis defined as\\b(.*)$', 2, 'is'))}}
        WHEN regexp_matches(rule, '\\bmeans\\b', 'i') THEN {{'t': regexp_replace(trim(regexp_extract(rule, '^(.*?)\\bmeans\\b(.*)$', 1, 'is')), '[.,;]+$', ''), 'd': trim(regexp_extract(rule, '^(.*?)\\bmeans\\b(.*)$', 2, 'is'))}} END AS x FROM p)
    SELECT id, CASE WHEN x IS NOT NULL THEN 'definition' ELSE type END AS type, x.t AS term, x.d AS definition FROM q WHERE type = 'provision'""")
def reclassify_definitions(spark, d):
    rule = F.expr("case pmod(seq, 4) when 0 then concat('WIND SPEED: ', data.rule) when 1 then concat('A wall, is defined as ', data.rule) when 2 then concat('Load means ', data.rule) else data.rule end")
    p = current(spark, d).filter("type = 'provision'")
    return K.reclassify_definitions(p.withColumn("data", F.col("data").withField("rule", rule))).select("id", "type", "data.term", "data.definition")


_CAPS = r"^([A-Z][A-Z0-9 ]+[A-Z0-9])\s*:\s*(.+)"
_CUT = lambda w: rf"^(|.*?[^\p{{L}}\p{{N}}_]){w}(|[^\p{{L}}\p{{N}}_].*)$"
_DEFINED = f"""CASE WHEN type <> 'provision' OR trim(coalesce(data.rule, '')) = '' THEN NULL
    WHEN regexp_matches(trim(data.rule), '{_CAPS}', 's') THEN {{'t': trim(regexp_extract(trim(data.rule), '{_CAPS}', 1, 's')), 'd': trim(regexp_extract(trim(data.rule), '{_CAPS}', 2, 's'))}}
    """ + "\n    ".join(
    f"WHEN regexp_matches(data.rule, '{_CUT(w)}', 'is') THEN {{'t': regexp_replace(trim(regexp_extract(data.rule, '{_CUT(w)}', 1, 'is')), '[.,;]+$', ''), 'd': trim(regexp_extract(data.rule, '{_CUT(w)}', 2, 'is'))}}"
    for w in ("is defined as", "means")
) + " END"
_FILLED = lambda f, test: f"CASE WHEN x IS NOT NULL THEN NULL WHEN {test} THEN coalesce(data.{f}, '') ELSE data.{f} END AS {f}"


@query(f"""{WITH}, q AS (SELECT *, {_DEFINED} AS x FROM cur)
    SELECT upper(split_part(replace(id, ' ', ''), '-', 1)) || substring(replace(id, ' ', ''), length(split_part(replace(id, ' ', ''), '-', 1)) + 1) AS id, CASE WHEN x IS NOT NULL THEN 'definition' ELSE type END AS type, coalesce(title, '') AS title,
    {_FILLED('rule', _PROV)}, {_FILLED('then_text', _PROV)}, {_FILLED('expression', "type = 'formula'")}, {_FILLED('target', "type = 'reference'")}, {_FILLED('figure_type', "type = 'figure'")}, {_FILLED('description', "type = 'figure'")},
    CASE WHEN x IS NOT NULL THEN x.t WHEN type = 'definition' THEN coalesce(data.term, '') ELSE data.term END AS term, CASE WHEN x IS NOT NULL THEN x.d WHEN type = 'definition' THEN coalesce(data.definition, '') ELSE data.definition END AS definition,
    array_to_string(list_transform(data.conditions, lambda c: coalesce(c.parameter, '') || ' ' || coalesce({_OPN.replace('CASE o', 'CASE c.operator').replace('trim(o)', 'trim(c.operator)').replace(', o)', ', c.operator)')}, '?')), ';') AS conditions,
    CASE WHEN x IS NULL THEN len(list_filter(map_values(data.parameters), lambda p: p.range IS NOT NULL AND len(list_filter(p.range, lambda v: v IS NULL)) = 0))::BIGINT END AS n_ranges FROM q""")
def post_process(spark, d):
    after = K.post_process(current(spark, d))
    said = F.transform("data.conditions", lambda c: F.concat_ws(" ", c["parameter"], F.coalesce(c["operator"], F.lit("?"))))
    ranges = F.size(F.filter(F.map_values("data.parameters"), lambda p: p["range"].isNotNull()))
    names = ("rule", "then_text", "expression", "target", "figure_type", "description", "term", "definition")
    return after.select("id", "type", "title", *(f"data.{n}" for n in names), F.array_join(said, ";").alias("conditions"), F.when(F.col("data.parameters").isNotNull(), ranges).cast("bigint").alias("n_ranges"))


@query(f"{WITH} SELECT id, coalesce(description, '') AS description, coalesce(source.citation, 'Section ' || source.section) AS citation FROM cur")
def fill_for_output(spark, d):
    return K.fill_for_output(current(spark, d)).select("id", "description", "source.citation")


QUERIES = Q
