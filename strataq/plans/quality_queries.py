"""Comparison, quality, registry, table and geometry queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataq.functions import text as T
from strataq.operators import compare as X
from strataq.operators import geometry as G
from strataq.operators import gold as O
from strataq.operators import quality as Y
from strataq.operators import registry as R
from strataq.operators import sequence as S
from strataq.operators import tables as B
from strataq.operators.nested import readable
from strataq.plans.corpus import CUR, WITH, blocks, current
from strataq.plans.text_queries import DOC, ORDER, mentions_of
from strataq.sources import table

Q: dict = {}
SQL: dict[str, str] = {}


def _n():
    return F.count(F.lit(1))


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# --- two runs --------------------------------------------------------------
# The second run: system B's rows, a seventh of their ids written anew, so that the citation has to match.

_B_ID = "CASE WHEN seq % 7 = 0 THEN 'new-' || id ELSE id END"


def _runs(spark, d):
    a, b = current(spark, d), current(spark, d, "elements_b")
    return a, b.withColumn("id", F.when(F.col("seq") % 7 == 0, F.concat(F.lit("new-"), "id")).otherwise(F.col("id")))


def _matched(spark, d):
    return X.match_runs(*_runs(spark, d))


_CITE = r"CASE WHEN source.chapter IS NOT NULL AND type <> '' AND trim(source.standard) <> '' AND trim(source.section) <> '' AND trim(source.citation) <> '' THEN concat_ws('|', type, source.chapter::VARCHAR, trim(regexp_replace(source.standard, '\s+', ' ', 'g')), trim(regexp_replace(source.section, '\s+', ' ', 'g')), trim(regexp_replace(source.citation, '\s+', ' ', 'g'))) END"
_MATCH = f"""
a AS (SELECT *, {_CITE} AS cite FROM cur), b0 AS ({CUR.format(t='elements_b')}), b2 AS (SELECT * REPLACE ({_B_ID} AS id), {_CITE} AS cite FROM b0),
la AS (SELECT id, cite FROM a WHERE id NOT IN (SELECT id FROM b2)), lb AS (SELECT id, cite FROM b2 WHERE id NOT IN (SELECT id FROM a)),
ua AS (SELECT cite, max(id) AS id FROM la WHERE cite IS NOT NULL GROUP BY cite HAVING count(*) = 1), ub AS (SELECT cite, max(id) AS id FROM lb WHERE cite IS NOT NULL GROUP BY cite HAVING count(*) = 1),
pc AS (SELECT ua.id AS id_a, ub.id AS id_b FROM ua JOIN ub ON ua.cite = ub.cite),
mt AS (SELECT a.id AS id_a, a.id AS id_b, 'id' AS basis FROM a JOIN b2 ON a.id = b2.id UNION ALL SELECT id_a, id_b, 'citation' FROM pc
    UNION ALL SELECT id, NULL, 'only_a' FROM la WHERE id NOT IN (SELECT id_a FROM pc) UNION ALL SELECT NULL, id, 'only_b' FROM lb WHERE id NOT IN (SELECT id_b FROM pc))"""


@query(f"{WITH}, {_MATCH} SELECT id_a, id_b, basis FROM mt")
def match_runs(spark, d):
    return _matched(spark, d).select("id_a", "id_b", "basis")


_TRIMMED = lambda p, q: f"trim({p}, ' ') IS NOT DISTINCT FROM trim({q}, ' ')"
_EXACT = lambda p, q: f"{p} IS NOT DISTINCT FROM {q}"


def _near(p: str, q: str, of: str = "greatest(abs({p}), abs({q}))") -> str:
    of = of.format(p=p, q=q)
    return f"(({p} IS NULL AND {q} IS NULL) OR coalesce(CASE WHEN {p} = 0 THEN abs({q}) <= 0.001 ELSE abs({p} - {q}) <= 0.001 * {of} END, false))"


def _near_gold(p: str, q: str) -> str:
    return _near(p, q, "abs({p})")


def _lists(a: str, b: str, same, i: str = "i") -> str:
    agree = f"len({a}) = len({b}) AND len(list_filter(range(1, len({a}) + 1), lambda {i}: NOT ({same(f'{a}[{i}]', f'{b}[{i}]')}))) = 0"
    return f"(({a} IS NULL AND {b} IS NULL) OR ({a} IS NOT NULL AND {b} IS NOT NULL AND coalesce({agree}, false)))"


def _maps(a: str, b: str, same) -> str:
    return f"(cardinality({a}) = cardinality({b}) AND len(list_filter(map_keys({a}), lambda k: NOT (list_contains(map_keys({b}), k) AND {same(f'{a}[k]', f'{b}[k]')}))) = 0)"


def _payload_same(text, number) -> dict[str, str]:
    """SQL: whether rows x and y agree in each payload field."""
    d = lambda whole, f, **kw: whole(f"x.data.{f}", f"y.data.{f}", **kw)
    both = lambda names, same: lambda p, q: " AND ".join(same(f"{p}.{n}", f"{q}.{n}") for n in names)
    condition = lambda p, q: both(("parameter", "operator", "value_str", "unit"), text)(p, q) + f" AND {number(f'{p}.value_num', f'{q}.value_num')}"
    parameter = lambda p, q: f"{both(('unit', 'source'), text)(p, q)} AND {_lists(f'{p}.range', f'{q}.range', number, 'j')}"
    a, b = "x.data.parameters", "y.data.parameters"
    return {
        **{f"data.{c}": d(text, c) for c in X.TEXTS},
        "data.conditions": d(_lists, "conditions", same=condition),
        "data.exceptions": d(_lists, "exceptions", same=text),
        "data.columns": d(_lists, "columns", same=both(("name", "unit"), text)),
        "data.rows": d(_lists, "rows", same=lambda p, q: _maps(p, q, text)),
        "data.parameters": f"(({a} IS NULL AND {b} IS NULL) OR coalesce({a} IS NOT NULL AND {b} IS NOT NULL AND {_maps(a, b, parameter)}, false))",
        "data.reference_parameters": d(_lists, "reference_parameters", same=text),
        "data.source_pdf_page": d(number, "source_pdf_page"),
    }


_XREF = lambda s: f"list_sort(list_distinct(list_filter(list_transform(coalesce({s}.cross_references, []), lambda r: trim(r, ' ')), lambda r: r IS NOT NULL AND r <> '')))"
_SAME = {
    "type": _EXACT("x.type", "y.type"),
    **{f"source.{c}": _TRIMMED(f"x.source.{c}", f"y.source.{c}") for c in ("standard", "section", "citation")},
    **{f"source.{c}": _EXACT(f"x.source.{c}", f"y.source.{c}") for c in ("chapter", "page")},
    "title": _EXACT("x.title", "y.title"),
    "description": _EXACT("x.description", "y.description"),
    **_payload_same(_TRIMMED, _near),
    "cross_references": _EXACT(_XREF("x"), _XREF("y")),
}


def _sev(path: str) -> str:
    if path in X.ALWAYS:
        return "'authoritative'"
    if path == "description":
        return "'descriptive'"
    exact = [t for t, fs in X.AUTHORITATIVE.items() if path in fs or (t == "table" and path.startswith("data."))]
    arms = (f"WHEN x.type IN ({', '.join(repr(t) for t in exact)}) THEN 'authoritative' " if exact else "") + ("WHEN x.type = 'figure' THEN 'descriptive' " if path == "data.description" else "")
    return f"CASE {arms}ELSE 'helper' END" if arms else "'helper'"


_DIFF = "df AS (" + "\nUNION ALL ".join(f"SELECT id_a, id_b, basis, '{p}' AS field, {_sev(p)} AS severity FROM mt JOIN a x ON x.id = id_a JOIN b2 y ON y.id = id_b WHERE NOT ({t})" for p, t in _SAME.items()) + ")"
_STATUS = """st AS (SELECT mt.*, CASE WHEN basis LIKE 'only%' THEN basis WHEN w.sev IS NULL THEN 'agreed' WHEN w.sev = 0 THEN 'authoritative' ELSE 'helper_only' END AS status
    FROM mt LEFT JOIN (SELECT id_a, id_b, min(CASE severity WHEN 'authoritative' THEN 0 WHEN 'helper' THEN 1 ELSE 2 END) AS sev FROM df GROUP BY ALL) w ON w.id_a = mt.id_a AND w.id_b = mt.id_b)"""


@query(f"{WITH}, {_MATCH}, {_DIFF} SELECT * FROM df")
def diff_fields(spark, d):
    return X.diff_fields(_matched(spark, d))


@query(f"""{WITH}, {_MATCH}, {_DIFF}, {_STATUS} SELECT count_if(basis = 'id') AS by_id, count_if(basis = 'citation') AS by_citation, count_if(status = 'agreed') AS agreed, count_if(status = 'helper_only') AS helper_only,
    count_if(status = 'authoritative') AS authoritative, count_if(status = 'only_a') AS only_a, count_if(status = 'only_b') AS only_b,
    round(count_if(status = 'agreed') / count_if(status NOT LIKE 'only%'), 4) AS agreement, round(count_if(status IN ('agreed', 'helper_only')) / count_if(status NOT LIKE 'only%'), 4) AS authoritative_agreement FROM st""")
def compare_summary(spark, d):
    return X.compare_summary(X.pair_status(_matched(spark, d)))


@query(f"""{WITH}, {_MATCH}, {_DIFF}, {_STATUS} SELECT st.id_a, st.id_b, st.status, count(*) AS n_diffs,
    string_agg(field, ',' ORDER BY CASE severity WHEN 'authoritative' THEN 0 WHEN 'helper' THEN 1 ELSE 2 END, field) AS fields FROM st JOIN df ON df.id_a = st.id_a AND df.id_b = st.id_b GROUP BY ALL""")
def review_queue(spark, d):
    return X.review_queue(_matched(spark, d))


@query(f"""{WITH}, {_MATCH}, {_DIFF} SELECT mt.id_a, mt.id_b, x.title AS title_a, y.title AS title_b, trim(coalesce(x.data.rule, ''), ' ') = trim(coalesce(y.data.rule, ''), ' ') AS same_rule
    FROM (SELECT DISTINCT id_a, id_b FROM df) mt JOIN a x ON x.id = mt.id_a JOIN b2 y ON y.id = mt.id_b""")
def review_rows(spark, d):
    rows = X.review_rows(X.review_queue(_matched(spark, d)), *_runs(spark, d))
    rule = lambda r: F.trim(F.coalesce(f"{r}.data.rule", F.lit("")))
    return rows.select("id_a", "id_b", F.col("row_a.title").alias("title_a"), F.col("row_b.title").alias("title_b"), (rule("row_a") == rule("row_b")).alias("same_rule"))


_PATHS = ["title", "description", "data.rule", "data.definition", "source.citation"]
_DEC = f"""
ld AS (SELECT * FROM (SELECT *, trim(element_id, ' ') AS eid, row_number() OVER (PARTITION BY trim(element_id, ' '), field_path ORDER BY decided_at DESC, decision_id DESC) AS r FROM decisions WHERE trim(element_id, ' ') <> '') WHERE r = 1),
bb AS ({CUR.format(t='elements_b')}),
va AS ({' UNION ALL '.join(f"SELECT id, '{p}' AS p, {p} AS v FROM cur" for p in _PATHS)}), vb AS ({' UNION ALL '.join(f"SELECT id, '{p}' AS p, {p} AS v FROM bb" for p in _PATHS)}),
ap AS (SELECT eid AS element_id, field_path, CASE choice WHEN 'manual' THEN picked_value WHEN 'a' THEN va.v WHEN 'b' THEN vb.v END AS value, choice AS origin FROM ld
    LEFT JOIN va ON va.id = coalesce(id_a, eid) AND va.p = field_path LEFT JOIN vb ON vb.id = coalesce(id_b, eid) AND vb.p = field_path
    WHERE ((choice = 'manual' AND picked_value IS NOT NULL) OR (choice = 'a' AND va.id IS NOT NULL) OR (choice = 'b' AND vb.id IS NOT NULL)) AND (eid IN (SELECT id FROM cur) OR eid IN (SELECT id FROM bb)))"""


@query(f"{WITH}, {_DEC} SELECT * FROM ap")
def decision_values(spark, d):
    return X.apply_decisions(current(spark, d, "elements_b"), current(spark, d), table(spark, d, "decisions"), _PATHS)


@query(f"""{WITH}, {_DEC}, m AS (SELECT * FROM bb UNION ALL SELECT * FROM cur WHERE id NOT IN (SELECT id FROM bb) AND id IN (SELECT element_id FROM ap))
    SELECT m.id, {', '.join(f"CASE WHEN EXISTS (SELECT 1 FROM ap WHERE element_id = m.id AND field_path = '{p}') THEN (SELECT value FROM ap WHERE element_id = m.id AND field_path = '{p}') ELSE {p} END AS {p.replace('.', '_')}" for p in _PATHS)},
    CASE WHEN m.id IN (SELECT element_id FROM ap) THEN 'passed' ELSE metadata.qc_status END AS qc_status FROM m""")
def merge_decisions(spark, d):
    base, alt = current(spark, d, "elements_b"), current(spark, d)
    out = X.merged(base, alt, X.apply_decisions(base, alt, table(spark, d, "decisions"), _PATHS), _PATHS)
    return out.select("id", *(F.col(p).alias(p.replace(".", "_")) for p in _PATHS), F.col("metadata.qc_status").alias("qc_status"))


@query("SELECT trim(element_id, ' ') AS element_id, field_path, arg_max(choice, decided_at) AS choice, max(decided_at) AS decided_at FROM decisions WHERE trim(element_id, ' ') <> '' GROUP BY 1, 2")
def latest_decisions(spark, d):
    dec = table(spark, d, "decisions").withColumn("element_id", F.trim("element_id")).filter("element_id <> ''")
    return X.latest_decisions(dec, ["element_id", "field_path"]).select("element_id", "field_path", "choice", "decided_at")


_GOLD_SAME = _payload_same(_EXACT, _near_gold)
_G = " + ".join(f"(x.{p} IS NOT NULL)::INT" for p in _GOLD_SAME)
_H = " + ".join(f"(x.{p} IS NOT NULL AND ({t}))::INT" for p, t in _GOLD_SAME.items())
_E = " + ".join(f"(y.{p} IS NOT NULL)::INT" for p in _GOLD_SAME)
_SCORE = f"""
g AS (SELECT * FROM cur WHERE metadata.qc_status = 'passed'), e2 AS ({CUR.format(t='elements_b')}),
sc AS (SELECT x.id AS element_id, y.id IS NOT NULL AS id_match, y.id IS NOT NULL AND x.type IS NOT DISTINCT FROM y.type AS type_match,
    CASE WHEN y.id IS NULL THEN 0.0::DOUBLE WHEN ({_G}) = 0 THEN (({_E}) = 0)::INT::DOUBLE ELSE ({_H}) / ({_G}) END AS dm, y.id IS NOT NULL AND {_XREF('x')} IS NOT DISTINCT FROM {_XREF('y')} AS xref_match FROM g x LEFT JOIN e2 y ON x.id = y.id),
s2 AS (SELECT element_id, id_match, type_match, round(dm, 4) AS data_match, xref_match, round(0.1 * id_match::INT::DOUBLE + 0.2 * type_match::INT::DOUBLE + 0.5 * dm + 0.2 * xref_match::INT::DOUBLE, 4) AS score FROM sc)"""


def _scores(spark, d):
    return X.score_gold(current(spark, d, "elements_b"), current(spark, d).filter("metadata.qc_status = 'passed'"), X.GOLD_FIELDS)


@query(f"{WITH}, {_SCORE} SELECT * FROM s2")
def calibration_scores(spark, d):
    return _scores(spark, d)


@query(f"{WITH}, {_SCORE} SELECT count_if(id_match) AS n_compared, count_if(NOT id_match) AS n_missing, round(avg(CASE WHEN id_match THEN score END), 4) AS accuracy, round(avg(CASE WHEN id_match THEN type_match::INT END), 4) AS type_accuracy FROM s2")
def calibration_report(spark, d):
    return X.calibration_report(_scores(spark, d))


# --- quality ---------------------------------------------------------------

_IN = lambda xs: "(" + ", ".join(f"'{x}'" for x in xs) + ")"
_CHECKS = {
    "id": f"regexp_matches(id, '{Y.ID_PATTERN}')",
    "type": f"type IN {_IN(Y.TYPES)}",
    "source": "source.standard IS NOT NULL AND source.chapter IS NOT NULL AND source.section IS NOT NULL",
    "title": "title IS NOT NULL",
    "data": "(data.rule IS NOT NULL AND data.conditions IS NOT NULL) OR (data.term IS NOT NULL AND data.definition IS NOT NULL) OR (data.columns IS NOT NULL AND data.rows IS NOT NULL) OR (data.expression IS NOT NULL AND data.parameters IS NOT NULL) OR data.target IS NOT NULL OR (data.figure_type IS NOT NULL AND data.description IS NOT NULL)",
    "conditions": f"len(list_filter(coalesce(data.conditions, []), lambda c: NOT coalesce(c.operator IN {_IN(Y.CONDITION_OPERATORS)} AND c.parameter IS NOT NULL, false))) = 0",
    "metadata": f"metadata.extracted_by IN {_IN(Y.EXTRACTED_BY)} AND metadata.qc_status IN {_IN(Y.QC_STATUS)}",
}
_ERRORS = "concat_ws(',', " + ", ".join(f"CASE WHEN NOT coalesce({t}, false) THEN '{n}' END" for n, t in _CHECKS.items()) + ")"
_VALID = f"v AS (SELECT *, {_ERRORS} AS errors FROM cur)"


@query(f"{WITH}, {_VALID} SELECT id, errors FROM v")
def validate_elements(spark, d):
    return Y.validate(current(spark, d)).select("id", F.array_join("errors", ",").alias("errors"))


@query(f"{WITH}, {_VALID} SELECT source.standard AS doc, source.chapter AS chapter, count(*) AS total, count_if(errors = '') AS passed, count_if(errors <> '') AS failed FROM v GROUP BY 1, 2")
def validate_chapter(spark, d):
    v = Y.validate(current(spark, d)).withColumns({"doc": F.col("source.standard"), "chapter": F.col("source.chapter")})
    return Y.validity(v, ["doc", "chapter"])


_SIX = "CASE WHEN type = 'formula' THEN 'equation' ELSE type END"
_FOUND = f"""found AS (SELECT DISTINCT source.standard AS doc, 'section' AS kind, source.section AS num FROM cur WHERE source.section IS NOT NULL
    UNION SELECT DISTINCT source.standard, {_SIX}, regexp_extract(source.citation, '(\\d+\\.\\d+-\\d+[A-Da-d]?)', 1) FROM cur WHERE type IN ('table', 'figure', 'formula') AND regexp_matches(source.citation, '\\d+\\.\\d+-\\d+'))"""
_TRUTH = "truth AS (" + " UNION ".join(f"SELECT DISTINCT doc, '{k}' AS kind, unnest(regexp_extract_all(text, '{p}', 1)) AS num FROM b" for k, p in T.MENTIONS.items() if k != "chapter") + ")"


def _found(spark, d):
    c = current(spark, d).select(F.col("source.standard").alias("doc"), "type", F.col("source.section").alias("s"), F.col("source.citation").alias("c"))
    kind = F.when(F.col("type") == "formula", "equation").otherwise(F.col("type"))
    items = c.filter("type in ('table', 'figure', 'formula')").filter(F.col("c").rlike(T.NUMBER))
    return c.filter("s is not null").select("doc", F.lit("section").alias("kind"), F.col("s").alias("num")).union(items.select("doc", kind, F.regexp_extract("c", r"(\d+\.\d+-\d+[A-Da-d]?)", 1)))


def _truth(spark, d):
    return mentions_of(blocks(spark, d), ("table", "figure", "equation", "section")).select("doc", "kind", "num")


@query(f"""{WITH}, {_FOUND}, {_TRUTH} SELECT coalesce(t.doc, f.doc) AS doc, coalesce(t.kind, f.kind) AS kind, count(t.doc) AS n_truth, count(f.doc) AS n_found, count_if(t.doc IS NOT NULL AND f.doc IS NOT NULL) AS n_both,
    count_if(f.doc IS NULL) AS n_missing, count_if(t.doc IS NULL) AS n_extra, round(count_if(t.doc IS NOT NULL AND f.doc IS NOT NULL) / greatest(count(t.doc), 1), 4) AS score
    FROM truth t FULL JOIN found f ON t.doc = f.doc AND t.kind = f.kind AND t.num = f.num GROUP BY 1, 2""")
def coverage(spark, d):
    return Y.coverage(_truth(spark, d), _found(spark, d), ["doc"])


@query(f"""{WITH}, {_FOUND}, {_TRUTH} SELECT t.doc, count(*) AS total, count(f.doc) AS found, round(count(f.doc) / greatest(count(*), 1), 4) AS score
    FROM truth t LEFT JOIN found f ON t.doc = f.doc AND t.kind = f.kind AND t.num = f.num GROUP BY 1""")
def completeness(spark, d):
    cov = Y.coverage(_truth(spark, d), _found(spark, d), ["doc"]).groupBy("doc").agg(F.sum("n_truth").alias("total"), F.sum("n_both").alias("found")).filter("total > 0")
    return cov.withColumn("score", F.round(F.col("found") / F.greatest("total", F.lit(1)), 4))


_PAGES = "pg AS (SELECT source.standard AS doc, source.chapter AS chapter, source.page AS page, string_agg(coalesce(data.rule, ''), ' ' ORDER BY seq, id) AS page_text FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC NULLS LAST, extracted_at DESC NULLS LAST, seq DESC) AS r2 FROM elements_b WHERE id IS NOT NULL) WHERE r2 = 1) GROUP BY 1, 2, 3)"


_FID = f"""{_PAGES}, ft AS (SELECT id, source.standard AS doc, source.chapter AS chapter, source.page AS page, coalesce(nullif(data.rule, ''), nullif(data.definition, ''), nullif(data.expression, ''), '') AS text FROM cur WHERE type <> 'figure'),
    fm AS (SELECT t.doc, t.chapter, CASE WHEN contains(regexp_replace(page_text, '\\s+', ' ', 'g'), substring(trim(regexp_replace(text, '\\s+', ' ', 'g')), 1, 60)) THEN 'exact'
        WHEN contains(replace(regexp_replace(page_text, '\\s+', ' ', 'g'), ' ', ''), replace(substring(trim(regexp_replace(text, '\\s+', ' ', 'g')), 1, 60), ' ', '')) THEN 'spacing' ELSE 'none' END AS match
        FROM ft t LEFT JOIN pg ON pg.doc = t.doc AND pg.chapter = t.chapter AND pg.page = t.page WHERE length(text) >= 20)"""


@query(f"""{WITH}, {_FID} SELECT doc, chapter, count(*) AS n_checked, count_if(match = 'exact') AS n_exact, count_if(match = 'spacing') AS n_spacing, round(count_if(match <> 'none') / greatest(count(*), 1), 4) AS score FROM fm GROUP BY 1, 2""")
def fidelity(spark, d):
    place = [F.col("source.standard").alias("doc"), F.col("source.chapter").alias("chapter"), F.col("source.page").alias("page")]
    b = current(spark, d, "elements_b").select(*place, F.struct("seq", "id", F.coalesce("data.rule", F.lit("")).alias("t")).alias("x"))
    pages = b.groupBy("doc", "chapter", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["t"]), " ").alias("page_text"))
    text = T.first_filled(*(F.col(f"data.{c}") for c in ("rule", "definition", "expression")))
    found = Y.fidelity(current(spark, d).filter("type <> 'figure'").select("id", *place, text.alias("text")), pages, ["doc", "chapter", "page"])
    hit = F.count_if(F.col("match") != "none")
    return found.groupBy("doc", "chapter").agg(_n().alias("n_checked"), F.count_if(F.col("match") == "exact").alias("n_exact"), F.count_if(F.col("match") == "spacing").alias("n_spacing"), F.round(hit / F.greatest(_n(), F.lit(1)), 4).alias("score"))


def _structural(spark, d):
    e = table(spark, d, "elements").filter("id is not null")
    return e.select(F.col("source.standard").alias("doc"), F.col("source.chapter").alias("chapter"), "seq", "id", "type", F.col("source.section").alias("section"), Y.element_text().alias("text"), F.col("loaded_at"))


_KEY = "list_transform(string_split(section, '.'), lambda x: coalesce(try_cast(x AS INT), 999))"
_STRUCT = f"""e AS (SELECT source.standard AS doc, source.chapter AS chapter, seq, id, type, source.section AS section, loaded_at, coalesce(nullif(data.rule, ''), nullif(data.definition, ''), nullif(data.expression, ''), nullif(data.description, ''), '') AS text FROM elements WHERE id IS NOT NULL),
    du AS (SELECT doc, chapter, count_if(n > 1) AS n_duplicate_ids FROM (SELECT doc, chapter, id, count(*) AS n FROM e GROUP BY 1, 2, 3) GROUP BY 1, 2),
    bs AS (SELECT doc, chapter, count(*) AS n, sum((coalesce(section, '') = '')::INT + (type <> 'table' AND length(text) < 5)::INT)::BIGINT AS n_empty FROM e GROUP BY 1, 2),
    iv AS (SELECT doc, chapter, count(*) AS n_sections, count_if(k < p) AS n_inversions FROM (SELECT doc, chapter, {_KEY} AS k, lag({_KEY}) OVER (PARTITION BY doc, chapter ORDER BY seq, id, loaded_at) AS p FROM e WHERE regexp_matches(section, '^\\d+\\.\\d+')) GROUP BY 1, 2),
    sr AS (SELECT bs.doc, bs.chapter, n, n_duplicate_ids, coalesce(n_inversions, 0) AS n_inversions, n_empty,
    round(((1 - coalesce(n_inversions, 0) / greatest(coalesce(n_sections, 0), 1)) + (1 - n_empty / n) + CASE WHEN n_duplicate_ids > 0 THEN 0.5 ELSE 1.0 END::DOUBLE) / 3, 4) AS score
    FROM bs JOIN du USING (doc, chapter) LEFT JOIN iv USING (doc, chapter))"""


@query(f"WITH {_STRUCT} SELECT * FROM sr")
def structure(spark, d):
    return Y.structure(_structural(spark, d), DOC, ["seq", "id", "loaded_at"])


_BENCH = f"""{_FOUND}, {_TRUTH}, {_STRUCT}, {_FID},
    cv AS (SELECT t.doc, count(f.doc) / greatest(count(*), 1) AS c FROM truth t LEFT JOIN found f ON t.doc = f.doc AND t.kind = f.kind AND t.num = f.num GROUP BY 1),
    fd AS (SELECT doc, count_if(match <> 'none') / greatest(count(*), 1) AS f FROM fm GROUP BY 1), s2 AS (SELECT doc, sum(score * n) / sum(n) AS s FROM sr GROUP BY 1),
    bench AS (SELECT s2.doc, c, coalesce(f, 0) AS f, s, round(0.4 * round(c, 3) + 0.4 * round(coalesce(f, 0), 3) + 0.2 * round(s, 3), 3) AS composite FROM s2 LEFT JOIN fd USING (doc) LEFT JOIN cv USING (doc))"""


@query(f"{WITH}, {_BENCH} SELECT doc, composite FROM bench WHERE c IS NOT NULL")
def composite(spark, d):
    """Standards with no text to check have fidelity 0."""
    return _benchmark(spark, d).filter("c is not null").select("doc", _composite().alias("composite"))


def _composite():
    return Y.composite(*(F.round(x, 3) for x in ("c", "f", "s")))


def _benchmark(spark, d):
    """(doc, c, f, s): coverage, fidelity and structure of each standard; no coverage where nothing is mentioned."""
    cov = completeness(spark, d).select("doc", (F.col("found") / F.greatest("total", F.lit(1))).alias("c"))
    hit = (F.sum("n_exact") + F.sum("n_spacing")) / F.greatest(F.sum("n_checked"), F.lit(1))
    fid = fidelity(spark, d).groupBy("doc").agg(hit.alias("f"))
    struct = structure(spark, d).groupBy("doc").agg((F.sum(F.col("score") * F.col("n")) / F.sum("n")).alias("s"))
    return struct.join(fid, "doc", "left").join(cov, "doc", "left").select("doc", "c", F.coalesce("f", F.lit(0.0)).alias("f"), "s")



_SIZE = lambda c: f"coalesce(len({c}), 0)"


@query(f"""{WITH}, {_VALID}, {_BENCH}, s AS (SELECT source.standard AS doc, count(DISTINCT k) AS n_symbols FROM (SELECT source, unnest(map_keys(data.parameters)) AS k FROM cur) GROUP BY 1),
    x AS (SELECT source.standard AS doc, unnest(cross_references) AS t FROM cur), br AS (SELECT doc, count(*) AS n_broken FROM x WHERE t IS NOT NULL AND t NOT IN (SELECT id FROM cur) GROUP BY 1),
    g AS (SELECT source.standard AS doc, count_if(errors <> '') = 0 AS schema, count_if(type = 'text_block' AND contains(lower(coalesce(data.rule, '')), 'shall ')) = 0 AS no_shall_in_text_blocks,
        count_if(type = 'formula') = 0 OR count_if(type = 'formula' AND coalesce(data.expression, '') <> '') / greatest(count_if(type = 'formula'), 1) >= 0.5 AS equations,
        count_if(type = 'formula') = 0 OR count_if(type = 'formula' AND coalesce(cardinality(data.parameters), 0) > 0) / greatest(count_if(type = 'formula'), 1) >= 0.3 AS parameters,
        count_if(type = 'provision') = 0 OR count_if(type = 'provision' AND {_SIZE('data.conditions')} > 0) / greatest(count_if(type = 'provision'), 1) >= 0.15 AS conditions,
        count_if({_SIZE('cross_references')} > 0) > 0 AS cross_references, count_if(type = 'reference') > 0 AS "references", count(DISTINCT CASE WHEN type IN ('heading', 'provision', 'text_block') THEN type END) = 3 AS core_types FROM v GROUP BY 1),
    w AS (SELECT g.*, coalesce(n_broken, 0) = 0 AS broken_references, coalesce(n_symbols, 0) > 10 AS symbols, coalesce(bench.composite >= 0.95, false) AS composite, coalesce(bench.c >= 0.85, false) AS coverage, coalesce(bench.f >= 0.95, false) AS fidelity
        FROM g LEFT JOIN br USING (doc) LEFT JOIN s USING (doc) LEFT JOIN bench USING (doc)),
    ev AS (SELECT * FROM w UNPIVOT (passed FOR "check" IN (schema, no_shall_in_text_blocks, equations, parameters, conditions, cross_references, "references", core_types, broken_references, symbols, composite, coverage, fidelity)))
    SELECT doc, "check", passed FROM ev UNION ALL SELECT doc, 'all', bool_and(passed) FROM ev GROUP BY doc""")
def deploy_gate(spark, d):
    now = current(spark, d).withColumn("doc", F.col("source.standard"))
    x = now.select("doc", F.explode("cross_references").alias("t")).filter("t is not null")
    broken = x.join(now.select(F.col("id").alias("t")), "t", "left_anti").groupBy("doc").agg(_n().alias("n_broken"))
    symbols = now.select("doc", F.explode(F.map_keys("data.parameters")).alias("k")).groupBy("doc").agg(F.count_distinct("k").alias("n_symbols"))
    scores = _benchmark(spark, d).select("doc", _composite().alias("composite"), F.col("c").alias("coverage"), F.col("f").alias("fidelity"))
    checks = Y.gate(now, ["doc"], broken, symbols, scores)
    return checks.unionByName(Y.released(checks, ["doc"]))


_FULL = "CASE " + " ".join(f"WHEN type = '{k}' THEN " + " AND ".join(f"coalesce(len(data.{c}), 0) > 0" if c in ("columns", "rows") else f"trim(coalesce(data.{c}, ''), ' ') <> ''" for c in cs) for k, cs in Y.PAYLOAD.items()) + " ELSE data IS NOT NULL END"
_CHECK = f"""ck AS (SELECT source.standard AS doc, source.chapter AS chapter, count(*) AS n_elements, count_if({_FULL}) AS n_full, count_if(errors = '') AS n_valid, count_if(type = 'text_block') AS n_unclassified,
    sum(coalesce(len(list_filter(cross_references, lambda r: r IS NOT NULL)), 0))::BIGINT AS n_refs,
    sum(coalesce(len(list_filter(cross_references, lambda r: coalesce(try_cast(regexp_extract(r, '^[A-Z0-9]+-\\d+-(\\d+)', 1) AS INT) <> source.chapter, false))), 0))::BIGINT AS n_refs_out FROM v GROUP BY 1, 2)"""


def _checkpoint(spark, d):
    now = current(spark, d).withColumns({"doc": F.col("source.standard"), "chapter": F.col("source.chapter")})
    return Y.checkpoint(now, ["doc", "chapter"], "chapter")


@query(f"{WITH}, {_VALID}, {_CHECK} SELECT * FROM ck")
def checkpoint_chapters(spark, d):
    return _checkpoint(spark, d)


@query(f"""{WITH}, {_VALID}, {_CHECK} SELECT doc, chapter, grouping(doc, chapter)::INT AS level, sum(n_elements)::BIGINT AS n_elements, round(sum(n_full) / sum(n_elements), 4) AS "full", round(sum(n_valid) / sum(n_elements), 4) AS valid,
    round(sum(n_unclassified) / sum(n_elements), 4) AS unclassified, sum(n_refs)::BIGINT AS n_refs, sum(n_refs_out)::BIGINT AS n_refs_out FROM ck GROUP BY ROLLUP (doc, chapter)""")
def checkpoint_overall(spark, d):
    return Y.checkpoint_rollup(_checkpoint(spark, d), ["doc", "chapter"])


@query(f"{WITH} SELECT source.standard AS doc, count(*) AS n, count_if(type = 'text_block') AS n_text_blocks, count_if(type = 'heading') AS n_headings, count_if(type = 'heading' AND length(coalesce(title, '')) < 80) AS n_clean_headings FROM cur GROUP BY 1")
def quality_report(spark, d):
    kind = F.col("type")
    return current(spark, d).groupBy(F.col("source.standard").alias("doc")).agg(
        _n().alias("n"), F.count_if(kind == "text_block").alias("n_text_blocks"), F.count_if(kind == "heading").alias("n_headings"),
        F.count_if((kind == "heading") & (F.length(F.coalesce("title", F.lit(""))) < 80)).alias("n_clean_headings"),
    )


@query(f"{WITH}, {_VALID} SELECT type, id FROM (SELECT *, row_number() OVER (PARTITION BY type ORDER BY (metadata.qc_status IS DISTINCT FROM 'passed')::INT, seq, id) AS k FROM v WHERE errors = '') WHERE k <= 3")
def gold_topk(spark, d):
    return O.draft_gold(current(spark, d)).select("type", "id")


# --- registries --------------------------------------------------------------


_LONG, _SHORT = (rf"{lead}([{R.LETTERS}][{R.LETTERS}0-9{R.MARKS}{inner}]*)\s*$" for lead, inner in ((r"(?:^|\s)", " "), (r"\s", "")))
_SAID = lambda p, last: f"(SELECT CASE WHEN d <> '' AND NOT contains(d, chr(10)) THEN d END FROM (SELECT trim(CASE WHEN {last} THEN {p} WHEN regexp_matches({p}, '{_SHORT}') THEN regexp_replace({p}, '{_SHORT}', '') END, ' ') AS d))"
_UNIT = "trim(regexp_replace(string_split(said, ',')[-1], '\\([^)]+\\)\\s*$', ''), ' ')"
_REGISTRY = f"""
src AS (SELECT doc, section, seq, id, string_split(CASE WHEN given = 'formula' THEN regexp_replace(text, ' \\(.*\\)$', '') ELSE text END, '=') AS parts FROM b),
sg AS (SELECT doc, section, seq, id, i, len(parts) AS n, parts[i] AS p0, parts[i + 1] AS p1, CASE WHEN i > 1 THEN parts[i - 1] END AS pb FROM (SELECT *, unnest(range(1, len(parts))) AS i FROM src)),
sd AS (SELECT *, regexp_replace({_SAID('p1', 'i + 1 = n')}, '\\.?,?$', '') AS said, coalesce(i > 1 AND regexp_matches(pb, '{_LONG}') AND {_SAID('p0', 'false')} IS NOT NULL, false) AS after FROM sg),
sm AS (SELECT doc, section, seq, id, trim(CASE WHEN after THEN regexp_extract(p0, '{_SHORT}', 1) ELSE regexp_extract(p0, '{_LONG}', 1) END, ' ') AS symbol, said, CASE WHEN contains(said, ',') AND {_UNIT} IN ({', '.join(f"'{u}'" for u in R.UNITS)}) THEN {_UNIT} END AS unit FROM sd),
sf AS (SELECT doc, section, seq, id, symbol, trim(CASE WHEN unit IS NOT NULL THEN substring(said, 1, length(said) - length(string_split(said, ',')[-1]) - 1) ELSE said END, ' ') AS description, unit FROM sm),
sk AS (SELECT * FROM sf WHERE symbol <> '' AND length(symbol) <= 15 AND length(description) >= 3 AND lower(symbol) NOT IN ({', '.join(f"'{u}'" for u in R.NO_SYMBOLS)})),
sl AS (SELECT * EXCLUDE r FROM (SELECT *, row_number() OVER (PARTITION BY doc, symbol ORDER BY length(description) DESC, seq, id, description) AS r FROM sk) WHERE r = 1),
sb AS (SELECT * EXCLUDE r FROM (SELECT *, row_number() OVER (PARTITION BY doc, symbol ORDER BY length(description) DESC, description) AS r FROM (SELECT * REPLACE (replace(symbol, ' ', '') AS symbol) FROM sl) x WHERE NOT EXISTS (SELECT 1 FROM sl WHERE sl.doc = x.doc AND sl.symbol = x.symbol)) WHERE r = 1)"""


@query(f"{WITH}, {_REGISTRY} SELECT doc, symbol, description FROM sl UNION ALL SELECT doc, symbol, description FROM sb")
def symbols_registry(spark, d):
    b = blocks(spark, d)
    src = b.withColumn("t", F.when(F.col("given") == "formula", F.regexp_replace("text", r" \(.*\)$", "")).otherwise(F.col("text")))
    found = src.select("doc", "section", "seq", "id", F.inline(R.symbol_definitions(F.col("t"))))
    kept = R.keep_longest(found, ["doc", "symbol"], "description", ["seq", "id", "description"])
    return R.with_aliases(kept, ["doc"]).select("doc", "symbol", "description")


_VARS = f"""SELECT id, doc, w AS symbol FROM (SELECT id, doc, unnest(regexp_extract_all(expression, '[\\p{{L}}\\p{{N}}_]+', 0)) AS w FROM f) WHERE regexp_full_match(w, '[A-Za-z][A-Za-z0-9_]*')
    UNION SELECT id, doc, unnest(regexp_extract_all(expression, '[A-Za-z]+(?:_[A-Za-z0-9]+)?', 0)) FROM f UNION SELECT id, doc, unnest(regexp_extract_all(expression, '[{R.GREEK}]', 0)) FROM f"""
_FORM = "f AS (SELECT id, source.standard AS doc, data.expression AS expression FROM cur WHERE type = 'formula' AND data.expression IS NOT NULL)"


@query(f"{WITH}, {_FORM}, t AS ({_VARS}) SELECT id, string_agg(symbol, ' ' ORDER BY symbol) AS variables FROM t WHERE symbol NOT IN {_IN(R.NO_VARIABLES)} GROUP BY id")
def formula_variables(spark, d):
    f = current(spark, d).filter("type = 'formula' and data.expression is not null")
    return f.select("id", F.array_join(R.variables(F.col("data.expression")), " ").alias("variables")).filter("variables <> ''")


_SYM = "sy AS (SELECT doc, symbol, arg_min(description, rk) AS description, arg_min(unit, rk) AS unit FROM (SELECT *, lpad((1000000 - length(description))::VARCHAR, 8, '0') || o AS rk FROM (SELECT source.standard AS doc, e.key AS symbol, e.value.source AS description, coalesce(e.value.unit, '') AS unit, lpad(seq::VARCHAR, 12, '0') || id AS o FROM (SELECT source, seq, id, unnest(map_entries(data.parameters)) AS e FROM cur)) WHERE description IS NOT NULL) GROUP BY 1, 2)"


def _symbols(spark, d):
    p = current(spark, d).select(F.col("source.standard").alias("doc"), "seq", "id", F.explode("data.parameters").alias("symbol", "v"))
    p = p.select("doc", "symbol", "seq", "id", F.col("v.source").alias("description"), F.coalesce("v.unit", F.lit("")).alias("unit")).filter("description is not null")
    return p


@query(f"{WITH}, {_SYM} SELECT * FROM sy")
def symbol_merge(spark, d):
    return R.keep_longest(_symbols(spark, d), ["doc", "symbol"], "description", ["seq", "id"]).select("doc", "symbol", "description", "unit")


@query(f"{WITH}, {_FORM}, t AS ({_VARS}), {_SYM} SELECT id, t.symbol, description, unit FROM t JOIN sy ON t.doc = sy.doc AND t.symbol = sy.symbol WHERE t.symbol NOT IN {_IN(R.NO_VARIABLES)}")
def resolve_parameters(spark, d):
    f = current(spark, d).filter("type = 'formula' and data.expression is not null").select("id", F.col("source.standard").alias("doc"), F.col("data.expression").alias("expression"))
    return R.resolve_parameters(f, symbol_merge(spark, d), ["doc"])


@query(f"""{WITH}, {_FORM}, va AS ({_VARS}), rw AS (SELECT source.standard AS doc, source.chapter AS chapter, id, type, coalesce(data.rule, data.expression) AS text, row_number() OVER (PARTITION BY source.standard, source.chapter ORDER BY seq, id) AS k FROM cur),
    nb AS (SELECT f.id, r.k, unnest(regexp_extract_all(r.text, '([A-Za-z][A-Za-z0-9_]*)\\s*=\\s*([^,;=]+)', 0)) AS m, generate_subscripts(regexp_extract_all(r.text, '([A-Za-z][A-Za-z0-9_]*)\\s*=\\s*([^,;=]+)', 0), 1) AS j
        FROM rw f JOIN rw r ON f.doc = r.doc AND f.chapter = r.chapter AND r.k BETWEEN f.k - 3 AND f.k + 3 AND r.k <> f.k WHERE f.type = 'formula'),
    nd AS (SELECT id, trim(regexp_extract(m, '([A-Za-z][A-Za-z0-9_]*)\\s*=\\s*([^,;=]+)', 1), ' ') AS symbol, trim(regexp_extract(m, '([A-Za-z][A-Za-z0-9_]*)\\s*=\\s*([^,;=]+)', 2), ' ') AS description, k, j FROM nb)
    SELECT nd.id, nd.symbol, arg_min(nd.description, (k, j)) AS description FROM nd JOIN (SELECT DISTINCT id, symbol FROM va WHERE symbol NOT IN {_IN(R.NO_VARIABLES)}) v ON v.id = nd.id AND v.symbol = nd.symbol WHERE length(nd.description) > 3 GROUP BY 1, 2""")
def nearby_definitions(spark, d):
    c = current(spark, d).select(F.col("source.standard").alias("doc"), F.col("source.chapter").alias("chapter"), "seq", "id", "type", F.col("data.expression").alias("expression"), F.coalesce("data.rule", "data.expression").alias("text"))
    return R.nearby_definitions(c, DOC, ORDER)


@query(f"{WITH}, p AS (SELECT source.standard AS doc, e.key AS symbol, e.value.unit AS u FROM (SELECT source, unnest(map_entries(data.parameters)) AS e FROM cur)) SELECT doc, symbol, count(DISTINCT u) AS n_descriptions FROM p GROUP BY 1, 2 HAVING count(DISTINCT u) > 1")
def symbol_conflicts(spark, d):
    p = current(spark, d).select(F.col("source.standard").alias("doc"), F.explode("data.parameters").alias("symbol", "v"))
    return R.symbol_conflicts(p.select("doc", "symbol", F.col("v.unit").alias("description")), ["doc"])


_NUMS = lambda t, p: f"coalesce(string_agg(DISTINCT CASE WHEN type = '{t}' THEN nullif(regexp_extract(source.citation, '{p}', 1), '') END, ',' ORDER BY CASE WHEN type = '{t}' THEN nullif(regexp_extract(source.citation, '{p}', 1), '') END), '')"
_MAN = f"SELECT source.standard AS doc, source.chapter AS chapter, count(*) AS n_elements, count(DISTINCT source.section) AS n_sections, {_NUMS('table', r'(\d+\.\d+-\d+)')} AS tables, {_NUMS('figure', r'(\d+\.\d+-\d+[A-D]?)')} AS figures, {_NUMS('formula', r'(\d+\.\d+-\d+[a-z]?)')} AS equations FROM cur GROUP BY 1, 2"


def _manifest(spark, d):
    c = current(spark, d).select(F.col("source.standard").alias("doc"), F.col("source.chapter").alias("chapter"), "type", F.col("source.section").alias("section"), F.col("source.citation").alias("citation"))
    return R.manifest(c, ["doc", "chapter"])


@query(f"{WITH} {_MAN}")
def manifest_entries(spark, d):
    return _manifest(spark, d)


@query("SELECT user_id, event_type, arg_max(value, (ts, event_id)) AS value, max((ts, event_id))[2] AS event_id FROM events GROUP BY 1, 2")
def upsert_latest(spark, d):
    return R.keep_latest(table(spark, d, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "value", "event_id")


@query(f"""{WITH}, {_VALID}, c0 AS (SELECT source.standard AS doc, source.chapter AS chapter, count_if(errors <> '') = 0 AS passed, count(*) AS n_elements FROM v GROUP BY ALL),
    bad AS (SELECT DISTINCT standard AS doc, chapter FROM raw_records WHERE NOT coalesce(json_valid(payload), false)), c AS (SELECT c0.*, CASE WHEN bad.doc IS NOT NULL THEN 'unreadable' END AS error FROM c0 LEFT JOIN bad USING (doc, chapter))
    SELECT count_if(error IS NULL AND passed) AS n_passed, count_if(error IS NULL AND NOT passed) AS n_failed, count(error) AS n_errors, sum(n_elements)::BIGINT AS n_elements FROM c""")
def batch_summary(spark, d):
    """Chapters with a delivery that can't be read count as errors."""
    bad = readable(table(spark, d, "raw_records")).filter("not readable").select(F.col("standard").alias("doc"), "chapter", F.lit("unreadable").alias("error")).distinct()
    c = validate_chapter(spark, d).join(bad, ["doc", "chapter"], "left")
    return R.batch_summary(c.select((F.col("failed") == 0).alias("passed"), "error", F.col("total").alias("n_elements")))


@query(f"{WITH} SELECT id, {' AND '.join(f'coalesce({_CHECKS[c]}, false)' for c in ('id', 'type', 'source', 'title'))} AND data IS NOT NULL AND metadata.extracted_by IS NOT NULL AND metadata.qc_status IS NOT NULL AS ok FROM cur")
def light_validation(spark, d):
    return Y.light(current(spark, d)).select("id", "ok")


@query(f"""{WITH}, {_FOUND}, {_TRUTH}, u AS (SELECT coalesce(t.doc, f.doc) AS doc, coalesce(t.kind, f.kind) AS kind, t.num AS t, f.num AS f FROM truth t FULL JOIN found f ON t.doc = f.doc AND t.kind = f.kind AND t.num = f.num WHERE t.num IS NULL OR f.num IS NULL)
    SELECT doc, kind, coalesce(string_agg(t, ',' ORDER BY t), '') AS missing, coalesce(string_agg(f, ',' ORDER BY f), '') AS extra FROM u GROUP BY 1, 2""")
def coverage_lists(spark, d):
    found = Y.coverage_lists(_truth(spark, d), _found(spark, d), ["doc"])
    return found.select("doc", "kind", F.array_join("missing", ",").alias("missing"), F.array_join("extra", ",").alias("extra"))


@query(f"{WITH}, {_FOUND}, {_TRUTH} SELECT coalesce(t.doc, f.doc) AS doc, round(count_if(t.doc IS NOT NULL AND f.doc IS NOT NULL) / greatest(count(t.doc), 1), 4) AS score FROM truth t FULL JOIN found f ON t.doc = f.doc AND t.kind = f.kind AND t.num = f.num GROUP BY 1")
def coverage_overall(spark, d):
    return Y.overall(Y.coverage(_truth(spark, d), _found(spark, d), ["doc"]), ["doc"])


@query(f"{WITH}, v AS (SELECT id, unnest(map_values(r)) AS c FROM (SELECT id, unnest(data.rows) AS r FROM cur)) SELECT id, CASE WHEN contains(c, '.') AND regexp_matches(trim(c, ' '), '^[+-]?\\d+(?:\\.\\d*)?$') THEN 'number' WHEN regexp_matches(trim(c, ' '), '^[+-]?\\d{{1,18}}$') THEN 'integer' ELSE 'text' END AS kind, count(*) AS n FROM v WHERE c IS NOT NULL GROUP BY 1, 2")
def cell_kinds(spark, d):
    v = current(spark, d).select("id", F.explode("data.rows").alias("r")).select("id", F.explode(F.map_values("r")).alias("c")).filter("c is not null").withColumn("v", T.cell_value(F.col("c")))
    kind = F.when(F.col("v.number").isNotNull(), "number").when(F.col("v.integer").isNotNull(), "integer").otherwise("text")
    return v.groupBy("id", kind.alias("kind")).agg(_n().alias("n"))


# --- tables and places -------------------------------------------------------


@query(f"""{WITH}, t AS (SELECT id, unnest(data.rows) AS r, generate_subscripts(data.rows, 1) AS row, list_transform(data.columns, lambda c: c.name) AS names FROM cur WHERE type = 'table' AND data.rows IS NOT NULL),
    c AS (SELECT id, row, n, coalesce(r[n], '') AS v FROM (SELECT id, row, r, unnest(list_distinct(names)) AS n FROM t)) SELECT id, row::INT AS row, string_agg(n || '=' || v, '|' ORDER BY n) AS cells FROM c GROUP BY 1, 2""")
def cells_to_table(spark, d):
    t = current(spark, d).filter("type = 'table' and data.rows is not null and size(data.columns) > 0")
    head = t.select("id", F.lit(0).alias("row"), F.posexplode("data.columns").alias("col", "c")).select("id", "row", "col", F.col("c.name").alias("text"))
    body = t.select("id", "data.columns", F.posexplode("data.rows").alias("row", "r")).select("id", (F.col("row") + 1).alias("row"), F.posexplode("columns").alias("col", "c"), "r")
    cells = head.unionByName(body.select("id", "row", "col", F.coalesce(F.element_at("r", F.col("c.name")), F.lit("")).alias("text")))
    rows = B.cells_to_rows(cells, ["id"])
    pairs = F.array_sort(F.transform(F.map_entries("cells"), lambda e: F.struct(e["key"].alias("k"), e["value"].alias("v"))))
    return rows.select("id", "row", F.array_join(F.transform(pairs, lambda p: F.concat(p["k"], F.lit("="), p["v"])), "|").alias("cells"))


@query(f"{WITH}, v AS (SELECT id, unnest(map_values(r)) AS c FROM (SELECT id, unnest(data.rows) AS r FROM cur)) SELECT id, count(*) AS n_cells, count(CASE WHEN regexp_matches(trim(c, ' '), '^[+-]?\\d+(?:\\.\\d*)?$') THEN 1 END) AS n_numbers, sum(CASE WHEN regexp_matches(trim(c, ' '), '^[+-]?\\d+$') THEN CAST(trim(c, ' ') AS DOUBLE) END) AS sum_integers FROM v GROUP BY id")
def parse_number_cells(spark, d):
    v = current(spark, d).select("id", F.explode("data.rows").alias("r")).select("id", F.explode(F.map_values("r")).alias("c"))
    num = T.number_cell(F.col("c"))
    return v.groupBy("id").agg(_n().alias("n_cells"), F.count(num).alias("n_numbers"), F.sum(F.when(~F.contains("c", F.lit(".")), num)).alias("sum_integers"))


@query(f"""{WITH}, p AS (SELECT doc, chapter, page, arg_min(text, lpad(seq::VARCHAR, 12, '0') || id) AS caption FROM b WHERE regexp_matches(text, '^Table\\s+\\d+\\.\\d+-\\d+') GROUP BY 1, 2, 3)
    SELECT b.id, p.caption FROM b LEFT JOIN p USING (doc, chapter, page) WHERE given = 'table'""")
def table_captions(spark, d):
    b = blocks(spark, d)
    texts = b.select("doc", "chapter", "page", "text", F.struct("seq", "id").alias("seq"))
    return B.captions(b.filter("given = 'table'").select("doc", "chapter", "page", "id"), texts, ["doc", "chapter", "page"]).select("id", "caption")


@query("""WITH l AS (SELECT event_id, user_id, epoch(ts) / 60 AS t FROM events WHERE event_type = 'click'), r AS (SELECT event_id AS rid, user_id, epoch(ts) / 60 AS t FROM events WHERE event_type <> 'click')
    SELECT l.event_id, arg_min(rid, (abs(l.t - r.t), rid)) AS near_id FROM l LEFT JOIN r ON l.user_id = r.user_id AND abs(l.t - r.t) < 600 GROUP BY 1""")
def nearest_span_asof(spark, d):
    e = table(spark, d, "events").withColumn("t", F.unix_micros(F.col("ts").cast("timestamp")) / 60e6)
    left = e.filter("event_type = 'click'").select("user_id", "event_id", "t")
    right = e.filter("event_type <> 'click'").select("user_id", F.col("event_id").alias("near_id"), "t")
    return G.nearest(left, right, ["user_id"], "t", "event_id", ["near_id"], 600.0, ["near_id"]).select("event_id", "near_id")


# Boxes and points on pages made of whole numbers of the line items: a page is a part.
_BOX = "SELECT l_partkey AS page, l_orderkey * 10 + l_linenumber AS box, l_quantity * 10 AS l, l_linenumber * 90 AS t, l_quantity * 10 + 60 + l_suppkey % 40 AS r, l_linenumber * 90 + 70 AS b, l_orderkey % 2 AS side FROM lineitem"
_POINT = "SELECT l_partkey AS page, l_orderkey * 10 + l_linenumber AS point, (l_suppkey * 37) % 600 AS x, (l_orderkey * 13) % 700 AS y FROM lineitem"


def _boxes(spark, d):
    li = table(spark, d, "lineitem")
    return li.selectExpr("l_partkey as page", "l_orderkey * 10 + l_linenumber as box", "l_quantity * 10 as l", "l_linenumber * 90 as t", "l_quantity * 10 + 60 + l_suppkey % 40 as r", "l_linenumber * 90 + 70 as b", "l_orderkey % 2 as side")


@query(f"WITH bx AS ({_BOX}), pt AS ({_POINT}) SELECT box, count(*) AS n_points FROM bx JOIN pt USING (page) WHERE x BETWEEN l - 8 AND r + 8 AND y BETWEEN t - 8 AND b + 8 GROUP BY box")
def box_containment(spark, d):
    pt = table(spark, d, "lineitem").selectExpr("l_partkey as page", "(l_suppkey * 37) % 600 as x", "(l_orderkey * 13) % 700 as y")
    return G.contained(pt, _boxes(spark, d), ["page"], "x", "y", 8.0).groupBy("box").agg(_n().alias("n_points"))


@query(f"""WITH bx AS ({_BOX}), g AS (SELECT * FROM bx WHERE side = 0), k AS (SELECT * FROM bx WHERE side = 1),
    o AS (SELECT page, g.box AS region_id, k.box AS known_id, greatest(least(g.r, k.r) - greatest(g.l, k.l), 0) * greatest(least(g.b, k.b) - greatest(g.t, k.t), 0) AS ov, (g.r - g.l) * (g.b - g.t) AS a FROM g JOIN k USING (page))
    SELECT page, region_id, arg_min(known_id, (-ov, known_id)) AS known_id FROM o WHERE ov > 0.2 * a GROUP BY page, region_id""")
def region_enrich(spark, d):
    b = _boxes(spark, d)
    return G.most_overlapping(b.filter("side = 0").withColumnRenamed("box", "region_id"), b.filter("side = 1").withColumnRenamed("box", "known_id"), ["page"])


@query()  # greedy, one after the other: tested against brute force
def iou_match(spark, d):
    b = _boxes(spark, d).select("page", F.col("box").alias("n"), (F.col("box") % 3).cast("string").alias("kind"), "l", "t", "r", "b", "side")
    return G.greedy_matches(b.filter("side = 0"), b.filter("side = 1"), "page")


@query(f"WITH bx AS ({_BOX}) SELECT box, least(1, greatest(0, (l + r) / 2 / 600)) AS cx, least(1, greatest(0, (t + b) / 2 / 800)) AS cy, least(1, greatest(0, (r - l) / 600)) AS w, least(1, greatest(0, (b - t) / 800)) AS h FROM bx")
def normalized_boxes(spark, d):
    return _boxes(spark, d).select("box", *G.normalized_box(F.lit(600.0), F.lit(800.0)))


@query(f"WITH bx AS ({_BOX}), o AS (SELECT *, CASE WHEN t - lag(b) OVER (PARTITION BY page ORDER BY t, box) > 3 THEN 1 ELSE 0 END AS s FROM bx), i AS (SELECT *, sum(s) OVER (PARTITION BY page ORDER BY t, box) + 1 AS island FROM o) SELECT page, island::BIGINT AS block, count(*) AS n, min(l) AS l, max(r) AS r, min(t) AS t, max(b) AS b FROM i GROUP BY 1, 2")
def lines_to_blocks(spark, d):
    i = S.gap_islands(_boxes(spark, d), ["page"], ["t", "box"], "t", "b", 3, "block")
    return i.groupBy("page", "block").agg(_n().alias("n"), F.min("l").alias("l"), F.max("r").alias("r"), F.min("t").alias("t"), F.max("b").alias("b"))


def _chars(spark, d):
    return _boxes(spark, d).select("page", "box", F.col("l").cast("double").alias("x0"), (F.col("l") + 8).cast("double").alias("x1"), (F.col("t") + F.col("box") % 3).cast("double").alias("top"), (F.col("box") % 10).cast("string").alias("text"), (F.col("box") % 4 != 0).alias("bold"), F.lit(600).alias("width"))


@query(f"WITH bx AS ({_BOX}), c AS (SELECT page, t, box, l AS x0, l + 8 AS x1, (box % 10)::VARCHAR AS x FROM bx), g AS (SELECT *, CASE WHEN x0 - lag(x1) OVER (PARTITION BY page, t ORDER BY x0, box) > 1.5 THEN ' ' ELSE '' END || x AS y FROM c) SELECT page, t, string_agg(y, '' ORDER BY x0, box) AS line FROM g GROUP BY 1, 2")
def spaced_lines(spark, d):
    c = _boxes(spark, d).selectExpr("page", "t", "box", "l as x0", "l + 8 as x1", "cast(box % 10 as string) as text")
    return S.spaced_text(c, ["page", "t"], ["x0", "box"])


@query(f"WITH bx AS ({_BOX}) SELECT page, t AS line, count(*) AS n, min(l) AS x0, max(r) AS x1, avg(l_linenumber) AS size, bool_or(side = 1) AS any_bold, bool_and(side = 1) AS all_bold FROM (SELECT *, t / 90 AS l_linenumber FROM bx) GROUP BY 1, 2")
def block_boxes(spark, d):
    c = _boxes(spark, d).select("page", F.col("t").alias("line"), F.col("l").alias("x0"), F.col("r").alias("x1"), F.col("t").alias("top"), F.col("b").alias("bottom"), (F.col("t") / 90).alias("size"), (F.col("side") == 1).alias("bold"))
    return G.block_boxes(c, ["page", "line"]).drop("top", "bottom")


@query()  # follows the greedy matching
def match_scores(spark, d):
    return G.match_scores(iou_match(spark, d))


@query("SELECT floor(l_quantity / 10)::BIGINT AS bin, l_linestatus AS kind, count(*) AS n FROM lineitem GROUP BY 1, 2")
def size_histogram(spark, d):
    return table(spark, d, "lineitem").groupBy(F.floor(F.col("l_quantity") / 10).alias("bin"), F.col("l_linestatus").alias("kind")).agg(_n().alias("n"))


QUERIES = Q
