"""Queries of the row emitters, the pipelines and the reports on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataq.functions import text as T
from strataq.operators import classify as C
from strataq.operators import emit as E
from strataq.operators import gold as O
from strataq.operators import link as L
from strataq.operators import quality as Y
from strataq.operators import sequence as S
from strataq.operators.current import current_rows
from strataq.plans import pipeline
from strataq.plans.corpus import CUR, WITH, blocks, current
from strataq.plans.quality_queries import _BENCH, _VALID, _benchmark, _composite, completeness, deploy_gate
from strataq.plans.text_queries import _DEF, _FILL, _IS_DEF, _JOIN, _KEY, _LETTER, _phrase, _sql_replaced, DOC, KIND, ORDER, PATTERNS, _classified
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


def _fixed(c: str) -> str:
    return f"trim(regexp_replace(regexp_replace({_sql_replaced(c, T.LIGATURES | T.ENTITIES)}, {_JOIN}), '[\\s\\p{{Z}}]+', ' ', 'g'))"


_ORDER = "lpad(seq::VARCHAR, 12, '0') || id"
_SUB = r"^(.+?\.)\s*(.*)"
_PAYLOAD = f"""CASE WHEN kind NOT IN ('definition', 'reference') THEN text END AS rule,
    CASE WHEN kind = 'definition' THEN CASE WHEN regexp_matches(text, '{_DEF}', 's') THEN trim(regexp_extract(text, '{_DEF}', 1, 's')) WHEN note = 'sub_definition' AND regexp_matches(text, '{_SUB}', 's') THEN trim(regexp_extract(text, '{_SUB}', 1, 's')) ELSE substring(text, 1, 50) END END AS term,
    CASE WHEN kind = 'definition' THEN CASE WHEN regexp_matches(text, '{_DEF}', 's') THEN trim(regexp_extract(text, '{_DEF}', 2, 's')) WHEN note = 'sub_definition' AND regexp_matches(text, '{_SUB}', 's') THEN trim(regexp_extract(text, '{_SUB}', 2, 's')) ELSE text END END AS definition,
    CASE WHEN kind = 'reference' THEN text END AS target"""


# --- element rows -------------------------------------------------------------


@query(f"{WITH}, {PATTERNS}, {KIND} SELECT id, kind, CASE WHEN kind = 'heading' THEN text ELSE substring(text, 1, 200) END AS title, {_PAYLOAD} FROM k")
def element_payloads(spark, d):
    k = _classified(spark, d)
    title = F.when(F.col("kind") == "heading", F.col("text")).otherwise(E.titled(F.col("text")))
    return k.select("id", "kind", title.alias("title"), E.payload(F.col("kind"), F.col("note"), F.col("text")).alias("p")).select("id", "kind", "title", "p.*")


# A parser that doesn't see the line end gives a heading and the block after it as one, the heading in bold.
@query(f"""{WITH}, h AS (SELECT id, given, text AS bold, coalesce(lead(text) OVER (PARTITION BY doc, chapter ORDER BY seq, id), '') AS body FROM b QUALIFY given = 'heading'),
    c AS (SELECT id, trim(bold) AS head, trim(body) AS body, bold || ' ' || body AS whole, length(bold) > 3 AND length(bold || ' ' || body) > length(bold) + 10 AS cut FROM h)
    SELECT id, 0 AS part, 'heading' AS type, CASE WHEN cut THEN head ELSE whole END AS title, CASE WHEN cut THEN head ELSE whole END AS rule, NULL::VARCHAR AS parent_id, NULL::VARCHAR AS note FROM c
    UNION ALL SELECT id, 1, 'text_block', substring(body, 1, 200), body, id, 'split_from_heading' FROM c WHERE cut AND length(body) > 5""")
def heading_rows(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy(*DOC).orderBy(*ORDER)
    h = blocks(spark, d).withColumn("bold", F.col("text")).withColumn("text", F.concat_ws(" ", "text", F.coalesce(F.lead("text").over(w), F.lit("")))).filter("given = 'heading'")
    return E.heading_rows(h)


_FAMILIES = ("NOVUM", "BRIM", "ORLA", "TESK", *C.REFERENCE_FAMILIES)


@query(f"""{WITH}, x AS (SELECT source.standard AS doc, source.chapter AS chapter, seq, id, {_fixed('data.target')} AS target FROM ({CUR.format(t='elements_b')}) WHERE regexp_matches(coalesce(data.target, ''), '^(?:{'|'.join(_FAMILIES)})(?:[^\\p{{L}}\\p{{N}}_]|$)')),
    n AS (SELECT *, row_number() OVER (PARTITION BY doc, substring(target, 1, 20) ORDER BY chapter, seq, id) AS r FROM x
        WHERE NOT EXISTS (SELECT 1 FROM cur WHERE source.standard = x.doc AND substring(data.target, 1, 20) = substring(x.target, 1, 20)))
    SELECT doc, chapter, seq, id, trim(split_part(target, ',', 1)) AS citation, target FROM n WHERE r = 1""")
def reference_rows(spark, d):
    """What the other run names and this one doesn't hold."""
    b = current(spark, d, "elements_b").select(F.col("source.standard").alias("doc"), F.col("source.chapter").alias("chapter"), "seq", "id", F.coalesce("data.target", F.lit("")).alias("text"))
    known = current(spark, d).filter("data.target is not null").select(F.col("source.standard").alias("doc"), F.col("data.target").alias("target"))
    return E.reference_rows(b, known, ["doc"], ["chapter", *ORDER], _FAMILIES)


@query(f"""{WITH}, p AS (SELECT doc, chapter, page, arg_min(text, {_ORDER}) AS caption FROM b WHERE regexp_matches(text, 'Table\\s+\\d+\\.\\d+-\\d+') GROUP BY 1, 2, 3),
    t AS (SELECT b.id, b.chapter, caption, nullif(regexp_extract(caption, 'Table\\s+(\\d+\\.\\d+-\\d+)', 1), '') AS num FROM b LEFT JOIN p USING (doc, chapter, page) WHERE given = 'table')
    SELECT id, coalesce({_fixed('substring(caption, 1, 200)')}, 'Table') AS title, coalesce('Table ' || num, '') AS citation, coalesce(regexp_replace(num, '-\\d+[A-Da-d]?$', ''), chapter::VARCHAR) AS section FROM t""")
def table_rows(spark, d):
    b = blocks(spark, d)
    tables = b.filter("given = 'table'").select("doc", "chapter", "page", "id")
    return E.table_rows(tables, b, ["doc", "chapter", "page"], ORDER).select("id", "title", "citation", "section")


_FIG = r"Figure\s+([\d.]+-\d+[A-D]?)"


@query(f"""{WITH}, l AS (SELECT doc, chapter, page, seq, id, given, text, nullif(regexp_extract(text, '{_FIG}', 1), '') AS num FROM b),
    u AS (SELECT *, 0 AS rank FROM l WHERE given = 'figure' UNION ALL SELECT *, 1 FROM l WHERE (doc, chapter, page) IN (SELECT (doc, chapter, page) FROM b WHERE given = 'figure')),
    f AS (SELECT *, row_number() OVER (PARTITION BY doc, chapter, num ORDER BY rank, page, seq, id) AS r FROM u WHERE num IS NOT NULL)
    SELECT doc, chapter, num, regexp_replace(num, '-\\d+[A-Da-d]?$', '') AS section, 'Figure ' || num AS citation, page, substring({_fixed('text')}, 1, 200) AS title FROM f WHERE r = 1""")
def figure_rows(spark, d):
    b = blocks(spark, d)
    bold = b.filter("given = 'figure'")
    return E.figure_rows(bold, bold, b, DOC, "page", ORDER)


_LABEL = lambda kind, p, q: f"""SELECT doc, chapter, '{kind}' AS kind, num, seq, id, caption FROM (SELECT doc, chapter, seq, id, text AS caption, nullif(regexp_extract(text, '{p}', 1), '') AS num,
    row_number() OVER (PARTITION BY doc, chapter, nullif(regexp_extract(text, '{p}', 1), '') ORDER BY seq, id) AS r FROM b) l WHERE r = 1 AND num IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM cur WHERE type = '{kind}' AND source.standard = l.doc AND source.chapter = l.chapter AND regexp_extract(source.citation, '{q}', 1) = l.num)"""  # noqa: E731


@query(f"""{WITH}, m AS ({_LABEL('table', E.LABELS['table'], r'([\d.]+-\d+)')} UNION ALL {_LABEL('figure', E.LABELS['figure'], r'([\d.]+-\d+[A-D]?)')})
    SELECT doc, chapter, kind, num, regexp_replace(num, '-\\d+[A-Da-d]?$', '') AS section, seq, id, caption FROM m""")
def missing_labels(spark, d):
    held = current(spark, d).select(F.col("source.standard").alias("doc"), F.col("source.chapter").alias("chapter"), "type", F.col("source.citation").alias("citation"))
    return E.missing_labels(blocks(spark, d), held, DOC, ORDER)


_MARK = r"(\((\d+)\.\d+-\d+[a-z]?(?:\.SI)?\))"


def _equations(rows: str, keys: str, text: str) -> str:
    """SQL: one row a numbered equation of a text, with its place, number, chapter and expression."""
    return f"""(SELECT {keys}, nth, regexp_extract(num, '\\((.+)\\)', 1) AS num, regexp_extract(num, '{_MARK}', 2) AS eq_chapter, trim(substring(upto, greatest(CASE WHEN instr(head, '. ') = 0 AND instr(head, ';') = 0 THEN 0
            ELSE greatest(length(head) - length(string_split(head, '. ')[-1]) - 1, length(head) - length(string_split(head, ';')[-1])) END, length(upto) - length(num) - 200, 0) + 1)) AS expression
        FROM (SELECT *, replace(before, chr(1), '') AS upto, string_split(before, chr(1))[-1] AS num, rtrim(substring(replace(before, chr(1), ''), 1, length(replace(before, chr(1), '')) - length(string_split(before, chr(1))[-1])), ' ') AS head
        FROM (SELECT {keys}, nth, array_to_string(parts[1:nth], '') AS before FROM (SELECT {keys}, parts, unnest(range(1, len(parts))) AS nth
        FROM (SELECT {keys}, string_split(regexp_replace({text}, '{_MARK}', chr(1) || '\\1' || chr(2), 'g'), chr(2)) AS parts FROM {rows})))))"""


@query(f"{WITH} SELECT doc, chapter AS of_chapter, seq, id, num, eq_chapter AS chapter, expression FROM {_equations('b', 'doc, chapter, seq, id', 'text')}")
def equation_rows(spark, d):
    rows = blocks(spark, d).select("doc", F.col("chapter").alias("of_chapter"), "seq", "id", F.inline(T.equations(F.col("text"))))
    return rows.select("doc", "of_chapter", "seq", "id", "num", "chapter", "expression")


@query(f"""{WITH}, e AS (SELECT * FROM {_equations('b', 'doc, chapter, seq, id', 'text')} WHERE eq_chapter = chapter::VARCHAR)
    SELECT doc, chapter, num, seq, id, regexp_replace(num, '-\\d+[A-Da-d]?$', '') AS section, expression FROM (SELECT *, row_number() OVER (PARTITION BY doc, chapter, num ORDER BY seq, id, nth) AS r FROM e) WHERE r = 1 AND length(expression) >= 5""")
def text_equations(spark, d):
    return E.text_equations(blocks(spark, d), DOC, ORDER)


_PAGE = f"""pg AS (SELECT source.standard AS doc, source.chapter AS chapter, source.page AS page, string_agg(coalesce(nullif(data.rule, ''), nullif(data.expression, ''), '') || ' ' || replace(coalesce(source.citation, ''), 'Eq. ', ''), chr(10) ORDER BY seq, id) AS page_text
    FROM ({CUR.format(t='elements_b')}) WHERE source.page IS NOT NULL GROUP BY 1, 2, 3)"""


def _pages(spark, d):
    """The pages of the other run: what a parser reads from each."""
    said = F.concat(T.first_filled(F.col("data.rule"), F.col("data.expression")), F.lit(" "), F.replace(F.coalesce("source.citation", F.lit("")), F.lit("Eq. "), F.lit("")))
    rows = current(spark, d, "elements_b").filter("source.page is not null").select(F.col("source.standard").alias("doc"), F.col("source.chapter").alias("chapter"), F.col("source.page").alias("page"), F.struct("seq", "id", said.alias("t")).alias("x"))
    return rows.groupBy("doc", "chapter", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["t"]), "\n").alias("page_text"))


@query(f"""{WITH}, {_PAGE}, ln AS (SELECT doc, chapter, page, unnest(string_split(page_text, chr(10))) AS t, generate_subscripts(string_split(page_text, chr(10)), 1) AS line FROM pg),
    e AS (SELECT * FROM {_equations('ln', 'doc, chapter, page, line', 't')} WHERE starts_with(num, chapter::VARCHAR || '.') AND NOT ends_with(num, '.SI')),
    f AS (SELECT *, row_number() OVER (PARTITION BY doc, chapter, num ORDER BY page, line, nth) AS r FROM e WHERE NOT EXISTS (SELECT 1 FROM cur WHERE type = 'formula' AND source.standard = e.doc AND source.chapter = e.chapter AND regexp_extract(source.citation, '(\\d+\\.\\d+-\\d+[a-z]?)', 1) = e.num)),
    x AS (SELECT doc, chapter, num, page, regexp_replace({_sql_replaced('expression', T.LIGATURES)}, '\\s+', ' ', 'g') AS expression FROM f WHERE r = 1)
    SELECT * FROM x WHERE length(expression) >= 5 AND NOT (NOT regexp_matches(expression, '[=<>≤≥+\\-*/^√∑]') AND len(regexp_extract_all(lower(expression), '\\b(?:shall|determined|using|accordance|permitted|including|satisfy)\\b')) >= 2)""")
def page_equations(spark, d):
    num = F.nullif(F.regexp_extract("source.citation", r"(\d+\.\d+-\d+[a-z]?)", 1), F.lit(""))
    known = current(spark, d).filter("type = 'formula'").select(F.col("source.standard").alias("doc"), F.col("source.chapter").alias("chapter"), num.alias("num")).filter("num is not null")
    return E.page_equations(_pages(spark, d), known, DOC, "page")


# --- pipelines ----------------------------------------------------------------

_ELEMENTS = f"""{PATTERNS}, {KIND}, {_FILL},
    i AS (SELECT *, replace(doc, ' ', '') || '-' || in_section || '-' || l || row_number() OVER (PARTITION BY doc, chapter, in_section, l ORDER BY seq, id) AS new_id FROM (SELECT *, {_LETTER} AS l FROM f)),
    dd AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc, chapter, kind, in_section, substring(text, 1, 200) ORDER BY seq, id) AS r FROM i) WHERE r = 1 OR length(text) = 0),
    el AS (SELECT doc, chapter, seq, id, new_id, kind, in_section AS section, CASE WHEN kind = 'heading' THEN text ELSE substring(text, 1, 200) END AS title, {_PAYLOAD}, text FROM dd WHERE kind IN ('table', 'figure', 'heading') OR length(text) >= 5)"""


@query(f"{WITH}, {_ELEMENTS} SELECT new_id, kind, section, title, rule, term, definition, target FROM el")
def extract_elements(spark, d):
    return pipeline.elements_of(blocks(spark, d)).select("new_id", "kind", "section", "title", "rule", "term", "definition", "target")


_LINKED = " UNION ALL ".join(f"SELECT DISTINCT doc, chapter, new_id, '{k}' AS kind, unnest(regexp_extract_all(text, '{p}', 1)) AS num FROM el" for k, p in T.MENTIONS.items() if k != "chapter")
_CITED = "c AS (SELECT source.standard AS doc, source.chapter AS chapter, type, source.section AS section, source.citation AS citation, id, lpad(seq::VARCHAR, 12, '0') || id AS o FROM cur)"
_NUM = r"nullif(regexp_extract(citation, '(\d+\.\d+-\d+[A-Da-d]?)', 1), '')"


@query(f"""{WITH}, {_ELEMENTS}, {_CITED}, near AS (SELECT doc, chapter, CASE WHEN type = 'formula' THEN 'equation' ELSE type END AS kind, {_NUM} AS num, arg_max(id, o) AS target FROM c WHERE type IN ('table', 'figure', 'formula') AND {_NUM} IS NOT NULL GROUP BY 1, 2, 3, 4),
    far AS (SELECT doc, kind, num, max(target) AS target FROM near GROUP BY 1, 2, 3), lk AS ({_LINKED}),
    r AS (SELECT lk.new_id, coalesce(near.target, far.target) AS target FROM lk LEFT JOIN near ON near.doc = lk.doc AND near.chapter = lk.chapter AND near.kind = lk.kind AND near.num = lk.num LEFT JOIN far ON far.doc = lk.doc AND far.kind = lk.kind AND far.num = lk.num),
    t AS (SELECT new_id, count(DISTINCT target) AS n FROM r WHERE target IS NOT NULL AND target <> new_id GROUP BY 1)
    SELECT doc, chapter, count(*) AS n_elements, count(DISTINCT section) AS n_sections, count_if(kind = 'provision') AS n_provisions, count_if(kind = 'text_block') AS n_text_blocks, coalesce(sum(t.n), 0)::BIGINT AS n_links FROM el LEFT JOIN t USING (new_id) GROUP BY 1, 2""")
def extract_corpus(spark, d):
    """The whole plan, blocks to linked rows, summed up by chapter."""
    cited = current(spark, d).select(F.col("source.standard").alias("doc"), F.col("source.chapter").alias("chapter"), "seq", "id", "type", F.col("source.citation").alias("citation"))
    rows = pipeline.run(blocks(spark, d), L.citation_index(cited, DOC, ORDER))
    kind = F.col("kind")
    return rows.groupBy("doc", "chapter").agg(
        _n().alias("n_elements"), F.count_distinct("section").alias("n_sections"), F.count_if(kind == "provision").alias("n_provisions"),
        F.count_if(kind == "text_block").alias("n_text_blocks"), F.sum(F.coalesce(F.size("targets"), F.lit(0))).alias("n_links"),
    )


_SHORT = f"""CASE WHEN label IN ('section_header', 'title') THEN 'heading' WHEN {_IS_DEF} THEN 'definition' WHEN {_phrase(C.REGULATORY_SHORT)} THEN 'provision' ELSE 'text_block' END"""


@query(f"""{WITH}, k AS (SELECT *, {_SHORT} AS kind, NULL AS note FROM b), {_FILL},
    i AS (SELECT *, row_number() OVER (PARTITION BY doc, chapter, kind, in_section, substring(text, 1, 200) ORDER BY seq, id) AS r FROM f)
    SELECT kind, count(*) AS n, count(DISTINCT doc || in_section) AS n_sections FROM i WHERE (r = 1 OR length(text) = 0) AND (kind = 'heading' OR length(text) >= 5) GROUP BY kind""")
def extract_simple(spark, d):
    """The pipeline with the classifier that knows headings, definitions and provisions only."""
    kind = C.classify_simple(F.col("label"), F.col("text"))
    rows = pipeline.elements_of(blocks(spark, d), pipeline.by_column(kind))
    return rows.groupBy("kind").agg(_n().alias("n"), F.count_distinct(F.concat("doc", "section")).alias("n_sections"))


@query(f"""{WITH}, t AS (SELECT *, length(bold) > 0 AS is_bold, CASE WHEN label = 'section_header' THEN 12 ELSE 10 END AS size, text = upper(text) AND regexp_matches(text, '[A-Za-z]') AS caps FROM b)
    SELECT given, CASE WHEN size > 11 AND is_bold THEN 'heading' WHEN is_bold AND contains(text, ':') AND caps THEN 'definition' WHEN is_bold AND caps AND length(text) < 80 THEN 'heading'
    WHEN starts_with(text, chapter::VARCHAR || '.') OR starts_with(text, 'CHAPTER') THEN 'heading' WHEN is_bold AND contains(text, ':') THEN 'definition' ELSE 'text' END AS kind, count(*) AS n FROM t GROUP BY ALL""")
def classify_lines(spark, d):
    size = F.when(F.col("label") == "section_header", 12).otherwise(10)  # the label tells the size
    kind = C.classify_line(F.col("text"), F.length("bold") > 0, size, F.col("chapter"))
    return blocks(spark, d).groupBy("given", kind.alias("kind")).agg(_n().alias("n"))


# --- reports --------------------------------------------------------------------


@query(f"""{WITH}, h AS (SELECT doc, chapter, arg_min(text, {_ORDER}) AS title FROM b WHERE given = 'heading' GROUP BY 1, 2) SELECT doc, chapter, title FROM h WHERE chapter IN (1, 2, 3, 4, 5, 6, 7, 8) AND NOT contains(title, 'RESERVED')""")
def kept_chapters(spark, d):
    h = blocks(spark, d).filter("given = 'heading'").groupBy(*DOC).agg(F.min_by("text", F.struct(*ORDER)).alias("title"))
    return E.kept_chapters(h, list(range(1, 9)))


@query("SELECT doc_id, length(coalesce(text, ''))::BIGINT AS n_chars, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\n\\t\\r]+'), lambda x: x <> ''))::BIGINT AS n_words, len(list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x, ' ') <> ''))::BIGINT AS n_lines FROM documents")
def page_stats(spark, d):
    return E.page_stats(table(spark, d, "documents"), "doc_id")


@query(f"{WITH} SELECT doc, chapter, page, count(DISTINCT given) * 10 + count(*) AS score FROM b GROUP BY 1, 2, 3 ORDER BY score DESC, doc DESC, chapter::VARCHAR DESC, page::VARCHAR DESC LIMIT 3")
def richest_pages(spark, d):
    return E.richest_pages(blocks(spark, d), ["doc", "chapter", "page"], "given")


@query(f"{WITH} SELECT type, count(*) AS n FROM cur GROUP BY type ORDER BY n DESC, type LIMIT 6")
def commonest_types(spark, d):
    return current(spark, d).groupBy("type").agg(_n().alias("n")).orderBy(F.desc("n"), "type").limit(6)


@query("SELECT coalesce((SELECT min(source.page) FROM elements) - (SELECT min(data.source_pdf_page) FROM elements_b), 0)::INT AS \"offset\"")
def page_offset(spark, d):
    images = table(spark, d, "elements_b").select(F.col("data.source_pdf_page").alias("index"))
    return E.page_offset(table(spark, d, "elements").select(F.col("source.page").alias("page")), images)


@query(f"""{WITH}, g AS (SELECT source.standard AS doc, source.chapter AS chapter, source.page AS page, bool_and(metadata.qc_status = 'pending') AS predicted, count(*) AS n_regions FROM cur GROUP BY 1, 2, 3)
    SELECT doc, chapter, page, n_regions FROM g WHERE NOT coalesce(predicted, false) AND EXISTS (SELECT 1 FROM elements_b e WHERE e.source.standard = g.doc AND e.source.chapter = g.chapter AND e.source.page = g.page)""")
def labelled_pages(spark, d):
    place = [F.col(f"source.{c}").alias(n) for c, n in (("standard", "doc"), ("chapter", "chapter"), ("page", "page"))]
    now = current(spark, d).select(*place, "metadata.qc_status")
    g = now.groupBy("doc", "chapter", "page").agg(F.bool_and(F.col("qc_status") == "pending").alias("predicted"), _n().alias("n_regions"))
    return E.labelled_pages(g, table(spark, d, "elements_b").select(*place), ["doc", "chapter", "page"]).drop("predicted")


@query(f"""{WITH} SELECT id, array_to_string(list_transform(data.columns[1:7], lambda c: coalesce(c.name, '')), '|') AS columns, array_to_string(list_transform(data.rows[1:4], lambda r: array_to_string(list_transform(data.columns[1:7], lambda c: coalesce(r[coalesce(c.name, '')], '')), '|')), '/') AS rows
    FROM cur WHERE type = 'table' AND data.columns IS NOT NULL AND data.rows IS NOT NULL""")
def table_preview(spark, d):
    t = E.preview(current(spark, d).filter("type = 'table' and data.columns is not null and data.rows is not null"))
    return t.select("id", F.array_join("columns", "|").alias("columns"), F.array_join(F.transform("rows", lambda r: F.array_join(r, "|")), "/").alias("rows"))


@query(f"""{WITH}, {_VALID}, {_BENCH}, u AS (SELECT source.standard AS doc, count_if(type = 'text_block') / count(*) AS unclassified, count_if(errors <> '') = 0 AS passed FROM v GROUP BY 1)
    SELECT u.doc, CASE WHEN passed THEN 'pass' WHEN coalesce(f, 0) >= 0.7 AND unclassified < 0.5 THEN 'partial' ELSE 'fail' END AS class, CASE WHEN coalesce(f, 0) >= 0.8 THEN 'good' WHEN coalesce(f, 0) >= 0.5 THEN 'fair' ELSE 'poor' END AS bar FROM u LEFT JOIN bench USING (doc)""")
def checkpoint_classes(spark, d):
    n = _n()
    u = Y.validate(current(spark, d)).groupBy(F.col("source.standard").alias("doc")).agg((F.count_if(F.col("type") == "text_block") / n).alias("unclassified"), (F.count_if(F.size("errors") > 0) == 0).alias("passed"))
    met = u.join(_benchmark(spark, d).select("doc", "f"), "doc", "left").withColumn("f", F.coalesce("f", F.lit(0.0)))
    return met.select("doc", Y.row_class(F.col("passed"), F.col("f"), F.col("unclassified")).alias("class"), Y.bar(F.col("f")).alias("bar"))


_SAMPLE = "(SELECT *, row_number() OVER (ORDER BY md5(id), id) AS k FROM cur)"


@query(f"{WITH} SELECT id, type FROM {_SAMPLE} WHERE k <= 30")
def spot_sample(spark, d):
    return O.spot_sample(current(spark, d)).select("id", "type")


_PAGE_TEXTS = f"""pq AS (SELECT source.standard AS doc, source.chapter AS chapter, source.page AS page, string_agg(coalesce(data.rule, ''), ' ' ORDER BY seq, id) AS page_text FROM ({CUR.format(t='elements_b')}) GROUP BY 1, 2, 3)"""
_CHECKED = "coalesce(nullif(data.rule, ''), nullif(data.definition, ''), '')"
_BARE = lambda c: f"replace({c}, ' ', '')"
_ONE = lambda c: f"regexp_replace({c}, '\\s+', ' ', 'g')"


@query(f"""{WITH}, {_PAGE_TEXTS}, s AS (SELECT *, {_CHECKED} AS text FROM cur WHERE type IN ('provision', 'definition') AND length({_CHECKED}) > 50 ORDER BY md5(id), id LIMIT 30),
    m AS (SELECT s.id, substring(trim({_ONE('text')}, ' '), 1, 50) AS x, {_ONE('page_text')} AS p FROM s LEFT JOIN pq ON pq.doc = s.source.standard AND pq.chapter = s.source.chapter AND pq.page = s.source.page)
    SELECT id, CASE WHEN contains(p, x) THEN 'exact' WHEN contains({_BARE('p')}, {_BARE('x')}) THEN 'spacing' ELSE 'none' END AS match FROM m""")
def spot_check(spark, d):
    """Whether the texts of a sample stand on their pages."""
    place = [F.col(f"source.{c}").alias(n) for c, n in (("standard", "doc"), ("chapter", "chapter"), ("page", "page"))]
    b = current(spark, d, "elements_b").select(*place, F.struct("seq", "id", F.coalesce("data.rule", F.lit("")).alias("t")).alias("x"))
    pages = b.groupBy("doc", "chapter", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["t"]), " ").alias("page_text"))
    text = T.first_filled(F.col("data.rule"), F.col("data.definition"))
    rows = current(spark, d).filter("type in ('provision', 'definition')").select("id", *place, text.alias("text")).filter(F.length("text") > 50)
    return Y.fidelity(O.spot_sample(rows), pages, ["doc", "chapter", "page"], 50, 0).select("id", "match")


@query(f"{WITH} SELECT id, CASE WHEN {_IS_DEF} THEN trim(regexp_extract(text, '{_DEF}', 1, 's')) END AS term, CASE WHEN {_IS_DEF} THEN trim(regexp_extract(text, '{_DEF}', 2, 's')) END AS body FROM b WHERE contains(text, ':')")
def definition_parts(spark, d):
    b = blocks(spark, d).filter(F.contains("text", F.lit(":")))
    return b.select("id", C.definition_parts(F.col("text")).alias("p")).select("id", "p.term", "p.body")


_SKIP = "EXISTS (SELECT 1 FROM pat p WHERE p.doc = b.doc AND p.chapter = b.chapter AND p.kind = 'skip' AND (starts_with(bold, p.marker) OR starts_with(text, p.marker)))"


@query(f"{WITH}, {PATTERNS}, {KIND.replace('WHERE length(text) >= 2', f'WHERE length(text) >= 2 AND NOT {_SKIP}')} SELECT kind, count(*) AS n FROM k GROUP BY kind")
def classify_prefix_skip(spark, d):
    """Every block that starts with a learned page number goes."""
    b = blocks(spark, d)
    return C.classify(b, C.learn_patterns(b, DOC), DOC, skip_by_prefix=True).groupBy("kind").agg(_n().alias("n"))


_TUNE = f"""{_VALID}, {_BENCH}, sv AS (SELECT source.standard AS doc, count_if(errors = '') / count(*) AS s FROM v GROUP BY 1)
    SELECT bench.doc, round((coalesce(c, 0) + f + sv.s) / 3, 3) AS overall FROM bench JOIN sv USING (doc)"""


@query(f"{WITH}, {_TUNE}")
def tune_measure(spark, d):
    """Mean of completeness, the share of texts found on their pages, and the share of valid rows."""
    valid = Y.validate(current(spark, d)).groupBy(F.col("source.standard").alias("doc")).agg((F.count_if(F.size("errors") == 0) / _n()).alias("v"))
    met = _benchmark(spark, d).join(valid, "doc")
    return met.select("doc", F.round((F.coalesce("c", F.lit(0.0)) + F.col("f") + F.col("v")) / 3, 3).alias("overall"))


_SPLIT = r"(\d+\.\d+(?:\.\d+)* [A-Z])"


# Headings of documents, each number standing after anything but a digit or a dot.
@query(f"""WITH t AS (SELECT doc_id, text, regexp_replace(text, '(^|[^\\p{{L}}\\p{{N}}_.]){_SPLIT}', '\\1' || chr(1) || '\\2', 'g') AS m FROM documents WHERE text IS NOT NULL),
    p AS (SELECT doc_id, text, list_transform(list_filter(string_split(m, chr(1)), lambda x: length(trim(x, ' ')) >= 10), lambda x: trim(x, ' ')) AS parts, length(m) - length(replace(m, chr(1), '')) AS n FROM t),
    q AS (SELECT doc_id, CASE WHEN length(text) >= 80 AND n >= 2 THEN parts ELSE [text] END AS parts FROM p)
    SELECT doc_id, unnest(range(0, len(parts)))::INT AS part, unnest(parts) AS body FROM q""")
def split_multi_section(spark, d):
    docs = table(spark, d, "documents").filter("text is not null")
    return docs.select("doc_id", F.posexplode(S.split_sections(F.col("text"))).alias("part", "body"))


@query(f"""{WITH}, s AS (SELECT doc, chapter, section, string_agg(text, ' ' ORDER BY seq, id) AS text FROM b GROUP BY 1, 2, 3),
    p AS (SELECT doc, chapter, section, string_split(regexp_replace(text, '([A-Z][A-Z ]{{2,}}[A-Z]):', chr(1) || '\\1' || chr(2), 'g'), chr(1))[2:] AS parts FROM s),
    e AS (SELECT doc, chapter, section, unnest(parts) AS x FROM p)
    SELECT * FROM (SELECT doc, chapter, section, trim(split_part(x, chr(2), 1), ' ') AS term, trim(substring(x, length(split_part(x, chr(2), 1)) + 2), ' ') AS body FROM e)
    WHERE term NOT IN ({', '.join(f"'{t}'" for t in S.NO_TERMS)}) AND length(body) > 10""")
def embedded_definitions(spark, d):
    b = blocks(spark, d).groupBy("doc", "chapter", "section").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "id", "text"))), lambda x: x["text"]), " ").alias("text"))
    return b.select("doc", "chapter", "section", F.inline(S.embedded_definitions(F.col("text"))))


_CHARS = """ch AS (SELECT l_partkey AS page, l_orderkey * 10 + l_linenumber AS box, (l_quantity * 10)::DOUBLE AS x0, (l_quantity * 10 + 8)::DOUBLE AS x1, (l_linenumber * 90 + (l_orderkey * 10 + l_linenumber) % 3)::DOUBLE AS top,
    ((l_orderkey * 10 + l_linenumber) % 10)::VARCHAR AS text, (l_orderkey * 10 + l_linenumber) % 4 <> 0 AS bold, 600 AS width FROM lineitem)"""


@query(f"""WITH {_CHARS}, r AS (SELECT *, CASE WHEN row_number() OVER w = 1 OR bold <> lag(bold) OVER w THEN 1 ELSE 0 END AS s FROM ch WINDOW w AS (PARTITION BY page ORDER BY top, x0, box)),
    i AS (SELECT *, sum(s) OVER (PARTITION BY page ORDER BY top, x0, box) AS run FROM r)
    SELECT page, run::BIGINT AS run, string_agg(text, '' ORDER BY top, x0, box) AS run_text FROM i WHERE bold GROUP BY 1, 2 HAVING length(string_agg(text, '' ORDER BY top, x0, box)) >= 3""")
def bold_runs(spark, d):
    from strataq.plans.quality_queries import _chars

    return S.bold_runs(_chars(spark, d), ["page"], ["top", "x0", "box"])


@query(f"""WITH {_CHARS}, n AS (SELECT page, floor(x0)::INT AS x, count(*) AS n FROM ch GROUP BY 1, 2), pg AS (SELECT page, 600 AS w FROM ch GROUP BY 1),
    st AS (SELECT page, w, unnest(range(floor(w * 0.35)::BIGINT, floor(w * 0.65)::BIGINT - 8)) AS x FROM pg),
    c AS (SELECT st.page, st.w, st.x, coalesce(sum(n.n), 0) AS inside FROM st LEFT JOIN n ON n.page = st.page AND n.x BETWEEN st.x AND st.x + 9 GROUP BY 1, 2, 3),
    b AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY inside, x) AS r FROM c),
    s AS (SELECT b.page AS page, b.w AS w, b.x + 5 AS split_at, b.inside AS inside, coalesce(sum(CASE WHEN n.x < b.x + 5 THEN n.n END), 0) / (b.x + 5) AS l, coalesce(sum(CASE WHEN n.x >= b.x + 5 THEN n.n END), 0) / (b.w - b.x - 5) AS rt FROM b JOIN n USING (page) WHERE r = 1 GROUP BY b.page, b.w, b.x, b.inside)
    SELECT page, split_at::INT AS split_at, l > 2 AND rt > 2 AND inside / 10 < 0.1 * greatest(l, rt) AS two_columns FROM s""")
def column_gap(spark, d):
    from strataq.plans.quality_queries import _chars

    return S.column_gap(_chars(spark, d), ["page"])


@query(f"""WITH RECURSIVE {_CHARS}, t AS (SELECT page, top, row_number() OVER (PARTITION BY page ORDER BY top) AS k FROM (SELECT DISTINCT page, top FROM ch)),
    f AS (SELECT page, k, top, top AS anchor, 1 AS line FROM t WHERE k = 1 UNION ALL SELECT t.page, t.k, t.top, CASE WHEN t.top - f.anchor < 1.5 THEN f.anchor ELSE t.top END, CASE WHEN t.top - f.anchor < 1.5 THEN f.line ELSE f.line + 1 END FROM f JOIN t ON t.page = f.page AND t.k = f.k + 1)
    SELECT page, line::INT AS line, count(*) AS n, min(ch.top) AS top FROM ch JOIN f USING (page, top) GROUP BY 1, 2""")
def anchored_lines(spark, d):
    from strataq.plans.quality_queries import _chars

    return S.anchored_lines(_chars(spark, d), ["page"]).groupBy("page", "line").agg(_n().alias("n"), F.min("top").alias("top"))


QUERIES = Q
