"""Text, classification and reading-order queries over the current elements and all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataq.functions import text as T
from strataq.operators import classify as C
from strataq.operators import sequence as S
from strataq.plans.corpus import WITH, blocks, current
from strataq.sources import table

DOC, ORDER = ["doc", "chapter"], ["seq", "id"]
Q: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# --- classification -------------------------------------------------------

_UPPER = "bold = upper(bold) AND regexp_matches(bold, '[A-Za-z]')"
_NOTE = "coalesce(" + ", ".join(f"CASE WHEN starts_with(bold, '{w}') THEN '{w}' END" for w in C.NOTE_WORDS) + ")"
_FAMILY = "|".join(C.REFERENCE_FAMILIES)
_DEF = r"^([A-Z][A-Z0-9 ,./()]+?)\s*:\s*(.+)"
_TERM = f"trim(regexp_extract(text, '{_DEF}', 1, 's'))"
_IS_DEF = f"(regexp_matches(text, '{_DEF}', 's') AND length({_TERM}) BETWEEN 3 AND 79 AND {_TERM} = upper({_TERM}) AND regexp_matches({_TERM}, '[A-Za-z]'))"
_COLON = "contains(substring(text, 1, length(bold) + 5), ':')"


def _phrase(phrases) -> str:
    return "(" + " OR ".join(f"contains(lower(text), '{p}')" for p in phrases) + ")"


PATTERNS = f"""
pat AS (
    SELECT DISTINCT doc, chapter, p.kind AS kind, p.marker AS marker FROM (
        SELECT doc, chapter, CASE
            WHEN regexp_matches(bold, '^\\d{{1,4}}$') THEN {{'kind': 'skip', 'marker': bold}}
            WHEN regexp_matches(bold, '^\\d+\\.\\d+') THEN {{'kind': 'section', 'marker': substring(bold, 1, 20)}}
            WHEN starts_with(bold, 'CHAPTER') THEN {{'kind': 'section', 'marker': 'CHAPTER'}}
            WHEN {_NOTE} IS NOT NULL THEN {{'kind': 'note', 'marker': {_NOTE}}}
            WHEN starts_with(upper(bold), 'EXCEPTION') THEN {{'kind': 'exception', 'marker': trim(split_part(split_part(bold, ':', 1), '.', 1))}}
            WHEN regexp_matches(bold, '^({_FAMILY})') THEN {{'kind': 'reference', 'marker': split_part(split_part(bold, ',', 1), ' ', 1)}}
            WHEN {_UPPER} AND {_COLON} AND length(bold) < 80 THEN {{'kind': 'definition', 'marker': 'ALLCAPS_COLON'}}
            WHEN regexp_matches(bold, '^[A-Z][a-z].*[A-Z]\\.?\\s*$') AND length(bold) < 40 THEN {{'kind': 'sub_definition', 'marker': substring(bold, 1, 20)}}
            WHEN {_UPPER} AND NOT {_COLON} AND length(bold) < 60 THEN {{'kind': 'topic', 'marker': bold}} END AS p
        FROM b WHERE length(bold) >= 2) WHERE p IS NOT NULL
)"""


def _has(kind: str, test: str) -> str:
    return f"EXISTS (SELECT 1 FROM pat p WHERE p.doc = b.doc AND p.chapter = b.chapter AND p.kind = '{kind}' AND {test})"


KIND = f"""
k AS (
    SELECT *, CASE raw WHEN 'sub_definition' THEN 'definition' WHEN 'topic' THEN 'heading' ELSE raw END AS kind,
        CASE WHEN raw IN ('sub_definition', 'topic') THEN raw END AS note FROM (
        SELECT *, CASE
            WHEN label IN ('section_header', 'title') THEN 'heading'
            WHEN {_has('note', 'starts_with(bold, p.marker) OR starts_with(text, p.marker)').replace('AND starts', 'AND (starts', 1)[:-1]})) THEN 'user_note'
            WHEN {_has('exception', 'starts_with(upper(bold), upper(p.marker))')} THEN 'exception'
            WHEN {_has('definition', 'true')} AND {_IS_DEF} THEN 'definition'
            WHEN {_has('sub_definition', 'starts_with(bold, substring(p.marker, 1, 10))')} THEN 'sub_definition'
            WHEN regexp_matches(bold, '^\\d+\\.\\d+') OR starts_with(bold, 'CHAPTER') THEN 'heading'
            WHEN {_has('topic', 'bold = p.marker')} THEN 'topic'
            WHEN {_has('reference', 'starts_with(bold, p.marker)')} THEN 'reference'
            WHEN {_phrase(C.REGULATORY)} THEN 'provision' ELSE 'text_block' END AS raw
        FROM b WHERE length(text) >= 2))"""


def _classified(spark: SparkSession, d: str) -> DataFrame:
    b = blocks(spark, d)
    return C.classify(b, C.learn_patterns(b, DOC), DOC)


@query(f"{WITH}, {PATTERNS}, {KIND} SELECT kind, count(*) AS n FROM k GROUP BY kind")
def element_type_counts(spark, d):
    return _classified(spark, d).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query(f"{WITH}, {PATTERNS} SELECT * FROM pat")
def learn_patterns(spark, d):
    return C.learn_patterns(blocks(spark, d), DOC)


@query(f"{WITH}, {PATTERNS}, {KIND} SELECT id, kind, note FROM k")
def classify_elements(spark, d):
    return _classified(spark, d).select("id", "kind", "note")


@query(f"""{WITH} SELECT given, coalesce(CASE
    WHEN regexp_matches(text, '^\\d{{3}}$') OR starts_with(text, 'Downloaded from') THEN NULL
    WHEN label IN ('section_header', 'title') THEN 'heading'
    WHEN starts_with(bold, 'User Note') OR starts_with(text, 'User Note') THEN 'user_note'
    WHEN starts_with(upper(bold), 'EXCEPTION') THEN 'exception' WHEN {_IS_DEF} THEN 'definition'
    WHEN regexp_matches(bold, '^\\d+\\.\\d+') OR starts_with(bold, 'CHAPTER') THEN 'heading'
    WHEN regexp_matches(bold, '^({_FAMILY})') THEN 'reference'
    WHEN {_phrase(C.REGULATORY_SHORT)} THEN 'provision' ELSE 'text_block' END, 'skipped') AS kind, count(*) AS n FROM b GROUP BY ALL""")
def classify_fixed(spark, d):
    kind = F.coalesce(C.classify_fixed(F.col("label"), F.col("bold"), F.col("text")), F.lit("skipped"))
    return blocks(spark, d).groupBy("given", kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""{WITH} SELECT given, CASE WHEN label IN ('section_header', 'title') OR (length(bold) > 0 AND 9 + length(bold) % 4 > 11) THEN 'heading'
    WHEN {_IS_DEF} THEN 'definition' WHEN length(text) < 120 AND contains(text, '=') AND NOT {_phrase(C.REGULATORY_SHORT)} THEN 'formula'
    WHEN {_phrase(C.REGULATORY_SHORT)} THEN 'provision' ELSE 'text_block' END AS kind, count(*) AS n FROM b GROUP BY ALL""")
def classify_by_font(spark, d):
    size = F.lit(9) + F.length("bold") % 4  # a stand-in: the tables hold no fonts
    kind = C.classify_by_font(F.col("label"), F.col("text"), F.length("bold") > 0, size)
    return blocks(spark, d).groupBy("given", kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""{WITH}, p AS (SELECT *, seq % 800 AS y0, seq % 800 + 12 AS y1 FROM b)
    SELECT given, coalesce(CASE WHEN (y0 < 30 OR y1 > 770) AND length(text) < 150 THEN NULL
    WHEN length(bold) > 0 AND regexp_matches(text, '^\\d+\\.\\d+') THEN 'heading' WHEN {_IS_DEF} THEN 'definition'
    WHEN length(text) < 150 AND contains(text, '=') AND NOT regexp_matches(lower(text), '\\b(?:shall|must|may)\\b') THEN 'formula'
    WHEN {_phrase(C.REGULATORY_MEDIUM)} THEN 'provision' ELSE 'text_block' END, 'skipped') AS kind, count(*) AS n FROM p GROUP BY ALL""")
def classify_by_place(spark, d):
    y0 = F.col("seq") % 800  # a stand-in: the tables hold no geometry
    kind = F.coalesce(C.classify_by_place(F.col("text"), y0, y0 + 12, F.lit(400), F.lit(12), F.length("bold") > 0), F.lit("skipped"))
    return blocks(spark, d).groupBy("given", kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""{WITH}, {PATTERNS}, {KIND}, x AS (SELECT b.given, coalesce(k.kind, 'skipped') AS kind FROM b LEFT JOIN k USING (id))
    SELECT kind, count(*) AS n, count_if(given = 'text_block') AS n_were_text_blocks, count_if(given <> kind) AS n_moved FROM x GROUP BY kind""")
def reclassification_audit(spark, d):
    """What a second classification makes of the elements, and of the text blocks among them."""
    again = _classified(spark, d).select("id", "kind")
    met = blocks(spark, d).select("id", "given").join(again, "id", "left").withColumn("kind", F.coalesce("kind", F.lit("skipped")))
    n = F.count(F.lit(1))
    return met.groupBy("kind").agg(n.alias("n"), F.count_if(F.col("given") == "text_block").alias("n_were_text_blocks"), F.count_if(F.col("given") != F.col("kind")).alias("n_moved"))


# --- text -----------------------------------------------------------------


def _sql_replaced(c: str, pairs: dict[str, str]) -> str:
    for old, new in pairs.items():
        c = f"replace({c}, '{old}', '{new}')"
    return c


_JOIN = r"'([\p{L}\p{N}_])- ([\p{L}\p{N}_])', '\1\2', 'g'"


@query(f"""SELECT doc_id, trim(regexp_replace(regexp_replace({_sql_replaced('text', T.LIGATURES | T.ENTITIES)}, {_JOIN}), '[\\s\\p{{Z}}]+', ' ', 'g')) AS fixed
    FROM documents WHERE text IS NOT NULL""")
def text_fix(spark, d):
    return table(spark, d, "documents").filter("text is not null").select("doc_id", T.fix_text(F.col("text")).alias("fixed"))


def _sql_repair() -> str:
    c = _sql_replaced("x", T.LIGATURES)
    for gap, word in T.gaps():
        c = f"regexp_replace({c}, '{gap}', '{word}', 'g')"
    for before, after in T.ORPHANS:
        c = f"regexp_replace({c}, '{before}', '{after.replace('$', chr(92))}', 'g')"
    return f"regexp_replace(regexp_replace({c}, {_JOIN}), '  +', ' ', 'g')"


_WORDED = ("title", "description", "data.rule", "data.definition", "data.term", "data.target", "data.description")
_EACH = " UNION ALL ".join(f"SELECT id, '{c}' AS field, {c} AS x FROM cur WHERE {c} IS NOT NULL" for c in _WORDED)


@query(f"{WITH}, w AS ({_EACH}) SELECT id, field, {_sql_repair()} AS repaired FROM w WHERE x <> {_sql_repair()}")
def word_repairs(spark, d):
    each = F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).alias("x")) for c in _WORDED))
    fixed = current(spark, d).select("id", F.inline(each)).withColumn("repaired", T.repair_words(F.col("x")))
    return fixed.filter("x <> repaired").select("id", "field", "repaired")


@query(f"{WITH} SELECT id, coalesce(nullif(data.rule, ''), nullif(data.expression, ''), nullif(data.definition, ''), nullif(data.target, ''), '') AS text FROM cur")
def first_nonempty_text(spark, d):
    return current(spark, d).select("id", T.first_filled(*(F.col(f"data.{c}") for c in ("rule", "expression", "definition", "target"))).alias("text"))


@query(f"{WITH} SELECT id, nullif(regexp_extract(text, '^\\d+\\.\\d+(?:\\.\\d+)*', 0), '') AS number, try_cast(nullif(regexp_extract(id, '^[A-Z0-9]+-\\d+-(\\d+)', 1), '') AS INT) AS id_chapter FROM b")
def section_number(spark, d):
    return blocks(spark, d).select("id", T.section_number(F.col("text")).alias("number"), T.chapter_of_id(F.col("id")).alias("id_chapter"))


_MENTION = " UNION ALL ".join(f"SELECT DISTINCT doc, chapter, id, '{k}' AS kind, unnest(regexp_extract_all(text, '{p}', 1)) AS num FROM b" for k, p in T.MENTIONS.items())
MENTIONS = f"m AS ({_MENTION})"


def mentions_of(b: DataFrame, kinds=tuple(T.MENTIONS)) -> DataFrame:
    return b.select("doc", "chapter", "id", F.inline(T.mentions(F.col("text"), kinds)))


@query(f"{WITH}, {MENTIONS} SELECT id, kind, num FROM m")
def reference_mentions(spark, d):
    return mentions_of(blocks(spark, d)).select("id", "kind", "num")


_FAM = "trim(split_part(split_part(t, ',', 1), ' ', 1) || ' ' || split_part(split_part(t, ',', 1), ' ', 2))"
_EXT = " UNION ALL ".join(f"SELECT doc, chapter, unnest(regexp_extract_all(text, '{p}', 1)) AS t FROM b" for p in T.EXTERNAL)


@query(f"""{WITH}, e AS ({_EXT} UNION ALL SELECT source.standard, source.chapter, data.target FROM cur WHERE data.target <> '')
    SELECT {_FAM} AS family, count(*) AS n_refs, string_agg(DISTINCT doc || ' ' || chapter::VARCHAR, ',' ORDER BY doc || ' ' || chapter::VARCHAR) AS cited_in FROM e GROUP BY 1""")
def external_catalog(spark, d):
    said = blocks(spark, d).select("doc", "chapter", F.explode(T.external_mentions(F.col("text"))).alias("t"))
    named = current(spark, d).filter("data.target <> ''").select("source.standard", "source.chapter", "data.target")
    each = said.union(named).groupBy(T.standard_family(F.col("t")).alias("family"), F.concat_ws(" ", "doc", "chapter").alias("at")).agg(F.count(F.lit(1)).alias("n"))
    return each.groupBy("family").agg(F.sum("n").alias("n_refs"), F.array_join(F.array_sort(F.collect_list("at")), ",").alias("cited_in"))


_NUM = r"\((\d+\.\d+-\d+[a-z]?(?:\.SI)?)\)"


@query(f"""{WITH}, e AS (SELECT doc, chapter, seq, id, unnest(regexp_extract_all(text, '{_NUM}', 1)) AS num FROM b)
    SELECT doc, chapter, num, arg_min(id, seq::VARCHAR || ' ' || id) AS first_id, count(*) AS n FROM
    (SELECT doc, chapter, num, lpad(seq::VARCHAR, 12, '0') AS seq, id FROM e) GROUP BY doc, chapter, num""")
def equation_first_seen(spark, d):
    e = blocks(spark, d).select("doc", "chapter", "seq", "id", F.explode(F.regexp_extract_all("text", F.lit(_NUM), F.lit(1))).alias("num"))
    return e.groupBy("doc", "chapter", "num").agg(F.min_by("id", F.struct("seq", "id")).alias("first_id"), F.count(F.lit(1)).alias("n"))


@query(f"{WITH} SELECT id, NOT regexp_matches(text, '[=<>≤≥+\\-*/^√∑]') AND len(regexp_extract_all(lower(text), '\\b(?:shall|determined|using|accordance|permitted|including|satisfy)\\b')) >= 2 AS prose FROM b WHERE given = 'formula' OR contains(text, 'Eq. (')")
def prose_equations(spark, d):
    return blocks(spark, d).filter("given = 'formula' or contains(text, 'Eq. (')").select("id", T.is_prose(F.col("text")).alias("prose"))


# --- order ----------------------------------------------------------------

_FILL = f"""f AS (SELECT *, coalesce(last_value(CASE WHEN kind = 'heading' OR starts_with(num, chapter::VARCHAR) THEN num END IGNORE NULLS)
    OVER (PARTITION BY doc, chapter ORDER BY seq, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), chapter::VARCHAR) AS in_section
    FROM (SELECT *, nullif(regexp_extract(text, '^\\d+\\.\\d+(?:\\.\\d+)*', 0), '') AS num FROM k))"""


def _filled(spark, d):
    return S.fill_section(_classified(spark, d), DOC, ORDER)


@query(f"{WITH}, {PATTERNS}, {KIND}, {_FILL} SELECT id, in_section FROM f")
def section_forward_fill(spark, d):
    return _filled(spark, d).select("id", "in_section")


_LETTER = "CASE kind " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in S.ID_LETTERS.items()) + " ELSE 'T' END"


@query(f"""{WITH}, {PATTERNS}, {KIND}, {_FILL} SELECT id, replace(doc, ' ', '') || '-' || in_section || '-' || l || row_number() OVER (PARTITION BY doc, chapter, in_section, l ORDER BY seq, id) AS new_id
    FROM (SELECT *, {_LETTER} AS l FROM f)""")
def element_ids(spark, d):
    return S.assign_ids(_filled(spark, d), DOC, ORDER, F.replace("doc", F.lit(" "), F.lit(""))).select("id", "new_id")


@query(f"{WITH}, h AS (SELECT id, text AS heading, substring(text, 1, 8 + seq % 20) AS bold FROM b WHERE given = 'heading') SELECT id, CASE WHEN cut THEN trim(substring(heading, 1, length(trim(bold)))) ELSE heading END AS head, CASE WHEN cut THEN trim(substring(heading, length(trim(bold)) + 1)) END AS body FROM (SELECT *, length(bold) > 3 AND length(heading) > length(bold) + 10 AS cut FROM h)")
def heading_body_split(spark, d):
    h = blocks(spark, d).filter("given = 'heading'").withColumn("bold", F.substring("text", F.lit(1), (8 + F.col("seq") % 20).cast("int")))
    return h.select("id", S.split_heading(F.col("text"), F.col("bold")).alias("s")).select("id", "s.head", "s.body")


_LINES = "l AS (SELECT doc_id, t.p - 1 AS pos, t.line AS line FROM (SELECT doc_id, unnest(list_zip(range(1, len(x) + 1), x)) AS z FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents WHERE text IS NOT NULL)), LATERAL (SELECT z[1] AS p, z[2] AS line) t)"


def _lines(spark, d):
    lines = table(spark, d, "documents").filter("text is not null").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    return lines.withColumn("kind", F.lit("text_block"))


@query(f"""WITH {_LINES}, i AS (SELECT *, sum(CASE WHEN length(line) >= 30 OR pos = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS isl FROM l)
    SELECT doc_id, min(pos)::INT AS pos, CASE WHEN arg_min(line, pos) <> '' THEN string_agg(line, ' ' ORDER BY pos) ELSE '' END AS merged,
    CASE WHEN arg_min(line, pos) <> '' THEN count(*) ELSE 1 END::INT AS n_parts FROM i GROUP BY doc_id, isl""")
def merge_fragments(spark, d):
    return S.merge_fragments(_lines(spark, d), ["doc_id"], ["pos"], text="line").select("doc_id", "pos", "merged", "n_parts")


@query(f"WITH {_LINES} SELECT doc_id, min(pos)::INT AS pos, substring(line, 1, 200) AS key FROM l GROUP BY doc_id, substring(line, 1, 200)")
def dedup_first(spark, d):
    kept = S.first_only(_lines(spark, d), ["doc_id", F.substring("line", 1, 200)], ["pos"])
    return kept.select("doc_id", "pos", F.substring("line", 1, 200).alias("key"))


@query(f"{WITH}, x AS (SELECT *, row_number() OVER (PARTITION BY doc, chapter, given, section, substring(text, 1, 200) ORDER BY seq, id) AS r FROM b) SELECT id FROM x WHERE r = 1 OR length(text) = 0")
def dedup_blocks(spark, d):
    return S.dedup_blocks(blocks(spark, d), DOC, ORDER, kind="given").select("id")


@query(f"WITH {_LINES} SELECT doc_id, count(*) AS n FROM l WHERE length(line) >= 5 GROUP BY doc_id")
def near_empty_filter(spark, d):
    return S.drop_near_empty(_lines(spark, d), text="line").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_LINES} SELECT doc_id, pos::INT AS pos, line FROM l WHERE regexp_matches(line, '^\\d{{1,4}}$|^Downloaded from|^Page \\d+|^- \\d+ -$')")
def furniture_skip(spark, d):
    return _lines(spark, d).filter(C.is_furniture(F.col("line"))).select("doc_id", "pos", "line")


@query(f"""{WITH} SELECT id, row_number() OVER (PARTITION BY doc, chapter ORDER BY page, CASE WHEN given = 'formula' THEN 0 ELSE seq END, id) AS position FROM b""")
def page_order(spark, d):
    b = blocks(spark, d).withColumn("s", F.when(F.col("given") != "formula", F.col("seq")))
    return S.resorted(b, DOC, "page", "s", "id").select("id", "position")


_KEY = "list_transform(string_split(section, '.'), lambda x: coalesce(try_cast(x AS INT), 999))"


@query(f"""{WITH}, s AS (SELECT doc, chapter, {_KEY} AS k, lag({_KEY}) OVER (PARTITION BY doc, chapter ORDER BY seq, id) AS p FROM b WHERE regexp_matches(section, '^\\d+\\.\\d+'))
    SELECT doc, chapter, count(*) AS n_sections, count_if(k < p) AS n_inversions FROM s GROUP BY doc, chapter""")
def section_inversions(spark, d):
    return S.inversions(blocks(spark, d), DOC, ORDER)


@query(f"""{WITH}, h AS (SELECT *, row_number() OVER (PARTITION BY doc, chapter, section ORDER BY seq, id) AS r FROM b WHERE given = 'heading')
    SELECT id, section, row_number() OVER (PARTITION BY doc, chapter ORDER BY {_KEY}, section) AS rank FROM h WHERE r = 1""")
def headings_in_order(spark, d):
    return S.headings_in_order(blocks(spark, d).filter("given = 'heading'"), DOC, ORDER).select("id", "section", "rank")


@query(f"""{WITH}, st AS (SELECT doc, chapter, min(page) AS page FROM b WHERE page > 0 GROUP BY 1, 2), la AS (SELECT doc, max(page) AS last_page FROM b GROUP BY 1),
    bo AS (SELECT doc, min(page) AS page FROM b WHERE given = 'reference' AND page > 0 GROUP BY doc, chapter),
    u AS (SELECT doc, chapter, page, true AS s FROM st UNION ALL SELECT doc, NULL, page, false FROM bo)
    SELECT doc, chapter, page, least(end_page, last_page) AS end_page FROM (SELECT *, least(coalesce(min(page) OVER (PARTITION BY doc ORDER BY page RANGE BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) - 1, page + 49), page + 49) AS end_page FROM u) JOIN la USING (doc) WHERE s""")
def chapter_ranges(spark, d):
    b = blocks(spark, d)
    starts = b.filter("page > 0").groupBy("doc", "chapter").agg(F.min("page").alias("page"))
    ends = b.filter("given = 'reference' and page > 0").groupBy("doc", "chapter").agg(F.min("page").alias("page")).drop("chapter")
    last = b.groupBy("doc").agg(F.max("page").alias("last_page"))
    return S.chapter_ranges(starts.join(last, "doc"), ends, ["doc"], last_page="last_page").drop("last_page")


QUERIES = Q
