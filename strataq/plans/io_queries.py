"""Queries of readers, writers, layout rows, streams and small formats."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from strataq.functions import text as T
from strataq.operators import clean as K
from strataq.operators import geometry as G
from strataq.operators import sequence as S
from strataq.plans.corpus import WITH, blocks, current
from strataq.plans.emit_queries import _CHARS
from strataq.plans.quality_queries import _boxes, _chars
from strataq.plans.text_queries import DOC, ORDER
from strataq.session import scratch_path
from strataq.sources import elements as I
from strataq.sources import layout, table

Q: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# --- files ----------------------------------------------------------------------


@query(f"{WITH} SELECT id, type, title, source.section AS section, data.rule AS rule, len(data.conditions) AS n_conditions, len(data.rows) AS n_rows, cardinality(data.parameters)::INT AS n_parameters FROM cur")
def json_round_trip(spark, d):
    """Elements written as JSON files and read again: none is lost, none is changed."""
    where = scratch_path(spark, "json")
    I.write_elements_json(current(spark, d), where, compression="gzip")
    back = I.read_elements(spark, where, lines=True)
    n = lambda c: F.when(F.col(c).isNotNull(), F.size(c))
    return back.select("id", "type", "title", F.col("source.section").alias("section"), "data.rule", n("data.conditions").cast("bigint").alias("n_conditions"), n("data.rows").cast("bigint").alias("n_rows"), n("data.parameters").alias("n_parameters"))


@query(f"{WITH} SELECT source.standard AS standard, source.chapter AS chapter, count(*) AS n FROM cur WHERE source.standard IS NOT NULL AND source.chapter = 3 GROUP BY 1, 2")
def partitioned_write(spark, d):
    """Elements written by standard and chapter; a chapter is read back from its own folders."""
    where = scratch_path(spark, "parts")
    now = current(spark, d)
    I.write_elements(now, where)
    back = I.read_chapter(spark, where, 3, now.schema).select("source.standard", "chapter").filter("standard is not null")
    return back.groupBy("standard", "chapter").agg(F.count(F.lit(1)).alias("n"))


@query(f"""{WITH} SELECT id FROM cur WHERE description IS NULL OR (source.citation IS NULL AND source.section IS NOT NULL)""")
def changed_rows(spark, d):
    now = current(spark, d)
    return I.changed_rows(now, K.fill_for_output(now)).select("id")


@query(f"""{WITH}, x AS (SELECT *, coalesce(data.rule, data.definition, data.expression, data.target, title, '') AS text FROM cur)
    SELECT source.standard AS standard, source.chapter AS chapter, seq, CASE type WHEN 'heading' THEN repeat('#', least(len(string_split(source.section, '.')), 6)::INT) || ' ' || text
        WHEN 'definition' THEN '**' || coalesce(data.term, '') || '**: ' || coalesce(data.definition, '') WHEN 'formula' THEN '`' || text || '`' ELSE text END AS line FROM x""")
def markdown_lines(spark, d):
    return I.markdown(current(spark, d))


@query(f"""{WITH} SELECT id, replace(replace(replace(replace(title, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') AS html, regexp_replace(lower(title), '[ -]', '', 'g') AS slug,
    CASE WHEN length(title) > 80 THEN substring(title, 1, 77) || '...' ELSE title END AS short FROM cur WHERE title IS NOT NULL""")
def title_formats(spark, d):
    t = F.col("title")
    return current(spark, d).filter("title is not null").select("id", T.html_escape(t).alias("html"), T.slug(t).alias("slug"), T.summarized(t).alias("short"))


@query("""SELECT source.standard AS standard, date_trunc('day', loaded_at) AS day, count(*) AS n FROM elements WHERE loaded_at IS NOT NULL GROUP BY 1, 2""")
def streamed_loads(spark, d):
    """The loads of each day, as a stream counts them batch by batch."""
    from strataq import streaming

    name = f"loads_{uuid.uuid4().hex}"
    stream = streaming.element_stream(spark, f"{d}/elements.parquet*")
    counted = streaming.loads_per_window(stream, late="3650 days")
    counted.writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", scratch_path(spark, "stream")).trigger(availableNow=True).start().awaitTermination()
    return spark.table(name).select("standard", F.col("window.start").cast("timestamp_ntz").alias("day"), "n")


# --- layout ------------------------------------------------------------------------


@query(f"""WITH {_CHARS}, o AS (SELECT *, min(bold::INT) OVER (PARTITION BY page, top ORDER BY x0, box ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lead FROM ch)
    SELECT page, top, string_agg(text, '' ORDER BY x0, box) AS text, coalesce(string_agg(CASE WHEN lead = 1 THEN text END, '' ORDER BY x0, box), '') AS bold_prefix, bool_and(bold) AS all_bold FROM o GROUP BY 1, 2""")
def line_spans(spark, d):
    return layout.line_spans(_chars(spark, d), ["page", "top"], ["x0", "box"])


@query(f"""WITH {_CHARS}, s AS (SELECT page, round(top)::INT AS y, bold, box % 5 + 8.0 AS size, 'f' || (box % 3)::VARCHAR AS font, row_number() OVER (PARTITION BY page, round(top)::INT ORDER BY bold DESC, box DESC) AS r FROM ch)
    SELECT page, y, bold, size::DOUBLE AS size, font FROM s WHERE r = 1""")
def font_map(spark, d):
    c = _chars(spark, d).select(F.lit("d").alias("doc"), "page", F.col("top").alias("y"), F.col("box").alias("span_seq"), "bold", (F.col("box") % 5 + 8.0).cast("double").alias("size"), F.concat(F.lit("f"), (F.col("box") % 3).cast("string")).alias("font"))
    return layout.font_map(c).drop("doc")


@query(f"""WITH {_CHARS}, c AS (SELECT page, box, x0, top, CASE WHEN box % 7 = 0 THEN 'ﬁ' ELSE text END AS text, CASE WHEN box % 11 = 0 THEN 'X+fb1' ELSE 'T' END AS font FROM ch)
    SELECT page, count(*) AS n, 0::BIGINT AS n_left, sum(length(replace(text, 'ﬁ', 'fi')))::BIGINT AS n_letters FROM c WHERE x0 >= 40 AND top <= 770 AND NOT regexp_matches(font, '\\+f[bc]') GROUP BY 1""")
def clean_chars(spark, d):
    c = _chars(spark, d).withColumn("text", F.when(F.col("box") % 7 == 0, "ﬁ").otherwise(F.col("text"))).withColumn("font", F.when(F.col("box") % 11 == 0, "X+fb1").otherwise("T"))
    return layout.clean_chars(c).groupBy("page").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("text") == "ﬁ").alias("n_left"), F.sum(F.length("text")).alias("n_letters"))


@query(f"""WITH {_CHARS} SELECT box, 800 - top AS y, top * (150 / 72) AS px FROM ch""")
def place_formats(spark, d):
    return _chars(spark, d).select("box", G.flipped(F.col("top"), F.lit(800)).alias("y"), G.scaled(F.col("top"), 150).alias("px"))


@query(f"""WITH {_CHARS}, t AS (SELECT page, box, top FROM ch WHERE box % 2 = 0), f AS (SELECT page, box AS fid, top AS y, box % 5 + 8.5 AS size FROM ch WHERE box % 2 = 1)
    SELECT t.page, t.box, coalesce(arg_min(f.size, (abs(t.top - f.y), (f.y < t.top)::INT, f.fid)), 9.5)::DOUBLE AS size FROM t LEFT JOIN f ON f.page = t.page AND abs(t.top - f.y) < 5 GROUP BY 1, 2""")
def nearest_font(spark, d):
    """The font of the line nearest to each text, the one below first; a default where none is near."""
    c = _chars(spark, d)
    left = c.filter("box % 2 = 0").select("page", "box", "top")
    right = c.filter("box % 2 = 1").select("page", F.col("box").alias("fid"), "top", (F.col("box") % 5 + 8.5).cast("double").alias("size"))
    return G.nearest(left, right, ["page"], "top", "box", ["fid"], 5.0, ["size"], ahead_first=True, default={"size": 9.5}).select("page", "box", "size").distinct()


_PAGE_TEXT = "pt AS (SELECT doc, chapter, page, CASE WHEN count(CASE WHEN given = 'heading' THEN 1 END) > 0 THEN 'CHAPTER ' || chapter::VARCHAR || chr(10) || upper(arg_min(CASE WHEN given = 'heading' THEN text END, CASE WHEN given = 'heading' THEN lpad(seq::VARCHAR, 12, '0') || id END)) ELSE 'none' END AS text FROM b GROUP BY 1, 2, 3)"


@query(rf"""{WITH}, {_PAGE_TEXT} SELECT doc, page, try_cast(regexp_extract(substring(text, 1, 500), 'CHAPTER\s+(\d+)\s*\n\s*([A-Z][A-Z :,\-]+)', 1) AS INT) AS chapter, trim(regexp_extract(substring(text, 1, 500), 'CHAPTER\s+(\d+)\s*\n\s*([A-Z][A-Z :,\-]+)', 2), ' ') AS title FROM pt
    WHERE regexp_matches(substring(text, 1, 500), 'CHAPTER\s+(\d+)\s*\n\s*([A-Z][A-Z :,\-]+)')""")
def chapter_starts(spark, d):
    """Pages that begin a chapter: their first heading, written as chapters are."""
    heads = blocks(spark, d).withColumn("h", F.when(F.col("given") == "heading", F.col("text")))
    first = heads.groupBy(*DOC, "page").agg(F.min_by("h", F.when(F.col("h").isNotNull(), F.struct(*ORDER))).alias("h"))
    text = F.coalesce(F.concat(F.lit("CHAPTER "), F.col("chapter").cast("string"), F.lit("\n"), F.upper("h")), F.lit("none"))
    return S.chapter_starts(first.select("doc", "page", text.alias("text"))).select("doc", "page", "chapter", "title")


@query(f"""{WITH}, p AS (SELECT doc || ' ' || chapter::VARCHAR AS doc, page, seq, text FROM b) SELECT doc, page, length(string_agg(text, chr(10) ORDER BY seq, text))::BIGINT AS n_chars, count(*) AS n_items FROM p GROUP BY 1, 2""")
def page_texts(spark, d):
    b = blocks(spark, d).select(F.concat_ws(" ", "doc", F.col("chapter").cast("string")).alias("doc"), "page", "seq", "text")
    n = b.groupBy("doc", "page").agg(F.count(F.lit(1)).alias("n_items"))
    return layout.page_texts(b).join(n, ["doc", "page"]).select("doc", "page", F.length("text").cast("bigint").alias("n_chars"), "n_items")


QUERIES = Q
