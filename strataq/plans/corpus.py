"""The corpus the queries run on: current elements, and the text blocks they stand for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataq.sources import table


def current(spark: SparkSession, d: str, name: str = "elements") -> DataFrame:
    """The row of each id that was loaded last (extracted last, read last where that ties).

    A rank rather than an aggregate of whole rows: columns a query doesn't use are not
    read, and each task keeps one row an id before the shuffle.
    """
    w = Window.partitionBy("id").orderBy(*(F.desc_nulls_last(c) for c in ("loaded_at", "extracted_at", "seq")))
    ranked = table(spark, d, name).filter("id is not null").withColumn("_rank", F.row_number().over(w))
    return ranked.filter("_rank = 1").drop("_rank")


CUR = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC NULLS LAST, extracted_at DESC NULLS LAST, seq DESC) AS rn FROM {t} WHERE id IS NOT NULL) WHERE rn = 1"

_BLOCK = """
    source.standard AS doc, source.chapter AS chapter, seq, id, coalesce(source.page, 0) AS page,
    source.section AS section, type AS given,
    CASE WHEN type = 'heading' THEN 'section_header' ELSE 'text' END AS label,
    CASE type WHEN 'heading' THEN coalesce(data.rule, '') WHEN 'definition' THEN coalesce(data.term, '')
        WHEN 'exception' THEN 'EXCEPTION:' WHEN 'user_note' THEN 'User Note:' ELSE '' END AS bold,
    CASE type WHEN 'definition' THEN concat(coalesce(data.term, ''), ': ', coalesce(data.definition, ''))
        WHEN 'exception' THEN concat('EXCEPTION: ', coalesce(data.rule, ''))
        WHEN 'user_note' THEN concat('User Note: ', coalesce(data.rule, ''))
        WHEN 'formula' THEN concat(coalesce(data.expression, ''), ' ', replace(coalesce(source.citation, ''), 'Eq. ', ''))
        WHEN 'reference' THEN coalesce(data.target, '')
        WHEN 'figure' THEN concat(coalesce(source.citation, ''), ' ', coalesce(data.description, ''))
        WHEN 'table' THEN concat(coalesce(source.citation, ''), ' ', coalesce(title, ''))
        ELSE coalesce(data.rule, '') END AS text"""


def blocks(spark: SparkSession, d: str) -> DataFrame:
    """Ordered text blocks of each document: what a layout parser hands over."""
    return current(spark, d).selectExpr(*_columns(_BLOCK))


def _columns(select: str) -> list[str]:
    out, depth, now = [], 0, ""
    for word in select.split():
        depth += word.count("(") - word.count(")") + (word in ("CASE",)) - (word in ("END",))
        now += " " + word
        if word.endswith(",") and depth == 0:
            out.append(now.strip().rstrip(","))
            now = ""
    return [*out, now.strip()]


#: SQL for the start of a query: ``cur`` and ``b``.
WITH = f"WITH cur AS ({CUR.format(t='elements')}), b AS (SELECT {_BLOCK} FROM cur)"
