"""One plan from text blocks to linked element rows, for a whole corpus at once.

Chapters are a partition key, not a loop: classification, sections, ids, payloads,
item rows, links, parents and clean-up are stages of one DataFrame plan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataq.functions.text import mentions
from strataq.operators import classify as C
from strataq.operators import emit as E
from strataq.operators import link as L
from strataq.operators import sequence as S
from strataq.session import durable

DOC, ORDER = ["doc", "chapter"], ["seq", "id"]


def typed(blocks: DataFrame, classifier: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The blocks with ``kind`` and ``note``; without a classifier, by the patterns learned from each chapter."""
    return classifier(blocks) if classifier else C.classify(blocks, C.learn_patterns(blocks, DOC), DOC)


def by_column(kind: Column) -> Callable[[DataFrame], DataFrame]:
    """A classifier of a column expression, for the alternative pipelines; null drops the block."""
    return lambda blocks: blocks.withColumn("kind", kind).filter("kind is not null").withColumn("note", F.lit(None).cast("string"))


def elements_of(blocks: DataFrame, classifier: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(doc, chapter, seq, id, new_id, kind, section, citation, title, rule, term, definition, target, note).

    Near-empty and repeated blocks go; ids are counted within section and type.
    """
    filled = S.fill_section(typed(blocks, classifier), DOC, ORDER)
    named = S.assign_ids(filled, DOC, ORDER, F.replace("doc", F.lit(" "), F.lit("")))
    made = named.withColumn("_p", E.payload(F.col("kind"), F.col("note"), F.col("text")))
    kept = S.drop_near_empty(S.dedup_blocks(made.withColumn("section", F.col("in_section")), DOC, ORDER))
    title = F.when(F.col("kind") == "heading", F.col("text")).otherwise(E.titled(F.col("text")))
    return kept.select(*DOC, *ORDER, "new_id", "kind", "section", F.concat(F.lit("Section "), "section").alias("citation"), title.alias("title"), "_p.*", "note", "text")


def run(blocks: DataFrame, index: DataFrame, classifier: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The element rows with ``targets`` (links by number) and ``parent`` (of text blocks).

    ``index``: doc, chapter, kind, num, target of the items that numbers name.
    """
    rows = durable(elements_of(blocks, classifier))  # read for the links, the parents and the result
    said = rows.select(*DOC, F.col("new_id").alias("id"), F.inline(mentions(F.col("text"))))
    wide = index.groupBy("doc", "kind", "num").agg(F.max("target").alias("target"))
    linked = L.cross_references(L.resolve_mentions(said, index, wide, DOC, ["doc"])).withColumnRenamed("id", "new_id")
    parents = L.associate(rows.drop("id").withColumnRenamed("new_id", "id"), DOC, ["seq", "id"]).select(F.col("id").alias("new_id"), "parent")
    return rows.join(linked, "new_id", "left").join(parents, "new_id", "left")
