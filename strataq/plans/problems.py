"""The queries of the general data problems, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataq.operators import copydiff, hierarchy, nested, refcheck
from strataq.sources import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return nested.element_children(table(spark, d, "raw_records"))


def p1_sections(spark: SparkSession, d: str) -> DataFrame:
    return nested.flatten_records(table(spark, d, "raw_records"))["sections"]


def p1_elements(spark: SparkSession, d: str) -> DataFrame:
    return nested.flatten_records(table(spark, d, "raw_records"))["elements"].select(
        "record_id", "element_path", "section_path", "element_id", "type", "title", "parent_id"
    )


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return copydiff.diff_copies(table(spark, d, "elements"), table(spark, d, "elements_b"), copydiff.ELEMENT_FIELDS)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.deep_or_cyclic(table(spark, d, "elements"))


def p4_paths(spark: SparkSession, d: str) -> DataFrame:
    found = hierarchy.hierarchy(table(spark, d, "elements"), paths=True)
    return found.withColumn("path", F.array_join("path", " > "))


def p4_descendants(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.descendants(hierarchy.hierarchy(table(spark, d, "elements"), paths=True))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    found = refcheck.element_orphans(table(spark, d, "elements"), table(spark, d, "decisions"), table(spark, d, "withdrawals"))
    return found.select("ref_table", "ref_id", "target_id", "period").distinct()


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    found = refcheck.element_orphans(table(spark, d, "elements"), table(spark, d, "decisions"), table(spark, d, "withdrawals"))
    return refcheck.orphan_report(found)


QUERIES = {f.__name__: f for f in (p1_found, p1_sections, p1_elements, p2_found, p4_found, p4_paths, p4_descendants, p5_found, p5_report)}

from strataq.plans.problems_sql import SQL  # noqa: E402, F401
