"""The queries of the text problems, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strataq.llm import leakage, lookalike, packing, spans
from strataq.sources import table


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.look_same(table(spark, d, "elements"))


def p3_forms(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.forms(table(spark, d, "elements")).select("id", "field", "form")


def p3_classes(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.look_classes(table(spark, d, "elements"))


def p6_packed(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "documents"), table(spark, d, "containers"))


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    containers = table(spark, d, "containers")
    return packing.fill_report(packing.pack(table(spark, d, "documents"), containers), containers)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return spans.shared_spans(table(spark, d, "documents"))


def p8_shared_chars(spark: SparkSession, d: str) -> DataFrame:
    return spans.shared_chars(table(spark, d, "documents"))


QUERIES = {f.__name__: f for f in (p3_found, p3_forms, p3_classes, p6_packed, p6_report, p7_found, p8_found, p8_shared_chars)}

#: No SQL: look-alike lattices, packing, token windows and long spans are tested against brute force.
SQL: dict[str, str] = {}
