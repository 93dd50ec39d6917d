"""Layout items as relations.

Parsers of page formats are adapters outside this package: a function from a file's
bytes to rows, run where the file is.  Everything after them is relational.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataq.functions.text import LIGATURES

SPANS = "doc string, page int, span_seq int, y double, text string, bold_prefix string, all_bold boolean"
TEXT_ITEMS = "doc string, seq bigint, page int, label string, text string, l double, t double, r double, b double"
TABLE_CELLS = "doc string, table_id int, page int, start_row int, start_col int, text string"
CHARS = "doc string, page int, seq bigint, text string, x0 double, x1 double, top double, bottom double, font string, size double"


def parse_files(spark: SparkSession, path: str, parser: Callable[[str, bytes], Iterable[dict]], schema: str, glob: str = "*") -> DataFrame:
    """Rows that ``parser(path, content)`` yields for each file, one file at a time."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")
    names = spark.createDataFrame([], schema).columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for where, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows = list(parser(where, content))
                if rows:
                    yield pa.RecordBatch.from_pydict({n: [r.get(n) for r in rows] for n in names})

    return files.mapInArrow(run, schema)


def page_texts(items: DataFrame) -> DataFrame:
    """(doc, page, text): the text of each page, its items in order, a line each."""
    parts = items.groupBy("doc", "page").agg(F.array_sort(F.collect_list(F.struct("seq", "text"))).alias("p"))
    return parts.select("doc", "page", F.array_join(F.transform("p", lambda x: x["text"]), "\n").alias("text"))


def clean_chars(chars: DataFrame, left: float = 40, foot: float = 770) -> DataFrame:
    """Without margins, footers and fallback fonts; ligatures as letters."""
    kept = chars.filter((F.col("x0") >= left) & (F.col("top") <= foot) & ~F.coalesce(F.col("font"), F.lit("")).rlike(r"\+f[bc]"))
    text = F.col("text")
    for old, new in LIGATURES.items():
        text = F.replace(text, F.lit(old), F.lit(new))
    return kept.withColumn("text", text)


def line_spans(spans: DataFrame, line: list[str], order: list[str]) -> DataFrame:
    """(line..., text, bold_prefix, all_bold): spans of a line with the bold ones it starts with.

    ``spans``: line..., order..., text, bold.
    """
    w = Window.partitionBy(*line).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    led = spans.withColumn("_lead", F.min(F.col("bold").cast("int")).over(w) == 1)
    parts = led.groupBy(*line).agg(F.array_sort(F.collect_list(F.struct(*order, "text", "_lead"))).alias("p"), F.bool_and("bold").alias("all_bold"))
    joined = lambda a: F.array_join(F.transform(a, lambda x: x["text"]), "")
    return parts.select(*line, joined(F.col("p")).alias("text"), joined(F.filter("p", lambda x: x["_lead"])).alias("bold_prefix"), "all_bold")


def font_map(spans: DataFrame) -> DataFrame:
    """(doc, page, y, bold, size, font): one entry a line height; a bold one wins over others, then the later."""
    entry = F.struct("bold", "size", "font")
    best = spans.groupBy("doc", "page", F.round("y").cast("int").alias("y")).agg(F.max_by(entry, F.struct(F.col("bold").cast("int"), "span_seq")).alias("v"))
    return best.select("doc", "page", "y", "v.*")
