"""Element files in and out."""

from __future__ import annotations

import json
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from strataq.functions.text import html_escape
from strataq.operators.quality import validate

#: The payload is a union of six shapes; ``parameters`` is a map in one and a list in another.
ELEMENT = """
id string, type string, title string, description string, parent_id string, cross_references array<string>,
source struct<standard:string,chapter:int,section:string,citation:string,page:int>,
metadata struct<extracted_by:string,qc_status:string,qc_notes:string>,
data struct<rule:string,conditions:array<struct<parameter:string,operator:string,value_num:double,value_str:string,unit:string>>,then_text:string,else_text:string,exceptions:array<string>,
term:string,definition:string,columns:array<struct<name:string,unit:string>>,rows:array<map<string,string>>,expression:string,
parameters:map<string,struct<unit:string,range:array<double>,source:string>>,target:string,url:string,reference_parameters:array<string>,
figure_type:string,description:string,source_pdf_page:int>""".replace("\n", "")


def _typed(raw: DataFrame) -> DataFrame:
    """Rows with the variant ``e`` as typed element rows; all of it stays in ``e``.

    ``data_keys`` tells absent fields from null ones.  A condition's value is a
    number or a text; a value of the wrong type is null.
    """

    def at(path: str, kind: str) -> str:
        return f"try_variant_get(e, '{path}', '{kind}')"

    texts = ("id", "type", "title", "description", "parent_id")
    source = ", ".join(f"'{c}', {at('$.source.' + c, k)}" for c, k in (("standard", "string"), ("chapter", "int"), ("section", "string"), ("citation", "string"), ("page", "int")))
    meta = ", ".join(f"'{c}', {at('$.metadata.' + c, 'string')}" for c in ("extracted_by", "qc_status", "qc_notes"))
    value = "try_variant_get(c, '$.value', 'string')"
    is_number = "schema_of_variant(try_variant_get(c, '$.value', 'variant')) not in ('STRING', 'BOOLEAN', 'VOID')"
    conditions = f"""transform({at('$.data.conditions', 'array<variant>')}, c -> named_struct(
        'parameter', try_variant_get(c, '$.parameter', 'string'), 'operator', try_variant_get(c, '$.operator', 'string'),
        'value_num', if({is_number}, try_variant_get(c, '$.value', 'double'), null), 'value_str', if({is_number}, null, {value}), 'unit', try_variant_get(c, '$.unit', 'string')))"""
    kinds = {
        "rule": "string", "exceptions": "array<string>", "term": "string", "definition": "string", "columns": "array<struct<name:string,unit:string>>",
        "rows": "array<map<string,string>>", "expression": "string", "target": "string", "url": "string", "figure_type": "string", "description": "string", "source_pdf_page": "int",
    }
    slots = {c: at(f"$.data.{c}", k) for c, k in kinds.items()} | {
        "conditions": conditions,
        "then_text": at("$.data.then", "string"),
        "else_text": at("$.data.else", "string"),
        "parameters": at("$.data.parameters", "map<string,struct<unit:string,range:array<double>,source:string>>"),
        "reference_parameters": at("$.data.parameters", "array<string>"),
    }
    order = [f.name for f in next(f for f in raw.sparkSession.createDataFrame([], ELEMENT).schema if f.name == "data").dataType]
    data = ", ".join(f"'{c}', {slots[c]}" for c in order)
    return raw.selectExpr(
        *(f"{at('$.' + c, 'string')} as {c}" for c in texts),
        f"{at('$.cross_references', 'array<string>')} as cross_references",
        f"named_struct({source}) as source",
        f"named_struct({meta}) as metadata",
        f"named_struct({data}) as data",
        f"map_keys({at('$.data', 'map<string,variant>')}) as data_keys",
        "file",
        "seq",
        "e as raw",
    )


def read_elements(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Element rows of JSON files, each an array of elements or one element.

    ``seq`` is the place in the file, ``file`` its path and ``chapter_of_file`` the
    number in a name ``ch<n>``.  A file that can't be read gives no row; see
    ``unreadable``.  ``lines``: the files are known to hold a value a line, as
    ``write_elements_json`` writes them; then a task holds a line, not a file.
    """
    whole = (_lines if lines else _whole)(spark, path).filter("j is not null")
    items = whole.select("file", F.posexplode(F.expr("coalesce(try_variant_get(j, '$', 'array<variant>'), array(j))")).alias("seq", "e"))
    return _typed(items).withColumn("chapter_of_file", F.regexp_extract("file", r"ch(\d+)[^/]*$", 1).try_cast("int"))


def unreadable(spark: SparkSession, path: str) -> DataFrame:
    return _whole(spark, path).filter("j is null").select("file")


def _whole(spark: SparkSession, path: str) -> DataFrame:
    """(file, j) of each file, and of each line of a file that isn't one JSON value but one a line."""
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    lines = F.filter(F.split("value", "\n"), lambda x: F.trim(x) != "")
    one = F.when((F.json_array_length(F.concat(F.lit("["), "value", F.lit("]"))) == 1) | (F.size(lines) < 2), F.array("value")).otherwise(lines)
    return text.select("file", F.explode_outer(one).alias("v")).select("file", F.expr("try_parse_json(v)").alias("j"))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, j) of each line that isn't blank: what ``_whole`` gives of files with a value a line, whatever their size."""
    return spark.read.text(path).filter(F.trim("value") != "").select(F.col("_metadata.file_path").alias("file"), F.expr("try_parse_json(value)").alias("j"))


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """Valid gold elements, by file name; unreadable and invalid files are skipped."""
    rows = validate(read_elements(spark, path))
    return rows.filter(F.size("errors") == 0).drop("errors").orderBy("file", "seq")


def page_images(spark: SparkSession, path: str) -> DataFrame:
    """(page, file) of images named ``page-<n>.png``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "page-*.png").load(path).select("path")
    return files.select(F.regexp_extract("path", r"page-(\d+)\.png$", 1).cast("int").alias("page"), F.col("path").alias("file"))


def table_or_empty(spark: SparkSession, name: str, schema: str) -> DataFrame:
    """A table of the catalog, or an empty one where it isn't there yet."""
    return spark.table(name) if spark.catalog.tableExists(name) else spark.createDataFrame([], schema)


def write_elements(elements: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet by standard and chapter: what later reads prune by.

    Rows are ranged by place first, so a folder gets one file (more only where it is
    larger than a task's range or lies across two), not one from each task.
    """
    named = elements.withColumns({"standard": F.col("source.standard"), "chapter": F.col("source.chapter")})
    named.repartitionByRange("standard", "chapter", "id").write.mode(mode).partitionBy("standard", "chapter").parquet(path)


def read_chapter(spark: SparkSession, path: str, chapter: int, schema: StructType) -> DataFrame:
    """One chapter of what ``write_elements`` wrote (rows of ``schema``); only its own folders are listed.

    ``standard`` is the folder's, where blank and null are one; ``source.standard`` tells them apart.
    """
    placed = StructType([*schema.fields, StructField("standard", StringType()), StructField("chapter", IntegerType())])
    folders = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/standard=*/chapter={chapter}")
    if not folders.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(folders):
        return spark.createDataFrame([], placed)
    return spark.read.schema(placed).option("basePath", path).parquet(folders.toString())


def as_json() -> Column:
    """An element row as the JSON object that ``read_elements`` reads; absent fields are left out."""
    value = lambda c: F.coalesce(c["value_num"].cast("variant"), c["value_str"].cast("variant"))
    conditions = F.transform("data.conditions", lambda c: F.struct(c["parameter"].alias("parameter"), c["operator"].alias("operator"), value(c).alias("value"), c["unit"].alias("unit")))
    parameters = F.coalesce(F.expr("cast(parse_json(to_json(data.parameters)) as variant)"), F.expr("cast(parse_json(to_json(data.reference_parameters)) as variant)"))
    kept = ("rule", "exceptions", "term", "definition", "columns", "rows", "expression", "target", "url", "figure_type", "description", "source_pdf_page")
    data = F.struct(
        *(F.col(f"data.{c}").alias(c) for c in kept), conditions.alias("conditions"), F.col("data.then_text").alias("then"), F.col("data.else_text").alias("else"), parameters.alias("parameters")
    )
    top = ("id", "type", "title", "description", "parent_id", "source", "metadata", "cross_references")
    return F.to_json(F.struct(*top, data.alias("data")))


def write_elements_json(elements: DataFrame, path: str, by: str | None = None, mode: str = "overwrite", compression: str = "none") -> None:
    """One JSON object a line; ``by`` (as ``id`` for gold rows) puts each value in a folder of its own."""
    w = elements.select(as_json().alias("value"), *([by] if by else [])).write.mode(mode)
    (w.partitionBy(by) if by else w).text(path, compression=compression)


def changed_rows(before: DataFrame, after: DataFrame, key: str = "id") -> DataFrame:
    """Rows of ``after`` that differ from ``before``; none: nothing needs to be written again."""
    old = before.select(F.col(key).alias("_k"), F.to_json(F.struct(*(c for c in before.columns if c != key))).alias("_old"))
    new = after.withColumn("_new", F.to_json(F.struct(*(c for c in before.columns if c != key))))
    return new.join(old, new[key] == F.col("_k")).filter(~F.col("_new").eqNullSafe(F.col("_old"))).drop("_k", "_old", "_new")


def markdown(elements: DataFrame) -> DataFrame:
    """(standard, chapter, seq, line): elements as Markdown lines."""
    depth = F.least(F.size(F.split("source.section", r"\.")), F.lit(6))
    text = F.coalesce("data.rule", "data.definition", "data.expression", "data.target", "title", F.lit(""))
    line = (
        F.when(F.col("type") == "heading", F.concat(F.repeat(F.lit("#"), depth), F.lit(" "), text))
        .when(F.col("type") == "definition", F.concat(F.lit("**"), F.coalesce("data.term", F.lit("")), F.lit("**: "), F.coalesce("data.definition", F.lit(""))))
        .when(F.col("type") == "formula", F.concat(F.lit("`"), text, F.lit("`")))
        .otherwise(text)
    )
    return elements.select("source.standard", "source.chapter", "seq", line.alias("line"))


def write_report(report: dict, path: str) -> None:
    """A report of a few numbers as one JSON file, with the time it was made."""
    made = {"timestamp": datetime.now(UTC).isoformat()} | report
    with open(path, "w", encoding="utf-8") as f:
        json.dump(made, f, indent=2, default=str, ensure_ascii=False)


def checkpoint_page(chapters: DataFrame, title: str = "Checkpoint") -> str:
    """An HTML table of the checkpoint of each chapter: a row a chapter reaches the driver."""
    cells = F.array(*(html_escape(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in chapters.columns))
    row = F.concat(F.lit("<tr><td>"), F.array_join(cells, "</td><td>"), F.lit("</td></tr>"))
    head = "".join(f"<th>{c}</th>" for c in chapters.columns)
    body = "\n".join(r.row for r in chapters.select(row.alias("row"), *chapters.columns[:2]).orderBy(*chapters.columns[:2]).toLocalIterator())
    return f"<!doctype html><title>{title}</title><table><tr>{head}</tr>\n{body}\n</table>"
