"""Command line: ``python -m strataq VERB ...`` over folders of element tables."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import functions as F

from strataq.functions.text import chapter_of_id
from strataq.operators import clean, compare, gold, quality, registry
from strataq.operators.current import current_rows
from strataq.session import build_session
from strataq.sources.elements import changed_rows, checkpoint_page, read_elements, write_elements, write_elements_json, write_report


def _read(spark, path: str):
    df = read_elements(spark, path) if path.endswith(".json") else spark.read.parquet(path)
    if "loaded_at" not in df.columns:
        return df
    return current_rows(df, [c for c in df.columns if c != "id"])


VERBS = {
    "validate": ["elements"], "clean": ["elements", "output"], "compare": ["run_a", "run_b"], "merge": ["base", "alt", "decisions", "output"],
    "gold": ["elements", "output"], "checkpoint": ["elements"], "manifest": ["elements"], "batch": ["elements"],
}


def _said(report: dict, where: str | None) -> None:
    print(json.dumps(report, default=str))
    if where:
        write_report(report, where)


def validation_report(rows, gold_rows=None) -> dict:
    """Valid rows, links that lead nowhere and, where gold rows are given, the score against them: a few numbers each."""
    checked = quality.validate(rows)
    total = checked.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.size("errors") == 0).alias("passed")).first().asDict()
    links = rows.select("id", F.explode(F.array_distinct("cross_references")).alias("t")).filter("t is not null")
    met = links.join(rows.select(F.col("id").alias("t"), F.lit(1).alias("hit")), "t", "left")
    xref = met.agg(F.count(F.lit(1)).alias("total"), F.count("hit").alias("resolved")).first().asDict()
    types = {r.type: r.n for r in rows.groupBy("type").agg(F.count(F.lit(1)).alias("n")).collect()}
    report = {"schema": total, "cross_references": xref, "types": types}
    if gold_rows is not None:
        report["calibration"] = compare.calibration_report(compare.score_gold(rows, gold_rows, compare.GOLD_FIELDS)).first().asDict()
    return report


def batch_report(rows) -> dict:
    """What a run over all chapters gave: a row a chapter, and the sums."""
    place = {"doc": F.col("source.standard"), "chapter": F.col("source.chapter")}
    per = quality.validity(quality.validate(rows).withColumns(place), ["doc", "chapter"])
    pages = rows.withColumns(place).groupBy("doc", "chapter").agg(F.count_distinct("source.page").alias("pages"))
    chapters = [r.asDict() for r in per.join(pages, ["doc", "chapter"]).orderBy("doc", "chapter").collect()]
    out = rows.select("id", F.explode("cross_references").alias("t")).filter("t is not null").join(rows.select(F.col("id").alias("t")), "t", "left_anti")
    known = rows.select(F.col("source.chapter").alias("c")).distinct()
    lost = out.withColumn("c", chapter_of_id(F.col("t"))).join(known.withColumn("there", F.lit(True)), "c", "left").agg(F.count_if("there").alias("broken"), F.count_if(F.col("there").isNull()).alias("pending")).first()
    done = sum(c["failed"] == 0 for c in chapters)
    return {
        "chapters": chapters, "unresolved": lost.asDict(),
        "summary": {"chapters_processed": len(chapters), "total_elements": sum(c["total"] for c in chapters), "passed": done, "failed": len(chapters) - done},
    }


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="strataq")
    verbs = p.add_subparsers(dest="verb", required=True)
    for verb, names in VERBS.items():
        v = verbs.add_parser(verb)
        for n in names:
            v.add_argument(n)
        v.add_argument("--report", help="a file for the report, as JSON")
        v.add_argument("--gold", help="gold rows to score against")
    a = p.parse_args(argv)
    spark = build_session()
    if a.verb == "validate":
        rows = clean.post_process(_read(spark, a.elements))
        _said(validation_report(rows, _read(spark, a.gold) if a.gold else None), a.report)
        quality.validate(rows).filter(F.size("errors") > 0).select("id", "errors").show(20, False)
    elif a.verb == "clean":
        before = _read(spark, a.elements)
        after = clean.fill_for_output(clean.post_process(before))
        if changed_rows(before, after).head(1):
            write_elements(after, a.output)
    elif a.verb == "compare":
        status = compare.pair_status(compare.match_runs(_read(spark, a.run_a), _read(spark, a.run_b)))
        _said(compare.compare_summary(status).first().asDict(), a.report)
    elif a.verb == "merge":
        base, alt = _read(spark, a.base), _read(spark, a.alt)
        paths = [f.path for f in compare.RUN_FIELDS if f.same in (compare.same_text, compare.exact_text)]
        applied = compare.apply_decisions(base, alt, spark.read.parquet(a.decisions), paths)
        write_elements(compare.merged(base, alt, applied, paths), a.output)
    elif a.verb == "gold":
        write_elements_json(gold.draft_gold(clean.post_process(_read(spark, a.elements))), a.output, by="id")
    elif a.verb == "batch":
        _said(batch_report(_read(spark, a.elements)), a.report)
    else:
        rows = _read(spark, a.elements).withColumns({"doc": F.col("source.standard"), "chapter": F.col("source.chapter"), "section": F.col("source.section"), "citation": F.col("source.citation")})
        if a.verb == "checkpoint":
            print(checkpoint_page(quality.checkpoint(rows, ["doc", "chapter"], "chapter")))
        else:
            registry.manifest(rows, ["doc", "chapter"]).show(1000, False)


if __name__ == "__main__":
    main()
