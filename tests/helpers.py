"""Small element tables for tests."""

from __future__ import annotations

from datetime import datetime, timedelta

from strataq.sources.elements import ELEMENT

SCHEMA = ELEMENT + ", seq bigint, extracted_at timestamp, loaded_at timestamp"
BASE = datetime(2024, 1, 1)
DATA = dict.fromkeys(
    "rule conditions then_text else_text exceptions term definition columns rows expression parameters target url reference_parameters figure_type description source_pdf_page".split()
)


def element(id_, day=0, **kw):
    data = DATA | kw.pop("data", {})
    row = {
        "id": id_, "type": "provision", "title": "T", "description": None, "parent_id": None, "cross_references": None,
        "source": {"standard": "STD 1-20", "chapter": 1, "section": "1.1", "citation": "Section 1.1", "page": 1},
        "metadata": {"extracted_by": "auto", "qc_status": "pending", "qc_notes": None},
        "data": data, "seq": 1, "extracted_at": BASE, "loaded_at": None if day is None else BASE + timedelta(days=day),
    }
    row["source"] = row["source"] | kw.pop("source", {})
    row["metadata"] = row["metadata"] | kw.pop("metadata", {})
    return row | kw


def elements(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def pairs(df):
    return sorted(tuple(r) for r in df.collect())
