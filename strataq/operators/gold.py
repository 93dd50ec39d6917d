"""Gold rows: the draft selection and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataq.operators.quality import validate


def draft_gold(elements: DataFrame, most: int = 3, order: list[str] | None = None) -> DataFrame:
    """Up to ``most`` valid elements of each type, those that passed review first; all marked passed."""
    w = Window.partitionBy("type").orderBy((~F.col("metadata.qc_status").eqNullSafe("passed")).cast("int"), *(order or ["seq", "id"]))
    valid = validate(elements).filter(F.size("errors") == 0).drop("errors")
    top = valid.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= most).drop("_rn")
    return top.withColumn("metadata", F.col("metadata").withField("qc_status", F.lit("passed")))


def spot_sample(elements: DataFrame, n: int = 30, key: str = "id") -> DataFrame:
    """A sample of ``n`` rows that is the same in every run."""
    return elements.orderBy(F.md5(F.col(key).cast("string")), key).limit(n)
