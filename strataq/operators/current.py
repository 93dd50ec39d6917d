"""The current version of each key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows without a load time count as older than all others.
NEVER = "timestamp'0001-01-01 00:00:00'"


def age(loaded: str = "loaded_at") -> Column:
    return F.coalesce(F.col(loaded), F.expr(NEVER))


def current_rows(df: DataFrame, columns: list[Column | str], key: str = "id", loaded: str = "loaded_at") -> DataFrame:
    """One row per key, with ``columns`` of the row loaded last.

    Aggregated before the shuffle, so a key that holds a large share of all rows
    costs no more than another.  Rows that tie on the load time are taken to be
    equal in ``columns``; a null key is dropped, it names nothing.
    """
    named = [F.col(c) if isinstance(c, str) else c for c in columns]
    kept = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("k"), age(loaded).alias("t"), F.struct(*named).alias("v"))
    return kept.groupBy("k").agg(F.max_by("v", "t").alias("v")).select(F.col("k").alias(key), "v.*")
