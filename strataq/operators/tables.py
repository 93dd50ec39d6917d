"""Table cells to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cells_to_rows(cells: DataFrame, key: list[str], row: str = "row", col: str = "col", text: str = "text") -> DataFrame:
    """(key..., row, cells): body rows as maps from the header's names to the texts.

    Row 0 is the header; a column without a name is ``col_i``; where a place or a
    name comes twice, the last counts; gaps in the grid are ''.
    """
    placed = cells.groupBy(*key, row, col).agg(F.max(F.struct(text)).alias("t")).select(*key, row, col, F.col("t")[text].alias(text))
    head = placed.filter(F.col(row) == 0).select(*key, col, F.coalesce(F.nullif(F.trim(text), F.lit("")), F.concat(F.lit("col_"), F.col(col))).alias("name"))
    width = placed.groupBy(*key).agg((F.max(col) + 1).alias("n"))
    rows = placed.filter(F.col(row) > 0).groupBy(*key, row).agg(F.map_from_entries(F.collect_list(F.struct(col, text))).alias("by"))
    names = head.groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct(col, "name"))).alias("names"))
    grid = rows.join(width, key).join(names, key, "left")
    each = F.transform(
        F.sequence(F.lit(0), F.col("n") - 1),
        lambda i: F.struct(F.coalesce(F.element_at("names", i), F.concat(F.lit("col_"), i)).alias("k"), F.coalesce(F.element_at("by", i), F.lit("")).alias("v"), i.alias("i")),
    )
    # The last of equal names: kept without a session-wide setting for map keys.
    last = F.filter(each, lambda x: ~F.exists(each, lambda y: (y["k"] == x["k"]) & (y["i"] > x["i"])))
    return grid.select(*key, row, F.map_from_entries(F.transform(last, lambda x: F.struct(x["k"], x["v"]))).alias("cells"))


def captions(items: DataFrame, texts: DataFrame, page: list[str], word: str = "Table") -> DataFrame:
    """Adds ``caption``: the first text of the page that names such an item."""
    named = texts.filter(F.col("text").rlike(rf"^{word}\s+\d+\.\d+-\d+"))
    first = named.groupBy(*page).agg(F.min_by("text", "seq").alias("caption"))
    return items.join(first, page, "left")
