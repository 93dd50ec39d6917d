"""Joins by place on a page.

Each is an equi-join on the page and a bucket of the coordinate, so that a page
with many items makes no product of all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nearest(
    left: DataFrame, right: DataFrame, page: list[str], at: str, left_id: str, right_order: list[str], within: float, carry: list[str], ahead_first: bool = False, default: dict | None = None
) -> DataFrame:
    """Adds ``carry`` of the row of ``right`` nearest in ``at`` on the same page.

    Closer than ``within`` only; of equally near ones the one ahead if ``ahead_first``,
    then the first in ``right_order``.  Where none is near, the ``default`` of a column.
    """
    b = lambda c: F.floor(F.col(c) / within)
    near = left.select(*page, left_id, F.col(at).alias("_at"), F.explode(F.array(b(at) - 1, b(at), b(at) + 1)).alias("_b"))
    cand = near.join(right.select(*page, F.col(at).alias("_r"), b(at).alias("_b"), *right_order, *(c for c in carry if c not in right_order)), [*page, "_b"])
    gap = F.abs(F.col("_at") - F.col("_r"))
    best = cand.filter(gap < within).groupBy(*page, left_id).agg(F.min_by(F.struct(*carry), F.struct(gap, (F.col("_r") < F.col("_at")) & F.lit(ahead_first), *right_order)).alias("_v"))
    held = lambda c: F.coalesce(F.col(f"_v.{c}"), F.lit(default[c])) if c in (default or {}) else F.col(f"_v.{c}")
    return left.join(best, [*page, left_id], "left").select(*left.columns, *(held(c).alias(c) for c in carry))


def contained(points: DataFrame, boxes: DataFrame, page: list[str], x: str, y: str, margin: float, cell: float = 100.0) -> DataFrame:
    """(box columns, point columns): points inside boxes widened by ``margin``.

    ``boxes``: page..., l, t, r, b.  A box is looked for in the grid cells it covers.
    """
    lo, hi = lambda c: F.floor((F.col(c) - margin) / cell), lambda c: F.floor((F.col(c) + margin) / cell)
    grid = boxes.withColumn("_gx", F.explode(F.sequence(lo("l"), hi("r")))).withColumn("_gy", F.explode(F.sequence(lo("t"), hi("b"))))
    at = points.withColumns({"_gx": F.floor(F.col(x) / cell), "_gy": F.floor(F.col(y) / cell)})
    met = grid.join(at, [*page, "_gx", "_gy"])
    inside = F.col(x).between(F.col("l") - margin, F.col("r") + margin) & F.col(y).between(F.col("t") - margin, F.col("b") + margin)
    return met.filter(inside).drop("_gx", "_gy")


def overlap(a: str, b: str) -> Column:
    """Common area of two boxes given as columns with prefixes."""
    w = F.least(f"{a}r", f"{b}r") - F.greatest(f"{a}l", f"{b}l")
    h = F.least(f"{a}b", f"{b}b") - F.greatest(f"{a}t", f"{b}t")
    return F.greatest(w, F.lit(0)) * F.greatest(h, F.lit(0))


def area(a: str) -> Column:
    return (F.col(f"{a}r") - F.col(f"{a}l")) * (F.col(f"{a}b") - F.col(f"{a}t"))


def iou(a: str, b: str) -> Column:
    both = overlap(a, b)
    return both / F.nullif(area(a) + area(b) - both, F.lit(0))


def most_overlapping(regions: DataFrame, known: DataFrame, page: list[str], least: float = 0.2, cell: float = 100.0, carry: tuple[str, ...] = ()) -> DataFrame:
    """(page..., region_id, known_id, carry...): the known region that covers most of each region, and what it is told by.

    More than ``least`` of the region's area; the first known one where areas tie.
    """
    spans = lambda p: F.sequence(F.floor(F.col(f"{p}l") / cell), F.floor(F.col(f"{p}r") / cell))
    a = regions.select(*page, "region_id", *(F.col(c).alias(f"a_{c}") for c in "ltrb")).withColumn("_g", F.explode(spans("a_")))
    b = known.select(*page, "known_id", *carry, *(F.col(c).alias(f"b_{c}") for c in "ltrb")).withColumn("_g", F.explode(spans("b_")))
    met = a.join(b, [*page, "_g"]).drop("_g").distinct().withColumn("_o", overlap("a_", "b_"))
    enough = met.filter(F.col("_o") > least * area("a_"))
    best = F.min_by(F.struct("known_id", *carry), F.struct(-F.col("_o"), F.col("known_id")))
    return enough.groupBy(*page, "region_id").agg(best.alias("_v")).select(*page, "region_id", "_v.*")


def greedy_matches(gold: DataFrame, predicted: DataFrame, page: str, threshold: float = 0.3) -> DataFrame:
    """(page, n_gold, n_predicted, n_matched, n_type, sum_iou): greedy one-to-one matching.

    Each gold region in turn takes the best prediction still free (the first of
    equal ones), so the regions of a page are one sequential step.  Pages are
    streamed in order through each partition, not handed over one by one.
    """
    cols = [page, "side", "n", "kind", "l", "t", "r", "b"]
    box = [F.col(c).cast("double").alias(c) for c in "ltrb"]
    both = gold.select(page, F.lit(0).alias("side"), "n", "kind", *box).unionByName(predicted.select(page, F.lit(1).alias("side"), "n", "kind", *box))
    placed = both.select(cols).repartition(page).sortWithinPartitions(page, "side", "n")
    kind = both.schema[page].dataType.simpleString()

    def score(rows: list[tuple]) -> tuple:
        golds, free = [r for r in rows if r[1] == 0], [r for r in rows if r[1] == 1]
        l_, t_, r_, b_ = np.array([r[4:8] for r in free], float).reshape(-1, 4).T
        taken = np.zeros(len(free), bool)
        matched, same, total = 0, 0, 0.0
        for _, _, _, k, l, t, r, b in golds:  # one gold region against all predictions at once
            both = np.clip(np.minimum(r, r_) - np.maximum(l, l_), 0, None) * np.clip(np.minimum(b, b_) - np.maximum(t, t_), 0, None)
            whole = (r - l) * (b - t) + (r_ - l_) * (b_ - t_) - both
            v = np.divide(both, whole, out=np.zeros(len(free)), where=(both > 0) & ~taken)
            at = int(v.argmax()) if len(free) else 0
            if len(free) and v[at] > 0 and v[at] >= threshold:
                taken[at] = True
                same += free[at][3] == k
                matched += 1
                total += float(v[at])
        return rows[0][0], len(golds), len(free), matched, same, total

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [page, "n_gold", "n_predicted", "n_matched", "n_type", "sum_iou"]
        held: list[tuple] = []
        page_type = None
        for batch in batches:
            page_type = batch.column(0).type
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[-1][0] != row[0]:
                    out.append(score(held))
                    held = []
                held.append(row)
            if out:
                yield _batch(out, names, page_type)
        if held:
            yield _batch([score(held)], names, page_type)

    def _batch(out: list[tuple], names: list[str], page_type: pa.DataType) -> pa.RecordBatch:
        kinds = [page_type, *[pa.int64()] * 4, pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return placed.mapInArrow(run, f"{page} {kind}, n_gold long, n_predicted long, n_matched long, n_type long, sum_iou double")


def match_scores(matches: DataFrame) -> DataFrame:
    """Means over pages of precision, recall, type accuracy and overlap."""
    per = lambda a, b: F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0))
    return matches.agg(
        F.avg(per("n_matched", "n_predicted")).alias("precision"),
        F.avg(per("n_matched", "n_gold")).alias("recall"),
        F.avg(per("n_type", "n_matched")).alias("type_accuracy"),
        F.avg(per("sum_iou", "n_matched")).alias("mean_iou"),
    )


def normalized_box(width: Column, height: Column) -> list[Column]:
    """Centre and size of a box as shares of the page, within 0 and 1."""
    clamp = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))
    return [
        clamp((F.col("l") + F.col("r")) / 2 / width).alias("cx"),
        clamp((F.col("t") + F.col("b")) / 2 / height).alias("cy"),
        clamp((F.col("r") - F.col("l")) / width).alias("w"),
        clamp((F.col("b") - F.col("t")) / height).alias("h"),
    ]


def flipped(y: Column, height: Column) -> Column:
    """A distance from the foot of the page as one from its head."""
    return height - y


def scaled(x: Column, dpi: int, points: int = 72) -> Column:
    """A length in points as one in pixels."""
    return x * F.lit(dpi / points)


def block_boxes(chars: DataFrame, block: list[str]) -> DataFrame:
    """(block..., n, x0, top, x1, bottom, size, any_bold, all_bold): what the characters of each block span."""
    return chars.groupBy(*block).agg(
        F.count(F.lit(1)).alias("n"), F.min("x0").alias("x0"), F.min("top").alias("top"), F.max("x1").alias("x1"), F.max("bottom").alias("bottom"),
        F.avg("size").alias("size"), F.bool_or("bold").alias("any_bold"), F.bool_and("bold").alias("all_bold"),
    )
