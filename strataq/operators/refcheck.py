"""References to records that do not exist.

References and the events of their targets (first load, loads, withdrawals) are
put into one stream, co-partitioned and sorted by target and time with a range
partitioning, and merged linearly: each reference meets the state its target has
at that time.  The sort key goes on to the reference itself, so a target that
holds a large share of all references is split over many partitions; the state at
the end of each partition (one row a partition) is carried to the next.

Defined results
---------------
* ``missing``: the target never loads; ``late``: its first load is after the
  reference; ``deleted``: the last event up to the reference is a withdrawal;
* a load and a withdrawal at the same instant: the load counts as the later one;
* targets are trimmed of plain spaces; null and blank ones are no references;
* a reference without a time lies before every event; events without a time or
  target are ignored; repeated references come out once; empty tables are fine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataq.operators.current import current_rows
from strataq.session import durable

# The order of what happens at one instant.
_FIRST, _WITHDRAWN, _LOADED, _REFERENCE = 0, 1, 2, 3
_OUT = "part int, row_kind string, target_id string, ref_table string, ref_id string, at timestamp, status string, first_load timestamp, head boolean, same boolean, alive boolean"
_KEYS = ["target_id", "at", "what", "ref_table", "ref_id"]


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The linear merge of one sorted partition.

    State of a target: its first load and whether the last event is a load.
    Hanging references of the partition's first target whose first load this
    partition doesn't tell are handed on as ``head``: an earlier one may.
    """
    part = TaskContext.get().partitionId()
    ts = pa.timestamp("us", tz="UTC")
    # Of the target at hand: its first load and whether it is up, and whether this partition tells.
    first_target = target = first_load = None
    up_now = marked = moved_yet = started = False

    def rows(n: int, **cols) -> pa.RecordBatch:
        kinds = {"part": pa.int32(), "at": ts, "first_load": ts, "head": pa.bool_(), "same": pa.bool_(), "alive": pa.bool_()}
        names = [c.split()[0] for c in _OUT.split(", ")]
        return pa.RecordBatch.from_arrays([cols[c].cast(kinds.get(c, pa.string())) if c in cols else pa.nulls(n, kinds.get(c, pa.string())) for c in names], names=names)

    def last(flags: np.ndarray, begin: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.maximum.accumulate(np.where(flags, pos, -1))
        return at, (at >= begin) & (at >= 0)

    for b in batches:
        n = b.num_rows
        if not n:
            continue
        t = b.column("target_id")
        what = b.column("what").to_numpy(zero_copy_only=False)
        pos = np.arange(n)
        change = np.ones(n, bool)
        change[1:] = pc.not_equal(t[1:], t[:-1]).to_numpy(zero_copy_only=False)
        change[0] = not started or t[0].as_py() != target
        if not started:
            first_target, started = t[0].as_py(), True
        begin = np.maximum.accumulate(np.where(change, pos, -1))
        carried = begin < 0  # the target goes on from the batch before
        mark, has_mark = last(what == _FIRST, begin, pos)
        move, has_move = last((what == _LOADED) | (what == _WITHDRAWN), begin, pos)
        tells_first = has_mark | (carried & marked)
        tells_up = has_move | (carried & moved_yet)
        up = np.where(has_move, what[np.maximum(move, 0)] == _LOADED, carried & up_now)
        load_at = b.column("first_load").cast(ts).take(pa.array(np.where(has_mark, mark, 0)))
        load_at = pc.if_else(pa.array(has_mark), load_at, pc.if_else(pa.array(carried), pa.scalar(first_load, ts), pa.scalar(None, ts)))
        head = pc.equal(t, pa.scalar(first_target, pa.string())).to_numpy(zero_copy_only=False) & ~tells_first
        keep = pa.array(np.flatnonzero((what == _REFERENCE) & ~up))
        if len(keep):
            k, at = len(keep), b.column("at").cast(ts).take(keep)
            after = pc.fill_null(pc.or_(pc.is_null(at), pc.greater(load_at.take(keep), at)), True)
            status = pc.if_else(pc.is_null(load_at.take(keep)), "missing", pc.if_else(after, "late", "deleted"))
            yield rows(
                k,
                part=pa.array(np.full(k, part, np.int32)),
                row_kind=pa.array(["ref"] * k),
                target_id=t.take(keep),
                ref_table=b.column("ref_table").take(keep),
                ref_id=b.column("ref_id").take(keep),
                at=at,
                status=status,
                head=pa.array(head).take(keep),
                alive=pc.if_else(pa.array(tells_up).take(keep), pa.scalar(False), pa.scalar(None, pa.bool_())),
            )
        target, first_load, up_now = t[n - 1].as_py(), load_at[n - 1].as_py(), bool(up[n - 1])
        marked, moved_yet = bool(tells_first[n - 1]), bool(tells_up[n - 1])
    if started:
        one = lambda x, kind: pa.array([x], kind)
        yield rows(
            1,
            part=one(part, pa.int32()),
            row_kind=one("end", pa.string()),
            target_id=one(target, pa.string()),
            ref_id=one(first_target, pa.string()),
            first_load=one(first_load, ts),
            head=one(not marked, pa.bool_()),
            same=one(first_target == target, pa.bool_()),
            alive=one(up_now if moved_yet else None, pa.bool_()),
        )


def orphans(references: DataFrame, loads: DataFrame, withdrawals: DataFrame) -> DataFrame:
    """(ref_table, ref_id, target_id, at, status) of the references that hang.

    ``references``: ref_table, ref_id, target_id, at.  ``loads``, ``withdrawals``:
    target_id, at.
    """
    spark = references.sparkSession
    none = F.lit(None).cast("string")

    def events(df: DataFrame, what: int) -> DataFrame:
        return df.filter("target_id is not null and at is not null").select("target_id", "at", F.lit(what).alias("what"), none.alias("ref_table"), none.alias("ref_id"), F.lit(None).cast("timestamp").alias("first_load"))

    marks = (
        loads.filter("target_id is not null and at is not null")
        .groupBy("target_id")
        .agg(F.min("at").alias("first_load"))
        .select("target_id", F.lit(None).cast("timestamp").alias("at"), F.lit(_FIRST).alias("what"), none.alias("ref_table"), none.alias("ref_id"), "first_load")
    )
    refs = (
        references.select(F.trim("target_id").alias("target_id"), "at", F.lit(_REFERENCE).alias("what"), "ref_table", "ref_id")
        .filter("target_id <> ''")
        .withColumn("first_load", F.lit(None).cast("timestamp"))
    )
    # Written once: the range partitioning reads it twice, to sample the keys and to place the rows.
    stream = marks.unionByName(events(withdrawals, _WITHDRAWN)).unionByName(events(loads, _LOADED)).unionByName(refs)
    stream = durable(stream)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A reference without a time sorts with the marks, which come first.
    placed = stream.repartitionByRange(parts, *_KEYS).sortWithinPartitions(*_KEYS)
    merged = durable(placed.mapInArrow(_merged, _OUT), by="row_kind")
    settled = merged.filter("row_kind = 'ref' and not head").select("ref_table", "ref_id", "target_id", "at", "status")
    # One row a partition: what its first target's state was when the partition began.
    ends = sorted(merged.filter("row_kind = 'end'").collect(), key=lambda r: r.part)
    carry, state = [], (None, None, False)
    for r in ends:
        began = state if state[0] == r.ref_id else (r.ref_id, None, False)
        carry.append((r.part, began[1], began[2]))
        goes_on = began if r.same else (None, None, False)
        state = (r.target_id, goes_on[1] if r.head else r.first_load, goes_on[2] if r.alive is None else r.alive)
    if not carry:
        return settled.distinct()
    known = spark.createDataFrame(carry, "part int, first_load timestamp, alive boolean")
    heads = (
        merged.filter("row_kind = 'ref' and head")
        .select("part", "ref_table", "ref_id", "target_id", "at", F.col("alive").alias("told"))
        .join(F.broadcast(known), "part")  # a row a partition
        .filter("not coalesce(told, alive)")
        .select(
            "ref_table",
            "ref_id",
            "target_id",
            "at",
            F.expr("case when first_load is null then 'missing' when at is null or first_load > at then 'late' else 'deleted' end").alias("status"),
        )
    )
    return settled.unionByName(heads).distinct()


def element_references(elements: DataFrame, decisions: DataFrame) -> DataFrame:
    """The references of the current elements and of the decisions."""
    now = current_rows(elements, ["cross_references", F.col("loaded_at").alias("at")])
    targets = F.array_distinct(F.transform("cross_references", lambda x: F.trim(x)))
    crossed = now.select(F.lit("elements").alias("ref_table"), F.col("id").alias("ref_id"), F.explode(targets).alias("target_id"), "at")
    decided = decisions.select(F.lit("decisions").alias("ref_table"), F.col("decision_id").cast("string").alias("ref_id"), F.col("element_id").alias("target_id"), F.col("decided_at").alias("at"))
    return crossed.unionByName(decided)


def element_orphans(elements: DataFrame, decisions: DataFrame, withdrawals: DataFrame) -> DataFrame:
    loads = elements.select(F.col("id").alias("target_id"), F.col("loaded_at").alias("at"))
    gone = withdrawals.select(F.col("element_id").alias("target_id"), F.col("withdrawn_at").alias("at"))
    found = orphans(element_references(elements, decisions), loads, gone)
    return found.withColumn("period", F.date_format("at", "yyyy-MM"))


def orphan_report(found: DataFrame) -> DataFrame:
    """Orphans per referring table, period and status."""
    return found.groupBy("ref_table", "period", "status").agg(F.count(F.lit(1)).alias("n_refs"), F.count_distinct("target_id").alias("n_targets"))
