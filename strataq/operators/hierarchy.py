"""Parent-child links to full hierarchies.

Weighted disjoint-set forests: each partition of a range-partitioned link table
holds a forest whose nodes carry their offset to the local root.  Local roots that
point outside the partition are contracted to links between such roots, with the
offset as weight, and the contracted links go through the same step, until one
task can hold them all.  The number of partitions always follows the number of
links, so no task's forest grows with the table.

Ids that lie near their parents' contract within their range.  So that ids in any
order contract as well, two things happen from the second level on: links that no
link points at wait outside (they end where their parent ends), and a coin tells
for each id and level whether its link moves to its parent's place, where the two
are one tree.  Each level so takes at least about a quarter of the links away, in a
cycle or a chain of scattered ids too.  Links to a parent with very many stay where
they are, so no place holds more than a share of a task.  Links never reach the
driver; only counts do.

Paths are written while a task's forest is traversed from its roots downwards, so a
task holds one path at a time.

Defined results
---------------
* a chain ends at an element whose parent is null or has no row; that element is
  the root, at depth 0;
* a chain that never ends has depth -1, and its top is the smallest id on the
  cycle; an element that is its own parent is such a cycle;
* null ids are dropped; several rows of an id: the last loaded counts;
* an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataq.operators.current import current_rows
from strataq.session import durable

#: Links that one task's forest holds.
LINKS_PER_TASK = 100_000
#: A parent with more links than this part of a task's keeps them in their own places.
HUB_SHARE = 8
#: Up to so many such parents (there are at most ``HUB_SHARE`` a task) go to all tasks.
BROADCAST_HUBS = 1_000_000
#: Rows, and entries of paths, written at once.
ROWS, ENTRIES = 20_000, 500_000

_STATE = "id string, root string, off bigint, low string, ext string, w bigint, own array<string>, cyclic boolean, seg array<string>"


class Forest:
    """A disjoint-set forest over dense ints with the offset to each root.

    ``parent[i]`` is ``i`` itself at a root.  ``weight`` is the length of the link
    to the parent, ``low`` the smallest rank met on it (the start excluded).
    """

    def __init__(self, parent: np.ndarray, weight: np.ndarray, low: np.ndarray):
        self.parent, self.weight, self.low = parent.copy(), weight.copy(), low.copy()
        self.is_root = parent == np.arange(len(parent))
        self.weight[self.is_root] = 0

    def compress(self) -> np.ndarray:
        """Point every node at its root; True where the chain runs into a cycle.

        After the last round a node on such a chain points at a node of the cycle
        whose ``low`` covers the whole cycle.
        """
        n = len(self.parent)
        for _ in range(max(1, math.ceil(math.log2(n + 1)) + 1)):
            at = self.parent
            if self.is_root[at].all():
                break
            self.weight = self.weight + self.weight[at]
            self.low = np.minimum(self.low, self.low[at])
            self.parent = at[at]
        return ~self.is_root[self.parent]


def _numbers(names: pa.Array, of: pa.Array) -> np.ndarray:
    """The place of each of ``of`` in ``names``; -1: none."""
    return pc.fill_null(pc.index_in(of, value_set=names), -1).to_numpy(zero_copy_only=False).astype(np.int64)


def _forest(batches: list[pa.RecordBatch], paths: bool, last: bool) -> Iterator[pa.RecordBatch]:
    """The forest of a partition's links, as ``_STATE``.

    ``last``: no other partition is left, so the roots' own links are followed too
    and ``root`` is where they lead.
    """
    t = pa.Table.from_batches(batches).combine_chunks()
    if not t.num_rows:
        return
    ids, ptr, low_in = (t[c].combine_chunks() for c in ("id", "ptr", "low"))
    n = len(ids)
    here = _numbers(ids, ptr)
    inside = here >= 0
    parent = np.where(inside, here, np.arange(n))
    loop = inside & (parent == np.arange(n))
    names = pc.unique(pa.concat_arrays([ids, low_in.drop_null()]))
    order = pc.sort_indices(names).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    none = len(order)
    at = _numbers(names, low_in)
    given = np.where(at >= 0, rank[at], none)
    low = np.where(inside, given, none)
    w = t["w"].to_numpy().astype(np.int64)
    f = Forest(parent, w, low)
    f.is_root &= ~loop
    f.weight[loop] = 1
    f.low[loop] = np.minimum(low, rank[_numbers(names, ids)])[loop]
    cyclic = f.compress()
    root = np.where(cyclic, 0, f.parent)
    lows = np.where(cyclic, np.where(f.low[f.parent] < none, f.low[f.parent], f.low), np.where(f.is_root, given, f.low))
    low_names = names.take(pa.array(order[np.minimum(lows, none - 1)]))
    low_names = pc.if_else(pa.array(lows < none), low_names, pa.scalar(None, pa.string()))
    off = f.weight + np.where(last, w[root], 0)
    ends = ptr if last else ids
    out = {
        "id": ids,
        "root": pc.if_else(pa.array(cyclic), low_names, ends.take(pa.array(root))),
        "off": pa.array(np.where(cyclic, -1, off)),
        "low": low_names,
        "ext": pc.if_else(pa.array(f.is_root & ~cyclic), ptr, pa.scalar(None, pa.string())),
        "w": t["w"],
        "own": t["seg"],
        "cyclic": pa.array(cyclic),
    }
    if paths:  # only roots' own links are followed later
        out["own"] = t["seg"].take(pa.array(np.arange(n), mask=~(f.is_root & ~cyclic)))
    table = pa.table(out)
    if not paths:
        yield from table.append_column("seg", pa.nulls(n, pa.list_(pa.string()))).to_batches(ROWS)
        return
    own = t["seg"].to_pylist()
    written = np.zeros(n, bool)
    for rows, flat, offsets in _traversed(parent, f.is_root & ~cyclic, ~cyclic & ~f.is_root, own, last):
        written[rows] = True
        seg = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.string()))
        yield from table.take(pa.array(rows)).append_column("seg", seg).combine_chunks().to_batches()
    rest = table.filter(pa.array(~written))
    yield from rest.append_column("seg", pa.nulls(rest.num_rows, pa.list_(pa.string()))).to_batches(ROWS)


def _traversed(parent: np.ndarray, is_root: np.ndarray, below: np.ndarray, own: list, last: bool) -> Iterator[tuple[list, list, list]]:
    """(rows, entries, offsets): the paths from the roots, by indexed parent traversal, depth first."""
    kids = np.flatnonzero(below)
    kids = kids[np.argsort(parent[kids], kind="stable")]
    first = np.searchsorted(parent[kids], np.arange(len(parent) + 1))
    kids, first = kids.tolist(), first.tolist()
    rows, flat, offsets, path = [], [], [0], []
    for r in np.flatnonzero(is_root).tolist():
        open_ = [(r, 0)]
        while open_:
            i, k = open_.pop()
            del path[k:]
            if i != r or last:
                path.extend(own[i])
            rows.append(i)
            flat.extend(path)
            offsets.append(len(flat))
            k = len(path)
            open_.extend((c, k) for c in kids[first[i] : first[i + 1]])
            if len(rows) >= ROWS or len(flat) >= ENTRIES:
                yield rows, flat, offsets
                rows, flat, offsets = [], [], [0]
    if rows:
        yield rows, flat, offsets


def _forests(placed: DataFrame, paths: bool, last: bool = False) -> DataFrame:
    """The forests of the partitions of (id, ptr, w, low, seg)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            yield from _forest(held, paths, last)

    return placed.mapInArrow(run, _STATE)


def _parts(n: int, per_task: int) -> int:
    """Ranges are sampled and places hold several links: half a task's links on average leave room for both."""
    return max(1, math.ceil(2 * n / per_task))


def _joined(seg: Column, more: Column) -> Column:
    """Paths one after the other, the one nearer to the root first."""
    return F.concat(F.coalesce(seg, F.array().cast("array<string>")), more)


def _ended(more: Column, rest: Column, off: Column, seg: Column, cyclic: Column) -> list[Column]:
    """Depth and path of what hangs on a link that ends so."""
    never = cyclic | F.coalesce(more < 0, F.lit(False))
    return [
        F.when(never, F.lit(-1)).otherwise(off + F.coalesce(more, F.lit(0))).cast("bigint").alias("more"),
        F.when(~never, _joined(rest, seg)).alias("rest"),
    ]


_LINK = ["id", "ptr", "w", "low", "seg"]


def _contracted(state: DataFrame, known_ends: bool) -> tuple[DataFrame, DataFrame]:
    """(id, top, more, rest) of the local roots that are settled, and the links between the others.

    ``known_ends``: a pointer at nothing in the table is an end; else its link counts for nothing.
    """
    ends = state.filter("ext is not null").select("id", "ext", "w", "own", F.col("low").alias("low1"))
    own = state.select(F.col("id").alias("ext"), "root", "off", "cyclic", "low", F.when(F.col("off") != 0, F.col("low")).alias("low2"), "seg", F.lit(True).alias("there"))
    met = durable(ends.join(own, "ext", "left" if known_ends else "inner"))
    lost = F.col("there").isNull()
    done = met.filter(lost | F.col("cyclic")).select(
        "id",
        F.when(lost, F.col("ext")).otherwise(F.col("root")).alias("top"),
        F.when(lost, F.col("w")).otherwise(F.lit(-1)).cast("bigint").alias("more"),
        F.when(lost, F.col("own")).alias("rest"),
    )
    links = met.filter("there and not cyclic").select(
        "id", F.col("root").alias("ptr"), (F.col("w") + F.col("off")).alias("w"), F.least("low1", "low2").alias("low"), F.concat("seg", "own").alias("seg")
    )
    return done, links


def _through(state: DataFrame, done: DataFrame, links: DataFrame, per_task: int, paths: bool, level: int) -> DataFrame:
    """(id, top, more, rest) of all nodes of the forests, by way of their local roots' links."""
    links = durable(links)
    tops = done
    if links.head(1):
        deep = _settle(links, per_task, paths, level)
        tail = done.select(F.col("id").alias("top"), F.col("top").alias("top2"), F.col("more").alias("more2"), F.col("rest").alias("rest2"))
        cyclic = F.col("more") < 0
        deep = deep.join(tail, "top", "left").select("id", F.coalesce("top2", "top").alias("top"), *_ended(F.col("more2"), F.col("rest2"), F.col("more"), F.col("rest"), cyclic))
        tops = durable(done.unionByName(deep))
    return state.alias("s").join(tops.alias("t"), F.col("s.root") == F.col("t.id"), "left").select(
        F.col("s.id").alias("id"),
        F.when(F.col("cyclic"), F.col("root")).otherwise(F.coalesce("top", "root")).alias("top"),
        *_ended(F.col("t.more"), F.col("t.rest"), F.col("off"), F.col("seg"), F.col("cyclic")),
    )


def _coin(c: str, level: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(level), F.col(c)), F.lit(2)) == 0


def _settle(links: DataFrame, per_task: int, paths: bool, level: int) -> DataFrame:
    """(id, top, more, rest): where the chain of each contracted link ends, how far that is, and the path.

    A pointer that is no ``id`` of the table is an end.  ``more`` -1: a cycle, whose
    smallest id is the top.
    """
    n = links.count()
    out = ["id", F.col("root").alias("top"), F.col("off").alias("more"), F.col("seg").alias("rest")]
    if n <= per_task:
        return _forests(links.select(_LINK).coalesce(1), paths, last=True).select(*out)
    # Links that none points at end where their parent ends.
    kids = durable(links.groupBy("ptr").agg(F.count(F.lit(1)).alias("kids")))
    marked = durable(links.join(kids.withColumnRenamed("ptr", "id"), "id", "left"))
    inner, leaves = marked.filter("kids is not null"), marked.filter("kids is null")
    m = inner.count()
    if m == 0:
        return leaves.select("id", F.col("ptr").alias("top"), F.col("w").alias("more"), F.col("seg").alias("rest"))
    if m <= per_task:
        settled = durable(_forests(inner.select(_LINK).coalesce(1), paths, last=True).select(*out))
    else:
        hubs = kids.filter(F.col("kids") > max(4, per_task // HUB_SHARE)).select("ptr", F.lit(True).alias("hub"))
        if HUB_SHARE * (n // per_task + 1) <= BROADCAST_HUBS:
            hubs = F.broadcast(hubs)
        moves = _coin("id", level) & ~_coin("ptr", level) & F.col("hub").isNull()
        placed = inner.join(hubs, "ptr", "left").withColumn("place", F.when(moves, F.col("ptr")).otherwise(F.col("id")))
        placed = placed.repartitionByRange(_parts(m, per_task), "place")
        state = durable(_forests(placed.select(_LINK), paths))
        done, again = _contracted(state, True)
        settled = durable(_through(state, done, again, per_task, paths, level + 1))
    on = settled.select(F.col("id").alias("ptr"), F.col("top"), F.col("more"), F.col("rest"))
    hung = leaves.join(on, "ptr", "left").select("id", F.coalesce("top", "ptr").alias("top"), *_ended(F.col("more"), F.col("rest"), F.col("w"), F.col("seg"), F.lit(False)))
    return settled.unionByName(hung)


def hierarchy(
    nodes: DataFrame,
    key: str = "id",
    parent: str = "parent_id",
    loaded: str | None = "loaded_at",
    paths: bool = False,
    links_per_task: int = LINKS_PER_TASK,
) -> DataFrame:
    """(element_id, top_id, depth[, path]): one row per key.

    ``path`` runs from the root down to the element itself and is null where the
    chain never ends.  ``loaded`` None: the keys are unique already.
    """
    raw = nodes.select(F.col(key).alias("id"), F.col(parent).alias("ptr"), *([F.col(loaded).alias("loaded_at")] if loaded else []))
    rows = durable(current_rows(raw, ["ptr"]) if loaded else raw.filter("id is not null"))
    n = rows.count()
    seg = F.array("ptr") if paths else F.lit(None).cast("array<string>")
    first = rows.select("id", "ptr", F.lit(1).cast("bigint").alias("w"), F.col("ptr").alias("low"), seg.alias("seg"))
    placed = first.coalesce(1) if n <= links_per_task else first.repartitionByRange(_parts(n, links_per_task), "id")
    state = durable(_forests(placed, paths))
    if n <= links_per_task:
        settled = state.select("id", F.col("root").alias("top"), F.col("off").alias("more"), F.col("seg").alias("rest"))
    else:  # a parent without a row drops out: the end is then the root
        done, links = _contracted(state, False)
        settled = _through(state, done, links, links_per_task, paths, 1)
    out = [F.col("id").alias("element_id"), F.col("top").alias("top_id"), F.col("more").cast("int").alias("depth")]
    if paths:
        out.append(F.when(F.col("more") >= 0, F.concat("rest", F.array("id"))).alias("path"))
    return settled.select(*out)


def deep_or_cyclic(nodes: DataFrame, least_depth: int = 6, **kw) -> DataFrame:
    """Elements at ``least_depth`` or more, and those whose chain never ends."""
    return hierarchy(nodes, **kw).filter((F.col("depth") >= least_depth) | (F.col("depth") < 0))


def descendants(paths: DataFrame) -> DataFrame:
    """(ancestor_id, descendant_id, distance) from ``hierarchy(paths=True)``.

    One row per node and proper ancestor: as many rows as the depths add up to,
    made where the path is, without a join.  Nodes in cycles have none.
    """
    each = paths.filter("depth > 0").select("element_id", "depth", F.posexplode(F.slice("path", F.lit(1), F.col("depth"))).alias("at", "ancestor_id"))
    return each.select("ancestor_id", F.col("element_id").alias("descendant_id"), (F.col("depth") - F.col("at")).alias("distance"))
