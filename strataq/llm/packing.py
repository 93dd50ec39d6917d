"""Filling fixed-capacity containers with items.

Items are texts, sized in tokens.  A text longer than the capacity is cut into full
containers and a rest; no other is cut.  How sizes are combined is decided on the
histogram of sizes alone, which has at most ``capacity`` entries however many texts
there are: the Martello-Toth reduction fixes small sets of sizes that dominate every
other set with the same largest size, then best fit puts the rest, largest sizes
first, each into the fullest container that still holds it; containers with equal
room are handled together.  The texts of one size are numbered
with salted partial counts, so a size that a third of all texts have is numbered by
many tasks, and find their container by binary search.

Defined results
---------------
* texts without a token (null, blank) take no space: piece 0 of size 0 in
  container 0 of each kind;
* kinds without a capacity, or with one below 1, hold nothing and give no rows; a
  kind given twice counts once, with its smallest capacity;
* texts of equal size are interchangeable: they go in the order of their salt and id;
* an empty table of texts or kinds gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataq.session import durable

#: A maximal run of letters, digits and underscores, or of other characters that are not white space.
#: The separators U+001C to U+001F are white space to the pattern of TESTDATA.md, but not to Java's ``\s``.
TOKEN = r"(?U)[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\x1C-\x1F]+"
#: Texts of one size that one task numbers.
PER_SALT = 500_000


def n_tokens(text: Column) -> Column:
    """Counted by deletion: each run becomes one mark, everything else nothing."""
    marked = F.regexp_replace(text, TOKEN, "\u0001")
    return F.coalesce(F.length(F.regexp_replace(marked, r"(?U)[\s\x1C-\x1F]+", "")), F.lit(0))


class Histogram:
    """Counts by size, with the largest size up to a bound."""

    def __init__(self, counts: dict[int, int]):
        self.count = {s: n for s, n in counts.items() if n > 0}
        self.sizes = sorted(self.count)

    def fit(self, room: int, used: dict[int, int] | None = None) -> int:
        """The largest size up to ``room`` of which one is left beside ``used``; 0: none."""
        i = bisect_right(self.sizes, room) - 1
        while i >= 0 and used and self.count[self.sizes[i]] <= used.get(self.sizes[i], 0):
            i -= 1
        return self.sizes[i] if i >= 0 else 0

    def smallest(self, k: int, used: dict[int, int]) -> int:
        """The sum of the k smallest left beside ``used``; more than any room if there are fewer."""
        total = 0
        for s in self.sizes:
            take = min(k, self.count[s] - used.get(s, 0))
            total += max(0, take) * s
            k -= max(0, take)
            if k <= 0:
                return total
        return 1 << 60

    def take(self, pattern: dict[int, int], times: int) -> None:
        for s, m in pattern.items():
            self.count[s] -= m * times
            if not self.count[s]:
                del self.count[s]
                self.sizes.pop(bisect_right(self.sizes, s) - 1)


def _times(h: Histogram, pattern: dict[int, int]) -> int:
    return min(h.count[s] // m for s, m in pattern.items())


def _add(pattern: dict[int, int], s: int) -> dict[int, int]:
    return pattern | {s: pattern.get(s, 0) + 1}


def dominant(h: Histogram, s: int, capacity: int) -> dict[int, int] | None:
    """The set with ``s`` that dominates every other feasible set with ``s``, if that is plain to see.

    Sets of up to three items: alone if nothing fits beside it; with the largest
    that fits if that fills the container, if no two more fit, or if it is at least
    as large as any two that fit, as long as no three more fit; with the best two if
    the larger of them is also the largest single and the pair fills the container.
    """
    room = capacity - s
    one = {s: 1}
    a = h.fit(room, one)
    if not a:
        return one
    if a == room or h.smallest(2, one) > room:
        return _add(one, a)
    if h.smallest(3, one) > room:
        best, i = (0, 0, 0), bisect_right(h.sizes, room)
        for x in reversed(h.sizes[:i]):
            if 2 * x < best[0]:
                break
            if h.count[x] <= one.get(x, 0):
                continue
            y = h.fit(min(x, room - x), _add(one, x))
            if y and x + y > best[0]:
                best = (x + y, x, y)
        if a >= best[0]:
            return _add(one, a)
        if best[0] == room and best[1] == a:
            return _add(_add(one, a), best[2])
    return None


class Rooms:
    """Open containers by the room they have left, as ranges of container numbers."""

    def __init__(self, least: int):
        self.least, self.ranges, self.rooms = least, {}, []

    def add(self, room: int, base: int, n: int) -> None:
        if n and room >= self.least:  # else nothing that is left fits in
            if room not in self.ranges:
                self.ranges[room] = []
                self.rooms.insert(bisect_left(self.rooms, room), room)
            self.ranges[room].append((base, n))

    def tightest(self, size: int) -> tuple[int, int, int] | None:
        """(room, first container, how many) of a range with the least room that holds ``size``; taken out."""
        i = bisect_left(self.rooms, size)
        if i == len(self.rooms):
            return None
        room = self.rooms[i]
        base, n = self.ranges[room].pop()
        if not self.ranges[room]:
            del self.ranges[room], self.rooms[i]
        return room, base, n


def fill_plan(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int]], int]:
    """Segments (size, first container, items of it in a container, items in all), and the number of containers.

    The items of a size take its segments one after the other.  Each segment uses up
    a size or a range of containers with equal room.
    """
    h, out, base = Histogram(counts), [], 0
    for s in sorted(h.sizes, reverse=True):  # the reduction, largest first
        while h.count.get(s, 0):
            p = dominant(h, s, capacity)
            if p is None:
                break
            # What is taken only shrinks the alternatives: the set dominates as often as its sizes last.
            n = max(1, _times(h, p))
            out += [(x, base, m, m * n) for x, m in p.items()]
            base += n
            h.take(p, n)
    rooms = Rooms(min(h.sizes, default=1))
    for s in sorted(h.sizes, reverse=True):  # best fit
        left = h.count[s]
        while left:
            room, first, n = rooms.tightest(s) or (capacity, base, left)
            # The fullest container that holds one more is the one just filled, as long as it holds one.
            m = min(room // s, left)
            k = min(n, left // m)
            if first == base:  # none holds it: new containers
                base, n = base + k, k
            out.append((s, first, m, m * k))
            rooms.add(room - m * s, first, k)
            rooms.add(room, first + k, n - k)
            left -= m * k
    return out, base


def pieces(documents: DataFrame, kinds: list[tuple[str, int]], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(container_kind, capacity, doc, piece, size): each text, cut where it must be."""
    sized = documents.select(F.col(key).alias("doc"), n_tokens(F.col(text)).alias("n"))
    kind = F.array(*(F.struct(F.lit(k).alias("container_kind"), F.lit(c).cast("int").alias("capacity")) for k, c in kinds))
    each = sized.select("doc", "n", F.inline(kind))
    last = F.greatest(F.ceil(F.col("n") / F.col("capacity")).cast("int") - 1, F.lit(0))
    cut = each.select("container_kind", "capacity", "doc", "n", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    size = F.least(F.col("capacity"), F.col("n") - F.col("piece") * F.col("capacity")).cast("int")
    return cut.select("container_kind", "capacity", "doc", "piece", size.alias("size"))


def pack(documents: DataFrame, containers: DataFrame, key: str = "doc_id", text: str = "text", per_salt: int = PER_SALT) -> DataFrame:
    """(container_kind, container_id, doc_id, piece, size)."""
    spark = documents.sparkSession
    usable = containers.filter("container_kind is not null and capacity >= 1").groupBy("container_kind").agg(F.min("capacity").alias("c"))
    kinds = [(r.container_kind, r.c) for r in usable.orderBy("container_kind").collect()]
    doc_type = documents.schema[key].dataType.simpleString()
    shape = f"container_kind string, container_id bigint, doc_id {doc_type}, piece int, size int"
    if not kinds:
        return spark.createDataFrame([], shape)
    # Sizes only: texts are read once and go no further.
    held = durable(pieces(documents, kinds, key, text))
    some = held.filter("size > 0")
    # At most one row a size up to each capacity: bounded by the kinds, not by the texts.
    counts: dict[str, dict[int, int]] = {k: {} for k, _ in kinds}
    for r in some.groupBy("container_kind", "size").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[r.container_kind][r.size] = r.n
    # Sizes that many texts have are numbered in parts: at most one row for each ``per_salt`` texts, so they go to all tasks.
    many = [(k, s, -(-n // per_salt)) for k, by in counts.items() for s, n in by.items() if n > per_salt]
    known = F.broadcast(spark.createDataFrame(many, "container_kind string, size int, salts int"))
    salt = F.pmod(F.xxhash64("doc", "piece"), F.coalesce("salts", F.lit(1))).cast("int")
    some = some.join(known, ["container_kind", "size"], "left").withColumn("salt", salt).drop("salts")
    # One row a size and salt: as many as sizes, and one more for each ``per_salt`` texts.
    salted = some.groupBy("container_kind", "size", "salt").agg(F.count(F.lit(1)).alias("n")).collect()
    names = pa.array([k for k, _ in kinds])
    number = {k: i for i, (k, _) in enumerate(kinds)}
    plan = [(number[k] << 32 | s, i, base, per, n) for k, c in kinds for i, (s, base, per, n) in enumerate(fill_plan(counts[k], c)[0])]
    code, _, base, per, taken = (np.array(x, np.int64) for x in zip(*sorted(plan), strict=True)) if plan else (np.zeros(0, np.int64),) * 5
    # One increasing sequence of items: the segments of all sizes, one after the other.
    begin = np.cumsum(taken) - taken
    parts = sorted((number[r.container_kind] << 32 | r.size, r.salt, r.n) for r in salted)
    code_of, salt_of, n_of = (np.array(x, np.int64) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 3
    start_of = np.cumsum(n_of) - n_of

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = int(salt_of.max(initial=0)) + 1
        keys = np.searchsorted(code, code_of) * width + salt_of
        for b in batches:
            kind = pc.index_in(b.column("container_kind"), value_set=names).to_numpy(zero_copy_only=False).astype(np.int64)
            own = np.searchsorted(code, kind << 32 | b.column("size").to_numpy()) * width + b.column("salt").to_numpy()
            at = start_of[np.searchsorted(keys, own)] + b.column("rank").to_numpy(zero_copy_only=False) - 1
            j = np.searchsorted(begin, at, "right") - 1
            out = base[j] + (at - begin[j]) // per[j]
            yield pa.RecordBatch.from_arrays(
                [b.column("container_kind"), pa.array(out), b.column("doc"), b.column("piece"), b.column("size")],
                names=["container_kind", "container_id", "doc_id", "piece", "size"],
            )

    order = Window.partitionBy("container_kind", "size", "salt").orderBy("doc", "piece")
    ranked = some.withColumn("rank", F.row_number().over(order).cast("bigint"))
    placed = ranked.select("container_kind", "size", "salt", "doc", "piece", "rank").mapInArrow(place, shape)
    empty = held.filter("size = 0").select("container_kind", F.lit(0).cast("bigint").alias("container_id"), F.col("doc").alias("doc_id"), "piece", "size")
    return placed.unionByName(empty)


def fill_report(packed: DataFrame, containers: DataFrame) -> DataFrame:
    """Per kind: containers, tokens, and the unused part of the capacity."""
    filled = packed.groupBy("container_kind").agg((F.max("container_id") + 1).alias("n_containers"), F.sum("size").alias("n_tokens"), F.count(F.lit(1)).alias("n_pieces"))
    kinds = containers.groupBy("container_kind").agg(F.min("capacity").alias("capacity"))
    unused = 1 - F.col("n_tokens") / (F.col("n_containers") * F.col("capacity"))
    return filled.join(kinds, "container_kind").withColumn("unused", unused)
