"""Long exact spans shared between records.

A character is shared if a window of ``span`` characters around it occurs verbatim
in another record.  Windows are counted by super-k-mers: consecutive windows with
the same minimiser (the smallest hash of the ``m``-character strings in a window)
travel as one packed string to the bucket of that minimiser.  Equal windows have
equal minimisers, so every repeat meets in one bucket, where the windows are sorted
and those of two or more records kept.

Two readings of the texts: the first counts records by minimiser (16 bytes a
super-k-mer travel), the second sends only super-k-mers whose minimiser two records
have, told by a bit map whose false positives cost time, not results.  Runs of equal
minimisers are cut at ``RUN`` windows, so a super-k-mer has a bounded length.  A
minimiser with more super-k-mers than a task should hold is split by record and
place; its sub-buckets settle what repeats within them.  All places of a window that
one record holds there, and a row for each of two records of a window of several, go
on to be compared between sub-buckets.

Windows are sorted by hash and those that meet are compared character by character
(``_agree``).  Between sub-buckets, where only hashes travel, two 64-bit hashes count.

Defined results
---------------
* offsets count code points from 0, the end is exclusive; nothing is normalised;
* null texts and texts shorter than ``span`` share nothing;
* a repeat within one record alone is not shared; rows with the same id are one
  record, rows with a null id are left out;
* adjoining shared stretches are one span; equal texts share all they have;
* texts of any length are read in blocks; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataq.session import durable

SPAN = 300
#: Length of the strings that minimisers are chosen from: a power of two below the span.
M = 64
#: Super-k-mers of one minimiser that a task takes at once.
PER_BUCKET = 8_000
#: Windows of a super-k-mer, at most.
RUN = 1024
#: Minimisers that are split by record and place, at most.
MAX_HOT = 1_000_000
#: Bits of the map for each shared minimiser, and the most bits it has: beyond, more text travels and the result stays the same.
BITS_EACH, MOST_BITS = 16, 1 << 30
#: Code points worked on at once.
BLOCK = 1 << 18
#: Places of windows written at once.
PLACES = 1 << 18

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xC2B2AE3D27D4EB4F)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def minimisers(codes: np.ndarray, span: int, m: int) -> np.ndarray:
    """The minimiser of each window of ``span`` code points, as a hash below 2^63."""
    h = (codes.astype(np.uint64) + np.uint64(1)) * _MIX
    size, power = 1, int(_ODD)
    while size < m:
        h = h[:-size] * np.uint64(power) + h[size:]
        size, power = 2 * size, power * power & 0xFFFFFFFFFFFFFFFF
    h = _scramble(h) >> np.uint64(1)
    width = span - m + 1
    size = 1
    low = h
    while 2 * size <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    return np.minimum(low[: len(h) - width + 1], low[width - size :])


def super_kmers(texts: list[str], span: int, m: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first text, base, text, start, windows, minimiser) arrays of the runs of equal minimisers.

    Texts are joined to blocks; a text longer than a block is cut into overlapping
    ones, so a run may be cut too, which changes no window's bucket.
    """
    held: list[tuple[int, int, np.ndarray]] = []
    size = 0
    for k, t in enumerate(texts):
        if t is None or len(t) < span:
            continue
        codes = code_points(t)
        for at in range(0, len(codes) - span + 1, BLOCK):
            held.append((k, at, codes[at : at + BLOCK + span - 1]))
            size += len(held[-1][2])
            if size >= BLOCK:
                yield _runs(held, span, m)
                held, size = [], 0
    if held:
        yield _runs(held, span, m)


def _runs(held: list[tuple[int, int, np.ndarray]], span: int, m: int) -> tuple[np.ndarray, ...]:
    lens = np.array([len(c) for _, _, c in held])
    begins = np.concatenate([[0], np.cumsum(lens)[:-1]])
    low = minimisers(np.concatenate([c for _, _, c in held]), span, m)
    fresh = np.ones(len(low), bool)
    fresh[1:] = low[1:] != low[:-1]
    valid = np.ones(len(low) + 1, bool)
    valid[-1] = False
    for b, n in zip(begins.tolist(), lens.tolist(), strict=True):
        fresh[b] = True
        valid[b + n - span + 1 : b + n] = False
    # A run starts at a fresh valid window and ends before the next fresh or invalid one.
    starts = np.flatnonzero(fresh & valid[:-1])
    stops = np.flatnonzero(np.concatenate([fresh | ~valid[:-1], [True]]))
    ends = stops[np.searchsorted(stops, starts, "right")]
    # Long runs are cut.
    pieces = -(-(ends - starts) // RUN)
    if (pieces > 1).any():
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts, ends = np.repeat(starts, pieces) + nth * RUN, np.repeat(ends, pieces)
        ends = np.minimum(starts + RUN, ends)
    part = np.searchsorted(begins, starts, "right") - 1
    text = np.array([k for k, _, _ in held])[part]
    offset = np.array([at for _, at, _ in held])[part]
    return text, starts - begins[part] + offset, ends - starts, low[starts].astype(np.int64)


def _counted(docs: DataFrame, span: int, m: int) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0)
            for text, _, _, low in super_kmers(b.column(1).to_pylist(), span, m):
                yield pa.RecordBatch.from_arrays([pa.array(low), ids.take(pa.array(text))], names=["low", "id"])

    kind = docs.schema["id"].dataType.simpleString()
    each = docs.mapInArrow(read, f"low bigint, id {kind}")
    seen = each.groupBy("low").agg(F.min("id").alias("a"), F.max("id").alias("b"), F.count(F.lit(1)).alias("n"))
    return seen.filter("a <> b").select("low", "n")


def _bit_map(shared: DataFrame, bits: int) -> np.ndarray:
    """A bit for each shared minimiser, in ``bits`` bits."""
    at = (F.col("low") % bits).cast("bigint")
    rows = (
        shared.select(at.alias("at"))
        .groupBy(F.expr("bitmap_bucket_number(at)").alias("k"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(at))").alias("bits"))
        .toLocalIterator()
    )
    # Bucket k covers 32,768 values from (k - 1) * 32,768 + 1; 0 lies in bucket 0 or 1 by its sign.
    out = np.zeros(bits // 8 + 2 * 4096, np.uint8)
    for r in rows:
        piece = np.frombuffer(bytes(r.bits), np.uint8)
        out[r.k * 4096 : r.k * 4096 + len(piece)] |= piece
    return out


def _position(low: np.ndarray, bits: int) -> np.ndarray:
    at = low % bits
    bucket = np.where(at > 0, 1 + (at - 1) // 32768, at // 32768)
    bit = np.where(at > 0, (at - 1) % 32768, -at % 32768)
    return bucket * 32768 + bit


def _packed(docs: DataFrame, marks: np.ndarray, bits: int, hot: dict[int, int], span: int, m: int) -> DataFrame:
    """(low, salt, id, at, text): the super-k-mers that may be shared."""
    held = docs.sparkSession.sparkContext.broadcast(marks)  # of bounded size
    hot_lows = np.array(sorted(hot), np.int64)
    hot_salts = np.array([hot[x] for x in sorted(hot)], np.int64)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = held.value
        for b in batches:
            ids, texts = b.column(0), b.column(1).to_pylist()
            code = b.column(2).to_numpy(zero_copy_only=False)
            for text, start, n, low in super_kmers(texts, span, m):
                p = _position(low, bits)
                keep = np.flatnonzero(seen[p >> 3] >> (p & 7).astype(np.uint8) & 1)
                if not len(keep):
                    continue
                text, start, n, low = text[keep], start[keep], n[keep], low[keep]
                salt = np.full(len(keep), -1, np.int64)
                if len(hot_lows):
                    i = np.minimum(np.searchsorted(hot_lows, low), len(hot_lows) - 1)
                    salt = np.where(hot_lows[i] == low, (code[text] + start // RUN * 7919) % hot_salts[i], -1)
                cut = [texts[k][s : s + w + span - 1] for k, s, w in zip(text.tolist(), start.tolist(), n.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(low), pa.array(salt, pa.int64()), ids.take(pa.array(text)), pa.array(start, pa.int64()), pa.array(cut, pa.string())],
                    names=["low", "salt", "id", "at", "text"],
                )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(read, f"low bigint, salt bigint, id {kind}, at bigint, text string")


class _Powers:
    def __init__(self) -> None:
        self.made: dict[tuple[int, int], np.ndarray] = {}

    def of(self, base: int, n: int) -> np.ndarray:
        size = 1 << max(16, (n - 1).bit_length())
        if (base, size) not in self.made:
            out = np.full(size, base, np.uint64)
            out[0] = 1
            self.made[base, size] = np.cumprod(out, dtype=np.uint64)
        return self.made[base, size][:n]


_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def window_hashes(codes: np.ndarray, span: int, powers: _Powers) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for i, base in enumerate(_BASES):
        c = _scramble((codes.astype(np.uint64) + np.uint64(2 * i + 1)) * np.uint64(base))
        total = np.zeros(len(c) + 1, np.uint64)
        np.cumsum(c * powers.of(base, len(c)), out=total[1:])
        inverse = pow(base, -1, 1 << 64)
        out.append(_scramble((total[span:] - total[:-span]) * powers.of(inverse, len(total) - span)))
    return out[0], out[1]


def _agree(codes: np.ndarray, at: np.ndarray, row: np.ndarray, first_of: np.ndarray, span: int) -> bool:
    """Whether every window has the characters of the first window with its hash.

    Where the window before it agrees with the window before that one, only the last
    character is left to compare.
    """
    w = np.flatnonzero(first_of != np.arange(len(at)))
    r = first_of[w]
    on = (w > 0) & (r > 0)
    on[on] = (row[w[on]] == row[w[on] - 1]) & (row[r[on]] == row[r[on] - 1]) & (first_of[w[on] - 1] == r[on] - 1)
    if (codes[at[w[on]] + span - 1] != codes[at[r[on]] + span - 1]).any():
        return False
    w, r = w[~on], r[~on]
    for i in range(0, len(w), 4096):
        a, b = (at[x[i : i + 4096], None] + np.arange(span) for x in (w, r))
        if (codes[a] != codes[b]).any():
            return False
    return True


def _sorted_windows(texts: list[str], owners: list[list[int]], span: int, powers: _Powers):
    """Hashes of all windows of distinct strings, whether two records hold each, and which of each window.

    ``owners``: the smallest and largest record number of each string.
    """
    codes = [code_points(t) for t in texts]
    n = np.array([len(c) - span + 1 for c in codes])
    joined = np.concatenate(codes)
    h1, h2 = window_hashes(joined, span, powers)
    ends = np.cumsum(n + span - 1)
    begins = ends - (n + span - 1)
    row = np.repeat(np.arange(len(n)), n)
    first = np.cumsum(n) - n
    at = begins[row] + (np.arange(len(row)) - first[row])
    h1, h2 = h1[at], h2[at]

    def grouped(k1: np.ndarray, k2: np.ndarray):
        order = np.argsort(k1)
        same = k1[order[1:]] == k1[order[:-1]]
        if (same & (k2[order[1:]] != k2[order[:-1]])).any():
            order = np.lexsort((k2, k1))
            same = (k1[order[1:]] == k1[order[:-1]]) & (k2[order[1:]] == k2[order[:-1]])
        group = np.concatenate([[0], np.flatnonzero(~same) + 1])
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(np.concatenate([[0], ~same]))
        return order, group, number

    order, group, number = grouped(h1, h2)
    if not _agree(joined, at, row, np.minimum.reduceat(order, group)[number], span):
        # Two windows with the same hashes: told apart by their characters.
        known: dict[bytes, int] = {}
        exact = np.fromiter((known.setdefault(joined[a : a + span].tobytes(), len(known)) for a in at.tolist()), np.int64, len(at))
        order, group, number = grouped(exact, exact)
    least, most = np.array([o[0] for o in owners])[row][order], np.array([o[1] for o in owners])[row][order]
    low, high = np.minimum.reduceat(least, group), np.maximum.reduceat(most, group)
    return h1, h2, row, first, n, (low != high)[number], order[group], low, high


def _stretches(flags: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last window of each run of flagged windows within a row."""
    edge = np.concatenate([[True], row[1:] != row[:-1]])
    before = np.concatenate([[False], flags[:-1]]) & ~edge
    after = np.concatenate([flags[1:], [False]]) & ~np.concatenate([edge[1:], [True]])
    return np.flatnonzero(flags & ~before), np.flatnonzero(flags & ~after)


def _settled(packed: DataFrame, span: int, hot: bool) -> DataFrame:
    """Shared stretches by bucket; of hot buckets also rows of the windows, to compare between sub-buckets."""
    kind = packed.schema["id"].dataType.simpleString()

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held: list[pa.RecordBatch] = []
        size = 0
        for b in batches:
            if not b.num_rows:
                continue
            low, salt = b.column("low").to_numpy(), b.column("salt").to_numpy()
            held.append(b)
            size += b.column("text").nbytes
            cut = np.flatnonzero((low[1:] != low[:-1]) | (salt[1:] != salt[:-1]))
            if size > 2_000_000 and len(cut):
                end = int(cut[-1]) + 1
                held[-1] = b.slice(0, end)
                yield pa.Table.from_batches(held)
                held, size = [b.slice(end)], 0
        if held:
            yield pa.Table.from_batches(held)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _Powers()
        for t in groups(batches):
            ids = t["id"].combine_chunks()
            coded = ids.dictionary_encode()
            record = coded.indices.to_numpy()
            texts, at = t["text"].to_pylist(), t["at"].to_numpy()
            # Equal strings are worked on once.
            rows_of: dict[str, list[int]] = {}
            for i, x in enumerate(texts):
                rows_of.setdefault(x, []).append(i)
            whole = list(rows_of)
            owners = []
            for x in whole:
                r = record[rows_of[x]]
                owners.append([int(r.min()), int(r.max())])
            yield from found(rows_of, owners, whole, at, ids, coded.dictionary, powers)

    def found(rows_of, owners, whole, at, ids, held, powers) -> Iterator[pa.RecordBatch]:
        h1, h2, row, first, n, shared, one_each, low, high = _sorted_windows(whole, owners, span, powers)
        begin, last = _stretches(shared, row)
        out_i, out_a, out_b = [], [], []
        for a, z, r in zip((begin - first[row[begin]]).tolist(), (last - first[row[begin]]).tolist(), row[begin].tolist(), strict=True):
            for i in rows_of[whole[r]]:
                out_i.append(i)
                out_a.append(at[i] + a)
                out_b.append(at[i] + z + span)
        yield pa.RecordBatch.from_arrays(
            [ids.take(pa.array(out_i, pa.int64())), pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64()), pa.nulls(len(out_i), pa.int64()), pa.nulls(len(out_i), pa.int64())],
            names=["id", "a", "b", "h1", "h2"],
        )
        if hot:
            # A shared window: only that two records hold it.
            both = np.flatnonzero(low != high)
            there = np.repeat(one_each[both], 2)
            yield windows(held, np.stack([low[both], high[both]], 1).ravel(), np.zeros(len(there), np.int64), None, h1[there], h2[there])
            # A window of one record so far: all its places, in all equal strings.
            alone = np.flatnonzero(~shared)
            copies = np.array([len(rows_of[x]) for x in whole])
            members, begins = np.concatenate([rows_of[x] for x in whole]), np.cumsum(copies) - copies
            for c in np.split(alone, np.flatnonzero(np.diff(np.cumsum(copies[row[alone]]) // PLACES)) + 1):
                n_c = copies[row[c]]
                w = np.repeat(c, n_c)
                i = members[np.repeat(begins[row[c]] - (np.cumsum(n_c) - n_c), n_c) + np.arange(len(w))]
                yield windows(ids, i, at[i] + w - first[row[w]], 0, h1[w], h2[w])

    def windows(ids, i, a, b, h1, h2) -> pa.RecordBatch:
        b = pa.nulls(len(i), pa.int64()) if b is None else pa.array(np.full(len(i), b, np.int64))
        return pa.RecordBatch.from_arrays(
            [ids.take(pa.array(i)), pa.array(a, pa.int64()), b, pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64))],
            names=["id", "a", "b", "h1", "h2"],
        )

    keyed = packed.repartition("low", "salt").sortWithinPartitions("low", "salt")
    return keyed.mapInArrow(read, f"id {kind}, a bigint, b bigint, h1 bigint, h2 bigint")


def _between(windows: DataFrame, span: int) -> DataFrame:
    """Places of windows that one record holds in its sub-bucket, and another holds elsewhere.

    A window's rows have two records if one sub-bucket or two tell of them.
    """
    many = windows.groupBy("h1", "h2").agg(F.min("id").alias("p"), F.max("id").alias("q")).filter("p <> q").select("h1", "h2")
    return windows.filter("b = 0").join(many, ["h1", "h2"], "left_semi").select("id", "a", (F.col("a") + span).alias("b"))


def stretches(
    documents: DataFrame, key: str, text: str, span: int = SPAN, m: int = M, per_bucket: int = PER_BUCKET, bits: int | None = None
) -> DataFrame:
    """(id, a, b): shared stretches, overlapping where windows do."""
    docs = documents.select(F.col(key).alias("id"), F.col(text).alias("text"), F.pmod(F.xxhash64(key), F.lit(1 << 30)).alias("code"))
    docs = docs.filter(F.col("id").isNotNull() & (F.length("text") >= span))
    shared = durable(_counted(docs, span, m))
    n, total = shared.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    bits = bits or min(MOST_BITS, 1 << max(20, (n * BITS_EACH - 1).bit_length()))
    marks = _bit_map(shared, bits)
    # Minimisers with many super-k-mers; the bound keeps them below ``MAX_HOT`` whatever the input.
    per_bucket = max(per_bucket, math.ceil(total / MAX_HOT))
    hot = {r.low: math.ceil(r.n / per_bucket) for r in shared.filter(F.col("n") > per_bucket).toLocalIterator()}
    packed = _packed(docs, marks, bits, hot, span, m)
    if not hot:
        return _settled(packed, span, False).select("id", "a", "b")
    packed = durable(packed)
    usual = _settled(packed.filter("salt < 0"), span, False).select("id", "a", "b")
    split = durable(_settled(packed.filter("salt >= 0"), span, True))
    return usual.unionByName(split.filter("h1 is null").select("id", "a", "b")).unionByName(_between(split.filter("h1 is not null"), span))


def shared_spans(documents: DataFrame, key: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """(doc_id, span_start, span_end): maximal runs of shared characters."""
    found = stretches(documents, key, text, **kw)
    w = Window.partitionBy("id").orderBy("a", "b")
    reach = F.max("b").over(w.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce((F.col("a") > reach).cast("int"), F.lit(1))
    runs = found.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    merged = runs.groupBy("id", "run").agg(F.min("a").alias("span_start"), F.max("b").alias("span_end"))
    return merged.select(F.col("id").alias(key), "span_start", "span_end")


def shared_chars(documents: DataFrame, key: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """(doc_id, n_spans, shared_chars, n_chars): every record, shared or not."""
    spans = shared_spans(documents, key, text, **kw)
    per = spans.groupBy(key).agg(F.count(F.lit(1)).alias("n_spans"), F.sum(F.col("span_end") - F.col("span_start")).alias("shared_chars"))
    every = documents.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.coalesce(F.length(text), F.lit(0))).cast("bigint").alias("n_chars"))
    zero = F.lit(0).cast("bigint")
    return every.join(per, key, "left").select(key, F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("shared_chars", zero).alias("shared_chars"), "n_chars")
