"""Evaluation texts leaking into training text.

A prefix-filtered set join.  An item is a set of windows of ``words`` words, a
window a set of word shingles; a text holds a window only if it holds all its
shingles, so one of them, the rarest over all texts, is the necessary prefix.

1. Items become a table of windows with their shingles.
2. A reading of all texts counts in how many texts each item shingle stands; this
   orders the shingles.  A window with a shingle in no text is ruled out.
3. A second reading looks for the prefix shingles only.  Each place found takes
   along the words around it, as far as a window can reach.
4. These are joined to the windows by prefix; the shingle's place in the window and
   in the text bounds where the window lies (length and position), and its words are
   compared there.

Shingles travel as 63-bit hashes; which texts send them is told by a bit map with
some bits a shingle.  Neither can lose or add a pair, as words are compared at the
end.  Items and texts never reach the driver.

Words are maximal runs of letters and digits; case and characters that only look
different don't matter (``lookalike.fold``).

Defined results
---------------
* items and texts with fewer than ``words`` words, null or blank, are never found;
* a pair comes out once, however often the window occurs; equal items and equal
  texts each come out under their own id;
* a null id is an id like any other; empty tables give no rows;
* texts are read whole, long ones a stretch of words at a time; further columns are
  ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataq.llm.lookalike import fold
from strataq.llm.spans import _bit_map, _position, _Powers, _scramble, code_points
from strataq.session import durable

WORDS = 13
SHINGLE = 5
#: Up to so many windows (about 150 bytes each) the windows go to all tasks; beyond it they are joined by key.
BROADCAST_WINDOWS = 200_000
#: A shingle in more texts than this is met by ``SALTS`` tasks where windows are joined by key.
HOT = 1_000_000
SALTS = 64
#: Bits of the map for each shingle, and the most bits it has: beyond, more places travel and the result stays the same.
BITS_EACH, MOST_BITS = 32, 1 << 30
#: Code points worked on at once.
BLOCK = 1 << 20

_BASE, _ROLL = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)


@lru_cache(1)
def _letters() -> np.ndarray:
    """By code point: whether it is a letter or digit."""
    return np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)


def _places(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes) of the words of a text."""
    codes = code_points(text)
    word = np.zeros(len(codes) + 2, bool)
    word[1:-1] = _letters()[codes]
    starts = np.flatnonzero(word[1:] & ~word[:-1])
    ends = np.flatnonzero(word[:-1] & ~word[1:])
    hashes = np.empty(len(starts), np.uint64)
    powers = _powers()
    inverse = pow(_BASE, -1, 1 << 64)
    i = 0
    while i < len(starts):  # a stretch of whole words at a time
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK, "right")))
        a, z = int(starts[i]), int(ends[j - 1])
        c = _scramble((codes[a:z].astype(np.uint64) + np.uint64(1)) * np.uint64(_BASE)) * powers.of(_BASE, z - a)
        total = np.zeros(z - a + 1, np.uint64)
        np.cumsum(c, out=total[1:])
        hashes[i:j] = _scramble((total[ends[i:j] - a] - total[starts[i:j] - a]) * powers.of(inverse, z - a + 1)[starts[i:j] - a])
        i = j
    return starts, ends, hashes


@lru_cache(1)
def _powers() -> _Powers:
    return _Powers()


def _blocks(texts: list[str | None], least: int) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(joined texts, text of each word, starts, ends, hashes), blocks of texts at a time."""
    held: list[tuple[int, str]] = []
    size = 0
    for k, t in enumerate(texts):
        if t and len(t) >= 2 * least - 1:
            held.append((k, fold(t).lower()))
            size += len(held[-1][1])
        if held and (size >= BLOCK or k == len(texts) - 1):
            joined = " ".join(t for _, t in held)
            starts, ends, hashes = _places(joined)
            begins = np.cumsum([0, *(len(t) + 1 for _, t in held)])[:-1]
            of = np.searchsorted(begins, starts, "right") - 1
            yield joined, np.array([k for k, _ in held])[of], starts, ends, hashes
            held, size = [], 0


def _shingles(of: np.ndarray, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of each shingle within one text."""
    n = len(of) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = hashes[:n]
    for j in range(1, size):
        h = h * _ROLL + hashes[j : n + j]
    at = np.flatnonzero(of[:n] == of[size - 1 :])
    return at, (_scramble(h[at]) >> np.uint64(1)).astype(np.int64)


def words_of(text: str | None) -> list[str]:
    """The words that are compared."""
    if not text:
        return []
    folded = fold(text).lower()
    starts, ends, _ = _places(folded)
    return [folded[a:z] for a, z in zip(starts.tolist(), ends.tolist(), strict=True)]


def _windows(items: DataFrame, words: int, size: int) -> DataFrame:
    """(item_id, win, sids): the windows of each item as text, with their shingles."""
    span = words - size + 1

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for joined, of, starts, ends, hashes in _blocks(b.column(1).to_pylist(), words):
                said = [joined[a:z] for a, z in zip(starts.tolist(), ends.tolist(), strict=True)]
                at, sid = _shingles(of, hashes, size)
                n = len(of) - words + 1
                first = np.flatnonzero(of[:n] == of[words - 1 :]) if n > 0 else at[:0]
                place = np.searchsorted(at, first)
                sids = sid[place[:, None] + np.arange(span)] if len(first) else np.zeros((0, span), np.int64)
                offsets = pa.array(np.arange(len(first) + 1, dtype=np.int32) * span)
                win = pa.array([" ".join(said[i : i + words]) for i in first.tolist()], pa.string())
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(of[first])), win, pa.ListArray.from_arrays(offsets, pa.array(sids.ravel()))], names=["item_id", "win", "sids"])

    kind = items.schema[0].dataType.simpleString()
    return items.mapInArrow(read, f"item_id {kind}, win string, sids array<bigint>")


def _bits(n: int) -> int:
    """A power of two with some bits a shingle."""
    return min(MOST_BITS, 1 << max(20, (n * BITS_EACH - 1).bit_length()))


class _Marked:
    """A bit map of shingles, at hand in all tasks."""

    def __init__(self, shingles: DataFrame):
        self.bits = _bits(shingles.count())
        self.held = shingles.sparkSession.sparkContext.broadcast(_bit_map(shingles.withColumnRenamed("sid", "low"), self.bits))  # of bounded size

    def among(self, sid: np.ndarray) -> np.ndarray:
        p = _position(sid, self.bits)
        return np.flatnonzero(self.held.value[p >> 3] >> (p & 7).astype(np.uint8) & 1)


def _frequencies(texts: DataFrame, asked: DataFrame, words: int, size: int) -> DataFrame:
    """(sid, df): in how many texts each of the shingles asked for stands; those in none are absent."""
    marked = _Marked(asked)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, of, _, _, hashes in _blocks(b.column(0).to_pylist(), words):
                at, sid = _shingles(of, hashes, size)
                hit = marked.among(sid)
                if len(hit):
                    pairs = np.unique(np.stack([of[at[hit]], sid[hit]]), axis=1)  # each text once
                    sid, n = np.unique(pairs[1], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(sid), pa.array(n.astype(np.int64))], names=["sid", "n"])

    counted = texts.select("text").mapInArrow(read, "sid bigint, n bigint").groupBy("sid").agg(F.sum("n").alias("df"))
    return counted.join(asked, "sid", "left_semi")


def _found(texts: DataFrame, prefixes: DataFrame, words: int, size: int) -> DataFrame:
    """(doc_id, sid, before, after, near): each place of a prefix, and the words around it.

    ``before`` and ``after`` count the words of ``near`` in front of the shingle and behind it.
    """
    marked = _Marked(prefixes)
    reach = words - size

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for joined, of, starts, ends, hashes in _blocks(b.column(1).to_pylist(), words):
                at, sid = _shingles(of, hashes, size)
                hit = marked.among(sid)
                if not len(hit):
                    continue
                at, sid = at[hit], sid[hit]
                a = np.maximum(at - reach, np.searchsorted(of, of[at], "left"))
                z = np.minimum(at + size + reach, np.searchsorted(of, of[at], "right"))
                starts_, ends_ = starts.tolist(), ends.tolist()
                near = [" ".join([joined[starts_[w] : ends_[w]] for w in range(i, j)]) for i, j in zip(a.tolist(), z.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(of[at])), pa.array(sid), pa.array((at - a).astype(np.int32)), pa.array((z - at - size).astype(np.int32)), pa.array(near, pa.string())],
                    names=["doc_id", "sid", "before", "after", "near"],
                )

    kind = texts.schema[0].dataType.simpleString()
    return texts.mapInArrow(read, f"doc_id {kind}, sid bigint, before int, after int, near string")


def leaks(
    documents: DataFrame,
    items: DataFrame,
    doc: str = "doc_id",
    item: str = "item_id",
    text: str = "text",
    words: int = WORDS,
    shingle: int = SHINGLE,
    broadcast_windows: int = BROADCAST_WINDOWS,
    hot: int = HOT,
) -> DataFrame:
    """(doc_id, item_id): the text holds ``words`` consecutive words of the item's text."""
    texts = documents.select(F.col(doc).alias("doc_id"), F.col(text).alias("text")).filter(F.col("text").isNotNull())
    windows = durable(_windows(items.select(F.col(item).alias("item_id"), F.col(text).alias("text")), words, shingle))
    span = words - shingle + 1
    distinct = windows.groupBy("win").agg(F.first("sids").alias("sids"))
    each = durable(distinct.select("win", F.posexplode("sids").alias("offset", "sid")))
    frequency = durable(_frequencies(texts, each.select("sid").distinct(), words, shingle))
    # The rarest shingle is the prefix; one in no text rules its window out.
    rarest = each.join(frequency, "sid", "left").groupBy("win").agg(
        F.min_by(F.struct("sid", "offset", "df"), F.struct(F.coalesce("df", F.lit(0)), F.col("offset"))).alias("p"), F.count("df").alias("known")
    )
    prefix = durable(rarest.filter(F.col("known") == span).select("win", "p.sid", "p.offset", "p.df"))
    found = _found(texts, prefix.select("sid").distinct(), words, shingle)
    few = windows.count() <= broadcast_windows
    if few:  # then a shingle that many texts hold is met where it is found
        met = found.join(F.broadcast(prefix), "sid")
    else:
        # As many hot shingles as texts hold ``hot`` of them at most.
        listed = F.broadcast(prefix.filter(F.col("df") > hot).select("sid", F.lit(True).alias("hot")).distinct())
        salt = F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id", "near"), F.lit(SALTS))).otherwise(F.lit(0)).cast("int")
        all_salts = F.explode(F.when(F.col("df") > hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))).alias("salt")
        met = found.join(listed, "sid", "left").withColumn("salt", salt).join(prefix.select("win", "sid", "offset", all_salts), ["sid", "salt"])
    bounded = met.filter((F.col("before") >= F.col("offset")) & (F.col("after") >= words - shingle - F.col("offset")))
    there = F.array_join(F.slice(F.split("near", " "), F.col("before") - F.col("offset") + 1, F.lit(words)), " ") == F.col("win")
    pairs = bounded.filter(there).select("doc_id", "win").distinct()
    named = windows.select("win", "item_id").distinct()
    return pairs.join(F.broadcast(named) if few else named, "win").select("doc_id", "item_id").distinct()
