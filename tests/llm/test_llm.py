"""The text operators against brute force and on edge cases."""

import random
import re
import string

import numpy as np
import pytest
from helpers import element, elements, pairs
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strataq.llm import leakage, lookalike, packing, spans

# --- look-alikes -----------------------------------------------------------------

R = lookalike.Reader({"^f": -1.0, "fl": -1.0, "fI": -5.0, "la": -1.0, "Ia": -6.0})


@pytest.mark.parametrize(
    ("a", "b"),
    [
        ("plаte", "plate"), ("ｗｉｎｄ （１）", "wind (1)"), ("ﬁeld ﬂow", "field flow"), ("façade", "façade"), ("zero​width­", "zerowidth"),
        ("a b　c d", "a b c d"), ("ⅽoⅼd", "cold"), ("ոսօ", "nuo"), ("fӀange", "flange"), ("Τ́", "T́"), ("﻿x⁠", "x"), ("ёл", "ëл"),
    ],
)
def test_equal_looks(a, b):
    assert R.read(a) == R.read(b)


@pytest.mark.parametrize(("a", "b"), [("m²", "m2"), ("≤", "<"), ("Case", "case"), ("é", "e"), ("a  b", "a b"), ("l", "I"), ("0", "O"), ("a\nb", "a b"), ("β", "B"), ("x½", "x1/2")])
def test_different_looks(a, b):
    assert R.read(a) != R.read(b)


def test_latin_texts_and_whole_words_keep_their_script():
    for t in ("", "plain text 12", "façade 5 m² ≤ 3 °", "γ = 2", "вода"):
        assert R.read(t) == t
    assert R.read("poзa") == "роза"  # the letter without a Latin look decides


LOOK = sorted({c for v in lookalike.LOOKS.values() for c in v})


@settings(max_examples=150, deadline=None)
@given(st.text("abcdeopxyzACEHIlOPзжфλ .²é", max_size=24), st.randoms())
def test_disguise_is_undone(text, rnd):
    def other(c):
        return rnd.choice(lookalike.LOOKS.get(c, c)) if rnd.random() < 0.5 else c

    hidden = "".join(other(c) + ("​" if rnd.random() < 0.1 else "") for c in text)
    if "ӏ" not in hidden and "Ӏ" not in hidden and "ǀ" not in hidden:  # one sign for two letters
        assert R.read(hidden) == R.read(text)
        assert lookalike.fold(hidden) == lookalike.fold(text)
    assert R.read(R.read(text)) == R.read(text)


def test_pairs(spark):
    rows = [
        element("a", title="Wind load", data={"rule": "x"}), element("b", title="Wіnd load", data={"rule": None}), element("c", title="Wind load"), element("d", title="Wind  load"),
        element("e", 1, title="Wind lo​ad"), element("e", 2, title="gone"), element(None, title="Wind lo­ad"), element("f", title=None, data={"definition": ""}),
        element("g", title=None, data={"definition": "​"}), element("h", title="y" * 200_000 + "а"), element("i", title="y" * 200_000 + "a"),
    ]
    want = [("a", "b", "title"), ("b", "c", "title"), ("f", "g", "data.definition"), ("h", "i", "title")]
    assert pairs(lookalike.look_same(elements(spark, *rows))) == want
    assert pairs(lookalike.look_same(elements(spark, *rows), hot=1)) == want
    assert lookalike.look_same(elements(spark)).count() == 0
    assert pairs(lookalike.look_classes(elements(spark, *rows))) == sorted(
        [(i, "title", "a", 2) for i in "abc"] + [(i, "data.definition", "f", 2) for i in "fg"] + [(i, "title", "h", 2) for i in "hi"]
    )
    forms = {(r.id, r.field): r.form for r in lookalike.forms(elements(spark, *rows)).collect()}
    assert forms["b", "title"] == "Wind load" and ("f", "title") not in forms and forms["g", "data.definition"] == ""


def test_second_hash_has_a_seed_of_its_own(spark):
    """Two hashes of a text are two seeds over it, not one hash hashed again."""
    h = spark.createDataFrame([("Wind load",)], "t string").select(*(x.alias(k) for x, k in zip(lookalike._hashed(F.col("t")), "ab", strict=True))).first()
    again = spark.sql("SELECT xxhash64('Wind load') AS a, xxhash64(17, 'Wind load') AS b").first()
    assert (h.a, h.b) == (again.a, again.b)


# --- packing ---------------------------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 40), st.lists(st.integers(1, 40), max_size=60))
def test_plan_holds_each_item_once(capacity, sizes):
    sizes = [min(s, capacity) for s in sizes]
    counts = {s: sizes.count(s) for s in sizes}
    plan, bins = packing.fill_plan(counts, capacity)
    filled, left = {}, dict(counts)
    for size, first, m, n in plan:
        for i in range(n):
            filled[first + i // m] = filled.get(first + i // m, 0) + size
        left[size] -= n
    assert not any(left.values()) and sorted(filled) == list(range(bins))
    assert max(filled.values(), default=0) <= capacity
    assert bins <= max(1, -(-11 * -(-sum(sizes) // capacity) // 9) + 2, (17 * -(-sum(sizes) // capacity)) // 10 + 1)


@settings(max_examples=200, deadline=None)
@given(st.integers(5, 40), st.lists(st.integers(1, 40), max_size=60))
def test_the_rest_is_filled_as_item_by_item_best_fit_does(capacity, sizes):
    sizes = [min(s, capacity) for s in sizes]
    before = packing.dominant
    packing.dominant = lambda h, s, c: None
    try:
        plan, bins = packing.fill_plan({s: sizes.count(s) for s in sizes}, capacity)
    finally:
        packing.dominant = before
    rooms = []
    for s in sorted(sizes, reverse=True):
        fits = [r for r in rooms if r >= s]
        if fits:
            rooms.remove(min(fits))
        rooms.append((min(fits) if fits else capacity) - s)
    filled = {}
    for size, first, m, n in plan:
        for i in range(n):
            filled[first + i // m] = filled.get(first + i // m, 0) + size
    assert sorted(capacity - f for f in filled.values()) == sorted(rooms)


def best(sizes, capacity):
    """The fewest containers, by trying all."""
    sizes, bound = sorted(sizes, reverse=True), [len(sizes)]

    def go(i, bins):
        if len(bins) >= bound[0]:
            return
        if i == len(sizes):
            bound[0] = len(bins)
            return
        for j in {b: k for k, b in enumerate(bins)}.values():
            if bins[j] + sizes[i] <= capacity:
                go(i + 1, [*bins[:j], bins[j] + sizes[i], *bins[j + 1 :]])
        go(i + 1, [*bins, sizes[i]])

    go(0, [])
    return bound[0]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=8))
def test_dominated_sets_lose_nothing(sizes):
    h = packing.Histogram({s: sizes.count(s) for s in sizes})
    s = max(sizes)
    p = packing.dominant(h, s, 20)
    if p is not None:
        rest = list(sizes)
        for x, m in p.items():
            for _ in range(m):
                rest.remove(x)
        assert best(rest, 20) + 1 == best(sizes, 20)


def test_pack(spark):
    rnd = random.Random(1)
    texts = {i: " ".join(rnd.choice(["a", "b2", "c-d", "é.", "日本", "x_1!"]) for _ in range(rnd.choice([0, 1, 2, 3, 7, 50, 300]))) for i in range(300)} | {900: None, 901: " \n", 902: "w " * 5000, 903: "a!! ²b", 904: "a\x1cb!\x1f\x1e?"}
    docs = spark.createDataFrame([(i, t, "z") for i, t in texts.items()], "doc_id bigint, text string, rank string").repartition(3)
    kinds = spark.createDataFrame([("s", 16), ("l", 100), ("l", 400), ("bad", 0), (None, 5), ("none", None)], "container_kind string, capacity bigint")
    out = packing.pack(docs, kinds, per_salt=20).toPandas()
    sizes = {i: len(re.findall(r"\w+|[^\w\s]+", t or "")) for i, t in texts.items()}
    for kind, capacity in (("s", 16), ("l", 100)):
        x = out[out.container_kind == kind]
        assert x.groupby("doc_id")["size"].sum().to_dict() == sizes
        filled = x.groupby("container_id")["size"].sum()
        assert filled.max() <= capacity and sorted(filled.index) == list(range(len(filled)))
        pieces = x.groupby("doc_id").piece.agg(["count", "max"])
        for i, n in sizes.items():
            assert tuple(pieces.loc[i]) == (max(1, -(-n // capacity)), max(0, -(-n // capacity) - 1))
        assert len(filled) <= -(-sum(sizes.values()) // capacity) * 1.05 + 1
    assert set(out.container_kind) == {"s", "l"}
    assert packing.pack(docs.limit(0), kinds).count() == 0 and packing.pack(docs, kinds.limit(0)).count() == 0
    report = {r.container_kind: r for r in packing.fill_report(packing.pack(docs, kinds), kinds).collect()}
    assert 0 <= report["s"].unused < 0.1


# --- leakage ---------------------------------------------------------------------


def test_leaks_against_brute_force(spark):
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([5, 12, 13, 20])))) for i in range(40)] + [(90, None), (91, ""), (0, "w1 " * 13), (92, "w1 " * 14), (None, "w2 " * 13)]
    docs = []
    for i in range(200):
        t = " ".join(rnd.choice(words) for _ in range(rnd.randrange(40)))
        src = rnd.choice(items)[1] or ""
        w = src.split()
        if len(w) > 4:
            k = rnd.choice([12, 13, len(w)])
            t += ", " + "; ".join(w[:k]).upper() + "! " + t
        docs.append((i, t))
    docs += [(500, None), (501, ""), (502, "w1 " * 50_000), (503, "w1 " * 13), (504, "ｗ２ " * 13), (500, "w1 " * 13), (None, "w2-" * 13)]
    got = {tuple(r) for r in leakage.leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    windows = {}
    for i, t in items:
        w = leakage.words_of(t)
        for k in range(len(w) - 12):
            windows.setdefault(tuple(w[k : k + 13]), set()).add(i)
    want = set()
    for i, t in docs:
        w = leakage.words_of(t)
        for k in range(len(w) - 12):
            want |= {(i, j) for j in windows.get(tuple(w[k : k + 13]), ())}
    assert got == want and len(want) > 20
    by_key = leakage.leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), broadcast_windows=0, hot=3)
    assert {tuple(r) for r in by_key.collect()} == want


@settings(max_examples=100, deadline=None)
@given(st.text("abz09_ .,-éß²١ⅷ\u0301𝔸\n", max_size=60))
def test_words_are_runs_of_letters_and_digits(text):
    want = re.findall(r"[^\W_]+", lookalike.fold(text).lower())
    assert leakage.words_of(text) == want
    a, z, h = leakage._places(lookalike.fold(text).lower())
    again = {w: leakage._places(w)[2][0] for w in want}
    assert [again[w] for w in want] == h.tolist() and len(set(again.values())) == len(again)


def test_stretches_of_a_long_text(monkeypatch):
    text = " ".join(f"w{i * i}" for i in range(3000))
    whole = leakage._places(text)[2]
    monkeypatch.setattr(leakage, "BLOCK", 50)
    assert (leakage._places(text)[2] == whole).all()


def test_leaks_of_nothing(spark):
    d, i = "doc_id bigint, text string", "item_id bigint, text string"
    one = [(1, " ".join(string.ascii_lowercase))]
    for docs, items in (([], one), (one, []), ([], []), (one, [(1, "a b c")])):
        assert leakage.leaks(spark.createDataFrame(docs, d), spark.createDataFrame(items, i)).count() == 0
    assert pairs(leakage.leaks(spark.createDataFrame(one, d), spark.createDataFrame(one, i))) == [(1, 1)]


# --- spans -----------------------------------------------------------------------


def brute(docs, span):
    held = {}
    for i, t in docs:
        if i is not None and t is not None:
            for k in range(len(t) - span + 1):
                held.setdefault(t[k : k + span], set()).add(i)
    marks = {}
    for i, t in docs:
        if i is not None and t is not None:
            for k in range(len(t) - span + 1):
                if len(held[t[k : k + span]]) > 1:
                    marks.setdefault(i, set()).update(range(k, k + span))
    out = set()
    for i, m in marks.items():
        for a in m:
            if a - 1 not in m:
                b = a
                while b in m:
                    b += 1
                out.add((i, a, b))
    return out


@pytest.mark.parametrize("per_bucket", [1000, 4])
@pytest.mark.parametrize("alphabet", ["ab", "abcdefgh é日\U0001f600"])
def test_spans_against_brute_force(spark, alphabet, per_bucket):
    rnd = random.Random(len(alphabet) + per_bucket)
    pool = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(10, 60))) for _ in range(12)]
    docs = [(i, "".join(rnd.choice(pool) if rnd.random() < 0.4 else "".join(rnd.choice(alphabet) for _ in range(15)) for _ in range(rnd.randrange(6)))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, docs[3][1]), (103, docs[3][1]), (None, docs[3][1]), (104, "a" * 200), (105, "a" * 150), (106, "xyz" * 30)]
    df = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id bigint, text string, low int").repartition(4)
    got = {tuple(r) for r in spans.shared_spans(df, span=20, m=8, per_bucket=per_bucket, bits=1 << 16).collect()}
    assert got == brute(docs, 20) and got


@pytest.mark.parametrize("places", [1 << 18, 3])
def test_repeats_in_one_record_and_a_partner_in_another_salt(spark, places, monkeypatch):
    """A window that a record holds twice (in equal super-k-mers, in others, in one) is marked at both places."""
    monkeypatch.setattr(spans, "PLACES", places)
    rnd = random.Random(4)
    word = lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n))
    docs = []
    for i in range(0, 60, 2):
        p, q = word(45), word(3) * 15
        docs += [(i, word(30) + p + word(30) + p + word(9) + p[:30] + word(30) + q + word(30)), (i + 1, word(20) + (q if i % 3 else p) + word(20))]
    # One shared block gives its minimiser so many super-k-mers that it is split.
    same = word(40)
    docs += [(100 + i, word(10) + same + word(15) + same if i < 6 else word(10) + same[i - 6 :] + word(5)) for i in range(9)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for per_bucket in (1, 3):
            assert {tuple(r) for r in spans.shared_spans(df, span=20, m=8, per_bucket=per_bucket, bits=1 << 16).collect()} == brute(docs, 20)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_long_texts_are_cut_and_put_together(spark):
    rnd = random.Random(9)
    body = "".join(rnd.choice("abcdefghij") for _ in range(3 * spans.BLOCK // 2))
    docs = [(1, "x" * 100 + body), (2, body + "y"), (3, "z" * 1000), (4, body[spans.BLOCK - 150 : spans.BLOCK + 150])]
    got = pairs(spans.shared_spans(spark.createDataFrame(docs, "doc_id bigint, text string")))
    assert got == [(1, 100, 100 + len(body)), (2, 0, len(body)), (4, 0, 300)]


@pytest.mark.parametrize("kept", [0, 1, 3])
def test_windows_whose_hashes_meet_are_told_apart(monkeypatch, kept):
    rnd = random.Random(3)
    pool = ["".join(rnd.choice("abc") for _ in range(9)) for _ in range(5)]
    texts = list(dict.fromkeys("".join(rnd.choice(pool) for _ in range(rnd.randrange(1, 5))) for _ in range(30)))
    owners = [sorted((rnd.randrange(4), rnd.randrange(4))) for _ in texts]
    real = spans.window_hashes
    monkeypatch.setattr(spans, "window_hashes", lambda *a: tuple(h & np.uint64(kept) for h in real(*a)))
    shared = spans._sorted_windows(texts, owners, 6, spans._Powers())[5]
    held = {}
    for t, o in zip(texts, owners, strict=True):
        for k in range(len(t) - 5):
            held.setdefault(t[k : k + 6], set()).update(o)
    assert shared.tolist() == [len(held[t[k : k + 6]]) > 1 for t in texts for k in range(len(t) - 5)]


def test_one_record_with_one_minimiser_throughout_is_split(spark):
    """A long periodic record: its super-k-mers are cut and spread, and found wherever a partner is."""
    docs = [(1, "ab" * 6000), (2, "x" * 30 + "ab" * 60 + "y"), (3, "cd" * 3000)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert pairs(spans.shared_spans(df, span=20, m=8, per_bucket=2, bits=1 << 16)) == [(1, 0, 12000), (2, 30, 150)]
    counts = spans._packed(df.selectExpr("doc_id id", "text", "doc_id code"), np.full(1 << 14, 255, np.uint8), 1 << 16, {int(x): 5 for x in spans.minimisers(spans.code_points("ab" * 20), 20, 8)}, 20, 8)
    assert counts.filter("id = 1").select("salt").distinct().count() > 1 and counts.selectExpr("max(length(text))").first()[0] <= spans.RUN + 19


def test_no_spans(spark):
    schema = "doc_id bigint, text string"
    assert spans.shared_spans(spark.createDataFrame([], schema)).count() == 0
    same = spark.createDataFrame([(1, "q" * 400), (1, "q" * 400), (2, "r" * 299), (3, "r" * 299)], schema)
    assert spans.shared_spans(same).count() == 0
    assert pairs(spans.shared_chars(same)) == [(1, 0, 0, 400), (2, 0, 0, 299), (3, 0, 0, 299)]
