"""The general data problems: edge cases and brute force."""

import json
import random
from datetime import timedelta

import pytest
from helpers import BASE, SCHEMA, element, elements, pairs
from pyspark.sql import functions as F

from strataq.operators import copydiff, hierarchy, nested, refcheck


# --- nested records ----------------------------------------------------------


def children(spark, *payloads):
    df = spark.createDataFrame(list(enumerate(payloads)), "record_id bigint, payload string")
    return pairs(nested.element_children(df))


def test_children_of_every_kind(spark):
    el = {
        "id": "e1",
        "data": {
            "columns": [{"name": "a"}, None, {"name": "b"}],
            "rows": [{"a": 1, "b": None}, None, {"c": {"x": 1}}],
            "conditions": {"parameter": "h"},
            "exceptions": ["x", None, "y"],
            "then": "do",
            "parameters": {"K": {"unit": "m"}, "L": None},
        },
    }
    got = children(spark, json.dumps({"wrap": [{"sections": [{"section": "1", "sections": {"section": "1.1", "elements": {"e1": el}}}]}]}))
    assert [r[1:] for r in got] == sorted(
        [("e1", "column", 0, "a"), ("e1", "column", 2, "b"), ("e1", "cell", 0, "a"), ("e1", "cell", 0, "b"), ("e1", "cell", 2, "c"), ("e1", "condition", 0, "h")]
        + [("e1", "exception", 0, ""), ("e1", "exception", 2, ""), ("e1", "then", 0, ""), ("e1", "parameter", 0, "K"), ("e1", "parameter", 0, "L")]
    )


def test_strings_hold_json(spark):
    inner = json.dumps({"exceptions": "lone"})
    doc = {"elements": [{"id": "e", "data": inner}, {"id": "f", "data": json.dumps(inner)}]}
    want = [(0, "e", "exception", 0, ""), (0, "f", "exception", 0, "")]
    assert children(spark, json.dumps(doc)) == want
    assert children(spark, json.dumps(json.dumps(doc))) == want


def test_unreadable_and_odd_payloads(spark):
    good = json.dumps({"id": "e", "data": {"then": "x"}})
    bad = [None, "", "  ", "null", "[]", "17", '"text"', good[:-2], good + " x", good + "," + good, '{"id":"e","data":null}', '{"id":"e","data":[1]}', '{"id":"e","data":{"then":"","parameters":[]}}']
    assert children(spark, *bad, good) == [(len(bad), "e", "then", 0, "")]
    tables = nested.flatten_records(spark.createDataFrame([(1, good), (1, good), (2, "x")], "record_id bigint, payload string"))
    assert pairs(tables["records"]) == [(1, True), (2, False)]
    assert tables["elements"].count() == 1 and tables["items"].count() == 1


def test_sections_keep_their_parents(spark):
    doc = {"sections": [{"section": "1", "elements": [{"id": "a", "data": {}}], "sections": [{"section": "1.1", "elements": []}]}]}
    df = spark.createDataFrame([(5, json.dumps(doc), "z")], "record_id bigint, payload string, k string")
    t = nested.flatten_records(df)
    assert pairs(t["sections"].select("section_path", F.coalesce("parent_section_path", F.lit("")), "section")) == [("$.sections[0]", "", "1"), ("$.sections[0].sections[0]", "$.sections[0]", "1.1")]
    assert t["elements"].first().section_path == "$.sections[0]"
    assert nested.element_children(df.limit(0)).count() == 0


def test_deep_nesting(spark):
    doc = {"id": "deep", "data": {"then": "x"}}
    for _ in range(60):
        doc = {"w": [doc]}
    assert children(spark, json.dumps(doc)) == [(0, "deep", "then", 0, "")]


def test_repeated_keys_deep_documents_and_long_strings_lose_nothing(spark):
    twice = '{"elements": [{"id": "a", "id": "b", "data": {"then": "x", "exceptions": ["y"], "exceptions": ["z", "w"]}}], "elements": []}'
    assert children(spark, twice) == [(0, "b", "exception", 0, ""), (0, "b", "exception", 1, ""), (0, "b", "then", 0, "")]
    for n in (400, 1100, 20_000):
        deep = '{"w":[' * n + '{"id":"e","data":{"then":"x","rows":[{"k":{"m":[1]}}]}}' + "]}" * n
        assert children(spark, deep) == [(0, "e", "cell", 0, "k"), (0, "e", "then", 0, "")]
        assert children(spark, deep[:-1]) == [] and children(spark, deep + "]") == []
    long = json.dumps({"id": "e", "data": {"rule": "x" * 21_000_000, "then": "x"}})
    assert children(spark, long) == [(0, "e", "then", 0, "")]


def test_texts_that_look_like_json_are_not_walked(spark):
    inner = json.dumps({"id": "f", "data": {"then": "x"}})
    doc = {"note": inner, "list": [inner, {"id": "g", "data": {"then": "[1]", "exceptions": "[]", "conditions": inner}}], "id": "e", "data": {"nested": [{"id": "h", "data": {"then": 1}}, inner]}}
    assert children(spark, json.dumps(doc)) == [(0, "g", "condition", 0, None), (0, "g", "exception", 0, ""), (0, "g", "then", 0, ""), (0, "h", "then", 0, "")]
    escaped = json.dumps({"elements": [{"id": "é", "data": {"then": "ü"}}]}).replace("data", "d\\u0061ta")
    assert children(spark, escaped) == [(0, "é", "then", 0, "")]


# --- copies --------------------------------------------------------------------


def diff(spark, a, b):
    return pairs(copydiff.diff_copies(elements(spark, *a), elements(spark, *b), copydiff.ELEMENT_FIELDS))


def test_equal_within_the_rules(spark):
    cond = {"parameter": "h", "operator": ">", "value_num": 100.0, "value_str": None, "unit": "ft"}
    a = element("x", title=" T ", cross_references=["b", " a ", None, ""], data={"conditions": [cond], "rows": [{"k": "1 ", "l": None}]})
    b = element("x", title="T", cross_references=["a", "b", "b"], data={"conditions": [cond | {"value_num": 100.05}], "rows": [{"l": None, "k": "1"}]})
    assert diff(spark, [a], [b]) == []


@pytest.mark.parametrize(
    ("change", "field"),
    [
        ({"title": "Т"}, "title"), ({"description": ""}, "description"), ({"type": None}, "type"), ({"parent_id": "p"}, "parent_id"),
        ({"source": {"page": None}}, "source.page"), ({"source": {"citation": None}}, "source.citation"), ({"data": {"rule": "r"}}, "data.rule"),
        ({"data": {"conditions": []}}, "data.conditions"), ({"data": {"rows": [{}]}}, "data.rows"), ({"data": {"columns": [None]}}, "data.columns"),
        ({"cross_references": ["q"]}, "cross_references"),
    ],
)
def test_each_field(spark, change, field):
    assert diff(spark, [element("x")], [element("x", **change)]) == [("x", field)]


def test_current_rows_and_sides(spark):
    a = [element("x", 1, title="old"), element("x", 2, title="new"), element("x", 2, title="new"), element("y"), element(None), element("n", None)]
    b = [element("x", 0, title="new"), element("z"), element("n", None)]
    assert diff(spark, a, b) == [("y", "only_a"), ("z", "only_b")]
    assert diff(spark, a, []) == [("n", "only_a"), ("x", "only_a"), ("y", "only_a")]
    assert diff(spark, [], []) == []


def test_missing_key_is_no_null_value(spark):
    assert diff(spark, [element("x", data={"rows": [{"k": None}]})], [element("x", data={"rows": [{"l": None}]})]) == [("x", "data.rows")]


# --- hierarchy -------------------------------------------------------------------


def chains(links):
    out = {}
    for i in links:
        met, x = [], i
        while True:
            if x in met:
                out[i] = (min(met[met.index(x) :]), -1, None)
                break
            met.append(x)
            p = links[x]
            if p is None or p not in links:
                out[i] = (x, len(met) - 1, list(reversed(met)))
                break
            x = p
    return out


@pytest.mark.parametrize("per_task", [1000, 60])
@pytest.mark.parametrize("seed", [1, 2])
def test_hierarchy_against_walking(spark, seed, per_task):
    rnd = random.Random(seed)
    ids = [f"n{i:04d}" for i in range(260)]
    rnd.shuffle(ids)
    links = {}
    for k, i in enumerate(ids):
        near = ids[max(0, k - 4)] if seed == 1 else rnd.choice(ids)
        links[i] = None if rnd.random() < 0.02 else "gone" if rnd.random() < 0.02 else near
    df = spark.createDataFrame(list(links.items()), "id string, parent_id string")
    got = {r.element_id: (r.top_id, r.depth, r.path) for r in hierarchy.hierarchy(df, loaded=None, paths=True, links_per_task=per_task).collect()}
    assert got == chains(links)


def test_long_chain_and_far_cycle(spark):
    links = {f"c{i:03d}": f"c{i - 1:03d}" if i else None for i in range(150)} | {f"z{i:02d}": f"z{(i + 1) % 30:02d}" for i in range(30)} | {"tail": "z05", "self": "self"}
    df = spark.createDataFrame(list(links.items()), "id string, parent_id string").repartition(5)
    got = {r.element_id: (r.top_id, r.depth) for r in hierarchy.hierarchy(df, loaded=None, links_per_task=60).collect()}
    assert got == {k: v[:2] for k, v in chains(links).items()}


def task_sizes(monkeypatch):
    """The links of each partition that a forest is made of."""
    real, seen = hierarchy._forests, []

    def spy(placed, paths, last=False):
        seen.extend(r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect())
        return real(placed, paths, last)

    monkeypatch.setattr(hierarchy, "_forests", spy)
    return seen


def hierarchy_of(spark, links, paths, per_task):
    df = spark.createDataFrame(list(links.items()), "id string, parent_id string").repartition(4)
    return {r.element_id: (r.top_id, r.depth, r.path if paths else None) for r in hierarchy.hierarchy(df, loaded=None, paths=paths, links_per_task=per_task).collect()}


def scattered(rnd, links):
    """The same trees with ids in no order."""
    names = {i: f"{rnd.randrange(1 << 40):010x}-{i}" for i in links}
    return {names[i]: names.get(p, p) for i, p in links.items()}


def test_ids_in_any_order_need_only_forests_of_bounded_size(spark, monkeypatch):
    rnd = random.Random(5)
    links = scattered(rnd, {i: None if i == 1 else i // 2 for i in range(1, 16_001)})
    seen = task_sizes(monkeypatch)
    got = hierarchy_of(spark, links, False, 500)
    assert got == {i: (v[0], v[1], None) for i, v in chains(links).items()}
    assert max(seen) <= 500


@pytest.mark.parametrize("shape", ["chain", "cycle", "hub", "forest"])
def test_scattered_shapes_over_several_levels(spark, monkeypatch, shape):
    rnd = random.Random(6)
    n = 420
    links = {
        "chain": {i: i - 1 if i else None for i in range(n)},
        "cycle": {i: (i + 1) % 200 if i < 200 else i - 37 if i < 360 else None for i in range(n)},
        "hub": {i: None if i == 0 else 0 if i % 3 == 0 else i - 1 for i in range(n)},
        "forest": {i: "gone" if i % 7 == 0 else i - 1 for i in range(n)},
    }[shape]
    links = scattered(rnd, links)
    seen = task_sizes(monkeypatch)
    assert hierarchy_of(spark, links, True, 150) == chains(links)
    assert max(seen) <= 150


def test_hierarchy_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert hierarchy.hierarchy(empty).count() == 0
    df = elements(spark, element("a", 1, parent_id="b"), element("a", 2, parent_id=None), element("a", 2), element("b", None, parent_id="a"), element(None, parent_id="a"))
    assert pairs(hierarchy.hierarchy(df)) == [("a", "a", 0), ("b", "a", 1)]
    below = hierarchy.descendants(hierarchy.hierarchy(df, paths=True))
    assert pairs(below) == [("a", "b", 1)]


# --- references ----------------------------------------------------------------


def orphans(spark, refs, loads, gone):
    day = lambda d: None if d is None else BASE + timedelta(days=d)
    r = spark.createDataFrame([(t, i, x, day(d)) for t, i, x, d in refs], "ref_table string, ref_id string, target_id string, at timestamp")
    e = spark.createDataFrame([(x, day(d)) for x, d in loads], "target_id string, at timestamp")
    w = spark.createDataFrame([(x, day(d)) for x, d in gone], "target_id string, at timestamp")
    return sorted((r.ref_id, r.target_id, r.status) for r in refcheck.orphans(r, e, w).collect())


def test_reference_states(spark):
    refs = [("t", "1", "never", 5), ("t", "2", " x ", 5), ("t", "3", "x", 0), ("t", "4", "x", 11), ("t", "5", "x", 21), ("t", "6", "", 5), ("t", "7", None, 5), ("t", "8", "x", None), ("t", "9", "x", 30), ("t", "9", "x", 30)]
    got = orphans(spark, refs, [("x", 1), ("x", 20), ("x", 30), (None, 3), ("never", None)], [("x", 10), ("x", 30), (None, 1)])
    assert got == [("1", "never", "missing"), ("3", "x", "late"), ("4", "x", "deleted"), ("8", "x", "late")]
    assert orphans(spark, [], [], []) == []
    assert orphans(spark, refs[:1], [], []) == [("1", "never", "missing")]


def test_hot_target_over_many_partitions(spark):
    rnd = random.Random(3)
    refs = [("t", str(i), rnd.choice(["hot", "hot", "hot", "a", "b", "none"]), rnd.randrange(400)) for i in range(1500)]
    loads = [(x, rnd.randrange(400)) for x in ("hot", "a", "b") for _ in range(6)]
    gone = [(x, rnd.randrange(400)) for x in ("hot", "a", "none") for _ in range(6)]
    want = []
    for _, i, x, d in refs:
        up = [(t, 1) for y, t in loads if y == x and t <= d] + [(t, 0) for y, t in gone if y == x and t <= d]
        if not up or max(up)[1] == 0:
            first = min((t for y, t in loads if y == x), default=None)
            want.append((i, x, "missing" if first is None else "late" if first > d else "deleted"))
    for parts in ("3", "17"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        assert orphans(spark, refs, loads, gone) == sorted(want)
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_element_references(spark):
    e = elements(spark, element("a", 40, cross_references=["b", " b", None, "q"]), element("a", 1, cross_references=["old"]), element("b", 50))
    d = spark.createDataFrame([(1, "b", BASE), (1, "b", BASE), (2, None, BASE)], "decision_id bigint, element_id string, decided_at timestamp")
    w = spark.createDataFrame([], "element_id string, withdrawn_at timestamp, reason string")
    got = pairs(refcheck.element_orphans(e, d, w).select("ref_table", "ref_id", "target_id", "period", "status"))
    assert got == [("decisions", "1", "b", "2024-01", "late"), ("elements", "a", "b", "2024-02", "late"), ("elements", "a", "q", "2024-02", "missing")]
