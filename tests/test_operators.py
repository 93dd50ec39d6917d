"""The document operators on small fixtures."""

import json

import pytest
from helpers import element, elements, pairs
from pyspark.sql import functions as F

from strataq.functions import text as T
from strataq.operators import classify as C
from strataq.operators import clean as K
from strataq.operators import compare as X
from strataq.operators import geometry as G
from strataq.operators import gold, link, quality, registry, tables
from strataq.operators import sequence as S
from strataq.operators.conditions import parse_conditions


def one(spark, expr, **cols):
    df = spark.range(1).select(*(F.lit(v).alias(k) for k, v in cols.items()))
    return df.select(expr.alias("x")).first().x


def test_text_functions(spark):
    t = F.col("t")
    assert one(spark, T.fix_text(t), t="  ﬁre &amp; da- ta\n x ") == "fire & data x"
    assert one(spark, T.repair_words(t), t="is speci ed and coef cient") == "is specified and coefficient"
    assert one(spark, T.section_number(t), t="26.1.2 Scope") == "26.1.2"
    assert one(spark, T.section_number(t), t="Scope") is None
    assert one(spark, T.section_prefixes(t), t="26.1.2") == ["26.1.2", "26.1", "26"]
    assert one(spark, T.chapter_of_id(t), t="STD7-22-26.1-P1") == 26
    assert [tuple(m) for m in one(spark, T.mentions(t), t="See Table 1.2-3, Figure 2.1-4A and Eq. (3.1-2a), Section 4.5")] == [("table", "1.2-3"), ("figure", "2.1-4A"), ("equation", "3.1-2a"), ("section", "4.5")]
    assert one(spark, T.external_mentions(t), t="per ASTM A36 and ACI 318-19") == ["ASTM A36", "ACI 318-19"]
    assert one(spark, T.standard_family(t), t="ACI 318, Code") == "ACI 318"
    assert one(spark, T.number_cell(t), t=" 12.5 ") == 12.5 and one(spark, T.number_cell(t), t="1_000") is None
    assert one(spark, T.html_escape(t), t="<a&b>") == "&lt;a&amp;b&gt;"
    assert one(spark, T.section_key(t), t="26.x") == [26, 999]


def test_equations_look_back(spark):
    got = one(spark, T.equations(F.col("t")), t="First part. V = 2 (26.1-1) and so; q = 3 (26.1-2a) end")
    assert [tuple(e) for e in got] == [("26.1-1", "26", "V = 2 (26.1-1)"), ("26.1-2a", "26", "q = 3 (26.1-2a)")]
    assert one(spark, T.equations(F.col("t")), t="none") == []
    long = one(spark, T.equations(F.col("t")), t="x" * 500 + " (1.1-1)")
    assert len(long[0].expression) == 207


@pytest.mark.parametrize(
    ("op", "want"),
    [("≤", "<="), ("≥", ">="), ("≠", "!="), ("equals", "=="), ("Greater Than", ">"), ("less than", "<"), (" at least ", ">="), ("at most", "<="), ("not equal", "!="), ("=", "="), (None, None), ("0", "0")],
)
def test_operators(spark, op, want):
    df = spark.createDataFrame([(op,)], "o string")
    assert df.select(K.normal_operator(F.col("o")).alias("x")).first().x == want


def test_clean_up(spark):
    e = element("std7-22 - 26.5-T1", title=None, data={"rule": None, "conditions": [{"parameter": None, "operator": "at least", "value_num": 1.0, "value_str": None, "unit": None}]}, source={"page": None})
    f = element("S-1-1-F", type="formula", data={"expression": None, "parameters": {"a": {"unit": None, "range": [None, 1.0], "source": None}, "b": {"unit": "m", "range": [0.0, 1.0], "source": None}}})
    df = elements(spark, e, f).withColumn("own", F.lit(7))
    once = K.post_process(df)
    rows = {r.type: r for r in once.collect()}
    p = rows["provision"]
    assert p.id == "STD7-22-26.5-T1" and p.title == "" and p.data.rule == "" and p.description is None and p.source.page is None and p.own == 7
    assert p.data.conditions[0].operator == ">=" and p.data.conditions[0].parameter == ""
    q = rows["formula"].data
    assert q.expression == "" and q.parameters["a"].range is None and q.parameters["a"].unit == "" and q.parameters["b"].range == [0.0, 1.0]
    assert pairs(once.select(F.to_json(F.struct("*")))) == pairs(K.post_process(once).select(F.to_json(F.struct("*"))))


@pytest.mark.parametrize(
    ("rule", "want"),
    [
        ("BASIC WIND SPEED: Three-second gust", ("BASIC WIND SPEED", "Three-second gust")),
        ("Wall, is defined as a thing", ("Wall", "a thing")),
        ("Load means force", ("Load", "force")),
        ("Where h > 60 ft the load shall be reduced.", None),
        ("", None),
        (None, None),
    ],
)
def test_definitions(spark, rule, want):
    row = K.reclassify_definitions(elements(spark, element("a", data={"rule": rule}))).first()
    assert (row.type == "definition") == (want is not None)
    assert want is None or (row.data.term, row.data.definition, row.data.rule) == (*want, None)


def test_conditions(spark):
    got = one(spark, parse_conditions(F.col("t")), t="h >= 60 ft and V > 150 mph, a = 2, greater than or equal to 30 m in Risk Category II or Exposure B for enclosed building")
    assert [(c.parameter, c.operator, c.value_num, c.value_str, c.unit) for c in got] == [
        ("h", ">=", 60.0, None, "ft"), ("V", ">", 150.0, None, "m"), ("a", "==", 2.0, None, None), ("", ">=", 30.0, None, "m"),
        ("risk_category", "==", None, "II", None), ("exposure_category", "==", None, "B", None), ("enclosure", "==", None, "enclosed", None),
    ]


def blocks(spark, *rows):
    return spark.createDataFrame([("d", 26, i, f"b{i}", *r) for i, r in enumerate(rows)], "doc string, chapter int, seq int, id string, label string, bold string, text string")


def test_classifier_learns(spark):
    b = blocks(
        spark,
        ("text", "26", "26"), ("text", "", "26 walls of type A"), ("section_header", "26.1 Scope", "26.1 Scope"), ("text", "User Note", "User Note: x"), ("text", "EXCEPTION:", "EXCEPTION: y"),
        ("text", "WIND", "WIND: a moving gas"), ("text", "Exposure B.", "Exposure B. is rough"), ("text", "PROCEDURES", "PROCEDURES"), ("text", "ASTM A36", "ASTM A36, Steel"), ("text", "", "It shall be so"),
        ("text", "", "Nothing"), ("page_footer", "", "foot"),
    )
    kinds = {r.id: (r.kind, r.note) for r in C.classify(b, C.learn_patterns(b, ["doc"]), ["doc"]).collect()}
    assert "b0" not in kinds and "b11" not in kinds
    assert [kinds[f"b{i}"][0] for i in range(1, 11)] == ["text_block", "heading", "user_note", "exception", "definition", "definition", "heading", "reference", "provision", "text_block"]
    assert kinds["b6"][1] == "sub_definition" and kinds["b7"][1] == "topic"
    strict = C.classify(b, C.learn_patterns(b, ["doc"]), ["doc"], skip_by_prefix=True)
    assert strict.filter("id in ('b1', 'b2')").count() == 0


def test_reading_order(spark):
    b = blocks(spark, ("h", "", "26.1 Scope"), ("t", "", "x" * 40), ("t", "", "short"), ("t", "", ""), ("t", "", "tail"), ("h", "", "26.10 Far"), ("t", "", "26.2 y" + "y" * 40), ("t", "", "3.3 no" + "n" * 40))
    b = b.withColumn("kind", F.when(F.col("label") == "h", "heading").otherwise("text_block"))
    filled = S.fill_section(b, ["doc"], ["seq"])
    assert [r.in_section for r in filled.orderBy("seq").collect()] == ["26.1"] * 5 + ["26.10", "26.2", "26.2"]
    ids = S.assign_ids(filled, ["doc"], ["seq"], F.lit("STD-1"))
    assert [r.new_id for r in ids.orderBy("seq").collect()][:3] == ["STD-1-26.1-H1", "STD-1-26.1-T1", "STD-1-26.1-T2"]
    merged = S.merge_fragments(b, ["doc"], ["seq"]).orderBy("seq").collect()
    assert [r.n_parts for r in merged] == [1, 4, 1, 1, 1] and merged[1].merged == "x" * 40 + " short  tail"
    inv = S.inversions(filled.withColumn("section", F.col("in_section")), ["doc"], ["seq"]).first()
    assert (inv.n_sections, inv.n_inversions) == (8, 1)


def test_fragments_at_the_edges(spark):
    b = blocks(spark, ("t", "", "lead"), ("f", "", ""), ("t", "", "lost")).withColumn("kind", F.when(F.col("label") == "t", "text_block").otherwise("figure"))
    assert [(r.merged, r.n_parts) for r in S.merge_fragments(b, ["doc"], ["seq"]).orderBy("seq").collect()] == [("lead", 1), ("", 1)]


def test_heading_split_sections_and_definitions(spark):
    s = one(spark, S.split_heading(F.col("h"), F.col("b")), h="26.1.1 Scope Buildings and others", b="26.1.1 Scope")
    assert (s.head, s.body) == ("26.1.1 Scope", "Buildings and others")
    s = one(spark, S.split_heading(F.col("h"), F.col("b")), h="26.1.1 Scope", b="26.1.1 Scope")
    assert (s.head, s.body) == ("26.1.1 Scope", None)
    parts = one(spark, S.split_sections(F.col("t")), t="26.1 Scope of the matter that is long enough. 26.2 Definitions of all the terms that there are.")
    assert [p[:4] for p in parts] == ["26.1", "26.2"]
    found = one(spark, S.embedded_definitions(F.col("t")), t="x WIND SPEED: the speed of the wind. NOTE: not a term at all. GUST FACTOR: the other one here")
    assert [d.term for d in found] == ["WIND SPEED", "GUST FACTOR"]


def test_chapters_and_lines(spark):
    starts = spark.createDataFrame([("d", 1, 1), ("d", 2, 20), ("d", 3, 100)], "doc string, chapter int, page int")
    ends = spark.createDataFrame([("d", 110)], "doc string, page int")
    got = [(r.chapter, r.end_page) for r in S.chapter_ranges(starts, ends, ["doc"]).orderBy("chapter").collect()]
    assert got == [(1, 19), (2, 69), (3, 109)]
    chars = spark.createDataFrame([(1, "a", 10.0, 0.0, 5.0), (1, "b", 11.0, 8.0, 9.0), (1, "c", 12.0, 0.0, 5.0), (1, "d", 12.6, 5.5, 9.0)], "page int, text string, top double, x0 double, x1 double")
    lines = S.anchored_lines(chars, ["page"])
    assert pairs(lines.select("text", "line")) == [("a", 1), ("b", 1), ("c", 2), ("d", 2)]
    assert pairs(S.spaced_text(lines, ["page", "line"], ["x0"], to="said").select("said")) == [("a b",), ("cd",)]
    runs = S.bold_runs(chars.withColumn("bold", F.col("text") != "b"), ["page"], ["top"], least=2)
    assert pairs(runs.select("run_text")) == [("cd",)]


def test_columns(spark):
    left = [(1, float(x), 600) for x in range(0, 280) for _ in range(4)]
    right = [(1, float(x), 600) for x in range(320, 600) for _ in range(4)]
    df = spark.createDataFrame(left + right, "page int, x0 double, width int")
    row = S.column_gap(df, ["page"]).first()
    assert row.two_columns and 280 <= row.split_at <= 320
    full = spark.createDataFrame([(1, float(x), 600) for x in range(600) for _ in range(4)], "page int, x0 double, width int")
    assert not S.column_gap(full, ["page"]).first().two_columns


def test_parents(spark):
    rows = [("heading", "1.1 H", "1.1", ""), ("formula", "V = 2", "1.1", ""), ("text_block", "where V is", "1.1", ""), ("heading", "1.2 H", "1.2", ""), ("text_block", "where no", "1.2.3", ""), ("figure", "f", "1.2", "Figure 1.2-1"), ("text_block", "Figure 1.2-1 shows", "1.2", ""), ("provision", "p", "1.2", ""), ("text_block", "a. item", "1.2", ""), ("text_block", "free", "9.9", "")]
    df = spark.createDataFrame([("d", i, f"e{i}", *r) for i, r in enumerate(rows)], "doc string, seq int, id string, kind string, text string, section string, citation string")
    got = {r.id: (r.parent, r.rule) for r in link.associate(df, ["doc"], ["seq"]).collect()}
    assert got == {"e2": ("e1", "where"), "e4": ("e3", "section"), "e6": ("e5", "figure"), "e8": ("e7", "list"), "e9": ("e3", "nearest")}


def test_gold_and_validity(spark):
    rows = [element(f"S-1-1-P{i}", seq=i, data={"rule": "r", "conditions": []}, metadata={"qc_status": "passed" if i == 8 else "pending"}) for i in range(10)]
    df = elements(spark, *rows)
    assert [r.id for r in gold.draft_gold(df, 3).orderBy("seq").collect()] == ["S-1-1-P0", "S-1-1-P1", "S-1-1-P8"]
    bad = elements(spark, element("bad id", type="x", title=None, metadata={"qc_status": "?"}), rows[0])
    errors = {r.id: r.errors for r in quality.validate(bad).collect()}
    assert set(errors["bad id"]) == {"id", "type", "title", "data", "metadata"} and errors["S-1-1-P0"] == []


def test_compare_and_calibrate(spark):
    a = element("x", data={"rule": "r"})
    def summary(b, base=a):
        return X.compare_summary(X.pair_status(X.match_runs(elements(spark, base), elements(spark, b)))).first()
    assert (summary(a).agreed, summary(a).agreement) == (1, 1.0)
    assert summary(a | {"title": "U", "cross_references": ["q"]}).helper_only == 1
    assert summary(element("x", data={"rule": "s"})).authoritative == 1
    assert summary(element("new", data={"rule": "r"})).by_citation == 1
    form = element("f", type="formula", data={"expression": "a"})
    assert summary(element("f", type="formula", data={"expression": "b"}), form).authoritative == 1
    fig = element("g", type="figure", data={"description": "a"})
    assert summary(element("g", type="figure", data={"description": "b"}), fig).helper_only == 1
    fields = [f for f in X.RUN_FIELDS if f.path in ("data.rule", "data.term")]
    s = X.score_gold(elements(spark, a), elements(spark, a, element("gone")), fields)
    assert {r.element_id: r.score for r in s.collect()} == {"x": 1.0, "gone": 0.0}
    rep = X.calibration_report(s).first()
    assert (rep.n_compared, rep.n_missing, rep.accuracy) == (1, 1, 1.0)


def test_compare_takes_parameters_and_pages(spark):
    p = {"unit": "m", "range": [1.0, 2.0], "source": "s"}
    def form(i, params):
        return element(i, type="formula", data={"expression": "e", "parameters": params})
    a = [form("u", {"p": p}), form("r", {"p": p}), form("s", {"p": p}), form("k", {"p": p}), form("n", {"p": p}), form("near", {"p": p}), form("none", None)]
    b = [form("u", {"p": p | {"unit": "ft"}}), form("r", {"p": p | {"range": [1.0, 3.0]}}), form("s", {"p": p | {"source": None}}), form("k", {"q": p}), form("n", None), form("near", {"p": p | {"range": [1.0, 2.001]}}), form("none", None)]
    a += [element("x", type="reference", data={"target": "t", "reference_parameters": ["k"]}), element("y", data={"rule": "r", "source_pdf_page": 1})]
    b += [element("x", type="reference", data={"target": "t", "reference_parameters": ["l"]}), element("y", data={"rule": "r", "source_pdf_page": None})]
    m = X.match_runs(elements(spark, *a), elements(spark, *b))
    got = pairs(X.diff_fields(m).select("id_a", "field", "severity"))
    assert got == sorted([*((i, "data.parameters", "authoritative") for i in "urskn"), ("x", "data.reference_parameters", "helper"), ("y", "data.source_pdf_page", "helper")])
    one = X.compare_summary(X.pair_status(m)).first()
    assert (one.agreed, one.helper_only, one.authoritative) == (2, 2, 5)
    assert X.review_queue(m).count() == 7


def test_calibration_takes_the_whole_payload(spark, tmp_path):
    from strataq.plans import registry
    pay = {
        "t": {"columns": [{"name": "c", "unit": None}], "rows": [{"c": "1"}]}, "u": {"rule": "r", "then_text": "do"}, "v": {"expression": "e", "parameters": {"p": {"unit": "m", "range": [1.0, 2.0], "source": "s"}}},
        "w": {"figure_type": "map", "description": "d", "source_pdf_page": 7}, "x": {"target": "q", "url": "l", "reference_parameters": ["k"]}, "y": {"rule": "r", "exceptions": ["a"]}, "z": {}, "n": {},
    }
    other = pay | {
        "t": {"columns": [{"name": "c", "unit": None}], "rows": [{"c": "2"}]}, "u": {"rule": "r", "then_text": "not"}, "v": {"expression": "e", "parameters": {"p": {"unit": "m", "range": [1.0, 3.0], "source": "s"}}},
        "w": {"figure_type": "map", "description": "o", "source_pdf_page": 8}, "x": {"target": "q", "url": "l", "reference_parameters": []}, "n": {"rule": "r"},
    }
    for name, data in (("elements", pay), ("elements_b", other)):
        elements(spark, *(element(i, data=d, metadata={"qc_status": "passed"}) for i, d in data.items())).write.parquet(f"{tmp_path}/{name}.parquet")
    got = {r.element_id: r.data_match for r in registry.queries()["calibration_scores"](spark, str(tmp_path)).collect()}
    assert got == {"t": 0.5, "u": 0.5, "v": 0.5, "w": 0.3333, "x": 0.6667, "y": 1.0, "z": 1.0, "n": 0.0}


def test_decisions(spark):
    base, alt = elements(spark, element("x", title="base")), elements(spark, element("x", title="alt"), element("y", title="other"))
    rows = [(1, " x", None, None, "title", "b", None), (2, "x", None, None, "title", "a", None), (3, "y", "y", None, "description", "manual", "m"), (4, "no", None, None, "title", "a", None), (5, None, None, None, "title", "a", None)]
    dec = spark.createDataFrame(rows, "decision_id bigint, element_id string, id_a string, id_b string, field_path string, choice string, picked_value string").withColumn("decided_at", F.timestamp_seconds("decision_id"))
    applied = X.apply_decisions(base, alt, dec, ["title", "description"])
    assert pairs(applied) == [("x", "title", "alt", "a"), ("y", "description", "m", "manual")]
    out = {r.id: r for r in X.merged(base, alt, applied, ["title", "description"]).collect()}
    assert out["x"].title == "alt" and out["y"].description == "m" and out["y"].metadata.qc_status == "passed"


def test_symbols(spark):
    got = one(spark, registry.symbol_definitions(F.col("t")), t="V = wind speed, mph K_z = exposure factor the = no")
    assert [(s.symbol, s.description, s.unit) for s in got] == [("V", "wind speed", "mph"), ("K_z", "exposure factor", None)]
    assert one(spark, registry.variables(F.col("t")), t="q = 2 K_z V and sin") == ["K_z", "V", "q"]
    df = spark.createDataFrame([("a", "xx", 1), ("a", "xxx", 2), ("a", "yyy", 3)], "symbol string, description string, n int")
    assert registry.keep_longest(df, ["symbol"], "description", ["n"]).first().n == 2
    near = spark.createDataFrame([("d", 0, "e0", "text_block", None, "V = the speed"), ("d", 1, "e1", "formula", "2 V", "2 V"), ("d", 9, "e2", "text_block", None, "V = later one")], "doc string, seq int, id string, type string, expression string, text string")
    assert pairs(registry.nearby_definitions(near, ["doc"], ["seq"])) == [("e1", "V", "the speed")]


def test_cells(spark):
    cells = [("t", 0, 0, "Name"), ("t", 0, 1, ""), ("t", 0, 2, "Name"), ("t", 1, 0, "a"), ("t", 1, 2, "c"), ("t", 1, 0, "a")]
    df = spark.createDataFrame(cells, "id string, row int, col int, text string")
    assert tables.cells_to_rows(df, ["id"]).first().cells == {"col_1": "", "Name": "c"}


def test_places(spark):
    left = spark.createDataFrame([(1, "i", 100.0), (1, "j", 500.0)], "page int, item string, y double")
    right = spark.createDataFrame([(1, 1, 95.0), (1, 2, 105.0), (1, 3, 510.0)], "page int, span int, y double")
    got = G.nearest(left, right, ["page"], "y", "item", ["span"], 10.0, ["span"])
    assert {r.item: r.span for r in got.collect()} == {"i": 1, "j": None}
    box = lambda n, l, k="a": (1, n, k, float(l), 0.0, l + 10.0, 10.0)  # noqa: E731, E741
    cols = "page int, n int, kind string, l double, t double, r double, b double"
    g, p = spark.createDataFrame([box(1, 0), box(2, 2), box(3, 100)], cols), spark.createDataFrame([box(1, 1), box(2, 4, "b")], cols)
    m = G.greedy_matches(g, p, "page").first()
    assert (m.n_gold, m.n_predicted, m.n_matched, m.n_type) == (3, 2, 2, 1)
    assert G.match_scores(G.greedy_matches(g, p, "page")).first().recall == pytest.approx(2 / 3)


def test_greedy_against_brute_force(spark):
    import random

    rnd = random.Random(5)
    rows = [(pg, side, n, "k", l := rnd.randrange(100), t := rnd.randrange(100), l + 30, t + 30) for pg in range(12) for side in (0, 1) for n in range(8)]
    df = spark.createDataFrame(rows, "page int, side int, n int, kind string, l int, t int, r int, b int")
    got = {r.page: r.n_matched for r in G.greedy_matches(df.filter("side = 0"), df.filter("side = 1"), "page").collect()}
    for pg in range(12):
        free = {r[2]: r for r in rows if r[0] == pg and r[1] == 1}
        n = 0
        for g in sorted((r for r in rows if r[0] == pg and r[1] == 0), key=lambda r: r[2]):
            def v(p):
                w, h = min(g[6], p[6]) - max(g[4], p[4]), min(g[7], p[7]) - max(g[5], p[5])
                return max(w, 0) * max(h, 0) / (1800 - max(w, 0) * max(h, 0)) if w > 0 and h > 0 else 0
            best = max(free.values(), key=lambda p: (v(p), -p[2]), default=None)
            if best and v(best) >= 0.3:
                del free[best[2]]
                n += 1
        assert got[pg] == n


def test_fidelity_and_structure(spark):
    e = spark.createDataFrame([("a", 1, "x" * 30), ("b", 1, "y y y y y y y y y y y y"), ("c", 1, "z" * 25), ("d", 1, "s")], "id string, page int, text string")
    pages = spark.createDataFrame([(1, "w " + "x" * 30 + " yyyyyyyyyyyy ")], "page int, page_text string")
    assert pairs(quality.fidelity(e, pages, ["page"]).select("id", "match")) == [("a", "exact"), ("b", "spacing"), ("c", "none")]


@pytest.fixture
def benchmarked(spark, tmp_path):
    """GOOD has its texts on their page, of which one is no rule; BAD has none of them there."""
    text = "as given in Section 1.1 and in no other place of this text"
    def rows(std, page, rule):
        return [element(f"{std}-1", data={"rule": rule}, source={"standard": std, "page": page}), element(f"{std}-2", type="definition", data={"term": "t", "definition": text}, source={"standard": std, "page": 1})]
    elements(spark, *rows("GOOD", 1, text), *rows("BAD", 1, text)).write.parquet(f"{tmp_path}/elements.parquet")
    elements(spark, *rows("GOOD", 1, text), *rows("BAD", 1, "another text that stands on the page")).write.parquet(f"{tmp_path}/elements_b.parquet")
    return str(tmp_path)


def test_composite_takes_fidelity(spark, benchmarked):
    from strataq.plans import registry as queries
    assert pairs(queries.queries()["composite"](spark, benchmarked)) == [("BAD", 0.6), ("GOOD", 1.0)]


def test_gate_takes_the_three_scores(spark, benchmarked):
    from strataq.plans import registry as queries
    rows = queries.queries()["deploy_gate"](spark, benchmarked).collect()
    got = {(r.doc, r.check): r.passed for r in rows}
    assert len(rows) == len(got) == 28
    assert not got["BAD", "all"] and got["GOOD", "all"] == all(v for (d, c), v in got.items() if d == "GOOD" and c != "all")
    assert [got["GOOD", c] for c in ("composite", "coverage", "fidelity")] == [True, True, True]
    assert [got["BAD", c] for c in ("composite", "coverage", "fidelity")] == [False, True, False]


def test_json_round_trip(spark, tmp_path):
    from strataq.sources import elements as IO

    el = {"id": "S-1-1.1-P1", "type": "provision", "source": {"standard": "S", "chapter": 1, "section": "1.1"}, "title": "t", "data": {"rule": "r", "conditions": [{"parameter": "h", "operator": ">", "value": 60, "unit": "ft"}, {"parameter": "c", "operator": "in", "value": "x"}], "then": None}, "metadata": {"extracted_by": "auto", "qc_status": "pending"}, "own": 1}
    ref = el | {"id": "S-1-1.1-R1", "type": "reference", "data": {"target": "q", "parameters": ["p"]}}
    form = el | {"id": "S-1-1.1-E1", "type": "formula", "data": {"expression": "a", "parameters": {"a": {"unit": "m", "range": [0, 1]}}}}
    (tmp_path / "ch3.json").write_text(json.dumps([el, ref, form]))
    (tmp_path / "ch10.json").write_text("{broken")
    (tmp_path / "ch11.json").write_text(json.dumps(el | {"id": "bad id"}))
    rows = {r.id: r for r in IO.read_elements(spark, str(tmp_path)).collect()}
    p = rows["S-1-1.1-P1"]
    assert [(c.value_num, c.value_str) for c in p.data.conditions] == [(60.0, None), (None, "x")]
    assert "then" in p.data_keys and "else" not in p.data_keys and p.chapter_of_file == 3 and p.seq == 0
    assert rows["S-1-1.1-R1"].data.reference_parameters == ["p"] and rows["S-1-1.1-E1"].data.parameters["a"].range == [0.0, 1.0]
    assert IO.unreadable(spark, str(tmp_path)).count() == 1
    assert [r.id for r in IO.read_gold(spark, str(tmp_path)).collect()] == ["S-1-1.1-P1", "S-1-1.1-R1", "S-1-1.1-E1"]
    df = elements(spark, element("a", data={"rule": "r"}))
    IO.write_elements(df, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
    assert IO.changed_rows(df, df).count() == 0 and IO.changed_rows(df, df.withColumn("title", F.lit("n"))).count() == 1
    assert IO.markdown(df).first().line == "r"
    assert "<td>1</td>" in IO.checkpoint_page(spark.createDataFrame([("d", 1)], "doc string, chapter int"))


def test_json_lines_are_read_line_by_line(spark, tmp_path, monkeypatch):
    from strataq import session
    from strataq.plans import registry as queries
    from strataq.sources import elements as IO

    rows = [element("a", data={"rule": "r\nof two lines", "conditions": []}), element("b", title=None), element("c", source={"section": None})]
    elements(spark, *rows).write.parquet(f"{tmp_path}/elements.parquet")
    IO.write_elements_json(elements(spark, *rows), f"{tmp_path}/out", compression="gzip")
    (tmp_path / "out" / "more.txt").write_text('{"id": "d"}\n\n{broken\r\n[{"id": "e"}, {"id": "f"}]\n  \n')
    kept = lambda **k: sorted(map(str, IO.read_elements(spark, f"{tmp_path}/out", **k).drop("raw").collect()))
    assert kept(lines=True) == kept() and len(kept()) == 6
    monkeypatch.setattr(IO, "_whole", None)
    got = queries.queries()["json_round_trip"](spark, str(tmp_path))
    assert pairs(got.select("id", "title", "section", "rule", "n_conditions")) == pairs(elements(spark, *rows).select("id", "title", "source.section", "data.rule", F.when(F.col("data.conditions").isNotNull(), F.size("data.conditions"))))
    assert all(f.endswith(".gz") for f in spark.read.text(session._written[-1]).inputFiles())


def test_folders_get_one_file(spark, tmp_path):
    from strataq.plans import registry as queries
    from strataq.sources import elements as IO

    place = [(s, c) for s in ("7", "10", "a/b", "", None) for c in (1, 3, None)]
    rows = [element(f"{n}-{i}", source={"standard": s, "chapter": c}) for n in range(40) for i, (s, c) in enumerate(place)]
    df = elements(spark, *rows).repartition(20)
    df.write.parquet(f"{tmp_path}/elements.parquet")
    IO.write_elements(df, f"{tmp_path}/out")
    folders = [f for f in (tmp_path / "out").rglob("chapter=*") if f.is_dir()]
    files = list((tmp_path / "out").rglob("*.parquet"))
    assert len(folders) == 12 and len(files) <= len(folders) + int(spark.conf.get("spark.sql.shuffle.partitions"))
    back = spark.read.schema(df.schema).parquet(f"{tmp_path}/out")
    assert pairs(back.select("id", "source.standard", "source.chapter")) == pairs(df.select("id", "source.standard", "source.chapter"))
    got = queries.queries()["partitioned_write"](spark, str(tmp_path))
    assert pairs(got) == pairs(spark.createDataFrame([("7", 3, 40), ("10", 3, 40), ("a/b", 3, 40), ("", 3, 40)], "standard string, chapter int, n bigint"))
    assert IO.read_chapter(spark, f"{tmp_path}/out", 9, df.schema).count() == 0


def test_layout_rows(spark, tmp_path):
    from strataq.sources import layout as L

    (tmp_path / "a.txt").write_text("one\ntwo")
    got = L.parse_files(spark, str(tmp_path), lambda p, c: [{"line": x} for x in c.decode().split("\n")], "line string")
    assert pairs(got) == [("one",), ("two",)]
    spans = spark.createDataFrame([(1, 0, "26.1 ", True), (1, 1, "Scope", True), (1, 2, " body", False), (1, 3, "!", True)], "line int, n int, text string, bold boolean")
    r = L.line_spans(spans, ["line"], ["n"]).first()
    assert (r.text, r.bold_prefix, r.all_bold) == ("26.1 Scope body!", "26.1 Scope", False)


def test_stream_keeps_a_registry(spark, tmp_path):
    from strataq import streaming as St

    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("a", "x", 1), ("a", "xyz", 2)], "symbol string, description string, n int").write.parquet(src)
    run = lambda: St.maintain(St.element_stream(spark, src), out, str(tmp_path / "cp"), St.longest_by(["symbol"], "description", ["n"])).awaitTermination()
    run()
    spark.createDataFrame([("a", "zz", 3), ("b", "q", 4)], "symbol string, description string, n int").write.mode("append").parquet(src)
    run()
    assert pairs(spark.read.parquet(out + "/v=1").select("symbol", "description")) == [("a", "xyz"), ("b", "q")]


def test_row_emitters_on_edge_cases(spark):
    from strataq.operators import emit as E

    rows = [("d", 1, 1, "a", 1, "Figure 1.2-3A Load on a  roof"), ("d", 1, 2, "b", 1, None), ("d", 1, 3, "c", 2, ""), ("d", 1, 4, "e", 2, "see Figure 1.2-3A and Table 1.1-2 here"), ("d", 1, 5, "f", 2, "Table 1.1-2. Twice")]
    b = spark.createDataFrame(rows, "doc string, chapter int, seq int, id string, page int, text string")
    scope, order = ["doc", "chapter"], ["seq", "id"]
    assert pairs(E.labels(b, "table", scope, order).select("num", "id")) == [("1.1-2", "e")]
    got = E.figure_rows(b.filter("id = 'a'"), b.filter("id = 'e'"), b, scope, "page", order)
    assert pairs(got.select("num", "section", "citation", "page")) == [("1.2-3A", "1.2", "Figure 1.2-3A", 1)]
    held = spark.createDataFrame([("d", 1, "figure", "Figure 1.2-3A"), ("d", 1, "table", None)], "doc string, chapter int, type string, citation string")
    assert pairs(E.missing_labels(b, held, scope, order).select("kind", "num", "section", "id")) == [("table", "1.1-2", "1.1", "e")]
    assert E.missing_labels(b.limit(0), held, scope, order).count() == 0
    tables = b.filter("id in ('f', 'b')").select("doc", "chapter", "page", "id")
    assert pairs(E.table_rows(tables, b, ["doc", "chapter", "page"], order).select("id", "title", "citation", "section")) == [("b", "Table", "", "1"), ("f", "see Figure 1.2-3A and Table 1.1-2 here", "Table 1.1-2", "1.1")]
    known = spark.createDataFrame([("d", "ASTM 7, Guide to a thing, old")], "doc string, target string")
    refs = spark.createDataFrame([("d", 1, "ASTM 7, Guide to a thing, new"), ("d", 2, "ASTM 9, x"), ("d", 3, "ASTM 9, x"), ("d", 4, "ASTMX"), ("e", 5, "ASTM 7, Guide to a thing")], "doc string, seq int, text string")
    assert pairs(E.reference_rows(refs, known, ["doc"], ["seq"], ("ASTM",))) == [("d", 2, "ASTM 9", "ASTM 9, x"), ("e", 5, "ASTM 7", "ASTM 7, Guide to a thing")]
    heads = spark.createDataFrame([("h", "1.1 Scope These rules apply", "1.1 Scope"), ("i", "1.2 End x", "1.2 End"), ("j", None, None)], "id string, text string, bold string")
    assert pairs(E.heading_rows(heads).select("id", "part", "type", F.coalesce("rule", F.lit("-")))) == [("h", 0, "heading", "1.1 Scope"), ("h", 1, "text_block", "These rules apply"), ("i", 0, "heading", "1.2 End x"), ("j", 0, "heading", "-")]
    pages = spark.createDataFrame([("d", 1, 1, "As w = 3\nq = 5 t (1.2-1) and determined using it shall be (1.2-2)\n(2.1-1) x"), ("d", 1, 2, "again q (1.2-1)")], "doc string, chapter int, page int, page_text string")
    none = spark.createDataFrame([], "doc string, chapter int, num string")
    assert pairs(E.page_equations(pages, none, scope, "page").select("num", "page", "expression")) == [("1.2-1", 1, "q = 5 t (1.2-1)"), ("1.2-2", 1, "q = 5 t (1.2-1) and determined using it shall be (1.2-2)")]
    assert E.page_offset(b, b.selectExpr("page + 2 as index")).first().offset == -2 and E.page_offset(b.limit(0), b.selectExpr("page as index")).first().offset == 0
    assert pairs(E.kept_chapters(spark.createDataFrame([(1, "A RESERVED"), (2, None), (3, "B")], "chapter int, title string"), [1, 2])) == [(2, None)]


def test_symbols_between_equals_signs(spark):
    from strataq.operators.registry import symbol_definitions, variables

    said = {
        "K_z = velocity factor, ft": [("K_z", "velocity factor", "ft")], "a = first thing b = second thing.": [("a", "first thing", None), ("b", "second thing", None)],
        "where the load q z = some load, m/s (mi/h)": [], "and = x y z": [], "x = ab": [], "no sign": [], "": [], "= lost": [], "G_f = a = b = gust factor": [("b", "gust factor", None)],
    }
    df = spark.createDataFrame([(k,) for k in said], "t string").select("t", symbol_definitions(F.col("t")).alias("s"))
    assert {r.t: [tuple(x) for x in r.s] for r in df.collect()} == said
    v = spark.createDataFrame([("α K2_z + min(q, Lα) sin 2B",)], "e string").select(variables(F.col("e"))).first()[0]
    assert v == ["B", "K", "K2_z", "L", "q", "z", "α"]


def test_numbers_against_gold_and_against_runs(spark):
    from strataq.operators.compare import near, near_gold

    rows = [(0.0, 0.0005), (0.0005, 0.0), (100.0, 100.1), (100.1, 100.0), (None, None), (None, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double").select(near(F.col("a"), F.col("b")), near_gold(F.col("a"), F.col("b")))
    assert [tuple(r) for r in df.collect()] == [(True, True), (False, False), (True, True), (True, True), (True, True), (False, False)]


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from strataq import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"
        _jsc = spark.sparkContext._jsc

    class Session:
        conf, sparkContext = Conf(), Context()

    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        with pytest.raises(ValueError):
            session.scratch_dir(Session())


def test_numbers_inside_a_citation(spark):
    from strataq.operators.link import numbers_inside

    got = spark.createDataFrame([("Figure 26.5-12A",), (None,), ("none",)], "c string").select(numbers_inside(F.col("c")).alias("n")).collect()
    assert sorted(got[0].n) == ["26.5-1", "26.5-12", "6.5-1", "6.5-12"] and got[1].n is None and got[2].n == []


def test_reports_of_the_command_line(spark, tmp_path):
    from strataq.__main__ import batch_report, validation_report
    from strataq.sources.elements import write_report

    df = elements(spark, element("S-1-1.1-P1", data={"rule": "r", "conditions": []}, cross_references=["S-1-1.1-P1", "S-1-9.9-P1", "S-1-9-P2"]), element("bad"))
    report = validation_report(df, df.limit(1))
    assert report["schema"] == {"total": 2, "passed": 1} and report["cross_references"] == {"total": 3, "resolved": 1} and report["calibration"]["n_compared"] == 1
    batch = batch_report(df)
    assert batch["summary"] == {"chapters_processed": 1, "total_elements": 2, "passed": 0, "failed": 1}
    write_report(batch, str(tmp_path / "r.json"))
    assert json.loads((tmp_path / "r.json").read_text())["summary"]["failed"] == 1
