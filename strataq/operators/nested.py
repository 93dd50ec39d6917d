"""Deeply nested semi-structured records as related flat tables.

One JSON document per row goes in; records, sections, elements and the
elements' children come out, each child row keyed to its parent by the pair
(record key, path).  The nesting depth is not known beforehand: a fold walks the
document level by level inside the row, transforms attach each node's path and
nearest section, ``flatten`` combines the levels and one ``inline`` per target
table emits the rows.  Nothing is shuffled before the rows are told apart.

A node is opened one level only, its members staying JSON text, and only where
its text names a member that an element or a section has.  So a level costs a
reading of what lies open, not a copy of typed subtrees, and the insides of
ordinary elements are never opened by the walk.

Defined results
---------------
* null, blank, truncated or otherwise unreadable payloads and text after the JSON
  value: the record stays in ``records`` with ``readable`` false and gives no
  other row;
* of an object that repeats a key all members are walked through; of an element's
  own members the last counts, of ``data``'s too;
* documents of any depth and with strings of any length are read; those deeper
  than the parser in the JVM goes (``DEEP``) are taken apart by a loop in Python;
* a JSON string that holds JSON (whole payload, or an element's ``data``) counts
  as its content, twice wrapped too; other strings are never walked;
* a lone value where a list is usual is a list of one; null entries give no row
  but keep their position; unknown fields are walked through;
* repeated deliveries of a record give the same rows once;
* input columns other than the key and the payload are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataq.session import durable, spread

#: Kinds of child objects.
KINDS = ("column", "cell", "condition", "exception", "then", "parameter")
#: Levels walked at a time: the state of a fold is copied at every step, so few steps go first.
STEPS = (8, 64)
#: Levels beyond which the parser in the JVM gives up.
DEEP = 1000

_OPTIONS = "map('allowSingleQuotes', 'false', 'allowNonNumericNumbers', 'false', 'maxStringLen', '2147483647', 'maxNestingDepth', '2147483647')"
_BRACKETS = "(2 * length(p) - length(replace(p, '[', '')) - length(replace(p, '{', '')))"
_NODE = "struct<kind:string,path:string,section_path:string,id:string,data:string,type:string,title:string,parent_id:string,section:string>"
_OPEN = "array<struct<path:string,section_path:string,here:string,obj:array<struct<key:string,value:string>>,arr:array<string>,texts:array<boolean>>>"
_ITEMS = "array<struct<item_kind:string,item_no:int,item_name:string,item:variant>>"
_DATA = "columns variant, rows variant, conditions variant, exceptions variant, `then` string, parameters variant"


def _json(text: str, kind: str) -> str:
    return f"from_json({text}, '{kind}', {_OPTIONS})"


def _boxed(text: str) -> str:
    """SQL: the JSON value and a nought after it; two entries only if the text is one JSON value.

    So text after the value is an error or a third entry; the parser alone passes over it.
    """
    return _json(f"concat('[', {text}, ',0]')", "array<string>")


def _unwrapped(text: str) -> str:
    """SQL: what a text that is one JSON string says, any other text as it is."""
    return f"if(ltrim({text}) like '\"%', coalesce(try_element_at({_boxed(text)}, 1), {text}), {text})"


def _may_hold(text: str) -> str:
    """SQL: whether an element or section can stand in this JSON text."""
    section = f"contains({text}, '\"section\"') and (contains({text}, '\"elements\"') or contains({text}, '\"sections\"'))"
    return f"left({text}, 1) in ('{{', '[') and (contains({text}, '\"data\"') or ({section}))"


def _member(name: str) -> str:
    """SQL: the last member of the open node ``f`` with this name."""
    return f"try_element_at(filter(f.obj, e -> e.key = '{name}'), -1).value"


def _has(name: str, node: str = "f") -> str:
    return f"exists({node}.obj, e -> e.key = '{name}')"


def walk(records: DataFrame, key: str = "record_id", payload: str = "payload") -> DataFrame:
    """(key, readable, nodes): every section and element of each document.

    A document deeper than ``DEEP`` has a second row, with its nodes.
    """
    base = spread(records.select(F.col(key).alias("k"), F.col(payload).cast("string").alias("p")))
    for _ in range(2):  # a generator, so that what follows doesn't work it out anew
        base = base.select("k", F.explode_outer(F.array(F.expr(_unwrapped("p")))).alias("p"))
    # Told by a streaming count first, which writes nothing.
    deep = F.expr(f"{_BRACKETS} >= {DEEP} and json_array_length(concat('[', p, ']')) is null and {_boxed('p')} is null")
    deep = F.coalesce(deep, F.lit(False))
    kind = records.schema[key].dataType.simpleString()
    far = base.filter(deep).mapInArrow(_far, f"k {kind}, readable boolean, nodes array<{_NODE}>")
    # The deep ones give no node here, so they needn't be told apart twice.
    return _near(base).unionByName(far).withColumnRenamed("k", key)


def readable(records: DataFrame, payload: str = "payload", to: str = "readable") -> DataFrame:
    """Adds whether the payload is one JSON value (within the depth of the parser in the JVM)."""
    return records.withColumn(to, F.coalesce(F.expr(f"size({_boxed(f'cast({payload} as string)')}) = 2"), F.lit(False)))


def _near(base: DataFrame) -> DataFrame:
    base = base.withColumn("box", F.expr(_boxed("p"))).withColumn("box", F.expr("if(size(box) = 2, box, null)"))

    def opened(found: str) -> str:
        # Whether a member is a text that looks like JSON is asked only where a text with such members is in sight.
        doubt = "contains(c.text, '\\\\\"data') or contains(c.text, '\\\\\"section')"
        in_object = f"transform(map_values({_json('c.text', 'map<string,variant>')}), v -> schema_of_variant(v) = 'STRING')"
        in_array = f"transform({_json('c.text', 'array<variant>')}, v -> schema_of_variant(v) = 'STRING')"
        cast = f"""transform({found}, c -> named_struct('path', c.path, 'section_path', c.section_path,
            'obj', if(left(c.text, 1) = '{{', map_entries({_json('c.text', 'map<string,string>')}), null),
            'arr', if(left(c.text, 1) = '[', {_json('c.text', 'array<string>')}, null),
            'texts', if({doubt}, if(left(c.text, 1) = '{{', {in_object}, {in_array}), null)))"""
        section = f"{_has('section', 'c')} and ({_has('elements', 'c')} or {_has('sections', 'c')})"
        return f"""transform({cast}, c -> named_struct('path', c.path, 'section_path', c.section_path,
            'here', if(coalesce({section}, false), c.path, c.section_path), 'obj', c.obj, 'arr', c.arr, 'texts', c.texts))"""

    # The data of an element counts as its content even where it is a text.
    below = f"""
        flatten(transform(a.open, f -> if(f.obj is not null,
            filter(transform(f.obj, (e, i) -> named_struct('path', concat(f.path, '.', e.key), 'section_path', f.here,
                'text', if(coalesce(f.texts[i], false) and not (e.key = 'data' and {_has('id')}), null, e.value))), c -> {_may_hold('c.text')}),
            filter(transform(f.arr, (x, i) -> named_struct('path', concat(f.path, '[', i, ']'), 'section_path', f.here,
                'text', if(coalesce(f.texts[i], false), null, x))), c -> {_may_hold('c.text')}))))"""
    element = f"coalesce({_has('id')} and {_has('data')}, false)"
    met = f"""
        transform(filter(a.open, f -> {element} or (f.obj is not null and f.here = f.path)), f -> named_struct(
            'kind', if({element}, 'element', 'section'), 'path', f.path, 'section_path', f.section_path,
            {', '.join(f"'{m}', {_member(m)}" for m in ('id', 'data', 'type', 'title', 'parent_id', 'section'))}))"""
    state = f"struct<open:{_OPEN},done:array<{_NODE}>>"
    top = "filter(array(named_struct('path', '$', 'section_path', cast(null as string), 'text', box[0])), c -> left(c.text, 1) in ('{', '['))"
    start = f"cast(named_struct('open', {opened(top)}, 'done', array()) as {state})"
    step = f"(a, level) -> if(size(a.open) = 0, a, named_struct('open', {opened(below)}, 'done', concat(a.done, {met})))"
    base = base.withColumn("at", F.expr(start))
    # A document is at most as deep as it has opening brackets; beyond its real depth nothing is open.
    for most in (*STEPS, f"1 + {_BRACKETS}"):
        base = base.withColumn("at", F.expr(f"if(size(at.open) = 0, at, aggregate(sequence(1, {most}), at, {step}))"))
    return base.select("k", F.col("box").isNotNull().alias("readable"), F.expr("if(box is null, array(), at.done)").alias("nodes"))


_TOKEN = re.compile(r'\s*(?:([\[\]{},:])|("(?:[^"\\\x00-\x1f]|\\.)*")|(-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|null))')


def parse_deep(text: str):
    """A JSON value of any depth, without recursion; objects as lists of pairs in a tuple."""
    at, held, waiting = 0, [], "value"  # held: (list of members, key or None, is object)
    end = len(text.rstrip())
    done: list = []
    while at < end:
        m = _TOKEN.match(text, at)
        if not m or (done and not held):
            raise ValueError(f"no JSON at {at}")
        at = m.end()
        mark, string, scalar = m.groups()
        if mark in ("{", "[") and waiting in ("value", "value or end"):
            held.append([[], None, mark == "{"])
            waiting = "key or end" if mark == "{" else "value or end"
            continue
        if mark in ("}", "]") and held and held[-1][2] == (mark == "}") and waiting in ("more", "key or end" if mark == "}" else "value or end"):
            members, _, is_object = held.pop()
            value = ("object", members) if is_object else members
        elif mark == "," and waiting == "more":
            waiting = "key" if held[-1][2] else "value"
            continue
        elif mark == ":" and waiting == "colon":
            waiting = "value"
            continue
        elif string is not None and waiting in ("key", "key or end"):
            held[-1][1], waiting = json.loads(string), "colon"
            continue
        elif mark is None and waiting in ("value", "value or end"):
            value = json.loads(string if string is not None else scalar)
        else:
            raise ValueError(f"no JSON at {at}")
        if held:
            held[-1][0].append((held[-1][1], value) if held[-1][2] else value)
            waiting = "more"
        else:
            done.append(value)
    if held or not done:
        raise ValueError("the text ends too early")
    return done[0]


def _is_object(value) -> bool:
    return isinstance(value, tuple)


def _written(value, most: int) -> str:
    """The value as JSON text; what lies deeper than ``most`` levels becomes null."""
    if _is_object(value):
        return "{" + ",".join(f"{json.dumps(k)}:{_written(v, most - 1) if most else 'null'}" for k, v in value[1]) + "}"
    if isinstance(value, list):
        return "[" + ",".join(_written(v, most - 1) if most else "null" for v in value) + "]"
    return json.dumps(value, ensure_ascii=False)


def _as_text(value) -> str | None:
    return value if value is None or isinstance(value, str) else _written(value, 50)


def deep_nodes(text: str) -> list[dict]:
    """The sections and elements of one document, as ``walk`` has them."""
    out, open_ = [], [("$", None, parse_deep(text))]
    for path, section, value in open_:
        below: list = []
        if _is_object(value):
            names = {k for k, _ in value[1]}
            own = dict(value[1])
            is_section = "section" in names and bool(names & {"elements", "sections"})
            is_element = {"id", "data"} <= names
            if is_section or is_element:
                out.append(
                    {"kind": "element" if is_element else "section", "path": path, "section_path": section}
                    | {m: _as_text(own.get(m)) for m in ("id", "data", "type", "title", "parent_id", "section")}
                )
            here = path if is_section else section
            for k, v in value[1]:
                if is_element and k == "data" and isinstance(v, str):
                    try:
                        v = parse_deep(v)
                    except ValueError:
                        continue
                below.append((f"{path}.{k}", here, v))
        elif isinstance(value, list):
            below = [(f"{path}[{i}]", section, v) for i, v in enumerate(value)]
        open_.extend(x for x in below if _is_object(x[2]) or isinstance(x[2], list))
    return out


def _far(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = re.findall(r"(\w+):string", _NODE)
    nodes_type = pa.list_(pa.struct([(n, pa.string()) for n in names]))
    for b in batches:
        nodes = []
        for text in b.column(1).to_pylist():
            try:
                nodes.append(deep_nodes(text))
            except ValueError:
                nodes.append(None)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([n is not None for n in nodes]), pa.array([n or [] for n in nodes], nodes_type)], names=["k", "readable", "nodes"])


def _data() -> Column:
    """The members of the element's data that hold child objects; where data is a text, of the JSON it holds."""
    kind = f"array<struct<{_DATA}>>"
    box = _json(f"concat('[', {_unwrapped('data')}, ',{{}}]')", kind)
    return F.expr(f"if(ltrim(data) like '{{%' or ltrim(data) like '\"%', if(size({box}) = 2, {box}[0], null), null)")


def _children() -> Column:
    """All child objects of one element's data as an array of structs."""

    def array_of(name: str) -> str:
        return f"try_variant_get(d.{name}, '$', 'array<variant>')"

    def object_of(node: str) -> str:
        return f"try_variant_get({node}, '$', 'map<string,variant>')"

    def listed(name: str) -> str:
        none = f"d.{name} is null or is_variant_null(d.{name})"
        return f"if({none}, cast(array() as array<variant>), coalesce({array_of(name)}, array(d.{name})))"

    def entries(name: str, kind: str, label: str) -> str:
        return f"""filter(transform({listed(name)}, (x, i) -> if(x is null or is_variant_null(x), null,
            named_struct('item_kind', '{kind}', 'item_no', i, 'item_name', {label}, 'item', x))), x -> x is not null)"""

    parts = [
        entries("columns", "column", "try_variant_get(x, '$.name', 'string')"),
        f"""flatten(transform({listed('rows')}, (x, i) -> coalesce(transform(map_entries({object_of('x')}), e ->
            named_struct('item_kind', 'cell', 'item_no', i, 'item_name', e.key, 'item', e.value)), array())))""",
        entries("conditions", "condition", "try_variant_get(x, '$.parameter', 'string')"),
        entries("exceptions", "exception", "''"),
        "if(coalesce(d.then, '') <> '', array(named_struct('item_kind', 'then', 'item_no', 0, 'item_name', '', 'item', cast(d.then as variant))), array())",
        f"""coalesce(transform(map_entries({object_of('d.parameters')}), e ->
            named_struct('item_kind', 'parameter', 'item_no', 0, 'item_name', e.key, 'item', e.value)), array())""",
    ]
    return F.expr("concat(" + ", ".join(f"cast({p} as {_ITEMS})" for p in parts) + ")")


def _each(df: DataFrame, listed: str, never_null: str) -> DataFrame:
    """One row an entry.

    Outer, and filtered afterwards: for an inner generator the optimizer adds filters
    that work the list out two times more.
    """
    kept = [c for c in df.columns if c != listed]
    return df.select(*kept, F.expr(f"inline_outer({listed})")).filter(F.col(never_null).isNotNull())


def flatten_records(records: DataFrame, key: str = "record_id", payload: str = "payload") -> dict[str, DataFrame]:
    """The flat tables ``records``, ``sections``, ``elements`` and ``items``.

    ``items`` holds every child object of the elements; its key to the parent is
    (record key, element_path).  ``item`` is the child's JSON text.  All four come
    of one walk, which is written once.
    """
    met = durable(walk(records, key, payload))
    nodes = _each(met.select(key, "nodes"), "nodes", "kind")
    sections = nodes.filter("kind = 'section'").select(
        key, F.col("path").alias("section_path"), F.col("section_path").alias("parent_section_path"), "section"
    )
    element = nodes.filter("kind = 'element'").select(
        key, F.col("path").alias("element_path"), "section_path", F.col("id").alias("element_id"), "type", "title", "parent_id", "data"
    )
    items = element.withColumn("d", _data()).select(key, "element_path", "element_id", _children().alias("items"))
    return {
        "records": met.groupBy(key).agg(F.max("readable").alias("readable")),
        "sections": sections.distinct(),
        "elements": element.distinct(),
        "items": _each(items, "items", "item_kind").withColumn("item", F.expr("to_json(item)")).distinct(),
    }


def element_children(records: DataFrame, key: str = "record_id", payload: str = "payload") -> DataFrame:
    """(key, element_id, item_kind, item_no, item_name), each once."""
    nodes = _each(walk(records, key, payload).select(key, "nodes"), "nodes", "kind").filter("kind = 'element'")
    items = nodes.select(key, F.col("id").alias("element_id"), _data().alias("d")).select(key, "element_id", _children().alias("items"))
    return _each(items, "items", "item_kind").select(key, "element_id", "item_kind", "item_no", "item_name").distinct()
