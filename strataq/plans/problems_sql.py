"""The same results in SQL, over the same tables."""

_CURRENT = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY coalesce(loaded_at, TIMESTAMP '0001-01-01') DESC) AS rn FROM {t} WHERE id IS NOT NULL) WHERE rn = 1)"

_TEXT_FIELDS = {
    "type": "type", "title": "title", "description": "description", "parent_id": "parent_id",
    "source.section": "source.section", "source.citation": "source.citation", "data.rule": "data.rule",
    "data.then_text": "data.then_text", "data.term": "data.term", "data.definition": "data.definition",
    "data.expression": "data.expression", "data.target": "data.target",
}


def _p2() -> str:
    tests = [f"('{k}', trim(x.{v}, ' ') IS DISTINCT FROM trim(y.{v}, ' '))" for k, v in _TEXT_FIELDS.items()]
    tests.append("('source.page', x.source.page IS DISTINCT FROM y.source.page)")
    text = lambda f: f"trim(c[1].{f}, ' ') IS NOT DISTINCT FROM trim(c[2].{f}, ' ')"
    number = "(c[1].value_num IS NOT DISTINCT FROM c[2].value_num OR coalesce(abs(c[1].value_num - c[2].value_num) <= 0.001 * greatest(abs(c[1].value_num), abs(c[2].value_num)), false))"

    def listed(f: str, same: str) -> str:
        a, b = f"x.data.{f}", f"y.data.{f}"
        pairs = f"list_transform(range(1, len({a}) + 1), lambda i: list_value({a}[i], {b}[i]))"
        agree = f"len({a}) = len({b}) AND len(list_filter({pairs}, lambda c: NOT ({same}))) = 0"
        return f"('data.{f}', NOT (({a} IS NULL AND {b} IS NULL) OR ({a} IS NOT NULL AND {b} IS NOT NULL AND coalesce({agree}, false))))"

    tests.append(listed("conditions", " AND ".join([text("parameter"), text("operator"), number, text("value_str"), text("unit")])))
    tests.append(listed("columns", " AND ".join([text("name"), text("unit")])))
    row = (
        "cardinality(c[1]) = cardinality(c[2]) AND len(list_filter(map_keys(c[1]), lambda k: NOT (list_contains(map_keys(c[2]), k)"
        " AND trim(c[1][k], ' ') IS NOT DISTINCT FROM trim(c[2][k], ' ')))) = 0"
    )
    tests.append(listed("rows", row))
    as_set = lambda s: f"list_sort(list_distinct(list_filter(list_transform(coalesce({s}.cross_references, []), lambda r: trim(r, ' ')), lambda r: r IS NOT NULL AND r <> '')))"
    tests.append(f"('cross_references', {as_set('x')} IS DISTINCT FROM {as_set('y')})")
    arms = "\nUNION ALL ".join(f"SELECT x.id AS element_id, {t.split(',', 1)[0][1:]} AS finding FROM x JOIN y ON x.id = y.id WHERE {t.split(',', 1)[1][:-1]}" for t in tests)
    return f"""
WITH x AS {_CURRENT.format(t='elements')}, y AS {_CURRENT.format(t='elements_b')}
SELECT id AS element_id, 'only_a' AS finding FROM x WHERE id NOT IN (SELECT id FROM y)
UNION ALL SELECT id, 'only_b' FROM y WHERE id NOT IN (SELECT id FROM x)
UNION ALL {arms}"""


_P4_WALK = f"""
WITH RECURSIVE x AS {_CURRENT.format(t='elements')},
link AS (SELECT x.id, p.id AS up FROM x LEFT JOIN x p ON x.parent_id = p.id),
walk AS (
    SELECT id, id AS here, up, 0 AS depth, [id] AS met, NULL::VARCHAR AS hit FROM link
    UNION ALL
    SELECT w.id, w.up, l.up, w.depth + 1, list_append(w.met, w.up), CASE WHEN list_contains(w.met, w.up) THEN w.up END
    FROM walk w JOIN link l ON w.up = l.id WHERE w.hit IS NULL
),
ended AS (
    SELECT id, CASE WHEN hit IS NULL THEN here ELSE list_min(met[list_position(met, hit):]) END AS top,
        CASE WHEN hit IS NULL THEN depth ELSE -1 END AS depth, met
    FROM walk WHERE hit IS NOT NULL OR up IS NULL
)"""

_P5 = f"""
WITH x AS {_CURRENT.format(t='elements')},
refs AS (
    SELECT 'elements' AS ref_table, id AS ref_id, trim(unnest(cross_references), ' ') AS target_id, loaded_at AS tm FROM x
    UNION ALL SELECT 'decisions', decision_id::VARCHAR, trim(element_id, ' '), decided_at FROM decisions
),
r AS (SELECT DISTINCT * FROM refs WHERE target_id IS NOT NULL AND target_id <> ''),
ev AS (
    SELECT id AS target_id, loaded_at AS tm, 1 AS up FROM elements WHERE loaded_at IS NOT NULL
    UNION ALL SELECT element_id, withdrawn_at, 0 FROM withdrawals WHERE withdrawn_at IS NOT NULL
),
s AS (
    SELECT r.ref_table, r.ref_id, r.target_id, r.tm,
        arg_max(ev.up, epoch_us(ev.tm) * 2 + ev.up) FILTER (ev.tm <= r.tm) AS up,
        min(ev.tm) FILTER (ev.up = 1) AS first_load
    FROM r LEFT JOIN ev ON r.target_id = ev.target_id GROUP BY ALL
),
found AS (
    SELECT ref_table, ref_id, target_id, tm, strftime(tm, '%Y-%m') AS period,
        CASE WHEN first_load IS NULL THEN 'missing' WHEN tm IS NULL OR first_load > tm THEN 'late' ELSE 'deleted' END AS status
    FROM s WHERE coalesce(up, 0) = 0
)"""

SQL = {
    "p2_found": _p2(),
    "p4_found": _P4_WALK + " SELECT id AS element_id, top AS top_id, depth FROM ended WHERE depth >= 6 OR depth < 0",
    "p4_paths": _P4_WALK + " SELECT id AS element_id, top AS top_id, depth, CASE WHEN depth >= 0 THEN array_to_string(list_reverse(met), ' > ') END AS path FROM ended",
    "p4_descendants": _P4_WALK + " SELECT met[k + 1] AS ancestor_id, id AS descendant_id, k AS distance FROM (SELECT id, met, depth, unnest(range(1, depth + 1))::INT AS k FROM ended WHERE depth > 0)",
    "p5_found": _P5 + " SELECT DISTINCT ref_table, ref_id, target_id, period FROM found",
    "p5_report": _P5 + " SELECT ref_table, period, status, count(*) AS n_refs, count(DISTINCT target_id) AS n_targets FROM found GROUP BY 1, 2, 3",
}

# --- nested records: every object of a document with its path, by the engine's own JSON tree -------

_KEYS = lambda v, k: f"list_contains(json_keys({v}), '{k}')"
_INNER = lambda j: f"CASE WHEN json_type({j}) = 'VARCHAR' THEN CASE WHEN json_valid({j} ->> '$') THEN ({j} ->> '$')::JSON END ELSE {j} END"
_DOCS = f"""d0 AS (SELECT DISTINCT record_id, CASE WHEN json_valid(payload) THEN payload::JSON END AS j FROM raw_records),
d1 AS (SELECT record_id, {_INNER('j')} AS j FROM d0), d2 AS (SELECT record_id, {_INNER('j')} AS j FROM d1 WHERE j IS NOT NULL),
t AS (SELECT DISTINCT d2.record_id, replace(x.fullkey, '"', '') AS path, x.value::JSON AS v FROM d2, json_tree(d2.j) x WHERE d2.j IS NOT NULL AND x.type = 'OBJECT'),
s AS (SELECT record_id, path, v ->> '$.section' AS section FROM t WHERE {_KEYS('v', 'section')} AND ({_KEYS('v', 'elements')} OR {_KEYS('v', 'sections')})),
e AS (SELECT record_id, path, v FROM t WHERE {_KEYS('v', 'id')} AND {_KEYS('v', 'data')})"""
_AROUND = lambda x: f"(SELECT arg_max(s.path, length(s.path)) FROM s WHERE s.record_id = {x}.record_id AND (starts_with({x}.path, s.path || '.') OR starts_with({x}.path, s.path || '[')))"
_LIST = lambda n: f"CASE WHEN json_type(d -> '$.{n}') = 'ARRAY' THEN d -> '$.{n}' WHEN coalesce(json_type(d -> '$.{n}'), 'NULL') <> 'NULL' THEN json_array(d -> '$.{n}') END"
_ENTRY = lambda n, alias: f"""{alias} AS (SELECT record_id, element_id, i::INT AS i, l -> ('$[' || i || ']') AS x FROM (SELECT *, unnest(range(0, json_array_length(l)::BIGINT)) AS i FROM (SELECT record_id, element_id, {_LIST(n)} AS l FROM g)))"""

SQL["p1_found"] = f"""WITH {_DOCS}, g0 AS (SELECT record_id, v ->> '$.id' AS element_id, {_INNER("(v -> '$.data')")} AS d FROM e), g AS (SELECT record_id, element_id, {_INNER('d')} AS d FROM g0),
{_ENTRY('columns', 'co')}, {_ENTRY('rows', 'ro')}, {_ENTRY('conditions', 'cd')}, {_ENTRY('exceptions', 'ex')}
SELECT record_id, element_id, 'column' AS item_kind, i AS item_no, x ->> '$.name' AS item_name FROM co WHERE json_type(x) <> 'NULL'
UNION SELECT record_id, element_id, 'cell', i, unnest(json_keys(x)) FROM ro WHERE json_type(x) = 'OBJECT'
UNION SELECT record_id, element_id, 'condition', i, x ->> '$.parameter' FROM cd WHERE json_type(x) <> 'NULL'
UNION SELECT record_id, element_id, 'exception', i, '' FROM ex WHERE json_type(x) <> 'NULL'
UNION SELECT record_id, element_id, 'then', 0, '' FROM g WHERE json_type(d) = 'OBJECT' AND coalesce(d ->> '$.then', '') <> ''
UNION SELECT record_id, element_id, 'parameter', 0, unnest(json_keys(d -> '$.parameters')) FROM g WHERE json_type(d -> '$.parameters') = 'OBJECT'"""

SQL["p1_sections"] = f"WITH {_DOCS} SELECT record_id, path AS section_path, {_AROUND('s2')} AS parent_section_path, section FROM s s2"

SQL["p1_elements"] = f"""WITH {_DOCS} SELECT record_id, path AS element_path, {_AROUND('e')} AS section_path, v ->> '$.id' AS element_id, v ->> '$.type' AS type, v ->> '$.title' AS title, v ->> '$.parent_id' AS parent_id FROM e"""
