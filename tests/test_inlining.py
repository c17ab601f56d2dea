import datetime as dt
import json

from hypothesis import given, settings
from hypothesis import strategies as st

from lamina.operators import inlining as n

SCHEMA = "obj_type string, obj_id string, data string, loaded_at timestamp, table_name string"


def objects(spark, rows):
    return spark.createDataFrame([(t, i, d, dt.datetime(2025, 1, day), "x") for t, i, d, day in rows], SCHEMA)


def found(spark, rows):
    _, out = n.inline(objects(spark, rows))
    return sorted(tuple(r) for r in n.evidence(out).collect())


def test_paths_parents_and_strings_that_hold_json(spark):
    inner = json.dumps([{"segment_id": "s2", "quote_hash": "h"}, None, {"segment_id": None, "quote_hash": "h"}])
    data = {"id": "c", "evidence_refs": [None, {"segment_id": "s1", "quote_hash": "h"}], "qualifiers": [{"id": "q", "evidence_refs": inner}, {"role": "x", "evidence_refs": {"segment_id": "s3", "quote_hash": None}}]}
    assert found(spark, [("Claim", "o", json.dumps(data), 1)]) == [
        ("Claim", "o", "$.evidence_refs[1]", "c", "s1"),
        ("Claim", "o", "$.qualifiers[0].evidence_refs[0]", "q", "s2"),
        ("Claim", "o", "$.qualifiers[1].evidence_refs", "c", "s3"),
    ]


def test_a_member_called_evidence_need_not_be_one(spark):
    data = {"evidence": [{"segment_id": "s1"}, {"segment_id": "s2", "quote_hash": None}, {"quote_hash": "h"}], "more": {"evidence": {"segment_id": "s3", "quote_hash": ["x"]}}}
    assert [(r[2], r[4]) for r in found(spark, [("A", "1", json.dumps(data), 1)])] == [("$.evidence[1]", "s2"), ("$.more.evidence", "s3")]


def test_current_row_broken_rows_and_nulls(spark):
    good = json.dumps({"segment_id": "s", "quote_hash": "h"})
    assert found(spark, [("A", "1", good, 1), ("A", "1", good[:-2], 2), ("A", "2", good[:-2], 1), ("A", "2", good, 2), ("A", "2", good, 2), ("A", "3", None, 1), ("A", None, good, 1), ("A", "4", '{"segment_id": NaN, "quote_hash": 1}', 1)]) == [("A", "2", "$", "2", "s")]


def test_empty_table(spark):
    graph, rows = n.inline(objects(spark, []))
    assert rows.count() == 0 and graph.count() == 0 and n.leaves(rows).count() == 0 and n.typed(rows, graph, "$").count() == 0


def tables_of(*values):
    """Element types that are tables, as :func:`classify` decides, without Spark."""
    edges = n.defaultdict(lambda: [0, 0, False])
    for v in values:
        n._edges(v, n.ELEMENTS, edges)
    above = n.defaultdict(set)
    for (parent, child, leaf), _ in edges.items():
        if leaf is None:
            above[child].add(parent)
    return frozenset({c for (_, c, leaf), (_, most, arr) in edges.items() if leaf is None and (arr or most > 1)} | {c for c, p in above.items() if len(p) > 1} | {"$", "evidence"})


def test_classification(spark):
    data = [{"one": {"shared": {"x": 1}}, "many": [{"shared": {"y": 2}}, {}], "rec": {"rec": {"rec": {"z": 1}}}, "once": {"in": {"v": 1}}, "list": [1, [2]]}]
    graph = n.schema_graph(objects(spark, [("A", "1", json.dumps(data[0]), 1)]))
    kinds = {r.kind for r in n.classify(graph, ()).collect()}
    assert kinds == {"many", "shared", "rec", "list", "list[]"} and kinds | {"$", "evidence"} == tables_of(*data)


def test_singletons_are_inlined_and_links_kept():
    value = {"id": "c", "meta": {"tool": {"name": "t"}, "a.b": 1}, "items": [{"id": "i", "n": 1}, {"n": 2}]}
    rows = n.shred_one(n.parse(json.dumps(value))[1], "o", frozenset({"items"}), n.ELEMENTS)
    assert rows[0][9] == {"id": "c", "meta.tool.name": "t", "meta.a\\.b": "1"}
    assert [r[:6] for r in rows[1:]] == [("items", "$.items[0]", "$", "$", "c", "i"), ("items", "$.items[1]", "$", "$", "c", None)]


def test_values_and_arrays_in_arrays_are_rows():
    rows = n.shred_one(n.parse('{"m": [[1, 2], [3, {"k": 4}], 5, null, [], {}]}')[1], "o", frozenset({"m", "m[]"}), n.ELEMENTS)
    got = [(r[0], r[1], r[3], r[6], r[7], r[8], r[9]) for r in rows]
    assert got == [
        ("$", "$", None, 0, "object", None, {}),
        ("m", "$.m[0]", "$", 0, "array", None, {}),
        ("m[]", "$.m[0][0]", "$.m[0]", 0, "integer", "1", {}),
        ("m[]", "$.m[0][1]", "$.m[0]", 1, "integer", "2", {}),
        ("m", "$.m[1]", "$", 1, "array", None, {}),
        ("m[]", "$.m[1][0]", "$.m[1]", 0, "integer", "3", {}),
        ("m[]", "$.m[1][1]", "$.m[1]", 1, "object", None, {"k": "4"}),
        ("m", "$.m[2]", "$", 2, "integer", "5", {}),
        ("m", "$.m[3]", "$", 3, "null", None, {}),
        ("m", "$.m[4]", "$", 4, "array", "[]", {}),
        ("m", "$.m[5]", "$", 5, "object", "{}", {}),
    ]
    assert [(r[1], r[7], r[8]) for r in n.shred_one(n.parse("[1,2.50,true]")[1], "o", frozenset(), n.ELEMENTS)] == [("$", "array", None), ("$[0]", "integer", "1"), ("$[1]", "number", "2.50"), ("$[2]", "boolean", "true")]
    assert n.shred_one("x", "o", frozenset(), n.ELEMENTS)[0][7:9] == ("string", "x")


def test_many_types_are_joined_with_the_same_result(spark):
    rows = [("A", str(i), json.dumps({"u": {f"k{i}": {"v": i, "list": [i, {"w": None}]}}, "evidence_refs": {"segment_id": "s", "quote_hash": "h"}}), 1) for i in range(40)] + [("A", "bad", "{", 1), ("A", "flat", "{}", 1)]
    pick = lambda x: sorted((tuple(r[:11]), sorted(r.columns.items(), key=str)) for r in x.collect())
    few, many = (n.inline(objects(spark, rows), send_at_most=k)[1] for k in (100_000, 3))
    assert pick(few) == pick(many) and len(pick(few)) > 120


def test_typed_tables(spark):
    rows = [("A", "1", '{"id": "a", "n": 1, "x": 1.5, "ok": true, "code": "007", "big": 123456789012345678901, "meta": {"n": 2, "N": 3}, "q": [{"r": 1}, {"r": null}]}', 1), ("A", "2", '{"n": null, "x": 2, "odd": 1}', 1), ("A", "3", '{"odd": "one", "json_path": "mine"}', 1)]
    graph, out = n.inline(objects(spark, rows))
    t = n.typed(out, graph, "$")
    kinds = dict(t.dtypes)
    assert [kinds[c] for c in ("n", "x", "ok", "code", "big", "meta.N", "odd", "id")] == ["bigint", "double", "boolean", "string", "string", "bigint", "string", "string"]
    assert "meta.n_2" in kinds
    assert [(r["code"], r["big"], r["json_path_2"]) for r in t.orderBy("obj_id").collect()] == [("007", "123456789012345678901", None), (None, None, None), (None, None, "mine")]
    q = n.typed(out, graph, "q")
    assert dict(q.dtypes)["r"] == "bigint" and sorted((r.parent_path, r.ordinal, r["r"] or 0) for r in q.collect()) == [("$", 0, 1), ("$", 1, 0)]
    assert {(r.table_name, r["column"]) for r in n.catalog(out).collect()} >= {("$", "meta.n"), ("q", "r")}


def test_very_deep_json():
    depth = 50_000
    text = "[" * depth + '{"segment_id": "s", "quote_hash": "h"}' + "]" * depth
    ok, value = n.parse(text)
    assert ok and n.parse("[" * depth)[0] is False
    deep = '{"a":' * 3000 + "1" + "}" * 3000
    assert [r[9] for r in n.shred_one(n.parse(deep)[1], "o", frozenset(), n.ELEMENTS)][0] == {".".join("a" * 3000): "1"}
    assert len(n._dump(value)) == len(text) - 3
    seen = 0
    for _, r in n._shred(value, "o", frozenset(), n.ELEMENTS):
        seen += r[7] == "array"
    assert seen == depth and r[0] == "evidence" and r[9]["segment_id"] == "s"


json_values = st.recursive(st.none() | st.booleans() | st.integers(-5, 5) | st.text(max_size=5), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.sampled_from(["id", "segment_id", "quote_hash", "a", "b"]), x, max_size=4), max_leaves=12)


@settings(max_examples=150, deadline=None)
@given(json_values)
def test_against_a_plain_recursion(value):
    out = []

    def rec(v, path, near):
        v = n.unfold(v)
        if isinstance(v, dict):
            if "segment_id" in v and "quote_hash" in v and v["segment_id"] is not None:
                out.append((path, near))
            own = v["id"] if isinstance(v.get("id"), str) else near
            for k, x in v.items():
                rec(x, f"{path}.{k}", own)
        elif isinstance(v, list):
            for i, x in enumerate(v):
                rec(x, f"{path}[{i}]", near)

    rec(value, "$", "o")
    rows = n.shred_one(value, "o", tables_of(value), n.ELEMENTS)
    got = [(r[1], r[4]) for r in rows if r[0] == "evidence" and r[9].get("segment_id") is not None]
    assert sorted(got) == sorted(out)


def all_leaves(value):
    out = []

    def rec(v, path):
        v = n.unfold(v)
        if isinstance(v, dict) and v:
            for k, x in v.items():
                rec(x, f"{path}.{k}")
        elif isinstance(v, list) and v:
            for i, x in enumerate(v):
                rec(x, f"{path}[{i}]")
        else:
            out.append((path, n._text(v)))

    rec(value, "$")
    return sorted(out, key=str)


any_json = st.recursive(st.none() | st.booleans() | st.integers(-5, 5) | st.floats(-9, 9) | st.text(max_size=5), lambda x: st.lists(x, max_size=4) | st.dictionaries(st.sampled_from(["id", "a", "b", "a.b", "", "$", "c\\"]), x, max_size=4), max_leaves=16)


@settings(max_examples=300, deadline=None)
@given(any_json, st.booleans())
def test_every_value_is_kept(value, decided):
    value = n.parse(json.dumps(value))[1]
    rows = n.shred_one(value, "o", tables_of(value) if decided else frozenset(), n.ELEMENTS)
    got = []
    for r in rows:
        if r[8] is not None or r[7] == "null":
            got.append((r[1], r[8]))
        got += [(r[1] + "." + n.re.sub(r"\\(.)", r"\1", k), v) for k, v in r[9].items()]
    assert sorted(got, key=str) == all_leaves(value)
    paths = {(r[0], r[1]) for r in rows}
    assert all(r[2] is None or (r[2], r[3]) in paths for r in rows)


def test_leaves_in_spark(spark):
    data = {"m": [[1, 2], [3, 4]], "x": {"a.b": [], "c": {}}, "s": '[{"k": "v"}]'}
    _, rows = n.inline(objects(spark, [("A", "1", json.dumps(data), 1)]))
    assert sorted(((r.json_path, r.value) for r in n.leaves(rows).collect()), key=str) == all_leaves(n.parse(json.dumps(data))[1])


@settings(max_examples=100, deadline=None)
@given(json_values)
def test_the_stack_parser_agrees_with_the_library(value):
    text = json.dumps(value)
    assert n._parse_deep(text) == n.parse(text)[1]
