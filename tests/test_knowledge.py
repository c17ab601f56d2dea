import json

import pytest
from pyspark.sql import functions as F

from lamina.operators import candidates as ca
from lamina.operators import coverage as co
from lamina.operators import evidence as ev
from lamina.operators import graph as gr
from lamina.operators import metrics as me
from lamina.operators import references as rf
from lamina.operators import relations as rl
from lamina.operators import repair as rp
from lamina.operators import resolve as rs
from lamina.operators import store as st
from lamina.operators import symbols as sy
from lamina.operators import validate as va
from lamina.schemas import SCHEMAS
from lamina.functions.text import content_hash


def frame(spark, name, rows):
    return spark.createDataFrame(rows, SCHEMAS[name])


def seg(spark, *rows):
    df = spark.createDataFrame([(i, "d", b, t, 0, len(x), x, "") for i, b, t, x in rows], SCHEMAS["Segment"])
    return df.withColumn("hash", content_hash(F.col("text_slice")))


def entity(i, name, aliases=(), segs=("s1",), refs=()):
    return (i, "d", name, "person", list(aliases), list(refs), list(segs))


def claim(i, s, p, o, modality="asserted", polarity="positive", refs=(), segs=("s1",), derived=()):
    return (i, "d", s, p, o, modality, polarity, 1.0, None, list(derived), list(refs), list(segs))


@pytest.fixture(scope="module")
def base(spark):
    segments = seg(spark, ("s1", 0, "sentence", "Ann met Bob."), ("s2", 0, "dialogue", "“Go,” said Bob."), ("s3", 1, "sentence", "Nobody came."))
    ents = frame(spark, "Entity", [entity("d_ent_0001", "Ann"), entity("d_ent_0002", "Bob", ["Bobby"], ["s1", "s2"])])
    events = frame(spark, "Event", [("d_evt_0001", "d", "meeting", "occurrence", ["d_ent_0001", "d_ent_0009"], None, None, [], ["s1"])])
    claims = frame(spark, "Claim", [claim("d_clm_0001", "d_ent_0001", "met", "d_ent_0002"), claim("d_clm_0002", "d_ent_0001", "met", "d_ent_0002", refs=[("s1", 0, 3, "x")]), claim("d_clm_0003", "d_ent_0002", "is", "tired", "reported"), claim("d_clm_0004", "d_ent_0001", "likes", "d_ent_0001", "inferred")])
    rels = frame(spark, "Relation", [("d_rel_clm_0001", "d", "d_ent_0001", "met", "d_ent_0002", "d_clm_0001", []), ("r2", "d", "d_ent_0002", "is", "d_ent_0001", "d_clm_0003", [])])
    return {"Segment": segments, "Entity": ents, "Event": events, "Claim": claims, "Relation": rels}


def objects(base):
    return {k: v for k, v in base.items() if k != "Segment"}


# ---------------------------------------------------------------- candidates


@pytest.mark.parametrize("text,n,recovered", [('[{"t":"E","n":"A"}]', 1, False), ('```json\n[{"t":"E","n":"A"}]\n```', 1, False), ('Here: [{"t":"E","n":"A"}] done', 1, False), ('{"candidates":[{"t":"E","n":"A"},{"t":"C"}]}', 2, False), ('[{"t":"E","n":"A}"},{"t":"C","sid"', 1, True), ("nothing", 0, False), ("", 0, False), (None, 0, False)])
def test_parse(text, n, recovered):
    found, rec = ca.parse(text)
    assert (len(found), rec) == (n, recovered)


def test_verbose_answers_and_scans():
    flat, wrapped = '{"type":"Entity","id":"e","name":"http://x"}', '{"type":"Claim","data":{"id":"c"}}'
    assert ca.verbose_objects(f"```json\n[{flat}, // note\n{wrapped}]\n```") == [("Entity", {"id": "e", "name": "http://x"}), ("Claim", {"id": "c"})]
    assert ca.verbose_objects(f'[{flat},{{"type":"Claim","da') == [("Entity", {"id": "e", "name": "http://x"})] and ca.verbose_objects(None) == [] and ca.verbose_objects("none") == []
    assert ca.scanned_names('x [{"name":"A","kind":"p"},{"name":"A","kind":"q"},{"name":" "},{"name":"B","aliases":["b",1]}]') == [{"name": "A", "kind": "p", "aliases": []}, {"name": "B", "kind": "", "aliases": ["b"]}]


def test_coerce():
    c = ca.coerce({"t": "C", "sid": "s1", "q": ["a", 3], "s": "e1", "p": "met", "o": 5, "m": "odd", "pol": "maybe", "lid": 7})
    assert (c["sids"], c["quotes"], c["object"], c["modality"], c["polarity"], c["lid"]) == (["s1"], ["a"], "5", None, "positive", "7")
    assert c["warnings"] == ["unknown modality", "unknown polarity"]
    assert ca.coerce({"t": "I"})["warnings"] == ["unknown type"] and ca.coerce({"n": "x"}) is None
    assert ca.coerce({"t": "E", "n": " "})["warnings"] == ["missing name"]


def test_expansion(spark):
    text = json.dumps([{"t": "E", "lid": "e1", "n": "Ann", "sid": "s1"}, {"t": "C", "s": "e1", "p": "met", "o": "x", "sid": ["s2"]}, {"t": "EV", "n": "m", "p": ["e1", "zz"], "sid": "s1"}, {"t": "I"}])
    rows = ca.with_ids(ca.candidates(spark.createDataFrame([("d", 0, text), ("d", 1, None)], "doc_id string, batch_index int, raw_text string")))
    done = ca.derive_modality(ca.resolve_locals(rows, ca.local_ids(rows)), seg(spark, ("s2", 0, "dialogue", "x"), ("s1", 0, "sentence", "y")))
    by = {r.id: r for r in done.collect()}
    assert set(by) == {"d_ent_0001", "d_clm_0001", "d_evt_0001"}
    assert by["d_clm_0001"].subject == "d_ent_0001" and by["d_clm_0001"].modality == "reported" and by["d_evt_0001"].participants == ["d_ent_0001", "zz"]


def test_batches(spark):
    assert ca.batch_numbers([3, 3, 9, 1, 1], 5) == [0, 1, 2, 3, 3] and ca.batch_numbers([1, 2], 5) == [0, 0] and ca.batch_numbers([], 5) == []
    rows = ca.batches(seg(spark, ("a", 0, "sentence", "xxx"), ("b", 1, "sentence", "xxx"), ("c", 2, "sentence", "x")), 5).collect()
    assert {r.id: r.batch_index for r in rows} == {"a": 0, "b": 1, "c": 1}


@pytest.mark.parametrize("text,noise", [("ab", True), ("", True), ("why?", True), ("a.", False), ("abc", False), ("is this noise?", False), (None, True)])
def test_noise(spark, text, noise):
    assert spark.createDataFrame([(text,)], "t string").select(ca.is_noise(F.col("t")).alias("n")).collect()[0].n is noise


def test_ids_and_aliases(spark):
    rows = spark.createDataFrame([("d", "d_ent_0007", 1), ("d", None, 2), ("d", None, 3)], "doc_id string, id string, pos int")
    assert [r.id for r in ca.missing_ids(rows, "ent").orderBy("pos").collect()] == ["d_ent_0007", "d_ent_0008", "d_ent_0009"]
    e = frame(spark, "Entity", [entity("d_char_0001", "Ann", ["Bob", "zzz", None], ["s2"])])
    got = ca.ground_aliases(e, seg(spark, ("s1", 0, "sentence", "Bob"), ("s2", 1, "sentence", "Bob")))
    assert [(r.alias, r.segment_id) for r in got.collect()] == [("Bob", "s2")]
    assert ca.fix_prefixes(e).collect()[0].fixed_id == "d_ent_0001"


# ---------------------------------------------------------------- evidence, references, gates


def test_quotes(spark):
    s = seg(spark, ("s1", 0, "sentence", "aXaXa"), ("s2", 0, "sentence", "nothing"))
    q = spark.createDataFrame([("o", 0, "aXa", "s1"), ("o", 1, "Q", "s1"), ("o", 2, "", "s1"), ("o", 3, "aXa", "s2"), ("o", 4, None, "s1")], "obj_id string, quote_no int, quote string, segment_id string")
    assert [(r.quote_no, r.span_start, r.span_end, r.ambiguous) for r in ev.place_quotes(q, s).collect()] == [(0, 0, 3, True)]
    assert sorted(r.quote_no for r in ev.unplaced(q, s).collect()) == [1, 2, 3, 4]


def test_spans(spark):
    s = seg(spark, ("s1", 0, "sentence", "a😀b"))
    good = "sha256:" + __import__("hashlib").sha256("😀".encode()).hexdigest()
    e = frame(spark, "Entity", [entity("e", "x", refs=[("s1", 1, 2, good), ("s1", 1, 2, "bad"), ("s1", 2, 9, good), ("s1", None, 1, good), ("s9", 0, 1, good)])])
    rows = ev.broken_spans(ev.exploded({"Entity": e}), s).collect()
    assert sorted((r.pos, r.problem) for r in rows) == [(1, "hash"), (2, "span"), (3, "span")]


def test_gates(base):
    v = va.validate(objects(base), base["Segment"]).collect()
    found = {(r.gate, r.severity, r.obj_id) for r in v}
    assert ("reference", "ERROR", "d_evt_0001") in found and ("self_reference", "ERROR", "d_clm_0004") in found
    assert ("evidence", "ERROR", "d_clm_0001") in found and ("evidence", "ERROR", "d_clm_0002") in found
    assert ("claim_safety", "ERROR", "d_clm_0003") in found and ("claim_safety", "ERROR", "d_clm_0004") in found
    with pytest.raises(va.ValidationFailed):
        va.stop_on_errors(va.validate(objects(base), base["Segment"]))


def test_schema_and_duplicates(spark):
    c = frame(spark, "Claim", [claim("c", None, "p", None, "odd", None), claim("c", "s", "p", None)])
    assert sorted((r.field, r.message) for r in va.schema({"Claim": c}).collect()) == [("modality", "not allowed"), ("polarity", "missing"), ("subject", "missing")]
    assert va.unique_ids({"Claim": c}).count() == 1


def test_severity_depends_on_what_is_at_hand(spark):
    e = frame(spark, "Event", [("v", "d", "n", "k", ["d_ent_1"], None, None, [], ["s1"])])
    rows = va.references({"Event": e}).collect()
    assert {r.severity for r in rows} == {"WARNING"} and len(rows) == 2


def test_repair(base):
    fixed, used = rp.repair_loop(objects(base), base["Segment"], attempts=2)
    assert used >= 1
    assert fixed["Event"].count() == 0 or fixed["Event"].collect()[0].participants == ["d_ent_0001"]
    assert {r.id for r in fixed["Claim"].collect()}.isdisjoint({"d_clm_0004"})


# ---------------------------------------------------------------- relations, resolution


def test_relations(base):
    rows = rl.derive(base["Claim"], base["Entity"]).collect()
    assert [(r.id, r.claim_id, r.claims, len(r.evidence_refs)) for r in rows] == [("d_rel_clm_0001", "d_clm_0001", 2, 1)]
    reasons = {r.id: r.skip_reason for r in rl.eligibility(base["Claim"], base["Entity"]).collect()}
    assert reasons == {"d_clm_0001": None, "d_clm_0002": None, "d_clm_0003": "modality", "d_clm_0004": "modality"}


def test_greedy_is_not_transitive(spark):
    assert rs.greedy_owners(["a", "b", "c"], [["A"], ["B"], ["A", "B"]]) == ["a", "b", "a"]
    assert rs.greedy_owners(["a", "b", "c"], [["A"], ["A", "Z"], ["Z"]]) == ["a", "a", "a"]
    e = frame(spark, "Entity", [entity("a", "A"), entity("b", "B"), entity("c", "A", ["B", None])])
    greedy = {r.id: r.canonical_id for r in rs.canonical(e).collect()}
    both = {r.id: r.canonical_id for r in rs.canonical(e, mode="components").collect()}
    assert greedy == {"a": "a", "b": "b", "c": "a"} and set(both.values()) == {"a"}
    merged = {r.id: r for r in rs.merge(e, rs.canonical(e)).collect()}
    assert set(merged) == {"a", "b"} and merged["a"].aliases == ["B"]


def test_rewrite(base, spark):
    owners = spark.createDataFrame([("d_ent_0002", "d_ent_0001")], "id string, canonical_id string")
    claims = rs.rewrite(base["Claim"], owners, ("subject", "object_ref"))
    kept, rels = rs.without_self_claims(claims, base["Relation"])
    assert {r.id for r in kept.collect()} == {"d_clm_0003"} and {r.id for r in rels.collect()} == {"r2"}
    ev2 = rs.rewrite_array(base["Event"], spark.createDataFrame([("d_ent_0009", "d_ent_0001")], "id string, canonical_id string"), "participants")
    assert ev2.collect()[0].participants == ["d_ent_0001"]


# ---------------------------------------------------------------- coverage, residuals, metrics, graph


def test_coverage(base, spark):
    res = frame(spark, "Residual", [("r", "d", "s2", "other", "high", "", [])])
    ign = frame(spark, "IgnoreSegment", [])
    s = co.status(base["Segment"], rf.refs(objects(base)), base["Claim"], res, ign)
    by = {r.segment_id: (r.status, r.raw_fallback) for r in s.collect()}
    assert by == {"s1": ("covered", True), "s2": ("partial", True), "s3": ("uncovered", True)}
    rep = co.report(s).collect()[0]
    assert (rep.total_segments, rep.covered, rep.partial, rep.ignored) == (3, 1, 1, 0)
    assert {r.segment_id: r.status for r in co.by_count(base["Segment"], rf.refs(objects(base))).collect()} == {"s1": "covered", "s2": "partial", "s3": "uncovered"}
    docs = spark.createDataFrame([("d", "then")], "id string, created_at string")
    assert co.reports(s, docs).collect()[0].requires_raw_fallback == ["s1", "s2", "s3"]
    sym = spark.createDataFrame([("s1", "seg_1")], "id string, symbol string")
    assert [(r.symbol, r.status) for r in co.by_symbol(s, sym).collect()] == [("seg_1", "covered")]


@pytest.mark.parametrize("text,want", [("他说道：好", ("interpersonal", "high")), ("太太" + "长" * 20, ("interpersonal", "high")), ("只见一座山" + "长" * 20, ("stylistic", "medium")), ("太太", ("structural", "medium")), ("plain", ("structural", "medium"))])
def test_residual_classes(spark, text, want):
    r = spark.createDataFrame([(text,)], "t string").select(rp.classify(F.col("t")).alias("c")).collect()[0].c
    assert (r.category, r.importance) == want


def test_fallback_and_failures(base, spark):
    v = va.validate(objects(base), base["Segment"])
    got = {r.segment_id: r.importance for r in rp.raw_fallback(base["Segment"], rf.refs(objects(base)), v).collect()}
    assert got == {"s1": "high", "s3": "medium"}
    w = spark.createDataFrame([("d", "s1", "Missing name in E"), ("d", "s1", "routine")], "doc_id string, segment_id string, warning string")
    assert [r.id for r in rp.failures_to_residuals(w).collect()] == ["d_res_0001"]
    assert {r.id for r in rp.second_pass(base["Segment"], objects(base)).collect()} == {"s3"}


def test_metrics(base, spark):
    g = {r.id: (r.issues, r.names) for r in me.grounding(base["Entity"], base["Segment"]).collect()}
    assert g == {"d_ent_0001": (0, 1), "d_ent_0002": (1, 2)}
    x = me.entropy(spark.createDataFrame([("a",), ("b",)], "c string"), "c").collect()[0]
    assert (x.groups, x.entropy) == (2, 1.0)
    t = spark.createDataFrame([("A",), ("B",)], "name string")
    f = spark.createDataFrame([("A",), ("C",), ("D",)], "name string")
    r = me.recall_precision(f, t).collect()[0]
    assert (r.tp, r.fp, r.fn, r.recall) == (1, 2, 1, 0.5)
    assert me.gate(0.5, 0, 9) == ["grounding", "conflicts"]


def test_graph(base):
    g = gr.Graph(base["Entity"], base["Event"], base["Claim"], base["Relation"], base["Segment"])
    classes = {r.relation_id: r.edge_class for r in g.edges.collect()}
    assert classes == {None: "navigation", "d_rel_clm_0001": "fact", "r2": "claim_index"}
    assert g.relations("d_ent_0001", facts_only=True).count() == 1 and g.neighbours("d_ent_0001").count() == 3
    ctx = g.answer_context("d_clm_0001").collect()[0]
    assert ctx.label == "d_ent_0001 met d_ent_0002" and [q.quote for q in ctx.quotes] == ["Ann met Bob."]
    assert g.node("nobody").count() == 0
    g.invalidate()


def test_store(base, tmp_path, spark):
    rows = st.rows_of("Entity", base["Entity"])
    old = rows.withColumn("data", F.lit("{}")).withColumn("loaded_at", F.lit("2020-01-01").cast("timestamp"))
    store = st.upsert(old, rows)
    assert store.count() == 2 and {r.name for r in st.load_all(store, "Entity").collect()} == {"Ann", "Bob"}
    assert st.delete(store, st.load(store, "Entity", "d_ent_0001")).count() == 1
    st.save(store, str(tmp_path / "s"))
    assert st.count(st.open_store(spark, str(tmp_path / "s"))).collect()[0].objects == 2
    assert st.query(base["Entity"], name="Ann", nothing=None).count() == 1 and st.query(base["Entity"], nothing="x").count() == 0


# ---------------------------------------------------------------- symbols


@pytest.mark.parametrize("name,want", [("Alice Smith", "alice_smith"), ("brand_7", "brand_7"), ("爱 Alice-B", "alice_b"), ("a-b", "a_b"), ("甲", None), ("___", None), (None, None)])
def test_normalise(spark, name, want):
    assert spark.createDataFrame([(name,)], "n string").select(sy.normalise(F.col("n")).alias("x")).collect()[0].x == want


def test_symbols_are_unique_and_stable(spark):
    e = frame(spark, "Entity", [entity("e1", "Ann"), entity("e2", "ann"), entity("e3", "Ann 1"), entity("e4", "甲")])
    a = {r.id: r.symbol for r in sy.assign({"Entity": e}).collect()}
    b = {r.id: r.symbol for r in sy.assign({"Entity": e.repartition(3)}).collect()}
    assert a == b and len(set(a.values())) == 4 and a["e1"] == "ent_ann" and a["e3"] == "ent_ann_1" and a["e4"].startswith("ent_zh_")
    assert sy.collisions({"Entity": e}).collect()[0].objects == 2
    assert sy.double_ids({"Entity": e, "Event": frame(spark, "Event", [("e1", "d", "n", "k", [], None, None, [], [])])}).count() == 1


def test_saved_are_those_that_no_error_names(spark):
    import datetime as dt

    from lamina.operators import store as st

    seg = frame(spark, "Segment", [("s1", "d", 0, "sentence", 0, 3, "Ann", "sha256:" + __import__("hashlib").sha256(b"Ann").hexdigest())])
    at = dt.datetime(2025, 1, 1)
    rows = lambda *x: spark.createDataFrame([(*r, at) for r in x], "obj_type string, obj_id string, data string, loaded_at timestamp")
    old = rows(("Entity", "e0", '{"id": "e0", "name": "Old", "kind": "person"}'))
    claim = lambda i, subject, more="": f'{{"id": "{i}", "subject": "{subject}", "predicate": "p", "object_ref": "x", "modality": "inferred", "polarity": "positive", "derived_from": ["c1"]{more}}}'
    batch = rows(
        ("Entity", "e1", '{"id": "e1", "name": "Ann", "kind": "person", "source_segment_ids": ["s1"]}'), ("Entity", "e2", '{"id": "e2", "kind": "person"}'), ("Entity", "e3", "{broken"),
        ("Claim", "c1", claim("c1", "e1")), ("Claim", "c2", claim("c2", "e0")), ("Claim", "c3", claim("c3", "gone")), ("Claim", "c4", claim("c4", "e1", ', "confidence": 7')), ("Odd", "o", "{}"), (None, "n", "{}"),
    )
    after, saved, violations = st.save_validated(old, batch, seg)
    assert {r.obj_id for r in saved.collect()} == {"e1", "c1", "c2"} and {r.obj_id for r in after.collect()} == {"e0", "e1", "c1", "c2"}
    gates = {(r.obj_id, r.gate) for r in violations.where("severity = 'ERROR'").collect()}
    assert {("e2", "schema"), ("e3", "grammar"), ("c3", "reference"), ("c4", "schema"), ("o", "grammar")} <= gates
    assert st.save_validated(old, batch.limit(0), seg)[1].count() == 0


def test_residual_gate(spark):
    rows = [("r1", "d", "s", "pragmatic", "high", "x", []), ("r2", "d", "s", "temporal", "low", "x", []), ("r3", "d", "s", None, "high", None, [])]
    got = sorted((r.obj_id, r.field, r.message) for r in va.schema({"Residual": frame(spark, "Residual", rows)}).collect())
    assert got == [("r2", "category", "not allowed"), ("r2", "importance", "not allowed"), ("r3", "category", "missing"), ("r3", "reason", "missing")]


def test_components_of_a_chain_a_star_and_a_pair(spark):
    from lamina.operators.components import components

    edges = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(60)] + [("hub", f"leaf{i}") for i in range(200)] + [("x", "y"), ("y", "x"), ("z", "z")]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "u string, v string")).collect()}
    assert {got[f"c{i:03d}"] for i in range(61)} == {"c000"} and {got[k] for k in got if k.startswith("leaf") or k == "hub"} == {"hub"} and got["x"] == got["y"] == "x" and "z" not in got
    assert components(spark.createDataFrame([], "u string, v string")).count() == 0


def test_dedup_keeps_the_evidence_of_all(spark):
    rows = [("r2", "d", "a", "p", "b", "c", [("s1", 0, 1, "h")]), ("r1", "d", "a", "p", "b", "c", [("s2", 0, 1, "h")]), ("r3", "d", "a", "p", "b", "c", [("s1", 0, 1, "h")]), ("r4", "d", "a", "p", "z", "c", None)]
    got = {r.id: [e.segment_id for e in r.evidence_refs] for r in rl.dedup(frame(spark, "Relation", rows)).collect()}
    assert got == {"r1": ["s2", "s1"], "r4": []}
