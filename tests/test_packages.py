import importlib
import sys

import pytest
from pyspark.sql import functions as F

from lamina.operators import references as rf
from lamina.operators import symbols as sy
from lamina.schemas import SCHEMAS
from lamina.sources import cache, package


def tables(spark):
    seg = spark.createDataFrame([("d_seg_0001", "d", 0, "sentence", 0, 7, "Ann met\nBob's 'x'.", "h")], SCHEMAS["Segment"])
    ent = spark.createDataFrame([("d_ent_0001", "d", "Ann", "person", ["A"], [("d_seg_0001", 0, 3, "q")], ["d_seg_0001"]), ("d_ent_0002", "d", "鲍", "person", [], [], [])], SCHEMAS["Entity"])
    clm = spark.createDataFrame([("d_clm_0001", "d", "d_ent_0001", "met", "d_ent_0002", "asserted", "positive", 0.5, None, [], [], ["d_seg_0001"])], SCHEMAS["Claim"])
    return {"Segment": seg, "Entity": ent, "Claim": clm}


def emitted(spark):
    t = tables(spark)
    table = sy.assign(t)
    lines = package.rendered(t, table, rf.refs({k: v for k, v in t.items() if k != "Segment"}))
    return package.modules(lines), table


def test_round_trip_and_contract(spark, tmp_path):
    sources, table = emitted(spark)
    homes = {r.symbol: r.module for r in table.collect()}
    texts = {r.module: r.source for r in sources.collect()}
    names = package.write_package(texts, homes, str(tmp_path / "pkg"))
    assert names == sorted(f"{m}.py" for m in package.FILES)
    sys.path.insert(0, str(tmp_path))
    try:
        pkg = importlib.import_module("pkg")
    finally:
        sys.path.pop(0)
    assert set(pkg.__all__) == set(homes) and pkg.ent_ann.name == "Ann"
    claim = next(getattr(pkg, s) for s in homes if s.startswith("claim_"))
    assert claim.subject is pkg.ent_ann and claim.source_segment_ids == [pkg.seg_0001]
    back = package.read_package(spark, str(tmp_path)).where(F.col("package") == "pkg")
    rows = package.parsed(back.where("module in ('text', 'entities', 'claims')")).collect()
    assert [r for r in rows if r.error] == [] and {r.symbol for r in rows} == set(homes)
    checks = {r.check: r.value for r in package.contract(back.where("module in ('text', 'entities', 'claims')")).collect()}
    assert checks == {"defined_twice": 0, "dangling": 0, "grammar_errors": 0, "wrong_symbol": 0, "not_imported": 0, "resolved_rate": 1}
    again = {r.module: r.source for r in emitted(spark)[0].collect()}
    assert again == texts
    assert package.write_package(texts, homes, str(tmp_path / "pkg")) == names
    (tmp_path / "pkg" / "text.py").write_text("mine = 1\n")
    with pytest.raises(FileExistsError):
        package.write_package(texts, homes, str(tmp_path / "pkg"))


def test_a_broken_symbol_is_found(spark):
    sources, _ = emitted(spark)
    broken = sources.withColumn("source", F.regexp_replace("source", "subject=ent_ann", "subject=ent_nobody"))
    checks = {r.check: r.value for r in package.contract(broken).collect()}
    assert checks["dangling"] == 1 and checks["resolved_rate"] < 1


@pytest.mark.parametrize(
    "source,error",
    [
        ("import os", "Import is not allowed"),
        ("x = 1", "not allowed"),
        ("from lamina.ontology import Entity\ne = Entity('a')", "keyword arguments"),
        ("from lamina.ontology import Entity\ne = Entity(id='a', name=zz)", "not defined above"),
        ("from lamina.ontology import Entity\ne = Entity(id='a', name=f())\n", "defined above|not allowed|"),
        ("from lamina.ontology import Entity\ne = Entity(id='a')\ne = Entity(id='b')", "defined twice"),
        ("e = Entity(id='a')", "not imported"),
        ("from lamina.ontology import Entity\ne = Entity(id='a', name=1 + 1)", "BinOp is not allowed"),
        ("def", "line 1"),
    ],
)
def test_grammar(source, error):
    import re

    rows, errors = package.read_module(source)
    assert re.search(error, " ".join(errors)) or rows


def test_older_argument_names():
    rows, _ = package.read_module("from lamina.ontology import Residual\nr = Residual(id='r', segment='s')")
    assert rows[0]["data"] == {"id": "r", "segment_id": "s"}


def test_references_keep_their_path():
    rows, errors = package.read_module("from .entities import ent_a\nfrom lamina.ontology import Event\ne = Event(id='v', participants=[ent_a, 'x'], n=-1)")
    assert not errors and rows[0]["refs"] == {"participants[0]": "ent_a"} and rows[0]["data"]["n"] == -1


def test_numbered_packages(spark):
    df = spark.createDataFrame([("ch02", "text", ""), ("ch10", "text", ""), ("ch3", "claims", ""), ("other", "text", "")], "package string, module string, source string")
    assert sorted(r.number for r in package.numbered_packages(df).collect()) == [2, 10]


# ---------------------------------------------------------------- cache

KEY = dict(doc_id="d", batch_index=0, segment_ids=["a", "b"], segment_hashes=["1", "2"], known_entities={"x": "1", "y": "2"}, model="m", prompt_version="v1", protocol="compact", options={"t": 0, "k": 1})


def test_cache_keys():
    base = cache.cache_key(**KEY)
    assert base == cache.cache_key(**{**KEY, "known_entities": {"y": "2", "x": "1"}, "options": {"k": 1, "t": 0}})
    for change in ({"model": "n"}, {"segment_ids": ["b", "a"]}, {"segment_hashes": ["1", "3"]}, {"known_entities": None}, {"options": {}}, {"prompt_version": "v2"}, {"batch_index": 1}):
        assert cache.cache_key(**{**KEY, **change}) != base
    assert cache.canonical_json({"b": "é", "a": [1, None]}) == '{"a":[1,null],"b":"é"}'


def test_cache_policies(spark):
    want = spark.createDataFrame([("a",), ("b",)], "cache_key string")
    have = spark.createDataFrame([("a",)], "cache_key string")
    act = lambda p: {r.cache_key: r.action for r in cache.plan(want, have, p).collect()}
    assert act("read_write") == {"a": "use", "b": "call_and_store"} and act("off") == {"a": "call", "b": "call"}
    assert act("refresh") == {"a": "call_and_store", "b": "call_and_store"} and act("read_only") == {"a": "use", "b": "fail"}
    with pytest.raises(Exception, match="not in the cache"):
        cache.require_all(cache.plan(want, have, "read_only")).collect()
    with pytest.raises(ValueError):
        cache.plan(want, have, "odd")


# ---------------------------------------------------------------- analyser, links, single files


def test_analyser_counts_who_names_whom(spark):
    sources, _ = emitted(spark)
    rows = {r.symbol: r for r in package.analysed(sources).collect()}
    seg, ann = rows["seg_0001"], rows["ent_ann"]
    assert seg.obj_type == "Segment" and seg.references == seg.cross_module >= 2 and "ent_ann" in seg.referenced_by
    assert ann.cross_module == ann.references == 1 and ann.line > 1
    assert [(r.segment_id, r.symbol) for r in package.segment_symbols(sources).collect()] == [("d_seg_0001", "seg_0001")]
    assert package.not_imported(sources).count() == 0
    broken = sources.withColumn("source", F.regexp_replace("source", r"from \.text import [^\n]*\n", ""))
    assert {r.symbol for r in package.not_imported(broken).collect()} == {"seg_0001"}


def test_links_across_modules_become_ids(spark):
    sources, _ = emitted(spark)
    rows = {r.obj_id: __import__("json").loads(r.data) for r in package.linked(package.parsed(sources)).collect()}
    assert rows["d_clm_0001"]["subject"] == "d_ent_0001" and rows["d_clm_0001"]["source_segment_ids"] == ["d_seg_0001"]
    assert rows["d_ent_0001"]["evidence_refs"][0]["segment_id"] == "d_seg_0001"


def test_a_target_of_another_package_or_defined_later_stays_an_id(spark):
    t = tables(spark)
    t["Claim"] = spark.createDataFrame([("d_clm_0001", "d", "e_ent_0001", "met", "x", "inferred", "positive", 0.5, None, ["d_clm_0002"], [], []), ("d_clm_0002", "d", "d_ent_0001", "met", "x", "inferred", "positive", 0.5, None, ["d_clm_0001"], [], [])], SCHEMAS["Claim"])
    t["Entity"] = t["Entity"].unionByName(spark.createDataFrame([("e_ent_0001", "e", "Zoe", "person", [], [], [])], SCHEMAS["Entity"]))
    lines = package.rendered(t, sy.assign(t), rf.refs(t))
    text = {(r.package, r.module): r.source for r in package.modules(lines).collect()}[("d", "claims")]
    assert "'e_ent_0001'" in text and "derived_from=['d_clm_0002']" in text and "derived_from=[claim_" in text
    checks = {(r.package, r.check): r.value for r in package.contract(package.modules(lines)).collect()}
    assert all(v == (1 if c == "resolved_rate" else 0) for (_, c), v in checks.items())


def test_strict_symbols(spark):
    t = tables(spark)
    with pytest.raises(LookupError, match="has no symbol"):
        sy.references_as_symbols(rf.refs({"Claim": t["Claim"].withColumn("subject", F.lit("gone"))}), sy.assign(t), strict=True)


def test_single_files_and_back(spark):
    t = tables(spark)
    files = package.single_files(t)
    assert {r.module for r in files.collect()} == {"segments", "knowledge"}
    rows = package.read_single_files(files).collect()
    assert [r for r in rows if r.error] == [] and sorted(r.obj_type for r in rows) == ["Claim", "Entity", "Entity", "Segment"]
    assert __import__("json").loads(next(r.data for r in rows if r.obj_type == "Segment"))["text_slice"] == "Ann met\nBob's 'x'."


def test_stored_objects_stand_for_the_answer(spark):
    schema = "cache_key string, doc_id string, batch_index int, created_at string, response struct<raw_text:string,parsed_candidates:string>, loaded_at timestamp"
    import datetime as dt

    rows = [("a", "d", 0, "2025", ("raw", '[{"t": "E"}]'), dt.datetime(2025, 1, 1)), ("b", "d", 1, "2025", ("raw", None), dt.datetime(2025, 1, 1))]
    assert sorted(r.raw_text for r in cache.answers(cache.entries(spark.createDataFrame(rows, schema))).collect()) == ['[{"t": "E"}]', "raw"]
