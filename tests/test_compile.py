import json
import os

import pytest

from lamina.__main__ import main, parser
from pyspark.sql import functions as F

from lamina.operators import candidates as ca
from lamina.operators import evidence as ev
from lamina.operators import repair as rp
from lamina.operators.candidates import batches, is_noise
from lamina.plans import compile as co
from lamina.plans import extract
from lamina.sources import model, texts

TEXT = "# Report\n\nAnn met Bob. Bob left.\n\nNobody came."


def answers(spark):
    raw = json.dumps(
        [
            {"t": "E", "lid": "e1", "n": "Ann", "k": "person", "sid": ["d_seg_0002"], "q": ["Ann"]},
            {"t": "E", "lid": "e2", "n": "Bob", "k": "person", "sid": ["d_seg_0002", "d_seg_0003"], "q": ["Bob"]},
            {"t": "E", "lid": "e3", "n": "Robert", "a": ["Bob"], "k": "person", "sid": ["d_seg_0003"]},
            {"t": "C", "s": "e1", "p": "met", "o": "e2", "sid": ["d_seg_0002"], "q": "met Bob"},
            {"t": "C", "s": "e1", "p": "met", "o": "e3", "sid": ["d_seg_0002"], "q": "Ann met"},
            {"t": "C", "s": "e9", "p": "is", "o": "lost", "sid": ["d_seg_0002"], "q": "Ann"},
            {"t": "EV", "n": "meeting", "p": ["e1", "e2"], "sid": ["d_seg_0002"], "q": "met"},
        ]
    )
    return spark.createDataFrame([("d", 0, raw)], "doc_id string, batch_index int, raw_text string")


def test_compile_emit_verify(spark, tmp_path):
    t = co.compile_texts(texts.from_memory(spark, {"d": TEXT}), answers(spark))
    assert {r.id for r in t["Entity"].collect()} == {"d_ent_0001", "d_ent_0002"}
    assert {r.id for r in t["Claim"].collect()} == {"d_clm_0001", "d_clm_0002"}
    rel = t["Relation"].collect()
    assert [(r.subject, r.object_ref, len(r.evidence_refs)) for r in rel] == [("d_ent_0001", "d_ent_0002", 2)]
    assert t["Violation"].where("severity = 'ERROR'").count() == 0
    cov = t["Coverage"].collect()[0]
    assert cov.total_segments == 4 and cov.status_counts["covered"] == 2 and cov.status_counts["raw_only"] == 2
    assert [(r.package, r.error) for r in co.emit(t, str(tmp_path)).collect()] == [("d", None)]
    first = {n: (tmp_path / "d" / n).read_text() for n in os.listdir(tmp_path / "d")}
    co.emit(t, str(tmp_path))
    assert first == {n: (tmp_path / "d" / n).read_text() for n in os.listdir(tmp_path / "d")}
    checks = {r.check: r.value for r in co.verify(spark, str(tmp_path)).collect()}
    assert checks == {"defined_twice": 0, "dangling": 0, "grammar_errors": 0, "wrong_symbol": 0, "resolved_rate": 1, "missing_files": 0, "failed_imports": 0, "not_imported": 0}
    (tmp_path / "d" / "text.py").write_text("import os", encoding="utf-8")
    failed = co.emit(t, str(tmp_path)).collect()
    assert "was not generated here" in failed[0].error and (tmp_path / "d" / "text.py").read_text() == "import os"
    with pytest.raises(RuntimeError, match="not generated"):
        co.stop_on_failed(spark.createDataFrame(failed, "package string, files string, error string"))
    assert {r.check: r.value for r in co.verify(spark, str(tmp_path)).collect()}["failed_imports"] == 1
    assert json.loads(co.summary(t))["objects"]["Claim"] == 2


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text(TEXT, encoding="utf-8")
    assert main(["compile-library", str(tmp_path / "in"), "--target", str(tmp_path / "out"), "--text-only"]) == 0
    assert json.loads(capsys.readouterr().out)["objects"] == {"Document": 1, "Block": 3, "Segment": 4}
    assert main(["compile-library", str(tmp_path / "none"), "--text-only"]) == 1
    assert "error" in json.loads(capsys.readouterr().out)
    with pytest.raises(SystemExit):
        parser().parse_args(["compile", "x"])


def test_model_client(spark):
    seg = co.text_only(texts.from_memory(spark, {"d": TEXT}))["Segment"]
    prompts = model.batch_prompts(seg, batches(seg, 10), model.INSTRUCTION)

    def client(prompt):
        if "Report" in prompt:
            return "[]"
        if "Nobody" in prompt:
            raise TimeoutError("late")
        return "[]"

    rows = model.ask(prompts, client, tries=2, pause=0.01).collect()
    assert sorted((r.raw_text or "", r.error or "") for r in rows)[0] == ("", "TimeoutError: late") and len(rows) > 1
    shown = model.Endpoint.resolve(url="u", api_key="abcdefghijkl").masked()
    assert "defgh" not in json.dumps(shown)


def test_aliases_found_nowhere_merge_nothing(spark):
    raw = json.dumps(
        [
            {"t": "E", "lid": "e1", "n": "Ann", "a": ["Zed", "Bob left"], "k": "person", "sid": ["d_seg_0002"], "q": ["Ann"]},
            {"t": "E", "lid": "e2", "n": "Bob", "a": ["Zed", "Nobody", "Bob. Bob"], "k": "person", "sid": ["d_seg_0002", "d_seg_0003"], "q": ["Bob"]},
        ]
    )
    df = spark.createDataFrame([("d", 0, raw)], "doc_id string, batch_index int, raw_text string")
    made = co.expand(df, co.text_only(texts.from_memory(spark, {"d": TEXT}))["Segment"])["Entity"]
    got = {r.id: (r.aliases, r.source_segment_ids) for r in made.collect()}
    assert got == {"d_ent_0001": (["Bob left"], ["d_seg_0002", "d_seg_0003"]), "d_ent_0002": (["Nobody", "Bob. Bob"], ["d_seg_0002", "d_seg_0003", "d_seg_0004"])}
    t = co.compile_texts(texts.from_memory(spark, {"d": TEXT}), df)
    assert {r.id for r in t["Entity"].collect()} == {"d_ent_0001", "d_ent_0002"}


def test_verbose_answers(spark):
    raw = """Here: [
      {"type": "Entity", "data": {"id": "d_char_0001", "name": "Ann", "kind": "person", "aliases": ["Annie", "Bob"], "source_segment_ids": ["d_seg_0002"]}}, // a person
      {"type": "Entity", "name": "Bob", "kind": "person", "source_segment_ids": ["d_seg_0002"]},
      {"type": "Event", "data": {"name": "meeting", "participants": ["d_char_0001", "x"], "source_segment_ids": ["d_seg_0002"]}},
      {"type": "Claim", "data": {"subject": "d_char_0001", "predicate": "met", "object": "Bob", "modality": "asserted", "polarity": "positive", "source_segment_ids": ["d_seg_0002"]}},
      {"type": "Relation", "data": {"id": "r", "subject": "d_char_0001", "predicate": "met", "object": "x", "claim_id": "d_clm_0001"}},
      {"type": "Other", "data": {}}, {"type": "Entity", "na"""
    seg = co.text_only(texts.from_memory(spark, {"d": TEXT}))["Segment"]
    rows = ca.verbose_rows(spark.createDataFrame([("d", 0, raw), ("d", 1, None)], "doc_id string, batch_index int, raw_text string"))
    t = ca.verbose_tables(rows, seg)
    assert [(r.id, r.name, r.aliases) for r in t["Entity"].orderBy("id").collect()] == [("d_ent_0001", "Ann", ["Bob"]), ("d_ent_0002", "Bob", None)]
    assert [(r.id, r.participants) for r in t["Event"].collect()] == [("d_evt_0001", ["d_ent_0001", "x"])]
    assert [(r.id, r.subject, r.object_ref, r.confidence) for r in t["Claim"].collect()] == [("d_clm_0001", "d_ent_0001", "Bob", 1.0)]
    assert [(r.id, r.subject) for r in t["Relation"].collect()] == [("r", "d_ent_0001")]


def test_each_batch_knows_what_the_ones_before_named(spark):
    seg = co.text_only(texts.from_memory(spark, {"d": TEXT, "e": "Zoe sat."}))["Segment"].cache()
    parts = batches(seg, 12)
    assert parts.agg(F.max("batch_index")).collect()[0][0] > 0

    def client(prompt):
        if "First" in prompt or "List the entities" in prompt:
            return '[{"name": "Ann", "kind": "person"}]'
        if "Report" in prompt:
            return "[]"
        if "Nobody" in prompt:
            raise RuntimeError("refused")
        said = "Ann" if "Ann met" in prompt else "Bob" if "Bob left" in prompt else "Zoe"
        assert said != "Bob" or "- d_ent_0001 Ann" in prompt and "Look out for:" in prompt
        return json.dumps([{"t": "E", "lid": "x", "n": said, "k": "person", "sid": [], "q": []}])

    hints = extract.scan(seg, parts, client)
    assert {(r.doc_id, r.name) for r in hints.collect()} == {("d", "Ann")}
    seeds = spark.createDataFrame([("e", "Yan", "seed_1")], "doc_id string, name string, id string")
    answers, names = extract.chapters(seg, parts, client, seeds=seeds, hints=hints, tries=1)
    got = {(r.doc_id, r.name): r.id for r in names.collect()}
    assert got[("d", "Ann")] == "d_ent_0001" and got[("d", "Bob")] == "d_ent_0002"
    assert got[("e", "Yan")] == "seed_1" and ("e", "Zoe") in got
    rows = answers.collect()
    assert len(rows) == parts.join(seg.where(~is_noise(F.col("text_slice"))), ["doc_id", "id"]).select("doc_id", "batch_index").distinct().count()
    assert [r.error for r in rows if r.error] == ["RuntimeError: refused"]
    again, same = extract.chapters(seg, parts, kept=answers.where("raw_text is not null"), seeds=seeds)
    assert {(r.doc_id, r.name): r.id for r in same.collect()} == got and again.where("error = 'not kept'").count() == 1


def test_warnings_become_residuals(spark):
    seg = co.text_only(texts.from_memory(spark, {"d": TEXT}))["Segment"]
    raw = json.dumps([{"t": "E", "lid": "e1", "n": " ", "sid": ["d_seg_0002"], "q": ["Ann"]}, {"t": "E", "lid": "e2", "n": "Bob", "sid": ["none"]}, {"t": "EV", "n": "x", "p": ["e2", "e9"], "sid": ["d_seg_0002"], "q": "not there"}, {"t": "C", "s": "e9", "p": "is", "o": "d_ent_0099", "sid": ["d_seg_0002"], "q": "Ann"}])
    rows = ca.with_ids(ca.candidates(spark.createDataFrame([("d", 0, raw)], "doc_id string, batch_index int, raw_text string")))
    rows = ca.resolve_locals(rows, ca.local_ids(rows))
    w = rp.expansion_warnings(rows, seg, ev.place_quotes(ca.quotes_of(rows), seg))
    got = {(r.id[2:5], r.warning) for r in w.collect()}
    assert got == {("ent", "missing name"), ("ent", "no source segment"), ("evt", "no match for a quote"), ("evt", "dangling participant"), ("evt", "no evidence"), ("clm", "subject is not an entity"), ("clm", "dangling object")}
    res = rp.failures_to_residuals(w).collect()
    assert len(res) == 7 and len({r.id for r in res}) == 7 and {r.category for r in res} == {"other"}


def test_sources_are_validated_in_order(spark, tmp_path):
    good = co.compile_texts(texts.from_memory(spark, {"d": TEXT}), answers(spark))
    co.emit(good, str(tmp_path)).collect()
    assert co.validate_folder(spark, str(tmp_path)).where("severity = 'ERROR'").collect() == []
    v = co.validate_string(spark, "from lamina.ontology import Claim, Entity\nc = Claim(id='c', subject='gone_ent_1', predicate='p', object_ref='x', modality='odd', polarity='positive')\nimport os")
    found = {(r.gate, r.obj_id) for r in v.where("severity = 'ERROR'").collect()}
    assert found == {("grammar", "source"), ("schema", "c"), ("evidence", "c")}
    assert ("reference", "c") in {(r.gate, r.obj_id) for r in v.collect()}  # a warning: no entity is at hand


def test_second_pass_asks_only_with_a_client(spark):
    seg = co.text_only(texts.from_memory(spark, {"d": TEXT}))["Segment"]
    prompts, said = extract.second_pass(seg)
    assert said is None and prompts.collect()[0].segments == 4 and "[d_seg_0002]" in prompts.collect()[0].prompt
    assert extract.second_pass(seg, lambda p: "[]")[1].collect()[0].raw_text == "[]"


def test_endpoint_layers_and_http(tmp_path, monkeypatch):
    import http.server
    import threading

    for name in ("LAMINA_URL", "LAMINA_MODEL", "LAMINA_API_KEY", "LAMINA_PROVIDER", "OPENAI_API_KEY"):
        monkeypatch.delenv(name, raising=False)
    (tmp_path / ".env").write_text("# note\nexport LAMINA_MODEL='from file'\nOPENAI_API_KEY=secret-key-1\n")
    e = model.Endpoint.resolve("openai", str(tmp_path), max_tokens=5)
    assert (e.model, e.api_key, e.max_tokens) == ("from file", "secret-key-1", 5) and e.url == model.PRESETS["openai"][0] and "secret" not in str(e.masked())
    monkeypatch.setenv("LAMINA_MODEL", "from env")
    assert model.Endpoint.resolve("openai", str(tmp_path)).model == "from env" and model.Endpoint.resolve("openai", str(tmp_path), model="given").model == "given"
    with pytest.raises(ValueError):
        model.Endpoint.resolve("nobody", str(tmp_path))

    class Handler(http.server.BaseHTTPRequestHandler):
        def log_message(self, *a):
            pass

        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["content-length"])))
            prompt = body["messages"][0]["content"]
            if prompt == "long" and not body.get("stream"):
                self.send_error(400)
                return
            if prompt == "down":
                self.send_error(503)
                return
            self.send_response(200)
            self.end_headers()
            if body.get("stream"):
                for i, x in ((0, "par"), (1, "s"), (0, "t")):
                    self.wfile.write(("data: " + json.dumps({"type": "content_block_delta", "index": i, "delta": {"type": "text_delta", "text": x}}) + "\n\n").encode())
                self.wfile.write(b"data: [DONE]\n\n")
            else:
                self.wfile.write(json.dumps({"content": [{"type": "thinking"}, {"type": "text", "text": "said " + prompt}]}).encode())

    server = http.server.HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        call = model.http_client(model.Endpoint(url=f"http://127.0.0.1:{server.server_port}", model="m"), timeout=10)
        assert call("hi") == "said hi" and call("long") == "parts"
        with pytest.raises(Exception, match="503"):
            call("down")
    finally:
        server.shutdown()
