import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lamina.llm import sentences as s

EV = s.Evidence(
    {},
    {"x:The": (50, 0, 0, 99), "x:Die": (50, 0, 0, 99), "x:Mai": (0, 0, 9, 10), "w:Dr": (0, 30, 0, 0), "w:p.m": (9, 9, 0, 9), **{f"w:{w}": (30, 9, 0, 0) for w in ("No", "sec", "cf", "fig", "Nr", "Art", "Vol")}, "w:etc": (4, 40, 0, 30), "w:usw": (0, 40, 0, 20), "w:rain": (0, 9, 90, 9), "s:แก้วน": (9, 0, 0, 0)},
    {"林雯"},
)


@pytest.mark.parametrize(
    "text,want",
    [
        ("Dr. Lee saw it. The end.", ["Dr. Lee saw it.", "The end."]),
        ("A cat, e.g. the old one, etc. The dog ran.", ["A cat, e.g. the old one, etc.", "The dog ran."]),
        ("In the rain. eLedger 3.6.2 ran.", ["In the rain.", "eLedger 3.6.2 ran."]),
        ("B. D. Lee met them at 10 p.m. The end.", ["B. D. Lee met them at 10 p.m.", "The end."]),
        ("See No. 3, sec. 4.2, of it (cf. fig. 9, p. 8). The end?!", ["See No. 3, sec. 4.2, of it (cf. fig. 9, p. 8).", "The end?!"]),
        ("Lee paused ... and left. Then...", ["Lee paused ... and left.", "Then..."]),
        ("Am 4. Mai kam er usw. Die Frau, d. h. Nr. 7. Die Stadt.", ["Am 4. Mai kam er usw.", "Die Frau, d. h. Nr. 7.", "Die Stadt."]),
        ("It was the key.The box hid.", ["It was the key.", "The box hid."]),
        ("“Is it? I see.” asked Ann. The end.", ["“Is it? I see.” asked Ann.", "The end."]),
        ('Ann asked: "Is it? I see." The end.', ['Ann asked: "Is it? I see."', "The end."]),
        ('"I see it." Art. 14 (b) ends.', ['"I see it."', "Art. 14 (b) ends."]),
        ("„Ja. Nein!“, sagte Ann. Die Frau.", ["„Ja. Nein!“, sagte Ann.", "Die Frau."]),
        ("(The cat sat.) The dog ran.", ["(The cat sat.)", "The dog ran."]),
        ("「好。走！」李四说。“灯。”张三说完，今天走了。", ["「好。走！」李四说。", "“灯。”张三说完，今天走了。"]),
        ("『灯亮……』鱼游了（见第2.2节。）。第三条 花开。", ["『灯亮……』", "鱼游了（见第2.2节。）。", "第三条 花开。"]),
        ("林雯……门开了。花开了……水流了。", ["林雯……门开了。", "花开了……", "水流了。"]),
        ("「犬を見た」鳥は飛んだ。「朝。夜。」と言った。", ["「犬を見た」", "鳥は飛んだ。", "「朝。夜。」と言った。"]),
        ("重3.5公斤，No. 82だった。翻开Vol. 3，走。", ["重3.5公斤，No. 82だった。", "翻开Vol. 3，走。"]),
        ("घर खोला। \"दरवाज़ा खोला?\" मीरा ने पूछा। डॉ. मीरा ने देखा ॥", ["घर खोला।", "\"दरवाज़ा खोला?\" मीरा ने पूछा।", "डॉ. मीरा ने देखा ॥"]),
        ("หมาเห็นหมวก! ปลาซื้อเรือ มะลิ แก้วนาวาเห็นแมวหนัก3.5กก. แมวพบปลา", ["หมาเห็นหมวก!", "ปลาซื้อเรือ", "มะลิ แก้วนาวาเห็นแมวหนัก3.5กก.", "แมวพบปลา"]),
        ("One line\nAnother line", ["One line", "Another line"]),
        ("The cat saw the\nwet dog. The end. 🙂", ["The cat saw the\nwet dog.", "The end. 🙂"]),
        ("no boundary at all", ["no boundary at all"]),
        ("  　 ", []),
        ("", []),
        ("。。。", ["。。。"]),
    ],
)
def test_units(text, want):
    assert [text[a:b] for a, b in s.spans(text, EV)] == want


def test_quote_sign_is_outside():
    t = "> One. Two.\n> Three."
    assert [t[a:b] for a, b in s.spans(t, EV, quote=True)] == ["One.", "Two.", "Three."]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aB .!?\n\"“”「」（）()。…，说:>😀กा3")), max_size=60), st.booleans())
def test_units_are_ordered_trimmed_and_cover_the_text(t, quote):
    out = s.spans(t, EV, quote)
    assert all(a < b and t[a:b].strip() == t[a:b] for a, b in out) and all(x[1] <= y[0] for x, y in zip(out, out[1:]))
    covered = set()
    for a, b in out:
        covered.update(range(a, b))
    assert all(t[i].isspace() or quote and t[i] == ">" for i in range(len(t)) if i not in covered)


def test_table(spark):
    schema = "id string, doc_id string, block_type string, text_slice string, loaded_at timestamp, token string, names int"
    d = dt.datetime
    rows = [("a", "d", "paragraph", "Mr. Lee came. Mr. 7 came, Mr. 8 left.", d(2025, 1, 1), "x", 1), ("a", "d", "paragraph", "old. text.", d(2024, 1, 1), "x", 1), ("b", None, "quote", "> One. Two.", d(2025, 1, 1), "x", 1), ("c", "d", "table", "| a. |", d(2025, 1, 1), "x", 1), ("d", "d", "paragraph", None, d(2025, 1, 1), "x", 1), ("e", "d", "paragraph", " ", d(2025, 1, 1), "x", 1), (None, "d", "paragraph", "x.", d(2025, 1, 1), "x", 1), ("b", None, "quote", "> One. Two.", d(2025, 1, 1), "x", 1)]
    blocks = spark.createDataFrame(rows, schema)
    got = sorted((r.block_id, r.text) for r in s.units(s.running_text(blocks)).collect())
    assert got == [("a", "Mr. 7 came, Mr. 8 left."), ("a", "Mr. Lee came."), ("b", "One."), ("b", "Two.")]
    assert s.units(s.running_text(blocks.limit(0))).count() == 0


def test_broadcast_and_join_agree(spark):
    text = "The rain fell. A Qx. 3 and a Qx. 4 met. Then Qx. 5 left the rain. The Qx. Nobody knew."
    df = spark.createDataFrame([(f"b{i}", f"d{i % 2}", "paragraph", text) for i in range(6)], "id string, doc_id string, kind string, text string")
    pick = lambda x: sorted((r.block_id, r.unit_start, r.unit_end) for r in x.collect())
    assert pick(s.units(df)) == pick(s.units(df, broadcast_rows=-1))
    assert "A Qx. 3 and a Qx. 4 met." in {r.text for r in s.units(df).collect()}


def test_evidence_of_a_document_spans_its_blocks(spark):
    blocks = [("a1", "a", "The Qx. Nobody knew. A Zed. While it rained, While sat.")]
    blocks += [("a2", "a", "One qx. The Qx fell while it rained and while all slept.")]
    blocks += [(f"b{i}", f"b{i}", "Then, While came. See Qx. 3 and Qx. 4.") for i in range(15)]
    df = spark.createDataFrame([(i, d, "paragraph", t) for i, d, t in blocks], "id string, doc_id string, kind string, text string")
    need = spark.createDataFrame([("a", "w:Qx"), ("a", "x:While"), ("b0", "w:Qx"), (None, "w:Zed")], "doc string, token string")
    found = s.facts(df)
    got = {(r.doc, r.token): (r.a, r.b, r.c) for r in s.document_evidence(found, need).collect()}
    assert got == {("a", "w:Qx"): (0, 1, 1), ("a", "x:While"): (2, 1, 0), ("b0", "w:Qx"): (2, 0, 0)}
    whole = {r.token: (r.a, r.b, r.c) for r in s.corpus_evidence(found, need).collect()}
    assert whole["w:Qx"] == (30, 1, 1) and set(whole) == {"w:Qx", "x:While", "w:Zed"}
    # the corpus takes Qx for an abbreviation, the other block of the document shows that it is a word here
    found = [r.text for r in s.units(df).where("block_id = 'a1'").orderBy("unit_index").collect()]
    assert found[0] == "The Qx."


def test_evidence_does_not_depend_on_partitions(spark):
    # "Etc. Then" counts for Etc only if "then" is a common word, which other blocks decide
    texts = ["They saw cats, Etc. Then rain fell.", "It fell then and only then.", "See Etc. Then all left.", "Then, Then sat.", "Etc. Then. Etc. Then. Etc. Nobody."] * 3
    rows = [(f"b{i}", f"d{i}", "paragraph", t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "id string, doc_id string, kind string, text string")
    need = spark.createDataFrame([("d0", "w:Etc"), ("d0", "x:Then")], "doc string, token string")
    seen = [sorted(tuple(r) for r in s.corpus_evidence(s.facts(df.repartition(k)), need).collect()) for k in (1, 7, 64)]
    assert seen[0] == seen[1] == seen[2] and dict((r[0], r[4]) for r in seen[0])["w:Etc"] == 12
    units = [sorted(tuple(r) for r in s.units(df.repartition(k)).select("block_id", "unit_start", "unit_end").collect()) for k in (1, 7, 64)]
    assert units[0] == units[1] == units[2]
