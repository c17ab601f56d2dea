import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lamina.llm import names as n

SCHEMA = "id string, work_id string, name string, kind string, aliases array<string>, loaded_at timestamp, is_deleted boolean, label string, form int"


def entities(spark, items):
    rows = []
    for i, x in enumerate(items):
        work, name, kind, *rest = x
        aliases, gone, ident = (list(rest) + [None, False, None][len(rest) :])
        rows.append((ident or f"e{i:02d}", work, name, kind, aliases, dt.datetime(2025, 1, 1), gone, "x", 1))
    return spark.createDataFrame(rows, SCHEMA)


def classes(spark, items):
    out = {}
    for r in n.linked(entities(spark, items)).collect():
        out.setdefault(r.label, set()).add(r.id)
    return sorted(map(sorted, (v for v in out.values() if len(v) > 1)))


def taught(*pairs):
    """Entities of other works that hold both spellings, as a corpus would."""
    return [(f"t{i}-{k}", f"{a} {x}", kind, [f"{b} {x}"]) for i, (a, b, kind) in enumerate(pairs) for k, x in enumerate(("Zarrow", "Quimby", "Feldstrom"))]


def test_variants_of_one_person(spark):
    items = [("w", x, "person") for x in ("Margaret Thöanvic", "margaret thoeanvic", "Thöanvic, Margaret", "Peggy Thöanvic", "Margaret  B. Thöanvic", "Margaet Thöanvic", "M. Thöanvic", "Dr. Thöanvic", "MARGARET THÖANVIC")]
    assert classes(spark, [*items, ("w", "Henrik Corfenwell", "person"), ("v", "Margaret Thöanvic", "person"), *taught(("Margaret", "Peggy", "person"))]) == [[f"e{i:02d}" for i in range(9)]]


def test_organisations(spark):
    items = [("w", x, "org") for x in ("Wyngaport Lantern Trust", "W.L.T.", "WLT", "Trust of Wyngaport Lantern", "The Wyngaport Lantern Trust Ltd", "Wyngaport-Lantern Tr.", "Wyngapoort Lantern Trust")]
    items += [("w", x, "org") for x in ("望海仓储公司", "望仓", "望海仓储", "仓储公司（望海）", "望海 仓储公司总部", "望海仓储有限公司")]
    taught_words = [(f"t{k}", f"{x} Trust", "org", [f"{x} Tr."]) for k, x in enumerate(("Zarrow Lamp", "Quimby Sail", "Feldstrom Rope"))]
    assert classes(spark, [*items, *taught_words]) == [[f"e{i:02d}" for i in range(7)], [f"e{i:02d}" for i in range(7, 13)]]


def test_scripts_without_case(spark):
    items = [("w", x, "person") for x in ("มะลิ แก้วนาวา", "คุณมะลิ แก้วนาวา", "แก้วนาวา มะลิ", "มะลิแก้วนาวา", "นายมะลิ")] + [("v", x, "person") for x in ("रोहन तारकेश", "श्री रोहन तारकेश", "तारकेश, रोहन", "र. तारकेश", "रोहन तारकेश जी", "रोहनतारकेश")]
    assert classes(spark, items) == [[f"e{i:02d}" for i in range(5)], [f"e{i:02d}" for i in range(5, 11)]]


def test_learned_readings_and_characters(spark):
    learn = [(f"x{i}", a, "person", [b]) for i, (a, b) in enumerate([("孙凡松", "Sun Fansong"), ("孙凡松", "Fansong Sun"), ("孫凡松", "孙凡松"), ("孫凡松", "孙凡松"), ("孙凡淞", "孙凡松"), ("孙凡淞", "孙凡松")])]
    items = [("w", "孙凡松", "person"), ("w", "Sun Fansong", "person"), ("w", "孫·凡松", "person"), ("w", "孙凡淞", "person"), ("w", "孙先生", "person"), ("w", "孙秋", "person", None, False, "z")]
    got = classes(spark, [*learn, *items])
    assert got == [["e06", "e07", "e08", "e09"]]


def test_what_must_stay_apart(spark):
    items = [("w", "Ann Marwick", "person"), ("w", "Henrik Marwick", "person"), ("w", "Marwick", "person"), ("w", "Portville", "location"), ("w", "Portville", None), (None, "Ann Marwick", "person"), ("w", None, "person"), ("w", " ", "person"), ("w", "Ann Marwick", "person", None, True)]
    assert classes(spark, items) == []


def test_generic_aliases_link_nobody(spark):
    items = [(f"w{i}", f"{c}xx Yyyy", "person", ["skipper of all"]) for i, c in enumerate("ABCDEFGH")] + [("v", "Qaa Bbb", "person", ["skipper of all"]), ("v", "Raa Ccc", "person", ["skipper of all"])]
    assert classes(spark, items) == []


def test_current_rows_and_empty(spark):
    assert n.pairs(n.linked(entities(spark, []))).count() == 0
    items = [("w", "Ann Marwick", "person", None, False, "a"), ("w", "Ann Marwick", "person", None, False, "a"), ("w", "Marwick, Ann", "PER", None, False, "b")]
    assert [tuple(r) for r in n.pairs(n.linked(entities(spark, items))).collect()] == [("a", "b")]


words = st.text(alphabet="abc", min_size=7, max_size=12)


@settings(max_examples=4, deadline=None)
@given(st.lists(words, min_size=3, max_size=25, unique=True))
def test_radius_join_is_exact(spark, forms):
    df = spark.createDataFrame([("w", "L:" + f) for f in forms], "work_id string, form string")
    got = {(r.form_a, r.form_b) for r in n.radius_join(df, cell_items=3, fan=2).collect()}
    reach = {"L:" + f: 2 if len(f) >= 10 else 1 for f in forms}
    want = {tuple(sorted((a, b))) for a in reach for b in reach if a != b and n.distance(a, b) <= min(reach[a], reach[b])}
    assert got == want
    one_cell = {(r.form_a, r.form_b) for r in n.radius_join(df, cell_items=10**6).collect()}
    assert one_cell == want


def test_a_hot_work_is_split_and_what_cannot_be_told_apart_ends(spark):
    forms = [("w", f"L:{a}{b}{c} harborough {d}ine") for a in "abcdefg" for b in "mnop" for c in "xyz" for d in "rst"]
    df = spark.createDataFrame(forms, "work_id string, form string").withColumn("r", n.radius(F.col("form")))
    at = n.cells(df, cell_items=20, fan=4)
    assert at.where("home").count() == len(forms) and at.where("home").select("form").distinct().count() == len(forms)
    assert at.select("cell").distinct().count() > 4


def test_short_words_replaced_whole_stay_apart(spark):
    df = spark.createDataFrame([("w", "L:belbestad bob"), ("w", "L:belbestad zoe"), ("w", "L:belbestad jhon"), ("w", "L:belbestad john"), ("w", "L:harbour rivre"), ("w", "L:harbour river")], "work_id string, form string")
    assert sorted(tuple(r)[1:] for r in n.radius_join(df).collect()) == [("L:belbestad jhon", "L:belbestad john"), ("L:harbour river", "L:harbour rivre")]


@given(words, words, words)
def test_distance_is_a_metric(a, b, c):
    assert n.distance(a, b) == n.distance(b, a) and n.distance(a, c) <= n.distance(a, b) + n.distance(b, c) and (n.distance(a, b) == 0) == (a == b)


@pytest.mark.parametrize("token,k,want", [("fansong", 2, ["fan", "song"]), ("xiaoqing", 2, ["xiao", "qing"]), ("yan", 1, ["yan"]), ("zzz", 1, None)])
def test_syllables(token, k, want):
    assert n.syllables(token, k) == want


def test_classes_follow_chains(spark):
    held = spark.createDataFrame([(f"i{k:03d}", "w", f"f{k + j}") for k in range(40) for j in (0, 1)], "id string, work_id string, form string")
    assert n.classes(held).agg(F.count_distinct("label")).collect()[0][0] == 1


def test_a_rare_script_has_pivots(spark):
    many = spark.range(20000).select(F.col("id").cast("string").alias("work_id"), F.concat(F.lit("L:"), F.md5(F.col("id").cast("string"))).alias("form"))
    few = spark.createDataFrame([("w", "T:มะลิแก้วนาวา"), ("w", "T:มะลิแก้วนาวี"), ("w", "D:रोहनतारकेश"), ("w", "D:रोहनतारकेस")], "work_id string, form string")
    assert {r.form_a[0] for r in n.radius_join(many.unionByName(few)).collect()} == {"T", "D"}


def test_a_large_lexicon_is_whole(spark):
    pairs = [("孙凡松", "Sun Fansong"), ("孫凡松", "孙凡松"), ("欧阳明月", "Mingyue Ouyang"), ("Ulvira Marwick", "Bex Marwick")]
    df = spark.createDataFrame([(f"{i}-{k}", "w", a, "person", [b]) for i, (a, b) in enumerate(pairs) for k in range(4)], "id string, work_id string, name string, kind string, aliases array<string>")
    small, none = n.learn(df)
    large, parts = n.learn(df, broadcast_rows=0)
    assert none is None and {r.key: r.reading for r in parts.collect()} == small.parts and len(small.parts) > 8
    assert (large.chars, large.readings, large.words) == (small.chars, small.readings, small.words) and len(small.words) == len(n.Lexicon().words) + 1
    pick = lambda x: sorted(tuple(r) for r in x.collect())
    assert pick(n.entity_forms(df, large, parts)) == pick(n.entity_forms(df, small))
    assert any(r.form.startswith("R:") and r.id == "2-0" for r in n.entity_forms(df.withColumn("aliases", F.array().cast("array<string>")), large, parts).collect())
