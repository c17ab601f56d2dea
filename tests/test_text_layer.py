import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lamina.operators import blocks as bl
from lamina.operators import segments as sg
from lamina.sources import texts

GOLDEN = [
    ("甲说：「走吧。」乙答：「好。」", [(0, 8, "dialogue"), (8, 15, "dialogue")]),
    ("雨停了。甲道：「走。」", [(0, 4, "sentence"), (7, 11, "dialogue")]),
    ("One. Two! tail", [(0, 4, "sentence"), (5, 9, "sentence")]),
    ("no end", [(0, 6, "sentence")]),
    ("1. foo bar", [(0, 2, "sentence")]),
    ("第三条 无标点", [(0, 7, "sentence")]),
    ("A。 。B！", [(0, 4, "sentence"), (4, 6, "sentence")]),
    ('He said: "go." Done.', [(0, 8, "sentence"), (9, 14, "dialogue"), (15, 20, "sentence")]),
    ('甲"a"乙「b」丙', [(0, 5, "sentence"), (5, 8, "dialogue"), (1, 4, "dialogue"), (4, 9, "sentence")]),
]


@pytest.mark.parametrize("text,want", GOLDEN)
def test_paragraph_goldens(text, want):
    assert sg.paragraph_spans(text) == want


def test_strict_quotations_are_sorted_and_apart():
    spans = sg.paragraph_spans('甲"a"乙「b」丙', strict=True)
    assert spans == sorted(spans) and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet='甲乙。！.「」"“”\n 第三条道：a', max_size=30))
def test_strict_spans_never_overlap(text):
    spans = sg.paragraph_spans(text, strict=True)
    assert all(0 <= a < b <= len(text) for a, b, _ in spans) and all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))


TEXT = "# Title\n\nFirst line.\nSecond 😀 line.\n\n| a | b |\n| c | d |\n- one\n- two\n> quoted\n　\n```\ncode\n    deep\n第三回 head\nno stop"


def test_blocks_have_exact_offsets(spark):
    t = texts.from_memory(spark, {"d": TEXT, "empty": "", "blank": " \n　\n"})
    rows = sorted(bl.blocks(t).collect(), key=lambda r: r.block_index)
    assert [r.block_type for r in rows] == ["heading", "paragraph", "table", "list", "quote", "code_block", "paragraph", "code_block", "heading", "paragraph"]
    assert all(TEXT[r.start_offset : r.end_offset] == r.text_slice for r in rows)
    assert [r.id for r in rows][:2] == ["d_blk_0000", "d_blk_0001"]
    assert bl.stale_slices(bl.blocks(t), t).count() == 0


def test_segments_have_exact_offsets_and_running_ids(spark):
    t = texts.from_memory(spark, {"d": TEXT})
    rows = sorted(sg.segments(bl.blocks(t)).collect(), key=lambda r: r.id)
    assert all(TEXT[r.start_offset : r.end_offset] == r.text_slice for r in rows)
    assert [r.id for r in rows] == [f"d_seg_{i:04d}" for i in range(1, len(rows) + 1)]
    assert [r.segment_type for r in rows][:7] == ["heading", "sentence", "sentence", "table_row", "table_row", "list_item", "list_item"]


def test_result_does_not_depend_on_partitions(spark):
    t = texts.from_memory(spark, {f"d{i}": TEXT * (i + 1) for i in range(5)})
    a = {tuple(r) for r in sg.segments(bl.blocks(t)).collect()}
    assert a == {tuple(r) for r in sg.segments(bl.blocks(t.repartition(7))).collect()}


def test_tampered_and_missing_texts(spark):
    t = texts.from_memory(spark, {"d": "One. Two."})
    b = bl.blocks(t)
    from pyspark.sql import functions as F

    assert [r.problem for r in bl.stale_slices(b.withColumn("hash", F.lit("x")), t).collect()] == ["hash differs"]
    assert [r.problem for r in bl.stale_slices(b.withColumn("start_offset", F.lit(1)), t).collect()] == ["slice differs"]
    assert [r.problem for r in bl.stale_slices(b.withColumn("doc_id", F.lit("x")), t).collect()] == ["no raw text"]


def test_chapters(spark):
    text = "序\n第一回 甲\n走。\n第二回 乙\n好。"
    rows = sorted(bl.chapters(texts.from_memory(spark, {"d": text, "e": "none"})).collect(), key=lambda r: r.chapter_no)
    assert [(r.chapter_no, r.title) for r in rows] == [(1, "第一回 甲"), (2, "第二回 乙")]
    assert [text[r.start_offset : r.end_offset] for r in rows] == ["第一回 甲\n走。\n", "第二回 乙\n好。"]


def test_content_timestamp(spark):
    t = texts.from_memory(spark, {"d": "甄士隐"})
    assert bl.documents(t).collect()[0].created_at == "2062-08-25T09:38:25+00:00"


def test_files(spark, tmp_path):
    (tmp_path / "2 é-x.txt").write_text("One.", encoding="utf-8")
    (tmp_path / "b.md").write_text("no", encoding="utf-8")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "c.txt").write_text("no", encoding="utf-8")
    rows = texts.read_library(spark, str(tmp_path)).collect()
    assert [(r.doc_id, r.text) for r in rows] == [("doc_2_é_x", "One.")]
    with pytest.raises(FileNotFoundError):
        texts.read_library(spark, str(tmp_path), "*.none")
    with pytest.raises(NotADirectoryError):
        texts.read_library(spark, str(tmp_path / "nowhere"))
