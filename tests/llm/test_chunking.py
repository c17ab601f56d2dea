import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lamina.llm import chunking as c

text = st.text(alphabet=st.sampled_from(list("ab .,!?\n。，甲乙😀é́#")), max_size=400)


@settings(max_examples=300, deadline=None)
@given(text, st.integers(12, 60), st.integers(0, 10))
def test_pieces_cover_overlap_and_fit(t, limit, overlap):
    p = c.pieces(t, limit, overlap)
    assert all(0 < b - a <= limit for a, b in p)
    if t:
        assert p[0][0] == 0 and p[-1][1] == len(t)
    for (a, b), (x, y) in zip(p, p[1:]):
        assert a < x <= b < y and b - x <= max(overlap, 32)
    rebuilt = t[: p[0][1]] if p else ""
    for (_, b), (_, y) in zip(p, p[1:]):
        rebuilt += t[b:y]
    assert rebuilt == t


def test_natural_places():
    t = "First sentence here. " * 100
    p = c.pieces(t, 200, 40)
    assert all(t[:a].endswith(" ") for a, _ in p[1:]) and all(t[a].strip() for a, _ in p)
    assert all(t[:b].endswith(". ") for _, b in p)
    assert all(0 < b - x <= 40 for (_, b), (x, _) in zip(p, p[1:]))


def test_text_without_any_place_shares_exactly_the_overlap():
    p = c.pieces("x" * 5000, 1000, 100)
    assert all(b - x == 100 for (_, b), (x, _) in zip(p, p[1:])) and p[-1][1] == 5000


def test_sections_first():
    t = "a" * 30 + "\n\n# B\n" + "b" * 30
    assert [t[a:b] for a, b in c.pieces(t, 50, 5)] [0] == "a" * 30 + "\n\n"


def test_limit_must_exceed_overlap():
    with pytest.raises(ValueError):
        c.pieces("x", 5, 5)


def test_marks_stay_with_their_letter():
    t = "é" * 600
    assert all(t[a] == "e" for a, _ in c.pieces(t, 101, 10))


def test_blocks(spark):
    schema = "id string, doc_id string, start_offset int, end_offset int, text_slice string, loaded_at timestamp, piece string, base int"
    d = dt.datetime
    long = "word " * 500
    rows = [("a", "d", 7, 9, long, d(2025, 1, 1), "x", 1), ("b", "d", 0, 5, "short", d(2025, 1, 1), "x", 1), ("c", "d", None, 5, long, d(2025, 1, 2), "x", 1), ("c", "d", 3, 5, "old", d(2025, 1, 1), "x", 1), ("d", "d", 0, 0, None, d(2025, 1, 1), "x", 1), ("e", "d", 0, 0, long, d(2025, 1, 1), "x", 1), ("e", "d", 0, 0, "now short", d(2025, 1, 2), "x", 1), (None, "d", 0, 0, long, d(2025, 1, 1), "x", 1), ("f", "d", 0, 0, "y" * 1000, d(2025, 1, 1), "x", 1), ("g", "d", 0, 0, "y" * 1001, d(2025, 1, 1), "x", 1), ("g", "d", 0, 0, "y" * 1001, d(2025, 1, 1), "x", 1)]
    blocks = spark.createDataFrame(rows, schema)
    got = c.oversized(blocks).collect()
    assert {r.block_id for r in got} == {"a", "c", "g"}
    assert all(r.doc_start - r.piece_start == {"a": 7}.get(r.block_id, 0) and len(r.text) == r.piece_end - r.piece_start <= 1000 for r in got)
    every = c.split(c.current_blocks(blocks)).collect()
    assert {r.block_id for r in every} == {"a", "b", "c", "e", "f", "g"}
    assert c.oversized(blocks.limit(0)).count() == 0


def test_very_long_text():
    t = ("甲乙丙。" * 5 + "\n") * 20_000
    p = c.pieces(t)
    assert p[-1][1] == len(t) and max(b - a for a, b in p) <= 1000
