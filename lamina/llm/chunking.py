"""Oversized items cut at natural boundaries, with overlap: a recursive separator hierarchy.

Method. A text is split at the coarsest separators (sections); a part that is still too large is
split at the next (paragraphs, sentences, words, at last characters). The parts are packed greedily
up to the limit, and each next piece starts with the last ``overlap`` code points of the piece
before, moved forward to the next natural place if there is one.

A part is at most limit - overlap long, so a part and its overlap always fit: no piece exceeds the
limit, none is dropped, and the pieces cover the text. Whole texts are read in one pass per level.

Defined cases: null and blank texts and texts within the limit are one piece (null: none); the
current row of an id counts; offsets are code points of the document, counted from the block's
start (null start: from 0), whatever its stored end says. A cut never separates a base character
from its combining marks where it can be avoided.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import current_rows

LEVELS = ("section", "paragraph", "sentence", "word", "character")
_SEPARATORS = (
    re.compile(r"\n[^\S\n]*\n\s*(?=#|第[^\n]{1,12}[章回节節卷篇部])"),
    re.compile(r"\n[^\S\n]*\n\s*|\n(?=[^\S\n]*(?:[-*|>#]|\d+[.、)]))"),
    re.compile(r"[.!?…]+[\"'”’»)\]]*\s+|[。！？．।॥…]+[」』”’）》\s]*|\n\s*"),
    re.compile(r"\s+|[，、；：,;]\s*"),
)


def boundaries(text: str) -> list[list[int]]:
    """Per level the positions at which the text may be cut (a part starts there), ascending."""
    return [[m.end() for m in sep.finditer(text) if 0 < m.end() < len(text)] for sep in _SEPARATORS]


def _joined(text: str, at: int) -> bool:
    """Whether a cut at ``at`` would part a character from its marks."""
    return 0 < at < len(text) and (unicodedata.category(text[at])[0] == "M" or text[at] == "‍" or text[at - 1] == "‍")


def atoms(text: str, most: int, marks: list[list[int]] | None = None) -> list[int]:
    """Ends of consecutive parts of at most ``most`` code points, cut as coarsely as possible."""
    marks = boundaries(text) if marks is None else marks
    ends: list[int] = []
    stack = [(0, len(text), 0)]
    while stack:
        lo, hi, level = stack.pop()
        if hi - lo <= most:
            ends.append(hi)
            continue
        if level == len(marks):
            cuts = []
            at = lo
            while hi - at > most:
                at += most
                back = at
                while _joined(text, back) and at - back < min(32, most - 1):
                    back -= 1
                at = at if _joined(text, back) else back
                cuts.append(at)
        else:
            m = marks[level]
            cuts = m[bisect_right(m, lo) : bisect_left(m, hi)]
        edges = [lo, *cuts, hi]
        stack.extend((a, b, level + 1) for a, b in reversed(list(zip(edges, edges[1:]))))
    return ends


def pieces(text: str, limit: int = 1000, overlap: int = 100) -> list[tuple[int, int]]:
    """(start, end) of the pieces."""
    if limit <= overlap or overlap < 0:
        raise ValueError("the limit must be greater than the overlap")
    n = len(text)
    if n <= limit:
        return [(0, n)] if n else []
    marks = boundaries(text)
    natural = sorted({p for level in marks for p in level})
    ends = atoms(text, limit - overlap, marks)
    out: list[tuple[int, int]] = []
    start, last = 0, 0
    for end in ends:
        if end - start > limit:
            out.append((start, last))
            start = _restart(text, natural, last, overlap)
            if end - start > limit:
                start = end - limit
        last = end
    out.append((start, last))
    return out


def _restart(text: str, natural: list[int], end: int, overlap: int) -> int:
    """Where the piece after one that ends at ``end`` starts."""
    earliest = max(0, end - overlap)
    i = bisect_left(natural, earliest)
    if i < len(natural) and natural[i] < end:
        return natural[i]
    while earliest < end and _joined(text, earliest):
        earliest += 1
    return earliest


def split(items: DataFrame, limit: int = 1000, overlap: int = 100) -> DataFrame:
    """block_id, doc_id, piece, piece_start, piece_end (in the text), doc_start, doc_end, text. ``items``: id, doc_id, start, text."""

    @F.pandas_udf("array<struct<s:int,e:int>>")
    def cutting(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [{"s": a, "e": b} for a, b in pieces(t, limit, overlap)] if t else [])

    small = F.length("text") <= limit
    whole = F.array(F.struct(F.lit(0).alias("s"), F.length("text").alias("e")))
    base = F.coalesce(F.col("start"), F.lit(0))

    def rows(part: DataFrame, spans: F.Column) -> DataFrame:
        x = part.select(F.col("id").alias("block_id"), "doc_id", base.alias("base"), "text", F.posexplode(spans).alias("piece", "p"))
        return x.select("block_id", "doc_id", "piece", F.col("p.s").alias("piece_start"), F.col("p.e").alias("piece_end"), (F.col("base") + F.col("p.s")).alias("doc_start"), (F.col("base") + F.col("p.e")).alias("doc_end"), F.substring("text", F.col("p.s") + 1, F.col("p.e") - F.col("p.s")).alias("text"))

    known = items.where(F.col("text").isNotNull())
    return rows(known.where(~small), cutting("text")).unionByName(rows(known.where(small), whole))


def current_blocks(blocks: DataFrame) -> DataFrame:
    return current_rows(blocks, ["id"], {"doc_id": "doc_id", "start": "start_offset", "text": "text_slice"})


def oversized(blocks: DataFrame, limit: int = 1000, overlap: int = 100) -> DataFrame:
    """Pieces of the current blocks that exceed the limit."""
    return split(current_blocks(blocks).where(F.length("text") > limit), limit, overlap)


def joined(cut_pieces: DataFrame, limit: int = 1000, overlap: int = 100) -> DataFrame:
    """The blocks put together from their pieces: block_id, text_hash, length, faults (too_long, apart, too_wide) and document offsets.

    apart: a piece that starts behind the end of the one before, or at another document offset than its place in the block.
    The pieces of one block are gathered, as many as the block itself is long.
    """
    rows = cut_pieces.groupBy("block_id").agg(F.sort_array(F.collect_list(F.struct("piece", "piece_start", "piece_end", "doc_start", "doc_end", "text"))).alias("p"))
    last = F.slice("p", 1, F.size("p") - 1)
    pairs = F.zip_with(last, F.slice("p", 2, F.size("p")), lambda a, b: F.struct((a["piece_end"] - b["piece_start"]).alias("shared"), a.alias("a"), b.alias("b")))
    text = F.aggregate("p", F.lit(""), lambda t, x: F.concat(t, F.substring(x["text"], F.length(t) - x["piece_start"] + 1, limit + overlap)))
    count = lambda found: F.size(found).alias
    first = F.element_at("p", 1)
    shifted = F.filter("p", lambda x: (x["doc_start"] - x["piece_start"] != first["doc_start"]) | (x["doc_end"] - x["doc_start"] != F.length(x["text"])) | (x["piece_end"] - x["piece_start"] != F.length(x["text"])))
    return rows.select(
        "block_id", F.sha2(text, 256).alias("text_hash"), F.element_at("p", -1)["piece_end"].alias("length"),
        count(F.filter("p", lambda x: F.length(x["text"]) > limit))("too_long"), (F.size(F.filter(pairs, lambda x: x["shared"] <= 0)) + F.size(shifted)).alias("apart"), count(F.filter(pairs, lambda x: x["shared"] > overlap))("too_wide"),
        first["doc_start"].alias("first_offset"), F.element_at("p", -1)["doc_end"].alias("last_offset"),
    )
