"""Blocks into segments: sentences and quotations of paragraphs, table rows, list items, headings and raw blocks.

One kernel cuts a block of any type, because quotations make the rules depend on order and so the blocks,
which come out of a long pipeline, are read once.

Two ways for paragraphs: ``strict`` False keeps the traditional rules (text behind the last stop of
a chunk is dropped, straight and corner quotes are listed one after the other), ``strict`` True
sorts the quotations and drops overlaps.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions.text import content_hash

Span = tuple[int, int, str]

#: Sentence, clause and numbering patterns, quotations and speech verbs. Fixed values.
SENTENCE = re.compile(r"[^。！？.!?\n]+[。！？.!?]+|第[一二三四五六七八九十百千\d]+条[^\n]*|（[一二三四五六七八九十\d]+）[^\n]*|[\d]+[\.、][^\n]*")
QUOTES = (re.compile(r"[「『][^」』]+[」』]"), re.compile(r'["“][^"”]*["”]'))
SPEAKER = re.compile(r"[道说笑哭骂叹答问喊叫吼唱念嘟囔嘀咕嚷][着了过]?(?:道|说|问)?[：:]$")


def _stripped(text: str, start: int, end: int) -> tuple[int, int]:
    while start < end and text[start].isspace():
        start += 1
    while end > start and text[end - 1].isspace():
        end -= 1
    return start, end


def sentence_spans(text: str, lo: int, hi: int) -> list[Span]:
    """Sentences of text[lo:hi]; the whole chunk where there is none."""
    out: list[Span] = []
    hits = list(SENTENCE.finditer(text[lo:hi]))
    for m in hits or [None]:
        a, b = _stripped(text, lo + m.start(), lo + m.end()) if m else _stripped(text, lo, hi)
        if a == b:
            continue
        if b - a < 2 and out:
            out[-1] = (out[-1][0], b, "sentence")
        else:
            out.append((a, b, "sentence"))
    return out


def quotations(text: str, strict: bool = False) -> list[Span]:
    found = [(m.start(), m.end(), "dialogue") for q in QUOTES for m in q.finditer(text)]
    if not strict:
        return found
    kept: list[Span] = []
    for s in sorted(found):
        if not kept or s[0] >= kept[-1][1]:
            kept.append(s)
    return kept


def with_speakers(spans: list[Span], text: str) -> list[Span]:
    """A sentence that ends in a speech verb and a colon joins the quotation right behind it."""
    out: list[Span] = []
    for span in spans:
        last = out[-1] if out else None
        if last and last[2] == "sentence" and span[2] == "dialogue" and last[1] == span[0] and SPEAKER.search(text[last[0] : last[1]].rstrip()):
            out[-1] = (last[0], span[1], "dialogue")
        else:
            out.append(span)
    return out


def paragraph_spans(text: str, strict: bool = False) -> list[Span]:
    """(start, end, type) within a paragraph or quote block."""
    quotes = quotations(text, strict)
    if not quotes:
        return sentence_spans(text, 0, len(text))
    spans: list[Span] = []
    at = 0
    for q in quotes:
        if q[0] > at:
            spans += sentence_spans(text, at, q[0])
        spans.append(q)
        at = q[1]
    if at < len(text):
        spans += sentence_spans(text, at, len(text))
    return with_speakers(spans, text)


#: Unicode white space (property White_Space). Fixed value.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def trimmed(text: str, at: int, kind: str) -> list[Span]:
    """The text at offset ``at`` without white space around it; nothing where that is all."""
    left = text.lstrip(WHITE)
    body = left.rstrip(WHITE)
    start = at + len(text) - len(left)
    return [(start, start + len(body), kind)] if body else []


def block_spans(text: str, block_type: str | None, strict: bool = False) -> list[Span]:
    """(start, end, type) of the segments of one block: sentences and quotations, lines of tables and lists, other blocks whole."""
    if block_type in ("paragraph", "quote"):
        return [x for x in paragraph_spans(text, strict) if x[1] > x[0]]
    if block_type not in ("table", "list"):
        return trimmed(text, 0, "heading" if block_type == "heading" else "raw")
    out: list[Span] = []
    at = 0
    for line in text.split("\n"):
        out += trimmed(line, at, "table_row" if block_type == "table" else "list_item")
        at += len(line) + 1
    return out


def segments(blocks: DataFrame, strict: bool = False) -> DataFrame:
    """id, doc_id, block_index, segment_type, offsets, text_slice, hash. The blocks are read once; one exchange on doc_id for the ordinals."""

    @F.pandas_udf("array<struct<s:int,e:int,t:string>>")
    def split(texts: pd.Series, kinds: pd.Series) -> pd.Series:
        return pd.Series([[{"s": a, "e": b, "t": k} for a, b, k in block_spans(t, kind, strict)] for t, kind in zip(texts, kinds)])

    base = blocks.where(F.col("text_slice").isNotNull()).select("doc_id", "block_index", "block_type", "start_offset", "text_slice")
    every = base.select("doc_id", "block_index", "start_offset", "text_slice", F.posexplode(split("text_slice", "block_type")).alias("pos", "x"))
    number = F.row_number().over(Window.partitionBy("doc_id").orderBy("block_index", "pos", "x.s"))
    text = F.substring("text_slice", F.col("x.s") + 1, F.col("x.e") - F.col("x.s"))
    return every.withColumn("n", number).select(
        F.format_string("%s_seg_%04d", "doc_id", "n").alias("id"), "doc_id", "block_index", F.col("x.t").alias("segment_type"), (F.col("start_offset") + F.col("x.s")).alias("start_offset"), (F.col("start_offset") + F.col("x.e")).alias("end_offset"), text.alias("text_slice"), content_hash(text).alias("hash")
    )
