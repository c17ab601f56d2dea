"""Quotes located in segments, and the gates on evidence references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import content_hash, locate_from, piece


def locate(quote: Column, text: Column) -> Column:
    """0-based first occurrence, null where there is none or the quote is empty."""
    return locate_from(quote, text)


def ambiguous(quote: Column, text: Column) -> Column:
    """Whether the quote occurs again (overlaps count)."""
    first = locate_from(quote, text)
    return first.isNotNull() & locate_from(quote, text, first + 1).isNotNull()


def place_quotes(quotes: DataFrame, segments: DataFrame) -> DataFrame:
    """Every quote in every segment it names: obj_id, quote_no, segment_id, span_start, span_end, quote_hash, ambiguous.

    ``quotes``: obj_id, quote_no, quote, segment_id. One equi-join on the segment; spans repeated
    within an object are kept once, with the lowest quote number.
    """
    at = quotes.join(segments.select(F.col("id").alias("segment_id"), F.col("text_slice")), "segment_id").withColumn("span_start", locate(F.col("quote"), F.col("text_slice"))).where(F.col("span_start").isNotNull())
    placed = at.select("obj_id", "quote_no", "segment_id", "span_start", (F.col("span_start") + F.length("quote")).alias("span_end"), content_hash(F.col("quote")).alias("quote_hash"), ambiguous(F.col("quote"), F.col("text_slice")).alias("ambiguous"))
    return placed.groupBy("obj_id", "segment_id", "span_start", "span_end").agg(F.min(F.struct("quote_no", "quote_hash", "ambiguous")).alias("q")).select("obj_id", "q.quote_no", "segment_id", "span_start", "span_end", "q.quote_hash", "q.ambiguous")


def unplaced(quotes: DataFrame, segments: DataFrame) -> DataFrame:
    """Quotes that none of their segments contains: obj_id, quote_no."""
    hit = quotes.join(segments.select(F.col("id").alias("segment_id"), "text_slice"), "segment_id").where(locate(F.col("quote"), F.col("text_slice")).isNotNull()).select("obj_id", "quote_no").distinct()
    return quotes.select("obj_id", "quote_no").distinct().join(hit, ["obj_id", "quote_no"], "left_anti")


def exploded(objects: dict[str, DataFrame]) -> DataFrame:
    """obj_type, obj_id, pos, segment_id, span_start, span_end, quote_hash of all evidence references."""
    out = None
    for name, df in objects.items():
        part = df.select(F.lit(name).alias("obj_type"), F.col("id").alias("obj_id"), F.posexplode("evidence_refs").alias("pos", "e")).where(F.col("e").isNotNull()).select("obj_type", "obj_id", "pos", "e.segment_id", "e.span_start", "e.span_end", "e.quote_hash")
        out = part if out is None else out.unionByName(part)
    return out


def without_evidence(claims: DataFrame, events: DataFrame) -> DataFrame:
    """Claims and events with no reference at all; inferred claims need none."""
    none = F.size(F.coalesce("evidence_refs", F.array())) == 0
    c = claims.where(none & (F.coalesce("modality", F.lit("")) != "inferred")).select(F.lit("Claim").alias("obj_type"), F.col("id").alias("obj_id"))
    return c.unionByName(events.where(none).select(F.lit("Event").alias("obj_type"), F.col("id").alias("obj_id")))


def broken_spans(evidence: DataFrame, segments: DataFrame) -> DataFrame:
    """References whose span does not fit the segment, or whose hash is not that of the slice."""
    at = evidence.join(segments.select(F.col("id").alias("segment_id"), "text_slice"), "segment_id")
    fits = (F.col("span_start") >= 0) & (F.col("span_end") > F.col("span_start")) & (F.col("span_end") <= F.length("text_slice"))
    same = content_hash(piece(F.col("text_slice"), F.col("span_start"), F.col("span_end"))).eqNullSafe(F.col("quote_hash"))
    problem = F.when(~F.coalesce(fits, F.lit(False)), "span").when(~same, "hash")
    return at.withColumn("problem", problem).where(F.col("problem").isNotNull()).select("obj_type", "obj_id", "pos", "segment_id", "problem")


def wrong_hashes(rows: DataFrame) -> DataFrame:
    """Blocks or segments whose hash is not that of their text."""
    return rows.where(~content_hash(F.col("text_slice")).eqNullSafe(F.col("hash"))).select("id")


def lookup(df: DataFrame) -> DataFrame:
    """obj_id, pos, segment_id, span: the references, else the source segments as references to whole segments."""
    refs = F.transform(F.coalesce("evidence_refs", F.array()), lambda e: F.struct(e["segment_id"].alias("segment_id"), e["span_start"].alias("span_start"), e["span_end"].alias("span_end")))
    whole = F.transform(F.coalesce("source_segment_ids", F.array()), lambda s: F.struct(s.alias("segment_id"), F.lit(None).cast("int").alias("span_start"), F.lit(None).cast("int").alias("span_end")))
    chosen = F.when(F.size(refs) > 0, refs).otherwise(whole)
    return df.select(F.col("id").alias("obj_id"), F.posexplode(chosen).alias("pos", "e")).select("obj_id", "pos", "e.segment_id", "e.span_start", "e.span_end")


def raw_quotes(found: DataFrame, segments: DataFrame) -> DataFrame:
    """``found`` (as from :func:`lookup`) with the quoted text."""
    at = found.join(segments.select(F.col("id").alias("segment_id"), "text_slice"), "segment_id")
    quote = F.when(F.col("span_start").isNull(), F.col("text_slice")).otherwise(piece(F.col("text_slice"), F.col("span_start"), F.col("span_end")))
    return at.select("obj_id", "pos", "segment_id", quote.alias("quote"))
