"""Coverage of segments by semantic objects: three definitions under three names.

``status``    what names a segment: objects, residuals, ignore markers
``sourced``   share of segments in source_segment_ids of entities, events and claims
``by_count``  0, 1 or more references
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import COVERAGE_STATUSES

SEMANTIC = ("Entity", "Event", "Claim", "Relation")


def status(segments: DataFrame, references: DataFrame, claims: DataFrame, residuals: DataFrame, ignores: DataFrame, modality_rule: bool = True) -> DataFrame:
    """doc_id, segment_id, status, raw_fallback, object_count (an object counts once per matching path)."""
    to_segment = references.where((F.col("target_type") == "Segment") & F.col("obj_type").isin(*SEMANTIC))
    doubtful = claims.where(~F.col("modality").eqNullSafe("asserted") | ~F.col("polarity").eqNullSafe("positive")).select(F.lit("Claim").alias("obj_type"), F.col("id").alias("obj_id"), F.lit(True).alias("doubt"))
    paths = to_segment.select("obj_type", "obj_id", F.col("target_id").alias("segment_id"), F.when(F.col("field") == "source_segment_ids", "source").otherwise("evidence").alias("path")).distinct()
    sem = paths.join(doubtful.distinct(), ["obj_type", "obj_id"], "left").groupBy("segment_id").agg(F.count("*").alias("object_count"), F.coalesce(F.bool_or("doubt"), F.lit(False)).alias("doubt"))
    res = residuals.groupBy("segment_id").agg(F.bool_or(F.col("importance") == "high").alias("high"), F.lit(True).alias("has_res"))
    ign = ignores.select("segment_id").distinct().withColumn("has_ign", F.lit(True))
    at = segments.select("doc_id", F.col("id").alias("segment_id")).join(sem, "segment_id", "left").join(res, "segment_id", "left").join(ign, "segment_id", "left")
    has_sem = F.coalesce("object_count", F.lit(0)) > 0
    has_res = F.coalesce("has_res", F.lit(False))
    st = F.when(F.coalesce("has_ign", F.lit(False)), "ignored").when(has_sem & ~has_res, "covered").when(has_sem, "partial").when(has_res, "raw_only").otherwise("uncovered")
    fallback = st.isin("partial", "raw_only", "uncovered") | F.coalesce("high", F.lit(False))
    if modality_rule:
        fallback = fallback | F.coalesce("doubt", F.lit(False))
    return at.select("doc_id", "segment_id", st.alias("status"), fallback.alias("raw_fallback"), F.coalesce("object_count", F.lit(0)).alias("object_count"))


def report(statuses: DataFrame) -> DataFrame:
    """Per document: total_segments, a count per status (zeros kept), fallback."""
    counts = [F.count_if(F.col("status") == s).alias(s) for s in COVERAGE_STATUSES]
    return statuses.groupBy("doc_id").agg(F.count("*").alias("total_segments"), *counts, F.count_if("raw_fallback").alias("fallback"))


def reports(statuses: DataFrame, documents: DataFrame) -> DataFrame:
    """CoverageReport rows: id, doc_id, total_segments, status_counts, requires_raw_fallback in segment order, generated_at.

    The list is part of the class; its length is that of the document.
    """
    listed = statuses.where("raw_fallback").groupBy("doc_id").agg(F.sort_array(F.collect_list("segment_id")).alias("requires_raw_fallback"))
    r = report(statuses)
    counts = F.create_map(*[x for s in COVERAGE_STATUSES for x in (F.lit(s), F.col(s).cast("int"))])
    out = r.join(listed, "doc_id", "left").join(documents.select(F.col("id").alias("doc_id"), F.col("created_at").alias("generated_at")), "doc_id", "left")
    return out.select(F.concat("doc_id", F.lit("_coverage")).alias("id"), "doc_id", F.col("total_segments").cast("int").alias("total_segments"), counts.alias("status_counts"), F.coalesce("requires_raw_fallback", F.array().cast("array<string>")).alias("requires_raw_fallback"), "generated_at")


def by_symbol(statuses: DataFrame, symbols: DataFrame) -> DataFrame:
    """Statuses keyed by symbol. ``symbols``: id, symbol."""
    return statuses.join(symbols.select(F.col("id").alias("segment_id"), "symbol"), "segment_id").select("doc_id", "symbol", "status", "raw_fallback")


def sourced(segments: DataFrame, references: DataFrame) -> DataFrame:
    """doc_id, segments, sourced, rate: segments in source_segment_ids of entities, events or claims."""
    named = references.where((F.col("field") == "source_segment_ids") & F.col("obj_type").isin("Entity", "Event", "Claim")).select(F.col("target_id").alias("id"), F.lit(1).alias("hit")).distinct()
    at = segments.select("id", "doc_id").join(named, "id", "left")
    return at.groupBy("doc_id").agg(F.count("*").alias("segments"), F.count("hit").alias("sourced")).withColumn("rate", F.round(F.col("sourced") / F.col("segments"), 4))


def by_count(segments: DataFrame, references: DataFrame) -> DataFrame:
    """doc_id, segment_id, references, status: two references cover, one covers partly."""
    n = references.where((F.col("field") == "source_segment_ids") & F.col("obj_type").isin("Entity", "Event", "Claim")).groupBy(F.col("target_id").alias("segment_id")).agg(F.count("*").alias("references"))
    at = segments.select("doc_id", F.col("id").alias("segment_id")).join(n, "segment_id", "left").withColumn("references", F.coalesce("references", F.lit(0)))
    return at.select("doc_id", "segment_id", "references", F.when(F.col("references") >= 2, "covered").when(F.col("references") == 1, "partial").otherwise("uncovered").alias("status"))
