"""Relations derived from claims."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def eligibility(claims: DataFrame, entities: DataFrame) -> DataFrame:
    """Claims with the first reason for which they give no relation (null: they give one)."""
    known = entities.select("id").distinct()
    marked = claims.join(known.select(F.col("id").alias("subject"), F.lit(True).alias("has_subject")), "subject", "left").join(known.select(F.col("id").alias("object_ref"), F.lit(True).alias("has_object")), "object_ref", "left")
    size = lambda c: F.size(F.coalesce(c, F.array()))
    reason = (
        F.when(~F.col("modality").eqNullSafe("asserted"), "modality")
        .when(~F.col("polarity").eqNullSafe("positive"), "polarity")
        .when(F.col("has_subject").isNull(), "subject")
        .when(F.col("has_object").isNull(), "object")
        .when((size("evidence_refs") == 0) & (size("source_segment_ids") == 0), "evidence")
    )
    return marked.withColumn("skip_reason", reason).drop("has_subject", "has_object")


def derive(claims: DataFrame, entities: DataFrame) -> DataFrame:
    """One relation per (doc_id, subject, predicate, object): the first claim names it, the evidence of all is united in order.

    Claims of a triple are ordered by id. Reference arrays are merged after a sort by (claim, position),
    so the result does not depend on the order of rows.
    """
    ok = eligibility(claims, entities).where(F.col("skip_reason").isNull())
    refs = F.transform(F.coalesce("evidence_refs", F.array()), lambda e: e)
    packed = ok.groupBy("doc_id", "subject", "predicate", "object_ref").agg(F.min("id").alias("claim_id"), F.count("*").alias("claims"), F.sort_array(F.collect_list(F.struct("id", refs.alias("refs")))).alias("all"))
    merged = F.array_distinct(F.flatten(F.transform("all", lambda x: x["refs"])))
    rel_id = F.when(F.col("claim_id").contains("_clm_"), F.regexp_replace("claim_id", r"^(.*?)_clm_", "$1_rel_clm_")).otherwise(F.concat("claim_id", F.lit("_rel")))
    return packed.select(rel_id.alias("id"), "doc_id", "subject", "predicate", "object_ref", "claim_id", merged.alias("evidence_refs"), "claims")


def dedup(relations: DataFrame) -> DataFrame:
    """The first relation (by id) of each triple, with the evidence of all, each reference once, in the order of ids."""
    cols = relations.columns
    triple = ("doc_id", "subject", "predicate", "object_ref")
    rest = [c for c in cols if c not in (*triple, "id", "evidence_refs")]
    aggs = [F.min(F.struct("id", *rest)).alias("r")]
    if "evidence_refs" in cols:
        aggs.append(F.sort_array(F.collect_list(F.struct("id", F.coalesce("evidence_refs", F.array()).alias("refs")))).alias("all"))
    first = relations.groupBy(*triple).agg(*aggs)
    if "evidence_refs" in cols:
        first = first.withColumn("evidence_refs", F.array_distinct(F.flatten(F.transform("all", lambda x: x["refs"]))))
    return first.select(*triple, "r.*", *(["evidence_refs"] if "evidence_refs" in cols else [])).select(*cols)
