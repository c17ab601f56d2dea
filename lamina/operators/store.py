"""The object store: rows (obj_type, obj_id, data JSON, loaded_at), last write wins; kept as Parquet by type."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import current_rows, cut
from ..schemas import SCHEMAS

KEYS = ("obj_type", "obj_id")


def rows_of(obj_type: str, df: DataFrame) -> DataFrame:
    """Typed rows as store rows; nulls are kept out of the JSON."""
    cols = [c for c in df.columns if c != "loaded_at"]
    at = F.col("loaded_at") if "loaded_at" in df.columns else F.current_timestamp()
    return df.select(F.lit(obj_type).alias("obj_type"), F.col("id").alias("obj_id"), F.to_json(F.struct(*cols)).alias("data"), at.alias("loaded_at"))


def upsert(store: DataFrame, changes: DataFrame) -> DataFrame:
    """Store after ``changes``: the latest row of each key."""
    both = store.select(*KEYS, "data", "loaded_at").unionByName(changes.select(*KEYS, "data", "loaded_at"))
    return current_rows(both, list(KEYS), {"data": "data"}).select(*KEYS, "data", "loaded_at")


def compact(store: DataFrame) -> DataFrame:
    return current_rows(store, list(KEYS), {"data": "data"}).select(*KEYS, "data", "loaded_at")


def delete(store: DataFrame, keys: DataFrame) -> DataFrame:
    return store.join(keys.select(*KEYS).distinct(), list(KEYS), "left_anti")


def load(store: DataFrame, obj_type: str, obj_id: str) -> DataFrame:
    return store.where((F.col("obj_type") == obj_type) & (F.col("obj_id") == obj_id))


def load_all(store: DataFrame, obj_type: str) -> DataFrame:
    """Typed rows of one class; rows whose JSON does not fit are left out."""
    parsed = store.where(F.col("obj_type") == obj_type).select("obj_id", F.from_json("data", SCHEMAS[obj_type]).alias("d"))
    return parsed.where(F.col("d.id").isNotNull()).select("d.*")


def query(df: DataFrame, **equal: Any) -> DataFrame:
    """Rows in which every named column equals the value (None matches null; a column that is missing counts as null)."""
    out = df
    for name, value in equal.items():
        have = F.col(name) if name in df.columns else F.lit(None)
        out = out.where(have.eqNullSafe(F.lit(value)))
    return out


def count(store: DataFrame, obj_type: str | None = None) -> DataFrame:
    rows = store if obj_type is None else store.where(F.col("obj_type") == obj_type)
    return rows.groupBy("obj_type").agg(F.count("*").alias("objects"))


def list_ids(store: DataFrame, obj_type: str) -> DataFrame:
    return store.where(F.col("obj_type") == obj_type).select("obj_id").distinct()


def id_index(store: DataFrame) -> DataFrame:
    """obj_type, obj_id in long form; the set of a class is a filter on it."""
    return store.select(*KEYS).where(F.col("obj_id").isNotNull()).distinct()


def segments_of(segments: DataFrame, doc_id: str) -> DataFrame:
    return segments.where(F.col("doc_id") == doc_id).orderBy("block_index", "id")


def objects_for_segment(references: DataFrame, segment_id: str) -> DataFrame:
    return references.where((F.col("target_type") == "Segment") & (F.col("target_id") == segment_id) & F.col("obj_type").isin("Entity", "Event", "Claim", "Relation")).select("obj_type", "obj_id").distinct()


def residuals_for_segment(residuals: DataFrame, segment_id: str) -> DataFrame:
    return residuals.where(F.col("segment_id") == segment_id)


def save_validated(store: DataFrame, batch: DataFrame, segments: DataFrame, texts: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(store after the batch, saved keys, violations): rows of the batch (obj_type, obj_id, data, loaded_at) that no error names are saved, the others skipped.

    References resolve within the batch and against the ids of the store and the segments; of an id that stands twice in
    the batch the latest row is meant. Errors name rows by class and id, not by words in a message. Writes the
    typed batch and the violations.
    """
    from . import validate as va

    latest = cut(compact(batch), "batch")
    frames, broken = va.json_rows(latest)
    objects = {k: cut(v, f"batch-{k}") for k, v in frames.items() if k in ("Entity", "Event", "Claim", "Relation", "Residual", "IgnoreSegment")}
    others = {k: v for k, v in frames.items() if k in ("Document", "Block", "CoverageReport")}
    outside = id_index(store).select(F.col("obj_type").alias("type"), F.col("obj_id").alias("id")).unionByName(segments.select(F.lit("Segment").alias("type"), "id")).unionByName(latest.select(F.col("obj_type").alias("type"), F.col("obj_id").alias("id")))
    found = [broken, va.schema({**objects, **others}), va.references(objects, outside), va.evidence(objects, segments, texts), va.self_claims(objects["Claim"])]
    found.append(va.rows_of_rules(va.claim_safety(objects["Claim"], objects["Relation"])))
    violations = cut(va.union(found), "violations")
    bad = violations.where("severity = 'ERROR'").select("obj_type", "obj_id").distinct()
    good = latest.where("obj_type is not null and obj_id is not null").join(bad, list(KEYS), "left_anti")
    return upsert(store, good), good.select(*KEYS), violations


def save(store: DataFrame, path: str) -> None:
    """Write partitioned by class, so that a class filter prunes folders."""
    store.write.mode("overwrite").partitionBy("obj_type").parquet(path)


def open_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(*KEYS, "data", "loaded_at")
