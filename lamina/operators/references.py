"""Foreign keys of the knowledge tables as one long table, and the joins that run on it.

``refs`` (doc_id, obj_type, obj_id, field, pos, target_type, target_id) is exploded once; existence
checks, coverage, metrics and repair all read it. A field with two possible targets (a claim's
source) has target_type "Entity|Claim".
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ForeignKey:
    obj_type: str
    field: str
    target: str
    literal_allowed: bool = False


FOREIGN_KEYS = (
    ForeignKey("Block", "doc_id", "Document"),
    ForeignKey("Segment", "doc_id", "Document"),
    ForeignKey("Entity", "source_segment_ids", "Segment"),
    ForeignKey("Entity", "evidence_refs.segment_id", "Segment"),
    ForeignKey("Event", "source_segment_ids", "Segment"),
    ForeignKey("Event", "evidence_refs.segment_id", "Segment"),
    ForeignKey("Event", "participants", "Entity"),
    ForeignKey("Claim", "source_segment_ids", "Segment"),
    ForeignKey("Claim", "evidence_refs.segment_id", "Segment"),
    ForeignKey("Claim", "subject", "Entity"),
    ForeignKey("Claim", "object_ref", "Entity", literal_allowed=True),
    ForeignKey("Claim", "derived_from", "Claim"),
    ForeignKey("Claim", "claim_source", "Entity|Claim"),
    ForeignKey("Relation", "subject", "Entity"),
    ForeignKey("Relation", "object_ref", "Entity"),
    ForeignKey("Relation", "claim_id", "Claim"),
    ForeignKey("Relation", "evidence_refs.segment_id", "Segment"),
    ForeignKey("Residual", "segment_id", "Segment"),
    ForeignKey("IgnoreSegment", "segment_id", "Segment"),
)


def is_entity_id(c: F.Column) -> F.Column:
    """A claim's object is a key only if it looks like one; other values are literals."""
    return c.contains("_ent_")


REF = "array<struct<field:string,pos:int,target_id:string,target_type:string>>"


def _keys(k: ForeignKey, df: DataFrame) -> F.Column:
    """The references of one key as an array of (field, pos, target_id, target_type)."""
    kind = df.select(F.col(k.field)).schema[0].dataType.typeName()
    values = F.col(k.field) if kind == "array" else F.array(F.col(k.field))
    wanted = F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda x, i: F.struct(F.lit(k.field).alias("field"), i.alias("pos"), x.cast("string").alias("target_id"), F.lit(k.target).alias("target_type")))
    known = lambda x: x["target_id"].isNotNull() & (is_entity_id(x["target_id"]) if k.literal_allowed else F.lit(True))
    return F.filter(wanted, known)


def refs(objects: dict[str, DataFrame], keys: tuple[ForeignKey, ...] = FOREIGN_KEYS) -> DataFrame:
    """The long table of all references of ``objects`` (class -> frame). Null keys are no references.

    Each class is read once: its keys become one array that is exploded, so only ids and keys are carried.
    """
    out = None
    for name, df in objects.items():
        arrays = [_keys(k, df) for k in keys if k.obj_type == name and k.field.split(".")[0] in df.columns]
        if not arrays:
            continue
        part = df.select("doc_id", F.lit(name).alias("obj_type"), F.col("id").alias("obj_id"), F.explode(F.concat(*arrays)).alias("r")).select("doc_id", "obj_type", "obj_id", "r.field", "r.pos", "r.target_type", "r.target_id")
        out = part if out is None else out.unionByName(part)
    return out.select("doc_id", "obj_type", "obj_id", "field", "pos", "target_type", "target_id")


def ids(objects: dict[str, DataFrame], external: DataFrame | None = None) -> DataFrame:
    """type, id of all objects, with an external index (type, id) merged in."""
    out = None
    for name, df in objects.items():
        part = df.select(F.lit(name).alias("type"), "id")
        out = part if out is None else out.unionByName(part)
    if external is not None:
        out = out.unionByName(external.select("type", "id"))
    return out.where(F.col("id").isNotNull()).distinct()


#: Targets that stand for several classes.
SEVERAL = tuple(sorted({k.target for k in FOREIGN_KEYS if "|" in k.target}))


def dangling(references: DataFrame, index: DataFrame) -> DataFrame:
    """References whose target id exists in none of its target types: one anti-join, as the index also holds its ids under the joint types."""
    joint = F.array(F.col("type"), *[F.when(F.col("type").isin(*t.split("|")), F.lit(t)) for t in SEVERAL])
    known = index.select(F.explode(joint).alias("target_type"), F.col("id").alias("target_id")).where(F.col("target_type").isNotNull())
    return references.join(known, ["target_type", "target_id"], "left_anti").select(*references.columns)


def with_severity(missing: DataFrame, index: DataFrame) -> DataFrame:
    """ERROR where the target type has rows at hand, else WARNING."""
    have = [r.type for r in index.select("type").distinct().collect()]  # at most one row per class
    known = F.lit(False)
    for t in have:
        known = known | F.col("target_type").contains(t)
    return missing.withColumn("severity", F.when(known, "ERROR").otherwise("WARNING"))


def segments_with_objects(segments: DataFrame, references: DataFrame) -> DataFrame:
    """Segments that some semantic object names, by either path."""
    named = references.where(F.col("obj_type").isin("Entity", "Event", "Claim", "Relation") & (F.col("target_type") == "Segment")).select(F.col("target_id").alias("id"))
    return segments.join(named, "id", "left_semi")


def relations_with_claims(relations: DataFrame, claims: DataFrame) -> DataFrame:
    c = claims.select(F.col("id").alias("claim_id"), F.col("modality"), F.col("polarity"), F.col("subject").alias("claim_subject"), F.col("object_ref").alias("claim_object"), F.size(F.coalesce("evidence_refs", F.array())).alias("claim_refs"), F.size(F.coalesce("source_segment_ids", F.array())).alias("claim_segments"), F.lit(True).alias("claim_known"))
    return relations.join(c, "claim_id", "left")


def relation_counts(relations: DataFrame) -> DataFrame:
    return relations.where(F.col("claim_id").isNotNull()).groupBy("claim_id").agg(F.count("*").alias("relations"))


def ignored_segments(ignores: DataFrame, segments: DataFrame, doc_id: str | None = None) -> DataFrame:
    """Ignore markers with the document of their segment."""
    out = ignores.select("id", "segment_id", "reason").join(segments.select(F.col("id").alias("segment_id"), "doc_id"), "segment_id")
    return out if doc_id is None else out.where(F.col("doc_id") == doc_id)
