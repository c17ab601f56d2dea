"""Validation gates: each returns violation rows (doc_id, gate, severity, obj_type, obj_id, field, message).

Later steps join on obj_id; nothing reads the message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import CLOSED, COVERAGE_STATUSES, REQUIRED
from . import evidence as ev
from . import references as rf

COLUMNS = ("doc_id", "gate", "severity", "obj_type", "obj_id", "field", "message")


def _rows(df: DataFrame, gate: str, severity: str | Column, obj_type: str | Column, field: str | Column, message: str | Column, obj_id: str = "id") -> DataFrame:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    doc = F.col("doc_id") if "doc_id" in df.columns else F.lit(None).cast("string")
    return df.select(doc.alias("doc_id"), F.lit(gate).alias("gate"), lit(severity).alias("severity"), lit(obj_type).alias("obj_type"), F.col(obj_id).alias("obj_id"), lit(field).alias("field"), lit(message).alias("message"))


def union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def schema(objects: dict[str, DataFrame]) -> DataFrame:
    """Nulls in required columns and values outside closed sets, one row per error."""
    parts = []
    for name, df in objects.items():
        checks = []
        for c in REQUIRED.get(name, ()):
            if c in df.columns:
                checks.append(F.when(F.col(c).isNull(), F.struct(F.lit(c).alias("field"), F.lit("missing").alias("problem"))))
        for c, allowed in CLOSED.get(name, {}).items():
            checks.append(F.when(F.col(c).isNotNull() & ~F.col(c).isin(*allowed), F.struct(F.lit(c).alias("field"), F.lit("not allowed").alias("problem"))))
        if name == "Claim" and "confidence" in df.columns:
            checks.append(F.when(~F.col("confidence").between(0, 1), F.struct(F.lit("confidence").alias("field"), F.lit("out of range").alias("problem"))))
        if name == "CoverageReport" and "status_counts" in df.columns:
            other = F.exists(F.map_keys("status_counts"), lambda k: ~k.isin(*COVERAGE_STATUSES))
            checks.append(F.when(F.coalesce(other, F.lit(False)), F.struct(F.lit("status_counts").alias("field"), F.lit("not allowed").alias("problem"))))
        if not checks:
            continue
        doc = F.col("doc_id") if "doc_id" in df.columns else F.lit(None).cast("string").alias("doc_id")
        bad = df.select(doc, "id", F.explode(F.filter(F.array(*checks), lambda x: x.isNotNull())).alias("x"))
        parts.append(_rows(bad, "schema", "ERROR", name, F.col("x.field"), F.col("x.problem")))
    return union(parts)


def unknown_types(rows: DataFrame) -> DataFrame:
    """Store rows of a class nobody declared: obj_type, obj_id."""
    from ..schemas import SCHEMAS

    return rows.where(F.col("obj_type").isNull() | ~F.col("obj_type").isin(*SCHEMAS)).select("obj_type", "obj_id")


def unique_ids(objects: dict[str, DataFrame]) -> DataFrame:
    """One error per further occurrence of an id within its class."""
    parts = []
    for name, df in objects.items():
        extra = df.groupBy("id").agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id")).where("n > 1").withColumn("k", F.explode(F.sequence(F.lit(2), F.col("n").cast("int"))))
        parts.append(_rows(extra, "identity", "ERROR", name, "id", "duplicate id"))
    return union(parts)


def references(objects: dict[str, DataFrame], external: DataFrame | None = None) -> DataFrame:
    """Dangling references; an error only where the target class has rows."""
    index = rf.ids(objects, external)
    missing = rf.with_severity(rf.dangling(rf.refs(objects), index), index)
    return _rows(missing, "reference", F.col("severity"), F.col("obj_type"), F.col("field"), F.concat(F.lit("unknown "), F.col("target_id")), "obj_id")


def self_claims(claims: DataFrame) -> DataFrame:
    same = claims.where((F.col("subject") == F.col("object_ref")) & rf.is_entity_id(F.col("subject")))
    return _rows(same, "self_reference", "ERROR", "Claim", "object_ref", "subject and object are the same")


def evidence(objects: dict[str, DataFrame], segments: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """Missing evidence, spans and hashes that do not fit, text layers that cannot be replayed."""
    with_refs = {k: v for k, v in objects.items() if "evidence_refs" in v.columns}
    parts = []
    if "Claim" in objects and "Event" in objects:
        parts.append(_rows(ev.without_evidence(objects["Claim"], objects["Event"]), "evidence", "ERROR", F.col("obj_type"), "evidence_refs", "no evidence", "obj_id"))
    parts.append(_rows(ev.broken_spans(ev.exploded(with_refs), segments), "evidence", "ERROR", F.col("obj_type"), "evidence_refs", F.col("problem"), "obj_id"))
    parts.append(_rows(ev.wrong_hashes(segments), "evidence", "ERROR", "Segment", "hash", "hash differs"))
    if texts is not None:
        from .blocks import stale_slices

        stale = stale_slices(segments, texts).where("problem <> 'hash differs'")
        parts.append(_rows(stale, "evidence", F.when(F.col("problem") == "no raw text", "WARNING").otherwise("ERROR"), "Segment", "text_slice", F.col("problem")))
    return union(parts)


#: Rule name, modalities, polarity that must not have a relation.
_FORBIDDEN = (
    ("no_asserted_from_reported", ("reported",), "positive"),
    ("no_asserted_from_claimed", ("claimed_by_source",), "positive"),
    ("no_uncertain_default_fact", ("uncertain", "hypothetical"), None),
    ("no_unconditional_from_conditional", ("conditional",), None),
    ("no_positive_from_negative", None, "negative"),
)


def claim_safety(claims: DataFrame, relations: DataFrame, only_with_relations: bool = False) -> DataFrame:
    """Claims that must not have become facts: id, doc_id, rule.

    ``only_with_relations`` skips every rule where there is no relation at all, as older pipelines do.
    """
    c = claims.join(rf.relation_counts(relations).withColumnRenamed("claim_id", "id"), "id", "left").withColumn("relations", F.coalesce("relations", F.lit(0)))
    rules = [F.when((F.col("modality") == "inferred") & (F.size(F.coalesce("derived_from", F.array())) == 0), "inferred_requires_source")]
    for name, modalities, polarity in _FORBIDDEN:
        hit = F.col("relations") > 0
        if modalities:
            hit = hit & F.col("modality").isin(*modalities)
        if polarity:
            hit = hit & (F.col("polarity") == polarity)
        rules.append(F.when(hit, name))
    out = c.select("id", "doc_id", F.explode(F.filter(F.array(*rules), lambda x: x.isNotNull())).alias("rule"))
    if only_with_relations:
        out = out.join(relations.limit(1).select(F.lit(1).alias("_any")), F.lit(True), "left_semi")
    return out


def rows_of_rules(broken: DataFrame) -> DataFrame:
    """Violations of the rules that :func:`claim_safety` found broken."""
    return _rows(broken, "claim_safety", "ERROR", "Claim", "modality", F.col("rule"))


def coverage(statuses: DataFrame) -> DataFrame:
    """Documents with uncovered segments, as warnings. ``statuses``: doc_id, status."""
    n = statuses.where("status = 'uncovered'").groupBy("doc_id").agg(F.count("*").alias("n")).withColumn("id", F.col("doc_id"))
    return _rows(n, "coverage", "WARNING", "Document", "coverage", F.concat(F.col("n").cast("string"), F.lit(" uncovered segments")))


def validate(objects: dict[str, DataFrame], segments: DataFrame, external: DataFrame | None = None, texts: DataFrame | None = None) -> DataFrame:
    """All gates. The set is valid when no row has severity ERROR."""
    everything = {**objects, "Segment": segments}
    parts = [schema(everything), unique_ids(everything), references(everything, external), evidence(objects, segments, texts)]
    if "Claim" in objects:
        parts.append(self_claims(objects["Claim"]))
        if "Relation" in objects:
            parts.append(rows_of_rules(claim_safety(objects["Claim"], objects["Relation"])))
    return union(parts)


def accepted(df: DataFrame, obj_type: str, violations: DataFrame) -> DataFrame:
    """Rows of one class that no error names."""
    bad = violations.where((F.col("severity") == "ERROR") & (F.col("obj_type") == obj_type)).select(F.col("obj_id").alias("id"))
    return df.join(bad, "id", "left_anti")


def json_rows(rows: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """Typed frames by class and the violations of the grammar, from store rows (obj_type, obj_id, data).

    What is not JSON, or has no declared class, or whose JSON does not fit the class, is a violation and in no frame.
    """
    from ..schemas import SCHEMAS

    frames, parts = {}, []
    ids = F.coalesce(F.col("obj_id"), F.lit("?"))
    unknown = rows.where(F.col("obj_type").isNull() | ~F.col("obj_type").isin(*SCHEMAS))
    parts.append(_rows(unknown.select(F.lit(None).cast("string").alias("doc_id"), "obj_type", ids.alias("id")), "grammar", "ERROR", F.coalesce("obj_type", F.lit("")), "", "unknown type"))
    for name, ddl in SCHEMAS.items():
        own = rows.where(F.col("obj_type") == name).select("obj_id", F.from_json("data", ddl + ", _broken string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}).alias("d"))
        fits = F.col("d").isNotNull() & F.col("d._broken").isNull() & F.col("d.id").isNotNull()
        parts.append(_rows(own.where(~fits).select(F.col("d.doc_id") if "doc_id string" in ddl else F.lit(None).cast("string").alias("doc_id"), ids.alias("id")), "grammar", "ERROR", name, "data", "does not fit the class"))
        frames[name] = own.where(fits).select("d.*").drop("_broken")
    return frames, union(parts)


class ValidationFailed(ValueError):
    """Raised by :func:`stop_on_errors`."""


def stop_on_errors(violations: DataFrame, shown: int = 3) -> None:
    """Raise when there is any error, naming at most ``shown``."""
    rows = violations.where("severity = 'ERROR'").limit(shown).collect()
    if rows:
        raise ValidationFailed("; ".join(f"{r.gate}: {r.obj_type} {r.obj_id}: {r.message}" for r in rows))
