"""Quality metrics of a knowledge base, each as a small frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from . import references as rf


def grounding(entities: DataFrame, segments: DataFrame) -> DataFrame:
    """id, doc_id, issues, names: spellings of an entity that its own source segments do not contain.

    An equi-join on the segment comes first; containment is tested on the joined rows only.
    """
    spelled = entities.select("id", "doc_id", F.explode(F.array_distinct(F.filter(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>"))), lambda x: x.isNotNull()))).alias("spelling"))
    named = entities.select("id", F.explode(F.array_distinct("source_segment_ids")).alias("segment_id")).join(segments.select(F.col("id").alias("segment_id"), "text_slice"), "segment_id").select("id", "text_slice")
    hit = spelled.join(named, "id").where(F.col("text_slice").contains(F.col("spelling"))).select("id", "spelling").distinct().withColumn("hit", F.lit(1))
    sourced = named.select("id").distinct().withColumn("sourced", F.lit(1))
    per = spelled.join(hit, ["id", "spelling"], "left").join(sourced, "id", "left").groupBy("id", "doc_id").agg(F.count("*").alias("names"), F.max("sourced").alias("sourced"), F.sum(F.when(F.col("hit").isNull(), 1).otherwise(0)).alias("missing"))
    return per.select("id", "doc_id", F.when(F.col("sourced").isNull(), F.lit(1)).otherwise(F.col("missing")).cast("bigint").alias("issues"), "names")


def grounding_rate(per_entity: DataFrame) -> DataFrame:
    return per_entity.agg(F.sum("issues").alias("issues"), F.sum("names").alias("names"), F.round(1 - F.sum("issues") / F.sum("names"), 6).alias("rate"))


def reference_issues(references: DataFrame, index: DataFrame) -> DataFrame:
    """obj_type, field, total, dangling."""
    missing = rf.dangling(references, index).groupBy("obj_type", "field").agg(F.count("*").alias("dangling"))
    total = references.groupBy("obj_type", "field").agg(F.count("*").alias("total"))
    return total.join(missing, ["obj_type", "field"], "left").select("obj_type", "field", "total", F.coalesce("dangling", F.lit(0)).alias("dangling"))


def event_density(events: DataFrame, segments: DataFrame) -> DataFrame:
    """doc_id, events, segments, density."""
    e = events.groupBy("doc_id").agg(F.count("*").alias("events"))
    s = segments.groupBy("doc_id").agg(F.count("*").alias("segments"))
    return s.join(e, "doc_id", "left").select("doc_id", F.coalesce("events", F.lit(0)).alias("events"), "segments", F.round(F.coalesce("events", F.lit(0)) / F.col("segments"), 6).alias("density"))


def conflicts(entities: DataFrame, scope: str = "work_id") -> DataFrame:
    """Spellings of one scope that several ids claim."""
    spelled = entities.select(scope, "id", F.explode(F.array_distinct(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>"))))).alias("token")).where("token is not null and token <> ''")
    return spelled.groupBy(scope, "token").agg(F.count_distinct("id").alias("ids")).where("ids > 1")


def issues_by(violations: DataFrame) -> DataFrame:
    return violations.groupBy("gate", "severity", "obj_type").agg(F.count("*").alias("issues"))


#: Thresholds of the quality gate. Fixed values.
THRESHOLDS = {"grounding": 0.70, "reference_issues": 10, "conflicts": 5, "coverage": 0.35}


def gate(grounding_value: float, reference_value: int, conflict_value: int, coverage_value: float | None = None) -> list[str]:
    """Names of the thresholds that are missed; coverage is observed only."""
    out = []
    if grounding_value < THRESHOLDS["grounding"]:
        out.append("grounding")
    if reference_value > THRESHOLDS["reference_issues"]:
        out.append("reference_issues")
    if conflict_value > THRESHOLDS["conflicts"]:
        out.append("conflicts")
    return out


def evidence_rate(objects: dict[str, DataFrame]) -> DataFrame:
    """obj_type, objects, with_evidence, rate."""
    out = None
    for name, df in objects.items():
        part = df.agg(F.count("*").alias("objects"), F.coalesce(F.sum((F.size(F.coalesce("evidence_refs", F.array())) > 0).cast("bigint")), F.lit(0)).alias("with_evidence")).withColumn("obj_type", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out.select("obj_type", "objects", "with_evidence", F.round(F.try_divide("with_evidence", "objects"), 6).alias("rate"))


def entropy(df: DataFrame, column: str) -> DataFrame:
    """Shannon entropy (bits) of a column: column, groups, entropy."""
    n = df.groupBy(column).agg(F.count("*").alias("n"))
    p = F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1)))  # as many rows as values of the column
    return n.withColumn("p", p).agg(F.lit(column).alias("measured"), F.count("*").alias("groups"), F.round(F.sum(-F.col("p") * F.log2("p")), 6).alias("entropy"))


def predicates(claims: DataFrame) -> DataFrame:
    return claims.groupBy("predicate").agg(F.count("*").alias("claims"), F.count_distinct("subject").alias("subjects"))


def recall_precision(found: DataFrame, truth: DataFrame, key: str = "name") -> DataFrame:
    """tp, fp, fn, recall, precision of two sets of names."""
    both = found.select(key).distinct().withColumn("f", F.lit(1)).join(truth.select(key).distinct().withColumn("t", F.lit(1)), key, "full")
    n = both.agg(F.count_if(F.col("f").isNotNull() & F.col("t").isNotNull()).alias("tp"), F.count_if(F.col("t").isNull()).alias("fp"), F.count_if(F.col("f").isNull()).alias("fn"))
    return n.select("tp", "fp", "fn", F.round(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), 6).alias("recall"), F.round(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), 6).alias("precision"))


def object_counts(objects: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in objects.items():
        part = df.agg(F.count("*").alias("objects")).select(F.lit(name).alias("obj_type"), "objects")
        out = part if out is None else out.unionByName(part)
    return out


def telemetry(results: DataFrame) -> DataFrame:
    """Tokens and seconds per batch status from pipeline results."""
    rows = results.select("run_id", F.explode("batch_timings").alias("b")).where(F.col("b").isNotNull())
    status = F.substring_index(F.col("b.status"), ":", 1)
    return rows.groupBy(status.alias("status")).agg(F.count("*").alias("batches"), F.sum("b.segment_count").alias("segments"), F.sum("b.object_count").alias("objects"), F.round(F.sum("b.elapsed_sec"), 4).alias("seconds"))


def glossary(recall: DataFrame, issues: DataFrame, statuses: DataFrame, evidence: DataFrame, residuals: DataFrame, claims: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """metric, value: ER and EP (recall and precision of entities), RR (references that resolve), SCR (segments covered or partly), ECR (objects with
    evidence), RD (entropy of residuals by category and importance) and PC (claims whose predicate is in ``vocabulary``). Shares of what is given; null over nothing."""
    row = lambda name, df, value: df.select(F.lit(name).alias("metric"), F.round(value, 6).alias("value"))
    known = claims.join(vocabulary.select("predicate", F.lit(1).alias("_in")), "predicate", "left")
    both = entropy(residuals, "category").unionByName(entropy(residuals, "importance"))
    parts = [
        row("ER", recall, F.col("recall")), row("EP", recall, F.col("precision")),
        row("RR", issues.agg(F.sum("dangling").alias("d"), F.sum("total").alias("t")), 1 - F.col("d") / F.col("t")),
        row("SCR", statuses.agg(F.count_if(F.col("status").isin("covered", "partial")).alias("c"), F.count("*").alias("n")), F.col("c") / F.col("n")),
        row("ECR", evidence.agg(F.sum("with_evidence").alias("w"), F.sum("objects").alias("n")), F.col("w") / F.col("n")),
        row("RD", both.agg(F.sum("entropy").alias("e")), F.col("e")),
        row("PC", known.agg(F.count("_in").alias("k"), F.count("*").alias("n")), F.col("k") / F.col("n")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
