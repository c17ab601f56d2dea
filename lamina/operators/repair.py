"""Repair by deletion, residuals for what is left, and the keyword classifier of residuals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import cut, release
from . import references as rf
from . import validate as va

#: Words by which a residual is classified, in order of precedence. Fixed values.
DIALOGUE_MARKS = ("「", "」", "『", "』")
SPEECH_WORDS = ("说道", "道：", "笑道", "叹道", "哭道", "骂道", "叫道", "问道", "答道")
HONORIFICS = ("太太", "奶奶", "老爷", "大爷", "姑娘", "小姐", "嫂子", "婶子", "嫂嫂")
DESCRIPTION_WORDS = ("只见", "但见", "原来", "好一个", "果然")

_ARRAYS = {"Entity": ("source_segment_ids",), "Event": ("source_segment_ids", "participants"), "Claim": ("source_segment_ids", "derived_from")}
_SCALARS = {"Claim": ("subject",), "Relation": ("subject", "object_ref", "claim_id"), "Residual": ("segment_id",), "IgnoreSegment": ("segment_id",)}
_TARGET = {(k.obj_type, k.field): k.target for k in rf.FOREIGN_KEYS}


def repair(objects: dict[str, DataFrame], segments: DataFrame, violations: DataFrame) -> dict[str, DataFrame]:
    """One pass: objects with errors of their own go; ids that then point nowhere leave the arrays; objects whose required key points nowhere go too.

    Reference errors alone do not delete an object whose array can be cleaned. Writes the errors, the
    kept objects and their ids, each of which is read several times.
    """
    own = cut(violations.where("severity = 'ERROR' and gate <> 'reference'").select("severity", "obj_type", "obj_id").distinct(), "errors")
    kept = {name: cut(va.accepted(df, name, own), f"kept-{name}") for name, df in objects.items()}
    index = cut(rf.ids({**kept, "Segment": segments}), "ids")
    out = {}
    for name, df in kept.items():
        for c in _ARRAYS.get(name, ()):
            known = index.where(F.col("type") == _TARGET[name, c]).select(F.col("id").alias("_v"))
            parts = df.select("id", F.posexplode(c).alias("pos", "_v")).join(known, "_v", "left_semi").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("pos", "_v"))).alias("_p"))
            cleaned = F.when(F.col(c).isNotNull(), F.coalesce(F.transform("_p", lambda x: x["_v"]), F.array().cast("array<string>")))
            df = df.join(parts, "id", "left").withColumn(c, cleaned).drop("_p")
        for c in _SCALARS.get(name, ()):
            known = index.where(F.col("type") == _TARGET[name, c]).select(F.col("id").alias(c))
            df = df.join(known, c, "left_semi")
        if name == "Claim":
            known = index.where("type = 'Entity'").select(F.col("id").alias("object_ref"), F.lit(True).alias("_known"))
            df = df.join(known, "object_ref", "left").where(F.col("_known").isNotNull() | F.col("object_ref").isNull() | ~rf.is_entity_id(F.col("object_ref"))).drop("_known")
        out[name] = df.select(*kept[name].columns)
    return out


def repair_loop(objects: dict[str, DataFrame], segments: DataFrame, attempts: int = 2) -> tuple[dict[str, DataFrame], int]:
    """Repair until valid, at most ``attempts`` times; (objects, attempts used). Each pass is written and read back."""
    used = 0
    written: dict[str, DataFrame] = {}
    for _ in range(attempts):
        violations = cut(va.validate(objects, segments), "violations")
        if violations.where("severity = 'ERROR'").limit(1).count() == 0:
            break
        fresh = {name: cut(df, f"repair-{name}") for name, df in repair(objects, segments, violations).items()}
        for df in written.values():
            release(df)
        objects = written = fresh
        used += 1
    return objects, used


def _any(c: Column, words: tuple[str, ...]) -> Column:
    return c.rlike("|".join(words))


def classify(text: Column) -> Column:
    """struct(category, importance) of a residual by its text."""
    kind = lambda category, importance: F.struct(F.lit(category).alias("category"), F.lit(importance).alias("importance"))
    short = F.length(text) < 20
    return (
        F.when(_any(text, DIALOGUE_MARKS + SPEECH_WORDS), kind("interpersonal", "high"))
        .when(_any(text, HONORIFICS) & ~short, kind("interpersonal", "high"))
        .when(_any(text, DESCRIPTION_WORDS), kind("stylistic", "medium"))
        .otherwise(kind("structural", "medium"))
    )


def uncovered(segments: DataFrame, references: DataFrame) -> DataFrame:
    """Segments that no object, residual or ignore marker names."""
    named = references.where((F.col("target_type") == "Segment") & (F.col("obj_type") != "Block")).select(F.col("target_id").alias("id"))
    return segments.join(named, "id", "left_anti")


def raw_fallback(segments: DataFrame, references: DataFrame, violations: DataFrame) -> DataFrame:
    """Residuals for segments of rejected objects and for segments nobody names: id, doc_id, segment_id, category, importance."""
    bad = violations.where("severity = 'ERROR'").select("obj_type", "obj_id").distinct()
    named = references.where("target_type = 'Segment'").join(bad, ["obj_type", "obj_id"], "left_semi").select(F.col("target_id").alias("id")).distinct()
    from_errors = segments.join(named, "id", "left_semi").select("id", "doc_id", F.lit("structural").alias("category"), F.lit("high").alias("importance"))
    rest = uncovered(segments, references).join(named, "id", "left_anti")
    c = classify(F.col("text_slice"))
    from_gaps = rest.select("id", "doc_id", c["category"].alias("category"), c["importance"].alias("importance"))
    return from_errors.unionByName(from_gaps).select(F.concat_ws("_", "doc_id", F.lit("res_raw"), "id").alias("id"), "doc_id", F.col("id").alias("segment_id"), "category", "importance")


def second_pass(segments: DataFrame, objects: dict[str, DataFrame], violations: DataFrame | None = None) -> DataFrame:
    """Segments worth another extraction: in no source_segment_ids and no target of a residual or ignore marker; those of rejected objects count as open."""
    keys = tuple(k for k in rf.FOREIGN_KEYS if k.field in ("source_segment_ids", "segment_id"))
    used = rf.refs(objects, keys)
    if violations is not None:
        bad = violations.where("severity = 'ERROR'").select("obj_type", "obj_id").distinct()
        used = used.join(bad, ["obj_type", "obj_id"], "left_anti")
    return segments.join(used.select(F.col("target_id").alias("id")), "id", "left_anti")


#: Parts of warnings that are worth a residual. Fixed values.
FAILURES = ("missing name", "no source segment", "no match", "dangling", "not an entity", "no evidence")


def expansion_warnings(rows: DataFrame, segments: DataFrame, placed: DataFrame) -> DataFrame:
    """doc_id, segment_id, id, warning: what went wrong while candidates were expanded; segment_id is the first known one.

    ``rows``: candidates with ids and resolved local names; ``placed``: obj_id, quote_no of the quotes that were found.
    """
    known = segments.select(F.col("id").alias("sid"))
    own = rows.select("id", F.posexplode("sids").alias("pos", "sid")).join(known, "sid").groupBy("id").agg(F.min(F.struct("pos", "sid")).getField("sid").alias("segment_id"))
    hits = placed.groupBy(F.col("obj_id").alias("id")).agg(F.count_distinct("quote_no").alias("hits"))
    entities = rows.where("t = 'E'").select(F.col("id").alias("_e"))
    out = rows.join(own, "id", "left").join(hits, "id", "left")
    for c in ("subject", "object"):
        out = out.join(entities.select(F.col("_e").alias(c), F.lit(True).alias(f"_{c}")), c, "left")
    parts = rows.where("t = 'EV'").select("id", F.explode("participants").alias("p")).join(entities.withColumnRenamed("_e", "p"), "p", "left_anti").groupBy("id").agg(F.count("*").alias("_lost"))
    out = out.join(parts, "id", "left")
    quotes, found = F.size(F.coalesce("quotes", F.array())), F.coalesce("hits", F.lit(0))
    claim = F.col("t") == "C"
    looks = F.coalesce(F.col("object").contains("_ent_"), F.lit(False))
    checks = F.array(
        F.when(F.col("t").isin("E", "EV") & (F.trim(F.coalesce("name", F.lit(""))) == ""), "missing name"),
        F.when(F.col("segment_id").isNull(), "no source segment"),
        F.when((quotes > 0) & (found < quotes), "no match for a quote"),
        F.when(F.col("_lost") > 0, "dangling participant"),
        F.when(claim & F.col("_subject").isNull(), "subject is not an entity"),
        F.when(claim & looks & F.col("_object").isNull(), "dangling object"),
        F.when(F.col("t").isin("C", "EV") & (found == 0), "no evidence"),
    )
    return out.select("doc_id", "segment_id", "id", F.explode(F.filter(checks, lambda x: x.isNotNull())).alias("warning"))


def failures_to_residuals(warnings: DataFrame) -> DataFrame:
    """Residuals from warnings (doc_id, segment_id, warning): id, doc_id, segment_id, category, importance, reason. Numbered per document."""
    from pyspark.sql import Window

    hit = warnings.where(F.lower("warning").rlike("|".join(FAILURES)))
    more = ["id"] if "id" in warnings.columns else []
    n = F.row_number().over(Window.partitionBy("doc_id").orderBy("segment_id", "warning", *more))
    return hit.withColumn("n", n).select(F.format_string("%s_res_%04d", "doc_id", "n").alias("id"), "doc_id", F.coalesce("segment_id", F.lit("")).alias("segment_id"), F.lit("other").alias("category"), F.lit("medium").alias("importance"), F.col("warning").alias("reason"))
