"""Compositions: texts to verified tables, with or without a model, and a library of texts to packages."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import blocks as bl
from ..operators import candidates as ca
from ..operators import coverage as co
from ..operators import evidence as ev
from ..operators import references as rf
from ..operators import relations as rl
from ..operators import repair as rp
from ..operators import resolve as rs
from ..operators import segments as sg
from ..operators import symbols as sy
from ..operators import validate as va
from ..runtime import cut
from ..schemas import EV
from ..sources import package

Tables = dict[str, DataFrame]


def text_only(texts: DataFrame) -> Tables:
    """Document, Block and Segment tables, written once."""
    blocks = cut(bl.blocks(texts), "blocks")
    docs = bl.with_block_count(bl.documents(texts), blocks)
    return {"Document": cut(docs.withColumn("doc_id", F.col("id")), "documents"), "Block": blocks, "Segment": cut(sg.segments(blocks), "segments")}


def expand(answers: DataFrame, segments: DataFrame) -> Tables:
    """Entity, Event and Claim tables from model answers (doc_id, batch_index, raw_text), with placed evidence and grounded aliases."""
    rows = cut(ca.with_ids(ca.candidates(answers)), "candidates")
    rows = cut(ca.derive_modality(ca.resolve_locals(rows, ca.local_ids(rows)), segments), "candidates")
    placed = ev.place_quotes(ca.quotes_of(rows), segments)
    refs = placed.groupBy(F.col("obj_id").alias("id")).agg(F.sort_array(F.collect_list(F.struct("quote_no", "segment_id", "span_start", "span_end", "quote_hash"))).alias("r"))
    out = rows.join(refs, "id", "left").withColumn("evidence_refs", F.coalesce(F.transform("r", lambda x: F.struct(x["segment_id"].alias("segment_id"), x["span_start"].alias("span_start"), x["span_end"].alias("span_end"), x["quote_hash"].alias("quote_hash"))), F.array().cast(EV)))
    out = cut(out, "expanded")
    sids = F.col("sids").alias("source_segment_ids")
    return {
        "Entity": cut(ca.keep_grounded(out.where("t = 'E'").select("id", "doc_id", "name", "kind", "aliases", "evidence_refs", sids), segments), "grounded"),
        "Event": out.where("t = 'EV'").select("id", "doc_id", "name", "kind", "participants", "event_time", "place", "evidence_refs", sids),
        "Claim": out.where("t = 'C'").select("id", "doc_id", "subject", "predicate", F.col("object").alias("object_ref"), "modality", "polarity", F.lit(1.0).alias("confidence"), F.lit(None).cast("string").alias("claim_source"), F.array().cast("array<string>").alias("derived_from"), "evidence_refs", sids),
    }


def expand_verbose(answers: DataFrame, segments: DataFrame) -> Tables:
    """Entity, Event and Claim tables from verbose answers. Their relations are derived from the claims like all others."""
    tables = ca.verbose_tables(cut(ca.verbose_rows(answers), "verbose"), segments)
    return {k: cut(v, k.lower()) for k, v in tables.items() if k != "Relation"}


def compile_texts(texts: DataFrame, answers: DataFrame | None = None, attempts: int = 2, protocol: str = "compact") -> Tables:
    """All tables of the texts: text layer, resolved and repaired objects, relations, residuals, coverage and violations left."""
    t = text_only(texts)
    if answers is None:
        return t
    segments = t["Segment"]
    objects = expand_verbose(answers, segments) if protocol == "verbose" else expand(answers, segments)
    owners = cut(rs.canonical(objects["Entity"]), "owners")
    entities = cut(rs.merge(objects["Entity"], owners), "entities")
    events = rs.rewrite_array(objects["Event"], owners, "participants")
    claims = rs.rewrite(objects["Claim"], owners, ("subject", "object_ref"))
    claims = cut(claims.where(~F.coalesce(F.col("subject") == F.col("object_ref"), F.lit(False))), "claims")
    relations = rl.derive(claims, entities).drop("claims")
    objects, used = rp.repair_loop({"Entity": entities, "Event": cut(events, "events"), "Claim": claims, "Relation": cut(relations, "relations")}, segments, attempts)
    left = cut(va.validate(objects, segments), "violations")
    refs = cut(rf.refs(objects), "refs")
    residuals = cut(rp.raw_fallback(segments, refs, left).withColumn("reason", F.lit("no structured object")).withColumn("evidence_refs", F.array().cast(EV)), "residuals")
    ignores = texts.sparkSession.createDataFrame([], "id string, segment_id string, reason string")
    status = co.status(segments, refs, objects["Claim"], residuals, ignores)
    return {**t, **objects, "Residual": residuals, "Violation": left, "Coverage": cut(co.reports(status, t["Document"]), "coverage")}


def emit(tables: Tables, target: str) -> DataFrame:
    """Write one package per document below ``target``, a folder that all executors share; package, files, error of each.

    A package is rendered, checked by an import and moved into place by one task, so nothing of the library passes the
    driver. A package that fails leaves its old folder as it was and gives an error; the others are written.
    """
    objects = {k: tables[k] for k in sy.ORDER if k in tables}
    table = cut(sy.assign(objects), "symbols")
    lines = package.rendered(objects, table, rf.refs(objects))
    parts = package.modules(lines).select("package", F.lit("module").alias("what"), F.col("module").alias("key"), F.col("source").alias("value"))
    parts = parts.unionByName(table.select("package", F.lit("symbol").alias("what"), F.col("symbol").alias("key"), F.col("module").alias("value")))
    if "Coverage" in tables:
        parts = parts.unionByName(tables["Coverage"].select(F.col("doc_id").alias("package"), F.lit("coverage").alias("what"), F.lit("").alias("key"), F.to_json(F.struct("*")).alias("value")))

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        doc = pdf["package"].iloc[0]
        of = lambda what: {k: v for w, k, v in zip(pdf["what"], pdf["key"], pdf["value"]) if w == what}
        coverage = of("coverage").get("", "")
        if coverage:
            coverage = "\n".join([package.HEADER, f"from {package.ONTOLOGY} import CoverageReport", "", package.render("CoverageReport", "coverage_report", json.loads(coverage), {}), ""])
        try:
            files, error = package.write_package(of("module"), of("symbol"), os.path.join(target, doc), coverage), None
        except Exception as e:  # one package that fails must not stop the others
            files, error = [], f"{type(e).__name__}: {e}"
        return pd.DataFrame([(doc, ", ".join(files), error)], columns=["package", "files", "error"])

    return cut(parts.where("package is not null").groupBy("package").applyInPandas(write, "package string, files string, error string"), "emitted")


def stop_on_failed(emitted: DataFrame, shown: int = 3) -> None:
    """Raise when a package could not be written, naming at most ``shown``."""
    bad = emitted.where("error is not null").limit(shown).collect()
    if bad:
        raise RuntimeError("; ".join(f"{r.package}: {r.error}" for r in bad))


def summary(tables: Tables) -> str:
    """Counts and coverage as JSON."""
    counts = {k: v.count() for k, v in tables.items() if k not in ("Coverage", "Violation")}
    out: dict = {"objects": counts}
    if "Violation" in tables:
        out["violations"] = {f"{r.gate}/{r.severity}": r.n for r in tables["Violation"].groupBy("gate", "severity").agg(F.count("*").alias("n")).orderBy("gate", "severity").collect()}
    if "Coverage" in tables:
        c = tables["Coverage"].select(F.explode("status_counts").alias("status", "n")).groupBy("status").agg(F.sum("n").alias("n")).orderBy("status").collect()
        out["coverage"] = {r.status: r.n for r in c}
    return json.dumps(out, sort_keys=True)


def verify(spark: SparkSession, folder: str) -> DataFrame:
    """package, check, value: the contract checks of the packages below a folder, missing files and failed imports counted. The folder is read by the executors."""
    sources = package.read_package(spark, folder)
    checks = package.contract(sources.where("module not in ('__init__', 'coverage') and source like '%import%'"))
    names = [p for p in os.listdir(folder) if os.path.isdir(os.path.join(folder, p)) and not p.startswith(".")]

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for p in pdf["package"]:
                have = {n[:-3] for n in os.listdir(os.path.join(folder, p)) if n.endswith(".py")}
                rows.append((p, "missing_files", float(len(set(package.FILES) - have))))
                try:
                    package.import_check(os.path.join(folder, p))
                    failed = 0.0
                except Exception:
                    failed = 1.0
                rows.append((p, "failed_imports", failed))
            yield pd.DataFrame(rows, columns=["package", "check", "value"])

    # file sources pass over names that start with an underscore, so each task lists its folders; the driver knows names only
    listed = spark.createDataFrame([(n,) for n in names], "package string").repartition(max(1, min(len(names), 64)))
    return checks.unionByName(listed.mapInPandas(look, "package string, check string, value double"))


def validate_sources(sources: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """Violations of modules given as text (package, module, source), in the order grammar, schema, identity, reference, evidence, safety. Valid without an ERROR."""
    read = cut(package.parsed(sources), "parsed")
    broken = read.where("error is not null").select(F.col("package").alias("doc_id"), F.lit("grammar").alias("gate"), F.lit("ERROR").alias("severity"), F.lit("").alias("obj_type"), F.col("module").alias("obj_id"), F.lit("").alias("field"), F.col("error").alias("message"))
    frames, misfit = va.json_rows(cut(package.linked(read), "linked").select("obj_type", "obj_id", "data"))
    frames = {k: cut(v, k.lower()) for k, v in frames.items()}
    objects = {k: frames[k] for k in ("Entity", "Event", "Claim", "Relation", "Residual", "IgnoreSegment")}
    others = va.schema({k: frames[k] for k in ("Document", "Block", "CoverageReport")})
    return va.union([broken, misfit, others, va.validate(objects, frames["Segment"], rf.ids({"Document": frames["Document"]}), texts)])


def validate_string(spark: SparkSession, source: str) -> DataFrame:
    """Violations of one module."""
    return validate_sources(spark.createDataFrame([("", "source", source)], "package string, module string, source string"))


def validate_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Violations of the packages below a folder."""
    return validate_sources(package.read_package(spark, folder).where("module not in ('__init__', 'coverage')"))
