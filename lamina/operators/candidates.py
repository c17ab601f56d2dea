"""Candidate source: batches of segments, prompt lines, and the expansion of compact JSON candidates.

A compact candidate is an object with ``t`` (E, EV, C), ``lid``, ``n``, ``k``, ``a``, ``sid``, ``q``, ``s``, ``p``,
``o``, ``m``, ``pol``. Parsing is a Python kernel because texts are broken in many ways; everything
after it is relational.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions.text import strip
from ..schemas import MODALITIES, POLARITIES

TYPES = ("E", "EV", "C")
WRAPPERS = ("candidates", "results", "data", "items")

# ------------------------------------------------------------------ batching and prompts


def batch_numbers(lengths: list[int], limit: int = 4000) -> list[int]:
    """Greedy batches in order; one that is too long alone is a batch of its own."""
    if sum(lengths) <= limit:
        return [0] * len(lengths)
    out, batch, used = [], 0, 0
    for n in lengths:
        if used and used + n > limit:
            batch += 1
            used = 0
        out.append(batch)
        used += n
    return out


def batches(segments: DataFrame, limit: int = 4000) -> DataFrame:
    """doc_id, id, batch_index: a running sum that restarts, folded over the lengths of a document in order."""

    @F.pandas_udf("array<int>")
    def fold(lengths: pd.Series) -> pd.Series:
        return lengths.map(lambda x: batch_numbers([int(n) for n in x], limit))

    per = segments.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("block_index", "start_offset", "id", F.length("text_slice").alias("n")))).alias("s"))
    numbered = per.select("doc_id", "s", fold(F.transform("s", lambda x: x["n"])).alias("b"))
    return numbered.select("doc_id", F.explode(F.arrays_zip(F.transform("s", lambda x: x["id"]).alias("id"), F.col("b").alias("batch_index"))).alias("z")).select("doc_id", "z.id", "z.batch_index")


def is_noise(text: Column) -> Column:
    """Empty, or under 3 characters without an end mark, or a short line with a question mark in it."""
    t = strip(text)
    return text.isNull() | (t == "") | ((F.length(t) < 3) & ~t.rlike("[。！？.!?]$")) | (t.contains("?") & (F.length(t) < 10))


def prompt_lines(segments: DataFrame) -> DataFrame:
    """doc_id, prompt: the clean segments as ``[id|type] text``, blocks set apart by an empty line."""
    clean = segments.where(~is_noise(F.col("text_slice")))
    order = Window.partitionBy("doc_id").orderBy("block_index", "start_offset", "id")
    line = F.concat(F.lit("["), "id", F.lit("|"), F.coalesce("segment_type", F.lit("")), F.lit("] "), "text_slice")
    gap = F.when(F.lag("block_index").over(order) != F.col("block_index"), F.concat(F.lit("\n"), line)).otherwise(line)
    rows = clean.withColumn("n", F.row_number().over(order)).withColumn("line", gap)
    return rows.groupBy("doc_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "line"))), lambda x: x["line"]), "\n").alias("prompt"))


def known_section(entity_map: DataFrame) -> DataFrame:
    """doc_id, id, line: one line per known id with its first name and further names. ``entity_map``: doc_id, name, id, pos."""
    per = entity_map.groupBy("doc_id", "id").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "name"))), lambda x: x["name"]).alias("names"))
    rest = F.slice("names", 2, 1_000_000)
    return per.select("doc_id", "id", F.when(F.size(rest) > 0, F.concat(F.lit("- "), "id", F.lit(" "), F.col("names")[0], F.lit(" (also "), F.array_join(rest, ", "), F.lit(")"))).otherwise(F.concat(F.lit("- "), "id", F.lit(" "), F.col("names")[0])).alias("line"))


def hint_section(hints: DataFrame) -> DataFrame:
    """doc_id, line of each attention hint (name, kind, aliases); the first chunk that names somebody wins."""
    first = hints.groupBy("doc_id", "name").agg(F.min(F.struct("chunk", "kind", "aliases")).alias("h"))
    also = F.array_join(F.coalesce(F.col("h.aliases"), F.array().cast("array<string>")), ", ")
    return first.select("doc_id", "name", F.concat(F.lit("- "), "name", F.lit(" ("), F.coalesce("h.kind", F.lit("")), F.lit(")"), F.when(also != "", F.concat(F.lit(", also "), also)).otherwise("")).alias("line"))


# ------------------------------------------------------------------ parsing

_FENCE = re.compile(r"\A\s*```[a-zA-Z]*\s*\n?|\n?\s*```\s*\Z")


def without_fence(text: str) -> str:
    return _FENCE.sub("", text).strip()


def complete_objects(text: str) -> list[dict]:
    """Every complete {...} of a broken text that has ``t`` and one of ``n`` and ``sid``."""
    return [x for x in balanced_objects(text) if "t" in x and ("n" in x or "sid" in x)]


def parse(text: str | None) -> tuple[list[dict], bool]:
    """(candidate objects, whether they had to be recovered)."""
    if not text:
        return [], False
    body = without_fence(text)
    tries = [body]
    lo, hi = body.find("["), body.rfind("]")
    if 0 <= lo < hi:
        tries.append(body[lo : hi + 1])
    for t in tries:
        try:
            v = json.loads(t)
        except (ValueError, RecursionError):
            continue
        if isinstance(v, dict):
            v = next((v[w] for w in WRAPPERS if isinstance(v.get(w), list)), [v])
        if isinstance(v, list):
            return [x for x in v if isinstance(x, dict)], False
    found = complete_objects(body)
    return found, bool(found)


_COMMENT = re.compile(r"(?m)(?<![:\"'\w/])//[^\n]*$")


def balanced_objects(text: str) -> list[dict]:
    """Every outermost {...} that parses, from a text that was cut or has prose around it."""
    out: list[dict] = []
    decoder = json.JSONDecoder()
    at = text.find("{")
    while at >= 0:
        try:
            x, end = decoder.raw_decode(text, at)
            out.append(x)
        except (ValueError, RecursionError):
            end = at + 1
        at = text.find("{", end)
    return out


def verbose_objects(text: str | None) -> list[tuple[str, dict]]:
    """(class, data) of a verbose answer: objects with their class in ``type``, their data flat or under ``data``; cut answers give their complete objects."""
    if not text:
        return []
    body = _COMMENT.sub("", without_fence(text))
    lo, hi = body.find("["), body.rfind("]")
    try:
        found = json.loads(body[lo : hi + 1]) if 0 <= lo < hi else [json.loads(body)]
    except (ValueError, RecursionError):
        found = balanced_objects(body)
    out = []
    for x in found if isinstance(found, list) else []:
        if isinstance(x, dict) and isinstance(x.get("type"), str):
            data = x.get("data")
            out.append((x["type"], data if isinstance(data, dict) else {k: v for k, v in x.items() if k != "type"}))
    return out


def scanned_names(text: str | None) -> list[dict]:
    """Entities of a pre-scan answer: name, kind, aliases; the first of a name wins."""
    body = _COMMENT.sub("", without_fence(text or ""))
    lo, hi = body.find("["), body.rfind("]")
    try:
        found = json.loads(body[lo : hi + 1]) if 0 <= lo < hi else []
    except (ValueError, RecursionError):
        found = balanced_objects(body)
    out: dict[str, dict] = {}
    for x in found if isinstance(found, list) else []:
        if isinstance(x, dict) and isinstance(x.get("name"), str) and x["name"].strip():
            out.setdefault(x["name"], {"name": x["name"], "kind": x.get("kind") if isinstance(x.get("kind"), str) else "", "aliases": _strings(x.get("aliases"))})
    return list(out.values())


def _strings(v: object) -> list[str]:
    return [v] if isinstance(v, str) else [x for x in v if isinstance(x, str)] if isinstance(v, list) else []


def _text(v: object) -> str | None:
    return v if v is None or isinstance(v, str) else str(v)


def _only_text(v: object) -> str | None:
    return v if isinstance(v, str) else None


def _array(v: object) -> list[str]:
    return _strings(v) if isinstance(v, list) else []


#: Column -> (key, rule, value of an absent key) of each class; what is not named here is null.
_COMMON = {"lid": ("lid", _text, None), "sids": ("sid", _strings, None), "quotes": ("q", _strings, None)}
_RULES = {
    "E": {**_COMMON, "name": ("n", lambda v: _only_text(v) or "", None), "kind": ("k", _text, "other"), "aliases": ("a", _array, None)},
    "EV": {**_COMMON, "name": ("n", lambda v: _only_text(v) or "", None), "kind": ("k", _text, "other"), "participants": ("p", _strings, None), "event_time": ("time", _only_text, None), "place": ("location", _only_text, None)},
    "C": {**_COMMON, "subject": ("s", _only_text, None), "predicate": ("p", _only_text, None), "object": ("o", _text, None), "modality": ("m", lambda v: v if v in MODALITIES else None, None), "polarity": ("pol", lambda v: v if v in POLARITIES else "positive", "positive")},
}
#: Warning -> (class, condition on the candidate and its columns).
_CHECKS = (
    ("missing name", ("E", "EV"), lambda x, row: not row["name"].strip()),
    ("unknown modality", ("C",), lambda x, row: x.get("m") is not None and row["modality"] is None),
    ("unknown polarity", ("C",), lambda x, row: x.get("pol", "positive") != row["polarity"]),
)


def coerce(x: dict) -> dict | None:
    """One candidate with the types its columns need, and warnings; None where it has no type."""
    t = x.get("t")
    if not isinstance(t, str):
        return None
    row: dict = {c.split()[0]: None for c in CANDIDATE.split(", ")} | {"t": t, "sids": [], "quotes": [], "warnings": []}
    if t not in _RULES:
        return row | {"warnings": ["unknown type"]}
    row |= {column: rule(x.get(key, default)) for column, (key, rule, default) in _RULES[t].items()}
    row["warnings"] = [name for name, classes, broken in _CHECKS if t in classes and broken(x, row)]
    return row


CANDIDATE = "t string, lid string, name string, kind string, aliases array<string>, sids array<string>, quotes array<string>, participants array<string>, subject string, predicate string, object string, modality string, polarity string, event_time string, place string, warnings array<string>"


def candidates(answers: DataFrame) -> DataFrame:
    """doc_id, batch_index, raw_index, recovered and the columns of CANDIDATE. ``answers``: doc_id, batch_index, raw_text."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["doc_id", "batch_index", "raw_index", "recovered", *[c.split()[0] for c in CANDIDATE.split(", ")]]
        for pdf in it:
            rows = []
            for doc, b, text in zip(pdf["doc_id"], pdf["batch_index"], pdf["raw_text"]):
                found, recovered = parse(text)
                for i, x in enumerate(found):
                    row = coerce(x)
                    if row:
                        rows.append((doc, b, i, recovered, *row.values()))
            yield pd.DataFrame(rows, columns=names)

    return answers.where(F.col("raw_text").isNotNull()).select("doc_id", "batch_index", "raw_text").mapInPandas(run, f"doc_id string, batch_index int, raw_index int, recovered boolean, {CANDIDATE}")


# ------------------------------------------------------------------ expansion

_PREFIX = {"E": "ent", "EV": "evt", "C": "clm"}


def with_ids(rows: DataFrame, counters: DataFrame | None = None) -> DataFrame:
    """Candidates with ``id``: {doc}_{ent,evt,clm}_{n:04d}, numbered per document in batch and array order, behind ``counters`` (doc_id, t, last)."""
    n = F.row_number().over(Window.partitionBy("doc_id", "t").orderBy("batch_index", "raw_index"))
    rows = rows.where(F.col("t").isin(*TYPES))
    if counters is not None:
        rows = rows.join(counters.select("doc_id", "t", F.col("last").alias("_last")), ["doc_id", "t"], "left")
        n = n + F.coalesce("_last", F.lit(0))
    prefix = F.element_at(F.create_map(*[F.lit(x) for kv in _PREFIX.items() for x in kv]), F.col("t"))
    return rows.withColumn("id", F.format_string("%s_%s_%04d", "doc_id", prefix, n)).drop("_last")


def greatest(rows: DataFrame) -> DataFrame:
    """doc_id, t, last: the greatest number given to each kind of candidate."""
    return rows.groupBy("doc_id", "t").agg(F.max(F.substring_index("id", "_", -1).try_cast("int")).alias("last"))


def local_ids(rows: DataFrame) -> DataFrame:
    """doc_id, batch_index, lid, entity_id: a local name that is given twice means the later entity."""
    e = rows.where("t = 'E' and lid is not null")
    return e.groupBy("doc_id", "batch_index", "lid").agg(F.max(F.struct("raw_index", "id")).alias("x")).select("doc_id", "batch_index", "lid", F.col("x.id").alias("entity_id"))


def resolve_locals(rows: DataFrame, locals_: DataFrame) -> DataFrame:
    """Subject, object and participants by entity id; unknown names pass through."""
    out = rows
    for c in ("subject", "object"):
        m = locals_.select("doc_id", "batch_index", F.col("lid").alias(c), F.col("entity_id").alias("_to"))
        out = out.join(m, ["doc_id", "batch_index", c], "left").withColumn(c, F.coalesce("_to", c)).drop("_to")
    parts = out.select("id", "doc_id", "batch_index", F.posexplode("participants").alias("pos", "lid"))
    named = parts.join(locals_, ["doc_id", "batch_index", "lid"], "left").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("pos", F.coalesce("entity_id", "lid").alias("v")))).alias("_p"))
    return out.join(named, "id", "left").withColumn("participants", F.when(F.col("_p").isNotNull(), F.transform("_p", lambda x: x["v"])).otherwise(F.col("participants"))).drop("_p")


#: Segments of these types report what somebody says. Fixed values.
REPORTING = ("dialogue", "heading", "list_item", "table_row")


def derive_modality(rows: DataFrame, segments: DataFrame) -> DataFrame:
    """Claims without a modality: ``reported`` if a source segment is dialogue, heading, list or table, else ``asserted``."""
    open_ = rows.where("t = 'C' and modality is null")
    kinds = open_.select("id", F.explode("sids").alias("sid")).join(segments.select(F.col("id").alias("sid"), "segment_type"), "sid").groupBy("id").agg(F.bool_or(F.col("segment_type").isin(*REPORTING)).alias("_rep"))
    out = rows.join(kinds, "id", "left")
    return out.withColumn("modality", F.when((F.col("t") == "C") & F.col("modality").isNull(), F.when(F.coalesce("_rep", F.lit(False)), "reported").otherwise("asserted")).otherwise(F.col("modality"))).drop("_rep")


def quotes_of(rows: DataFrame) -> DataFrame:
    """obj_id, quote_no, quote, segment_id: every quote of an object with every segment it names."""
    q = rows.select(F.col("id").alias("obj_id"), "sids", F.posexplode("quotes").alias("quote_no", "quote"))
    return q.select("obj_id", "quote_no", "quote", F.explode("sids").alias("segment_id"))


def warnings_of(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "batch_index", "raw_index", "t", F.explode("warnings").alias("warning"))


# ------------------------------------------------------------------ ids and aliases of verbose answers


def fix_prefixes(entities: DataFrame, wrong: str = "_char_", right: str = "_ent_") -> DataFrame:
    """id, fixed_id of the entities whose id has the wrong prefix; references follow by a join on it."""
    return entities.where(F.col("id").contains(wrong)).select("id", F.replace("id", F.lit(wrong), F.lit(right)).alias("fixed_id"))


#: Columns of verbose objects that name other objects.
_NAMES_OTHERS = {"Event": ("participants",), "Claim": ("subject", "object_ref", "claim_source"), "Relation": ("subject", "object_ref", "claim_id")}
_EVIDENCE = "array<struct<segment_id:string,start:int,end:int,quote_hash:string>>"
_VERBOSE = {
    "Entity": f"id string, name string, kind string, aliases array<string>, evidence_refs {_EVIDENCE}, source_segment_ids array<string>",
    "Event": f"id string, name string, kind string, participants array<string>, time string, location string, evidence_refs {_EVIDENCE}, source_segment_ids array<string>",
    "Claim": f"id string, subject string, predicate string, object string, modality string, polarity string, confidence double, source string, derived_from array<string>, evidence_refs {_EVIDENCE}, source_segment_ids array<string>",
    "Relation": f"id string, subject string, predicate string, object string, claim_id string, evidence_refs {_EVIDENCE}",
}
_RENAMED = {"object": "object_ref", "source": "claim_source", "time": "event_time", "location": "place"}
_SHORT = {"Entity": "ent", "Event": "evt", "Claim": "clm", "Relation": "rel"}


def verbose_rows(answers: DataFrame) -> DataFrame:
    """doc_id, batch_index, raw_index, obj_type, data (JSON) of verbose answers (doc_id, batch_index, raw_text); of cut ones their complete objects."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            rows = [(doc, b, i, t, json.dumps(x, ensure_ascii=False)) for doc, b, text in zip(pdf["doc_id"], pdf["batch_index"], pdf["raw_text"]) for i, (t, x) in enumerate(verbose_objects(text))]
            yield pd.DataFrame(rows, columns=["doc_id", "batch_index", "raw_index", "obj_type", "data"])

    return answers.where(F.col("raw_text").isNotNull()).select("doc_id", "batch_index", "raw_text").mapInPandas(run, "doc_id string, batch_index int, raw_index int, obj_type string, data string")


def verbose_tables(rows: DataFrame, segments: DataFrame) -> dict[str, DataFrame]:
    """Entity, Event, Claim and Relation tables of verbose objects: wrong prefixes put right with all that refers to them, missing ids given, aliases grounded.

    ``rows``: from :func:`verbose_rows`. Classes that are not declared are left out.
    """
    from . import resolve as rs

    out: dict[str, DataFrame] = {}
    for name, ddl in _VERBOSE.items():
        own = rows.where(F.col("obj_type") == name).select("doc_id", F.struct("batch_index", "raw_index").alias("pos"), F.from_json("data", ddl).alias("d")).where("d is not null").select("doc_id", "pos", "d.*")
        for a, b in _RENAMED.items():
            if a in own.columns:
                own = own.withColumnRenamed(a, b)
        if "modality" in own.columns:
            own = own.withColumn("confidence", F.coalesce("confidence", F.lit(1.0))).withColumn("derived_from", F.coalesce("derived_from", F.array().cast("array<string>")))
        refs = F.transform(F.coalesce("evidence_refs", F.array().cast(_EVIDENCE)), lambda e: F.struct(e["segment_id"].alias("segment_id"), e["start"].alias("span_start"), e["end"].alias("span_end"), e["quote_hash"].alias("quote_hash")))
        own = own.withColumn("evidence_refs", refs).withColumn("id", F.when(F.trim("id") != "", F.col("id")))
        out[name] = missing_ids(own, _SHORT[name]) if name != "Entity" else own
    fixes = fix_prefixes(out["Entity"]).select("id", F.col("fixed_id").alias("canonical_id")).distinct()
    out["Entity"] = missing_ids(rs.rewrite(out["Entity"], fixes, ("id",)), "ent")
    for name, cols in _NAMES_OTHERS.items():
        for c in cols:
            out[name] = rs.rewrite_array(out[name], fixes, c) if c == "participants" else rs.rewrite(out[name], fixes, (c,))
    out = {name: df.drop("pos") for name, df in out.items()}
    out["Entity"] = keep_grounded(out["Entity"], segments)
    return out


def missing_ids(rows: DataFrame, prefix: str) -> DataFrame:
    """Rows without an id numbered behind the greatest number of their document. ``rows``: doc_id, id, pos."""
    top = F.coalesce(F.max(F.substring_index("id", "_", -1).try_cast("int")).over(Window.partitionBy("doc_id")), F.lit(0))
    n = F.sum(F.col("id").isNull().cast("int")).over(Window.partitionBy("doc_id").orderBy("pos"))
    return rows.withColumn("id", F.coalesce("id", F.format_string(f"%s_{prefix}_%04d", "doc_id", top + n)))


def greatest_numbers(ids: DataFrame) -> DataFrame:
    """doc_id, obj_type, last: the greatest number in the ids of each class."""
    return ids.groupBy("doc_id", "obj_type").agg(F.max(F.substring_index("id", "_", -1).try_cast("int")).alias("last"))


def ground_aliases(entities: DataFrame, segments: DataFrame) -> DataFrame:
    """id, alias, segment_id: the first segment of the document, own ones first, that holds the alias. Aliases found nowhere are left out.

    An equi-join on the document bounds the containment test to its segments.
    """
    a = entities.select("id", "doc_id", "source_segment_ids", F.explode(F.array_distinct("aliases")).alias("alias")).where("alias is not null and alias <> ''")
    s = segments.select("doc_id", F.col("id").alias("segment_id"), "block_index", "start_offset", "text_slice")
    hit = a.join(s, "doc_id").where(F.col("text_slice").contains(F.col("alias")))
    own = F.when(F.array_contains("source_segment_ids", F.col("segment_id")), 0).otherwise(1)
    return hit.groupBy("id", "alias").agg(F.min(F.struct(own.alias("k"), "block_index", "start_offset", "segment_id")).alias("x")).select("id", "alias", F.col("x.segment_id").alias("segment_id"))


def keep_grounded(entities: DataFrame, segments: DataFrame) -> DataFrame:
    """``entities`` without the aliases that no segment of their document holds, and with the segments that hold the others.

    An alias may also stand in the source segments taken together (joined by a space).
    """
    text = segments.select("doc_id", F.col("id").alias("segment_id"), "text_slice")
    own = entities.select("id", "doc_id", F.posexplode("source_segment_ids").alias("pos", "segment_id")).join(text, ["doc_id", "segment_id"])
    own = own.groupBy("id").agg(F.concat_ws(" ", F.transform(F.sort_array(F.collect_list(F.struct("pos", "text_slice"))), lambda x: x["text_slice"])).alias("_own"))
    found = ground_aliases(entities, segments).groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("alias", "segment_id"))).alias("_found"))

    def within(a: F.Column) -> F.Column:
        return F.coalesce("_own", F.lit("")).contains(a)

    def place(a: F.Column) -> F.Column:
        return F.try_element_at("_found", a)

    sids = F.coalesce("source_segment_ids", F.array().cast("array<string>"))
    more = F.filter(F.transform(F.filter("aliases", lambda a: ~within(a)), place), lambda x: x.isNotNull())
    kept = F.filter("aliases", lambda a: within(a) | place(a).isNotNull())
    out = entities.join(own, "id", "left").join(found, "id", "left")
    out = out.withColumn("source_segment_ids", F.when(F.col("aliases").isNull(), F.col("source_segment_ids")).otherwise(F.concat(sids, F.array_except(more, sids))))
    return out.withColumn("aliases", kept).select(*entities.columns)


def entity_map(entities: DataFrame) -> DataFrame:
    """doc_id, name, id: every name and alias; the later entity wins."""
    spelled = entities.select("doc_id", "id", F.explode(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("name")).where("name is not null and name <> ''")
    return spelled.groupBy("doc_id", "name").agg(F.max("id").alias("id"))
