"""The chapter driver: batches of a document asked one after the other, each told what the ones before have named.

Documents run side by side; only the batches of one document depend on each other, so round b asks batch b of every
document in one job. What a round leaves behind is a row per answer and per name, written to the shared folder; the
driver holds nothing but the number of rounds.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import candidates as ca
from ..runtime import cut
from ..sources import model

ANSWERS = "doc_id string, batch_index int, raw_text string, error string, seconds double"
NAMES = "doc_id string, name string, id string, pos bigint"
COUNTERS = "doc_id string, t string, last int"

SCAN_INSTRUCTION = 'List the entities of the text as a JSON array of {"name", "kind", "aliases"}. Answer with the array only.'


def replay(kept: DataFrame, prompts: DataFrame) -> DataFrame:
    """Kept answers (doc_id, batch_index, raw_text) in place of a model; a batch that was not kept is an error row."""
    out = prompts.select("doc_id", "batch_index").join(kept.select("doc_id", "batch_index", "raw_text"), ["doc_id", "batch_index"], "left")
    return out.select("doc_id", "batch_index", "raw_text", F.when(F.col("raw_text").isNull(), "not kept").alias("error"), F.lit(0.0).alias("seconds"))


def _sections(prompts: DataFrame, names: DataFrame, hints: DataFrame | None) -> DataFrame:
    """Prompts with what is known so far, and with the names to look out for."""
    known = ca.known_section(names).groupBy("doc_id").agg(F.array_join(F.sort_array(F.collect_list("line")), "\n").alias("k"))
    out = prompts.join(known, "doc_id", "left")
    text = F.concat("prompt", F.coalesce(F.concat(F.lit("\n\nKnown entities:\n"), "k"), F.lit("")))
    if hints is not None:
        lines = ca.hint_section(hints).groupBy("doc_id").agg(F.array_join(F.sort_array(F.collect_list("line")), "\n").alias("h"))
        out = out.join(lines, "doc_id", "left")
        text = F.concat(text, F.coalesce(F.concat(F.lit("\n\nLook out for:\n"), "h"), F.lit("")))
    return out.select("doc_id", "batch_index", text.alias("prompt"))


def scan(segments: DataFrame, batches: DataFrame, client: model.Client | None = None, kept: DataFrame | None = None) -> DataFrame:
    """doc_id, chunk, name, kind, aliases: attention hints from a first reading of documents of several batches. They get no ids."""
    several = batches.groupBy("doc_id").agg(F.max("batch_index").alias("m")).where("m > 0").select("doc_id")
    prompts = model.batch_prompts(segments, batches.join(several, "doc_id", "left_semi"), SCAN_INSTRUCTION)
    said = replay(kept, prompts) if client is None else model.ask(prompts, client)

    @F.pandas_udf("array<struct<name:string,kind:string,aliases:array<string>>>")
    def names(texts: pd.Series) -> pd.Series:
        return texts.map(ca.scanned_names)

    rows = cut(said.where("raw_text is not null"), "scan").select("doc_id", F.col("batch_index").alias("chunk"), F.explode(names("raw_text")).alias("e"))
    return rows.select("doc_id", "chunk", "e.name", "e.kind", "e.aliases")


def chapters(segments: DataFrame, batches: DataFrame, client: model.Client | None = None, kept: DataFrame | None = None, seeds: DataFrame | None = None, hints: DataFrame | None = None, tries: int = 3, pause: float = 2.0) -> tuple[DataFrame, DataFrame]:
    """(answers, names) of all batches. ``seeds``: doc_id, name, id known before the first batch; ``kept`` answers are used where there is no client.

    A batch that keeps failing leaves an error row and the others go on. The later entity wins a name.
    """
    spark = segments.sparkSession
    names = spark.createDataFrame([], NAMES) if seeds is None else seeds.select("doc_id", "name", "id", F.lit(-1).cast("bigint").alias("pos"))
    counters = spark.createDataFrame([], COUNTERS)
    answers: list[DataFrame] = []
    last = batches.agg(F.max("batch_index").alias("m")).collect()[0].m
    for b in range(-1 if last is None else int(last) + 1):
        prompts = _sections(model.batch_prompts(segments, batches.where(F.col("batch_index") == b), model.INSTRUCTION), names, hints)
        said = cut(replay(kept, prompts) if client is None else model.ask(prompts, client, tries, pause), "answers")
        answers.append(said)
        rows = cut(ca.with_ids(ca.candidates(said), counters), "named")
        fresh = rows.where("t = 'E'").select("doc_id", "id", F.posexplode(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("at", "name"), (F.lit(b).cast("bigint") * 1_000_000 + F.col("raw_index") * 1000).alias("base"))
        fresh = fresh.where("name is not null and name <> ''").select("doc_id", "name", "id", (F.col("base") + F.col("at")).alias("pos"))
        top = names.unionByName(fresh).groupBy("doc_id", "name").agg(F.max(F.struct("pos", "id")).alias("x"))
        names = cut(top.select("doc_id", "name", "x.id", "x.pos"), "names")
        counters = cut(counters.unionByName(ca.greatest(rows)).groupBy("doc_id", "t").agg(F.max("last").alias("last")), "counters")
    out = spark.createDataFrame([], ANSWERS)
    for a in answers:
        out = out.unionByName(a)
    return out, names.select("doc_id", "name", "id")


SECOND_INSTRUCTION = 'These segments are in no object yet. Say for each what it holds, as a JSON array of {"segment_id", "category", "importance", "reason"}.'


def second_pass(open_segments: DataFrame, client: model.Client | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(prompts per document, answers): what a second reading would ask of the segments left open. Without a client nothing is called."""
    line = F.concat(F.lit("["), "id", F.lit("] "), "text_slice")
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block_index", "start_offset", "id", line.alias("line")))), lambda x: x["line"]), "\n")
    prompts = open_segments.where("text_slice is not null").groupBy("doc_id").agg(F.concat(F.lit(SECOND_INSTRUCTION + "\n\n"), body).alias("prompt"), F.count("*").alias("segments")).withColumn("batch_index", F.lit(0))
    return prompts.select("doc_id", "batch_index", "prompt", "segments"), None if client is None else cut(model.ask(prompts, client), "second")
