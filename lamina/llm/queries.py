"""The named queries of this package, each with production parameters over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.registry import Registry
from ..runtime import cut, table
from . import chunking, mixing, names, packing, reading, sentences, truncation

query = Registry()


@query("p3_found")
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.truncated(table(spark, sf_dir, "cache_entries"))


@query("p3_rates")
def p3_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.rates(table(spark, sf_dir, "cache_entries"))


@query(
    "p3_reported",
    """with r as (select doc_id, run_id, batches_truncated from pipeline_results where run_id is not null qualify row_number() over (partition by run_id order by loaded_at desc nulls last) = 1),
    e as (select cache_key, doc_id, response.raw_text t, quality.truncated f from cache_entries where cache_key is not null qualify row_number() over (partition by cache_key order by loaded_at desc nulls last) = 1)
    select coalesce(r.doc_id, e.doc_id) doc_id, r.reported, coalesce(e.flagged, 0) flagged, coalesce(e.answers, 0) answers
    from (select doc_id, max(batches_truncated) reported from r where doc_id is not null group by 1) r full join (select doc_id, count(*) filter (coalesce(f, false)) flagged, count(*) filter (length(t) > 0) answers from e where doc_id is not null group by 1) e on e.doc_id = r.doc_id""",
)
def p3_reported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the truncations that its runs and its cache entries report; :func:`truncation.compared` sets them beside those found."""
    return truncation.reported(table(spark, sf_dir, "cache_entries"), table(spark, sf_dir, "pipeline_results"))


@query("p3_compared")
def p3_compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.compared(table(spark, sf_dir, "cache_entries"), table(spark, sf_dir, "pipeline_results"))


@query("p4_found")
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.pairs(names.linked(table(spark, sf_dir, "entities")))


@query("p4_classes")
def p4_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.linked(table(spark, sf_dir, "entities"))


@query(
    "p5_found",
    "with c as (select id, arg_max(text_slice, loaded_at) t from blocks where id is not null group by id) select id as block_id from c where length(t) > 1000",
)
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks that came out of the operator in more than one piece."""
    return chunking.oversized(table(spark, sf_dir, "blocks")).where(F.col("piece") == 1).select("block_id")


@query("p5_pieces")
def p5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.oversized(table(spark, sf_dir, "blocks"))


@query(
    "p5_whole",
    """with c as (select id, arg_max(text_slice, loaded_at) t, arg_max(start_offset, loaded_at) s from blocks where id is not null group by id)
    select id as block_id, sha256(t) as text_hash, length(t) as "length", 0 as too_long, 0 as apart, 0 as too_wide, coalesce(s, 0) as first_offset, coalesce(s, 0) + length(t) as last_offset from c where length(t) > 1000""",
)
def p5_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each cut block put together again from its pieces: hash, faults (too long, a gap or wrong offset, more than the overlap shared) and document offsets."""
    return chunking.joined(chunking.oversized(table(spark, sf_dir, "blocks")), 1000, 100)


@query("p6_found")
def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentences.units(sentences.running_text(table(spark, sf_dir, "blocks"))).select("block_id", "unit_start", "unit_end")


@query("p6_profile")
def p6_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units per block type with their mean length."""
    rows = sentences.running_text(table(spark, sf_dir, "blocks"))
    u = sentences.units(rows)
    return u.join(rows.select(F.col("id").alias("block_id"), "kind"), "block_id").groupBy("kind").agg(F.count("*").alias("units"), F.count_distinct("block_id").alias("blocks"), F.round(F.avg(F.length("text")), 4).alias("mean_length"))


@query("p7_containers")
def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.containers(table(spark, sf_dir, "documents"))


@query("p7_fill")
def p7_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.fills(packing.containers(table(spark, sf_dir, "documents")))


@query("p7_whole", "select (select count(*) from documents where doc_id is not null) as items, 0 as lost, 0 as overfull, 0 as misreported, 0 as divided")
def p7_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items, and faults of the packing: items whose tokens are not all there, containers over capacity or with a wrong fill, items divided without need."""
    stock = cut(packing.sized(table(spark, sf_dir, "documents")), "sized")
    return packing.faults(stock, packing.pack(stock), 2048)


@query("p7_search")
def p7_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers before and after the search, per shard, beside the bound."""
    return packing.search_report(packing.sized(table(spark, sf_dir, "documents")))


@query("p8_drawn")
def p8_drawn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.draw(mixing.supply(table(spark, sf_dir, "documents")), table(spark, sf_dir, "mix_targets"))


@query(
    "p8_kept",
    """select regexp_replace(regexp_replace(lower(source), '^\\s+|\\s+$', '', 'g'), '[\\s\\-]+', '_', 'g') as source, 0 as over_cap, 0 as off_share
    from mix_targets where source is not null and target_share > 0 group by 1""",
)
def p8_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per target source: documents drawn more often than allowed, and whether the share is off by more than one block and one document."""
    stock, targets = mixing.supply(table(spark, sf_dir, "documents")), table(spark, sf_dir, "mix_targets")
    return mixing.faults(stock, mixing.draw(stock, targets), targets)


@query("p8_shares")
def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = table(spark, sf_dir, "mix_targets")
    return mixing.shares(mixing.draw(mixing.supply(table(spark, sf_dir, "documents")), targets), targets)


@query("p8_full_shares")
def p8_full_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of a mix as large as the corpus, where small sources reach their cap and fall short."""
    targets = table(spark, sf_dir, "mix_targets")
    stock = mixing.supply(table(spark, sf_dir, "documents"))
    return mixing.shares(mixing.draw(stock, targets, mixing.corpus_size(stock)), targets)


@query("p9_found")
def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = reading.graded(table(spark, sf_dir, "documents"), table(spark, sf_dir, "reading_labels"))
    return g.where(F.col("lang").isin("en", "zh", "de") & (F.col("chars") >= 200) & (F.col("grade") >= 4)).select("doc_id")


@query("p9_grades")
def p9_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = reading.graded(table(spark, sf_dir, "documents"), table(spark, sf_dir, "reading_labels"))
    return g.select("doc_id", "lang", "grade")


@query("p9_profile")
def p9_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reading.profile(reading.graded(table(spark, sf_dir, "documents"), table(spark, sf_dir, "reading_labels")))
