"""Sources mixed to target weights along a low-discrepancy schedule.

Method. The output is a sequence of slots, each a block of ``block_tokens`` tokens of one source.
Slot k goes to the source in whose cumulative weight interval the golden-ratio point
frac((k + 1/2) * phi) falls, so every stretch of the sequence holds the target shares. Slots are
ranked per source; the documents of a source are shuffled by a hash (anew for each repeat), laid
end to end and cut into equal-token blocks (a document belongs to the block its middle falls in);
block r of a source is joined to its slot of rank r.

Running sums and ranks are built in two levels (per bucket, then over the few buckets), so a source
that holds a third of all rows is spread over many tasks.

The total is by default the largest at which every source with documents can meet its share
within ``max_repeats``; a larger total fills sources up to their cap and the report shows by how
much they fall short.

Defined cases: source names are compared in lower case with blanks and hyphens as underscores;
documents without a source or a target, null and empty texts are not drawn; sources without
documents are reported with share 0 and the other shares are scaled to 1; a null max_repeats
means 1; targets named twice are added up (the larger cap holds); empty tables give no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..runtime import cut
from . import tokens

#: Fractional part of the golden ratio in steps of 2**-53. Fixed value.
PHI = round((math.sqrt(5) - 1) / 2 * 2**53) / 2**53
BUCKET_DOCS = 20_000
BUCKET_SLOTS = 65_536


def source_name(c: Column) -> Column:
    """Null where the name is null or blank."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(c), r"(?U)^\s+|\s+$", ""), r"(?U)[\s\-]+", "_")
    return F.when(plain != "", plain)


def wanted(targets: DataFrame) -> DataFrame:
    """source, share, repeats, one row per source with a positive share."""
    t = targets.select(source_name(F.col("source")).alias("source"), F.col("target_share").cast("double").alias("share"), F.coalesce(F.col("max_repeats"), F.lit(1)).alias("repeats"))
    return t.where("source is not null and share > 0").groupBy("source").agg(F.sum("share").alias("share"), F.max("repeats").alias("repeats"))


def supply(documents: DataFrame, vocabulary: str = tokens.VOCABULARY) -> DataFrame:
    """doc_id, source, tokens (> 0) of the documents that may be drawn, written once."""
    known = documents.select("doc_id", source_name(F.col("source")).alias("source"), "text").where("doc_id is not null and source is not null and text is not null")
    return cut(known.select("doc_id", "source", tokens.count(F.col("text"), vocabulary).alias("tokens")).where("tokens > 0"), "supply")


def plan(stock: DataFrame, targets: DataFrame, total_tokens: int | None = None, max_sources: int = 10_000) -> tuple[list[dict], int]:
    """Per source with documents: name, weight, size, docs, repeats; and the total. One job; its result has a row per target."""
    t = wanted(targets)
    have = stock.groupBy("source").agg(F.sum("tokens").alias("size"), F.count("*").alias("docs"))
    rows = [r.asDict() for r in t.join(have, "source").orderBy("source").limit(max_sources + 1).collect() if r.repeats > 0]
    if len(rows) > max_sources:
        raise ValueError(f"more than {max_sources} target sources")
    all_shares = sum(r["share"] for r in rows)
    for r in rows:
        r["weight"] = r["share"] / all_shares
    if total_tokens is None:
        total_tokens = int(min((r["size"] * r["repeats"] / r["weight"] for r in rows), default=0))
    return rows, total_tokens


def corpus_size(stock: DataFrame) -> int:
    """Tokens of all documents that may be drawn, as a total for :func:`draw`. One job, one row."""
    return int(stock.agg(F.sum("tokens").alias("n")).collect()[0].n or 0)


def _slots(sources: list[dict], count: int, spark: object) -> DataFrame:
    """slot, source, rank."""
    edges, at = [], 0.0
    for s in sources[:-1]:
        at += s["weight"]
        edges.append(at)
    cumulative = F.array(*[F.lit(e) for e in edges]) if edges else F.array().cast("array<double>")
    names = F.array(*[F.lit(s["source"]) for s in sources])
    x = (F.col("slot") + F.lit(0.5)) * F.lit(PHI)
    u = x - F.floor(x)
    at_source = F.size(F.filter(cumulative, lambda e: e <= F.col("u")))
    slots = spark.range(count).withColumnRenamed("id", "slot").withColumn("u", u).select("slot", F.element_at(names, at_source + 1).alias("source"), F.floor(F.col("slot") / BUCKET_SLOTS).alias("bucket"))
    per = slots.groupBy("source", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select("source", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy("source", "bucket").orderBy("slot")) - 1
    return slots.join(offsets, ["source", "bucket"]).select("slot", "source", (F.col("base") + inside).alias("rank"))


def block_size(total: int, block_tokens: int | None = None) -> int:
    """``block_tokens``, or a 4 000th of the total between 16 and 4 096: a mix has about 4 000 blocks or more, and a share is met within one."""
    return block_tokens or max(16, min(4096, total // 4000))


def draw(stock: DataFrame, targets: DataFrame, total_tokens: int | None = None, block_tokens: int | None = None, seed: int = 1) -> DataFrame:
    """slot, source, doc_id, repeat (0..), tokens: the drawn documents in schedule order (slot, then any order)."""
    spark = stock.sparkSession
    sources, total = plan(stock, targets, total_tokens)
    if not sources or total <= 0:
        return stock.where("false").select(F.lit(0).cast("bigint").alias("slot"), "source", "doc_id", F.lit(0).alias("repeat"), "tokens")
    block = block_size(total, block_tokens)
    count = max(1, round(total / block))
    meta = spark.createDataFrame([(s["source"], int(min(s["repeats"], math.ceil(total * s["weight"] / s["size"] + 1e-9) + 1)), max(1, s["docs"] // BUCKET_DOCS)) for s in sources], "source string, epochs int, buckets bigint")
    epochs = stock.join(F.broadcast(meta), "source").select("doc_id", "source", "tokens", "buckets", F.explode(F.sequence(F.lit(0), F.col("epochs") - 1)).alias("repeat"))
    mixed = epochs.withColumn("h", F.xxhash64("doc_id", "repeat", F.lit(seed)))
    unit = (F.shiftrightunsigned("h", 11) / F.lit(float(2**53))).cast("double")
    mixed = mixed.withColumn("bucket", F.floor(unit * F.col("buckets"))).withColumn("key", F.shiftrightunsigned("h", 1))
    per = mixed.groupBy("source", "repeat", "bucket").agg(F.sum("tokens").alias("n"))
    before = Window.partitionBy("source").orderBy("repeat", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select("source", "repeat", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    running = F.sum("tokens").over(Window.partitionBy("source", "repeat", "bucket").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("tokens")
    laid = mixed.join(offsets, ["source", "repeat", "bucket"]).select("doc_id", "source", "tokens", "repeat", F.floor((F.col("base") + running + F.col("tokens") / 2) / block).alias("rank"))
    return laid.join(_slots(sources, count, spark), ["source", "rank"]).select("slot", "source", "doc_id", "repeat", "tokens")


def shares(drawn: DataFrame, targets: DataFrame) -> DataFrame:
    """source, target_share (scaled to 1), documents, most_repeats, tokens, actual_share; also for sources without documents."""
    t = wanted(targets)
    scaled = t.crossJoin(F.broadcast(t.agg(F.sum("share").alias("all")))).select("source", (F.col("share") / F.col("all")).alias("target_share"))
    uses = drawn.groupBy("source", "doc_id").agg(F.count("*").alias("uses"), F.sum("tokens").alias("tokens")).groupBy("source").agg(F.sum("uses").alias("documents"), F.max("uses").alias("most_repeats"), F.sum("tokens").alias("tokens"))
    total = uses.agg(F.sum("tokens").alias("total"))
    out = scaled.join(uses, "source", "left").crossJoin(F.broadcast(total))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return out.select("source", F.round("target_share", 6).alias("target_share"), zero("documents").alias("documents"), zero("most_repeats").alias("most_repeats"), zero("tokens").alias("tokens"), F.round(zero("tokens") / F.col("total"), 6).alias("actual_share"))


def faults(stock: DataFrame, drawn: DataFrame, targets: DataFrame) -> DataFrame:
    """source, over_cap (documents used more often than max_repeats), off_share (1 where the tokens are off the target by more than a block and a document), for every target source.

    Shares are those of :func:`plan`, among sources with documents; for the default total.
    """
    sources, total = plan(stock, targets)
    t = wanted(targets)
    spark = stock.sparkSession
    aim = spark.createDataFrame([(x["source"], float(x["weight"] * total)) for x in sources], "source string, aim double")
    largest = stock.groupBy("source").agg(F.max("tokens").alias("largest"))
    uses = drawn.groupBy("source", "doc_id").agg(F.count("*").alias("uses"), F.sum("tokens").alias("tokens"))
    got = uses.join(F.broadcast(t.select("source", "repeats")), "source").groupBy("source").agg(F.count_if(F.col("uses") > F.col("repeats")).cast("int").alias("over_cap"), F.sum("tokens").alias("tokens"))
    out = t.select("source").join(F.broadcast(aim), "source", "left").join(largest, "source", "left").join(got, "source", "left")
    off = F.abs(F.coalesce("tokens", F.lit(0)) - F.coalesce("aim", F.lit(0.0))) > F.coalesce("largest", F.lit(0)) + 2 * block_size(total)
    return out.select("source", F.coalesce("over_cap", F.lit(0)).alias("over_cap"), off.cast("int").alias("off_share"))
