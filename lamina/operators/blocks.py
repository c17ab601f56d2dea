"""Text layer: documents, typed lines and blocks with exact code-point offsets.

Everything after the line explode is keyed by doc_id, so one exchange serves the running offset,
the island numbering, the block aggregation and the block ordinal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions.text import content_hash, content_timestamp, iso_utc, piece, strip

#: Line patterns in order of precedence, matched against the stripped line. Fixed values.
HEADING = r"^(#|第[一二三四五六七八九十百千零\p{Nd}]+[回章节卷篇部])"
LIST = r"^(- |\* |\p{Nd}+\. )"
CHAPTER = r"第[一二三四五六七八九十百千零\d]+回"


def documents(texts: DataFrame) -> DataFrame:
    """id, source_path, raw_text_hash, total_length, block_count (0), created_at from (doc_id, text[, source_path])."""
    path = F.col("source_path") if "source_path" in texts.columns else F.lit(None).cast("string")
    return texts.where(F.col("text").isNotNull()).select(
        F.col("doc_id").alias("id"), path.alias("source_path"), content_hash(F.col("text")).alias("raw_text_hash"), F.length("text").alias("total_length"), F.lit(0).alias("block_count"), iso_utc(content_timestamp(F.col("text"))).alias("created_at")
    )


def lines(texts: DataFrame) -> DataFrame:
    """doc_id, line_no, line, line_start."""
    exploded = texts.where(F.col("text").isNotNull()).select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    before = Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    return exploded.withColumn("line_start", F.coalesce(F.sum(F.length("line") + 1).over(before), F.lit(0)).cast("int"))


def line_type(line: Column) -> Column:
    """Type of a line; null for a blank one."""
    s = strip(line)
    return (
        F.when(s == "", F.lit(None))
        .when(s.rlike(HEADING), "heading")
        .when(s.startswith("|"), "table")
        .when(s.startswith(">"), "quote")
        .when(s.rlike(LIST), "list")
        .when(s.startswith("```") | line.startswith("    "), "code_block")
        .otherwise("paragraph")
    )


def blocks(texts: DataFrame) -> DataFrame:
    """Maximal runs of neighbouring lines of one type: id, doc_id, block_index, block_type, offsets, text_slice, hash."""
    typed = lines(texts).withColumn("kind", line_type(F.col("line")))
    order = Window.partitionBy("doc_id").orderBy("line_no")
    starts = F.col("kind").isNotNull() & ~F.lag("kind").over(order).eqNullSafe(F.col("kind"))
    numbered = typed.withColumn("island", F.sum(starts.cast("int")).over(order)).where(F.col("kind").isNotNull())
    runs = numbered.groupBy("doc_id", "island").agg(F.min("line_start").alias("start_offset"), F.min("kind").alias("block_type"), F.sort_array(F.collect_list(F.struct("line_no", "line"))).alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["line"]), "\n")
    rows = runs.select("doc_id", (F.col("island") - 1).cast("int").alias("block_index"), "block_type", "start_offset", text.alias("text_slice"))
    return rows.select(
        F.format_string("%s_blk_%04d", "doc_id", "block_index").alias("id"), "doc_id", "block_index", "block_type", "start_offset", (F.col("start_offset") + F.length("text_slice")).alias("end_offset"), "text_slice", content_hash(F.col("text_slice")).alias("hash")
    )


def with_block_count(docs: DataFrame, blks: DataFrame) -> DataFrame:
    n = blks.groupBy(F.col("doc_id").alias("id")).agg(F.count("*").cast("int").alias("n"))
    return docs.join(n, "id", "left").withColumn("block_count", F.coalesce("n", F.lit(0))).drop("n")


def block_slice(text: Column, start: Column, end: Column) -> Column:
    return piece(text, start, end)


def stale_documents(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """Documents whose stored hash is not that of their text."""
    return docs.join(texts.select(F.col("doc_id").alias("id"), "text"), "id").where(~content_hash(F.col("text")).eqNullSafe(F.col("raw_text_hash"))).select("id")


def stale_slices(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Blocks or segments that cannot be replayed from the raw text: id, doc_id, problem."""
    at = rows.join(texts.select("doc_id", "text"), "doc_id", "left")
    replay = piece(F.col("text"), F.col("start_offset"), F.col("end_offset"))
    problem = (
        F.when(F.col("text").isNull(), "no raw text")
        .when(~content_hash(F.col("text_slice")).eqNullSafe(F.col("hash")), "hash differs")
        .when(~replay.eqNullSafe(F.col("text_slice")), "slice differs")
    )
    return at.withColumn("problem", problem).where(F.col("problem").isNotNull()).select("id", "doc_id", "problem")


def chapters(texts: DataFrame, title_limit: int = 40) -> DataFrame:
    """doc_id, chapter_no, title, start_offset, end_offset: a chapter runs from its mark to the next."""
    parts = F.split("text", f"(?={CHAPTER})", -1)
    exploded = texts.where(F.col("text").rlike(CHAPTER)).select("doc_id", F.posexplode(parts).alias("part_no", "part"))
    before = Window.partitionBy("doc_id").orderBy("part_no").rowsBetween(Window.unboundedPreceding, -1)
    placed = exploded.withColumn("start_offset", F.coalesce(F.sum(F.length("part")).over(before), F.lit(0)).cast("int"))
    found = placed.where(F.col("part").rlike(f"^{CHAPTER}"))
    title = F.substring(F.split("part", "\n", 2)[0], 1, title_limit)
    number = F.row_number().over(Window.partitionBy("doc_id").orderBy("part_no"))
    return found.select("doc_id", number.alias("chapter_no"), strip(title).alias("title"), "start_offset", (F.col("start_offset") + F.length("part")).alias("end_offset"))


def chapter(texts: DataFrame, number: int) -> DataFrame:
    return chapters(texts).where(F.col("chapter_no") == number)
