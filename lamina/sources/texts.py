"""Text files and in-memory texts as (doc_id, source_path, text)."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import table


def safe_id(stem: Column) -> Column:
    """A name fit for ids: word characters only, ``document`` where nothing is left, ``doc_`` before a leading figure."""
    word = F.regexp_replace(F.regexp_replace(stem, r"(?U)\W+", "_"), "^_+|_+$", "")
    word = F.when(word == "", F.lit("document")).otherwise(word)
    return F.when(word.rlike(r"^\p{Nd}"), F.concat(F.lit("doc_"), word)).otherwise(word)


def stem(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def read_files(spark: SparkSession, path: str, pattern: str = "*.txt", safe: bool = True) -> DataFrame:
    """One row per file; folders are not entered."""
    raw = spark.read.format("text").option("wholetext", True).option("pathGlobFilter", pattern).load(path)
    name = stem(F.url_decode(F.col("_metadata.file_path")))
    return raw.select((safe_id(name) if safe else name).alias("doc_id"), F.col("_metadata.file_path").alias("source_path"), F.col("value").alias("text"))


def read_library(spark: SparkSession, folder: str, pattern: str = "*.txt") -> DataFrame:
    """All texts of a local folder; an error where it is missing, no folder, or holds none."""
    import fnmatch

    if not os.path.isdir(folder):
        raise NotADirectoryError(folder)
    if not any(fnmatch.fnmatch(n, pattern) for n in os.listdir(folder)):
        raise FileNotFoundError(f"no {pattern} in {folder}")
    return read_files(spark, folder, pattern)


def from_memory(spark: SparkSession, texts: dict[str, str]) -> DataFrame:
    return spark.createDataFrame(list(texts.items()), "doc_id string, text string").withColumn("source_path", F.lit(None).cast("string"))


def from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table as texts, keyed by doc_key."""
    return table(spark, sf_dir, "documents").where(F.col("doc_key").isNotNull()).select(F.col("doc_key").alias("doc_id"), "source_path", "text")
