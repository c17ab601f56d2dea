"""Model answers kept by key: canonical keys, lookup policies, and replay."""

from __future__ import annotations

import hashlib
import json
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.current import current

SCHEMA_NAME = "lamina-answers-v1"
POLICIES = ("off", "read_write", "read_only", "refresh")


def canonical_json(value: Any) -> str:
    """Sorted keys, no blanks, no escapes of non-ASCII characters."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def digest(value: Any) -> str:
    return hashlib.sha256((value if isinstance(value, str) else canonical_json(value)).encode()).hexdigest()


def cache_key(*, doc_id: str, batch_index: int, segment_ids: list[str], segment_hashes: list[str], known_entities: dict[str, str] | None, model: str, prompt_version: str, protocol: str, options: dict[str, Any], chapter: tuple[int, str] = (0, ""), schema: str = SCHEMA_NAME) -> str:
    """Everything that shapes an answer is part of its key. Order counts for segments, not for entities and options."""
    parts = {
        "schema": schema, "doc_id": doc_id, "chapter": list(chapter), "batch_index": batch_index, "segments": digest([list(x) for x in zip(segment_ids, segment_hashes)]),
        "entities": digest(sorted((known_entities or {}).items())), "model": model, "prompt_version": prompt_version, "protocol": protocol, "options": options,
    }
    return f"{schema}:{digest(parts)}"


def entries(raw: DataFrame) -> DataFrame:
    """Current entry of each key; entries without a readable answer are misses and left out."""
    cur = current(raw, ("cache_key",))
    return cur.where(F.col("cache_key").isNotNull() & F.col("response.raw_text").isNotNull())


def plan(wanted: DataFrame, known: DataFrame, policy: str = "read_write") -> DataFrame:
    """cache_key and what to do: use, call, call_and_store, or fail. ``wanted``: cache_key."""
    if policy not in POLICIES:
        raise ValueError(f"unknown cache policy {policy}")
    hit = wanted.select("cache_key").join(known.select("cache_key").distinct().withColumn("hit", F.lit(True)), "cache_key", "left")
    miss = {"off": "call", "read_write": "call_and_store", "read_only": "fail", "refresh": "call_and_store"}[policy]
    use = F.col("hit").isNotNull() if policy in ("read_write", "read_only") else F.lit(False)
    return hit.select("cache_key", F.when(use, "use").otherwise(miss).alias("action"))


def require_all(planned: DataFrame) -> DataFrame:
    """The plan itself; running it fails at the first miss that may not be called."""
    return planned.withColumn("action", F.when(F.col("action") == "fail", F.raise_error(F.concat(F.lit("not in the cache: "), "cache_key"))).otherwise(F.col("action")))


def answers(known: DataFrame) -> DataFrame:
    """doc_id, batch_index, raw_text of entries to replay: the latest per batch. Where an entry holds parsed objects (JSON text), they stand for its answer."""
    fields = known.schema["response"].dataType.names
    text = F.coalesce("response.parsed_candidates", "response.raw_text") if "parsed_candidates" in fields else F.col("response.raw_text")
    rows = known.where(F.col("doc_id").isNotNull()).groupBy("doc_id", "batch_index").agg(F.max(F.struct("created_at", "cache_key", text.alias("raw_text"))).alias("r"))
    return rows.select("doc_id", "batch_index", F.col("r.raw_text").alias("raw_text"))


def write(df: DataFrame, path: str) -> None:
    """Append entries; readers take the current one of each key."""
    df.write.mode("append").parquet(path)
