"""Entities with a name or alias in common merged into one, and the references to them rewritten.

Two modes. ``greedy`` keeps the sequential rule: in id order an entity joins the owner of its first
token that has one, otherwise it owns its tokens. Only one document's entities depend on each
other, and only those with a token in common, so these alone run per document (``applyInPandas``).
``components`` merges everything connected; it is expressed by joins and has no per-document task.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components, stars


def greedy_owners(ids: list[str], tokens: list[list[str]]) -> list[str]:
    """Canonical id of each entity; entities come in id order, tokens are name first, then aliases."""
    owner: dict[str, str] = {}
    out = []
    for i, names in zip(ids, tokens):
        to = next((owner[t] for t in names if t in owner), i)
        for t in names:
            if to != i or t not in owner:
                owner[t] = to
        out.append(to)
    return out


def _tokens(entities: DataFrame) -> DataFrame:
    spelled = F.filter(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>"))), lambda x: x.isNotNull() & (x != ""))
    return entities.select("doc_id", "id", F.array_distinct(spelled).alias("tokens"))


def canonical(entities: DataFrame, mode: str = "greedy") -> DataFrame:
    """doc_id, id, canonical_id.

    Entities none of whose tokens another entity of the document has own themselves; only the others take part.
    ``greedy`` then runs per document, ``components`` merges what is connected.
    """
    named = _tokens(entities)
    held = named.select("doc_id", "id", F.explode("tokens").alias("token"))
    shared = held.groupBy("doc_id", "token").agg(F.count("*").alias("n")).where("n > 1").select("doc_id", "token")
    if mode == "components":
        node = held.join(shared, ["doc_id", "token"]).select("doc_id", "token", F.struct("doc_id", "id").alias("id"))
        label = components(stars(node, ["doc_id", "token"])).select("node.doc_id", "node.id", F.col("label.id").alias("canonical_id"))
        return named.select("doc_id", "id").join(label, ["doc_id", "id"], "left").select("doc_id", "id", F.coalesce("canonical_id", "id").alias("canonical_id"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")
        to = greedy_owners(pdf["id"].tolist(), [list(t) for t in pdf["tokens"]])
        return pd.DataFrame({"doc_id": pdf["doc_id"].tolist(), "id": pdf["id"].tolist(), "canonical_id": to})

    # the shared tokens of an entity in their order; a document is null-safe as a key of the group
    tied = named.select("doc_id", "id", F.posexplode("tokens").alias("pos", "token")).join(shared, ["doc_id", "token"], "left_semi").groupBy("doc_id", "id").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "token"))), lambda x: x["token"]).alias("tokens"))
    owned = tied.groupBy("doc_id").applyInPandas(run, "doc_id string, id string, canonical_id string")
    return named.select("doc_id", "id").join(owned, ["doc_id", "id"], "left").select("doc_id", "id", F.coalesce("canonical_id", "id").alias("canonical_id"))


def merge(entities: DataFrame, owners: DataFrame) -> DataFrame:
    """Canonical entities: aliases of all members (without the owner's name), sorted segment ids, distinct references."""
    e = entities.join(owners.select("id", "canonical_id"), "id")
    own = e.where("id = canonical_id").select("id", "doc_id", "name", "kind")
    spelled = F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))
    all_ = e.groupBy("canonical_id").agg(
        F.sort_array(F.collect_list(F.struct("id", spelled.alias("names"), F.coalesce("source_segment_ids", F.array().cast("array<string>")).alias("segs"), "evidence_refs"))).alias("m")
    )
    names = F.array_distinct(F.flatten(F.transform("m", lambda x: x["names"])))
    segs = F.array_sort(F.array_distinct(F.flatten(F.transform("m", lambda x: x["segs"]))))
    refs = F.array_distinct(F.flatten(F.filter(F.transform("m", lambda x: x["evidence_refs"]), lambda x: x.isNotNull())))
    out = own.join(all_.select(F.col("canonical_id").alias("id"), names.alias("names"), segs.alias("source_segment_ids"), refs.alias("evidence_refs")), "id")
    return out.select("id", "doc_id", "name", "kind", F.filter("names", lambda x: x.isNotNull() & ~x.eqNullSafe(F.col("name"))).alias("aliases"), "evidence_refs", "source_segment_ids")


def rewrite(df: DataFrame, owners: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Scalar references replaced by their canonical id. Unknown ids stay."""
    out = df
    for c in columns:
        m = owners.select(F.col("id").alias(c), F.col("canonical_id").alias("_to"))
        out = out.join(m, c, "left").withColumn(c, F.coalesce("_to", c)).drop("_to")
    return out.select(*df.columns)


def rewrite_array(df: DataFrame, owners: DataFrame, column: str, key: str = "id") -> DataFrame:
    """An array of references rewritten, order kept, repeated targets once."""
    parts = df.select(key, F.posexplode(column).alias("pos", "_v"))
    m = owners.select(F.col("id").alias("_v"), F.col("canonical_id").alias("_to"))
    new = parts.join(m, "_v", "left").select(key, "pos", F.coalesce("_to", "_v").alias("v")).groupBy(key).agg(F.sort_array(F.collect_list(F.struct("pos", "v"))).alias("p"))
    return df.join(new, key, "left").withColumn(column, F.when(F.col("p").isNotNull(), F.array_distinct(F.transform("p", lambda x: x["v"]))).otherwise(F.col(column))).select(*df.columns)


def without_self_claims(claims: DataFrame, relations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Claims about an entity and itself go after a rewrite, and with them their relations."""
    kept = claims.where(~((F.col("subject") == F.col("object_ref")) & F.col("subject").isNotNull() & F.col("object_ref").isNotNull()))
    return kept, relations.join(kept.select(F.col("id").alias("claim_id")), "claim_id", "left_semi")
