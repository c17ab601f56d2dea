"""Node, edge and answer-context views over the knowledge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import evidence as ev
from . import references as rf


def nodes(entities: DataFrame, events: DataFrame, claims: DataFrame) -> DataFrame:
    """id, node_type, label, kind, modality, polarity."""
    none = F.lit(None).cast("string")
    e = entities.select("id", F.lit("Entity").alias("node_type"), F.col("name").alias("label"), "kind", none.alias("modality"), none.alias("polarity"))
    v = events.select("id", F.lit("Event").alias("node_type"), F.col("name").alias("label"), "kind", none.alias("modality"), none.alias("polarity"))
    text = F.concat_ws(" ", F.coalesce("subject", F.lit("None")), F.coalesce("predicate", F.lit("None")), F.coalesce("object_ref", F.lit("None")))
    c = claims.select("id", F.lit("Claim").alias("node_type"), text.alias("label"), none.alias("kind"), "modality", "polarity")
    return e.unionByName(v).unionByName(c)


def participation_edges(events: DataFrame) -> DataFrame:
    p = events.select("id", F.explode("participants").alias("p")).where(F.col("p").isNotNull())
    return p.select(F.col("p").alias("source_id"), F.col("id").alias("target_id"), F.lit("participates_in").alias("edge_type"), F.lit("navigation").alias("edge_class"), F.lit(None).cast("string").alias("relation_id"), F.lit(None).cast("string").alias("claim_id"), F.lit(None).cast("string").alias("modality"), F.lit(None).cast("string").alias("polarity"))


def relation_edges(relations: DataFrame, claims: DataFrame) -> DataFrame:
    """A relation is a fact if its claim exists, is asserted and positive, says the same and has evidence; else an index to a claim."""
    j = rf.relations_with_claims(relations, claims)
    fact = F.col("claim_known").isNotNull() & (F.col("modality") == "asserted") & (F.col("polarity") == "positive") & (F.col("claim_subject") == F.col("subject")) & (F.col("claim_object") == F.col("object_ref")) & ((F.col("claim_refs") > 0) | (F.col("claim_segments") > 0))
    return j.select(F.col("subject").alias("source_id"), F.col("object_ref").alias("target_id"), F.col("predicate").alias("edge_type"), F.when(fact, "fact").otherwise("claim_index").alias("edge_class"), F.col("id").alias("relation_id"), "claim_id", "modality", "polarity")


def edges(events: DataFrame, relations: DataFrame, claims: DataFrame) -> DataFrame:
    return participation_edges(events).unionByName(relation_edges(relations, claims))


class Graph:
    """Nodes and edges, cached on first use until :meth:`invalidate`."""

    def __init__(self, entities: DataFrame, events: DataFrame, claims: DataFrame, relations: DataFrame, segments: DataFrame) -> None:
        self.tables = {"Entity": entities, "Event": events, "Claim": claims, "Relation": relations}
        self.segments = segments
        self._cached: tuple[DataFrame, DataFrame] | None = None

    def _both(self) -> tuple[DataFrame, DataFrame]:
        if self._cached is None:
            t = self.tables
            self._cached = (nodes(t["Entity"], t["Event"], t["Claim"]).cache(), edges(t["Event"], t["Relation"], t["Claim"]).cache())
        return self._cached

    @property
    def nodes(self) -> DataFrame:
        return self._both()[0]

    @property
    def edges(self) -> DataFrame:
        return self._both()[1]

    def invalidate(self) -> None:
        for df in self._cached or ():
            df.unpersist()
        self._cached = None

    def node(self, node_id: str) -> DataFrame:
        return self.nodes.where(F.col("id") == node_id)

    def neighbours(self, node_id: str) -> DataFrame:
        return self.edges.where((F.col("source_id") == node_id) | (F.col("target_id") == node_id))

    def relations(self, node_id: str, facts_only: bool = False) -> DataFrame:
        """Edges that leave a node, participation among them."""
        out = self.edges.where(F.col("source_id") == node_id)
        return out.where("edge_class = 'fact'") if facts_only else out

    def evidence(self, obj_id: str) -> DataFrame:
        out = None
        for name in ("Entity", "Event", "Claim"):
            part = ev.lookup(self.tables[name].where(F.col("id") == obj_id))
            out = part if out is None else out.unionByName(part)
        rel = self.tables["Relation"].where(F.col("id") == obj_id).withColumn("source_segment_ids", F.array().cast("array<string>"))
        return out.unionByName(ev.lookup(rel))

    def answer_context(self, obj_id: str) -> DataFrame:
        """The node with its references and raw quotes, one row."""
        quotes = ev.raw_quotes(self.evidence(obj_id), self.segments)
        packed = quotes.groupBy("obj_id").agg(F.sort_array(F.collect_list(F.struct("pos", "segment_id", "quote"))).alias("quotes"))
        return self.node(obj_id).join(packed.withColumnRenamed("obj_id", "id"), "id", "left")


def answer_contexts(entities: DataFrame, events: DataFrame, claims: DataFrame, segments: DataFrame) -> DataFrame:
    """All contexts at once: obj_id, pos, segment_id, quote, label."""
    found = ev.lookup(entities).unionByName(ev.lookup(events)).unionByName(ev.lookup(claims))
    return ev.raw_quotes(found, segments).join(nodes(entities, events, claims).select(F.col("id").alias("obj_id"), "node_type", "label"), "obj_id")
