"""Deterministic symbols for objects: readable where the name allows it, hashed where not, unique per package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..runtime import cut, release

#: Class, rank in which symbols are given out, and module. Fixed values.
ORDER = ("Document", "Block", "Segment", "Entity", "Event", "Claim", "Relation", "Residual", "IgnoreSegment")
MODULES = {"Document": "text", "Block": "text", "Segment": "text", "Entity": "entities", "Event": "events", "Claim": "claims", "Relation": "derived", "Residual": "residuals", "IgnoreSegment": "residuals"}
IMPORTS = {"text": (), "entities": ("text",), "events": ("text", "entities"), "claims": ("text", "entities"), "derived": ("text", "entities", "events", "claims"), "residuals": ("text",)}


def normalise(name: Column) -> Column:
    """Lower-case ASCII words joined by underscores; null where there are none."""
    words = F.regexp_extract_all(name, F.lit("[A-Za-z0-9]+"), F.lit(0))
    plain = name.rlike("^[A-Za-z0-9_]+$") & name.rlike("[A-Za-z0-9]")
    return F.when(plain, F.lower(name)).when(F.size(words) > 0, F.lower(F.array_join(words, "_")))


def hashed(prefix: str, text: Column) -> Column:
    return F.concat(F.lit(f"{prefix}_zh_"), F.substring(F.sha2(text, 256), 1, 6))


def claim_key(subject: Column, predicate: Column, obj: Column) -> Column:
    return F.concat_ws("_", *[F.coalesce(c, F.lit("")) for c in (subject, predicate, obj)])


def _named(df: DataFrame, prefix: str) -> Column:
    n = normalise(F.col("name"))
    return F.when(n.isNotNull(), F.concat(F.lit(prefix + "_"), n)).otherwise(hashed(prefix, F.concat(F.coalesce("name", F.lit("")), F.col("id"))))


def bases(objects: dict[str, DataFrame], package: str = "doc_id") -> DataFrame:
    """package, obj_type, id, base: the symbol each object would have if it were alone."""
    out = None
    segment_base = F.when(F.col("id").contains("_seg_"), F.concat(F.lit("seg_"), F.substring_index("id", "_seg_", -1))).otherwise(hashed("seg", F.col("id")))
    for name in ORDER:
        df = objects.get(name)
        if df is None:
            continue
        pack = F.col(package) if package in df.columns else F.col("id")
        rank = F.row_number().over(Window.partitionBy(pack).orderBy("id")) - 1
        if name == "Document":
            base = F.concat(F.lit("doc_"), F.translate("id", ".-", "__"))
        elif name == "Block":
            base = F.format_string("blk_%04d", F.coalesce("block_index", F.lit(0)))
        elif name == "Segment":
            base = segment_base
        elif name in ("Entity", "Event"):
            base = _named(df, "ent" if name == "Entity" else "evt")
        elif name == "Claim":
            key = claim_key(F.col("subject"), F.col("predicate"), F.col("object_ref"))
            n = normalise(key)
            base = F.when(n.isNotNull() & (F.length(n) <= 30), F.concat(F.lit("claim_"), n)).otherwise(hashed("claim", F.concat(key, F.col("id"))))
        elif name == "Relation":
            base = F.when(F.col("id").contains("_rel_clm_"), F.concat(F.lit("rel_clm_"), F.substring_index("id", "_rel_clm_", -1))).otherwise(F.format_string("rel_%04d", rank))
        else:
            head = "res" if name == "Residual" else "ign"
            own = F.when(F.col("segment_id").contains("_seg_"), F.concat(F.lit(head + "_seg_"), F.substring_index("segment_id", "_seg_", -1)))
            base = F.coalesce(own, F.format_string(head + "_%04d", rank))
        part = df.select(pack.alias("package"), F.lit(name).alias("obj_type"), "id", base.alias("base"))
        out = part if out is None else out.unionByName(part)
    return out


def _numbered(df: DataFrame) -> DataFrame:
    rank = F.element_at(F.create_map(*[x for i, n in enumerate(ORDER) for x in (F.lit(n), F.lit(i))]), F.col("obj_type"))
    k = F.row_number().over(Window.partitionBy("package", "base").orderBy(rank, "id")) - 1
    return df.withColumn("symbol", F.when(k == 0, F.col("base")).otherwise(F.concat("base", F.lit("_"), k.cast("string"))))


def assign(objects: dict[str, DataFrame], package: str = "doc_id") -> DataFrame:
    """package, obj_type, id, symbol, module. Equal bases get _1, _2, .. in class and id order.

    A numbered symbol may equal another object's own base; such clashes (rare) are numbered again
    until none is left; every round makes them longer, so it ends.
    """
    table = cut(_numbered(bases(objects, package)).select("package", "obj_type", "id", "base", "symbol"), "symbols")
    while True:
        twice = table.groupBy("package", "symbol").agg(F.count("*").alias("n")).where("n > 1")
        if twice.limit(1).count() == 0:
            break
        marked = table.join(twice.select("package", "symbol", F.lit(1).alias("again")), ["package", "symbol"], "left")
        again = marked.where("again is not null and symbol <> base").select("package", "obj_type", "id", F.concat("symbol", F.lit("_")).alias("base"))
        keep = marked.where("again is null or symbol = base").select("package", "obj_type", "id", "base", "symbol")
        fresh = cut(keep.unionByName(_numbered(again).select("package", "obj_type", "id", "base", "symbol")), "symbols")
        release(table)
        table = fresh
    modules = F.create_map(*[x for k, v in MODULES.items() for x in (F.lit(k), F.lit(v))])
    return table.select("package", "obj_type", "id", "symbol", F.element_at(modules, F.col("obj_type")).alias("module"))


def collisions(objects: dict[str, DataFrame], package: str = "doc_id") -> DataFrame:
    """Bases that more than one object of a package would have."""
    return bases(objects, package).groupBy("package", "base").agg(F.count("*").alias("objects")).where("objects > 1")


def double_ids(objects: dict[str, DataFrame]) -> DataFrame:
    """Ids that stand under more than one class."""
    out = None
    for name, df in objects.items():
        part = df.select(F.lit(name).alias("obj_type"), "id").distinct()
        out = part if out is None else out.unionByName(part)
    return out.groupBy("id").agg(F.count("*").alias("classes")).where("classes > 1")


def references_as_symbols(references: DataFrame, table: DataFrame, strict: bool = False, shown: int = 3) -> DataFrame:
    """References with the symbol, class and module of their target in the same package; null where the package does not hold it.

    ``strict`` raises and names at most ``shown`` that point nowhere.
    """
    s = table.select(F.col("package").alias("doc_id"), F.col("id").alias("target_id"), "symbol", F.col("module").alias("target_module"), F.col("obj_type").alias("target_class"))
    out = references.join(s, ["doc_id", "target_id"], "left").select("doc_id", "obj_type", "obj_id", "field", "pos", "target_id", "symbol", "target_module", "target_class")
    if strict:
        lost = out.where("symbol is null").limit(shown).collect()
        if lost:
            raise LookupError("; ".join(f"{r.obj_type} {r.obj_id}.{r.field}: {r.target_id} has no symbol in {r.doc_id}" for r in lost))
    return out


def export_order(obj_type: str) -> list[str]:
    return {"Block": ["block_index", "start_offset", "id"], "Segment": ["block_index", "start_offset", "id"]}.get(obj_type, ["id"])
