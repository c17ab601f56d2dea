"""Queries on references without records and on nested records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import inlining, orphans
from ..runtime import table
from .registry import Registry

query = Registry()

_CURRENT = """
cur as (
  select 'claims' t, id, arg_max(loaded_at, loaded_at) loaded_at, arg_max(coalesce(is_deleted, false), loaded_at) gone, min(loaded_at) first_seen from claims where id is not null group by id
  union all select 'relations', id, max(loaded_at), false, min(loaded_at) from relations where id is not null group by id
  union all select 'kg_events', id, max(loaded_at), false, min(loaded_at) from kg_events where id is not null group by id
  union all select 'entities', id, max(loaded_at), arg_max(coalesce(is_deleted, false), loaded_at), min(loaded_at) from entities where id is not null group by id
  union all select 'segments', id, max(loaded_at), arg_max(coalesce(is_deleted, false), loaded_at), min(loaded_at) from segments where id is not null group by id
  union all select 'seed_entities', id, max(loaded_at), false, min(loaded_at) from seed_entities where id is not null group by id),
targets as (
  select case t when 'claims' then 'claim' when 'segments' then 'segment' else 'entity' end target, id, min(first_seen) first_seen, bool_and(gone) gone
  from cur where t in ('claims', 'segments', 'entities', 'seed_entities') group by 1, 2),
refs as (
  select distinct 'claims' src_table, c.id src_id, 'subject' field_name, 'entity' target, c.subject ref_id, k.loaded_at ref_at from claims c join cur k on k.t = 'claims' and k.id = c.id and k.loaded_at = c.loaded_at and not k.gone
  union select 'claims', c.id, 'segment_id', 'segment', e.u.segment_id, k.loaded_at from claims c join cur k on k.t = 'claims' and k.id = c.id and k.loaded_at = c.loaded_at and not k.gone, unnest(c.evidence_refs) e(u)
  union select 'relations', c.id, 'claim_id', 'claim', c.claim_id, k.loaded_at from relations c join cur k on k.t = 'relations' and k.id = c.id and k.loaded_at = c.loaded_at and not k.gone
  union select 'relations', c.id, 'segment_id', 'segment', e.u.segment_id, k.loaded_at from relations c join cur k on k.t = 'relations' and k.id = c.id and k.loaded_at = c.loaded_at and not k.gone, unnest(c.evidence_refs) e(u)
  union select 'kg_events', c.id, 'participants', 'entity', e.u, k.loaded_at from kg_events c join cur k on k.t = 'kg_events' and k.id = c.id and k.loaded_at = c.loaded_at, unnest(c.participants) e(u)
  union select 'kg_events', c.id, 'segment_id', 'segment', e.u.segment_id, k.loaded_at from kg_events c join cur k on k.t = 'kg_events' and k.id = c.id and k.loaded_at = c.loaded_at, unnest(c.evidence_refs) e(u)
  union select 'entities', c.id, 'segment_id', 'segment', e.u.segment_id, k.loaded_at from entities c join cur k on k.t = 'entities' and k.id = c.id and k.loaded_at = c.loaded_at and not k.gone, unnest(c.evidence_refs) e(u)),
failing as (
  select r.*, case when t.id is null then 'absent' when t.gone then 'deleted' else 'late' end reason
  from refs r left join targets t on t.target = r.target and t.id = r.ref_id
  where r.ref_id is not null and regexp_matches(r.ref_id, '[^\\s\\x{3000}\\x{00A0}]')
    and (t.id is null or t.gone or t.first_seen > r.ref_at))
"""


def _frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t.name: table(spark, sf_dir, t.name) for t in orphans.PROJECT}


@query("p1_found", f"with {_CURRENT} select src_table, src_id, field_name, ref_id from failing")
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans.orphans(orphans.PROJECT, _frames(spark, sf_dir)).select("src_table", "src_id", "field_name", "ref_id")


@query(
    "p1_report",
    f"with {_CURRENT} select src_table, field_name, reason, strftime(ref_at, '%Y-%m') period, count(*) failing, count(distinct ref_id) failing_keys from failing group by 1, 2, 3, 4",
)
def p1_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans.report(orphans.PROJECT, _frames(spark, sf_dir))


@query("p1_changed", f"with {_CURRENT} select src_table, src_id, field_name, ref_id, reason from failing")
def p1_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same references from kept state, after three batches of changes of all tables by the date of loading."""
    frames = _frames(spark, sf_dir)
    state = None
    for k in range(3):
        batch = {n: f.where(F.coalesce(F.pmod(F.datediff("loaded_at", F.lit("2020-01-01")), F.lit(3)), F.lit(0)) == k) for n, f in frames.items()}
        state = orphans.begin(orphans.PROJECT, batch) if state is None else orphans.advance(orphans.PROJECT, state, batch)
    return orphans.failing(state).drop("ref_at")


# every node of every document; strings that hold an array or object are opened again, level by level
_NODES = """
ob as (select obj_type, obj_id, arg_max(data, loaded_at) d from objects where coalesce(obj_type, obj_id) is not null group by 1, 2),
lvl0 as (select obj_type, obj_id, '$' as base, cast(d as json) d from ob where obj_id is not null and d is not null and json_valid(d)),
nodes as (
  select obj_type, obj_id, base, t.fullkey, t.type, t.value, t.atom, d from lvl0, json_tree(d) t
  union all
  select n.obj_type, n.obj_id, n.path, t.fullkey, t.type, t.value, t.atom, n.inner_d from (
    select obj_type, obj_id, base || substr(fullkey, 2) path, cast(json_extract_string(d, fullkey) as json) inner_d from nodes where type = 'VARCHAR' and regexp_matches(json_extract_string(d, fullkey), '^\\s*[\\[{]') and json_valid(json_extract_string(d, fullkey))) n, json_tree(n.inner_d) t),
node as (select obj_type, obj_id, base || substr(fullkey, 2) json_path, type, case when type = 'VARCHAR' then json_extract_string(d, fullkey) when type = 'NULL' then null else cast(value as varchar) end as value from nodes
  where not (type = 'VARCHAR' and regexp_matches(json_extract_string(d, fullkey), '^\\s*[\\[{]') and json_valid(json_extract_string(d, fullkey))))
"""


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return inlining.inline(table(spark, sf_dir, "objects"))


@query(
    "p2_found",
    f"""with recursive {_NODES}, seg as (select obj_type, obj_id, regexp_replace(json_path, '\\.segment_id$', '') p, coalesce(value, '') segment_id, type from node where json_path like '%.segment_id'),
    hash as (select distinct obj_type, obj_id, regexp_replace(json_path, '\\.quote_hash$', '') p from node where json_path like '%.quote_hash'),
    own as (select obj_type, obj_id, regexp_replace(json_path, '\\.id$', '') p, value from node where json_path like '%.id' and type = 'VARCHAR'),
    hit as (select s.obj_type, s.obj_id, s.p json_path, s.segment_id from seg s join hash h on h.obj_type is not distinct from s.obj_type and h.obj_id = s.obj_id and h.p = s.p where s.type <> 'NULL')
    select h.obj_type, h.obj_id, h.json_path, coalesce((select arg_max(o.value, length(o.p)) from own o where o.obj_type is not distinct from h.obj_type and o.obj_id = h.obj_id and h.json_path <> o.p and starts_with(h.json_path, o.p) and substr(h.json_path, length(o.p) + 1, 1) in ('.', '[')), h.obj_id) parent_id, h.segment_id from hit h""",
)
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inlining.evidence(_tables(spark, sf_dir)[1])


@query(
    "p2_leaves",
    f"with recursive {_NODES} select obj_type, obj_id, json_path, value from node where type not in ('OBJECT', 'ARRAY') or value in ('[]', '{{}}')",
)
def p2_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value of every document, read back from the flat tables."""
    return inlining.leaves(_tables(spark, sf_dir)[1]).select("obj_type", "obj_id", "json_path", "value")


@query(
    "p2_rows",
    f"with recursive {_NODES} select obj_type, obj_id, count(*) as items from node where regexp_matches(json_path, '\\]$') or json_path = '$' group by 1, 2",
)
def p2_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per document that stand for the document itself or an item of an array."""
    rows = _tables(spark, sf_dir)[1]
    return rows.where(F.col("json_path").rlike(r"\]$") | (F.col("json_path") == "$")).groupBy("obj_type", "obj_id").agg(F.count("*").alias("items"))


@query("p2_tables")
def p2_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of all flat tables with the keys that relate them."""
    cols = F.array_sort(F.transform(F.map_entries("columns"), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("null")))))
    return _tables(spark, sf_dir)[1].select("obj_type", "obj_id", "table_name", "json_path", "parent_table", "parent_path", "parent_id", "row_id", "ordinal", "item_type", "item", F.array_join(cols, "\x1f").alias("columns"))


@query(
    "p2_qualifiers",
    f"""with recursive {_NODES}, q as (select distinct obj_type, obj_id, regexp_extract(json_path, '^(.*\\.qualifiers\\[\\d+\\])\\.[^.]*$', 1) json_path from node),
    m as (select obj_type, obj_id, json_path, type, value from node)
    select q.obj_type, q.obj_id, q.json_path, (select min(value) from m where m.obj_type is not distinct from q.obj_type and m.obj_id = q.obj_id and m.json_path = q.json_path || '.id' and m.type = 'VARCHAR') row_id,
      (select min(value) from m where m.obj_type is not distinct from q.obj_type and m.obj_id = q.obj_id and m.json_path = q.json_path || '.role') as role,
      (select min(value) from m where m.obj_type is not distinct from q.obj_type and m.obj_id = q.obj_id and m.json_path = q.json_path || '.text') as text
    from q where json_path <> ''""",
)
def p2_qualifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The qualifier table as a frame of its own."""
    graph, rows = _tables(spark, sf_dir)
    return inlining.qualifiers(rows).select("obj_type", "obj_id", "json_path", "row_id", "role", "text")


@query("p2_schema_graph")
def p2_schema_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tables(spark, sf_dir)[0]


@query(
    "p2_claim_evidence",
    """with c as (select id, loaded_at, evidence_refs from claims qualify row_number() over (partition by id order by loaded_at desc, coalesce(is_deleted, false)) = 1 and not coalesce(is_deleted, false) and id is not null),
    e as (select id as claim_id, unnest(range(len(evidence_refs))) as ordinal, unnest(evidence_refs) as u from c)
    select claim_id, cast(ordinal as int) as ordinal, u.segment_id as segment_id, u.span_start as span_start, u.span_end as span_end, u.quote_hash as quote_hash from e where u is not null""",
)
def p2_claim_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inlining.claim_evidence(table(spark, sf_dir, "claims"))
