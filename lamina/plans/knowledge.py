"""Queries on the text layer and the knowledge tables, each beside the SQL it must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import blocks as bl
from ..operators import candidates as ca
from ..operators import coverage as co
from ..operators import evidence as ev
from ..operators import graph as gr
from ..operators import metrics as me
from ..operators import references as rf
from ..operators import relations as rl
from ..operators import repair as rp
from ..operators import resolve as rs
from ..operators import segments as sg
from ..operators import store as st
from ..operators import symbols as sy
from ..operators import validate as va
from ..operators.current import current
from ..runtime import cut, table
from ..sources import cache, package, texts
from .registry import Registry

query = Registry()

# ------------------------------------------------------------------ inputs


class Base:
    """Current rows of the tables below ``sf_dir``, by class."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.dir = spark, sf_dir

    def get(self, name: str) -> DataFrame:
        return current(table(self.spark, self.dir, name))

    @property
    def segments(self) -> DataFrame:
        return self.get("segments")

    @property
    def claims(self) -> DataFrame:
        return self.get("claims")

    @property
    def relations(self) -> DataFrame:
        return self.get("relations")

    @property
    def events(self) -> DataFrame:
        return self.get("kg_events")

    @property
    def entities(self) -> DataFrame:
        return self.get("entities")

    def objects(self) -> dict[str, DataFrame]:
        return {"Entity": self.entities, "Event": self.events, "Claim": self.claims, "Relation": self.relations}

    def texts(self) -> DataFrame:
        return texts.from_documents(self.spark, self.dir)

    def store(self) -> DataFrame:
        return st.compact(table(self.spark, self.dir, "objects"))

    def keyed(self) -> dict[str, DataFrame]:
        """The objects with their ids and foreign keys only, so that nothing else is read and shuffled."""
        names = {"Entity": "entities", "Event": "kg_events", "Claim": "claims", "Relation": "relations"}
        keys = {c: tuple(k.field.split(".")[0] for k in rf.FOREIGN_KEYS if k.obj_type == c) for c in names}
        more = {"Claim": ("modality", "polarity")}
        return {c: current(table(self.spark, self.dir, n), only=("doc_id", *keys[c], *more.get(c, ()))) for c, n in names.items()}

    def refs(self) -> DataFrame:
        return rf.refs(self.keyed())

    def residuals(self) -> DataFrame:
        return st.load_all(self.store(), "Residual").where(F.col("segment_id").isNotNull())

    def ignores(self) -> DataFrame:
        return st.load_all(self.store(), "IgnoreSegment").where(F.col("segment_id").isNotNull())

    def index(self) -> DataFrame:
        seeds = table(self.spark, self.dir, "seed_entities").select(F.lit("Entity").alias("type"), "id")
        docs = table(self.spark, self.dir, "documents").select(F.lit("Document").alias("type"), F.col("doc_key").alias("id"))
        return rf.ids({**self.keyed(), "Segment": current(table(self.spark, self.dir, "segments"), only=())}, seeds.unionByName(docs))


def _cur(alias: str, name: str, deleted: bool) -> str:
    rows = f"select * from {name} where id is not null qualify row_number() over (partition by id order by loaded_at desc nulls last) = 1"
    return f"{alias} as (select * from ({rows})" + (" where not coalesce(is_deleted, false))" if deleted else ")")


_SEG, _CL, _RE, _EV, _EN, _BL = (_cur(*x) for x in (("sg", "segments", True), ("cl", "claims", True), ("re", "relations", False), ("ev", "kg_events", False), ("en", "entities", True), ("bl", "blocks", False)))
_ALL = ", ".join((_SEG, _CL, _RE, _EV, _EN))
_WS = r"[\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_REFS = f"""{_ALL}, refs0 as (
  select doc_id, 'Entity' obj_type, id obj_id, 'source_segment_ids' field, unnest(range(len(source_segment_ids))) pos, unnest(source_segment_ids) target_id, 'Segment' target_type from en
  union all select doc_id, 'Entity', id, 'evidence_refs.segment_id', unnest(range(len(evidence_refs))), unnest(list_transform(evidence_refs, lambda e: e.segment_id)), 'Segment' from en
  union all select doc_id, 'Event', id, 'source_segment_ids', unnest(range(len(source_segment_ids))), unnest(source_segment_ids), 'Segment' from ev
  union all select doc_id, 'Event', id, 'evidence_refs.segment_id', unnest(range(len(evidence_refs))), unnest(list_transform(evidence_refs, lambda e: e.segment_id)), 'Segment' from ev
  union all select doc_id, 'Event', id, 'participants', unnest(range(len(participants))), unnest(participants), 'Entity' from ev
  union all select doc_id, 'Claim', id, 'source_segment_ids', unnest(range(len(source_segment_ids))), unnest(source_segment_ids), 'Segment' from cl
  union all select doc_id, 'Claim', id, 'evidence_refs.segment_id', unnest(range(len(evidence_refs))), unnest(list_transform(evidence_refs, lambda e: e.segment_id)), 'Segment' from cl
  union all select doc_id, 'Claim', id, 'subject', 0, subject, 'Entity' from cl
  union all select doc_id, 'Claim', id, 'object_ref', 0, object_ref, 'Entity' from cl where contains(object_ref, '_ent_')
  union all select doc_id, 'Claim', id, 'derived_from', unnest(range(len(derived_from))), unnest(derived_from), 'Claim' from cl
  union all select doc_id, 'Claim', id, 'claim_source', 0, claim_source, 'Entity|Claim' from cl
  union all select doc_id, 'Relation', id, 'subject', 0, subject, 'Entity' from re
  union all select doc_id, 'Relation', id, 'object_ref', 0, object_ref, 'Entity' from re
  union all select doc_id, 'Relation', id, 'claim_id', 0, claim_id, 'Claim' from re
  union all select doc_id, 'Relation', id, 'evidence_refs.segment_id', unnest(range(len(evidence_refs))), unnest(list_transform(evidence_refs, lambda e: e.segment_id)), 'Segment' from re),
refs as (select * from refs0 where target_id is not null),
idx as (select 'Segment' type, id from sg union select 'Claim', id from cl union select 'Relation', id from re union select 'Event', id from ev union select 'Entity', id from en union select 'Entity', id from seed_entities),
missing as (select * from refs r where not exists (select 1 from idx i where i.id = r.target_id and contains(r.target_type, i.type)))"""

# ------------------------------------------------------------------ text layer

_LINES = f"""ln0 as (select doc_key doc_id, string_split(text, chr(10)) parts from documents where doc_key is not null and text is not null),
ln1 as (select doc_id, unnest(range(len(parts))) line_no, unnest(parts) line from ln0),
ln as (select *, cast(coalesce(sum(length(line) + 1) over (partition by doc_id order by line_no rows between unbounded preceding and 1 preceding), 0) as int) line_start,
         regexp_replace(line, '^{_WS}+|{_WS}+$', '', 'g') s from ln1),
typed as (select *, case when s = '' then null when regexp_matches(s, '^(#|第[一二三四五六七八九十百千零\\p{{Nd}}]+[回章节卷篇部])') then 'heading' when starts_with(s, '|') then 'table' when starts_with(s, '>') then 'quote'
  when regexp_matches(s, '^(- |\\* |\\p{{Nd}}+\\. )') then 'list' when starts_with(s, '```') or starts_with(line, '    ') then 'code_block' else 'paragraph' end kind from ln)"""
_BLOCKS = f"""{_LINES}, st as (select *, case when kind is not null and lag(kind) over (partition by doc_id order by line_no) is distinct from kind then 1 else 0 end start from typed),
isl as (select *, sum(start) over (partition by doc_id order by line_no) island from st),
blk as (select doc_id, cast(island - 1 as int) block_index, min(kind) block_type, min(line_start) start_offset, string_agg(line, chr(10) order by line_no) text_slice from isl where kind is not null group by doc_id, island)"""


@query(
    "document_index",
    "select doc_key id, 'sha256:' || sha256(text) raw_text_hash, length(text) total_length, strftime(make_timestamp(cast('0x' || substr(sha256(text), 1, 8) as bigint) * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00' created_at from documents where doc_key is not null and text is not null",
)
def document_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bl.documents(Base(spark, sf_dir).texts()).select("id", "raw_text_hash", "total_length", "created_at")


@query("line_types", f"with {_LINES} select doc_id, cast(line_no as int) line_no, line_start, kind from typed")
def line_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bl.lines(Base(spark, sf_dir).texts()).select("doc_id", "line_no", "line_start", bl.line_type(F.col("line")).alias("kind"))


@query(
    "block_index",
    f"with {_BLOCKS} select doc_id || '_blk_' || case when block_index < 10000 then printf('%04d', block_index) else cast(block_index as varchar) end id, doc_id, block_index, block_type, start_offset, cast(start_offset + length(text_slice) as int) end_offset, 'sha256:' || sha256(text_slice) hash from blk",
)
def block_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bl.blocks(Base(spark, sf_dir).texts()).drop("text_slice")


@query("document_blocks", f"with {_BLOCKS} select d.doc_key id, cast(count(b.doc_id) as int) block_count from (select distinct doc_key from documents where doc_key is not null and text is not null) d left join blk b on b.doc_id = d.doc_key group by 1")
def document_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Base(spark, sf_dir).texts()
    return bl.with_block_count(bl.documents(t), bl.blocks(t)).select("id", "block_count").distinct()


@query("stale_documents", "select doc_key id from documents where doc_key is not null and text is not null and 'sha256:' || sha256(text) is distinct from raw_text_hash")
def stale_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_key").alias("id"), "raw_text_hash")
    return bl.stale_documents(docs, Base(spark, sf_dir).texts().where("text is not null"))


@query("stale_documents_edited", "select doc_key id from documents where doc_key is not null and text is not null and 'sha256:' || sha256(replace(text, 'a', 'b')) is distinct from raw_text_hash")
def stale_documents_edited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check of stored hashes after an edit of the texts, which is to find every document it touched."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_key").alias("id"), "raw_text_hash")
    return bl.stale_documents(docs, Base(spark, sf_dir).texts().where("text is not null").withColumn("text", F.replace("text", F.lit("a"), F.lit("b"))))


@query(
    "stale_blocks",
    f"""with {_BL}, j as (select b.id, b.doc_id, case when d.text is null then 'no raw text' when 'sha256:' || sha256(b.text_slice) is distinct from b.hash then 'hash differs' when substr(d.text, b.start_offset + 1, b.end_offset - b.start_offset) is distinct from b.text_slice then 'slice differs' end problem
    from bl b left join documents d on d.doc_key = b.doc_id) select * from j where problem is not null""",
)
def stale_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Base(spark, sf_dir)
    return bl.stale_slices(b.get("blocks"), b.texts())


@query(
    "structural_segments",
    f"""with {_BLOCKS}, r as (select doc_id, block_index, block_type, start_offset, unnest(string_split(text_slice, chr(10))) line, unnest(range(len(string_split(text_slice, chr(10))))) pos from blk where block_type in ('table', 'list')
      union all select doc_id, block_index, block_type, start_offset, text_slice, 0 from blk where block_type in ('heading', 'code_block')),
    p as (select *, regexp_replace(line, '^{_WS}+|{_WS}+$', '', 'g') s, length(regexp_extract(line, '^({_WS}*)', 1)) ld, coalesce(sum(length(line) + 1) over (partition by doc_id, block_index order by pos rows between unbounded preceding and 1 preceding), 0) ofs from r)
    select doc_id, block_index, case block_type when 'table' then 'table_row' when 'list' then 'list_item' when 'heading' then 'heading' else 'raw' end segment_type, cast(start_offset + ofs + ld as int) start_offset, cast(start_offset + ofs + ld + length(s) as int) end_offset, 'sha256:' || sha256(s) hash from p where s <> ''""",
)
def structural_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sg.segments(bl.blocks(Base(spark, sf_dir).texts()))
    return s.where(F.col("segment_type").isin("table_row", "list_item", "heading", "raw")).select("doc_id", "block_index", "segment_type", "start_offset", "end_offset", "hash")


@query("text_layer")
def text_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents to segments without a model."""
    return sg.segments(bl.blocks(Base(spark, sf_dir).texts())).drop("text_slice")


_MARK = "第[一二三四五六七八九十百千零\\d]+回"


@query(
    "chapters",
    f"""with m as (select doc_key doc_id, text, unnest(regexp_extract_all(text, '{_MARK}')) mark, unnest(string_split_regex(text, '{_MARK}')[2:]) rest, unnest(range(len(regexp_extract_all(text, '{_MARK}')))) k, length(string_split_regex(text, '{_MARK}')[1]) lead from documents where doc_key is not null and regexp_matches(text, '{_MARK}')),
    p as (select *, length(mark) + length(rest) n from m)
    select doc_id, cast(k + 1 as int) chapter_no, regexp_replace(substr(string_split(mark || rest, chr(10))[1], 1, 40), '^{_WS}+|{_WS}+$', '', 'g') title, cast(lead + coalesce(sum(n) over (partition by doc_id order by k rows between unbounded preceding and 1 preceding), 0) as int) start_offset, cast(lead + sum(n) over (partition by doc_id order by k) as int) end_offset from p""",
)
def chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bl.chapters(Base(spark, sf_dir).texts())


@query(
    "library_summary",
    f"with {_BLOCKS} select block_type, count(*) blocks, count(distinct doc_id) documents, cast(sum(length(text_slice)) as bigint) characters from blk group by 1",
)
def library_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bl.blocks(Base(spark, sf_dir).texts()).groupBy("block_type").agg(F.count("*").alias("blocks"), F.count_distinct("doc_id").alias("documents"), F.sum(F.length("text_slice")).alias("characters"))


# ------------------------------------------------------------------ candidates

_NOISE = f"(text_slice is null or regexp_replace(text_slice, '^{_WS}+|{_WS}+$', '', 'g') = '' or (length(regexp_replace(text_slice, '^{_WS}+|{_WS}+$', '', 'g')) < 3 and not regexp_matches(text_slice, '[。！？.!?]{_WS}*$')) or (contains(text_slice, '?') and length(regexp_replace(text_slice, '^{_WS}+|{_WS}+$', '', 'g')) < 10))"


@query("noise_segments", f"with {_SEG} select id from sg where {_NOISE}")
def noise_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Base(spark, sf_dir).segments.where(ca.is_noise(F.col("text_slice"))).select("id")


@query(
    "prompt_lines",
    f"""with {_SEG}, c as (select *, lag(block_index) over (partition by doc_id order by block_index, start_offset, id) prev from sg where not {_NOISE})
    select doc_id, string_agg(case when prev <> block_index then chr(10) else '' end || '[' || id || '|' || coalesce(segment_type, '') || '] ' || text_slice, chr(10) order by block_index, start_offset, id) prompt from c group by doc_id""",
)
def prompt_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ca.prompt_lines(Base(spark, sf_dir).segments)


@query(
    "batches",
    f"""with recursive {_SEG}, o as (select doc_id, id, length(text_slice) n, row_number() over (partition by doc_id order by block_index nulls first, start_offset nulls first, id) k, sum(length(text_slice)) over (partition by doc_id) total from sg),
    f as (select doc_id, id, k, n used, 0 b, total from o where k = 1
      union all select o.doc_id, o.id, o.k, case when f.total > 4000 and f.used > 0 and f.used + o.n > 4000 then o.n else f.used + o.n end, case when f.total > 4000 and f.used > 0 and f.used + o.n > 4000 then f.b + 1 else f.b end, o.total from f join o on o.doc_id = f.doc_id and o.k = f.k + 1)
    select doc_id, id, cast(b as int) batch_index from f""",
)
def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ca.batches(Base(spark, sf_dir).segments)


def _answers(b: Base) -> DataFrame:
    return cache.answers(cache.entries(table(b.spark, b.dir, "cache_entries")))


_MODALITIES = "('asserted', 'reported', 'claimed_by_source', 'uncertain', 'hypothetical', 'conditional', 'inferred')"
_ANSWERS = """cc as (select * from cache_entries where cache_key is not null qualify row_number() over (partition by cache_key order by loaded_at desc nulls last) = 1),
an as (select doc_id, batch_index, arg_max(response.raw_text, (created_at, cache_key)) raw_text from cc where response.raw_text is not null and doc_id is not null group by 1, 2)"""
# a comma before a closing bracket, outside of strings, which DuckDB reads over
_TRAILING = """regexp_matches(regexp_replace({0}, '"(?:[^"\\\\]|\\\\.)*"', '""', 'g'), ',\\s*[\\]}}]')"""
# a fence at either end goes; then the whole text, what stands between the outer brackets, or every complete object of it
_CAND = f"""{_ANSWERS}, bd as (select doc_id, batch_index, regexp_replace(regexp_replace(regexp_replace(raw_text, '^\\s*```[a-zA-Z]*\\s*\\n?', ''), '\\n?\\s*```\\s*$', ''), '^\\s+|\\s+$', '', 'g') t from an),
tr0 as (select *, regexp_extract(t, '(?s)\\[.*\\]') m from bd),
tr as (select *, case when json_valid(t) and not {_TRAILING.format('t')} then t when m <> '' and json_valid(m) and not {_TRAILING.format('m')} then m end j from tr0),
wr as (select *, case when j is null then null when json_type(j) = 'OBJECT' then coalesce(case when json_type(j, '$.candidates') = 'ARRAY' then json_extract(j, '$.candidates') end, case when json_type(j, '$.results') = 'ARRAY' then json_extract(j, '$.results') end, case when json_type(j, '$.data') = 'ARRAY' then json_extract(j, '$.data') end,
  case when json_type(j, '$.items') = 'ARRAY' then json_extract(j, '$.items') end, json_array(cast(j as json))) else cast(j as json) end a from tr),
el as (select doc_id, batch_index, false recovered, x, row_number() over (partition by doc_id, batch_index order by k) - 1 raw_index from (select doc_id, batch_index, unnest(json_extract(a, '$[*]')) x, unnest(range(cast(json_array_length(a) as bigint))) k from wr where a is not null and json_type(a) = 'ARRAY') where json_type(x) = 'OBJECT'
  union all select doc_id, batch_index, true, cast(x as json), row_number() over (partition by doc_id, batch_index order by k) - 1 from (select doc_id, batch_index, unnest(regexp_extract_all(t, '\\{{(?:[^{{}}"]|"(?:[^"\\\\]|\\\\.)*")*\\}}')) x, unnest(range(len(regexp_extract_all(t, '\\{{(?:[^{{}}"]|"(?:[^"\\\\]|\\\\.)*")*\\}}')))) k from wr where a is null)
    where json_valid(x) and json_exists(x, '$.t') and (json_exists(x, '$.n') or json_exists(x, '$.sid'))),
fl as (select doc_id, batch_index, cast(raw_index as int) raw_index, recovered, x, json_extract_string(x, '$.t') t from el where json_type(x, '$.t') = 'VARCHAR'),
cd as (select *, t in ('E', 'EV', 'C') known, case when t in ('E', 'EV') then case when json_type(x, '$.n') = 'VARCHAR' then json_extract_string(x, '$.n') else '' end end name,
  case when t in ('E', 'EV') then case when json_exists(x, '$.k') then json_extract_string(x, '$.k') else 'other' end end kind,
  case when t = 'C' and json_type(x, '$.s') = 'VARCHAR' then json_extract_string(x, '$.s') end subject, case when t = 'C' and json_type(x, '$.p') = 'VARCHAR' then json_extract_string(x, '$.p') end predicate, case when t = 'C' then json_extract_string(x, '$.o') end as object,
  case when t = 'C' and json_extract_string(x, '$.m') in {_MODALITIES} then json_extract_string(x, '$.m') end modality,
  case when t = 'C' then case when json_extract_string(x, '$.pol') in ('positive', 'negative') then json_extract_string(x, '$.pol') else 'positive' end end polarity,
  case when t = 'C' and json_exists(x, '$.pol') then json_extract_string(x, '$.pol') when t = 'C' then 'positive' end said from fl),
cw as (select *, list_filter([case when not known then 'unknown type' end, case when name is not null and trim(name) = '' then 'missing name' end, case when t = 'C' and json_type(x, '$.m') <> 'NULL' and modality is null then 'unknown modality' end,
  case when t = 'C' and said is distinct from polarity then 'unknown polarity' end], lambda w: w is not null) warnings,
  case when not known then [] when json_type(x, '$.sid') = 'VARCHAR' then [json_extract_string(x, '$.sid')] when json_type(x, '$.sid') = 'ARRAY' then list_transform(list_filter(json_extract(x, '$.sid[*]'), lambda e: json_type(e) = 'VARCHAR'), lambda e: json_extract_string(e, '$')) else [] end sids,
  case when not known then [] when json_type(x, '$.q') = 'VARCHAR' then [json_extract_string(x, '$.q')] when json_type(x, '$.q') = 'ARRAY' then list_transform(list_filter(json_extract(x, '$.q[*]'), lambda e: json_type(e) = 'VARCHAR'), lambda e: json_extract_string(e, '$')) else [] end quotes from cd)"""


@query(
    "candidates_parsed",
    f"""with {_CAND} select doc_id, batch_index, raw_index, recovered, t, case when known then json_extract_string(x, '$.lid') end lid, name, kind, subject, predicate, object, modality, polarity, array_to_string(sids, '|') sids, array_to_string(quotes, '|') quotes, array_to_string(warnings, '|') warnings from cw""",
)
def candidates_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ca.candidates(_answers(Base(spark, sf_dir)))
    flat = lambda c: F.array_join(F.coalesce(c, F.array().cast("array<string>")), "|")
    return rows.select("doc_id", "batch_index", "raw_index", "recovered", "t", "lid", "name", "kind", "subject", "predicate", "object", "modality", "polarity", flat("sids").alias("sids"), flat("quotes").alias("quotes"), flat("warnings").alias("warnings"))


@query(
    "candidates_expanded",
    f"""with {_CAND}, {_SEG}, nu as (select *, json_extract_string(x, '$.lid') lid, doc_id || case t when 'E' then '_ent_' when 'EV' then '_evt_' else '_clm_' end || printf('%04d', row_number() over (partition by doc_id, t order by batch_index, raw_index)) id from cw where known),
    lo as (select doc_id, batch_index, lid, arg_max(id, raw_index) entity_id from nu where t = 'E' and lid is not null group by 1, 2, 3),
    rep as (select distinct nu.id from (select id, unnest(sids) sid from nu where t = 'C' and modality is null) nu join sg on sg.id = nu.sid where sg.segment_type in ('dialogue', 'heading', 'list_item', 'table_row')),
    pl as (select id, doc_id, batch_index, unnest(range(len(p))) pos, unnest(p) lid from (select id, doc_id, batch_index, case when json_type(x, '$.p') = 'VARCHAR' then [json_extract_string(x, '$.p')] when json_type(x, '$.p') = 'ARRAY' then list_transform(list_filter(json_extract(x, '$.p[*]'), lambda e: json_type(e) = 'VARCHAR'), lambda e: json_extract_string(e, '$')) else [] end p from nu where t = 'EV')),
    pn as (select pl.id, string_agg(coalesce(lo.entity_id, pl.lid), '|' order by pos) parts from pl left join lo using (doc_id, batch_index, lid) group by 1)
    select nu.id, nu.doc_id, t, name, coalesce(a.entity_id, subject) subject, predicate, coalesce(b.entity_id, object) as object, case when t = 'C' and modality is null then case when rep.id is null then 'asserted' else 'reported' end else modality end modality, polarity,
      case when t = 'EV' then coalesce(pn.parts, '') end participants
    from nu left join lo a on a.doc_id = nu.doc_id and a.batch_index = nu.batch_index and a.lid = nu.subject left join lo b on b.doc_id = nu.doc_id and b.batch_index = nu.batch_index and b.lid = nu.object left join rep on rep.id = nu.id left join pn on pn.id = nu.id""",
)
def candidates_expanded(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Base(spark, sf_dir)
    rows = cut(ca.with_ids(ca.candidates(_answers(b))), "candidates")
    done = ca.derive_modality(ca.resolve_locals(rows, ca.local_ids(rows)), b.segments)
    return done.select("id", "doc_id", "t", "name", "subject", "predicate", "object", "modality", "polarity", F.array_join("participants", "|").alias("participants"))


@query("candidate_warnings", f"with {_CAND} select t, warning, count(*) n from (select t, unnest(warnings) warning from cw) group by 1, 2")
def candidate_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ca.warnings_of(ca.candidates(_answers(Base(spark, sf_dir)))).groupBy("t", "warning").agg(F.count("*").alias("n"))


@query(
    "cache_answers",
    """with c as (select * from cache_entries where cache_key is not null qualify row_number() over (partition by cache_key order by loaded_at desc nulls last) = 1)
    select doc_id, batch_index, arg_max(response.raw_text, (created_at, cache_key)) raw_text from c where response.raw_text is not null and doc_id is not null group by 1, 2""",
)
def cache_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answers(Base(spark, sf_dir))


@query(
    "cache_plan",
    """with w as (select distinct cache_key from cache_entries where cache_key is not null),
    k as (select * from cache_entries where cache_key is not null qualify row_number() over (partition by cache_key order by loaded_at desc nulls last) = 1)
    select w.cache_key, case when k.cache_key is not null then 'use' else 'call_and_store' end as action from w left join (select cache_key from k where response.raw_text is not null) k using (cache_key)""",
)
def cache_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "cache_entries")
    return cache.plan(raw.where("cache_key is not null").select("cache_key").distinct(), cache.entries(raw))


@query(
    "entity_map",
    f"with {_EN} select doc_id, name, max(id) id from (select doc_id, id, unnest(list_prepend(name, coalesce(aliases, []))) as name from en) where name is not null and name <> '' group by doc_id, name",
)
def entity_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ca.entity_map(Base(spark, sf_dir).entities)


@query(
    "grounded_aliases",
    f"""with {_EN}, {_SEG}, a as (select distinct id, doc_id, source_segment_ids, unnest(aliases) alias from en), h as (
      select a.id, a.alias, s.id segment_id, row_number() over (partition by a.id, a.alias order by case when list_contains(a.source_segment_ids, s.id) then 0 else 1 end, s.block_index nulls first, s.start_offset nulls first, s.id) k
      from a join sg s on s.doc_id = a.doc_id and contains(s.text_slice, a.alias) where a.alias is not null and a.alias <> '')
    select id, alias, segment_id from h where k = 1""",
)
def grounded_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Base(spark, sf_dir)
    return ca.ground_aliases(b.entities, b.segments)


@query(
    "id_counters",
    f"with {_ALL} select doc_id, obj_type, max(try_cast(regexp_extract(id, '_([^_]*)$', 1) as int)) as \"last\" from (select doc_id, 'Entity' obj_type, id from en union all select doc_id, 'Event', id from ev union all select doc_id, 'Claim', id from cl) group by 1, 2",
)
def id_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Base(spark, sf_dir)
    ids = None
    for name, df in (("Entity", b.entities), ("Event", b.events), ("Claim", b.claims)):
        part = df.select("doc_id", F.lit(name).alias("obj_type"), "id")
        ids = part if ids is None else ids.unionByName(part)
    return ca.greatest_numbers(ids)


# ------------------------------------------------------------------ evidence

_NAMEQ = f"{_EN}, {_SEG}, q as (select id obj_id, 0 quote_no, name quote, unnest(source_segment_ids) segment_id from en where name is not null)"


def _name_quotes(b: Base) -> DataFrame:
    return b.entities.where("name is not null").select(F.col("id").alias("obj_id"), F.lit(0).alias("quote_no"), F.col("name").alias("quote"), F.explode("source_segment_ids").alias("segment_id"))


@query(
    "quotes_placed",
    f"""with {_NAMEQ}, h as (select distinct obj_id, quote_no, q.segment_id, quote, text_slice, strpos(text_slice, quote) p from q join sg on sg.id = q.segment_id where length(quote) > 0)
    select obj_id, quote_no, segment_id, cast(p - 1 as int) span_start, cast(p - 1 + length(quote) as int) span_end, 'sha256:' || sha256(quote) quote_hash, strpos(substr(text_slice, p + 1), quote) > 0 as ambiguous from h where p > 0""",
)
def quotes_placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Base(spark, sf_dir)
    return ev.place_quotes(_name_quotes(b), b.segments)


@query("quotes_unplaced", f"with {_NAMEQ} select obj_id, quote_no from q group by 1, 2 having not coalesce(bool_or(exists (select 1 from sg where sg.id = q.segment_id and length(q.quote) > 0 and contains(sg.text_slice, q.quote))), false)")
def quotes_unplaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Base(spark, sf_dir)
    return ev.unplaced(_name_quotes(b), b.segments)


@query("without_evidence", f"with {_ALL} select 'Claim' obj_type, id obj_id from cl where coalesce(len(evidence_refs), 0) = 0 and coalesce(modality, '') <> 'inferred' union all select 'Event', id from ev where coalesce(len(evidence_refs), 0) = 0")
def without_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Base(spark, sf_dir)
    return ev.without_evidence(b.claims, b.events)


@query(
    "broken_spans",
    f"""with {_ALL}, e as (select 'Entity' obj_type, id obj_id, unnest(range(len(evidence_refs))) pos, unnest(evidence_refs) e from en union all select 'Event', id, unnest(range(len(evidence_refs))), unnest(evidence_refs) from ev
      union all select 'Claim', id, unnest(range(len(evidence_refs))), unnest(evidence_refs) from cl union all select 'Relation', id, unnest(range(len(evidence_refs))), unnest(evidence_refs) from re),
    j as (select obj_type, obj_id, cast(pos as int) pos, e.segment_id segment_id, case when not coalesce(e.span_start >= 0 and e.span_end > e.span_start and e.span_end <= length(s.text_slice), false) then 'span'
      when 'sha256:' || sha256(substr(s.text_slice, e.span_start + 1, e.span_end - e.span_start)) is distinct from e.quote_hash then 'hash' end problem from e join sg s on s.id = e.segment_id)
    select * from j where problem is not null""",
)
def broken_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Base(spark, sf_dir)
    return ev.broken_spans(ev.exploded(b.objects()), b.segments)


@query("wrong_hashes", f"with {_SEG} select id from sg where 'sha256:' || sha256(text_slice) is distinct from hash")
def wrong_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.wrong_hashes(Base(spark, sf_dir).segments)


def _cut_short(b: Base) -> DataFrame:
    """Segments that have lost their first character."""
    return b.segments.withColumn("text_slice", F.substring("text_slice", 2, 1_000_000_000))


@query(
    "broken_spans_edited",
    f"""with {_ALL}, e as (select 'Entity' obj_type, id obj_id, unnest(range(len(evidence_refs))) pos, unnest(evidence_refs) e from en union all select 'Event', id, unnest(range(len(evidence_refs))), unnest(evidence_refs) from ev
      union all select 'Claim', id, unnest(range(len(evidence_refs))), unnest(evidence_refs) from cl union all select 'Relation', id, unnest(range(len(evidence_refs))), unnest(evidence_refs) from re),
    s2 as (select id, substr(text_slice, 2) text_slice from sg),
    j as (select obj_type, obj_id, cast(pos as int) pos, e.segment_id segment_id, case when not coalesce(e.span_start >= 0 and e.span_end > e.span_start and e.span_end <= length(s.text_slice), false) then 'span'
      when 'sha256:' || sha256(substr(s.text_slice, e.span_start + 1, e.span_end - e.span_start)) is distinct from e.quote_hash then 'hash' end problem from e join s2 s on s.id = e.segment_id)
    select * from j where problem is not null""",
)
def broken_spans_edited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check of spans against segments that have lost a character: what it must find."""
    b = Base(spark, sf_dir)
    return ev.broken_spans(ev.exploded(b.objects()), _cut_short(b))


@query("wrong_hashes_edited", f"with {_SEG} select id from sg where 'sha256:' || sha256(substr(text_slice, 2)) is distinct from hash")
def wrong_hashes_edited(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.wrong_hashes(_cut_short(Base(spark, sf_dir)))


# ------------------------------------------------------------------ references and gates


@query("dangling_references", f"with {_REFS} select doc_id, obj_type, obj_id, field, cast(pos as int) pos, target_type, target_id from missing")
def dangling_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Base(spark, sf_dir)
    return rf.dangling(b.refs(), b.index()).select("doc_id", "obj_type", "obj_id", "field", "pos", "target_type", "target_id")


@query("reference_issues", f"with {_REFS} select r.obj_type, r.field, count(*) total, (select count(*) from missing m where m.obj_type = r.obj_type and m.field = r.field) dangling from refs r group by 1, 2")
def reference_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Base(spark, sf_dir)
    return me.reference_issues(b.refs(), b.index())


@query("segments_with_objects", f"with {_REFS} select id from sg where exists (select 1 from refs r where r.target_type = 'Segment' and r.target_id = sg.id)")
def segments_with_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Base(spark, sf_dir)
    return rf.segments_with_objects(b.segments, b.refs()).select("id")


@query("duplicate_ids", "select 'Claim' obj_type, id obj_id, count(*) - 1 extra from claims where id is not null group by id having count(*) > 1 union all select 'Segment', id, count(*) - 1 from segments where id is not null group by id having count(*) > 1 union all select 'Entity', id, count(*) - 1 from entities where id is not null group by id having count(*) > 1")
def duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = {k: table(spark, sf_dir, n).where("id is not null") for k, n in (("Claim", "claims"), ("Segment", "segments"), ("Entity", "entities"))}
    return va.unique_ids(raw).groupBy("obj_type", "obj_id").agg(F.count("*").alias("extra"))


_MOD = "('asserted', 'reported', 'claimed_by_source', 'uncertain', 'hypothetical', 'conditional', 'inferred')"


@query(
    "schema_violations",
    f"""with {_ALL}, {_BL}, v as (
      select 'Claim' obj_type, id obj_id, unnest([case when subject is null then 'subject:missing' end, case when predicate is null then 'predicate:missing' end, case when modality is null then 'modality:missing' end, case when polarity is null then 'polarity:missing' end,
        case when modality not in {_MOD} then 'modality:not allowed' end, case when polarity not in ('positive', 'negative') then 'polarity:not allowed' end, case when confidence < 0 or confidence > 1 then 'confidence:out of range' end]) x from cl
      union all select 'Entity', id, unnest([case when name is null then 'name:missing' end, case when kind is null then 'kind:missing' end]) from en
      union all select 'Event', id, unnest([case when name is null then 'name:missing' end, case when kind is null then 'kind:missing' end]) from ev
      union all select 'Relation', id, unnest([case when subject is null then 'subject:missing' end, case when predicate is null then 'predicate:missing' end, case when object_ref is null then 'object_ref:missing' end, case when claim_id is null then 'claim_id:missing' end]) from re
      union all select 'Segment', id, unnest([case when doc_id is null then 'doc_id:missing' end, case when block_index is null then 'block_index:missing' end, case when segment_type is null then 'segment_type:missing' end, case when start_offset is null then 'start_offset:missing' end, case when end_offset is null then 'end_offset:missing' end,
        case when text_slice is null then 'text_slice:missing' end, case when hash is null then 'hash:missing' end, case when segment_type not in ('sentence', 'clause', 'dialogue', 'table_row', 'heading', 'list_item', 'raw') then 'segment_type:not allowed' end]) from sg
      union all select 'Block', id, unnest([case when doc_id is null then 'doc_id:missing' end, case when block_index is null then 'block_index:missing' end, case when block_type is null then 'block_type:missing' end, case when start_offset is null then 'start_offset:missing' end, case when end_offset is null then 'end_offset:missing' end,
        case when text_slice is null then 'text_slice:missing' end, case when hash is null then 'hash:missing' end, case when block_type not in ('paragraph', 'heading', 'table', 'code_block', 'list', 'quote', 'raw') then 'block_type:not allowed' end]) from bl)
    select obj_type, obj_id, split_part(x, ':', 1) field, split_part(x, ':', 2) message from v where x is not null
    union all select 'Residual', id, split_part(x, ':', 1), split_part(x, ':', 2) from (select json_extract_string(data, '$.id') id, unnest([case when json_extract_string(data, '$.category') is null then 'category:missing' end, case when json_extract_string(data, '$.importance') is null then 'importance:missing' end, case when json_extract_string(data, '$.reason') is null then 'reason:missing' end,
      case when json_extract_string(data, '$.category') not in ('structural', 'stylistic', 'pragmatic', 'modal', 'interpersonal', 'cultural', 'implication', 'other') then 'category:not allowed' end, case when json_extract_string(data, '$.importance') not in ('medium', 'high') then 'importance:not allowed' end]) x
      from (select arg_max(data, loaded_at) data from objects where obj_type = 'Residual' group by obj_id) where json_valid(data) and json_extract_string(data, '$.segment_id') is not null) where id is not null and x is not null""",
)
def schema_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Base(spark, sf_dir)
    return va.schema({**b.objects(), "Segment": b.segments, "Block": b.get("blocks"), "Residual": b.residuals()}).select("obj_type", "obj_id", "field", "message")


@query("self_claims", f"with {_CL} select id from cl where subject = object_ref and contains(subject, '_ent_')")
def self_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va.self_claims(Base(spark, sf_dir).claims).select(F.col("obj_id").alias("id"))


@query(
    "claim_safety",
    f"""with {_CL}, {_RE}, n as (select claim_id, count(*) n from re where claim_id is not null group by 1), c as (select cl.*, coalesce(n.n, 0) n from cl left join n on n.claim_id = cl.id),
    r as (select id, doc_id, unnest([case when modality = 'inferred' and coalesce(len(derived_from), 0) = 0 then 'inferred_requires_source' end, case when n > 0 and modality = 'reported' and polarity = 'positive' then 'no_asserted_from_reported' end,
      case when n > 0 and modality = 'claimed_by_source' and polarity = 'positive' then 'no_asserted_from_claimed' end, case when n > 0 and modality in ('uncertain', 'hypothetical') then 'no_uncertain_default_fact' end,
      case when n > 0 and modality = 'conditional' then 'no_unconditional_from_conditional' end, case when n > 0 and polarity = 'negative' then 'no_positive_from_negative' end]) as rule from c)
    select id, doc_id, rule from r where rule is not null""",
)
def claim_safety(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Base(spark, sf_dir)
    return va.claim_safety(b.claims, b.relations)


_VIOL = f"""{_REFS}, {_BL},
sgv as (select 'Segment' obj_type, id, unnest([case when doc_id is null then 'doc_id:missing' end, case when block_index is null then 'block_index:missing' end, case when segment_type is null then 'segment_type:missing' end, case when start_offset is null then 'start_offset:missing' end, case when end_offset is null then 'end_offset:missing' end,
  case when text_slice is null then 'text_slice:missing' end, case when hash is null then 'hash:missing' end, case when segment_type not in ('sentence', 'clause', 'dialogue', 'table_row', 'heading', 'list_item', 'raw') then 'segment_type:not allowed' end]) x from sg),
schv as (select 'Claim' obj_type, id, unnest([case when subject is null then 'subject:missing' end, case when predicate is null then 'predicate:missing' end, case when modality is null then 'modality:missing' end, case when polarity is null then 'polarity:missing' end,
    case when modality not in {_MOD} then 'modality:not allowed' end, case when polarity not in ('positive', 'negative') then 'polarity:not allowed' end, case when confidence < 0 or confidence > 1 then 'confidence:out of range' end]) x from cl
  union all select 'Entity', id, unnest([case when name is null then 'name:missing' end, case when kind is null then 'kind:missing' end]) from en
  union all select 'Event', id, unnest([case when name is null then 'name:missing' end, case when kind is null then 'kind:missing' end]) from ev
  union all select 'Relation', id, unnest([case when subject is null then 'subject:missing' end, case when predicate is null then 'predicate:missing' end, case when object_ref is null then 'object_ref:missing' end, case when claim_id is null then 'claim_id:missing' end]) from re
  union all select * from sgv),
evx as (select 'Entity' obj_type, id obj_id, unnest(evidence_refs) e from en union all select 'Event', id, unnest(evidence_refs) from ev union all select 'Claim', id, unnest(evidence_refs) from cl union all select 'Relation', id, unnest(evidence_refs) from re),
spv as (select obj_type, obj_id from evx join sg s on s.id = e.segment_id where not coalesce(e.span_start >= 0 and e.span_end > e.span_start and e.span_end <= length(s.text_slice), false) or 'sha256:' || sha256(substr(s.text_slice, e.span_start + 1, e.span_end - e.span_start)) is distinct from e.quote_hash),
nrel as (select claim_id, count(*) n from re where claim_id is not null group by 1), csf as (select cl.*, coalesce(nrel.n, 0) n from cl left join nrel on nrel.claim_id = cl.id),
rulev as (select id, unnest([case when modality = 'inferred' and coalesce(len(derived_from), 0) = 0 then 1 end, case when n > 0 and modality = 'reported' and polarity = 'positive' then 1 end,
  case when n > 0 and modality = 'claimed_by_source' and polarity = 'positive' then 1 end, case when n > 0 and modality in ('uncertain', 'hypothetical') then 1 end,
  case when n > 0 and modality = 'conditional' then 1 end, case when n > 0 and polarity = 'negative' then 1 end]) r from csf),
docv as (select s.id from sg s where s.doc_id is not null and not exists (select 1 from documents d where d.doc_key = s.doc_id)),
objv as (
  select 'schema' gate, 'ERROR' severity, obj_type, id obj_id from schv where x is not null
  union all select 'reference', 'ERROR', obj_type, obj_id from missing
  union all select 'evidence', 'ERROR', 'Claim', id from cl where coalesce(len(evidence_refs), 0) = 0 and coalesce(modality, '') <> 'inferred' union all select 'evidence', 'ERROR', 'Event', id from ev where coalesce(len(evidence_refs), 0) = 0
  union all select 'evidence', 'ERROR', obj_type, obj_id from spv
  union all select 'evidence', 'ERROR', 'Segment', id from sg where 'sha256:' || sha256(text_slice) is distinct from hash
  union all select 'self_reference', 'ERROR', 'Claim', id from cl where subject = object_ref and contains(subject, '_ent_')
  union all select 'claim_safety', 'ERROR', 'Claim', id from rulev where r is not null)"""


@query(
    "violations_by_gate",
    f"""with {_VIOL}, allv as (select * from objv union all select 'reference', 'ERROR', 'Segment', id from docv
      union all select 'evidence', case when d.doc_key is null then 'WARNING' else 'ERROR' end, 'Segment', s.id from sg s left join documents d on d.doc_key = s.doc_id and d.text is not null
        where d.doc_key is null or ('sha256:' || sha256(s.text_slice) is not distinct from s.hash and substr(d.text, s.start_offset + 1, s.end_offset - s.start_offset) is distinct from s.text_slice))
    select gate, severity, obj_type, count(*) issues from allv group by 1, 2, 3""",
)
def violations_by_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Base(spark, sf_dir)
    objects, segments = {k: cut(v, "objects") for k, v in b.objects().items()}, cut(b.segments, "segments")
    return me.issues_by(va.validate(objects, segments, b.index(), b.texts()))


@query("unknown_types", "select distinct obj_type from objects where obj_type is null or obj_type not in ('Document', 'Block', 'Segment', 'Entity', 'Event', 'Claim', 'Relation', 'Residual', 'IgnoreSegment', 'CoverageReport')")
def unknown_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va.unknown_types(table(spark, sf_dir, "objects")).select("obj_type").distinct()


@query("unknown_types_edited", "select distinct obj_type || 's' obj_type from objects where obj_type is not null")
def unknown_types_edited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes spelled in the plural are unknown."""
    return va.unknown_types(table(spark, sf_dir, "objects").where("obj_type is not null").withColumn("obj_type", F.concat("obj_type", F.lit("s")))).select("obj_type").distinct()


# ------------------------------------------------------------------ relations and resolution

_ELIG = f"""{_CL}, {_EN}, el as (select c.*, case when modality is distinct from 'asserted' then 'modality' when polarity is distinct from 'positive' then 'polarity' when not exists (select 1 from en where en.id = c.subject) then 'subject'
  when not exists (select 1 from en where en.id = c.object_ref) then 'object' when coalesce(len(evidence_refs), 0) = 0 and coalesce(len(source_segment_ids), 0) = 0 then 'evidence' end skip_reason from cl c)"""


@query("relation_skips", f"with {_ELIG} select id, skip_reason from el where skip_reason is not null")
def relation_skips(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Base(spark, sf_dir)
    return rl.eligibility(b.claims, b.entities).where("skip_reason is not null").select("id", "skip_reason")


@query(
    "relations_derived",
    f"""with {_ELIG}, g as (select doc_id, subject, predicate, object_ref, min(id) claim_id, count(*) claims, len(list_distinct(flatten(list(coalesce(evidence_refs, []))))) evidence from el where skip_reason is null group by all)
    select regexp_replace(claim_id, '^(.*?)_clm_', '\\1_rel_clm_') id, doc_id, subject, predicate, object_ref, claim_id, claims, cast(evidence as int) evidence from g""",
)
def relations_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Base(spark, sf_dir)
    return rl.derive(b.claims, b.entities).select("id", "doc_id", "subject", "predicate", "object_ref", "claim_id", "claims", F.size("evidence_refs").alias("evidence"))


@query("relations_dedup", f"with {_RE} select doc_id, subject, predicate, object_ref, min(id) id from re group by 1, 2, 3, 4")
def relations_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rl.dedup(Base(spark, sf_dir).relations).select("doc_id", "subject", "predicate", "object_ref", "id")


_OWNERS = f"""{_ALL}, gt as (select doc_id, id, list_filter(list_prepend(name, coalesce(aliases, [])), lambda t: t is not null and t <> '') ts, row_number() over (partition by doc_id order by id) k from en),
fold as (select doc_id, id, k, id as to_id, map_from_entries(list_transform(list_distinct(ts), lambda t: {{'k': t, 'v': id}})) as own from gt where k = 1
  union all select g.doc_id, g.id, g.k, g.to_id, map_concat(g.own, map_from_entries(list_transform(list_distinct(g.ts), lambda t: {{'k': t, 'v': g.to_id}}))) from (
    select gt.*, fold.own, coalesce(list_filter(list_transform(gt.ts, lambda t: map_extract_value(fold.own, t)), lambda o: o is not null)[1], gt.id) to_id from fold join gt on gt.doc_id = fold.doc_id and gt.k = fold.k + 1) g),
owners as (select doc_id, id, to_id canonical_id from fold)"""


@query("entity_resolution", f"with recursive {_OWNERS} select * from owners")
def entity_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rs.canonical(Base(spark, sf_dir).entities)


@query(
    "entity_components",
    f"""with recursive {_EN}, ct as (select distinct doc_id, id, unnest(list_prepend(name, coalesce(aliases, []))) t from en), ce as (select distinct a.doc_id, a.id x, b.id y from ct a join ct b on a.doc_id = b.doc_id and a.t = b.t where a.t is not null and a.t <> ''),
    reach as (select doc_id, id x, id y from en union select r.doc_id, r.x, ce.y from reach r join ce on ce.doc_id = r.doc_id and ce.x = r.y)
    select doc_id, x id, min(y) canonical_id from reach group by 1, 2""",
)
def entity_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rs.canonical(Base(spark, sf_dir).entities, mode="components")


@query(
    "entities_merged",
    f"""with recursive {_OWNERS}, mem as (select o.canonical_id, e.* from owners o join en e on e.id = o.id),
    nm as (select canonical_id, id, unnest(range(1 + len(coalesce(aliases, [])))) p, unnest(list_prepend(name, coalesce(aliases, []))) n from mem), nf as (select canonical_id, n, min((id, p)) k from nm where n is not null group by 1, 2),
    sf as (select canonical_id, list_sort(list_distinct(list(sid))) s from (select canonical_id, unnest(source_segment_ids) sid from mem) group by 1),
    rf as (select canonical_id, count(*) r from (select distinct canonical_id, u from (select canonical_id, unnest(evidence_refs) u from mem)) group by 1)
    select e.id, e.doc_id, e.name, e.kind, coalesce((select string_agg(n, '|' order by k) from nf where nf.canonical_id = e.id and nf.n is distinct from e.name), '') aliases, cast(coalesce(rf.r, 0) as int) evidence, coalesce(array_to_string(sf.s, '|'), '') segments
    from en e join owners o on o.id = e.id and o.canonical_id = e.id left join sf on sf.canonical_id = e.id left join rf on rf.canonical_id = e.id""",
)
def entities_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = cut(Base(spark, sf_dir).entities, "entities")
    m = rs.merge(e, rs.canonical(e))
    return m.select("id", "doc_id", "name", "kind", F.array_join("aliases", "|").alias("aliases"), F.size("evidence_refs").alias("evidence"), F.array_join("source_segment_ids", "|").alias("segments"))


@query(
    "claims_rewritten",
    f"""with recursive {_OWNERS}, c as (select cl.id, coalesce(a.canonical_id, subject) subject, predicate, coalesce(b.canonical_id, object_ref) object_ref from cl left join owners a on a.id = cl.subject left join owners b on b.id = cl.object_ref)
    select * from c where not coalesce(subject = object_ref, false)""",
)
def claims_rewritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Base(spark, sf_dir)
    owners = cut(rs.canonical(b.entities), "owners")
    kept, _ = rs.without_self_claims(rs.rewrite(b.claims, owners, ("subject", "object_ref", "claim_source")), b.relations)
    return kept.select("id", "subject", "predicate", "object_ref")


@query(
    "participants_rewritten",
    f"""with recursive {_OWNERS}, p as (select id, unnest(range(len(participants))) pos, unnest(participants) x from ev), m as (select p.id, coalesce(o.canonical_id, p.x) x, min(pos) pos from p left join owners o on o.id = p.x group by 1, 2)
    select ev.id, case when participants is null then null else coalesce((select string_agg(x, '|' order by pos) from m where m.id = ev.id), '') end participants from ev""",
)
def participants_rewritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Base(spark, sf_dir)
    return rs.rewrite_array(b.events, rs.canonical(b.entities), "participants").select("id", F.array_join("participants", "|").alias("participants"))


# ------------------------------------------------------------------ repair, residuals, coverage


_GOOD = """bad as (select distinct obj_type, obj_id from objv where gate <> 'reference'), gone as (select obj_type || chr(31) || obj_id k from bad),
ken as (select * from en where 'Entity' || chr(31) || id not in (select k from gone)), kev as (select * from ev where 'Event' || chr(31) || id not in (select k from gone)),
kcl as (select * from cl where 'Claim' || chr(31) || id not in (select k from gone)), kre as (select * from re where 'Relation' || chr(31) || id not in (select k from gone)),
rcl as (select * from kcl c where c.subject in (select id from ken) and (c.object_ref is null or not contains(c.object_ref, '_ent_') or c.object_ref in (select id from ken))),
rre as (select * from kre r where r.subject in (select id from ken) and r.object_ref in (select id from ken) and r.claim_id in (select id from kcl))"""


@query("repaired", f"with {_VIOL}, {_GOOD} select 'Entity' obj_type, id from ken union all select 'Event', id from kev union all select 'Claim', id from rcl union all select 'Relation', id from rre")
def repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Base(spark, sf_dir)
    objects, _ = rp.repair_loop({k: cut(v, "objects") for k, v in b.objects().items()}, cut(b.segments, "segments"), attempts=1)
    out = None
    for name, df in objects.items():
        part = df.select(F.lit(name).alias("obj_type"), "id")
        out = part if out is None else out.unionByName(part)
    return out


_CLASS = """case when regexp_matches(text_slice, '「|」|『|』|说道|道：|笑道|叹道|哭道|骂道|叫道|问道|答道') then 'interpersonal' when regexp_matches(text_slice, '太太|奶奶|老爷|大爷|姑娘|小姐|嫂子|婶子|嫂嫂') and length(text_slice) >= 20 then 'interpersonal'
  when regexp_matches(text_slice, '只见|但见|原来|好一个|果然') then 'stylistic' else 'structural' end"""


@query("residual_classes", f"with {_SEG}, c as (select id, {_CLASS} category from sg where text_slice is not null) select id, category, case category when 'interpersonal' then 'high' else 'medium' end importance from c")
def residual_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = rp.classify(F.col("text_slice"))
    return Base(spark, sf_dir).segments.where("text_slice is not null").select("id", c["category"].alias("category"), c["importance"].alias("importance"))


@query("uncovered_segments", f"with {_REFS} select id from sg where not exists (select 1 from refs r where r.target_type = 'Segment' and r.target_id = sg.id)")
def uncovered_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Base(spark, sf_dir)
    return rp.uncovered(b.segments, b.refs()).select("id")


@query("second_pass", f"with {_REFS} select id from sg where not exists (select 1 from refs r where r.field = 'source_segment_ids' and r.target_id = sg.id)")
def second_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Base(spark, sf_dir)
    return rp.second_pass(b.segments, b.objects()).select("id")


_CLASS_OF = f"""case when true then ({_CLASS}) end"""


@query(
    "raw_fallback",
    f"""with {_VIOL}, bad as (select distinct obj_type, obj_id from objv union select 'Segment', id from docv), nms as (select distinct r.target_id id from refs r join bad b on b.obj_type = r.obj_type and b.obj_id = r.obj_id where r.target_type = 'Segment'),
    a as (select sg.id segment_id, doc_id, 'structural' category, 'high' importance from sg join nms on nms.id = sg.id union all
      select id, doc_id, category, case category when 'interpersonal' then 'high' else 'medium' end from (select id, doc_id, {_CLASS_OF} category from sg where id not in (select id from nms) and not exists (select 1 from refs r where r.target_type = 'Segment' and r.target_id = sg.id)))
    select concat_ws('_', doc_id, 'res_raw', segment_id) id, doc_id, segment_id, category, importance from a""",
)
def raw_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Base(spark, sf_dir)
    objects, segments = {k: cut(v, "objects") for k, v in b.objects().items()}, cut(b.segments, "segments")
    return rp.raw_fallback(segments, rf.refs(objects), cut(va.validate(objects, segments, b.index()), "violations"))


_RES = """ob as (select obj_type, obj_id, arg_max(data, loaded_at) data from objects where obj_type is not null or obj_id is not null group by 1, 2),
res as (select json_extract_string(data, '$.segment_id') segment_id, json_extract_string(data, '$.importance') importance, json_extract_string(data, '$.category') category from ob where obj_type = 'Residual' and json_valid(data) and json_extract_string(data, '$.id') is not null and json_extract_string(data, '$.segment_id') is not null)"""
_STATUS = f"""{_REFS}, {_RES}, ign as (select distinct json_extract_string(data, '$.segment_id') segment_id from ob where obj_type = 'IgnoreSegment' and json_valid(data) and json_extract_string(data, '$.id') is not null and json_extract_string(data, '$.segment_id') is not null), pa as (select distinct obj_type, obj_id, target_id segment_id, field = 'source_segment_ids' src from refs where target_type = 'Segment'),
se as (select p.segment_id, count(*) object_count, coalesce(bool_or(p.obj_type = 'Claim' and exists (select 1 from cl where cl.id = p.obj_id and (cl.modality is distinct from 'asserted' or cl.polarity is distinct from 'positive'))), false) doubt from pa p group by 1),
rg as (select segment_id, bool_or(importance = 'high') high from res group by 1),
stt as (select sg.doc_id, sg.id segment_id, case when ig.segment_id is not null then 'ignored' when se.segment_id is not null and rg.segment_id is null then 'covered' when se.segment_id is not null then 'partial' when rg.segment_id is not null then 'raw_only' else 'uncovered' end status, coalesce(rg.high, false) high, coalesce(se.doubt, false) doubt, coalesce(se.object_count, 0) object_count
  from sg left join se on se.segment_id = sg.id left join rg on rg.segment_id = sg.id left join ign ig on ig.segment_id = sg.id)"""


def _statuses(b: Base) -> DataFrame:
    keyed = b.keyed()
    return co.status(current(table(b.spark, b.dir, "segments"), only=("doc_id",)), rf.refs(keyed), keyed["Claim"], b.residuals(), b.ignores())


@query("coverage_status", f"with {_STATUS} select doc_id, segment_id, status, status in ('partial', 'raw_only', 'uncovered') or high or doubt as raw_fallback, object_count from stt")
def coverage_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _statuses(Base(spark, sf_dir))


@query(
    "coverage_report",
    f"with {_STATUS} select doc_id, count(*) total_segments, count(*) filter (status = 'covered') covered, count(*) filter (status = 'partial') \"partial\", count(*) filter (status = 'raw_only') raw_only, count(*) filter (status = 'uncovered') uncovered, count(*) filter (status = 'ignored') ignored, count(*) filter (status in ('partial', 'raw_only', 'uncovered') or high or doubt) fallback from stt group by doc_id",
)
def coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return co.report(_statuses(Base(spark, sf_dir)))


@query("coverage_gate", f"with {_STATUS} select doc_id, cast(count(*) as varchar) || ' uncovered segments' message from stt where status = 'uncovered' group by 1")
def coverage_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va.coverage(_statuses(Base(spark, sf_dir))).select("doc_id", "message")


@query("coverage_sourced", f"with {_REFS}, h as (select distinct target_id from refs where field = 'source_segment_ids') select doc_id, count(*) segments, count(h.target_id) sourced, round(count(h.target_id) / count(*), 4) rate from sg left join h on h.target_id = sg.id group by 1")
def coverage_sourced(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Base(spark, sf_dir)
    return co.sourced(b.segments, b.refs())


@query(
    "coverage_by_count",
    f"with {_REFS}, n as (select target_id, count(*) n from refs where field = 'source_segment_ids' group by 1) select doc_id, id segment_id, coalesce(n, 0) as \"references\", case when coalesce(n, 0) >= 2 then 'covered' when n = 1 then 'partial' else 'uncovered' end status from sg left join n on n.target_id = sg.id",
)
def coverage_by_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Base(spark, sf_dir)
    return co.by_count(b.segments, b.refs())


# ------------------------------------------------------------------ metrics

_GROUND = f"""{_EN}, {_SEG}, sp as (select distinct id, doc_id, unnest(list_prepend(name, coalesce(aliases, []))) spelling from en), nm as (select e.id, s.text_slice from (select distinct id, unnest(source_segment_ids) segment_id from en) e join sg s on s.id = e.segment_id),
gr as (select sp.id, sp.doc_id, count(*) names, bool_or(exists (select 1 from nm where nm.id = sp.id)) sourced, count(*) filter (not exists (select 1 from nm where nm.id = sp.id and contains(nm.text_slice, sp.spelling))) missing from sp where spelling is not null group by 1, 2)"""


@query("grounding", f"with {_GROUND} select id, doc_id, case when sourced then missing else 1 end issues, names from gr")
def grounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Base(spark, sf_dir)
    return me.grounding(b.entities, b.segments)


@query("grounding_rate", f"with {_GROUND} select cast(sum(case when sourced then missing else 1 end) as bigint) issues, cast(sum(names) as bigint) names, round(1 - sum(case when sourced then missing else 1 end) / sum(names), 6) rate from gr")
def grounding_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Base(spark, sf_dir)
    return me.grounding_rate(me.grounding(b.entities, b.segments))


@query("event_density", f"with {_SEG}, {_EV}, e as (select doc_id, count(*) n from ev group by 1) select sg.doc_id, coalesce(max(e.n), 0) as events, count(*) segments, round(coalesce(max(e.n), 0) / count(*), 6) density from sg left join e on e.doc_id = sg.doc_id group by 1")
def event_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Base(spark, sf_dir)
    return me.event_density(b.events, b.segments)


@query("entity_conflicts", f"with {_EN}, t as (select work_id, id, unnest(list_prepend(name, coalesce(aliases, []))) as token from en) select work_id, token, count(distinct id) ids from t where token is not null and token <> '' group by 1, 2 having count(distinct id) > 1")
def entity_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return me.conflicts(Base(spark, sf_dir).entities)


@query(
    "evidence_rate",
    f"with {_ALL}, u as (select 'Entity' obj_type, evidence_refs from en union all select 'Event', evidence_refs from ev union all select 'Claim', evidence_refs from cl) select obj_type, count(*) as objects, count(*) filter (len(evidence_refs) > 0) with_evidence, round(count(*) filter (len(evidence_refs) > 0) / count(*), 6) rate from u group by 1",
)
def evidence_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Base(spark, sf_dir)
    return me.evidence_rate({k: v for k, v in b.objects().items() if k != "Relation"})


_ENTROPY = f"{_RES}, p as (select 'category' m, count(*) / sum(count(*)) over () p from res group by category union all select 'importance', count(*) / sum(count(*)) over () from res group by importance)"


@query("residual_entropy", f"with {_ENTROPY} select m measured, count(*) groups, round(-sum(p * log2(p)), 6) entropy from p group by 1")
def residual_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = Base(spark, sf_dir).residuals()
    return me.entropy(r, "category").unionByName(me.entropy(r, "importance"))


@query(
    "metric_glossary",
    f"""with {_STATUS}, p as (select count(*) / sum(count(*)) over (partition by m) p from (select 'c' m, category v from res union all select 'i', importance from res) group by m, v),
    f as (select distinct name from en where lower(kind) in ('org', 'organisation') and name is not null), t as (select distinct name from seed_entities where kind = 'org')
    select 'ER' metric, round((select count(*) from f where name in (select name from t)) / nullif((select count(*) from t), 0), 6) as value union all select 'EP', round((select count(*) from f where name in (select name from t)) / nullif((select count(*) from f), 0), 6)
    union all select 'RR', round(1 - (select count(*) from missing) / (select count(*) from refs), 6) union all select 'SCR', round((select count(*) filter (status in ('covered', 'partial')) / count(*) from stt), 6)
    union all select 'ECR', round(((select count(*) filter (len(evidence_refs) > 0) from en) + (select count(*) filter (len(evidence_refs) > 0) from ev) + (select count(*) filter (len(evidence_refs) > 0) from cl)) / ((select count(*) from en) + (select count(*) from ev) + (select count(*) from cl)), 6)
    union all select 'RD', round(-(select sum(p * log2(p)) from p), 6) union all select 'PC', round((select count(*) filter (predicate in (select predicate from cl group by 1 having count(distinct doc_id) >= 3)) / count(*) from cl), 6)""",
)
def metric_glossary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The measures of a library under their short names; the vocabulary of predicates is what three documents or more use."""
    b = Base(spark, sf_dir)
    org = b.entities.where("lower(kind) in ('org', 'organisation') and name is not null")
    words = b.claims.where("predicate is not null").groupBy("predicate").agg(F.count_distinct("doc_id").alias("n")).where("n >= 3").select("predicate")
    objects = {k: v for k, v in b.objects().items() if k != "Relation"}
    return me.glossary(me.recall_precision(org, table(spark, sf_dir, "seed_entities").where("kind = 'org'")), me.reference_issues(b.refs(), b.index()), _statuses(b), me.evidence_rate(objects), b.residuals(), b.claims, words)


@query("predicates", f"with {_CL} select predicate, count(*) claims, count(distinct subject) subjects from cl group by 1")
def predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return me.predicates(Base(spark, sf_dir).claims)


@query(
    "recall_precision",
    f"with {_EN}, f as (select distinct name from en where lower(kind) in ('org', 'organisation') and name is not null), t as (select distinct name from seed_entities where kind = 'org'), j as (select f.name f, t.name t from f full join t on f.name = t.name), n as (select count(*) filter (f is not null and t is not null) tp, count(*) filter (t is null) fp, count(*) filter (f is null) fn from j) select tp, fp, fn, round(tp / nullif(tp + fn, 0), 6) recall, round(tp / nullif(tp + fp, 0), 6) as \"precision\" from n",
)
def recall_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = Base(spark, sf_dir).entities.where("lower(kind) in ('org', 'organisation') and name is not null")
    return me.recall_precision(found, table(spark, sf_dir, "seed_entities").where("kind = 'org'"))


@query("object_counts", f"with {_ALL} select 'Entity' obj_type, count(*) as objects from en union all select 'Event', count(*) from ev union all select 'Claim', count(*) from cl union all select 'Relation', count(*) from re")
def object_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return me.object_counts(Base(spark, sf_dir).objects())


@query(
    "telemetry",
    """with p as (select * from pipeline_results where run_id is not null qualify row_number() over (partition by run_id order by loaded_at desc nulls last) = 1), b as (select unnest(batch_timings) b from p)
    select split_part(b.status, ':', 1) status, count(*) batches, cast(sum(b.segment_count) as bigint) segments, cast(sum(b.object_count) as bigint) as objects, round(sum(b.elapsed_sec), 4) as "seconds" from b where b is not null group by 1""",
)
def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return me.telemetry(current(table(spark, sf_dir, "pipeline_results"), ("run_id",)))


# ------------------------------------------------------------------ graph


@query(
    "graph_nodes",
    f"with {_ALL} select id, 'Entity' node_type, name as \"label\", kind, null modality, null polarity from en union all select id, 'Event', name, kind, null, null from ev union all select id, 'Claim', coalesce(subject, 'None') || ' ' || coalesce(predicate, 'None') || ' ' || coalesce(object_ref, 'None'), null, modality, polarity from cl",
)
def graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Base(spark, sf_dir)
    return gr.nodes(b.entities, b.events, b.claims)


_EDGES = f"""{_ALL}, ed as (select p source_id, id target_id, 'participates_in' edge_type, 'navigation' edge_class, null relation_id, null claim_id, null modality, null polarity from (select id, unnest(participants) p from ev) where p is not null
  union all select r.subject, r.object_ref, r.predicate, case when c.id is not null and c.modality = 'asserted' and c.polarity = 'positive' and c.subject = r.subject and c.object_ref = r.object_ref and (coalesce(len(c.evidence_refs), 0) > 0 or coalesce(len(c.source_segment_ids), 0) > 0) then 'fact' else 'claim_index' end, r.id, r.claim_id, c.modality, c.polarity
  from re r left join cl c on c.id = r.claim_id)"""


@query("graph_edges", f"with {_EDGES} select * from ed")
def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Base(spark, sf_dir)
    return gr.edges(b.events, b.relations, b.claims)


@query("graph_neighbours", f"with {_EDGES} select * from ed where source_id = 'seed_ent_0001' or target_id = 'seed_ent_0001'")
def graph_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Base(spark, sf_dir)
    e = gr.edges(b.events, b.relations, b.claims)
    return e.where("source_id = 'seed_ent_0001' or target_id = 'seed_ent_0001'")


@query(
    "answer_contexts",
    f"""with {_ALL}, n as (select id, 'Entity' node_type, name as "label", evidence_refs, source_segment_ids from en union all select id, 'Event', name, evidence_refs, source_segment_ids from ev union all select id, 'Claim', coalesce(subject, 'None') || ' ' || coalesce(predicate, 'None') || ' ' || coalesce(object_ref, 'None'), evidence_refs, source_segment_ids from cl),
    l as (select id, node_type, "label", unnest(range(len(evidence_refs))) pos, unnest(evidence_refs) e, null seg from n where len(evidence_refs) > 0 union all select id, node_type, "label", unnest(range(len(source_segment_ids))), null, unnest(source_segment_ids) from n where coalesce(len(evidence_refs), 0) = 0)
    select l.id obj_id, cast(pos as int) pos, s.id segment_id, case when l.e is null or l.e.span_start is null then s.text_slice else substr(s.text_slice, l.e.span_start + 1, l.e.span_end - l.e.span_start) end quote, node_type, "label" from l join sg s on s.id = coalesce(l.e.segment_id, l.seg)""",
)
def answer_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Base(spark, sf_dir)
    return gr.answer_contexts(b.entities, b.events, b.claims, b.segments)


# ------------------------------------------------------------------ store


@query("store_compact", "select obj_type, obj_id, arg_max(data, loaded_at) data from (select *, row_number() over (partition by obj_type, obj_id order by loaded_at desc, data desc nulls last) k from objects) where k = 1 and coalesce(obj_type, obj_id) is not null group by 1, 2")
def store_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Base(spark, sf_dir).store().select("obj_type", "obj_id", "data")


@query("store_counts", "select obj_type, count(distinct obj_id) as objects from objects where obj_type is not null group by 1")
def store_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.count(Base(spark, sf_dir).store())


@query("store_after_upsert", "with o as (select obj_type, obj_id, max(loaded_at) loaded_at from objects group by 1, 2), c as (select id from claims where id is not null group by 1) select obj_type, count(*) as objects from (select obj_type, obj_id from o union select 'Claim', id from c) group by 1")
def store_after_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "claims").where("id is not null")
    return st.count(st.upsert(table(spark, sf_dir, "objects"), st.rows_of("Claim", raw)))


@query("store_query", f"with {_CL} select id from cl where modality = 'reported' and claim_source is null")
def store_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.query(Base(spark, sf_dir).claims, modality="reported", claim_source=None).select("id")


@query("store_after_delete", "select obj_type, obj_id from (select distinct obj_type, obj_id from objects) o where not exists (select 1 from claims c where c.is_deleted and o.obj_type = 'Claim' and o.obj_id = c.id)")
def store_after_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = table(spark, sf_dir, "claims").where("is_deleted").select(F.lit("Claim").alias("obj_type"), F.col("id").alias("obj_id"))
    return st.id_index(st.delete(Base(spark, sf_dir).store(), gone))


@query("store_ids", "select distinct obj_id from objects where obj_type = 'Event'")
def store_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.list_ids(Base(spark, sf_dir).store(), "Event")


# ------------------------------------------------------------------ symbols and packages


@query(
    "symbol_bases",
    f"""with {_EN}, n as (select *, case when regexp_full_match(name, '[A-Za-z0-9_]+') and regexp_matches(name, '[A-Za-z0-9]') then lower(name) when regexp_matches(name, '[A-Za-z0-9]') then lower(array_to_string(regexp_extract_all(name, '[A-Za-z0-9]+'), '_')) end norm from en)
    select doc_id as package, id, case when norm is not null then 'ent_' || norm else 'ent_zh_' || substr(sha256(coalesce(name, '') || id), 1, 6) end base from n""",
)
def symbol_bases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sy.bases({"Entity": Base(spark, sf_dir).entities}).select("package", "id", "base")


_SYMBOLS = f"""{_ALL}, u as (
      select doc_id package, 'Segment' obj_type, id, case when contains(id, '_seg_') then 'seg_' || regexp_extract(id, '.*_seg_(.*)$', 1) else 'seg_zh_' || substr(sha256(id), 1, 6) end base from sg
      union all select doc_id, 'Entity', id, case when norm is not null then 'ent_' || norm else 'ent_zh_' || substr(sha256(coalesce(name, '') || id), 1, 6) end from (select *, case when regexp_full_match(name, '[A-Za-z0-9_]+') and regexp_matches(name, '[A-Za-z0-9]') then lower(name) when regexp_matches(name, '[A-Za-z0-9]') then lower(array_to_string(regexp_extract_all(name, '[A-Za-z0-9]+'), '_')) end norm from en)
      union all select doc_id, 'Event', id, case when norm is not null then 'evt_' || norm else 'evt_zh_' || substr(sha256(coalesce(name, '') || id), 1, 6) end from (select *, case when regexp_full_match(name, '[A-Za-z0-9_]+') and regexp_matches(name, '[A-Za-z0-9]') then lower(name) when regexp_matches(name, '[A-Za-z0-9]') then lower(array_to_string(regexp_extract_all(name, '[A-Za-z0-9]+'), '_')) end norm from ev)
      union all select doc_id, 'Claim', id, case when norm is not null and length(norm) <= 30 then 'claim_' || norm else 'claim_zh_' || substr(sha256(key || id), 1, 6) end from (select *, case when regexp_full_match(key, '[A-Za-z0-9_]+') and regexp_matches(key, '[A-Za-z0-9]') then lower(key) when regexp_matches(key, '[A-Za-z0-9]') then lower(array_to_string(regexp_extract_all(key, '[A-Za-z0-9]+'), '_')) end norm from (select *, coalesce(subject, '') || '_' || coalesce(predicate, '') || '_' || coalesce(object_ref, '') as key from cl))
      union all select doc_id, 'Relation', id, case when contains(id, '_rel_clm_') then 'rel_clm_' || regexp_extract(id, '.*_rel_clm_(.*)$', 1) else 'rel_' || printf('%04d', row_number() over (partition by doc_id order by id) - 1) end from re)"""


@query("symbol_bases_all", f"with {_SYMBOLS} select * from u")
def symbol_bases_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Base(spark, sf_dir)
    return sy.bases({"Segment": b.segments, **b.objects()})


# numbered symbols that are another's own base (rare) are not numbered again here
@query(
    "symbols_assigned",
    f"""with {_SYMBOLS}, k as (select *, row_number() over (partition by package, base order by list_position(['Segment', 'Entity', 'Event', 'Claim', 'Relation'], obj_type), id) - 1 k from u)
    select package, obj_type, id, case when k = 0 then base else base || '_' || k end symbol, case obj_type when 'Segment' then 'text' when 'Entity' then 'entities' when 'Event' then 'events' when 'Claim' then 'claims' else 'derived' end as module from k""",
)
def symbols_assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Base(spark, sf_dir)
    return sy.assign({"Segment": b.segments, **b.objects()})


@query("symbol_clashes", "select 0 clashes, 0 unnamed")
def symbol_clashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbols that stand twice in a package, and objects without one: none may be left."""
    b = Base(spark, sf_dir)
    objects = {"Document": _document_rows(b), "Block": b.get("blocks"), "Segment": b.segments, **b.objects()}
    given = sy.assign(objects)
    twice = given.groupBy("package", "symbol").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum((F.col("n") > 1).cast("int")), F.lit(0)).cast("int").alias("clashes"))
    none = given.agg(F.coalesce(F.sum(F.col("symbol").isNull().cast("int")), F.lit(0)).cast("int").alias("unnamed"))
    return twice.join(none)


@query("double_ids", f"with {_ALL}, u as (select distinct 'Segment' t, id from sg union select 'Entity', id from en union select 'Event', id from ev union select 'Claim', id from cl union select 'Relation', id from re) select id, count(*) classes from u group by 1 having count(*) > 1")
def double_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Base(spark, sf_dir)
    return sy.double_ids({"Segment": b.segments, **b.objects()})


@query("double_ids_edited", f"with {_EN} select id, 2 classes from en")
def double_ids_edited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities that stand as events too have double ids."""
    e = Base(spark, sf_dir).entities
    return sy.double_ids({"Entity": e, "Event": e})


def _document_rows(b: Base) -> DataFrame:
    """Document rows of the texts that have objects."""
    docs = bl.documents(b.texts()).withColumn("doc_id", F.col("id"))
    return docs.join(b.segments.select(F.col("doc_id").alias("id")), "id", "left_semi")


@query(
    "package_contract",
    f"""with {_ALL}, {_BL}, d as (select doc_id from bl union select doc_id from sg union select doc_id from en union select doc_id from ev union select doc_id from cl union select doc_id from re), n as (select count(doc_id) n from d)
    select unnest(['grammar_errors', 'defined_twice', 'resolved_rate', 'dangling', 'wrong_symbol', 'not_imported']) as "check", n as packages, cast(unnest([0, 0, n, 0, 0, 0]) as double) total from n""",
)
def package_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's objects rendered to modules, read back and checked: packages per check and their sum, over all packages.

    References to objects that are absent or in another document cannot be imported; they are rendered as literals and
    counted by ``dangling_references``. So a good library has 0 everywhere but in resolved_rate, which is 1.
    """
    b = Base(spark, sf_dir)
    objects = {"Document": _document_rows(b), "Block": b.get("blocks"), "Segment": b.segments, **b.objects(), "Residual": b.residuals().join(b.segments.select(F.col("id").alias("segment_id"), F.col("doc_id").alias("_doc")), "segment_id").withColumn("doc_id", F.col("_doc")).drop("_doc")}
    names = sy.assign(objects)
    lines = package.rendered(objects, names, rf.refs(objects))
    sources = cut(package.modules(lines), "modules")
    return package.contract(sources).groupBy("check").agg(F.count("*").alias("packages"), F.round(F.sum("value"), 4).alias("total"))


# ------------------------------------------------------------------ validated saving


def _batch(b: Base) -> DataFrame:
    parts = [st.rows_of(k, v).withColumn("loaded_at", F.lit("2030-01-01").cast("timestamp")) for k, v in b.objects().items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query(
    "saved_rows",
    f"""with {_VIOL}, idx2 as (select 'Entity|Claim' t, id from idx where type in ('Entity', 'Claim') union select type, id from idx union select obj_type, obj_id from objects union select 'Entity|Claim', obj_id from objects where obj_type in ('Entity', 'Claim')),
    miss as (select r.obj_type, r.obj_id from refs r where not exists (select 1 from idx2 i where i.t = r.target_type and i.id = r.target_id and not exists (select 1 from seed_entities s where s.id = i.id))),
    bad as (select distinct obj_type, obj_id from (select obj_type, obj_id from objv where gate <> 'reference' and obj_type <> 'Segment' union all select * from miss)),
    u as (select 'Entity' obj_type, id from en union all select 'Event', id from ev union all select 'Claim', id from cl union all select 'Relation', id from re)
    select u.obj_type, count(*) rows, count(*) filter (bad.obj_id is null) saved from u left join bad on bad.obj_type = u.obj_type and bad.obj_id = u.id group by 1""",
)
def saved_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current objects checked against the store and each other, and those without an error saved."""
    b = Base(spark, sf_dir)
    batch = cut(_batch(b), "rows")
    _, saved, _ = st.save_validated(b.store(), batch, b.segments)
    return batch.select("obj_type", "obj_id").distinct().join(saved.withColumn("ok", F.lit(1)), ["obj_type", "obj_id"], "left").groupBy("obj_type").agg(F.count("*").alias("rows"), F.count("ok").alias("saved"))


@query("expansion_residuals")
def expansion_residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Residuals for what went wrong while model answers were expanded."""
    b = Base(spark, sf_dir)
    rows = cut(ca.with_ids(ca.candidates(_answers(b))), "candidates")
    rows = cut(ca.resolve_locals(rows, ca.local_ids(rows)), "candidates")
    return rp.failures_to_residuals(rp.expansion_warnings(rows, b.segments, ev.place_quotes(ca.quotes_of(rows), b.segments)))
