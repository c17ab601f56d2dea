"""References to records that do not exist, by signed counts per key.

Method. A table change is a set of deltas: the version that comes in counts +1 for each key it
names (and +1 for the existence of its own id, unless it is a tombstone), the version it replaces
counts -1. Summed per (target, key) these give the counts

    refs        live references to the key
    live        live records with that id (0: absent or deleted)
    first_seen  earliest time a record with that id was loaded
    first_ref   earliest time of a live reference (kept as a lower bound when one is withdrawn)

Kept state is these counts and the current version of each record. :func:`advance` applies a batch of
changes of any of the tables: only ids named in the batch are looked up, their old versions taken
back and the winning ones counted. Counts are sums, so a batch adds rows and changes none;
:class:`Log` keeps the state as such batches in a folder and merges them now and then.

Sums and minima combine on the map side, so a key that holds a third of all references costs one
row per task. Keys with refs > 0 and live <= 0 are the orphan report; keys with
first_ref < first_seen hold references that came before their target. Only these suspicious keys
are joined back to the references to name them, one equi-join in which adaptive execution splits
a hot key.

Defined cases: null ids are no records; null and blank references do not count; ids are compared
as stored; a reference without a time is never early; repeated references of one record are one
row; versions may come in any order and more than once; empty tables give empty results; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import is_blank
from ..runtime import cut, release


@dataclass(frozen=True)
class Reference:
    """``keys``: a column (string or array of strings) of the referring table; ``target``: a name in ``targets``."""

    field: str
    keys: str
    target: str


@dataclass(frozen=True)
class Table:
    """A changing table. ``provides``: the target its ids belong to, if any."""

    name: str
    references: tuple[Reference, ...] = field(default=())
    provides: str | None = None
    key: str = "id"
    order: str = "loaded_at"
    deleted: str | None = "is_deleted"


#: The tables of the project and what they refer to.
PROJECT = (
    Table("claims", (Reference("subject", "subject", "entity"), Reference("segment_id", "evidence_refs.segment_id", "segment")), "claim"),
    Table("relations", (Reference("claim_id", "claim_id", "claim"), Reference("segment_id", "evidence_refs.segment_id", "segment"))),
    Table("kg_events", (Reference("participants", "participants", "entity"), Reference("segment_id", "evidence_refs.segment_id", "segment")), deleted=None),
    Table("entities", (Reference("segment_id", "evidence_refs.segment_id", "segment"),), "entity"),
    Table("segments", (), "segment"),
    Table("seed_entities", (), "entity", deleted=None),
)

COUNTS = "target string, ref_id string, refs bigint, live bigint, first_seen timestamp, first_ref timestamp"
ROWS = "src_table string, id string, loaded_at timestamp, gone boolean, refs array<struct<field:string,target:string,ref_id:string>>, first_seen timestamp"


def _as_array(df: DataFrame, path: str) -> Column:
    kind = df.select(F.col(path)).schema[0].dataType.typeName()
    return F.col(path) if kind == "array" else F.array(F.col(path))


def _named(r: Reference) -> Callable[[Column], Column]:
    return lambda x: F.struct(F.lit(r.field).alias("field"), F.lit(r.target).alias("target"), x.alias("ref_id"))


def versions(tables: tuple[Table, ...], frames: dict[str, DataFrame]) -> DataFrame:
    """All rows of the tables in ``frames`` in one form: src_table, id, loaded_at, gone and the distinct references of a row that is not gone."""
    out = None
    for t in tables:
        if t.name not in frames:
            continue
        df = frames[t.name]
        gone = F.coalesce(F.col(t.deleted), F.lit(False)) if t.deleted and t.deleted in df.columns else F.lit(False)
        refs = F.array().cast("array<struct<field:string,target:string,ref_id:string>>")
        for r in t.references:
            keys = F.filter(F.coalesce(_as_array(df, r.keys), F.array().cast("array<string>")), lambda x: ~is_blank(x))
            refs = F.concat(refs, F.transform(keys, _named(r)))
        part = df.where(F.col(t.key).isNotNull()).select(
            F.lit(t.name).alias("src_table"), F.col(t.key).alias("id"), F.col(t.order).cast("timestamp").alias("loaded_at"), gone.alias("gone"), F.when(gone, F.array().cast("array<struct<field:string,target:string,ref_id:string>>")).otherwise(F.array_distinct(refs)).alias("refs")
        )
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no table given")
    return out


def latest(rows: DataFrame) -> DataFrame:
    """The latest version of each record, with the earliest time any was loaded. ``rows``: versions, with or without first_seen. One exchange for all tables."""
    seen = F.col("first_seen") if "first_seen" in rows.columns else F.col("loaded_at")
    out = rows.groupBy("src_table", "id").agg(F.max(F.struct("loaded_at", "gone", "refs")).alias("_r"), F.min(seen).alias("first_seen"))
    return out.select("src_table", "id", "_r.loaded_at", "_r.gone", "_r.refs", "first_seen")


def current(tables: tuple[Table, ...], frames: dict[str, DataFrame]) -> DataFrame:
    """Current version of each record of the tables in ``frames``, in the form of ROWS."""
    return latest(versions(tables, frames))


def references(rows: DataFrame) -> DataFrame:
    """src_table, src_id, field_name, target, ref_id, ref_at: one row per distinct reference of the live rows."""
    return rows.select("src_table", F.col("id").alias("src_id"), F.col("loaded_at").alias("ref_at"), F.explode("refs").alias("r")).select("src_table", "src_id", F.col("r.field").alias("field_name"), "r.target", "r.ref_id", "ref_at")


def deltas(tables: tuple[Table, ...], rows: DataFrame, sign: int = 1) -> DataFrame:
    """What ``rows`` add to the counts, in the form of COUNTS; ``sign`` -1 takes them back."""
    s, zero, none = F.lit(sign).cast("bigint"), F.lit(0).cast("bigint"), F.lit(None).cast("timestamp")
    provides = F.lit(None).cast("string")
    for t in tables:
        if t.provides:
            provides = F.when(F.col("src_table") == t.name, t.provides).otherwise(provides)

    def delta(target: Column, key: Column, refs: Column, live: Column, seen: Column, ref: Column) -> Column:
        return F.struct(target.alias("target"), key.alias("ref_id"), refs.alias("refs"), live.alias("live"), seen.alias("first_seen"), ref.alias("first_ref"))

    named = F.transform("refs", lambda r: delta(r["target"], r["ref_id"], s, zero, none, F.col("loaded_at") if sign > 0 else none))
    own = F.array(delta(provides, F.col("id"), zero, F.when(F.col("gone"), zero).otherwise(s), F.col("first_seen"), none))
    return rows.select(F.explode(F.concat(named, own)).alias("d")).select("d.*").where("target is not null")


def counts(parts: list[DataFrame]) -> DataFrame:
    """Deltas and earlier states summed to one row per (target, key). States are themselves deltas."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("target", "ref_id").agg(F.sum("refs").alias("refs"), F.sum("live").alias("live"), F.min("first_seen").alias("first_seen"), F.min("first_ref").alias("first_ref"))


@dataclass(frozen=True)
class State:
    """``counts`` per (target, key) and the current ``rows`` of all tables, in the form of ROWS."""

    counts: DataFrame
    rows: DataFrame


def begin(tables: tuple[Table, ...], frames: dict[str, DataFrame]) -> State:
    """State after a first load. ``frames`` by table name. Writes the rows."""
    rows = cut(current(tables, frames), "rows")
    return State(counts([deltas(tables, rows)]), rows)


def changed(before: DataFrame, incoming: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(versions taken back, versions that count now) of the records in ``incoming``; both in the form of ROWS."""
    touched = before.join(incoming.select("src_table", "id"), ["src_table", "id"], "left_semi").select(*before.columns)
    return latest(touched), latest(touched.unionByName(incoming))


def advance(tables: tuple[Table, ...], state: State, batch: dict[str, DataFrame]) -> State:
    """The state after one batch of changes of any of the tables. Writes the versions that come and go."""
    old, new = changed(state.rows, current(tables, batch))
    old, new = cut(old, "old"), cut(new, "new")
    rest = state.rows.join(new.select("src_table", "id"), ["src_table", "id"], "left_anti")
    return State(counts([state.counts, deltas(tables, old, -1), deltas(tables, new, +1)]), rest.select(*new.columns).unionByName(new))


def suspicious(state: DataFrame) -> DataFrame:
    """Keys that are referred to but do not live, or that were referred to before they were seen."""
    return state.where((F.col("refs") > 0) & ((F.col("live") <= 0) | (F.col("first_ref") < F.col("first_seen"))))


def failing(state: State) -> DataFrame:
    """Every failing reference by the counts: src_table, src_id, field_name, ref_id, ref_at, reason (absent, deleted, late)."""
    bad = suspicious(state.counts).select("target", "ref_id", "live", "first_seen")
    hit = references(state.rows).join(bad, ["target", "ref_id"])
    reason = F.when((F.col("live") <= 0) & F.col("first_seen").isNull(), "absent").when(F.col("live") <= 0, "deleted").when(F.col("ref_at") < F.col("first_seen"), "late")
    return hit.withColumn("reason", reason).where(F.col("reason").isNotNull()).select("src_table", "src_id", "field_name", "ref_id", "ref_at", "reason")


def last_month(tables: tuple[Table, ...], frames: dict[str, DataFrame]) -> object:
    """Start of the month of the latest load, None for empty tables. One job over one column."""
    tops = None
    for t in tables:
        part = frames[t.name].select(F.max(t.order).alias("top"))
        tops = part if tops is None else tops.unionByName(part)
    return tops.agg(F.date_trunc("month", F.max("top")).alias("m")).collect()[0].m


def replayed(tables: tuple[Table, ...], frames: dict[str, DataFrame], at: object) -> State:
    """State of all changes before ``at`` (rows without a time among them), advanced by those from then on."""
    if at is None:
        return begin(tables, frames)
    late = {t.name: F.coalesce(F.col(t.order) >= F.lit(at), F.lit(False)) for t in tables}
    return advance(tables, begin(tables, {n: f.where(~late[n]) for n, f in frames.items()}), {n: f.where(late[n]) for n, f in frames.items()})


def orphans(tables: tuple[Table, ...], frames: dict[str, DataFrame]) -> DataFrame:
    """Failing references of change logs: the months before the last as a first load, the last as a batch of changes."""
    return failing(replayed(tables, frames, last_month(tables, frames)))


class Log:
    """State in a folder, as batches that are only added: ``<folder>/<counts or rows_TABLE>/<part or full>-N``.

    Batch N of a table holds its signed deltas and the versions that count since. After ``merge_every`` batches a full
    one with the sums (keys at zero left out) and the latest versions takes the place of all before it, which are
    deleted two merges later, so a reader of the last state never loses its files. A batch that runs again overwrites
    itself and reads only what was there before it, so nothing counts twice. Each table may have a stream of its own.
    """

    def __init__(self, spark: SparkSession, folder: str, merge_every: int = 16) -> None:
        self.spark, self.folder, self.merge_every = spark, folder.rstrip("/"), merge_every

    def _fs(self) -> tuple[object, object]:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        return path, path(self.folder).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def batches(self, name: str) -> list[tuple[int, str]]:
        """(number, part or full) of the finished batches of one table."""
        path, fs = self._fs()
        if not fs.exists(path(f"{self.folder}/{name}")):
            return []
        done = []
        for f in fs.listStatus(path(f"{self.folder}/{name}")):
            kind, _, n = f.getPath().getName().partition("-")
            if kind in ("part", "full") and fs.exists(path(f"{self.folder}/{name}/{kind}-{n}/_SUCCESS")):
                done.append((int(n), kind))
        return sorted(done)

    def read(self, name: str, before: int | None = None) -> DataFrame | None:
        """The last full batch and the parts behind it, of those before ``before``."""
        have = [(n, k) for n, k in self.batches(name) if before is None or n < before]
        start = max((n for n, k in have if k == "full"), default=-1)
        use = [f"{self.folder}/{name}/{k}-{n}" for n, k in have if n > start and k == "part" or n == start and k == "full"]
        return self.spark.read.parquet(*use) if use else None

    def _drop(self, name: str, upto: int) -> None:
        path, fs = self._fs()
        for n, k in self.batches(name):
            if n <= upto:
                fs.delete(path(f"{self.folder}/{name}/{k}-{n}"), True)

    def apply(self, table: Table, batch: DataFrame, number: int) -> None:
        """Add batch ``number`` (counted per table from 0)."""
        counted, kept = f"counts_{table.name}", f"rows_{table.name}"
        incoming = current((table,), {table.name: batch})
        before = self.read(kept, number)
        before = incoming.where("false") if before is None else before
        old, new = changed(before, incoming)
        new = cut(new, "new")
        delta = counts([deltas((table,), old, -1), deltas((table,), new, +1)])
        full = number > 0 and number % self.merge_every == 0
        if full:
            sums = self.read(counted, number)
            delta = counts([x for x in (sums, delta) if x is not None]).where("refs <> 0 or live <> 0 or first_seen is not null")
        kind = "full" if full else "part"
        delta.write.mode("overwrite").parquet(f"{self.folder}/{counted}/{kind}-{number}")
        (latest(before.unionByName(new)) if full else new).write.mode("overwrite").parquet(f"{self.folder}/{kept}/{kind}-{number}")
        release(new)
        if full:
            for name in (counted, kept):
                self._drop(name, number - 2 * self.merge_every)

    def state(self, tables: tuple[Table, ...]) -> State:
        """What all batches so far add up to."""
        none = self.spark.createDataFrame([], COUNTS), self.spark.createDataFrame([], ROWS)
        parts = [c for t in tables if (c := self.read(f"counts_{t.name}")) is not None]
        rows = none[1]
        for t in tables:
            if (r := self.read(f"rows_{t.name}")) is not None:
                rows = rows.unionByName(r)
        return State(counts([none[0], *parts]), latest(rows))


def monthly(found: DataFrame) -> DataFrame:
    """Failing references counted per table, field, reason and month of the referring row."""
    return found.groupBy("src_table", "field_name", "reason", F.date_format("ref_at", "yyyy-MM").alias("period")).agg(F.count("*").alias("failing"), F.count_distinct("ref_id").alias("failing_keys"))


def report(tables: tuple[Table, ...], frames: dict[str, DataFrame]) -> DataFrame:
    """The orphan report of change logs."""
    return monthly(orphans(tables, frames))
