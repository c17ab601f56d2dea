"""Deeply nested JSON records turned into related flat tables, by shared inlining.

Method. Pass one walks every document once and counts the edges of the schema graph: element type
-> child element type, how often, the most children one parent has and whether they stand in an
array; and which types of value the members hold. From the graph each element type is classified:
what stands in arrays (objects, values and arrays alike), is shared by several parents or recursive
becomes a table of its own; singleton descendants are inlined into the nearest ancestor that is a
table, as columns named by their path. (A type on a cycle that can be reached from the root has a
parent outside the cycle or the root's own row, so cycles always hold a shared type.) Pass two walks
the documents again and emits one row per table element with a key, the key of its parent row, its
ordinal and the inlined columns. Every value of the input, empty containers and nulls included,
stands in exactly one row (:func:`leaves` lists them).

:func:`typed` turns the rows of one table into a frame with a column per inlined path, typed by the
values seen.

Which types are tables is found by an aggregation, whatever the number of types. The decisions are
sent to the workers while they are few; beyond that they are joined to the documents that need them.

A string that itself holds a JSON array or object counts as that value, at any depth. Text that is
not valid JSON (also NaN or Infinity, which JSON lacks), null text and null keys give no rows.
Of repeated member names the last counts. Nesting is walked with an own stack, so depth is bounded
by memory only; where the C parser refuses the depth a stack parser takes over.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import current_rows, cut

ROOT = "$"
#: Element types recognised by the members an object must have, whatever it is called.
ELEMENTS = {"evidence": ("segment_id", "quote_hash")}
#: In the graph, the child that stands for the value of an array item.
ITEM = ""

EDGE_SCHEMA = "obj_type string, parent string, child string, leaf string, elements bigint, most bigint, in_array boolean"
ROW_SCHEMA = "obj_type string, obj_id string, table_name string, json_path string, parent_table string, parent_path string, parent_id string, row_id string, ordinal int, item_type string, item string, columns map<string,string>"


class Number(str):
    """A JSON number as it is written."""


def _no_constant(name: str) -> None:
    raise ValueError(name)


_DECODER = json.JSONDecoder(parse_constant=_no_constant, parse_float=Number, parse_int=Number)
_TOKEN = re.compile(r'[ \t\r\n]*(?:([\[\]{},:])|("(?:[^"\\\x00-\x1f]|\\.)*")|(-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][-+]?\d+)?)|(true|false|null))')


def _parse_deep(text: str) -> object:
    """A JSON parser with its own stack, for depths at which the C parser gives up."""
    pos, stack, state = 0, [], "value"
    key: str | None = None
    holder: list = []
    words = {"true": True, "false": False, "null": None}

    def put(value: object) -> None:
        if not stack:
            holder.append(value)
        elif isinstance(stack[-1][0], list):
            stack[-1][0].append(value)
        else:
            stack[-1][0][stack[-1][1]] = value

    while True:
        m = _TOKEN.match(text, pos)
        if not m:
            if state == "end" and not text[pos:].strip(" \t\r\n"):
                return holder[0]
            raise ValueError("not JSON")
        pos = m.end()
        mark, string, number, word = m.groups()
        if state in ("value", "first") and mark in ("[", "{"):
            new: object = [] if mark == "[" else {}
            put(new)
            stack.append([new, None])
            state = "first" if mark == "[" else "firstkey"
            continue
        if state in ("value", "first") and (string or number or word):
            put(_DECODER.decode(string) if string else _DECODER.decode(number) if number else words[word])
        elif state in ("key", "firstkey") and string:
            key = _DECODER.decode(string)
            stack[-1][1] = key
            state = "colon"
            continue
        elif state == "colon" and mark == ":":
            state = "value"
            continue
        elif state == "after" and mark == ",":
            state = "value" if isinstance(stack[-1][0], list) else "key"
            continue
        elif mark == "]" and state in ("first", "after") and isinstance(stack[-1][0], list) or mark == "}" and state in ("firstkey", "after") and isinstance(stack[-1][0], dict):
            stack.pop()
        else:
            raise ValueError("not JSON")
        state = "after" if stack else "end"


def parse(text: str | None) -> tuple[bool, object]:
    """(valid, value)."""
    if text is None:
        return False, None
    try:
        return True, _DECODER.decode(text)
    except RecursionError:
        try:
            return True, _parse_deep(text)
        except (ValueError, IndexError):
            return False, None
    except ValueError:
        return False, None


def unfold(value: object) -> object:
    """The array or object a string holds, else the value itself."""
    if isinstance(value, str):
        s = value.lstrip(" \t\r\n")
        if s and s[0] in "[{":
            ok, inner = parse(s)
            if ok:
                return inner
    return value


def element_type(value: object, label: str, elements: dict[str, tuple[str, ...]]) -> str:
    if isinstance(value, dict):
        for name, members in elements.items():
            if all(m in value for m in members):
                return name
    return label


def _text(value: object) -> str | None:
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, bool):
        return "true" if value else "false"
    return _dump(value)


def _dump(value: object) -> str:
    """JSON without blanks, numbers as written, on an own stack."""
    out: list[str] = []
    stack: list[tuple[str, object]] = [("value", value)]
    while stack:
        what, v = stack.pop()
        if what == "text":
            out.append(v)
        elif isinstance(v, dict):
            out.append("{")
            stack.append(("text", "}"))
            for i, (k, x) in reversed(list(enumerate(v.items()))):
                stack += [("value", x), ("text", ("," if i else "") + json.dumps(k, ensure_ascii=False) + ":")]
        elif isinstance(v, list):
            out.append("[")
            stack.append(("text", "]"))
            for i, x in reversed(list(enumerate(v))):
                stack += [("value", x), *([("text", ",")] if i else [])]
        else:
            out.append(str(v) if isinstance(v, Number) else json.dumps(v, ensure_ascii=False))
    return "".join(out)


def kind_of(value: object) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, Number):
        return "integer" if value.lstrip("-").isdigit() else "number"
    return "string" if isinstance(value, str) else "array" if isinstance(value, list) else "object"


def column_name(parts: str) -> str:
    """A member name as part of a column name: points within it are marked."""
    return parts.replace("\\", "\\\\").replace(".", "\\.")


def _edges(root: object, elements: dict[str, tuple[str, ...]], out: dict) -> None:
    """Add the edges of one document to ``out``: (parent, child, leaf) -> [number, most below one parent, in an array]."""

    def note(parent: str, child: str, leaf: str | None, tally: dict | None, in_array: bool) -> None:
        e = out[(parent, child, leaf)]
        e[0] += 1
        if tally is not None:
            tally[child] += 1
            e[1] = max(e[1], tally[child])
        e[2] = e[2] or in_array

    stack: list[tuple[object, str]] = [(unfold(root), ROOT)]
    while stack:
        value, kind = stack.pop()
        tally: dict[str, int] = defaultdict(int)
        if isinstance(value, dict):
            for k, v in value.items():
                v = unfold(v)
                if isinstance(v, dict) and v:
                    child = element_type(v, k, elements)
                    note(kind, child, None, tally, False)
                    stack.append((v, child))
                elif isinstance(v, list) and v:
                    for x in map(unfold, v):
                        child = element_type(x, k, elements)
                        note(kind, child, None, tally, True)
                        stack.append((x, child))
                else:
                    note(kind, k, kind_of(v), None, False)
        elif isinstance(value, list):
            for x in map(unfold, value):
                child = element_type(x, kind + "[]", elements)
                note(kind, child, None, tally, True)
                stack.append((x, child))
        else:
            note(kind, ITEM, kind_of(value), None, False)


def schema_graph(df: DataFrame, obj_type: str = "obj_type", data: str = "data", elements: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Edges of the schema graph: obj_type, parent, child, leaf (type of the value, null for elements), elements, most (children below one parent), in_array."""
    kinds = ELEMENTS if elements is None else elements

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict = defaultdict(lambda: defaultdict(lambda: [0, 0, False]))

        def flush() -> pa.RecordBatch:
            rows = [(t, *edge, *n) for t, edges in found.items() for edge, n in edges.items()]
            found.clear()
            cols = list(zip(*rows)) if rows else [()] * 7
            return pa.RecordBatch.from_arrays([*[pa.array(c, pa.string()) for c in cols[:4]], pa.array(cols[4], pa.int64()), pa.array(cols[5], pa.int64()), pa.array(cols[6], pa.bool_())], names=["obj_type", "parent", "child", "leaf", "elements", "most", "in_array"])

        for batch in batches:
            for t, x in zip(batch.column("t").to_pylist(), batch.column("d").to_pylist()):
                ok, value = parse(x)
                if ok:
                    _edges(value, kinds, found[t])
            if sum(map(len, found.values())) > 100_000:
                yield flush()
        yield flush()

    partial = df.select(F.col(obj_type).alias("t"), F.col(data).alias("d")).where(F.col("d").isNotNull()).mapInArrow(walk, EDGE_SCHEMA)
    return partial.groupBy("obj_type", "parent", "child", "leaf").agg(F.sum("elements").alias("elements"), F.max("most").alias("most"), F.max("in_array").alias("in_array"))


def classify(graph: DataFrame, always: tuple[str, ...] = tuple(ELEMENTS)) -> DataFrame:
    """kind: the element types that are tables. ``always``: types the caller wants as tables whatever the graph says."""
    per = graph.where("leaf is null").groupBy(F.col("child").alias("kind")).agg(F.max("in_array").alias("in_array"), F.max("most").alias("most"), F.count_distinct("parent").alias("parents"))
    return per.where(F.col("in_array") | (F.col("most") > 1) | (F.col("parents") > 1) | F.col("kind").isin(ROOT, *always)).select("kind")


def kinds_of(value: object, elements: dict[str, tuple[str, ...]]) -> set[str]:
    """All element types of one document."""
    out: dict = defaultdict(lambda: [0, 0, False])
    _edges(value, elements, out)
    return {child for _, child, leaf in out if leaf is None}


def shred_one(value: object, obj_id: str | None, tables: frozenset[str], elements: dict[str, tuple[str, ...]]) -> list[tuple]:
    """Rows of one document in the order of the text: (table, path, parent table, parent path, parent id, id, ordinal, item type, item, columns)."""
    return [r[1] for r in sorted(_shred(value, obj_id, tables, elements), key=lambda r: r[0])]


def _shred(value: object, obj_id: str | None, tables: frozenset[str], elements: dict[str, tuple[str, ...]]) -> Iterator[tuple[int, tuple]]:
    """(number, row): arrays and values as they come, so that deep nests of arrays never gather; objects, whose columns come later, at the end."""
    objects: list[tuple[int, tuple]] = []
    count = 0

    def row(kind: str, path: str, home: tuple | None, near: str | None, own: str | None, ordinal: int, item_type: str | None, item: str | None) -> tuple:
        return (kind, path, home[0] if home else None, home[1] if home else None, near, own, ordinal, item_type, item, {})

    # what waits: value, label, path, ordinal, whether in an array, row it hangs below, its column path there, nearest enclosing string id
    stack: list[tuple] = [(unfold(value), ROOT, ROOT, 0, False, None, "", obj_id)]
    while stack:
        v, label, path, ordinal, in_array, home, lead, near = stack.pop()
        if isinstance(v, dict):
            kind = element_type(v, label, elements)
            own = v.get("id")
            own = own if isinstance(own, str) and not isinstance(own, Number) else None
            if home is None or in_array or kind in tables:
                here, prefix = row(kind, path, home, near, own, ordinal, "object", None if v else "{}"), ""
                objects.append((count, here))
                count += 1
            else:
                here, prefix = home, lead + "."
            nearest = near if own is None else own
            waiting = []
            for k, x in v.items():
                x = unfold(x)
                name = prefix + column_name(k)
                if x and isinstance(x, (dict, list)):
                    waiting.append((x, k, f"{path}.{k}", 0, False, here, name, nearest))
                    if k in elements.get(kind, ()):
                        here[9][name] = _text(x)
                else:
                    here[9][name] = _text(x)
            stack.extend(reversed(waiting))
        elif isinstance(v, list):
            if home is None or in_array:
                home, label = row(label, path, home, near, None, ordinal, "array", None if v else "[]"), label + "[]"
                yield count, home
                count += 1
            stack.extend([(x, label, f"{path}[{i}]", i, True, home, "", near) for i, x in reversed(list(enumerate(map(unfold, v))))])
        else:
            yield count, row(label, path, home, near, None, ordinal, kind_of(v), _text(v))
            count += 1
    yield from objects


_STRINGS = ("obj_type", "obj_id", "table_name", "json_path", "parent_table", "parent_path", "parent_id", "row_id")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * 12
    maps = pa.array([list(m.items()) for m in cols[11]], pa.map_(pa.string(), pa.string()))
    arrays = [*[pa.array(c, pa.string()) for c in cols[:8]], pa.array(cols[8], pa.int32()), pa.array(cols[9], pa.string()), pa.array(cols[10], pa.string()), maps]
    return pa.RecordBatch.from_arrays(arrays, names=[*_STRINGS, "ordinal", "item_type", "item", "columns"])


def shred(df: DataFrame, tables: DataFrame, elements: dict[str, tuple[str, ...]] | None = None, obj_type: str = "obj_type", obj_id: str = "obj_id", data: str = "data", send_at_most: int = 100_000) -> DataFrame:
    """The flat tables as one frame of rows; ``table_name`` tells them apart, (obj_type, obj_id, parent_table, parent_path) is the foreign key.

    ``tables``: from :func:`classify`, read once to count it. Up to ``send_at_most`` types go to the workers as they are; beyond that each document gets those it has by a join.
    """
    kinds = ELEMENTS if elements is None else elements
    src = df.select(F.col(obj_type).alias("t"), F.col(obj_id).alias("i"), F.col(data).alias("d")).where(F.col("d").isNotNull() & F.col("i").isNotNull())
    some = [r.kind for r in tables.limit(send_at_most + 1).collect()]
    if len(some) <= send_at_most:
        known: frozenset[str] | None = frozenset(some)
        src = src.withColumn("k", F.lit(None).cast("array<string>"))
    else:
        known = None

        @F.pandas_udf("array<string>")
        def has(texts):  # noqa: ANN001, ANN202
            return texts.map(lambda x: sorted(kinds_of(parse(x)[1], kinds)))

        ask = src.withColumn("_n", F.monotonically_increasing_id())
        ask = cut(ask, "numbered")
        wanted = ask.select("_n", F.explode(has("d")).alias("kind")).join(tables, "kind").groupBy("_n").agg(F.collect_list("kind").alias("k"))
        src = ask.join(wanted, "_n", "left").select("t", "i", "d", F.coalesce("k", F.array().cast("array<string>")).alias("k"))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            used = 0
            for t, i, x, k in zip(*[batch.column(c).to_pylist() for c in "tidk"]):
                ok, value = parse(x)
                if not ok:
                    continue
                for _, r in _shred(value, i, known if known is not None else frozenset(k), kinds):
                    out.append((t, i, *r))
                    used += 200 + len(r[1])
                    if used >= 8_000_000:
                        yield _batch(out)
                        out, used = [], 0
            if out:
                yield _batch(out)

    return src.select("t", "i", "d", "k").mapInArrow(walk, ROW_SCHEMA)


def inline(objects: DataFrame, elements: dict[str, tuple[str, ...]] | None = None, send_at_most: int = 100_000) -> tuple[DataFrame, DataFrame]:
    """Current objects -> (graph, rows of all tables). Writes the current objects and the graph."""
    rows = cut(current_rows(objects, ["obj_type", "obj_id"], {"data": "data"}).select("obj_type", "obj_id", "data"), "objects")
    graph = cut(schema_graph(rows, elements=elements), "graph")
    return graph, shred(rows, classify(graph), elements, send_at_most=send_at_most)


def leaves(rows: DataFrame) -> DataFrame:
    """obj_type, obj_id, json_path, value: every value of the documents, read back from the tables.

    Empty containers stand as ``[]`` and ``{}``; containers with something in them are known by what is in them (a member
    by which an element type is recognised stands as text as well).
    """
    scalar = rows.where("item is not null or item_type = 'null'").select("obj_type", "obj_id", "json_path", F.col("item").alias("value"))
    column = rows.select("obj_type", "obj_id", "json_path", "table_name", F.explode("columns").alias("name", "value"))
    plain = F.regexp_replace("name", r"\\(.)", "$1")
    members = column.select("obj_type", "obj_id", F.concat("json_path", F.lit("."), plain).alias("json_path"), "value")
    return scalar.unionByName(members)


def catalog(rows: DataFrame) -> DataFrame:
    """table_name, column, rows: the columns of each table."""
    return rows.select("table_name", F.explode(F.map_keys("columns")).alias("column")).groupBy("table_name", "column").agg(F.count("*").alias("rows"))


def _type_of(leaf: set[str], longest: int) -> str:
    """The narrowest Spark type for values of these JSON types, the longest of ``longest`` characters."""
    leaf = leaf - {"null"}
    if leaf == {"boolean"}:
        return "boolean"
    if leaf == {"integer"} and longest <= 18:
        return "bigint"
    return "double" if leaf and leaf <= {"integer", "number"} and longest <= 15 else "string"


def typed(rows: DataFrame, graph: DataFrame, name: str, max_columns: int = 2000) -> DataFrame:
    """One table with a column per inlined path behind its keys, typed as the graph has seen its values. Runs two jobs.

    Columns are named by their path; those that differ in case only get a number. A number too long for its type stays
    text. A table of more than ``max_columns`` columns (member names that are data, like ids) raises: it stays in the
    form of ``rows``, where columns are a map.
    """
    own = rows.where(F.col("table_name") == name)
    seen = own.select(F.explode("columns").alias("column", "value")).groupBy("column").agg(F.max(F.length("value")).alias("longest"))
    found = sorted(seen.limit(max_columns + 1).collect(), key=lambda r: r["column"])
    if len(found) > max_columns:
        raise ValueError(f"table {name} has more than {max_columns} columns")

    def last(column: str) -> tuple[str, str]:
        """(element type, member) of a column path."""
        parts = [re.sub(r"\\(.)", r"\1", x) for x in re.split(r"(?<!\\)(?:\\\\)*\.", column)]
        return (parts[-2] if len(parts) > 1 else name), parts[-1]

    edges: dict[tuple[str, str], set[str]] = defaultdict(set)
    parents = sorted({last(r["column"])[0] for r in found})
    if parents:
        for r in graph.where(F.col("leaf").isNotNull() & F.col("parent").isin(*parents)).select("parent", "child", "leaf").distinct().toLocalIterator():
            edges[r.parent, r.child].add(r.leaf)
    keys = ["obj_type", "obj_id", "json_path", "parent_table", "parent_path", "parent_id", "row_id", "ordinal", "item_type", "item"]
    taken = set(keys)
    cols = []
    for r in found:
        label, n = r["column"], 1
        while label.lower() in taken:
            n += 1
            label = f"{r['column']}_{n}"
        taken.add(label.lower())
        cols.append(F.element_at("columns", F.lit(r["column"])).try_cast(_type_of(edges[last(r["column"])], r["longest"] or 0)).alias(label))
    return own.select(*keys, *cols)


def evidence(rows: DataFrame) -> DataFrame:
    """The evidence table: obj_type, obj_id, json_path, parent_id, segment_id."""
    seg = F.col("columns").getItem("segment_id")
    both = seg.isNotNull() & F.map_contains_key("columns", F.lit("quote_hash"))  # a member called evidence may be something else
    return rows.where((F.col("table_name") == "evidence") & both).select("obj_type", "obj_id", "json_path", "parent_id", seg.alias("segment_id"))


def qualifiers(rows: DataFrame, name: str = "qualifiers") -> DataFrame:
    """The qualifier table: its own key, the parent row's key, role and text."""
    c = F.col("columns")
    return rows.where(F.col("table_name") == name).select("obj_type", "obj_id", "json_path", "parent_path", "parent_id", "row_id", c.getItem("role").alias("role"), c.getItem("text").alias("text"))


def claim_evidence(claims: DataFrame) -> DataFrame:
    """Claim.evidence_refs of the current, not deleted claims as a flat table keyed (claim_id, ordinal)."""
    gone = F.coalesce(F.col("is_deleted"), F.lit(False)) if "is_deleted" in claims.columns else F.lit(False)
    rows = current_rows(claims, ["id"], {"gone": gone, "evidence_refs": "evidence_refs"})
    return (
        rows.where(~F.col("gone"))
        .select(F.col("id").alias("claim_id"), F.posexplode("evidence_refs").alias("ordinal", "e"))
        .where(F.col("e").isNotNull())
        .select("claim_id", "ordinal", F.col("e.segment_id").alias("segment_id"), F.col("e.span_start").alias("span_start"), F.col("e.span_end").alias("span_end"), F.col("e.quote_hash").alias("quote_hash"))
    )
