"""Knowledge packages: importable Python modules of constructor calls, written from tables and read back.

A package has one folder per document and one file per module. The text is deterministic: symbols
depend on the object set only, rows are ordered, nothing reads the clock.
"""

from __future__ import annotations

import ast
import importlib.util
import json
import os
import re
import shutil
import sys
import tempfile
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..operators import symbols as sy

HEADER = "# generated by lamina; do not edit"
FILES = ("text", "entities", "events", "claims", "derived", "residuals", "coverage", "__init__")
ONTOLOGY = "lamina.ontology"

# ------------------------------------------------------------------ rendering


def render(obj_type: str, symbol: str, data: dict, known: dict[str, str]) -> str:
    """One assignment. References to known ids become symbols; up to four arguments share a line."""
    args = [f"{k}={_value(v, known, k)}" for k, v in data.items() if v is not None]
    args.append(f"symbol={symbol!r}")
    one = ", ".join(args)
    call = f"{obj_type}({one})" if len(args) <= 4 else f"{obj_type}(\n    " + ",\n    ".join(args) + ",\n)"
    note = preview(data)
    return f"{symbol} = {call}" + (f"  # {note}" if note else "")


_REFERENCES = ("subject", "object_ref", "claim_id", "segment_id", "participants", "source_segment_ids", "derived_from")


def _value(v: object, known: dict[str, str], key: str) -> str:
    if isinstance(v, str):
        return known[v] if key in _REFERENCES and v in known else repr(v)
    if isinstance(v, (list, tuple)):
        return "[" + ", ".join(_value(x, known, key) for x in v) + "]"
    if isinstance(v, dict):
        return "dict(" + ", ".join(f"{k}={_value(x, known, k)}" for k, x in v.items()) + ")"
    return repr(v)


def preview(data: dict, width: int = 40) -> str:
    """A comment to search by, on one line."""
    text = data.get("text_slice") or data.get("name") or " ".join(str(data[k]) for k in ("subject", "predicate", "object_ref") if data.get(k))
    return " ".join(str(text or "").split())[:width]


def _rank(c: str) -> F.Column:
    return F.element_at(F.create_map(*[x for i, n in enumerate(sy.ORDER) for x in (F.lit(n), F.lit(i))]), F.col(c))


def rendered(objects: dict[str, DataFrame], table: DataFrame, references: DataFrame) -> DataFrame:
    """package, module, obj_type, id, symbol, line, uses: every object as source text and the (symbol, module) it names.

    References are looked up by a join. A target of another package, or of the same module and defined later, stays a literal id.
    """
    named = sy.references_as_symbols(references.where(F.substring_index("field", ".", -1).isin(*_REFERENCES)), table).where(F.col("symbol").isNotNull())
    modules_ = F.create_map(*[x for k, v in sy.MODULES.items() for x in (F.lit(k), F.lit(v))])
    own_rank, rank = _rank("obj_type"), _rank("target_class")
    above = (F.element_at(modules_, F.col("obj_type")) != F.col("target_module")) | (rank < own_rank) | ((rank == own_rank) & (F.col("target_id") < F.col("obj_id")))
    own = named.where(above).groupBy("obj_type", F.col("obj_id").alias("id")).agg(F.collect_set(F.struct("target_id", "symbol", F.col("target_module").alias("module"))).alias("k"))
    out = None
    for name, df in objects.items():
        cols = [c for c in df.columns if c not in ("loaded_at", "is_deleted")]
        part = df.select(F.lit(name).alias("obj_type"), "id", F.to_json(F.struct(*cols)).alias("data"))
        out = part if out is None else out.unionByName(part)

    @F.pandas_udf("string")
    def line(obj_type: pd.Series, symbol: pd.Series, data: pd.Series, known: pd.Series) -> pd.Series:
        return pd.Series([render(t, s, json.loads(d), {x["target_id"]: x["symbol"] for x in k} if k is not None else {}) for t, s, d, k in zip(obj_type, symbol, data, known)])

    rows = out.join(table, ["obj_type", "id"]).join(own, ["obj_type", "id"], "left")
    uses = F.coalesce(F.transform("k", lambda x: F.struct(x["symbol"].alias("symbol"), x["module"].alias("module"))), F.array().cast("array<struct<symbol:string,module:string>>"))
    return rows.select("package", "module", "obj_type", "id", "symbol", line("obj_type", "symbol", "data", "k").alias("line"), uses.alias("uses"))


def modules(lines: DataFrame) -> DataFrame:
    """package, module, source: header, imports that are used, assignments in order. One row per module of a document."""
    used = lines.select("package", F.col("module").alias("_m"), F.explode("uses").alias("u")).where("u.module <> _m").groupBy("package", F.col("_m").alias("module")).agg(F.sort_array(F.collect_set("u")).alias("uses"))
    per = lines.groupBy("package", "module").agg(F.sort_array(F.collect_set("obj_type")).alias("types"), F.sort_array(F.collect_list(F.struct(_rank("obj_type").alias("r"), "id", "symbol", "line"))).alias("rows"))

    @F.pandas_udf("string")
    def source(types: pd.Series, rows: pd.Series, uses: pd.Series) -> pd.Series:
        out = []
        for ts, rs, us in zip(types, rows, uses):
            by: dict[str, list[str]] = {}
            for u in us if us is not None else ():
                by.setdefault(u["module"], []).append(u["symbol"])
            head = [HEADER, f"from {ONTOLOGY} import {', '.join(ts)}", *[f"from .{m} import {', '.join(sorted(by[m]))}" for m in FILES if m in by]]
            out.append("\n".join([*head, "", *[r["line"] for r in rs], ""]))
        return pd.Series(out)

    return per.join(used, ["package", "module"], "left").select("package", "module", source("types", "rows", "uses").alias("source"))


def surface(homes: dict[str, str]) -> str:
    """__init__: re-exports in import order."""
    by: dict[str, list[str]] = {}
    for s, m in homes.items():
        by.setdefault(m, []).append(s)
    order = [m for m in FILES if m in by]
    lines = [HEADER, *[f"from .{m} import {', '.join(sorted(by[m]))}" for m in order], "", "__all__ = ["]
    return "\n".join([*lines, *[f"    {s!r}," for m in order for s in sorted(by[m])], "]", ""])


def import_check(folder: str) -> None:
    """Import a package from its folder under a name of its own, and let it go again. Raises what the import raises.

    The modules hold constructor calls only; the grammar is checked first, so nothing else can run.
    """
    for n in sorted(os.listdir(folder)):
        if n.endswith(".py") and n != "__init__.py":
            with open(os.path.join(folder, n), encoding="utf-8") as f:
                _, errors = read_module(f.read())
            if errors:
                raise ImportError(f"{n}: {errors[0]}")
    name = f"_lamina_check_{uuid.uuid4().hex}"
    spec = importlib.util.spec_from_file_location(name, os.path.join(folder, "__init__.py"), submodule_search_locations=[folder])
    module = importlib.util.module_from_spec(spec)
    sys.modules[name] = module
    before, sys.dont_write_bytecode = sys.dont_write_bytecode, True
    try:
        spec.loader.exec_module(module)
        for s in getattr(module, "__all__", []):
            getattr(module, s)
    finally:
        sys.dont_write_bytecode = before
        for k in [k for k in sys.modules if k == name or k.startswith(name + ".")]:
            del sys.modules[k]


def write_package(sources: dict[str, str], homes: dict[str, str], target: str, coverage: str = "", check: bool = True) -> list[str]:
    """Write the modules of one document next to the target, check that they parse and (``check``) can be imported, then move them into place.

    A folder that holds files without our header is not overwritten; on failure the old one stays.
    """
    for name in sorted(os.listdir(target)) if os.path.isdir(target) else []:
        path = os.path.join(target, name)
        if os.path.isfile(path) and name.endswith(".py"):
            with open(path, encoding="utf-8") as f:
                if f.readline().rstrip("\n") != HEADER:
                    raise FileExistsError(f"{path} was not generated here")
    parent = os.path.dirname(os.path.abspath(target))
    os.makedirs(parent, exist_ok=True)
    stage = tempfile.mkdtemp(prefix=".stage-", dir=parent)
    try:
        for m in FILES:
            text = surface(homes) if m == "__init__" else sources[m] if m in sources else coverage if m == "coverage" and coverage else HEADER + "\n"
            compile(text, m, "exec")
            with open(os.path.join(stage, f"{m}.py"), "w", encoding="utf-8") as f:
                f.write(text)
        if check:
            import_check(stage)
        backup = None
        if os.path.isdir(target):
            backup = stage + ".old"
            os.replace(target, backup)
        try:
            os.replace(stage, target)
        except OSError:
            if backup:
                os.replace(backup, target)
            raise
        if backup:
            shutil.rmtree(backup)
    finally:
        shutil.rmtree(stage, ignore_errors=True)
    return sorted(os.listdir(target))


# ------------------------------------------------------------------ reading


#: Argument names of older packages and what they mean. Fixed values.
KEYWORDS = {"segment": "segment_id", "claim": "claim_id", "object": "object_ref", "source": "claim_source", "index": "block_index", "time": "event_time", "location": "place"}


def read_module(source: str, bare: bool = False) -> tuple[list[dict], list[str]]:
    """(rows, errors) of a module. Only imports, assignments of constructor calls, keyword arguments, literals, names and signed numbers are allowed; a name must be defined above.

    ``bare``: calls without an assignment are rows too, as in single files without symbols.
    """
    rows: list[dict] = []
    errors: list[str] = []
    try:
        tree = ast.parse(source)
    except SyntaxError as e:
        return [], [f"line {e.lineno}: {e.msg}"]
    known: dict[str, str] = {}
    classes: set[str] = set()

    def value(n: ast.expr, path: str, refs: dict[str, str]) -> object:
        if isinstance(n, ast.Constant) and (n.value is None or isinstance(n.value, (str, int, float, bool))):
            return n.value
        if isinstance(n, ast.UnaryOp) and isinstance(n.op, (ast.USub, ast.UAdd)) and isinstance(n.operand, ast.Constant) and isinstance(n.operand.value, (int, float)):
            return -n.operand.value if isinstance(n.op, ast.USub) else n.operand.value
        if isinstance(n, ast.List):
            return [value(x, f"{path}[{i}]", refs) for i, x in enumerate(n.elts)]
        if isinstance(n, ast.Dict):
            return {value(k, path, refs): value(v, path, refs) for k, v in zip(n.keys, n.values)}
        if isinstance(n, ast.Call) and isinstance(n.func, ast.Name) and not n.args:
            return {k.arg: value(k.value, f"{path}.{k.arg}", refs) for k in n.keywords}
        if isinstance(n, ast.Name):
            if n.id not in known:
                raise ValueError(f"line {n.lineno}: {n.id} is not defined above")
            refs[path] = n.id
            return known[n.id]
        raise ValueError(f"line {n.lineno}: {type(n).__name__} is not allowed")

    for node in tree.body:
        try:
            if isinstance(node, ast.ImportFrom) and (node.level or node.module == ONTOLOGY):
                for a in node.names:
                    if node.level:
                        known[a.asname or a.name] = a.name
                    else:
                        classes.add(a.name)
            elif isinstance(node, ast.Assign) and len(node.targets) == 1 and isinstance(node.targets[0], ast.Name) and isinstance(node.value, ast.Call) and isinstance(node.value.func, ast.Name):
                name, call = node.targets[0].id, node.value
                if name in known:
                    raise ValueError(f"line {node.lineno}: {name} is defined twice")
                if call.func.id not in classes:
                    raise ValueError(f"line {node.lineno}: {call.func.id} is not imported")
                if call.args or any(k.arg is None for k in call.keywords):
                    raise ValueError(f"line {node.lineno}: keyword arguments only")
                refs: dict[str, str] = {}
                data = {KEYWORDS.get(k.arg, k.arg): value(k.value, k.arg, refs) for k in call.keywords}
                known[name] = data.get("id", name)
                rows.append({"type": call.func.id, "symbol": name, "data": data, "refs": refs})
            elif bare and isinstance(node, ast.Expr) and isinstance(node.value, ast.Call) and isinstance(node.value.func, ast.Name) and node.value.func.id in classes and not node.value.args:
                refs = {}
                rows.append({"type": node.value.func.id, "symbol": None, "data": {KEYWORDS.get(k.arg, k.arg): value(k.value, k.arg, refs) for k in node.value.keywords}, "refs": refs})
            elif isinstance(node, ast.Expr) and isinstance(node.value, ast.Constant) and isinstance(node.value.value, str) or isinstance(node, ast.Assign) and isinstance(node.targets[0], ast.Name) and node.targets[0].id == "__all__":
                continue
            else:
                raise ValueError(f"line {node.lineno}: {type(node).__name__} is not allowed")
        except ValueError as e:
            errors.append(str(e))
    return rows, errors


def parsed(sources: DataFrame, bare: bool = False) -> DataFrame:
    """package, module, obj_type, symbol, data, refs (path -> symbol), error: rows or errors of each module. ``sources``: package, module, source."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = []
            for p, m, s in zip(pdf["package"], pdf["module"], pdf["source"]):
                rows, errors = read_module(s, bare)
                out += [(p, m, r["type"], r["symbol"], json.dumps(r["data"], ensure_ascii=False, sort_keys=True), r["refs"], None) for r in rows]
                out += [(p, m, None, None, None, None, e) for e in errors]
            yield pd.DataFrame(out, columns=["package", "module", "obj_type", "symbol", "data", "refs", "error"])

    return sources.select("package", "module", "source").mapInPandas(run, "package string, module string, obj_type string, symbol string, data string, refs map<string,string>, error string")


def linked(rows: DataFrame) -> DataFrame:
    """Parsed rows with the ids of what they name in place of symbols, also of symbols of other modules of the package.

    Symbols that no module of the package defines stay as they are.
    """
    keyed = rows.where("error is null").withColumn("obj_id", F.get_json_object("data", "$.id"))
    names = keyed.where("symbol is not null").select("package", F.col("symbol").alias("name"), F.col("obj_id").alias("target")).distinct()
    ask = keyed.select("package", "module", "obj_type", "obj_id", F.explode("refs").alias("path", "name")).join(names, ["package", "name"])
    found = ask.groupBy("package", "module", "obj_type", "obj_id").agg(F.map_from_entries(F.collect_list(F.struct("path", "target"))).alias("targets"))

    @F.pandas_udf("string")
    def put(data: pd.Series, targets: pd.Series) -> pd.Series:
        return pd.Series([_with_targets(d, dict(t)) if t is not None else d for d, t in zip(data, targets)])

    out = keyed.join(found, ["package", "module", "obj_type", "obj_id"], "left")
    return out.select("package", "module", "obj_type", "obj_id", "symbol", put("data", "targets").alias("data"))


def _with_targets(data: str, targets: dict[str, str]) -> str:
    """JSON data with the values at paths like ``a.b[0]`` replaced; argument names of older packages are known."""
    root = json.loads(data)
    for path, target in targets.items():
        steps = [int(x[1:-1]) if x[0] == "[" else KEYWORDS.get(x, x) for x in re.findall(r"\[\d+\]|[^.\[\]]+", path)]
        at = root
        for s in steps[:-1]:
            at = at[s]
        at[steps[-1]] = target
    return json.dumps(root, ensure_ascii=False, sort_keys=True)


def segment_symbols(sources: DataFrame) -> DataFrame:
    """package, segment_id, symbol of every segment defined in the sources."""
    return parsed(sources).where("obj_type = 'Segment'").select("package", F.get_json_object("data", "$.id").alias("segment_id"), "symbol")


def analysed(sources: DataFrame) -> DataFrame:
    """package, module, symbol, obj_type, line, references, referenced_by, cross_module (references from other modules): every definition and who names it."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = []
            for p, m, s in zip(pdf["package"], pdf["module"], pdf["source"]):
                try:
                    tree = ast.parse(s)
                except SyntaxError:
                    continue
                for n in tree.body:
                    if isinstance(n, ast.Assign) and isinstance(n.targets[0], ast.Name) and isinstance(n.value, ast.Call) and isinstance(n.value.func, ast.Name):
                        own = n.targets[0].id
                        out.append((p, m, own, n.value.func.id, n.lineno, None))
                        out += [(p, m, x.id, None, None, own) for k in n.value.keywords for x in ast.walk(k.value) if isinstance(x, ast.Name)]
            yield pd.DataFrame(out, columns=["package", "module", "symbol", "obj_type", "line", "by"]).astype({"line": "Int64"})

    seen = sources.select("package", "module", "source").mapInPandas(run, "package string, module string, symbol string, obj_type string, line int, by string")
    defined = seen.where("by is null").drop("by")
    named = seen.where("by is not null").select("package", "symbol", F.col("module").alias("_from"), "by")
    both = defined.join(named, ["package", "symbol"], "left")
    return both.groupBy("package", "module", "symbol", "obj_type", "line").agg(F.count("by").alias("references"), F.sort_array(F.collect_set("by")).alias("referenced_by"), F.count_if(F.col("_from") != F.col("module")).alias("cross_module"))


def not_imported(sources: DataFrame) -> DataFrame:
    """package, module, symbol: names that a module uses and neither defines nor imports."""
    names = names_used(sources)
    have = names.where("role in ('defined', 'imported')").select("package", "module", "symbol")
    return names.where("role = 'used'").join(have, ["package", "module", "symbol"], "left_anti").select("package", "module", "symbol").distinct()


#: Classes of the single files a document may be written to without symbols. Fixed values.
SINGLE = {"document": ("Document", "Block"), "segments": ("Segment",), "knowledge": ("Entity", "Event", "Claim", "Relation", "Residual", "IgnoreSegment")}


def single_files(objects: dict[str, DataFrame]) -> DataFrame:
    """package, module (document, segments, knowledge), source: constructor calls without symbols, in the order of export."""
    out = None
    for file, classes in SINGLE.items():
        for name in classes:
            if name not in objects:
                continue
            df = objects[name]
            cols = [c for c in df.columns if c not in ("loaded_at", "is_deleted", "work_id")]
            order = F.struct(*[F.col(c) for c in sy.export_order(name)])
            doc = F.col("id") if name == "Document" else F.col("doc_id")
            part = df.select(doc.alias("package"), F.lit(file).alias("module"), F.lit(sy.ORDER.index(name)).alias("r"), F.to_json(order).alias("o"), F.row_number().over(Window.partitionBy(doc).orderBy(*sy.export_order(name))).alias("k"), F.lit(name).alias("t"), F.to_json(F.struct(*cols)).alias("data"))
            out = part if out is None else out.unionByName(part)
    per = out.where("package is not null").groupBy("package", "module").agg(F.sort_array(F.collect_list(F.struct("r", "k", "t", "data"))).alias("rows"))

    @F.pandas_udf("string")
    def source(rows: pd.Series) -> pd.Series:
        texts = []
        for rs in rows:
            calls = [f"{r['t']}(" + ", ".join(f"{k}={_value(v, {}, k)}" for k, v in json.loads(r["data"]).items() if v is not None) + ")" for r in rs]
            texts.append("\n".join([HEADER, f"from {ONTOLOGY} import {', '.join(sorted({r['t'] for r in rs}))}", "", *calls, ""]))
        return pd.Series(texts)

    return per.select("package", "module", source("rows").alias("source"))


def read_single_files(sources: DataFrame) -> DataFrame:
    """package, module, obj_type, data, error of single files."""
    return parsed(sources, bare=True).select("package", "module", "obj_type", "data", "error")


def names_used(sources: DataFrame) -> DataFrame:
    """package, module, symbol, role (defined, used, imported): the definitions and references of each module."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = []
            for p, m, s in zip(pdf["package"], pdf["module"], pdf["source"]):
                try:
                    tree = ast.parse(s)
                except SyntaxError:
                    continue
                for n in tree.body:
                    if isinstance(n, ast.ImportFrom) and n.level:
                        out += [(p, m, a.asname or a.name, "imported") for a in n.names]
                    if isinstance(n, ast.Assign):
                        out += [(p, m, t.id, "defined") for t in n.targets if isinstance(t, ast.Name)]
                        out += [(p, m, x.id, "used") for x in ast.walk(n.value) if isinstance(x, ast.Name) and not (isinstance(n.value, ast.Call) and x is n.value.func) and x.id != "dict"]
            yield pd.DataFrame(out, columns=["package", "module", "symbol", "role"])

    return sources.select("package", "module", "source").mapInPandas(run, "package string, module string, symbol string, role string")


def read_package(spark: SparkSession, folder: str) -> DataFrame:
    """package, module, source of every module below a folder of packages."""
    raw = spark.read.format("text").option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.py").load(folder)
    parts = F.split(F.col("_metadata.file_path"), "/")
    return raw.select(F.element_at(parts, -2).alias("package"), F.regexp_replace(F.element_at(parts, -1), r"\.py$", "").alias("module"), F.col("value").alias("source"))


def numbered_packages(sources: DataFrame) -> DataFrame:
    """Packages in folders called ch<number>: package, number."""
    return sources.where(F.col("package").rlike(r"^ch\d+$") & (F.col("module") == "text")).select("package", F.regexp_extract("package", r"(\d+)", 1).cast("int").alias("number")).distinct()


def contract(sources: DataFrame) -> DataFrame:
    """package, check, value: the checks on emitted packages. A good package has 0 everywhere but in resolved_rate (1)."""
    names = names_used(sources)
    defined = names.where("role = 'defined'")
    used = names.where("role = 'used'")
    twice = defined.groupBy("package", "symbol").agg(F.count("*").alias("n")).where("n > 1").groupBy("package").agg(F.count("*").cast("double").alias("value")).withColumn("check", F.lit("defined_twice"))
    hit = used.join(defined.select("package", "symbol").distinct().withColumn("hit", F.lit(1)), ["package", "symbol"], "left")
    rate = sources.select("package").distinct().join(hit.groupBy("package").agg((F.count("hit") / F.count("*")).alias("value")), "package", "left").select("package", F.coalesce("value", F.lit(1.0)).alias("value"), F.lit("resolved_rate").alias("check"))
    dangling = hit.where("hit is null").groupBy("package").agg(F.count("*").cast("double").alias("value")).withColumn("check", F.lit("dangling"))
    rows = parsed(sources)
    errors = rows.where("error is not null").groupBy("package").agg(F.count("*").cast("double").alias("value")).withColumn("check", F.lit("grammar_errors"))
    other = rows.where("symbol is not null and get_json_object(data, '$.symbol') <> symbol").groupBy("package").agg(F.count("*").cast("double").alias("value")).withColumn("check", F.lit("wrong_symbol"))
    loose = not_imported(sources).groupBy("package").agg(F.count("*").cast("double").alias("value")).withColumn("check", F.lit("not_imported"))
    zero = sources.select("package").distinct().select("package", F.explode(F.array(*[F.lit(c) for c in ("defined_twice", "dangling", "grammar_errors", "wrong_symbol", "not_imported")])).alias("check"), F.lit(0.0).alias("value"))
    found = twice.unionByName(rate).unionByName(dangling).unionByName(errors).unionByName(other).unionByName(loose)
    return zero.unionByName(found.select("package", "check", "value")).groupBy("package", "check").agg(F.round(F.max("value"), 6).alias("value"))
