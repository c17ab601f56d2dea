"""Variant spellings of names, linked by exact radius joins in a metric space.

Method. Names are brought to comparable forms (case, accents, order, titles, initials; nicknames,
abbreviations, character variants and romanisations as learned from the aliases of all entities).
Full forms then meet in a metric space: every form goes to the cell of its nearest pivot and, by
the triangle inequality, to each cell that a form within the radius could have as its own; cells
that are still large draw pivots of their own, so their number grows with the work. Inside a cell
all forms of one work within the radius are found with the edit distance itself. Equal forms are
one point (distance 0). Entities that hold the same point, or points within the radius, are one
class. Forms that name only a part (surname, initial and surname, acronym) join the one class of
the work they fit; where several fit they join none.

No list of nicknames, abbreviations or generic aliases is built in: which spellings stand for the
same word is learned from how often they stand together in one entity (three entities at least),
and which stand for anybody from the unlike names they stand beside. While the lexicon is small it
is broadcast; beyond that the readings of name parts, which grow with the data, are a table that
is joined to the spellings (characters are bounded by their script, word equivalents are decided in
order on the driver). Pairs are only made inside a class, as the result asks for.

Defined cases: null ids, null works, tombstones and places take no part; null names and aliases
are skipped; aliases that stand for many unlike names ("the captain") name nobody; repeated rows
count once; an empty table gives no rows.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import components, stars
from ..runtime import current_rows, cut, release

PERSON = ("person", "per", "character", "people", "human")
ORG = ("org", "organisation", "organization", "company", "institution")
PLACE = ("location", "place", "loc", "gpe", "geo")

#: Titles by script, and the ends of organisation names. Fixed values.
TITLES = frozenset("dr mr mrs ms miss prof capt sir hr fr frau herr st".split())
HAN_TITLES = ("先生", "女士", "小姐", "夫人", "医生", "醫生", "老师", "站长", "经理", "主任", "教授", "博士", "队长", "校长", "船长", "さん", "様", "氏", "君")
THAI_TITLES = ("นางสาว", "นาย", "นาง", "คุณ", "ดร.")
DEVA_TITLES = ("श्रीमती", "श्री", "डॉ.", "डॉ")
ORG_ENDS = ("公司", "协会", "協會", "商行", "研究所", "图书馆", "圖書館", "学校", "医院", "银行")
STOP_WORDS = frozenset(("the", "ltd", "of", "and", "limited", "inc", "gmbh"))

_PINYIN = re.compile(r"(?:zh|ch|sh|[bpmfdtnlgkhjqxrzcsyw])?(?:iang|iong|uang|ueng|ang|eng|ing|ong|iao|ian|uai|uan|van|ai|ei|ao|ou|an|en|in|un|vn|ia|ie|iu|ua|uo|ui|ue|ve|er|a|o|e|i|u|v)")
_SPACE = re.compile(r"[\s·・‧•]+")


def han(c: str) -> bool:
    o = ord(c)
    return 0x3400 <= o <= 0x9FFF or 0x3040 <= o <= 0x30FF or 0xF900 <= o <= 0xFAFF or 0x20000 <= o < 0x32000


def script(text: str) -> str:
    n: Counter = Counter()
    for c in text:
        o = ord(c)
        if han(c):
            n["han"] += 2
        elif 0xE00 <= o <= 0xE7F:
            n["thai"] += 1
        elif 0x900 <= o <= 0x97F:
            n["deva"] += 1
        elif c.isalpha():
            n["latin"] += 1
    return n.most_common(1)[0][0] if n else "none"


def plain(text: str) -> str:
    """Lower case without accents; umlauts are written out."""
    t = text.lower().replace("ä", "ae").replace("ö", "oe").replace("ü", "ue").replace("ß", "ss").replace("ø", "oe").replace("æ", "ae")
    return "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))


def syllables(token: str, want: int) -> list[str] | None:
    """A romanised token cut into ``want`` syllables."""
    found: list[list[str]] = []

    def walk(at: int, got: list[str]) -> None:
        if found or len(got) > want:
            return
        if at == len(token):
            if len(got) == want:
                found.append(got)
            return
        m = _PINYIN.match(token, at)
        if not m:
            return
        for end in range(m.end(), at, -1):
            part = _PINYIN.fullmatch(token, at, end)
            if part:
                walk(end, [*got, token[at:end]])

    walk(0, [])
    return found[0] if found else None


@dataclass
class Lexicon:
    """Learned from aliases: variant characters, readings of characters and of name parts, and word equivalents."""

    chars: dict[str, str] = field(default_factory=dict)
    readings: dict[str, str] = field(default_factory=dict)
    parts: dict[str, str] = field(default_factory=dict)
    words: dict[str, str] = field(default_factory=dict)
    goals: set[str] = field(default_factory=set)

    def base(self, text: str) -> str:
        return "".join(self.chars.get(c, c) for c in text)

    def org_end(self, text: str) -> str:
        """The ending by which ``text`` (in base characters) is an organisation, or an empty string."""
        return next((e for e in map(self.base, ORG_ENDS) if text.endswith(e)), "")


def han_core(text: str) -> tuple[str, bool]:
    """Without spaces, titles and seat; (core, whether a title was cut off)."""
    t = _SPACE.sub("", text)
    m = re.fullmatch(r"(.+?)[（(](.+?)[）)]", t)
    if m:
        t = m[2] + m[1]
    t = t.removesuffix("总部").removesuffix("總部").replace("有限公司", "公司")
    cut_off = False
    for title in HAN_TITLES:
        if t.endswith(title) and len(t) > len(title):
            t, cut_off = t[: -len(title)], True
            break
    if len(t) == 2 and t[0] in "小老":
        return t[1], True
    return t, cut_off


def latin_tokens(text: str) -> list[str]:
    if "," in text:
        a, _, b = text.partition(",")
        text = f"{b} {a}"
    return [t for t in re.split(r"[\s\-–]+", text.strip()) if t.strip(".,'\"()")]


def forms(name: str | None, kind: str | None, lex: Lexicon) -> tuple[list[str], list[str], list[str]]:
    """(full forms, keys of parts that the full forms cover, part forms) of one spelling."""
    if not name or not name.strip():
        return [], [], []
    full: list[str] = []
    covers: list[str] = []
    part: list[str] = []
    s = script(name)
    if s == "han":
        t, titled = han_core(name)
        t = lex.base(t)
        end = lex.org_end(t)
        if kind == "org" or kind is None and end:
            if end:
                full.append("H:" + t)
                head = t[: -len(end)]
                covers.append("h:" + head)
                if len(head) >= 3:
                    covers.append(f"a:{head[0]}{head[2]}")
            elif len(t) == 2:
                part.append("a:" + t)
            else:
                part.append("h:" + t)
            return full, covers, part
        if len(t) == 1 or titled and len(t) == 2 and name.rstrip().endswith(("さん", "様", "氏", "君")):
            return full, covers, ["s:" + t]
        full.append("H:" + t)
        covers += ["s:" + t[:1], *(["s:" + t[:2]] if len(t) > 2 else [])]
        if len(t) <= 4 and all(c in lex.readings for c in t):
            given = "".join(lex.readings[c] for c in t[1:])
            full.append("R:" + " ".join(sorted((lex.readings[t[0]], given))))
        for k in range(1, len(t)):
            a, b = lex.parts.get(t[:k]), lex.parts.get(t[k:])
            if a and b:
                full.append("R:" + " ".join(sorted((a, b))))
        return full, covers, part
    if s == "latin":
        raw = latin_tokens(name)
        letters = re.sub(r"[^A-Za-z]", "", name)
        if kind != "person" and len(raw) == 1 and 2 <= len(letters) <= 5 and letters.isupper():
            return [], [], ["a:" + letters.lower()]
        tokens, initials = [], []
        for t in raw:
            bare = plain(t.strip(".,'\"()"))
            if not bare or bare in TITLES:
                continue
            if len(bare) == 1 or len(bare) == 2 and t.isupper() and kind != "org" and len(raw) > 1 and not name.isupper():
                initials.append(bare)
            else:
                tokens.append(bare)
        if kind == "org" or kind is None and len(tokens) >= 3:
            words = [lex.words.get(t, t) for t in tokens]
            if "of" in words[1:2]:
                words = words[2:] + words[:1]
            words = [w for w in words if w not in STOP_WORDS]
            if len(words) >= 2:
                full.append("L:" + " ".join(sorted(words)))
                covers.append("a:" + "".join(w[0] for w in words))
            return full, covers, part
        if len(tokens) >= 2:
            words = [lex.words.get(t, t) for t in tokens]
            full.append("L:" + " ".join(sorted(words)))
            if len(words) == 2:
                full.append("R:" + " ".join(sorted(tokens)))
            for a, b in ((words[0], words[-1]), (tokens[0], tokens[-1])):
                covers += [f"i:{a[0]}|{b}", f"i:{b[0]}|{a}", "s:" + a, "s:" + b]
        elif len(tokens) == 1 and initials:
            part.append(f"i:{initials[0][0]}|{tokens[0]}")
        elif len(tokens) == 1:
            part.append("s:" + tokens[0])
        return full, covers, part
    if s in ("thai", "deva"):
        t = name.strip()
        for title in THAI_TITLES if s == "thai" else DEVA_TITLES:
            if t.startswith(title) and len(t) > len(title):
                t = t[len(title) :].strip()
                break
        if s == "deva" and t.endswith(" जी"):
            t = t[:-3].strip()
        tokens = [x.strip(".,") for x in latin_tokens(t)]
        mark = "T:" if s == "thai" else "D:"
        if len(tokens) >= 2:
            a, b = tokens[0], tokens[-1]
            if s == "deva" and len(a) <= 2 and "." in t:
                return [], [], [f"i:{a[0]}|{b}"]
            full += [mark + "".join(tokens), mark + "".join(tokens[::-1])]
            covers += ["s:" + a, "s:" + b, f"i:{a[0]}|{b}", f"i:{b[0]}|{a}"]
        elif tokens and len(tokens[0]) <= 8:
            part.append("s:" + tokens[0])
            if s == "deva" and len(tokens[0]) >= 6:
                full.append(mark + tokens[0])
        elif tokens:
            full.append(mark + tokens[0])
        return full, covers, part
    return full, covers, part


# ------------------------------------------------------------------ lexicon


def _learn(left: list[str], right: list[str] | None = None) -> Iterator[tuple[str, str, str]]:
    """Evidence from the spellings of one entity: (kind, a, b) for each pair within ``left``, or of ``left`` and ``right``."""
    shapes = [(n, script(n)) for n in left if n and n.strip()]
    others = shapes if right is None else [(n, script(n)) for n in right if n and n.strip()]
    for i, (n, s) in enumerate(others):
        for m, u in shapes[:i] if right is None else shapes:
            if s == u == "han":
                a, b = han_core(n)[0], han_core(m)[0]
                if len(a) == len(b) >= 2 and a != b:
                    same = sum(x == y for x, y in zip(a, b))
                    if same and same * 3 >= len(a):
                        for x, y in zip(a, b):
                            if x != y:
                                yield "v", min(x, y), max(x, y)
            elif {s, u} == {"han", "latin"}:
                h, lat = (n, m) if s == "han" else (m, n)
                core, titled = han_core(h)
                tokens = [plain(t) for t in latin_tokens(lat)]
                if titled and len(core) < 2 or len(tokens) != 2 or not 2 <= len(core) <= 5 or core.endswith(ORG_ENDS):
                    continue
                for a, b in (tokens, tokens[::-1]):
                    for k in range(1, len(core)):
                        yield "p", core[:k], a
                        yield "p", core[k:], b
                    sa, sb = syllables(a, 1), syllables(b, len(core) - 1)
                    if sa and sb and len(core) <= 3:
                        for c, x in zip(core, sa + sb):
                            yield "r", c, x
            elif s == u == "latin":
                a = [plain(t.strip(".,")) for t in latin_tokens(n)]
                b = [plain(t.strip(".,")) for t in latin_tokens(m)]
                a, b = [t for t in a if len(t) > 1 and t not in TITLES], [t for t in b if len(t) > 1 and t not in TITLES]
                if len(a) == len(b) >= 2:
                    x, y = Counter(a) - Counter(b), Counter(b) - Counter(a)
                    if len(x) == len(y) == 1:
                        p, q = next(iter(x)), next(iter(y))
                        yield "w", min(p, q), max(p, q)


def learn(entities: DataFrame, least: int = 2, broadcast_rows: int = 100_000, block: int = 64) -> tuple[Lexicon, DataFrame | None]:
    """Lexicon from the aliases of all entities, and the readings of name parts (key, reading) where they do not go into it.

    An entity of more than ``block`` spellings counts once per pair of blocks. Writes the entries. Up to ``broadcast_rows`` of them the lexicon holds all and the table is None.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n: Counter = Counter()
            for left, right, same in zip(pdf["l"], pdf["r"], pdf["same"]):
                n.update(set(_learn(list(left), None if same else list(right))))
            yield pd.DataFrame([(*k, c) for k, c in n.items()], columns=["kind", "a", "b", "n"])

    # every spelling of an entity meets every other, in blocks, so that no task holds more than two blocks of one entity
    spelled = entities.where("aliases is not null and size(aliases) > 0").select(F.array_distinct(F.concat(F.array("name"), "aliases")).alias("s")).where("size(s) > 1")
    last = F.floor((F.size("s") - 1) / block).cast("int")
    spelled = spelled.select("s", last.alias("last"), F.explode(F.sequence(F.lit(0), last)).alias("i"))
    spelled = spelled.select("s", "i", F.explode(F.sequence("i", "last")).alias("j"))
    part = lambda k: F.slice("s", F.col(k) * block + 1, F.lit(block))
    pairs_ = spelled.select(part("i").alias("l"), F.when(F.col("i") != F.col("j"), part("j")).alias("r"), (F.col("i") == F.col("j")).alias("same"))
    counts = pairs_.mapInPandas(run, "kind string, a string, b string, n bigint").groupBy("kind", "a", "b").agg(F.sum("n").alias("n"))
    rows = cut(counts.where(F.col("n") >= least), "lexicon")
    if rows.count() <= broadcast_rows:
        return build_lexicon([(r.kind, r.a, r.b, r.n) for r in rows.orderBy(F.desc("n"), "kind", "a", "b").collect()]), None
    lex = build_lexicon([(r.kind, r.a, r.b, r.n) for r in rows.where("kind = 'v'").collect()])
    base = F.translate("a", "".join(lex.chars), "".join(lex.chars.values())).alias("key")
    best = rows.where("kind in ('r', 'p')").groupBy("kind", base).agg(F.max(F.struct("n", "b")).getField("b").alias("reading"))
    lex.readings = {r.key: r.reading for r in best.where("kind = 'r'").collect()}
    words = rows.where("kind = 'w'")
    freq = words.select(F.explode(F.array("a", "b")).alias("word"), "n").groupBy("word").agg(F.sum("n").alias("freq"))
    for end in "ab":
        words = words.join(freq.select(F.col("word").alias(end), F.col("freq").alias("f" + end)), end)
    likely = words.where((F.col("n") >= 3) & (F.greatest(F.length("a"), F.length("b")) > 2) & (F.levenshtein("a", "b") > 2))
    for r in likely.orderBy(F.desc("n"), "a", "b").toLocalIterator():
        add_word(lex, r.a, r.b, r.n, r.fa, r.fb)
    return lex, cut(best.where("kind = 'p'").select("key", "reading"), "parts")


def shortens(short: str, long_: str) -> bool:
    """Whether ``short`` is ``long_`` with letters left out behind the first."""
    rest = iter(long_)
    return len(short) < len(long_) and short[0] == long_[0] and all(c in rest for c in short)


def add_word(lex: Lexicon, a: str, b: str, n: int, freq_a: int, freq_b: int) -> None:
    """Take ``a`` and ``b`` as equivalent, an abbreviation for the word and else the rarer for the other, unless an entry before says otherwise."""
    short, long_ = (a, b) if (freq_a, -len(a)) < (freq_b, -len(b)) else (b, a)
    least = 3
    if shortens(a, b) or shortens(b, a):
        short, long_, least = *sorted((a, b), key=len), 2
    if n >= 3 and len(short) >= least and len(long_) > 2 and not {a, b} & STOP_WORDS and short not in lex.words and long_ not in lex.words and short not in lex.goals and distance(short, long_) > 2:
        lex.words[short] = long_
        lex.goals.add(long_)


def build_lexicon(rows: list[tuple[str, str, str, int]]) -> Lexicon:
    lex = Lexicon()
    weight: Counter = Counter()
    parent: dict[str, str] = {}

    def root(x: str) -> str:
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    for kind, a, b, n in rows:
        if kind == "v":
            weight[a] += n
            weight[b] += n
    for kind, a, b, n in rows:
        if kind == "v":
            ra, rb = root(a), root(b)
            if ra != rb:
                keep, other = (ra, rb) if (weight[ra], rb) >= (weight[rb], ra) else (rb, ra)
                parent[other] = keep
    lex.chars = {c: root(c) for c in weight if root(c) != c}
    best: dict[tuple[str, str], tuple[int, str]] = {}
    for kind, a, b, n in rows:
        if kind in "rp":
            key = (kind, lex.base(a))
            if (n, b) > best.get(key, (0, "")):
                best[key] = (n, b)
    lex.readings = {a: b for (k, a), (_, b) in best.items() if k == "r"}
    lex.parts = {a: b for (k, a), (_, b) in best.items() if k == "p"}
    freq: Counter = Counter()
    for kind, a, b, n in rows:
        if kind == "w":
            freq[a] += n
            freq[b] += n
    for kind, a, b, n in rows:
        if kind == "w":
            add_word(lex, a, b, n, freq[a], freq[b])
    return lex


def distance(a: str, b: str) -> int:
    """Levenshtein distance, a metric."""
    if len(a) < len(b):
        a, b = b, a
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


# ------------------------------------------------------------------ DataFrame operators


def current_entities(entities: DataFrame) -> DataFrame:
    """id, work_id, name, kind (person, org, place or null) and aliases of the current, not deleted entities."""
    k = F.lower(F.trim("kind"))
    kind = F.when(k.isin(*PERSON), "person").when(k.isin(*ORG), "org").when(k.isin(*PLACE), "place")
    rows = current_rows(entities, ["id"], {"gone": F.coalesce(F.col("is_deleted"), F.lit(False)), "work_id": "work_id", "name": "name", "kind": kind, "aliases": "aliases"})
    return rows.where("not gone and work_id is not null").select("id", "work_id", "name", "kind", "aliases")


_SCRIPT = ((r"[\u3040-\u30ff\u3400-\u9fff]", "han"), (r"[\u0e00-\u0e7f]", "thai"), (r"[\u0900-\u097f]", "deva"))


def _written(c: F.Column) -> F.Column:
    """The script of a spelling by its first tell-tale character."""
    out = F.lit("latin")
    for pattern, name in reversed(_SCRIPT):
        out = F.when(c.rlike(pattern), name).otherwise(out)
    return out


def _pieces(c: F.Column) -> F.Column:
    """Tokens in lower case; Han and kana one by one."""
    return F.filter(F.split(F.lower(c), r"[\s,.]+|(?<=[\u3040-\u30ff\u3400-\u9fff])"), lambda x: x != "")


def anybody(entities: DataFrame, least: int = 4) -> DataFrame:
    """alias: spellings that stand for anybody, as they stand beside unlike names of their own script with at least
    ``least`` different first letters, in as many works. Unlike: no token shared and neither inside the other."""
    name, alias = F.col("name"), F.col("alias")
    unlike = (_written(name) == _written(alias)) & ~F.arrays_overlap(_pieces(name), _pieces(alias)) & ~F.contains(F.lower(name), F.lower(alias)) & ~F.contains(F.lower(alias), F.lower(name))
    return (
        entities.where("name is not null and aliases is not null")
        .select("work_id", "name", F.upper(F.substring(F.trim("name"), 1, 1)).alias("first"), F.explode(F.array_distinct("aliases")).alias("alias"))
        .where(alias.isNotNull() & (name != alias))
        .where(unlike)
        .groupBy("alias")
        .agg(F.approx_count_distinct("first", 0.02).alias("firsts"), F.approx_count_distinct("work_id").alias("works"))
        .where(f"firsts >= {least} and works >= {least}")
        .select("alias")
    )


def part_keys(name: str | None, lex: Lexicon) -> list[str]:
    """Keys under which :func:`forms` looks for readings of name parts; learned ones have at most four characters."""
    t = lex.base(han_core(name)[0]) if name and script(name) == "han" else ""
    return sorted({x for k in range(1, len(t)) if k <= 4 and len(t) - k <= 4 for x in (t[:k], t[k:])})


def entity_forms(entities: DataFrame, lex: Lexicon, parts: DataFrame | None = None) -> DataFrame:
    """id, work_id, role (full, covers, part), form. ``parts``: key, reading, where they are not in ``lex``."""
    shared = entities.sparkSession.sparkContext.broadcast(lex)

    @F.pandas_udf("array<struct<role:string,form:string>>")
    def run(name: pd.Series, kind: pd.Series, read: pd.Series) -> pd.Series:
        lx = shared.value
        out = []
        for n, k, own in zip(name, kind, read):
            full, covers, part = forms(n, k or None, lx if own is None else replace(lx, parts={x["key"]: x["reading"] for x in own}))
            out.append([{"role": r, "form": f} for r, fs in (("full", full), ("covers", covers), ("part", part)) for f in dict.fromkeys(fs)])
        return pd.Series(out)

    @F.pandas_udf("array<string>")
    def keys(name: pd.Series) -> pd.Series:
        return name.map(lambda n: part_keys(n, shared.value))

    kind = F.coalesce("kind", F.lit("")).alias("kind")
    own = entities.where("name is not null").select("id", "work_id", kind, F.col("name").alias("spelling"))
    alias = entities.select("id", "work_id", kind, F.explode(F.array_distinct("aliases")).alias("spelling")).where(F.col("spelling").isNotNull())
    alias = alias.join(anybody(entities).withColumnRenamed("alias", "spelling"), "spelling", "left_anti").select("id", "work_id", "kind", "spelling")
    spellings = cut(own.unionByName(alias).distinct(), "spellings")
    distinct = spellings.select("spelling", "kind").distinct()
    read = "array<struct<key:string,reading:string>>"
    if parts is None:
        distinct = distinct.withColumn("read", F.lit(None).cast(read))
    else:
        wanted = distinct.select("spelling").distinct().select("spelling", F.explode(keys("spelling")).alias("key"))
        distinct = distinct.join(wanted.join(parts, "key").groupBy("spelling").agg(F.collect_list(F.struct("key", "reading")).alias("read")), "spelling", "left")
    formed = distinct.select("spelling", "kind", run("spelling", "kind", "read").alias("fs"))
    return spellings.join(formed, ["spelling", "kind"]).select("id", "work_id", F.explode("fs").alias("f")).select("id", "work_id", "f.role", "f.form").distinct()


def radius(form: F.Column) -> F.Column:
    """Edit radius of a full form by script and length: two for long alphabetic ones, one for shorter, none where one letter is another name."""
    n = F.length(form) - 2
    head = F.substring(form, 1, 2)
    one = (head.isin("L:", "D:") & (n >= 7)) | (head.isin("T:") & (n >= 8)) | (head.isin("R:") & (n >= LEAST_READ)) | (head.isin("H:") & (n >= LEAST_HAN))
    return F.when(head.isin("L:") & (n >= 10), 2).when(one, 1).otherwise(0)


#: Lengths from which romanised and Han forms may differ by one character; shorter ones are other names.
LEAST_READ = 12
LEAST_HAN = 6


def cells(points: DataFrame, cell_items: int = 12, fan: int = 8) -> DataFrame:
    """``points`` (work_id, form, r) spread over cells: work_id, cell, form, r, home. Writes a table per level.

    The first cell of a form is its work and script. Every cell of more than ``cell_items`` home forms draws ``fan``
    pivots from its own forms (those of least hash in ``fan`` hash classes); a home form moves to the cell of its
    nearest pivot, and every form is copied to each cell whose pivot is at most twice its radius farther than its
    nearest. By the triangle inequality each pair within the smaller radius still meets in the home cell of either.
    The number of pivots so grows with the work. A cell whose forms cannot be told apart stays as it is.
    """
    at = cut(points.select("work_id", F.xxhash64(F.substring("form", 1, 2)).alias("cell"), "form", "r", F.lit(True).alias("home"), F.lit(None).cast("bigint").alias("above")), "cells")
    level = 0
    while True:
        level += 1
        size = at.where("home").groupBy("work_id", "cell").agg(F.count("*").alias("n"), F.max("above").alias("above"))
        big = size.where((F.col("n") > cell_items) & (F.col("above").isNull() | (F.col("n") < 0.9 * F.col("above")))).select("work_id", "cell", "n")
        if big.limit(1).count() == 0:
            return at
        h = F.xxhash64("form", F.lit(level))
        drawn = at.where("home").join(big, ["work_id", "cell"]).groupBy("work_id", "cell", "n", F.pmod(h, F.lit(fan)).alias("k")).agg(F.min(F.struct(h.alias("h"), "form")).getField("form").alias("pivot"))
        pivots = drawn.groupBy("work_id", "cell", "n").agg(F.sort_array(F.collect_list("pivot")).alias("pivots"))
        # a form of a cell that is not split stays where it is
        dist = at.join(pivots, ["work_id", "cell"], "left").withColumn("d", F.transform("pivots", lambda p: F.levenshtein(F.col("form"), p))).withColumn("least", F.array_min("d"))
        spots = dist.select("work_id", "cell", "form", "r", "home", "above", "n", F.posexplode_outer("d").alias("i", "far"), "least", (F.array_position("d", F.col("least")) - 1).alias("own"))
        stays = F.col("n").isNull()
        moved = spots.where(stays | (F.col("far") <= F.col("least") + 2 * F.col("r"))).select(
            "work_id", F.when(stays, F.col("cell")).otherwise(F.xxhash64("cell", "i")).alias("cell"), "form", "r", F.when(stays, F.col("home")).otherwise(F.col("home") & (F.col("i") == F.col("own"))).alias("home"), F.when(stays, F.col("above")).otherwise(F.col("n")).alias("above")
        )
        new = cut(moved, "cells")
        release(at)
        at = new


def _word_by_word(x: F.Column, y: F.Column) -> F.Column:
    """Whether no short word differs by two edits, where both forms have as many words."""
    letters = lambda w: F.array_sort(F.split(w, ""))
    near = lambda a, b: (F.least(F.length(a), F.length(b)) >= 5) | (F.levenshtein(a, b) <= 1) | (letters(a) == letters(b))
    a, b = F.split(F.substr(x, F.lit(3)), " "), F.split(F.substr(y, F.lit(3)), " ")
    return (F.size(a) != F.size(b)) | F.forall(F.zip_with(a, b, near), lambda ok: ok)


def radius_join(full: DataFrame, cell_items: int = 12, fan: int = 8) -> DataFrame:
    """work_id, form_a < form_b: all pairs of different forms of one work within the smaller of their radii. Writes the cells.

    ``full``: work_id, form (distinct). Home forms meet all forms of their cell, and the edit distance itself decides. Two
    edits in one word of under five letters make another word, unless its letters only changed places.
    """
    at = cells(full.withColumn("r", radius(F.col("form"))).where("r > 0"), cell_items, fan)
    x = at.where("home").select("work_id", "cell", F.col("form").alias("x"), F.col("r").alias("rx"))
    y = at.select("work_id", "cell", F.col("form").alias("y"), F.col("r").alias("ry"), F.col("home").alias("yh"))
    r = F.least("rx", "ry")
    met = x.join(y, ["work_id", "cell"]).where((F.col("x") < F.col("y")) | ((F.col("x") > F.col("y")) & ~F.col("yh"))).where(F.abs(F.length("x") - F.length("y")) <= r)
    close = met.where(F.levenshtein(F.col("x"), F.col("y"), 2).between(0, r)).where(_word_by_word(F.col("x"), F.col("y")))
    return close.select("work_id", F.least("x", "y").alias("form_a"), F.greatest("x", "y").alias("form_b")).distinct()


def classes(held: DataFrame) -> DataFrame:
    """id, label: connected classes of ids that share a form; the label is the least id. ``held``: id, work_id, form.

    Every form is a star around its least id; the stars are contracted until no edge is left.
    """
    label = components(stars(held.select("id", "work_id", "form").distinct(), ["work_id", "form"])).withColumnRenamed("node", "id")
    return held.select("id").distinct().join(label, "id", "left").select("id", F.coalesce("label", "id").alias("label"))


def linked(entities: DataFrame) -> DataFrame:
    """id, work_id, label: one row per linkable entity, its class within the work."""
    ents = current_entities(entities)
    ents = cut(ents, "entities")
    place = ents.where("kind = 'place'").select("work_id", "name").distinct()
    ents = ents.where("kind is null or kind <> 'place'").join(place, ["work_id", "name"], "left_anti").select("id", "work_id", "name", "kind", "aliases")
    have = cut(entity_forms(ents, *learn(ents)), "forms")
    full = have.where("role = 'full'").select("id", "work_id", "form")
    close = cut(radius_join(full.select("work_id", "form").distinct()), "close")
    both = close.select("work_id", F.col("form_a").alias("form"), F.col("form_b").alias("other")).unionByName(close.select("work_id", F.col("form_b").alias("form"), F.col("form_a").alias("other")))
    held = full.unionByName(full.join(both, ["work_id", "form"]).select("id", "work_id", F.col("other").alias("form")))
    label = cut(classes(held), "classes")
    # parts: the one class of the work that covers them
    covered = have.where("role = 'covers'").join(label, "id").groupBy("work_id", "form").agg(F.min("label").alias("label"), F.count_distinct("label").alias("n"))
    parts = have.where("role = 'part'").join(label, "id", "left_anti").select("id", "work_id", "form")
    rank = F.when(F.col("form").startswith("i:"), 0).otherwise(1)
    fitting = parts.join(covered, ["work_id", "form"], "left")
    attached = fitting.where("n = 1").groupBy("id").agg(F.min(F.struct(rank.alias("k"), "label")).getField("label").alias("label"))
    # parts that nothing covers: the same part in one work means the same
    left = fitting.where("n is null").select("id", "work_id", "form").join(attached.select("id"), "id", "left_anti")
    alone = left.groupBy("work_id", "form").agg(F.min("id").alias("label"))
    lonely = left.join(alone, ["work_id", "form"]).groupBy("id").agg(F.min("label").alias("label"))
    all_ = label.unionByName(attached).unionByName(lonely)
    return ents.select("id", "work_id").join(all_, "id", "left").select("id", "work_id", F.coalesce("label", "id").alias("label"))


def pairs(classed: DataFrame) -> DataFrame:
    """entity_id_a < entity_id_b of one work and class. Writes the classes."""
    classed = cut(classed, "members")
    a = classed.select("work_id", "label", F.col("id").alias("entity_id_a"))
    b = classed.select("work_id", "label", F.col("id").alias("entity_id_b"))
    return a.join(b, ["work_id", "label"]).where(F.col("entity_id_a") < F.col("entity_id_b")).select("entity_id_a", "entity_id_b")
