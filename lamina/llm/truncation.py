"""Text cut off by field limits: hashed logistic regression trained on artificially cut values.

Method. Values that look intact (stop reason and flags agree) give the negatives; the same values,
cut at random places and at the limits of their source and partly dressed up again (an ellipsis, a
note, a repaired JSON ending), give the positives. Both are described by hashed features of how
the text closes: the last characters, closing punctuation, open brackets and quotes, the members
of the last JSON object against those before it, trailing notes, and the distance of the length to
a limit of the source. A logistic regression is fitted on the driver on at most ``sample``
values (a bounded sample of labelled rows); every record is then scored in Arrow batches.

Limits are found in all data: a length at which far more values of one source end than at the
lengths around it.

Defined cases: the current row of a key counts; null and empty texts are not cut; a null source is
a source of its own; texts are read whole; an empty table gives no rows; with no intact value to
learn from the built-in prior weights decide (open structure or no closing mark).
"""

from __future__ import annotations

import random
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import current_rows, cut

DIM = 1 << 14

_STRING = re.compile(r'"(?:[^"\\]|\\.)*"', re.S)
_OBJECT = re.compile(r"\{[^{}]*\}")
_MEMBER = re.compile(r'"(\w{1,24})"\s*:')
_JSON_HEAD = re.compile(r'[\[{]\s*(?://[^\n]*\n\s*)?[\[{]?\s*(?:"|\}|\])')
_FENCE = re.compile(r"\n?\s*```\s*\Z")
#: Words by which a tool says that it left something out. Fixed values.
_LEFT_OUT = re.compile(r"trunc|trim|omit|cut|clip|remain|continu|abridg|shorten|snip|more|省略|截断|略|未完|続|अपूर्ण|ต่อ", re.I)
_NOTE = re.compile(r"\s*(\.{3}|…+)?\s*(\[[^\[\]\n]{1,40}\]|\([^()\n]{1,40}\)|<[^<>\n]{1,40}>|（[^（）\n]{1,40}）)\s*\Z")
_ELLIPSIS = re.compile(r"(?:\.{3,}|…+|\. \. \.)\Z")
_TERMINAL = set(".!?。！？．｡।॥؟…")
_CLOSING = set("\"'”’»」』）)]}】》›“‘")
_WORD = re.compile(r"[^\W\d_]+\Z")
PAIRS = {"“": "”", "„": "“", "「": "」", "『": "』", "（": "）", "(": ")", "《": "》"}


def _char_class(c: str) -> str:
    if c in _TERMINAL:
        return "end"
    if c in _CLOSING:
        return "close"
    if c == "�":
        return "broken"
    if c in ",;:、，；：-–—/\\|=":
        return "mid"
    cat = unicodedata.category(c)
    if cat[0] == "L":
        o = ord(c)
        return "han" if 0x3400 <= o <= 0x9FFF or o >= 0x20000 else "kana" if 0x3040 <= o <= 0x30FF else "deva" if 0x900 <= o <= 0x97F else "thai" if 0xE00 <= o <= 0xE7F else "upper" if c.isupper() else "lower"
    if cat[0] == "M":
        return "mark"
    if cat[0] == "N":
        return "digit"
    return "symbol" if cat[0] == "S" else "other"


def json_like(text: str) -> bool:
    """Whether the text holds JSON, bare, fenced or within prose."""
    return _JSON_HEAD.search(text) is not None and '"' in text


def structure(text: str) -> tuple[bool, int, int]:
    """(a string is open, open brackets, brackets closed too often) of JSON-like text from its first bracket on."""
    start = min((i for i in (text.find("["), text.find("{")) if i >= 0), default=0)
    bare = _STRING.sub("", text[start:])
    open_string = '"' in bare
    if open_string:
        bare = bare[: bare.index('"')]
    depth = over = 0
    for c in re.findall(r"[\[\]{}]", bare):
        if c in "[{":
            depth += 1
        elif depth:
            depth -= 1
        else:
            over += 1
    return open_string, depth, over


def _last_object(text: str) -> list[str]:
    """How the last flat object differs from those before it."""
    objects = _OBJECT.findall(text)
    if len(objects) < 2:
        return ["obj:few"]
    last, out = objects[-1], []
    names = set(_MEMBER.findall(last))
    kind = re.search(r'"t"\s*:\s*"(\w+)"', last)
    before = [set(_MEMBER.findall(o)) for o in objects[:-1]]
    alike = [set(_MEMBER.findall(o)) for o in objects[:-1] if kind and re.search(r'"t"\s*:\s*"%s"' % kind[1], o)]
    common = set.intersection(*(alike or before[-3:]))
    out.append("obj:lacks" if common - names else "obj:like")
    if len(names) < min(len(b) for b in before):
        out.append("obj:fewest")
    spaced = ['": ' in _STRING.sub('""', o) for o in objects[:-1]]
    if ('": ' in _STRING.sub('""', last)) != (sum(spaced) * 2 > len(spaced)):
        out.append("obj:style")
    return out


def ending(text: str) -> str:
    """The last word, or in scripts without spaces the last two characters."""
    if not text:
        return ""
    if _char_class(text[-1]) in ("han", "kana", "thai", "mark"):
        return text[-2:]
    word = _WORD.search(text)
    return word[0].lower() if word else text[-1]


_ENDED = re.compile(r"[^\s.!?。！？।॥…]{1,24}(?=[.!?。！？।॥…]+(?:[\s\"'”’»」』)）]|\Z))")
_ANY_WORD = re.compile(r"[^\W\d_]+")


def ending_counts(texts: Iterable[str]) -> tuple[Counter, Counter]:
    """How often each word (or pair of characters) stands in the texts, and how often at the end of a sentence."""
    total: Counter = Counter()
    last: Counter = Counter()
    for t in texts:
        for w in _ANY_WORD.findall(t):
            if _char_class(w[0]) in ("upper", "lower"):
                total[w.lower()] += 1
            else:
                total.update(map(str.__add__, w, w[1:]))
        for w in _ENDED.findall(t):
            last[ending(w)] += 1
    return total, last


def endings(texts: list[str]) -> dict[str, float]:
    """Of each word (or last pair of characters) how often it stands at the end of a sentence."""
    total, last = ending_counts(texts)
    return {w: last[w] / n for w, n in total.items() if n >= 3}


class _Asked(dict):
    """Takes down the word whose ending share a text depends on."""

    word: str | None = None

    def get(self, key: str, default: float) -> float:  # type: ignore[override]
        self.word = key
        return default


def asked(text: str | None) -> str | None:
    """The word that stands before the closing ellipsis of running text, if there is one."""
    note = _Asked()
    if text and any(x in text for x in ("…", "...", ". . .")):
        describe(text, None, note)
    return note.word


def describe(text: str, limits: list[int] | None, ends: dict[str, float] | None = None) -> list[str]:
    """Names of the features of one value. ``ends``: from :func:`endings`."""
    size, raw = len(text), len(text.encode("utf-8", "surrogatepass"))
    body = text.rstrip()
    out = []
    for lim in limits or ():
        if size == lim or raw == lim or 0 <= lim - raw <= 3 and body[-1:] == "�" or 0 < raw - lim <= 3 and body[-1:] == "�":
            out.append("limit")
    note = _NOTE.search(body)
    marked = bool(note and _LEFT_OUT.search(note[2]))
    if marked:
        body = body[: note.start()]
        out.append("note")
        for lim in limits or ():
            if len(body) == lim or len(body.encode("utf-8", "surrogatepass")) == lim:
                out.append("limit")
    ell = _ELLIPSIS.search(body)
    core = body[: ell.start()] if ell else body
    is_json = json_like(text)
    if is_json:
        inside, depth, over = structure(core)
        fenced = _FENCE.search(body) is not None
        tail = text[text.rfind("]") + 1 :] if depth == 0 else ""
        out += ["json", f"json:string{int(inside)}", f"json:depth{min(depth, 4)}", f"json:over{int(over > 0)}", f"json:fence{int(fenced)}", f"json:tail{int(bool(tail.strip()))}"]
        if depth or inside:
            out.append("json:open")
        if ell:
            out.append("json:ellipsis")
        if depth == 0 and not inside:
            out += [f"json:{x}" for x in _last_object(core)]
        out.append("json:last:" + _char_class(core[-1]) if core else "json:none")
        return out
    # running text: a short last line of its own is a note or a signature, the text ends before it
    lines = core.rsplit("\n", 1)
    tailed = len(lines) == 2 and 0 < len(lines[1].strip()) <= 40 and lines[0].rstrip()[-1:] in (_TERMINAL | _CLOSING)
    if tailed:
        out.append("text:tail")
        core = lines[0].rstrip()
        ell = None
    while core and unicodedata.category(core[-1]) in ("So", "Zs", "Cf", "Sk") and core[-1] != "�":
        core = core[:-1].rstrip()
        out.append("text:symbol")
    kind = _char_class(core[-1]) if core else "none"
    closing = kind == "close"
    inner = core.rstrip("".join(_CLOSING)) if closing else core
    ended = kind == "end" or closing and inner[-1:] in _TERMINAL
    out += ["text", f"text:last:{kind}", f"text:ended{int(ended)}"]
    if closing and not ended:
        out.append("text:closed")
    if ell:
        share = ({} if ends is None else ends).get(ending(core), -1.0)
        known = "new" if share < 0 else "never" if share < 0.01 else "seldom" if share < 0.1 else "often"
        out += [f"text:ellipsis:{ell[0][:4]}", f"text:ellipsis:{ell[0][:4]}:{known}", f"text:ellipsis:{kind}:{known}", f"ellw:{ending(core)[-12:]}"]
    else:
        out += [f"c1:{core[-1:]}", f"c2:{core[-2:]}"]
        if marked:
            out.append("text:marked")
    for a, b in PAIRS.items():
        if core.count(a) > core.count(b) and a != b:
            out.append("text:openquote")
            break
    return out


def hashed(names: list[str]) -> np.ndarray:
    return np.unique(np.fromiter((zlib.crc32(n.encode()) % DIM for n in names), dtype=np.int64, count=len(names)))


# ------------------------------------------------------------------ artificial cuts


def _close_json(text: str) -> str:
    """Close what a cut left open, as a repairing tool does: the broken last member is dropped or ended."""
    open_string, depth, _ = structure(text)
    at = text.rfind("{")
    head = text[:at]
    members = re.findall(r'"(\w+)"\s*:\s*("(?:[^"\\]|\\.)*"|\[[^\[\]]*\]|[\d.]+)', text[at:])
    if len(members) < 1:
        return re.sub(r",?\s*\Z", "", head) + "]"
    kept = ", ".join(f'"{k}": {v}' for k, v in members)
    return head + "{" + kept + "}]"


def cut_copies(text: str, limits: list[int] | None, rng: random.Random) -> list[str]:
    """Cut versions of an intact value."""
    n = len(text)
    if n < 24:
        return []
    out = []
    places = [rng.randrange(max(8, n // 8), n - 2)]
    if limits and rng.random() < 0.6:
        places += [lim for lim in limits if lim < n - 2][:1]
    is_json = json_like(text)
    for place in places:
        part = text[:place]
        if is_json and structure(part)[1] == 0 and not structure(part)[0]:
            continue
        if not is_json:
            # a cut right behind a finished sentence leaves no trace; it is no positive to learn from
            end = part.rstrip()
            if not end or _char_class(end[-1]) in ("end", "close"):
                continue
        dress = rng.random()
        if dress < 0.12:
            part = part.rstrip() + rng.choice(["...", "…"])
        elif dress < 0.22:
            part = part.rstrip() + rng.choice([" [truncated]", "…(omitted)", " (continued)"])
        elif is_json and dress < 0.45:
            part = _close_json(part)
            if "obj:lacks" not in _last_object(part):
                continue  # what is missing cannot be seen
        elif dress < 0.5:
            raw = part.encode()
            part = raw[: len(raw) - 1].decode("utf-8", "replace") if len(raw) > len(part) else part
        out.append(part)
    return out


def fit(values: list[tuple[str, list[int] | None]], seed: int = 17, epochs: int = 40, l2: float = 1e-4, shares: Callable[[set[str]], dict[str, float]] | None = None) -> tuple[np.ndarray, dict[str, float]]:
    """Weights of the logistic regression (the last entry is the bias) and the sentence endings they rely on.

    ``shares`` looks up the ending shares of words; without it they are counted in ``values``.
    """
    rng = random.Random(seed)
    labelled: list[tuple[str, list[int] | None, float]] = []
    for text, limits in values:
        labelled.append((text, limits, 0.0))
        labelled += [(part, limits, 1.0) for part in cut_copies(text, limits, rng)]
    if shares is None:
        ends = endings([t for t, _ in values if not json_like(t)])
    else:
        ends = shares({w for text, _, _ in labelled if (w := asked(text)) is not None})
    rows = [hashed(describe(text, limits, ends)) for text, limits, _ in labelled]
    ys = [y for _, _, y in labelled]
    w = np.zeros(DIM + 1)
    if len(set(ys)) < 2:
        for name, v in (("json:open", 3.0), ("text:ended0", 1.5), ("text:tail", -1.0), ("note", 3.0), ("json:lacks", 1.5), ("json:obj:lacks", 3.0), ("text:closed", -1.5)):
            w[zlib.crc32(name.encode()) % DIM] = v
        w[DIM] = -1.0
        return w, ends
    flat = np.concatenate(rows)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    y = np.array(ys)
    weight = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    grad2 = np.full(DIM + 1, 1e-8)
    for _ in range(epochs * 5):
        z = np.bincount(owner, weights=w[flat], minlength=len(rows)) + w[DIM]
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        e = (p - y) * weight
        g = np.bincount(flat, weights=e[owner], minlength=DIM + 1) + l2 * w * (np.arange(DIM + 1) < DIM)
        g[DIM] = e.sum()
        grad2 += g * g
        w -= 0.5 * g / np.sqrt(grad2)
    return w, ends


# ------------------------------------------------------------------ DataFrame operators


def current_responses(entries: DataFrame) -> DataFrame:
    """cache_key, model, raw_text, looks_intact of the current rows."""
    fields = {
        "model": F.col("request.model"),
        "raw_text": F.col("response.raw_text"),
        "looks_intact": (F.col("response.stop_reason") == "end_turn") & ~F.coalesce(F.col("quality.truncated"), F.lit(False)) & F.coalesce(F.col("quality.parse_ok"), F.lit(True)),
    }
    return current_rows(entries, ["cache_key"], fields)


def limits(rows: DataFrame, least: int = 12, share: float = 0.004, against: int = 12) -> DataFrame:
    """model, limits: lengths (in code points or bytes) at which at least ``least`` values and ``share`` of a source end, and many more than at the ``against`` lengths around.

    At most 1 / ``share`` limits per source can exist, so the lists are short by construction.
    """
    sized = rows.where(F.length("raw_text") > 0).select(F.coalesce("model", F.lit("")).alias("model"), F.explode(F.array(F.length("raw_text"), F.octet_length("raw_text"))).alias("size"))
    per = sized.groupBy("model", "size").agg(F.count("*").alias("n"))
    total = per.groupBy("model").agg(F.sum("n").alias("total"))
    near = per.select("model", F.col("n").alias("m"), F.explode(F.expr(f"sequence(size - {against}, size + {against})")).alias("size"), F.col("size").alias("other")).where("other <> size").groupBy("model", "size").agg(F.sum("m").alias("m"))
    spikes = per.join(total, "model").where((F.col("n") >= least) & (F.col("n") >= F.col("total") * share)).join(near, ["model", "size"], "left").where(F.col("n") > 4 * F.coalesce("m", F.lit(0)) / against + 4)
    return spikes.groupBy("model").agg(F.sort_array(F.collect_list("size")).alias("limits"))


def ending_shares(rows: DataFrame) -> DataFrame:
    """word, share: :func:`endings` over every value of running text that looks intact, whatever its length. Writes the table."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            total, last = ending_counts(t for t in pdf["raw_text"] if not json_like(t))
            yield pd.DataFrame([(w, n, last[w]) for w, n in total.items()] + [(w, 0, n) for w, n in last.items() if w not in total], columns=["word", "total", "last"])

    counts = rows.where(F.col("looks_intact") & (F.length("raw_text") > 0)).select("raw_text").mapInPandas(run, "word string, total bigint, last bigint").groupBy("word").agg(F.sum("total").alias("total"), F.sum("last").alias("last"))
    return cut(counts.where("total >= 3").select("word", (F.col("last") / F.col("total")).alias("share")), "endings")


def train(rows: DataFrame, ends: DataFrame, sample: int = 6000) -> np.ndarray:
    """Fit on at most ``sample`` values that look intact, drawn by a hash of the key, whatever their length. ``ends``: word, share. Runs two jobs."""
    intact = rows.where(F.col("looks_intact") & (F.length("raw_text") > 0))
    picked = intact.orderBy(F.xxhash64("cache_key"), "cache_key").limit(sample).select("raw_text", "limits").collect()

    def shares(words: set[str]) -> dict[str, float]:
        if not words:
            return {}
        few = F.broadcast(rows.sparkSession.createDataFrame([(w,) for w in sorted(words)], "word string"))
        return {r.word: r.share for r in ends.join(few, "word", "left_semi").collect()}

    return fit([(r.raw_text, list(r.limits) if r.limits else None) for r in picked], shares=shares)[0]


#: Classes of ending shares in the order of :func:`share_class`.
KNOWN = ("new", "never", "seldom", "often")


def share_class(share: F.Column) -> F.Column:
    """Place of an ending share among KNOWN."""
    return F.when(share.isNull(), 0).when(share < 0.01, 1).when(share < 0.1, 2).otherwise(3)


def chances(text: str, limits: list[int] | None, weights: np.ndarray) -> tuple[str | None, list[float]]:
    """(word before a closing ellipsis, probability that the text was cut: one, or one for each class of that word's ending share)."""
    note = _Asked()
    names = describe(text, limits, note)

    def chance(ns: list[str]) -> float:
        z = weights[hashed(ns)].sum() + weights[DIM]
        return float(1 / (1 + np.exp(-max(-30.0, min(30.0, z)))))

    if note.word is None:
        return None, [chance(names)]
    end = ":" + KNOWN[0]
    return note.word, [chance([n[: -len(end)] + ":" + k if n.startswith("text:ellipsis:") and n.endswith(end) else n for n in names]) for k in KNOWN]


def score(rows: DataFrame, weights: np.ndarray, ends: DataFrame, broadcast_rows: int = 200_000) -> DataFrame:
    """cache_key, model and ``cut_score``: the probability that raw_text was cut off; null for null and empty texts.

    The texts are read once: where the chance depends on how often the word before an ellipsis ends a sentence, it is worked
    out for every class of that share, and the words alone are looked up in ``ends`` (word, share), which is broadcast only
    up to ``broadcast_rows``. Writes the chances.
    """
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("struct<word:string,chances:array<double>>")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        w = shared.value
        for text, lims in batches:
            out = [chances(t, list(lim) if lim is not None else None, w) if t else (None, None) for t, lim in zip(text, lims)]
            yield pd.DataFrame({"word": [x for x, _ in out], "chances": [c for _, c in out]})

    at = cut(rows.select("cache_key", "model", run("raw_text", "limits").alias("c")).select("cache_key", "model", "c.word", "c.chances"), "chances")
    used = cut(ends.join(at.select("word").distinct(), "word", "left_semi"), "used")
    at = at.join(F.broadcast(used) if used.count() <= broadcast_rows else used, "word", "left")
    place = F.when(F.col("word").isNull(), 0).otherwise(share_class(F.col("share")))
    return at.select("cache_key", "model", F.get("chances", place).alias("cut_score"))


def scored(entries: DataFrame, sample: int = 6000) -> DataFrame:
    """cache_key, model, cut_score for every current entry. Writes the entries, counts endings and trains first."""
    rows = current_responses(entries).withColumn("_m", F.coalesce("model", F.lit("")))
    rows = cut(rows, "responses")
    lim = limits(rows).withColumnRenamed("model", "_m")
    rows = rows.join(lim, "_m", "left").drop("_m")
    ends = ending_shares(rows)
    return score(rows, train(rows, ends, sample), ends)


def truncated(entries: DataFrame, threshold: float = 0.5) -> DataFrame:
    """cache_key of the entries whose text was cut off."""
    return scored(entries).where(F.col("cut_score") >= threshold).select("cache_key")


def rates(entries: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Per model: texts, cut texts and their share."""
    s = scored(entries).where(F.col("cut_score").isNotNull())
    found = F.sum((F.col("cut_score") >= threshold).cast("bigint"))
    return s.groupBy("model").agg(F.count("*").alias("texts"), found.alias("cut"), F.round(found / F.count("*"), 6).alias("cut_share"))


def reported(entries: DataFrame, results: DataFrame) -> DataFrame:
    """doc_id, reported (most truncated batches any run of the document reports, null where none does), flagged and answers (cache entries flagged as truncated, and with a text)."""
    runs = current_rows(results, ["run_id"], {"doc_id": "doc_id", "n": "batches_truncated"}).where("doc_id is not null").groupBy("doc_id").agg(F.max("n").alias("reported"))
    cached = current_rows(entries, ["cache_key"], {"doc_id": "doc_id", "text": F.col("response.raw_text"), "flag": F.col("quality.truncated")}).where("doc_id is not null")
    cached = cached.groupBy("doc_id").agg(F.count_if(F.coalesce("flag", F.lit(False))).alias("flagged"), F.count_if(F.length("text") > 0).alias("answers"))
    return runs.join(cached, "doc_id", "full").select("doc_id", "reported", F.coalesce("flagged", F.lit(0)).alias("flagged"), F.coalesce("answers", F.lit(0)).alias("answers"))


def compared(entries: DataFrame, results: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, reported, flagged, answers and found: the truncations that runs and flags report beside those found."""
    docs = current_rows(entries, ["cache_key"], {"doc_id": "doc_id"}).select("cache_key", "doc_id")
    found = scored(entries).where(F.col("cut_score") >= threshold).join(docs, "cache_key").where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("found"))
    return reported(entries, results).join(found, "doc_id", "left").withColumn("found", F.coalesce("found", F.lit(0)))
