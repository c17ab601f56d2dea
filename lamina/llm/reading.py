"""Reading level of each document: difficulty propagated over the graph of documents and words.

Method. Documents and words form a bipartite graph; an edge weighs the word's share of the
document's running text times how specific the word is to a level. Documents graded by raters are
clamped to their mean grade. In each harmonic iteration a word takes the mean of its documents and
a free document the mean of its words. The iterations stop after four steps, before they have settled: with few
graded documents further steps draw all values together (measured on held-out labels, see README). A
monotone map per language, fitted on the graded documents, then turns the propagated value into a
grade from 1 to 5.

Words are nodes by hash: the graph has 2**20 word nodes (BUCKETS) at every size of the corpus, so what
an iteration returns and broadcasts has a fixed bound. Words that share a node share their value. Documents stay where they
are; an iteration is one scan with a map-side sum and a small reduction.

Running text is what is left without headings, tables, list items, code and quotes' signs; a text
of nothing else is taken whole. Scripts without spaces are cut into character pairs.

Defined cases: null ids are dropped; null and empty texts and texts with no known word get grade
null; several ratings of a document are averaged, null and out-of-range ones ignored; without any
rating every grade is null.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import cut

BUCKETS = 1 << 20

_LATIN = re.compile(r"[^\W\d_]{2,}")
_HAN = re.compile(r"[㐀-鿿\U00020000-\U0003134f]{2,}")
_KANA = re.compile(r"[぀-ヿ]")
_ASIAN = re.compile(r"[㐀-鿿぀-ヿ]{2,}")
_THAI = re.compile(r"[฀-๿]{3,}")
_DEVA = re.compile(r"[ऀ-ॿ]{2,}")
_APART = re.compile(r"^(?:[ \t]{4,}\S.*|\s*(?:#|\||```|[-*] |\d+[.、)] ).*)$", re.M)
_DE = frozenset("der die das und den dem ein eine nicht mit vor im am sich von zu auf aber denn".split())
_EN = frozenset("the and of to in a is that it was for with but which at by so".split())


def language(text: str) -> str:
    """Language by the text's own letters: zh, ja, th, hi, de, en or other."""
    return _language(text, Counter(_LATIN.findall(text.lower())))


def _language(text: str, latin: Counter) -> str:
    """``latin``: the words of alphabetic scripts in the text."""
    n_latin = sum(len(w) * n for w, n in latin.items() if w[0] < "ɐ")
    if text.isascii():
        han = thai = deva = kana = 0
    else:
        han, thai, deva = sum(map(len, _HAN.findall(text))), sum(map(len, _THAI.findall(text))), sum(map(len, _DEVA.findall(text)))
        kana = len(_KANA.findall(text))
    best = max((n_latin * 0.4, "latin"), (han + kana, "han"), (thai * 0.4, "th"), (deva * 0.5, "hi"))
    if not best[0]:
        return "other"
    if best[1] == "latin":
        de, en = sum(latin[w] for w in _DE), sum(latin[w] for w in _EN)
        return "de" if de > en else "en" if en else "other"
    if best[1] == "han":
        return "ja" if kana * 10 > han + kana else "zh"
    return best[1]


def running(text: str) -> str:
    """Without headings, tables, lists and code, where anything is left."""
    left = _APART.sub("", text)
    return left if len(left.strip()) * 8 >= len(text.strip()) else text


def words(text: str, lang: str, latin: Counter | None = None) -> Counter:
    """Words of the running text; ``latin``: those of the whole text, where they are at hand."""
    body = running(text)
    if lang in ("zh", "ja"):
        out: Counter = Counter()
        for run in _ASIAN.findall(body):
            out.update(map(str.__add__, run, run[1:]))
        return out
    if lang == "th":
        out = Counter()
        for run in _THAI.findall(body):
            out.update(run[i : i + 3] for i in range(len(run) - 2))
        return out
    if lang == "hi":
        return Counter(_DEVA.findall(body))
    return latin if latin is not None and body == text else Counter(_LATIN.findall(body.lower()))


_NODE: dict[str, int] = {}


def nodes(counts: Counter, lang: str) -> tuple[list[int], list[int]]:
    """Bucket and count of each word."""
    if len(_NODE) > 500_000:
        _NODE.clear()
    ids = []
    for w in counts:
        key = lang + w
        n = _NODE.get(key)
        if n is None:
            n = _NODE[key] = zlib.crc32(key.encode("utf-8", "surrogatepass")) & (BUCKETS - 1)
        ids.append(n)
    return ids, list(counts.values())


def graph(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang, chars, label, words, counts: the edges, packed per document and written once."""

    @F.pandas_udf("struct<lang:string,words:array<int>,counts:array<int>>")
    def edges(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            langs, ids, ns = [], [], []
            for t in batch:
                latin = Counter(_LATIN.findall(t.lower()))
                lang = _language(t, latin)
                i, n = nodes(words(t, lang, latin), lang)
                langs.append(lang)
                ids.append(i)
                ns.append(n)
            yield pd.DataFrame({"lang": langs, "words": ids, "counts": ns})

    rated = labels.where(F.col("doc_id").isNotNull() & F.col("grade").between(1, 5)).groupBy("doc_id").agg(F.avg("grade").alias("label"))
    docs = documents.where(F.col("doc_id").isNotNull() & (F.length("text") > 0)).select("doc_id", F.length("text").alias("chars"), edges("text").alias("e"))
    return cut(docs.select("doc_id", "chars", "e.lang", "e.words", "e.counts").join(rated, "doc_id", "left"), "reading")


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """word bucket, edge share of its document, document row; and the labels (NaN: free)."""
    lists = batch.column("words")
    sizes = np.diff(lists.offsets.to_numpy())
    w = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    c = np.sqrt(batch.column("counts").flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    owner = np.repeat(np.arange(len(sizes)), sizes)
    total = np.bincount(owner, weights=c, minlength=len(sizes))
    share = c / np.maximum(total[owner], 1e-9)
    label = batch.column("label").to_numpy(zero_copy_only=False).astype(np.float64)
    return w, share, owner, label


def _means(w: np.ndarray, share: np.ndarray, owner: np.ndarray, n: int, score: np.ndarray, weight: np.ndarray) -> np.ndarray:
    e = share * weight[w]
    den = np.bincount(owner, weights=e, minlength=n)
    num = np.bincount(owner, weights=e * np.nan_to_num(score[w]), minlength=n)
    return np.where(den > 0, num / np.maximum(den, 1e-12), np.nan)


def _iterate(docs: DataFrame, score: np.ndarray | None, weight: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """One harmonic step: (mean, weight) per bucket from the documents' values."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((score, weight))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, k = shared.value
        mass, first, second, seen = (np.zeros(BUCKETS) for _ in range(4))
        for batch in batches:
            w, share, owner, label = _flat(batch)
            f = label if s is None else np.where(np.isnan(label), _means(w, share, owner, len(label), s, k), label)
            ok = ~np.isnan(f[owner]) if len(owner) else np.zeros(0, bool)
            w, e, v = w[ok], share[ok], f[owner[ok]]
            used, at = np.unique(w, return_inverse=True)
            mass[used] += np.bincount(at, weights=e)
            first[used] += np.bincount(at, weights=e * v)
            second[used] += np.bincount(at, weights=e * v * v)
            seen[used] += np.bincount(at)
        b = np.flatnonzero(mass)
        yield pa.RecordBatch.from_arrays([pa.array(b.astype(np.int32)), *[pa.array(x[b]) for x in (mass, first, second, seen)]], names=["b", "mass", "first", "second", "seen"])

    src = docs.where("label is not null") if score is None else docs
    sums = src.select("words", "counts", "label").mapInArrow(step, "b int, mass double, first double, second double, seen double").groupBy("b").agg(*[F.sum(x).alias(x) for x in ("mass", "first", "second", "seen")]).toPandas()
    mean = np.full(BUCKETS, np.nan)
    out = np.zeros(BUCKETS)
    if len(sums):
        b = sums["b"].to_numpy()
        m = (sums["first"] / sums["mass"]).to_numpy()
        var = np.maximum((sums["second"] / sums["mass"]).to_numpy() - m * m, 0)
        mean[b] = m
        n = sums["seen"].to_numpy()
        out[b] = n / (n + 3) / (var + 0.15)
    shared.unpersist()
    return mean, out


def propagate(docs: DataFrame, iterations: int = 4, tolerance: float = 0.01) -> tuple[np.ndarray, np.ndarray]:
    """(value, weight) of every word bucket after at most ``iterations`` harmonic steps. One job per step."""
    score, weight = _iterate(docs, None, None)
    for _ in range(iterations):
        new, weight = _iterate(docs, score, weight)
        both = ~np.isnan(new) & ~np.isnan(score)
        moved = float(np.abs(new[both] - score[both]).mean()) if both.any() else 0.0
        score = new
        if moved < tolerance:
            break
    return score, weight


def isotonic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the monotone fit as (centre, value) of its pools."""
    pools: list[list[float]] = []
    for a, b, c in sorted(zip(x, y, n)):
        pools.append([a * c, b * c, c])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            q = pools.pop()
            for i in range(3):
                pools[-1][i] += q[i]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


def graded(documents: DataFrame, labels: DataFrame, iterations: int = 4, step: float = 0.02) -> DataFrame:
    """doc_id, lang, chars, value (propagated), level (on the raters' scale), grade (1..5)."""
    docs = graph(documents, labels)
    spark = documents.sparkSession
    score, weight = propagate(docs, iterations)
    words_ = spark.sparkContext.broadcast((score.astype(np.float32), weight.astype(np.float32)))

    def value(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, k = words_.value
        for batch in batches:
            w, share, owner, label = _flat(batch)
            f = _means(w, share, owner, len(label), s, k)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), batch.column("chars"), batch.column("label"), pa.array(f, mask=np.isnan(f))], names=["doc_id", "lang", "chars", "label", "value"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    valued = docs.select("doc_id", "lang", "chars", "label", "words", "counts").mapInArrow(value, f"doc_id {kind}, lang string, chars int, label double, value double")
    # at most (languages) x (4 / step) rows come back
    bins = valued.where("label is not null and value is not null").groupBy("lang", F.round(F.col("value") / step).cast("int").alias("bin")).agg(F.avg("value").alias("x"), F.avg("label").alias("y"), F.count("*").alias("n")).toPandas()
    maps: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    if len(bins):
        maps[""] = isotonic(bins["x"].to_numpy(), bins["y"].to_numpy(), bins["n"].to_numpy())
        for lang, g in bins.groupby("lang"):
            if g["n"].sum() >= 12:
                maps[lang] = isotonic(g["x"].to_numpy(), g["y"].to_numpy(), g["n"].to_numpy())

    @F.pandas_udf("double")
    def level(value: pd.Series, lang: pd.Series) -> pd.Series:
        out = np.full(len(value), np.nan)
        v = value.to_numpy(dtype=float)
        for code in lang.unique():
            at = (lang == code).to_numpy()
            m = maps.get(code) or maps.get("")
            if m is not None:
                out[at] = np.interp(v[at], m[0], m[1])
        out[np.isnan(v)] = np.nan
        return pd.Series(out)

    lev = F.nanvl(level("value", "lang"), F.lit(None).cast("double"))
    grade = F.when(F.col("level").isNotNull(), F.least(F.greatest(F.floor(F.col("level") + 0.5), F.lit(1)), F.lit(5)).cast("int"))
    return valued.withColumn("level", lev).select("doc_id", "lang", "chars", "value", "level", grade.alias("grade"))


def profile(grades: DataFrame) -> DataFrame:
    """lang, grade, documents, chars."""
    return grades.groupBy("lang", "grade").agg(F.count("*").alias("documents"), F.sum("chars").alias("chars"))
