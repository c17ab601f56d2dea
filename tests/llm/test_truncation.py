import datetime as dt
import json
import random

import numpy as np
from pyspark.sql import functions as F

from lamina.llm import truncation as t

SCHEMA = "cache_key string, request struct<model:string>, response struct<raw_text:string,stop_reason:string>, quality struct<parse_ok:boolean,truncated:boolean>, loaded_at timestamp, raw_text string, label int"


def answer(rng, i):
    objs = [{"t": "E", "lid": f"e{k}", "n": rng.choice(["Ann Lee", "林雯", "Bob"]), "k": "person", "sid": [f"s{k}"]} for k in range(rng.randint(1, 4))]
    objs += [{"t": "C", "sid": ["s1"], "s": "e1", "p": "met", "q": "the cat sat on", "m": "asserted"} for _ in range(rng.randint(2, 8))]
    if i % 3 == 0:
        return " ".join(rng.choice(["The old cat saw the wet dog.", "Nobody came to the harbour!", "She bought the lamp at night."]) for _ in range(rng.randint(4, 12)))
    text = json.dumps(objs, ensure_ascii=False, separators=(",", ":") if i % 2 else (", ", ": "))
    return f"```json\n{text}\n```" if i % 5 == 0 else text + ("\nLet me know if more is needed" if i % 7 == 0 else "")


def test_held_out_accuracy():
    rng = random.Random(3)
    values = [(answer(rng, i), [512]) for i in range(700)]
    model = t.fit(values[:500])
    w, ends = model
    good = total = 0
    for text, lim in values[500:]:
        for x, cut in [(text, False), *[(c, True) for c in t.cut_copies(text, lim, rng)]]:
            z = w[t.hashed(t.describe(x, lim, ends))].sum() + w[t.DIM]
            good += (z >= 0) == cut
            total += 1
    assert good / total > 0.97


def rows(spark, items):
    when = dt.datetime(2025, 1, 1)
    return spark.createDataFrame([(k, (m,), None if x is None else (x, stop), (True, False), when + dt.timedelta(days=d), "x", 1) for k, m, x, stop, d in items], SCHEMA)


def test_current_rows_nulls_and_sources(spark):
    rng = random.Random(4)
    items = [(f"k{i}", "m1" if i % 2 else None, answer(rng, i), "end_turn", 0) for i in range(300)]
    whole = items[1][2]
    items += [("a", "m1", whole, "end_turn", 0), ("a", "m1", whole[:-9] + "…", "max_tokens", 1), ("b", "m1", whole[:40], "max_tokens", 0), ("b", "m1", whole, "end_turn", 1), ("b", "m1", whole, "end_turn", 1), ("c", "m1", None, None, 0), ("d", "m1", "", "end_turn", 0), (None, "m1", whole[:40], "max_tokens", 0)]
    df = rows(spark, items)
    found = {r.cache_key for r in t.truncated(df).collect()}
    assert "a" in found and not found & {"b", "c", "d", None}
    r = {x.model: (x.texts, x.cut) for x in t.rates(df).collect()}
    assert r["m1"][0] == 152 and r[None][0] == 150


def test_empty_table(spark):
    assert t.truncated(rows(spark, [])).count() == 0


def test_limits_are_spikes(spark):
    items = [(f"a{i}", "m", "x" * 100, "end_turn", 0) for i in range(40)] + [(f"b{i}", "m", "x" * (50 + i * 3), "end_turn", 0) for i in range(60)]
    assert [(r.model, r.limits) for r in t.limits(t.current_responses(rows(spark, items))).collect()] == [("m", [100])]


def test_structure():
    assert t.structure('[{"a":"b"}]') == (False, 0, 0) and t.structure('x [{"a":"b') == (True, 2, 0) and t.structure('[{"a":"]"},') == (False, 1, 0)
    assert t.structure('[{"a":"\\""}]') == (False, 0, 0)


def test_endings_are_counted_over_all_rows(spark):
    items = [(f"k{i}", "m", "The old cat saw the harbour. Nobody came.", "end_turn", 0) for i in range(40)] + [("long", "m", "She left the zebra. " * 1200, "end_turn", 0), ("cut", "m", "The zebra. " * 9, "max_tokens", 0)]
    df = t.current_responses(rows(spark, items)).withColumn("limits", F.lit(None).cast("array<bigint>"))
    ends = t.ending_shares(df)
    assert {r.word: r.share for r in ends.collect()} == t.endings([x[2] for x in items[:-1]])
    seen = []
    fit, t.fit = t.fit, lambda values, shares: (seen.append((len(values), shares({"harbour", "zebra", "nowhere"}))), ({}, {}))[1]
    try:
        t.train(df, ends, sample=5)
    finally:
        t.fit = fit
    assert seen == [(5, {"harbour": 1.0, "zebra": 1.0})]


def test_scores_use_the_shares_of_all_rows(spark):
    items = [("a", "m", "They came to the harbour...", "end_turn", 0), ("b", "m", "They came to the…", "end_turn", 0), ("c", "m", "No more. . .", "end_turn", 0), ("d", "m", None, "end_turn", 0), ("e", "m", "Done.", "end_turn", 0)]
    df = t.current_responses(rows(spark, items)).withColumn("limits", F.lit(None).cast("array<bigint>"))
    shares = {"harbour": 0.5, "the": 0.0, "more": 0.05, "other": 1.0}
    ends = spark.createDataFrame(list(shares.items()), "word string, share double")
    w = np.random.default_rng(1).normal(size=t.DIM + 1)
    want = {k: None if x is None else 1 / (1 + np.exp(-np.clip(w[t.hashed(t.describe(x, None, shares))].sum() + w[t.DIM], -30, 30))) for k, _, x, _, _ in items}
    for most in (200_000, -1):
        got = {r.cache_key: r.cut_score for r in t.score(df, w, ends, most).collect()}
        assert got.keys() == want.keys() and all(got[k] == want[k] or abs(got[k] - want[k]) < 1e-9 for k in want)
