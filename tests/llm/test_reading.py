import random

import numpy as np
import pytest

from lamina.llm import reading as r

EASY, MID, HARD = ["cat", "dog", "milk", "rope", "bell", "hat"], ["lantern", "harbour", "captain", "ledger", "journey"], ["jurisdiction", "provenance", "stipulation", "ratification", "indemnification"]


def corpus(n=400, seed=5):
    rng = random.Random(seed)
    docs, grades = [], {}
    for i in range(n):
        g = rng.randint(1, 5)
        pool = {1: EASY, 2: EASY * 2 + MID, 3: EASY + MID * 3, 4: MID * 2 + HARD, 5: MID + HARD * 4}[g]
        docs.append((i, "the " + " and the ".join(rng.choice(pool) for _ in range(90)), "x"))
        grades[i] = g
    return docs, grades


def test_held_out_grades(spark):
    docs, grades = corpus()
    d = spark.createDataFrame([*docs, (None, "the cat", "x"), (901, None, "x"), (902, "", "x"), (903, "12345", "x")], "doc_id long, text string, label string")
    labels = spark.createDataFrame([(i, "a", g) for i, g in list(grades.items())[:150]] + [(0, "b", None), (1, "b", 99), (None, "b", 3), (5000, "b", 3)], "doc_id long, rater string, grade int")
    got = {x.doc_id: x.grade for x in r.graded(d, labels).collect()}
    rest = [i for i in grades if i >= 150]
    assert np.mean([got[i] == grades[i] for i in rest]) > 0.8 and np.mean([abs(got[i] - grades[i]) <= 1 for i in rest]) > 0.98
    assert got[903] is None and not set(got) & {None, 901, 902}
    assert r.profile(r.graded(d, labels)).count() > 0


def test_without_labels_or_documents(spark):
    d = spark.createDataFrame([(1, "the cat")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, rater string, grade int")
    assert [x.grade for x in r.graded(d, none).collect()] == [None]
    assert r.graded(d.limit(0), none).count() == 0


@pytest.mark.parametrize("text,want", [("the cat and the dog", "en"), ("der Hund und die Katze", "de"), ("猫看见了狗。", "zh"), ("猫は犬を見た。", "ja"), ("หมาเห็นแมว", "th"), ("घर ने देखा", "hi"), ("12 %", "other"), ("", "other")])
def test_language(text, want):
    assert r.language(text) == want


def test_running_text():
    assert "code" not in r.running("# head\n\nText here that is long enough.\n\n    code_1 = 2\n| a | b |\n- item") and "Text" in r.running("# head\n\nText here that is long enough.\n- x")
    assert r.running("| only | tables |") == "| only | tables |"


def test_isotonic():
    x, y = r.isotonic(np.array([1.0, 2, 3]), np.array([1.0, 3, 2]), np.array([1.0, 1, 1]))
    assert y.tolist() == [1.0, 2.5] and x.tolist() == [1.0, 2.5]


def test_word_buckets_are_bounded():
    ids, n = r.nodes(r.words("the cat and the cat", "en"), "en")
    assert all(0 <= i < r.BUCKETS for i in ids) and sum(n) == 5
