import datetime as dt

from lamina.operators import orphans as o

T = lambda day: dt.datetime(2025, 1, day)
EV = "array<struct<segment_id:string,span_start:int,span_end:int,quote_hash:string>>"
CLAIMS = f"id string, subject string, evidence_refs {EV}, loaded_at timestamp, is_deleted boolean, ref_id int, live string"
ENTITIES = f"id string, evidence_refs {EV}, loaded_at timestamp, is_deleted boolean, refs int"


def ref(*segs):
    return [(s, 0, 1, "h") for s in segs]


def frames(spark, claims=(), entities=(), segments=()):
    return {
        "claims": spark.createDataFrame([(*c, 1, "x") for c in claims], CLAIMS),
        "entities": spark.createDataFrame([(*e, 1) for e in entities], ENTITIES),
        "segments": spark.createDataFrame(list(segments), "id string, loaded_at timestamp, is_deleted boolean"),
        "relations": spark.createDataFrame([], f"id string, claim_id string, evidence_refs {EV}, loaded_at timestamp"),
        "kg_events": spark.createDataFrame([], f"id string, participants array<string>, evidence_refs {EV}, loaded_at timestamp"),
        "seed_entities": spark.createDataFrame([("seed", T(1))], "id string, loaded_at timestamp"),
    }


def found(df):
    return sorted((r.src_table, r.src_id, r.field_name, r.ref_id, r.reason) for r in df.collect())


def test_absent_deleted_late_and_live(spark):
    f = frames(
        spark,
        claims=[("c1", "e1", ref("s1", "s9"), T(5), False), ("c2", "gone", None, T(5), False), ("c3", "late", [], T(2), None), ("c4", "seed", None, T(5), False), ("c5", " 　", None, T(5), False), ("c6", None, None, T(5), False)],
        entities=[("e1", None, T(1), False), ("gone", None, T(1), False), ("gone", None, T(2), True), ("late", None, T(3), False)],
        segments=[("s1", T(1), False)],
    )
    assert found(o.orphans(o.PROJECT, f)) == [("claims", "c1", "segment_id", "s9", "absent"), ("claims", "c2", "subject", "gone", "deleted"), ("claims", "c3", "subject", "late", "late")]


def test_only_the_current_version_refers(spark):
    f = frames(spark, claims=[("c1", "x", None, T(1), False), ("c1", "seed", None, T(2), False), ("c2", "x", None, T(1), False), ("c2", None, None, T(2), True), ("c3", "x", None, T(1), False), ("c3", "x", None, T(1), False), (None, "x", None, T(1), False)])
    assert found(o.orphans(o.PROJECT, f)) == [("claims", "c3", "subject", "x", "absent")]


def test_a_restored_target_lives_and_repeats_count_once(spark):
    f = frames(spark, claims=[("c1", "e", ref("s", "s", None), T(9), False)], entities=[("e", None, T(1), False), ("e", None, T(2), True), ("e", None, T(3), False)])
    assert found(o.orphans(o.PROJECT, f)) == [("claims", "c1", "segment_id", "s", "absent")]


def test_empty_tables(spark):
    assert o.orphans(o.PROJECT, frames(spark)).count() == 0
    assert o.report(o.PROJECT, frames(spark)).count() == 0


def test_report_counts_per_table_and_month(spark):
    f = frames(spark, claims=[("c1", "x", None, T(1), False), ("c2", "x", None, T(2), False), ("c3", "y", None, dt.datetime(2025, 3, 1), False)])
    rows = {(r.period, r.failing, r.failing_keys) for r in o.report(o.PROJECT, f).collect()}
    assert rows == {("2025-01", 2, 1), ("2025-03", 1, 1)}


def test_signed_counts_advance_by_batches_as_in_one_go(spark):
    claims = (o.PROJECT[0],)
    rows = [("a", "k1", ref("s1"), T(1), False), ("b", "k1", None, T(1), False), ("a", "k2", None, T(2), False), ("b", None, None, T(3), True), ("c", "k2", None, T(3), False), ("a", "k0", None, T(1), False)]
    make = lambda r: {"claims": spark.createDataFrame([(*x, 1, "x") for x in r], CLAIMS)}
    state = o.begin(claims, make([]))
    for batch in (rows[:2], rows[2:3], rows[3:]):
        state = o.advance(claims, state, make(batch))
    once = o.begin(claims, make(rows[:5]))
    pick = lambda s: sorted((r.target, r.ref_id, r.refs, r.live) for r in s.counts.collect() if r.refs or r.live)
    assert pick(state) == pick(once)
    assert min(r.refs for r in state.counts.collect()) == 0 and state.counts.where("ref_id = 'k1' and refs = 0").count() == 1


def history(spark):
    """Corrections, deletions, a restored record and versions out of order, as (days of a batch) -> frames."""
    claims = [("c1", "e1", ref("s1"), T(1), False), ("c1", "e2", ref("s9"), T(4), False), ("c2", "e3", None, T(2), False), ("c2", None, None, T(6), True), ("c3", "e1", None, T(3), False), ("c4", "e4", None, T(2), False), ("c3", "e0", None, T(2), False)]
    entities = [("e1", None, T(1), False), ("e1", None, T(5), True), ("e2", None, T(6), False), ("e3", None, T(1), True), ("e3", None, T(3), False), ("e4", None, T(3), False)]
    segments = [("s1", T(1), False), ("s9", T(2), False), ("s9", T(7), True)]

    def days(*d):
        return frames(spark, [x for x in claims if x[3].day in d], [x for x in entities if x[2].day in d], [x for x in segments if x[1].day in d])

    return days


def test_batches_with_corrections_and_deletions_report_as_one(spark):
    days = history(spark)
    want = found(o.orphans(o.PROJECT, days(*range(1, 8))))
    assert want == [("claims", "c1", "segment_id", "s9", "deleted"), ("claims", "c1", "subject", "e2", "late"), ("claims", "c3", "subject", "e1", "deleted"), ("claims", "c4", "subject", "e4", "late")]
    for order in ([(1,), (2, 3, 4), (5, 6, 7)], [(7, 4, 3), (1, 3, 6, 2), (5,)]):
        state = o.begin(o.PROJECT, days(*order[0]))
        for d in order[1:]:
            state = o.advance(o.PROJECT, state, days(*d))
        assert found(o.failing(state)) == want


def test_log_keeps_adds_merges_and_survives_a_repeat(spark, tmp_path):
    days = history(spark)
    want = found(o.orphans(o.PROJECT, days(*range(1, 8))))
    log = o.Log(spark, str(tmp_path / "log"), merge_every=2)
    used = tuple(t for t in o.PROJECT if t.name in ("claims", "entities", "segments"))
    for n, d in enumerate(range(1, 8)):
        for t in used if n < 5 else used[::-1]:
            log.apply(t, days(d)[t.name], n)
            if n == 4:
                log.apply(t, days(d)[t.name], n)  # run again after a failure
    assert found(o.failing(log.state(o.PROJECT))) == want
    assert {r.period for r in o.monthly(o.failing(log.state(o.PROJECT))).collect()} == {"2025-01"}
    kept = log.batches("rows_claims")
    assert kept[-1] == (6, "full") and min(kept)[0] > 2 and (4, "full") in kept
    assert o.Log(spark, str(tmp_path / "none")).state(o.PROJECT).counts.count() == 0


def test_a_key_with_a_third_of_all_references(spark):
    f = frames(spark, claims=[(f"c{i}", "hot" if i % 3 == 0 else f"k{i}", None, T(2), False) for i in range(600)], entities=[(f"k{i}", None, T(1), False) for i in range(600)])
    assert o.orphans(o.PROJECT, f).count() == 200
