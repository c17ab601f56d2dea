import datetime as dt

from lamina.operators import orphans as o
from lamina.streaming import text as s


def test_texts_become_tables_once(spark, tmp_path):
    src, out, ck = tmp_path / "in", tmp_path / "out", tmp_path / "ck"
    src.mkdir()
    (src / "a.txt").write_text("# T\n\nOne. Two.", encoding="utf-8")
    for _ in range(2):
        q = s.into_tables(s.texts(spark, str(src)), str(out), str(ck))
        q.awaitTermination(120)
        (src / "b.txt").write_text("Three.", encoding="utf-8")
    segs = spark.read.parquet(str(out / "segments"))
    assert sorted((r.doc_id, r.text_slice) for r in segs.collect()) == [("a", "# T"), ("a", "One."), ("a", "Two."), ("b", "Three.")]


def test_orphans_follow_streams_of_two_tables(spark, tmp_path):
    claims = o.Table("claims", (o.Reference("subject", "subject", "entity"),), "claim")
    entities = o.Table("entities", (), "entity")
    schema = "id string, subject string, loaded_at timestamp, is_deleted boolean"
    t = dt.datetime
    log = o.Log(spark, str(tmp_path / "log"))

    def push(table, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / table.name))
        q = s.orphan_changes(spark.readStream.schema(schema).parquet(str(tmp_path / table.name)), table, log, str(tmp_path / f"ck_{table.name}"))
        q.awaitTermination(120)
        assert q.exception() is None

    report = lambda: sorted((r.src_id, r.ref_id, r.reason) for r in o.failing(log.state((claims, entities))).collect())
    push(claims, [("a", "x", t(2025, 1, 1), False), ("b", "x", t(2025, 1, 1), False)])
    assert report() == [("a", "x", "absent"), ("b", "x", "absent")]
    push(entities, [("y", None, t(2025, 1, 1), False), ("x", None, t(2025, 1, 1), False)])
    assert report() == []
    push(claims, [("a", "y", t(2025, 1, 2), False), ("b", None, t(2025, 1, 2), True)])
    push(entities, [("y", None, t(2025, 1, 3), True)])
    assert report() == [("a", "y", "deleted")]


def test_windowed_counts(spark, tmp_path):
    schema = "ts timestamp, kind string"
    spark.createDataFrame([(dt.datetime(2025, 1, 1, 0, 5), "a"), (dt.datetime(2025, 1, 1, 0, 50), "a"), (dt.datetime(2025, 1, 1, 3, 0), "a")], schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    df = s.windowed_counts(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "ts", "kind")
    q = s.to_memory(df, "windowed", "complete")
    q.awaitTermination(120)
    assert sorted(r.events for r in spark.sql("select * from windowed").collect()) == [1, 2]
