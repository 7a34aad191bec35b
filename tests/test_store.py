import json

from lexweave.sources import store
from lexweave.streaming import ingest


def test_scan_counts_corrupt_files(spark, tmp_path):
    (tmp_path / "in/a").mkdir(parents=True)
    entry = {"id": "river", "headword": "river", "synonyms": ["Stream", "stream ", "brook", ""], "pos": [{"pos": "noun", "senses": [{"index": 0, "gloss": "g", "relations": [{"type": "hypernym", "target_term": "watercourse"}]}, {"index": 1, "retired": True, "relations": [{"type": "synonym", "target_term": "x"}]}]}]}
    (tmp_path / "in/a/1.json").write_text(json.dumps(entry))
    (tmp_path / "in/a/2.json").write_text("{broken")
    good, bad = store.scan(spark, str(tmp_path / "in"))
    assert good.count() == 1 and bad.count() == 1
    assert [(r.type, r.target_term) for r in store.upgrade(good).orderBy("ord").collect()] == [("synonym", "Stream"), ("synonym", "brook")]
    assert [tuple(r)[:4] for r in store.relations(good).collect()] == [("river:noun:0", 0, "hypernym", "watercourse")]
    assert store.lookup(good, spark.createDataFrame([("river",), ("none",)], "id string")).count() == 1


def test_snapshots(spark, tmp_path):
    for v in (1, 2):
        store.write_snapshot(spark.range(v), str(tmp_path / "s"), v)
    assert store.latest(spark, str(tmp_path / "s")).count() == 2


def test_stream(spark, tmp_path):
    rows = [(i, f"2024-01-01 00:{i:02d}:00", 1, "click", 1.0, "{}") for i in range(30)]
    df = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string").selectExpr("event_id", "cast(ts as timestamp_ntz) ts", "user_id", "event_type", "value", "props")
    df.repartition(3).write.parquet(str(tmp_path / "events"))
    q = ingest.windowed(ingest.stream(spark, str(tmp_path / "events"), ingest.EVENTS)).writeStream.outputMode("complete").format("memory").queryName("windowed").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.events for r in spark.table("windowed").collect()) == [5] * 6
