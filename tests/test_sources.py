import wave

import pytest
from helpers import rows
from pyspark.sql import functions as F

from clipweave import config, schemas, scorers
from clipweave.sources import jsonl, lake, media
from clipweave.streaming import incremental


def test_settings(tmp_path, monkeypatch):
    (tmp_path / "base.yaml").write_text("a: {b: 1, c: 2}\npath: ${SOME_DIR:-/tmp}/x\n")
    (tmp_path / "own.yaml").write_text("extends: base.yaml\na: {c: 3}\n")
    s = config.load_settings(tmp_path / "own.yaml")
    assert (s.a.b, s.a.c, s.path) == (1, 3, "/tmp/x")
    monkeypatch.setenv("SOME_DIR", "")
    assert config.load_settings(tmp_path / "own.yaml").path == "/tmp/x"
    with pytest.raises(KeyError):
        config.expand("${NOT_SET_ANYWHERE}")
    with pytest.raises(AttributeError):
        s.nothing


def test_jsonl_round_trip_and_missing_path(spark, tmp_path):
    df = spark.createDataFrame([("u1",), ("u2",)], schemas.LINKS)
    jsonl.write_jsonl(df, str(tmp_path / "l"))
    assert rows(jsonl.read_jsonl(spark, str(tmp_path / "l"), schemas.LINKS)) == [("u1",), ("u2",)]
    assert jsonl.read_jsonl(spark, str(tmp_path / "none"), schemas.LINKS).count() == 0


def test_links_keep_their_first_place(spark, tmp_path):
    (tmp_path / "links.txt").write_text("# note\n b \n\na\nb\n")
    assert [r["url"] for r in jsonl.read_links(spark, str(tmp_path / "links.txt")).orderBy("place").collect()] == ["b", "a"]


def write_wav(path, seconds):
    path.parent.mkdir(parents=True, exist_ok=True)
    with wave.open(str(path), "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(8000)
        w.writeframes(b"\0\0" * int(8000 * seconds))


def test_media_index(spark, tmp_path):
    write_wav(tmp_path / "My Playlist" / "Talk ｜ part 1 [abcdefghijk].wav", 20)
    write_wav(tmp_path / "NA" / "Talk [abcdefghijk].wav", 20)
    write_wav(tmp_path / "NA" / "short [ABCDEFGHIJK].wav", 5)
    write_wav(tmp_path / "x.temp.wav", 20)
    (tmp_path / "NA" / "bad [zzzzzzzzzzz].wav").write_bytes(b"no")
    files = media.list_files(spark, str(tmp_path), content=True)
    assert files.count() == 4
    parts = media.parsed_name(F.regexp_replace("path", f".*/{tmp_path.name}/", ""))
    described = media.probe_headers(files).select("path", "duration", "error", *[c.alias(n) for n, c in parts.items()])
    got = {r["title"]: (r["outcome"], r["playlist"]) for r in media.settle(described, 10.0).collect()}
    assert got == {"Talk | part 1": ("ok", "My Playlist"), "Talk": ("duplicate", None), "short": ("short", None), "bad": ("error", None)}


def test_shards_hold_whole_videos_and_close_when_full(spark):
    df = spark.createDataFrame([(f"v{i}", b) for i, b in enumerate([4, 7, 1, 12, 3])], "video_id string, bytes long")
    got = dict(rows(lake.pack_shards(df, 10)))
    assert got == {"v0": 1, "v1": 1, "v2": 2, "v3": 2, "v4": 3}
    assert lake.pack_shards(df.limit(0), 10).count() == 0


def test_shards_stay_open_across_batches(spark):
    sizes = [i * 7919 % 13 for i in range(50_011)]
    fill, no, want = 0, 1, {}
    for i, b in enumerate(sizes):
        want[f"v{i:06}"] = no
        fill += b
        if fill >= 100:
            fill, no = 0, no + 1
    df = spark.createDataFrame([(f"v{i:06}", b) for i, b in enumerate(sizes)], "video_id string, bytes long")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for most in ("10000", "777"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", most)
            assert {r["video_id"]: r["shard"] for r in lake.pack_shards(df, 100).collect()} == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_ledger_and_failures(spark, tmp_path):
    ledger = lake.Ledger(spark, str(tmp_path / "ledger"))
    assert ledger.done("a").count() == 0
    ledger.mark("a", spark.createDataFrame([("1",), ("2",)], "id string"))
    ledger.mark("b", spark.createDataFrame([("3",)], "id string"))
    assert rows(ledger.done("a")) == [("1",), ("2",)]
    one = spark.createDataFrame([("s", "x", "p", "t", "e", 1)], schemas.FAILURES)
    assert lake.merge_failures(one, one).first()["gpu_crashes"] == 2


def fragile():
    """A scorer that fails on some rows; made in a function, so that workers needn't import this file."""

    class Fragile(scorers.TextLengthScorer):
        def score(self, batch):
            if batch["text"].eq("bad").any():
                raise MemoryError("too large")
            return super().score(batch)

    return Fragile()


def test_a_failing_row_doesnt_take_its_batch_along(spark):
    df = spark.createDataFrame([(str(i), "bad" if i == 7 else "ab c") for i in range(20)], "id string, text string")
    got = scorers.apply(df, fragile(), order_by="text").toPandas()
    assert len(got) == 20 and got["error"].notna().sum() == 1 and got["chars"].sum() == 19 * 4
    with pytest.raises(KeyError):
        scorers.scorer("nothing")


def test_watching_a_folder_takes_each_file_once(spark, tmp_path):
    source, seen = tmp_path / "in", []
    schema = spark.range(1).selectExpr("id", "cast('x' as string) s").schema
    for k in range(2):
        spark.range(k * 3, k * 3 + 3).selectExpr("id", "cast('x' as string) s").write.mode("append").parquet(str(source))
        incremental.watch_folder(spark, str(source), schema, lambda df, n: seen.extend(r["id"] for r in df.collect()), str(tmp_path / "cp")).awaitTermination(60)
    assert sorted(seen) == list(range(6))


def test_stream_windows(spark, tmp_path):
    given = [("2025-01-01 00:10", "a"), ("2025-01-01 00:50", "a"), ("2025-01-01 03:00", "b")]
    spark.createDataFrame(given, "t string, k string").selectExpr("cast(t as timestamp_ntz) ts", "k").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts timestamp_ntz, k string").parquet(str(tmp_path / "in"))
    q = incremental.windowed_counts(stream, time="ts", group="k").writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination(60)
    assert rows(spark.table("w").select("k", "n")) == [("a", 2), ("b", 1)]
