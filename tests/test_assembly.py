"""Assembly, balance, links, imports, the HTTP scorer and steps against small cases with known results."""

import io
import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import numpy as np
import pytest
from helpers import rows
from pyspark.sql import functions as F

from clipweave import cli, report, scorers, steps
from clipweave.functions import text as T
from clipweave.operators import assembly, balance, order, rules, select, stats
from clipweave.operators import timeseries as ts
from clipweave.sources import jsonl, lake, media


def test_the_later_table_wins_shared_columns(spark):
    a = spark.createDataFrame([("x", 1, "a"), ("y", 2, "a"), ("z", 3, "a")], "id string, n int, s string")
    b = spark.createDataFrame([("x", "b", 7), ("y", None, 8)], "id string, s string, m int")
    assert rows(assembly.merged_columns(a, b, "id")) == [("x", 1, "b", 7), ("y", 2, None, 8)]
    assert rows(assembly.merged_columns(a, b, "id", "left")) == [("x", 1, "b", 7), ("y", 2, None, 8), ("z", 3, "a", None)]


def test_only_videos_with_all_outputs_are_joined(spark):
    clips = spark.createDataFrame([("a1", "a"), ("a2", "a"), ("b1", "b")], "id string, video_id string")
    q = spark.createDataFrame([("a1", 3.0), ("b1", 4.0)], "id string, dnsmos_bak double")
    s = spark.createDataFrame([("a1", 0.9), ("a2", 0.9)], "id string, window_similarity double")
    assert rows(assembly.joined_clips(clips, q, s)) == [("a1", "a", 3.0, 0.9)]


def test_shard_rows_have_the_fixed_schema_and_come_back(spark, tmp_path):
    clips = spark.createDataFrame([(f"v{i % 3}_{i}", f"v{i % 3}", 7.0, 0, float(i)) for i in range(9)], "id string, video_id string, duration double, local_speaker int, start double")
    q = clips.select("id", F.lit(3.9).alias("dnsmos_bak"), F.lit(3.5).alias("utmos"))
    s = clips.select("id", F.lit(0.9).alias("window_similarity"), F.array(*[F.lit(0.5)] * 192).alias("speaker_embedding"))
    assignment, people = clips.select("id", F.lit("F_1").alias("speaker_id")), spark.createDataFrame([("F_1", "female")], "speaker_id string, gender string")
    videos = spark.createDataFrame([("v0", "T", None, "C")], "id string, title string, playlist string, channel string")
    out = assembly.hub_rows(clips, q.limit(8), s, assignment, people, videos)
    assert len(out.columns) == 32 and out.schema["duration"].dataType.typeName() == "float" and out.schema["end"].dataType.typeName() == "double"
    shards = lake.pack_shards(clips.groupBy("video_id").agg(F.lit(60).alias("bytes")), 100)
    lake.write_shards(out, shards, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 9 and back.agg(F.sum("duration")).first()[0] == 63.0 and back.where("gender = 'female'").count() == 9
    got = rows(assembly.manifest(clips.withColumn("ms", F.lit(7000)), shards, first=5, per_commit=1))
    assert [g[:4] for g in got] == [(5, 0, 2, 6), (6, 1, 1, 3)]
    assert set(assembly.clips_of_shards(back).columns).isdisjoint(assembly.NOT_OF_CLIPS) and assembly.imported_quality(back).count() == 6
    assert rows(assembly.to_push(clips, shards.where("shard = 1").select("video_id"))) == [("v2",)] and assembly.to_push(clips, shards, force=True, limit=2).count() == 2


def test_download_plan_and_skip_list(spark):
    found = spark.createDataFrame([("a", 100.0, None), ("b", 5.0, None), ("c", None, None), ("d", 0.0, "is_live"), ("e", 100.0, None), ("f", 5.0, "was_live")], "id string, duration double, live_status string")
    have = spark.createDataFrame([("e",), ("e",)], "id string")
    plan = dict(rows(assembly.download_plan(found, have, least_sec=10, most_sec=200)))
    assert plan == {"a": "todo", "b": "length", "c": "todo", "d": "live", "e": "have", "f": "length"}
    assert dict(rows(assembly.download_plan(found, have, least_sec=10, most_sec=200, force=True)))["e"] == "todo"
    failures = spark.createDataFrame([("s", "a", 2), ("s", "b", 1), ("t", "c", 5)], "step string, id string, gpu_crashes int")
    assert [r[0] for r in rows(assembly.without_broken(found, failures, step="s").select("id"))] == ["b", "c", "d", "e", "f"]


def test_published_words_tags_and_names(spark):
    w = "array<struct<word:string,start:double,end:double,score:double>>"
    schema = f"id string, text string, text_tagged string, tags array<string>, words {w}, " + ", ".join(f"{c} string" for c in assembly.PUBLISHED if c not in ("id", "text", "text_tagged", "tags", "words"))
    df = spark.createDataFrame([("a", "t", "", None, [("x", 0.1, 0.2, 9.0)], *[None] * 16)], schema)
    got = assembly.published_rows(df).first()
    assert got["text_tagged"] == "t" and got["tags"] == [] and got["words"][0].asDict() == {"word": "x", "start": 0.1, "end": 0.2} and tuple(assembly.published_rows(df).columns) == assembly.PUBLISHED
    hours = spark.createDataFrame([(9_000_000,)], "ms long")
    assert assembly.release_name("c", hours).first()[0] == "c-2h"


def test_balance_keeps_to_its_caps(spark):
    data = [(f"c{i}", "S", "v1" if i < 50 else "v2", "f", 10_000, 4000 - i) for i in range(55)] + [(f"d{i}", "T", "v3", "m", 10_000, 9000 + i) for i in range(5)]
    df = spark.createDataFrame(data, "id string, speaker_id string, video_id string, gender string, ms long, score long")
    got = select.diverse_cap(df, 100_000).where("speaker_id = 'S'")
    assert got.count() == 10 and got.select("video_id").distinct().count() == 2
    assert rows(select.best_until(df, 30_000, group="speaker_id").where("speaker_id = 'T'").select("id")) == [("d2",), ("d3",), ("d4",)]
    kept = balance.balanced(df, share=1.0, target_ms=60_000)
    assert rows(kept.select("id"))[-5:] == [(f"d{i}",) for i in range(5)] and kept.count() == 6
    parts = balance.split(df, test_speakers=5, test_ms=20_000, fraction=0.1)
    assert parts.where("split = 'test'").count() == 0 or parts.where("split = 'test'").select("speaker_id").distinct().count() == 1


def test_best_until_settles_ties_by_key(spark):
    df = spark.createDataFrame([(f"k{i}", "g", 10, 5) for i in range(6)] + [("z", "g", 10, 9), ("n", None, 10, 9)], "id string, grp string, ms long, score long")
    assert rows(select.best_until(df, 30, group="grp").select("id")) == [("k0",), ("k1",), ("z",)]


def test_places_run_over_blocks(spark):
    rng = np.random.default_rng(0)
    v = rng.integers(0, 40, 200).tolist()
    df = spark.createDataFrame([(i, x) for i, x in enumerate(v)] + [(999, None)], "k int, v int")
    out, n = order.placed(df, "v", "k", block=30)
    want = sorted((x, i) for i, x in enumerate(v))
    got = {r["k"]: (r["_place"], r["_running"]) for r in out.collect()}
    run = np.cumsum([x for x, _ in want])
    assert n == 200 and got == {i: (p + 1, int(run[p])) for p, (_, i) in enumerate(want)}


def test_gates_name_the_first_failure(spark):
    clips = spark.createDataFrame([(i,) for i in "abcdefg"], "id string")
    t = spark.createDataFrame([(i, i != "b", "كلام كتير جدا هنا") for i in "bcdefg"], "id string, ok boolean, text string")
    al = spark.createDataFrame([(i, -1.0, i != "c") for i in "cdefg"], "id string, align_score double, align_ok boolean")
    v = spark.createDataFrame([("e", "حاجة تانية خالص"), ("f", "كلام كتير جدا هنا"), ("g", "كلام كتير جدا هنا")], "id string, text string")
    a = spark.createDataFrame([("g", "S")], "id string, speaker_id string")
    got = dict(rows(balance.gated(clips.withColumn("speaker_id", F.lit(None).cast("string")), t, al, a, verify=v).select("id", "outcome")))
    assert got == {"a": "not_transcribed", "b": "transcript_sanity", "c": "alignment", "d": "not_verified", "e": "asr_disagreement", "f": "no_speaker", "g": "pass"}
    assert dict(rows(balance.gated(clips, t, al, a).select("id", "outcome")))["d"] == "no_speaker"


def test_tuner_pages(spark):
    clips = spark.createDataFrame([(f"c{i}", "v", x) for i, x in enumerate([3.0, 3.5, 3.7, None, 4.5])], "id string, video_id string, dnsmos_bak double")
    for c in ("window_similarity", "edge_db"):
        clips = clips.withColumn(c, F.lit(None).cast("double"))
    labels = spark.createDataFrame([("c0", "good"), ("c2", "bad"), ("c4", "good"), ("c1", "good"), ("c1", "bad")], "clip_id string, label string")
    j = rules.labelled(clips, labels, rules.with_limits())
    show = lambda **k: [r["id"] for r in rules.page(j, metric="dnsmos_bak", threshold=3.6, **k).collect()]
    assert show() == ["c1", "c2", "c0", "c4", "c3"] and show(show="wrong") == ["c2", "c0"] and show(show="unlabeled", order="low") == ["c1", "c3"]
    assert show(order="high", size=2, number=1) == ["c1", "c0"] and show(video="x") == [] and len(show(order="random")) == 5
    payload = rules.ranges(clips, ["dnsmos_bak"])
    doc = report.tuner_document(payload, rules.QUALITY_RULES, clips.withColumn("start_sec", F.lit(0.0)))
    assert doc["metrics"] == [{"metric": "dnsmos_bak", "low": 3.0, "high": 4.5, "known": 4}] and len(doc["clips"]) == 5 and len(doc["rules"]) == 9


def test_regrid_of_odd_frames_doesnt_drift(spark):
    df = spark.createDataFrame([("v", i, i * 10) for i in range(1000)], "video_id string, frame long, x int")
    got = {r["frame"]: r["x"] for r in ts.regrid(df, keys=["video_id"], value="x", frame_sec=0.032).collect()}
    assert got == {i: min(int(i * 0.01 / 0.032), 999) * 10 for i in range(3200)}


def test_links_lists_and_documents(spark, tmp_path):
    links = spark.createDataFrame([("u1", 0), ("bad", 1), ("u2", 2)], "url string, place int")

    def provider(url):
        if url == "bad":
            raise ValueError("gone")
        if url == "tab":
            return [{"id": "ccccccccccc"}, {"list": True, "url": "deep"}]
        return [{"id": "aaaaaaaaaaa", "duration": 5.0}, {"id": "short"}, *([{"list": True, "url": "tab"}] if url == "u2" else [])]

    got = jsonl.expand_links(links, provider)
    assert rows(got.select("url", "id")) == [("u1", "aaaaaaaaaaa"), ("u2", "aaaaaaaaaaa"), ("u2", "ccccccccccc")]
    assert rows(jsonl.discover(got).select("id", "url")) == [("aaaaaaaaaaa", "u1"), ("ccccccccccc", "u2")]
    assert jsonl.write_document(got.select("id"), str(tmp_path / "d.json")) == 3
    assert jsonl.read_document(spark, str(tmp_path / "d.json"), "id string").count() == 3


def test_index_ages_and_catalog(spark, tmp_path):
    for name in ("a.wav", "b.tmp.wav", ".c.wav", "d.part", "P/Q/T ｜ x [abcdefghijk].wav"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    assert media.list_files(spark, str(tmp_path)).count() == 2 and media.list_files(spark, str(tmp_path), least_age_sec=3600).count() == 0
    parts = media.parsed_name(F.col("path"))
    one = spark.createDataFrame([("P/Q/T ｜ x [abcdefghijk].wav",), ("NA/y.wav",)], "path string").select(*[c.alias(n) for n, c in parts.items()])
    assert [tuple(r) for r in one.collect()][0] == ("abcdefghijk", "T | x", "P/Q", "https://www.youtube.com/watch?v=abcdefghijk") and one.collect()[1]["playlist"] is None
    about = spark.createDataFrame([("abcdefghijk", "", "C", None, "u", "L")], "id string, title string, channel string, channel_id string, url string, playlist string")
    assert media.enriched(one, about).where("channel = 'C'").first().asDict() == {"id": "abcdefghijk", "title": "T | x", "playlist": "L", "url": "u", "channel": "C", "channel_id": None}


def test_vectors_come_from_archives(spark):
    raw = io.BytesIO()
    np.savez(raw, ids=np.array(["a", "b"]), embeddings=np.ones((2, 3), np.float16), window_similarity=np.array([0.5, 0.25], np.float32), local_speaker=np.array([0, 1]))
    got = lake.read_vectors(spark.createDataFrame([("f", bytearray(raw.getvalue()))], "path string, content binary"))
    assert rows(got.select("id", "local_speaker", "window_similarity", F.size("embedding"))) == [("a", 0, 0.5, 3), ("b", 1, 0.25, 3)]


def test_http_scorer_tries_again_and_cleans(spark):
    seen = []

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            seen.append(body["text"])
            self.send_response(503 if seen.count(body["text"]) < 2 or body["text"] == "never" else 200)
            self.end_headers()
            self.wfile.write(json.dumps({"text": f'Transcript: "{body["text"]} [Whispering] x [unknown]"'}).encode())

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    model = scorers.HttpScorer(f"http://127.0.0.1:{server.server_port}", pause=0.01, attempts=3)
    df = spark.createDataFrame([("a", "one"), ("b", "never")], "id string, text string")
    got = {r["id"]: r for r in scorers.apply(df.coalesce(1), model, attempts=1).collect()}
    server.shutdown()
    assert got["a"]["text_tagged"] == "one [whispering] x [/whispering]" and got["a"]["tags"] == ["whispering"] and got["a"]["text"] == "one x"
    assert got["b"]["text"] is None and "HTTPError" in got["b"]["error"] and seen.count("one") >= 2


def test_python_and_column_text_functions_agree(spark):
    texts = ["```json\nhello\n```", 'Transcript: "a  b"', "«x»", "النص: كلام [laughs] هنا", "plain", '"', ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.clean_llm_output(F.col("t")), T.strip_tags(F.col("t")))
    assert all((b, c) == (T.clean_answer(a), T.without_tags(a)) for a, b, c in df.collect())
    assert T.prompt_list(("laughs",), ("shouting",), ("sad",)) == "[sad], [laughs], [shouting] ... [/shouting]"
    assert T.word_tokens("Ab,c|", {"a": 1, "b": 2, "|": 9}) == [1, 2] and T.word_tokens("...", {}) == []


def test_long_texts_are_checked_for_loops_in_no_time(spark):
    text = " ".join(f"w{i}" for i in range(60_000)) + " a b a b a b a b a b a b"
    df = spark.createDataFrame([(text,), (text[:-4],), (None,), ("x x x x x x",), ("a x x x x x x",), ("p a b a b a b a b a b a b",)], "t string")
    assert [r[0] for r in df.select(T.has_repetition_loop(F.col("t"))).collect()] == [True, False, None, True, True, False]


def test_votes_means_and_choices(spark):
    df = spark.createDataFrame([(f"c{i}", "S", 1000 * i, 0.9 if i > 35 else 0.0) for i in range(40)], "id string, speaker_id string, ms long, p_female double")
    assert rows(assembly.gender_votes(df, samples=1)) in ([("S", "female", 0.8)], [("S", "male", 1.0)])
    x = spark.createDataFrame([("v", 1.0), ("v", -5.0), ("w", -5.0)], "id string, music_db double")
    assert rows(assembly.separation(x, threshold=0.0)) == [("v", True), ("w", False)]
    assert rows(stats.cluster_report(spark.createDataFrame([("f", 3_600_000), (None, 300_000)], "gender string, ms long")).select("gender", "speakers", "five_minutes", "one_hour")) == [("?", 1, 1, 0), ("all", 2, 2, 1), ("f", 1, 1, 1)]


def test_steps_run_once_and_in_slices(spark, small, tmp_path, capsys):
    assert steps.chosen("local", first="clip_names", last="hub_rows") == ["clip_names", "adjacent_similarity", "hub_rows"]
    for bad in ({"stage": "x"}, {"stage": "local", "first": "funnel"}, {"only": ["nothing"]}):
        with pytest.raises(KeyError):
            steps.chosen(**bad)
    assert steps.progress(5, 20, audio_sec=600.0, elapsed_sec=60.0) == "5/20 (25 %), 10.0x real time, 0:03:00 to go" and steps.progress(0, 0, audio_sec=0, elapsed_sec=0).startswith("0/0 (-)")
    steps.register("mine", lambda s, f: s.range(3))
    work = str(tmp_path / "w")
    assert steps.run(spark, small, work, ["mine", "sample_rates"]) == ["mine", "sample_rates"] and steps.run(spark, small, work, ["mine"]) == [] and steps.run(spark, small, work, ["mine"], force=True, limit=1) == ["mine"]
    assert spark.read.parquet(f"{work}/mine").count() == 1
    assert cli.main([small, work, "--steps", "mine,sample_rates", "--from", "sample_rates"]) == 0 and capsys.readouterr().out.strip() == ""
    report.export_figures({"f": spark.range(2).toDF("x")}, str(tmp_path / "figs"))
    assert json.loads((tmp_path / "figs" / "f.json").read_text()) == {"columns": ["x"], "rows": [{"x": 0}, {"x": 1}]}
