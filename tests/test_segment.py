import numpy as np
from helpers import rows
from pyspark.sql import functions as F
from test_kernels import timeline

from clipweave import cli, report
from clipweave.functions import kernels as K
from clipweave.functions import text as T
from clipweave.operators import rules, segment
from clipweave.sources import audio


def test_planned_clips_of_every_voice(spark):
    diar, vad, db = timeline([(1, "pause"), (8, "s0"), (1, "pause"), (9, "s1"), (1, "pause")])
    data = [("v", i, [float(x) for x in p], float(a), float(b)) for i, (p, a, b) in enumerate(zip(diar, vad, db))]
    df = spark.createDataFrame(data, "video_id string, frame int, probs array<double>, vad double, db double").repartition(3)
    got = rows(segment.planned_clips(df))
    assert [(g[1], g[4], g[5], g[-1]) for g in got] == [(0, "turn", "turn", False), (1, "turn", "turn", False)] and all(7.9 < g[3] - g[2] < 9.5 for g in got)


def test_long_turns_are_split_where_quiet(spark):
    db = np.full(6000, -20.0)
    db[2950:2980] = -60
    levels = spark.createDataFrame([("v", i, float(x)) for i, x in enumerate(db)], "video_id string, frame long, db double")
    turns = spark.createDataFrame([("v", 0, 0, 5900), ("v", 1, 5900, 6000)], "video_id string, speaker int, start long, stop long")
    got = rows(segment.split_turns(turns, levels, step=0.01))
    assert len(got) == 3 and 2940 <= got[0][3] <= 2990 and got[-1][1:] == (1, 5900, 6000)


def test_stitched_windows(spark):
    p = np.full((300, 2), 0.05)
    p[np.arange(300), np.arange(300) // 10 % 2] = 0.95
    windows = [("v", k, p[k * 80 : k * 80 + 100][:, ::-1 if k % 2 else 1].tolist()) for k in range(3)]
    got = segment.stitched(spark.createDataFrame(windows, "video_id string, window int, probs array<array<double>>"), step=80, overlap=20).orderBy("frame").toPandas()
    assert (np.stack(got["probs"]).argmax(1) == p[:260].argmax(1)).all()


def test_alignment_gate(spark):
    w = "array<struct<word:string,start:double,end:double>>"
    data = [("a", [("x", 0.1, 0.5), ("y", None, None), ("z", 0.6, 0.9)], -1.0, 0.95, 1.0), ("b", [("x", 0.0, 0.5)], -1.0, 1.0, 1.0), ("c", [("x", None, None)], -99.0, 0.0, 1.0), ("d", [("x", 0.1, 0.9)], -5.0, 1.0, 1.0)]
    df = spark.createDataFrame(data, f"id string, words {w}, align_score double, timed_ratio double, duration double")
    assert rows(segment.alignment_gate(df).select("id", "edge_ok", "align_ok")) == [("a", True, True), ("b", False, False), ("c", False, False), ("d", True, False)]


def test_other_voice(spark):
    clips = spark.createDataFrame([("c", "v", 0, 0.0, 0.3), ("d", "v", 1, 0.9, 1.0)], "id string, video_id string, local_speaker int, start_sec double, end_sec double")
    frames = spark.createDataFrame([("v", i, s, 0.1 * i if s else 0.9) for i in range(5) for s in (0, 1)], "video_id string, frame long, speaker int, p double")
    assert rows(segment.other_voice(clips, frames, frame_sec=0.1)) == [("c", 0.2), ("d", 0.0)]


def test_validation_split(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("id"))
    got = segment.validation_split(df, 0.0157)
    assert got.where("split = 'validation'").count() == 15 and got.count() == 1000
    assert segment.validation_split(df.limit(0), 0.5).count() == 0


def test_clips_are_cut_from_files(spark):
    rate = 8000
    tone = 0.5 * np.sin(2 * np.pi * 300 * np.arange(rate * 4) / rate)
    files = spark.createDataFrame([("f", bytearray(audio.encode_wav(tone, rate))), ("g", bytearray(b"no"))], "path string, content binary")
    clips = spark.createDataFrame([("a", "f", 1.0, 3.0), ("b", "f", 3.5, 9.0), ("c", "g", 0.0, 1.0)], "id string, path string, start_sec double, end_sec double")
    got = {r["id"]: r for r in audio.cut_clips(files, clips).collect()}
    x, own = audio.decode_wav(bytes(got["a"]["audio"]))
    assert own == rate and len(x) == 2 * rate and abs(K.loudness(x, rate) + 20) < 0.3
    assert len(audio.decode_wav(bytes(got["b"]["audio"]))[0]) == rate // 2 and got["c"]["audio"] is None
    y, to = audio.decode_wav(audio.encode_wav(tone, rate), 1.0, 2.0, 4000)
    assert to == 4000 and len(y) == 4000


def test_widths_of_samples_and_ranges_of_files(spark, tmp_path):
    import wave

    x = np.array([0.5, -0.25, 0.0, -1.0])
    for width in (1, 2, 3, 4):
        whole = np.rint(x * (1 << (8 * width - 1))).astype(np.int64) + (128 if width == 1 else 0)
        raw = b"".join(int(v).to_bytes(width, "little", signed=width > 1) for v in whole)
        assert np.allclose(audio.pcm_samples(raw, width, 1), x) and np.allclose(audio.pcm_samples(raw, width, 2), [0.125, -0.5])
        with wave.open(str(tmp_path / f"{width}.wav"), "wb") as w:
            w.setnchannels(1), w.setsampwidth(width), w.setframerate(4), w.writeframes(raw)
        assert np.allclose(audio.decode_wav(str(tmp_path / f"{width}.wav"), 0.25, 0.75)[0], x[1:3])
    rate = 8000
    (tmp_path / "f.wav").write_bytes(audio.encode_wav(0.5 * np.sin(np.arange(rate * 4) / 4), rate))
    files = spark.createDataFrame([(str(tmp_path / "f.wav"),), (str(tmp_path / "none.wav"),)], "path string")
    clips = files.selectExpr("path", "path AS id", "1.0D AS start_sec", "2.0D AS end_sec")
    got = {r["id"]: r["audio"] for r in audio.cut_clips(files, clips).collect()}
    assert len(audio.decode_wav(bytes(got[str(tmp_path / "f.wav")]))[0]) == rate and got[str(tmp_path / "none.wav")] is None


def test_segment_lines_and_archive_lines(spark):
    df = spark.createDataFrame([(["1.5 2 b", "0 1 a", "x y z", "1 2"], "site abc"), ([], "a b c")], "lines array<string>, line string")
    got = df.select(T.parse_segments(F.col("lines")), T.archived_id(F.col("line"))).collect()
    assert [tuple(s) for s in got[0][0]] == [(0.0, 1.0, "a"), (1.5, 2.0, "b")] and got[0][1] == "abc" and got[1][0] == [] and got[1][1] is None


def test_reports_and_names(spark, capsys):
    df = spark.createDataFrame([("<a>", None)], "x string, y int")
    assert report.review_table(df) == "<table><tr><th>x</th><th>y</th></tr><tr><td>&lt;a&gt;</td><td></td></tr></table>"
    card = report.dataset_card("T", spark.createDataFrame([("train", 1000, 2.5, 3)], "split string, clips int, hours double, speakers int"))
    assert "| train | 1,000 | 2.50 | 3 |" in card
    assert "min_dnsmos_bak: 3.6" in report.thresholds_yaml(rules.QUALITY_RULES) and "max_edge_db: null" in report.thresholds_yaml(rules.QUALITY_RULES)
    assert cli.main([]) == 0 and "filter_kept:" in capsys.readouterr().out
