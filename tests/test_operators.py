import random

import numpy as np
import pytest
from helpers import rows
from pyspark.sql import functions as F

from clipweave.functions import text as T
from clipweave.operators import joins, rules, select, speakers, stats
from clipweave.operators import timeseries as ts
from clipweave.session import clear_cuts, cut, drop_cut


def greedy_cap(clips, cap):
    """The cap as a loop: best first within videos, larger videos first in each turn."""
    out = set()
    for spk in {c[1] for c in clips}:
        own = sorted((c for c in clips if c[1] == spk), key=lambda c: (-c[4], c[0]))
        queues = {}
        for c in own:
            queues.setdefault(c[2], []).append(c)
        order = sorted(queues.values(), key=lambda q: (-len(q), own.index(q[0])))
        total = 0
        while total < cap and any(order):
            for q in order:
                if q and total < cap:
                    c = q.pop(0)
                    out.add(c[0])
                    total += c[3]
    return out


def test_diverse_cap_equals_a_greedy_loop(spark):
    rng = random.Random(1)
    clips = [(f"c{i:03}", f"s{rng.randrange(4)}", f"v{rng.randrange(5)}", rng.randrange(1000, 9000), rng.randrange(6)) for i in range(160)]
    df = spark.createDataFrame(clips, "id string, speaker_id string, video_id string, ms long, score int")
    for cap in (1, 20_000, 60_000, 10**9):
        assert {r["id"] for r in select.diverse_cap(df, cap).collect()} == greedy_cap(clips, cap)


def test_diverse_cap_spreads_over_videos_and_takes_the_best(spark):
    clips = [(f"a{i:02}", "s", "v1", 10_000, 40) for i in range(50)] + [(f"b{i}", "s", "v2", 10_000, 30) for i in range(5)]
    kept = select.diverse_cap(spark.createDataFrame(clips, "id string, speaker_id string, video_id string, ms long, score int"), 100_000)
    assert kept.agg(F.sum("ms")).first()[0] == 100_000 and kept.select("video_id").distinct().count() == 2
    one = [(f"c{i}", "s", "v", 10_000, i) for i in range(10)]
    best = select.diverse_cap(spark.createDataFrame(one, "id string, speaker_id string, video_id string, ms long, score int"), 30_000)
    assert {r["id"] for r in best.collect()} == {"c9", "c8", "c7"}


def test_target_size_is_a_prefix_of_the_order(spark):
    clips = [(f"c{i:02}", 1000, i % 3) for i in range(30)]
    df = spark.createDataFrame(clips, "id string, ms long, score int")
    want = [c[0] for c in sorted(clips, key=lambda c: (-c[2], c[0]))[:12]]
    assert sorted(r["id"] for r in select.target_size(df, 11_500, step=1).collect()) == sorted(want)
    assert select.target_size(df.limit(0), 1000).count() == 0


def test_share_cap_stops_and_holds(spark):
    df = spark.createDataFrame([("a", 900_000_000), ("b", 50_000_000), ("c", 50_000_000)], "s string, ms long")
    cap = select.share_cap(df, 0.5)
    assert 0 < cap < 900_000_000 and select.share_cap(df, 1.0) == 1_000_000_000


def test_rules_pass_nulls_and_equality(spark):
    df = spark.createDataFrame([(3.6, 0.78, 10.0, False), (3.5, 0.7, 1.9, True), (None, None, 1.96, False), (9.9, 9.9, 30.06, None)], "dnsmos_bak double, window_similarity double, duration double, weak_cut boolean")
    got = [r[0] for r in df.select(rules.reasons(rules.QUALITY_RULES, 2.0, 30.0, drop_weak=True)).collect()]
    assert got == [[], ["duration", "background", "speaker_mix", "weak_cut"], [], ["duration"]]
    assert spark.createDataFrame([(None, -3.0), (None, None)], "edge_start_db double, edge_end_db double").select(rules.edge_db()).collect()[0][0] == -3.0


def test_stats_of_nothing_are_zero(spark):
    empty = spark.createDataFrame([], "speaker_id string, ms long, gender string")
    assert stats.speaker_stats(empty).first()["hours"] == 0 and stats.gini(empty, "ms").first()["gini"] == 0


@pytest.mark.parametrize("values", [[5], [0, 0], [1, 2, 3, 4], [2, 2, 2, 9, 9]])
def test_gini_equals_the_formula(spark, values):
    x = np.sort(np.array(values, float))
    n = len(x)
    want = 0.0 if x.sum() == 0 else float((2 * np.arange(1, n + 1) - n - 1) @ x / (n * x.sum()))
    assert stats.gini(spark.createDataFrame([(v,) for v in values], "v long"), "v").first()["gini"] == pytest.approx(want, abs=1e-6)


def test_joins(spark):
    known = spark.createDataFrame([("a", 1), ("b", 2)], "id string, x int")
    new = spark.createDataFrame([("b", 9), ("c", 3)], "id string, x int")
    assert rows(joins.upsert(known, new, "id")) == [("a", 1), ("b", 9), ("c", 3)]
    assert [r["id"] for r in joins.pending(new, new, known, "id").collect()] == ["c"]
    assert len(joins.pending(new, new, known, "id", force=True, limit=1).collect()) == 1
    spans = spark.createDataFrame([("v", 0.0, 70.0), ("v", 65.0, 66.0), ("v", 70.0, 80.0)], "v string, s double, e double")
    got = joins.interval_overlaps(spans, spans, group="v", start="s", end="e", bucket=10.0)
    assert got.where("l_s < r_s").count() == 1 and got.count() == 5


def test_turns_stop_at_overlap_and_bridge_silence(spark):
    track = [(10, 0), (3, None), (10, 0), (5, -1), (10, 1)]
    frames, f = [], 0
    for n, who in track:
        for _ in range(n):
            frames += [("v", f, s) for s in ((0, 1) if who == -1 else (who,))]
            f += 1
    df = spark.createDataFrame(frames, "video_id string, frame long, speaker int")
    got = [(r["speaker"], r["start"], r["stop"]) for r in ts.single_speaker_turns(df, max_gap=3, pad=2, least=5).orderBy("start").collect()]
    assert got == [(0, 0, 23), (1, 28, 38)]


def test_windows_cover_everything(spark):
    df = spark.createDataFrame([("a", 10.0), ("b", 3.0), ("c", 2.0), ("d", 0.0)], "id string, duration double")
    got = {}
    for r in ts.sliding_windows(df, key="id", duration="duration").collect():
        got.setdefault(r["id"], []).append((r["start"], r["end"]))
    assert sorted(got["a"])[-1][1] == 10.0 and got["b"] == [(0.0, 3.0)] and got["c"] == [(0.0, 2.0)] and "d" not in got
    w = ts.window_cover(df, key="id", duration="duration", window=4.0, overlap=1.0).where("id = 'a'").orderBy("n").collect()
    assert w[0]["start"] == 0 and w[-1]["end"] == 10.0 and all(b["start"] < a["end"] for a, b in zip(w, w[1:]))


def test_text_functions(spark):
    texts = ["[laughs] أنا رايح الـ meeting", "hello hello hello hello hello hello", "", "أَكَلَ  التفاحةَ", "a b a b a b a b a b a b", "x y z"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    got = df.select(T.strip_tags(t), T.is_code_switched(t), T.has_repetition_loop(t), T.normalize_for_compare(t)).collect()
    assert [r[0] for r in got][:2] == ["أنا رايح الـ meeting", texts[1]]
    assert [r[1] for r in got] == [True, False, False, False, False, False]
    assert [r[2] for r in got] == [False, True, False, False, True, False]
    assert got[3][3] == "اكل التفاحه"
    cleaned = df.limit(1).select(T.tag_cleaner()(F.lit("[Clears Throat] a [whispering] b [unknown] [/shouting] c")).alias("c")).first()["c"]
    assert cleaned["text"] == "[clears_throat] a [whispering] b c [/whispering]" and cleaned["tags"] == ["clears_throat", "whispering"]
    cers = spark.createDataFrame([("abc", "abd"), ("", ""), ("", "x")], "a string, b string").select(F.round(T.cer(F.col("a"), F.col("b")), 3)).collect()
    assert [r[0] for r in cers] == [0.333, 0.0, 1.0]
    out = spark.createDataFrame([('```\ntranscript: "hi  there"\n```',)], "t string").select(T.clean_llm_output(F.col("t"))).first()[0]
    assert out == "hi there"
    name = spark.createDataFrame([("ع" * 100 + "/x",)], "t string").select(T.safe_name(F.col("t"))).first()[0]
    assert name == "ع" * 60


def test_three_people_make_three_speakers(spark):
    rng = np.random.default_rng(0)
    unit = lambda v: v / np.linalg.norm(v)
    people = [unit(rng.normal(size=192)) for _ in range(3)]
    data = [(f"v{i}", unit(people[i % 3] + 0.35 * unit(rng.normal(size=192))).tolist(), 300.0 if i < 24 else 5.0, i % 3) for i in range(25)]
    df = spark.createDataFrame(data, "video_id string, print array<double>, seconds double, truth int")
    got = speakers.speakers_across(df).toPandas()
    assert got["speaker"].nunique() == 3 and (got.groupby("truth")["speaker"].nunique() == 1).all()


def test_voice_prints_ignore_broken_vectors(spark):
    v = [0.0] * 191 + [1.0]
    df = spark.createDataFrame([("v", 0, 2.0, v), ("v", 0, 2.0, v), ("v", 0, 1.0, [float("nan")] * 192), ("v", 0, 1.0, None), ("v", 1, 1.0, v[:50])], "video_id string, local_speaker int, duration double, speaker_embedding array<float>")
    got = speakers.voice_prints(df).collect()
    assert len(got) == 1 and got[0]["seconds"] == 4.0 and got[0]["members"] == 2 and got[0]["print"][-1] == pytest.approx(1, abs=1e-6)


def test_cut_reads_back_and_can_be_dropped(spark):
    df = cut(spark.range(5), "test")
    assert df.count() == 5 and df.inputFiles()
    drop_cut(df)
    with pytest.raises(Exception):
        df.count()
    kept = cut(spark.range(3), "test")
    clear_cuts(spark)
    with pytest.raises(Exception):
        kept.count()


def test_cer_of_whole_texts_equals_brute_force(spark, tmp_path):
    from clipweave.plans import speech

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    pairs = [("السلام عليكم", "الكتاب قديم"), ("أنا رايح الـ meeting", "[happy] أنا رايح الـ meeting"), ("قهوة 😀", "قهوه 😀"), ("", "نص"), ("", ""), ("abc", "abd"), (None, "x"), ("x", None)]
    spark.createDataFrame([(str(i), a, b) for i, (a, b) in enumerate(pairs)], "id string, text string, text_tagged string").selectExpr("*", "true AS ok", "array('') AS flags", "array('') AS tags", "'' AS backend", "1D AS chars_per_sec", "1D AS arabic_ratio").write.parquet(str(tmp_path / "transcripts.parquet"))
    got = {r["id"]: r["cer"] for r in speech.QUERIES["cer_pairs_whole"](spark, str(tmp_path)).collect()}
    want = {str(i): round(edits(a, b) / len(a), 6) if a else float(bool(b)) for i, (a, b) in enumerate(pairs) if a is not None and b is not None}
    assert got == want and got["0"] == 0.5


@pytest.mark.parametrize("block", [7, 16_384])
def test_speakers_of_all_channels_equal_linkage_of_the_whole_table(spark, monkeypatch, block):
    monkeypatch.setattr(speakers, "BLOCK", block)
    rng = np.random.default_rng(3)
    unit = lambda v: v / np.linalg.norm(v)
    people = [unit(rng.normal(size=24)) for _ in range(6)]
    prints = [unit(people[i % 6] + 0.8 * unit(rng.normal(size=24))) for i in range(60)]
    seconds = [float(rng.integers(31, 300)) if i % 5 else 5.0 + i / 100 for i in range(60)]
    df = spark.createDataFrame([(i, p.tolist(), s, f"channel {i % 4}") for i, (p, s) in enumerate(zip(prints, seconds))], "video_id long, print array<double>, seconds double, channel string")
    got = {r["video_id"]: r["speaker"] for r in speakers.speakers_across(df).collect()}
    want = speakers.assign_prints(np.array(prints), np.array(seconds))
    assert len(set(zip(got.values(), (want[i] for i in got)))) == len(set(got.values())) == len(set(want.tolist()))


def test_linkage_by_sums_equals_linkage_by_pairs():
    rng = np.random.default_rng(4)
    for n in (1, 2, 40, 120):
        x = rng.normal(size=(n, 6))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        a, b = speakers.linked_groups(x, 0.5), speakers.average_linkage(x, 0.5)
        assert len(set(zip(a.tolist(), b.tolist()))) == len(set(a.tolist())) == len(set(b.tolist()))
