from itertools import combinations

import numpy as np
import pytest

from clipweave.functions import kernels as K


def timeline(parts):
    """diar, vad and db at 10 ms from (seconds, "s0" | "s1" | "pause" | "overlap")."""
    diar, vad, db = [], [], []
    for seconds, kind in parts:
        n = round(seconds * 100)
        p = {"s0": (0.95, 0.0), "s1": (0.0, 0.95), "pause": (0.0, 0.0), "overlap": (0.9, 0.9)}[kind]
        diar += [p] * n
        vad += [0.0 if kind == "pause" else 0.95] * n
        db += [-60.0 if kind == "pause" else -18.0 if kind == "overlap" else -20.0] * n
    return np.array(diar), np.array(vad), np.array(db)


def clips_of(parts, speaker=0, s=K.CutSettings(), **more):
    diar, vad, db = timeline(parts)
    speech, pause = vad > 0.5, vad < 0.35
    regions = K.own_regions(diar, speech, speaker, guard=30, most_silence=150, pad=15)
    return [c for r in regions for c in K.plan_clips(speech, pause, vad, db, r, s, **more)]


def test_a_short_turn_is_one_clip_with_padding():
    (c,) = clips_of([(1, "pause"), (8, "s0"), (1, "pause")])
    assert 0.8 <= c.start <= 1.0 and 9.0 <= c.end <= 9.2 and not c.weak and (c.start_cut, c.end_cut) == ("turn", "turn")


def test_a_monologue_is_cut_in_its_pauses():
    parts = [(1, "pause")] + [p for _ in range(8) for p in ((9, "s0"), (0.5, "pause"))]
    got = clips_of(parts)
    assert len(got) >= 3 and all(5 <= c.end - c.start <= 30 for c in got) and sum(c.end - c.start for c in got) > 60


def test_no_clip_touches_another_voice_or_overlap():
    got = clips_of([(1, "pause"), (7, "s0"), (0.4, "pause"), (3, "s0"), (2, "overlap"), (3, "s0"), (0.4, "pause"), (7, "s0"), (0.5, "pause"), (6, "s1"), (0.5, "pause"), (7, "s0"), (1, "pause")])
    assert len(got) == 3
    for c in got:
        assert not (c.start < 13.7 and c.end > 11.1) and not (c.start < 30.6 and c.end > 24.0)


def test_an_edge_in_speech_is_no_place_to_cut():
    assert clips_of([(10, "s0"), (2, "overlap"), (10, "s0")]) == []
    (c,) = clips_of([(1, "pause"), (9, "s0"), (0.5, "pause"), (9, "s0"), (2, "overlap")])
    assert c.end < 10.6 and c.end_cut == "pause" and c.end_pause == 0.5 and c.speech_ratio > 0.9 and c.max_internal_silence == 0


def test_long_silence_splits_and_short_turns_drop():
    assert len(clips_of([(1, "pause"), (6, "s0"), (3, "pause"), (6, "s0"), (1, "pause")])) == 2
    assert clips_of([(1, "pause"), (3, "s0"), (1, "pause")]) == []


def brute_regions(diar, speech, k, guard, most, pad):
    """Regions frame by frame, from the rule."""
    n, out = len(speech), []
    others = [any(diar[f, j] > 0.2 for j in range(diar.shape[1]) if j != k) for f in range(n)]
    nobody = [not (diar[f] > 0.2).any() for f in range(n)]
    bad = [others[f] or (speech[f] and nobody[f]) for f in range(n)]
    free = [not any(bad[max(0, f - guard) : f + guard + 1]) and ((diar[f, k] > 0.2 and not others[f]) or (nobody[f] and not speech[f])) for f in range(n)]
    said = [f for f in range(n) if free[f] and speech[f] and diar[f, k] > 0.5]
    for i, f in enumerate(said):
        parted = i == 0 or f - said[i - 1] > most or not all(free[said[i - 1] : f])
        out = [*out, [f, f + 1]] if parted else [*out[:-1], [out[-1][0], f + 1]]
    for r in out:
        for _ in range(2 * pad):
            r[0] -= r[0] > 0 and free[r[0] - 1]
            r[1] += r[1] < n and free[r[1]]
    return [tuple(map(int, r)) for r in out]


def test_regions_equal_the_rule():
    rng = np.random.default_rng(0)
    for _ in range(60):
        at = np.repeat(rng.integers(0, 4, 30), rng.integers(1, 12, 30))
        diar = np.stack([np.where(at == k, rng.choice([0.95, 0.3], len(at), p=[0.8, 0.2]), 0.0) for k in (0, 1)], axis=1)
        speech = (at < 2) | ((at == 2) & (rng.random(len(at)) < 0.05))
        for k in (0, 1):
            assert K.own_regions(diar, speech, k, guard=2, most_silence=6, pad=2) == brute_regions(diar, speech, k, 2, 6, 2)


def test_dips_are_weak_cuts():
    diar, vad, db = timeline([(1, "pause"), (58, "s0"), (1, "pause")])
    for at in range(1000, 5800, 900):
        db[at - 5 : at + 5] = -35
        vad[at - 5 : at + 5] = 0.6
    speech, pause = vad > 0.5, vad < 0.35
    region = K.own_regions(diar, speech, 0, guard=30, most_silence=150, pad=15)[0]
    assert K.plan_clips(speech, pause, vad, db, region, K.CutSettings()) == []
    got = K.plan_clips(speech, pause, vad, db, region, K.CutSettings(), allow_dips=True)
    assert len(got) >= 2 and any(c.weak for c in got)


def brute_plan(nodes, s):
    """The greatest worth of any set of pieces."""
    n, best = len(nodes), [0.0] * len(nodes)
    for j in range(1, n):
        best[j] = best[j - 1]
        for i in range(j):
            d = nodes[j] - nodes[i]
            if s.shortest <= d <= s.longest + 2 * s.pad:
                best[j] = max(best[j], best[i] + d - s.off_target * ((d - s.target) / s.target) ** 2)
    return best[-1]


def test_the_cut_plan_is_best():
    rng, s = np.random.default_rng(0), K.CutSettings()
    for _ in range(20):
        nodes = np.sort(rng.uniform(0, 90, 14))
        plan = K.cut_plan(nodes, np.zeros(14), s)
        worth = sum(nodes[j] - nodes[i] - s.off_target * ((nodes[j] - nodes[i] - s.target) / s.target) ** 2 for i, j in plan)
        assert worth == pytest.approx(brute_plan(nodes, s)) and all(a[1] <= b[0] for a, b in zip(plan, plan[1:]))


def test_stitching_undoes_permuted_columns():
    rng = np.random.default_rng(0)
    truth = np.repeat(np.arange(60) % 4, 50)  # all four speak in every overlap
    p = np.full((3000, 4), 0.02)
    p[np.arange(3000), truth] = 0.95
    windows = [p[a : a + 1000][:, rng.permutation(4) if a else np.arange(4)] for a in range(0, 2400, 800)]
    assert (K.stitch(windows, 800, 200).argmax(1) == truth[:2600]).all()


def test_quiet_split():
    db = np.full(5000, -20.0)
    db[2600:2630] = -60
    (at,) = K.quiet_splits(db, step=0.01, longest=30)
    assert 2590 <= at <= 2640 and K.quiet_splits(db[:2000], step=0.01, longest=30) == []


def test_ctc_path():
    lp = np.log(np.full((6, 3), 0.05))
    for f, t in enumerate([0, 1, 1, 0, 2, 0]):
        lp[f, t] = np.log(0.9)
    frames, scores = K.ctc_path(lp, [1, 1, 2])
    assert frames == [1, 2, 4] and np.allclose(scores, np.log(0.9)) and K.ctc_path(lp, [1] * 7) is None and K.ctc_path(lp, []) is None
    spans, score = K.word_spans((frames, scores), [0, -1, 2], 3, 0.1)
    assert spans == [(0.1, 0.2), None, (0.4, 0.5)] and score == round(float(np.log(0.9)), 4) and K.word_spans(([], []), [], 2, 0.1) == ([None, None], -99.0)


def test_ctc_path_is_the_best():
    rng = np.random.default_rng(1)
    for _ in range(30):
        lp = np.log(rng.dirichlet(np.ones(4), 7))
        tokens = rng.integers(1, 4, 3).tolist()
        frames, scores = K.ctc_path(lp, tokens)
        total = lambda at: sum(lp[f, t] for f, t in zip(at, tokens)) + sum(lp[f, 0] for f in range(7) if f not in at)
        assert total(tuple(frames)) == pytest.approx(max(map(total, combinations(range(7), 3))))


def test_levels_and_fades():
    t = np.arange(24000) / 24000
    tone = 0.3 * np.sin(2 * np.pi * 220 * t)
    quiet = np.concatenate([np.zeros(3600), tone, np.zeros(3600)])
    edges = K.edge_levels(K.frame_db(quiet, 768))
    assert max(edges) < -40 and min(K.edge_levels(K.frame_db(tone, 768))) > -3 and K.edge_levels(np.zeros(5)) == (0.0, 0.0)
    f = K.faded(tone, 100)
    assert f[0] == 0 and abs(f[-1]) < 1e-9 and (f[100:-100] == tone[100:-100]).all()
    assert K.clip_share(np.array([1.0, 0.5])) == 0.5


def test_loudness_of_a_full_scale_tone():
    rate = 48000
    tone = np.sin(2 * np.pi * 997 * np.arange(rate * 4) / rate)
    assert K.loudness(tone, rate) == pytest.approx(-3.01, abs=0.05)
    assert K.loudness(K.normalized_loudness(tone * 0.1, rate), rate) == pytest.approx(-20, abs=0.05)
    assert K.loudness(np.zeros(rate), rate) == float("-inf") and np.abs(K.normalized_loudness(tone * 1e-3, rate, 0.0)).max() <= 10 ** (-1 / 20) + 1e-9


def test_music_level_and_resampling():
    rng = np.random.default_rng(0)
    vocal, music = rng.normal(size=8000), rng.normal(size=8000)
    assert K.music_db(vocal + 0.1 * music, vocal) == pytest.approx(-20, abs=0.5) and K.music_db(vocal, vocal * 0) == 0.0 and K.music_db(vocal * 0, vocal * 0) == -100.0
    t = np.arange(24000) / 24000
    tone = np.sin(2 * np.pi * 440 * t)
    out = K.resampled(tone, 24000, 16000)
    assert len(out) == 16000 and np.abs(out - np.sin(2 * np.pi * 440 * np.arange(16000) / 16000))[200:-200].max() < 0.01


def test_score_windows():
    assert K.score_windows(20_000, 1000) == [(i * 1000, i * 1000 + 9010) for i in range(11)]
    assert K.score_windows(3000, 1000)[0] == (0, 9010)
