"""Cap, ranking and splits against brute force, and their edge cases."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import rows

from clipweave.llm import cap, rank, splits


def brute_cap(records, limit):
    """Which records are dropped, by sorting every contributor."""
    out, total = set(), defaultdict(int)
    for k, c, s, w in sorted((r for r in records if r[1] is not None), key=lambda r: (r[1], -(r[2] or 0), r[0])):
        if total[c] >= limit:
            out.add(k)
        total[c] += max(w or 0, 0)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_cap_equals_sorting(spark, seed, monkeypatch):
    monkeypatch.setattr(cap, "TIE_BLOCK", 3)
    rng = random.Random(seed)
    spread = (3, 400, 10**9)[seed]
    records = [(f"id{rng.randrange(10**6):06}{i}", rng.choice(["a", "a", "a", "b", "c", None]), rng.randrange(-spread, spread), rng.randrange(0, 50)) for i in range(300)]
    df = spark.createDataFrame(records, "id string, contributor string, score long, weight long")
    for limit in (1, 700, 10**7):
        got = cap.cap_contributors(df, limit)
        assert got.count() == len(records)
        assert {r["id"] for r in got.where("NOT kept").collect()} == brute_cap(records, limit)


def test_ties_of_numeric_keys_are_in_order_of_the_numbers(spark, monkeypatch):
    monkeypatch.setattr(cap, "TIE_BLOCK", 3)
    records = [(i, "a", 5, 10) for i in [*range(-30, 120), 10**15, -(1 << 63), (1 << 63) - 1]]
    df = spark.createDataFrame(records, "id long, contributor string, score long, weight long")
    for limit in (10, 315, 400, 1200, 10**6):
        assert {r["id"] for r in cap.cap_contributors(df, limit).where("NOT kept").collect()} == brute_cap(records, limit)


def test_cap_takes_odd_input(spark):
    schema = "id string, contributor string, score long, weight long, kept string, c int, k int, s int"
    records = [("a", "x", None, None, "clash", 1, 1, 1), ("b", "x", 5, 10, "clash", 1, 1, 1), ("c", "x", 5, 10, "", 1, 1, 1), ("d", None, 1, 99, "", 1, 1, 1), ("e", "x", 4, -3, "", 1, 1, 1)]
    got = cap.cap_contributors(spark.createDataFrame(records, schema), 10)
    assert rows(got.select("id", "kept")) == [("a", False), ("b", True), ("c", False), ("d", True), ("e", False)]
    assert cap.cap_contributors(spark.createDataFrame([], schema), 10).count() == 0


def walk(values, damping, rounds=400):
    """The walk by its dense matrix."""
    n, m = values.shape
    p = np.zeros((n, n))
    for s in range(m):
        for i in range(n):
            up = values[:, s] > values[i, s]
            p[i] += up / up.sum() / m if up.any() else 1 / n / m
    pi = np.full(n, 1 / n)
    for _ in range(rounds):
        pi = (1 - damping) / n + damping * pi @ p
    return pi


@pytest.mark.parametrize("damping", [0.15, 0.85])
def test_rank_walk_equals_the_dense_chain(spark, damping, monkeypatch):
    monkeypatch.setattr(rank, "PREFIX_BLOCK", 7)
    rng = np.random.default_rng(1)
    v = np.column_stack([rng.integers(0, 12, 60) / 10, rng.normal(size=60), rng.integers(0, 3, 60) * 1e6])
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(v)], "id long, a double, b double, c double")
    got = {r["id"]: r["stationarity"] for r in rank.rank_walk(df, ["a", "b", "c"], damping=damping, tolerance=1e-11).collect()}
    assert np.allclose([got[i] for i in range(60)], walk(v, damping), atol=1e-7)


def test_one_extreme_score_doesnt_lead(spark):
    rng = np.random.default_rng(0)
    v = rng.normal(size=(400, 4))
    v[7] = [1e12, -0.1, -0.1, -0.1]
    v[8] = [1.8, 1.8, 1.8, 1.8]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(v)], "id long, a double, b double, c double, d double")
    best = [r["id"] for r in rank.head(rank.rank_walk(df, ["a", "b", "c", "d"]), 0.01).collect()]
    assert best[0] == 8 and 7 not in best


def test_rank_of_ties_and_nothing(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 1.0)], "id string, x double")
    got = rank.rank_walk(df, ["x"])
    assert {round(r["stationarity"], 9) for r in got.collect()} == {round(1 / 3, 9)}
    assert [r["id"] for r in rank.head(got, 0.34).collect()] == ["a"]
    assert rank.rank_walk(df.limit(0), ["x"]).count() == 0


def components(edges):
    """Component of every vertex, by a plain search."""
    near, out = defaultdict(set), {}
    for u, v in edges:
        near[u].add(v)
        near[v].add(u)
    for v in near:
        if v not in out:
            todo, out[v] = [v], v
            while todo:
                for x in near[todo.pop()]:
                    if x not in out:
                        out[x] = v
                        todo.append(x)
    return out


@pytest.mark.parametrize("shape", ["random", "path", "star", "none"])
def test_spanning_forest(spark, shape):
    rng = random.Random(2)
    edges = {
        "random": [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] * 2,
        "path": [(i, i + 1) for i in range(70)],
        "star": [(0, i) for i in range(1, 60)],
        "none": [],
    }[shape]
    forest, roots = splits.spanning_forest(spark.createDataFrame(edges, "u long, v long"))
    want = components(edges)
    got = {r["vertex"]: r["root"] for r in roots.collect()}
    assert set(got) == set(want)
    pairs = {(got[v], want[v]) for v in want}
    assert len(pairs) == len(set(got.values())) == len(set(want.values()))
    tree = rows(forest)
    assert len(tree) == len(got) - len(set(got.values())) and len(components(tree)) == len([v for v in got if sum(g == got[v] for g in got.values()) > 1])


def test_splits_keep_sharers_together_and_hold_proportions(spark):
    rng = random.Random(3)
    data = [(f"r{i}", rng.choice([None, f"s{min(rng.randrange(300), rng.randrange(300))}"]), f"v{i // 3}", rng.choice(["m", "f", None])) for i in range(4000)]
    df = spark.createDataFrame(data, "id string, speaker_id string, video string, gender string")
    got = {r["id"]: r for r in splits.deal_splits(df, {"train": 0.8, "validation": 0.1, "test": 0.1}).collect()}
    assert set(got) == {d[0] for d in data}
    by = defaultdict(set)
    for i, s, *_ in data:
        by[s].add(got[i]["split"])
    assert all(len(v) == 1 for s, v in by.items() if s)
    share = Counter(r["split"] for r in got.values())
    for of in (lambda d: True, lambda d: d[3] == "m", lambda d: d[3] == "f", lambda d: d[3] is None):
        share = Counter(got[d[0]]["split"] for d in data if of(d))
        assert all(abs(share[s] / share.total() - p) < 0.01 for s, p in {"train": 0.8, "validation": 0.1, "test": 0.1}.items())
    again = {r["id"]: r["split"] for r in splits.deal_splits(df, {"train": 0.8, "validation": 0.1, "test": 0.1}).collect()}
    assert again == {i: r["split"] for i, r in got.items()}


def test_many_small_roots_are_dealt_by_sums(spark, monkeypatch):
    monkeypatch.setattr(splits, "LARGE", 1 / 50)
    monkeypatch.setattr(splits, "HAND", 100)
    rng = random.Random(4)
    data = [(f"r{i}", rng.choice([None, "big", f"s{rng.randrange(600)}", f"s{rng.randrange(600)}", f"s{rng.randrange(600)}"]), rng.choice("mf")) for i in range(4000)]
    df = spark.createDataFrame(data, "id string, speaker_id string, gender string")
    got = {r["id"]: r["split"] for r in splits.deal_splits(df, {"a": 2, "b": 1, "c": 1}).collect()}
    share = Counter(got.values())
    assert set(got) == {d[0] for d in data} and len({got[i] for i, s, _ in data if s == "big"}) == 1
    assert abs(share["a"] / 4000 - 0.5) < 0.03 and abs(share["b"] / 4000 - 0.25) < 0.03


def test_splits_follow_chains_of_two_keys(spark):
    df = spark.createDataFrame([("a", "s1", "v1"), ("b", "s2", "v1"), ("c", "s2", "v2"), ("d", None, None)], "id string, speaker_id string, video string")
    got = {r["id"]: r["root"] for r in splits.deal_splits(df, {"x": 1, "y": 1}, shared=("speaker_id", "video"), stratum=None).collect()}
    assert got["a"] == got["b"] == got["c"] != got["d"]
    assert splits.deal_splits(df.limit(0), {"x": 1}, stratum=None).count() == 0


def test_leaking_values(spark):
    df = spark.createDataFrame([("a", "s"), ("b", "s"), ("c", "t"), ("d", None), ("e", "u")], "id string, speaker_id string")
    split = spark.createDataFrame([("a", "train"), ("a", "train"), ("b", "test"), ("c", "train"), ("d", "test"), ("zz", "test"), ("e", None)], "id string, split string")
    assert rows(splits.leaking_values(df, split)) == [("s",)]
    assert splits.leaking_values(df.limit(0), split).count() == 0
