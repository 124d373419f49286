"""Neighbours and clusters against brute force, and their edge cases."""

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from clipweave.llm import clusters, neighbours, vectors

SCHEMA = "id string, speaker_embedding array<float>, speaker_id string, h int, cell int"
DIMS = 24


def voices(n_voices, per, seed=0, noise=0.45):
    rng = np.random.default_rng(seed)
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    centre = unit(rng.normal(size=(n_voices, DIMS)))
    truth = np.repeat(np.arange(n_voices), per)
    return unit(centre[truth] + noise * unit(rng.normal(size=(len(truth), DIMS)))), truth


def frame(spark, x, truth=None, extra=()):
    data = [(f"c{i:04}", [float(a) for a in v], None if truth is None else f"S{truth[i]}", 1, 1) for i, v in enumerate(x)]
    return spark.createDataFrame([*data, *extra], SCHEMA)


BROKEN = [("n1", None, None, 1, 1), ("n2", [0.0] * DIMS, None, 1, 1), ("n3", [float("nan")] * DIMS, None, 1, 1), ("n4", [1.0] * 5, None, 1, 1), ("n5", [None] * DIMS, None, 1, 1), (None, [1.0] * DIMS, None, 1, 1)]


def brute(x, least):
    s = x @ x.T
    return {(f"c{i:04}", f"c{j:04}") for i, j in zip(*np.nonzero(np.triu(s, 1) >= least))}


def test_usable_rows():
    col = pa.array([[3.0, 4.0], None, [0.0, 0.0], [float("nan"), 1.0], [1.0], [1e30, 0.0], [float("inf"), 1.0], [1e-30, 0.0]], pa.list_(pa.float32()))
    at, x = vectors.unit_rows(col, 2)
    assert at.tolist() == [0, 5, 7] and np.allclose(x, [[0.6, 0.8], [1, 0], [1, 0]])
    assert np.allclose(vectors.unpack(vectors.pack(x), 2), x, atol=1e-4)
    at, x = vectors.unit_rows(col.slice(3, 3), 2)
    assert at.tolist() == [2]


@pytest.mark.parametrize("rooms", [{}, {"room_rows": 120}, {"room_rows": 60, "most_room": 120, "fan": 3}])
def test_near_pairs_are_all_found(spark, rooms):
    x, _ = voices(12, 50)
    rng = np.random.default_rng(1)
    near = x[:60] + 0.1 * rng.normal(size=(60, DIMS)) / np.sqrt(DIMS)
    x = np.concatenate([x, near / np.linalg.norm(near, axis=1, keepdims=True)])
    x *= rng.uniform(0.1, 9, size=(len(x), 1))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    got = neighbours.nearest_vectors(frame(spark, x, extra=BROKEN), k=5, least=0.95, dims=DIMS, rows_per_cell=80, **rooms)
    pairs = {tuple(sorted((r["id"], r["neighbour"]))) for r in got.collect()}
    want = brute(u, 0.95)
    assert len(want) >= 60 and pairs <= brute(u, 0.9499) and len(want - pairs) <= 0.02 * len(want)


def test_recall_of_lists(spark):
    x, _ = voices(10, 80, seed=3)
    got = defaultdict(set)
    for r in neighbours.nearest_vectors(frame(spark, x), k=5, dims=DIMS, rows_per_cell=60).collect():
        got[r["id"]].add(int(r["neighbour"][1:]))
    s = x @ x.T
    np.fill_diagonal(s, -2)
    top = np.argsort(-s, axis=1)[:, :5]
    assert np.mean([len(got[f"c{i:04}"] & set(top[i].tolist())) / 5 for i in range(len(x))]) >= 0.9


def test_copies_list_each_other_without_pairs(spark):
    x, _ = voices(6, 30, seed=4)
    x[:60] = x[0]
    got = defaultdict(list)
    for r in neighbours.nearest_vectors(frame(spark, x, extra=[("c0000", [float(a) for a in x[0]], None, 1, 1)]), k=3, dims=DIMS).orderBy("id", "rank").collect():
        got[r["id"]].append((r["neighbour"], round(r["similarity"], 3)))
    assert got["c0000"] == [("c0001", 1.0), ("c0002", 1.0), ("c0003", 1.0)] and got["c0059"] == [("c0000", 1.0), ("c0001", 1.0), ("c0002", 1.0)]


def test_neighbours_of_nothing(spark):
    assert neighbours.nearest_vectors(spark.createDataFrame(BROKEN, SCHEMA), dims=DIMS).count() == 0
    assert neighbours.nearest_vectors(spark.createDataFrame([("a", [1.0] * DIMS, None, 1, 1)], SCHEMA), dims=DIMS).count() == 0


@pytest.mark.parametrize("assigned", [10**6, 40])
def test_clusters_are_the_voices(spark, assigned):
    x, truth = voices(25, 40, seed=5)
    got = clusters.similarity_clusters(frame(spark, x, truth, BROKEN).repartition(5), keep=("speaker_id",), dims=DIMS, rows_per_branch=100, assigned=assigned).collect()
    assert len(got) == len(x)
    by = defaultdict(set)
    for r in got:
        by[r["speaker_id"]].add(r["cluster"])
    assert all(len(c) == 1 for c in by.values()) and len({c for s in by.values() for c in s}) == 25
    assert min(r["closeness"] for r in got) > 0.7


def test_trees_merge(spark, monkeypatch):
    monkeypatch.setattr(clusters, "FAN_IN", 2)
    x, truth = voices(8, 30, seed=6)
    got = clusters.similarity_clusters(frame(spark, x, truth).repartition(7), keep=("speaker_id",), dims=DIMS, rows_per_branch=60)
    assert got.select("cluster").distinct().count() == 8


def test_names_and_typical_members(spark):
    data = [("a", 1, "X", 0.9), ("b", 1, "X", 0.95), ("c", 1, None, 0.95), ("d", 1, "Y", 0.1), ("e", 2, "X", 0.5), ("f", 2, "Y", 0.5), ("g", 3, None, 0.5)]
    members = spark.createDataFrame(data, "id string, cluster long, speaker_id string, closeness float")
    assert {r["cluster"]: r["name"] for r in clusters.cluster_names(members, "speaker_id").collect()} == {1: "X"}
    got = {r["cluster"]: (r["size"], r["typical"]) for r in clusters.describe_clusters(members, typical=2).collect()}
    assert got == {1: (4, ["b", "c"]), 2: (2, ["e", "f"]), 3: (1, ["g"])}
    assert clusters.similarity_clusters(spark.createDataFrame(BROKEN[:5], SCHEMA), dims=DIMS).count() == 0


def test_ward_merges_the_cheapest_first():
    x = np.array([[1, 0], [0.99, 0.14], [0, 1], [0.1, 0.99]], np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    group = clusters.ward_groups(x, np.ones(4), 0.6)
    assert group[0] == group[1] != group[2] == group[3]
    assert len(set(clusters.ward_groups(x, np.ones(4), -1.0).tolist())) == 1


def test_feature_tree_keeps_counts():
    x, truth = voices(5, 20, seed=7)
    tree = clusters.FeatureTree(0.6)
    for i in range(0, 100, 7):
        tree.insert(0, x[i : i + 7].astype(np.float32), np.ones(len(x[i : i + 7])))
    _, n, ls = tree.drain()
    assert sorted(n.tolist()) == [20.0] * 5 and np.allclose(ls.sum(0), x.sum(0), atol=1e-3) and Counter(truth) == Counter({i: 20 for i in range(5)})
