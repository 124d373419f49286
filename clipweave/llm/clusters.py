"""Grouping records into similarity clusters: mergeable cluster-feature trees, Ward agglomeration of leaves, one assignment pass."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clipweave.llm import vectors as V
from clipweave.llm.splits import spanning_forest
from clipweave.session import cut

#: Mean cosine between the members of two features from which they are one. "About 0.65 or more" within a cluster, and
#: well below between clusters, leaves room under 0.65 for the pairs of a cluster that lie furthest apart.
SIMILAR = 0.6
#: Rows a branch of the trees' root is made for, and the most branches there may be (sent to every task: 3 MB at 192 dimensions).
ROWS_PER_BRANCH = 400
MOST_BRANCHES = 4096
SAMPLED_PER_BRANCH = 32
#: Leaves a task holds before it passes its tree on and starts anew. Features are mergeable, so nothing is lost.
LEAVES_HELD = 30_000
#: Trees merged by one task at a time.
FAN_IN = 32
#: Branches in which a leaf meets the leaves of other branches. Leaves of few rows point a little aside, so three are too few.
MEETINGS = 12
#: Rows assigned by one task; larger branches are dealt to several tasks, each with all centres of the branch.
ASSIGNED = 20_000


class FeatureTree:
    """A cluster-feature tree: branches fixed for all tasks, under each the leaves (count, linear sum) of unit rows.

    A row or feature enters the leaf of its branch with whose members its mean cosine is highest, if that reaches
    `similar`; else it becomes a leaf. Since branches are the same everywhere, trees merge branch by branch.
    """

    def __init__(self, similar: float):
        self.similar = similar
        self.leaves: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.size = 0

    def insert(self, branch: int, sums: np.ndarray, counts: np.ndarray) -> None:
        """Enter features into a branch, the largest first where they must found leaves."""
        old = self.leaves.get(branch)
        if old is not None:
            n, ls = old
            score = (sums / counts[:, None]) @ (ls / n[:, None]).T
            best = score.argmax(axis=1)
            fits = score[np.arange(len(best)), best] >= self.similar
            if fits.any():
                ls = ls + V.group_sums(sums[fits], best[fits], len(n))
                n = n + np.bincount(best[fits], weights=counts[fits], minlength=len(n))
                self.leaves[branch] = (n, ls)
            sums, counts = sums[~fits], counts[~fits]
        if len(counts):
            founded = _found_leaves(sums, counts, self.similar)
            if old is not None:
                founded = tuple(np.concatenate([a, b]) for a, b in zip(self.leaves[branch], founded))
            self.size += len(founded[0]) - (len(self.leaves[branch][0]) if old is not None else 0)
            self.leaves[branch] = founded

    def drain(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(branch, count, linear sum) of all leaves; the tree is empty afterwards."""
        if not self.leaves:
            return np.zeros(0, np.int32), np.zeros(0), np.zeros((0, 1), np.float32)
        branch = np.concatenate([np.full(len(n), b, np.int32) for b, (n, _) in self.leaves.items()])
        n = np.concatenate([n for n, _ in self.leaves.values()])
        ls = np.concatenate([s for _, s in self.leaves.values()])
        self.leaves, self.size = {}, 0
        return branch, n, ls


def _found_leaves(sums: np.ndarray, counts: np.ndarray, similar: float) -> tuple[np.ndarray, np.ndarray]:
    """Leaves made of features alone: each in turn takes in all that remain and are similar to it."""
    order = np.argsort(-counts, kind="stable")
    means = (sums / counts[:, None])[order]
    n, ls = [], []
    rest = np.arange(len(order))
    while len(rest):
        near = means[rest] @ means[rest[0]] >= similar
        near[0] = True
        at = order[rest[near]]
        n.append(counts[at].sum())
        ls.append(sums[at].sum(axis=0))
        rest = rest[~near]
    return np.array(n, float), np.array(ls, np.float32)


def ward_groups(sums: np.ndarray, counts: np.ndarray, similar: float) -> np.ndarray:
    """Group numbers of features by Ward agglomeration: of the pairs similar enough, the one merges first that adds least
    to the squared distances within; features are summed, so every later cost is exact."""
    n, ls = counts.astype(float).copy(), sums.astype(np.float64).copy()
    group = np.arange(len(n))
    means = ls / n[:, None]
    score = means @ means.T
    np.fill_diagonal(score, -2)
    alive = np.ones(len(n), bool)
    while True:
        a, b = np.nonzero(np.triu(score >= similar, 1))
        if not len(a):
            return group
        # Merge per round the best pair of every feature that is mutual, as in a chain of nearest neighbours.
        gap = np.einsum("ij,ij->i", means[a] - means[b], means[a] - means[b])
        cost = n[a] * n[b] / (n[a] + n[b]) * gap
        order = np.lexsort((b, a, cost))
        used = np.zeros(len(n), bool)
        changed = []
        for i in order:
            x, y = a[i], b[i]
            if used[x] or used[y]:
                used[x] = used[y] = True  # a cheaper merge of either comes first; this pair waits for the next round
                continue
            used[x] = used[y] = True
            ls[x] += ls[y]
            n[x] += n[y]
            alive[y] = False
            group[group == y] = x
            changed.append(x)
        score[~alive] = -2
        score[:, ~alive] = -2
        for x in changed:
            means[x] = ls[x] / n[x]
        fresh = means[changed] @ means.T
        fresh[:, ~alive] = -2
        fresh[np.arange(len(changed)), changed] = -2
        score[changed] = fresh
        score[:, changed] = fresh.T


def similarity_clusters(records: DataFrame, *, key: str = "id", column: str = "speaker_embedding", keep: tuple[str, ...] = (), dims: int = 192, similar: float = SIMILAR, rows_per_branch: int = ROWS_PER_BRANCH, assigned: int = ASSIGNED) -> DataFrame:
    """(`key`, *keep, cluster, closeness) of every record with a usable vector; closeness is the cosine to the cluster's centre.

    Usable are vectors of `dims` finite values that aren't all zero; other records have no row. A key delivered more
    than once has one row. `cluster` is the number of a leaf of the cluster. An empty table gives an empty result.

    One pass grows a feature tree per task, and trees are merged by branch, FAN_IN at a time. Merged leaves meet those
    of other branches in their MEETINGS nearest branches, where Ward agglomeration links them; linked leaves are
    contracted to clusters by a distributed spanning forest. Leaves that are linked in any meeting become one cluster, so
    across branches clusters are joined by single links between Ward groups. A second pass assigns every row to the nearest centre of
    its branch; a branch with many rows is dealt to many tasks. What leaves a task before that is a feature per leaf.
    """
    spark = records.sparkSession
    kept = records.where(F.col(key).isNotNull() & F.col(column).isNotNull()).select(key, *keep, column)
    shape = kept.select(key, *keep).schema
    out_schema = StructType([*shape.fields]).add("cluster", "long").add("closeness", "float")
    n = kept.count()
    sample = V.sample(kept, key, column, dims, max(1024, SAMPLED_PER_BRANCH * min(MOST_BRANCHES, max(1, n // rows_per_branch))))
    if not len(sample):
        return spark.createDataFrame([], out_schema)
    roots = V.fit_cells(sample, int(min(MOST_BRANCHES, max(1, n // rows_per_branch))))
    shared = spark.sparkContext.broadcast(roots)
    spec = "tree bigint, branch int, n double, ls binary"

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        number = context.partitionId() if context else 0
        tree = FeatureTree(similar)
        for batch in batches:
            _, x = V.unit_rows(batch.column(0), dims)
            if not len(x):
                continue
            branch, _ = V.nearest(x, shared.value)
            order = np.argsort(branch, kind="stable")
            edges = np.flatnonzero(np.concatenate([[True], np.diff(branch[order]) > 0, [True]]))
            for a, b in zip(edges[:-1], edges[1:]):
                rows = order[a:b]
                tree.insert(int(branch[rows[0]]), x[rows], np.ones(len(rows)))
            if tree.size > LEAVES_HELD:
                yield _leaf_batch(number, *tree.drain())
        yield _leaf_batch(number, *tree.drain())

    leaves = cut(kept.select(column).mapInArrow(grow, spec), "cf-leaves")
    trees = leaves.agg(F.max("tree")).first()[0]
    trees = 0 if trees is None else trees + 1

    def merge(table: pa.Table) -> pa.Table:
        tree = FeatureTree(similar)
        n_, ls = table["n"].to_numpy(), V.binary_rows(table["ls"], np.float32, dims)
        order = np.argsort(-n_, kind="stable")
        tree.insert(table["branch"][0].as_py(), ls[order], n_[order])
        batch = _leaf_batch(table["up"][0].as_py(), *tree.drain())
        return pa.Table.from_batches([batch])

    while trees > 1:
        up = F.floor(F.col("tree") / FAN_IN)
        leaves = cut(leaves.withColumn("up", up).groupBy("up", "branch").applyInArrow(merge, spec), "cf-leaves")
        trees = -(-trees // FAN_IN)
    by_size = F.row_number().over(Window.partitionBy("branch").orderBy(F.desc("n"), "ls"))
    leaves = cut(leaves.select("branch", "n", "ls", (F.shiftleft(F.col("branch").cast("long"), 32) + by_size).alias("leaf")), "cf-leaves")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ls = V.binary_rows(batch.column(2), np.float32, dims)
            if len(ls):
                mean = ls / batch.column(1).to_numpy()[:, None]
                unit = mean / np.maximum(np.sqrt(np.einsum("ij,ij->i", mean, mean)), 1e-9)[:, None]
                tops = V.top_cells(unit, shared.value, MEETINGS)
                own, packed = batch.column(3).to_numpy(), V.pack(mean)
                for p in range(tops.shape[1]):
                    yield pa.RecordBatch.from_arrays([pa.array(tops[:, p].astype(np.int32)), pa.array(own), batch.column(1), packed], names=["meeting", "leaf", "n", "mean"])

    def agglomerate(table: pa.Table) -> pa.Table:
        leaf = table["leaf"].to_numpy()
        order = np.argsort(leaf)
        leaf, n_ = leaf[order], table["n"].to_numpy()[order]
        means = V.binary_rows(table["mean"], np.int16, dims)[order].astype(np.float32) / V.SCALE
        u, v = [], []
        for part in _parts(means, similar):
            if len(part) > 1:
                group = ward_groups(means[part] * n_[part][:, None], n_[part], similar)
                u.append(leaf[part])
                v.append(leaf[part][group])
            else:
                u.append(leaf[part])
                v.append(leaf[part])
        return pa.table({"u": pa.array(np.concatenate(u)), "v": pa.array(np.concatenate(v))})

    met = leaves.select("branch", "n", "ls", "leaf").mapInArrow(meet, "meeting int, leaf bigint, n double, mean binary")
    links = met.groupBy("meeting").applyInArrow(agglomerate, "u bigint, v bigint").distinct()
    _, clusters = spanning_forest(cut(links, "cf-links"))
    joined = leaves.join(clusters.select(F.col("vertex").alias("leaf"), F.col("root").alias("cluster")), "leaf")
    named = cut(joined.select("branch", "cluster", "n", "ls"), "cf-clusters")

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The rows of a cluster stand together; the last of a batch may go on in the next.
        last, held = None, np.zeros(dims, np.float64)
        for batch in batches:
            if not len(batch):
                continue
            ids, ls = batch.column(0).to_numpy(), V.binary_rows(batch.column(1), np.float32, dims).astype(np.float64)
            begin = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            sums, who = np.add.reduceat(ls, begin, axis=0), ids[begin]
            if last is not None:
                if who[0] == last:
                    sums[0] += held
                else:
                    who, sums = np.concatenate([[last], who]), np.concatenate([held[None], sums])
            last, held = who[-1], sums[-1]
            yield _centre_batch(who[:-1], sums[:-1])
        if last is not None:
            yield _centre_batch(np.array([last]), held[None])

    ordered = named.repartition("cluster").sortWithinPartitions("cluster").select("cluster", "ls")
    centres = ordered.mapInArrow(total, "cluster bigint, centre binary")
    shares = {r["branch"]: int(-(-r["n"] // assigned)) for r in named.groupBy("branch").agg(F.sum("n").alias("n")).collect()}  # MOST_BRANCHES rows at most
    hands = np.array([max(1, shares.get(b, 1)) for b in range(len(roots))], np.int64)
    dealt = spark.createDataFrame([(b, h) for b, count in enumerate(hands.tolist()) for h in range(count)], "branch int, hand int")
    offered = named.select("branch", "cluster").distinct().join(centres, "cluster").join(dealt, "branch").select("branch", "hand", "cluster", "centre")

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = V.unit_rows(batch.column(batch.num_columns - 1), dims)
            branch, _ = V.nearest(x, shared.value)
            hand = at % hands[branch]
            rest = [batch.column(i).take(pa.array(at)) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([pa.array(branch.astype(np.int32)), pa.array(hand.astype(np.int32)), *rest, V.pack(x)], names=["branch", "hand", *[f.name for f in shape], "v"])

    def assign(rows: pa.Table, centre: pa.Table) -> pa.Table:
        if not len(rows):
            return pa.table({**{f.name: rows[f.name] for f in shape}, "cluster": pa.array([], pa.int64()), "closeness": pa.array([], pa.float32())})
        c = V.binary_rows(centre["centre"], np.float32, dims)
        order = np.argsort(centre["cluster"].to_numpy())
        best, close = V.nearest(V.unpack(rows["v"], dims), c[order])
        return pa.table({**{f.name: rows[f.name] for f in shape}, "cluster": pa.array(centre["cluster"].to_numpy()[order][best]), "closeness": pa.array(close)})

    row_spec = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in shape)
    routed = kept.mapInArrow(route, f"branch int, hand int, {row_spec}, v binary")
    placed = routed.groupBy("branch", "hand").cogroup(offered.groupBy("branch", "hand")).applyInArrow(assign, f"{row_spec}, cluster bigint, closeness float")
    once = placed.groupBy(key).agg(F.max(F.struct("closeness", "cluster", *keep)).alias("r"))
    return cut(once.select(key, *[F.col("r")[c].alias(c) for c in (*keep, "cluster", "closeness")]), "cf-placed")


def _leaf_batch(tree: int, branch: np.ndarray, n: np.ndarray, ls: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(n), tree, np.int64)), pa.array(branch.astype(np.int32)), pa.array(n.astype(float)), V.rows_as_binary(ls.astype(np.float32))], names=["tree", "branch", "n", "ls"])


def _centre_batch(who: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    unit = sums / np.maximum(np.sqrt(np.einsum("ij,ij->i", sums, sums)), 1e-12)[:, None]
    return pa.RecordBatch.from_arrays([pa.array(who.astype(np.int64)), V.rows_as_binary(unit.astype(np.float32))], names=["cluster", "centre"])


def _parts(means: np.ndarray, similar: float) -> list[np.ndarray]:
    """Connected parts of the graph of similar features; only within a part can anything merge."""
    label = np.arange(len(means))
    a, b = [], []
    for s in range(0, len(means), 1024):
        x, y = np.nonzero(means[s : s + 1024] @ means.T >= similar)
        a.append(x + s)
        b.append(y)
    a, b = np.concatenate(a), np.concatenate(b)
    while True:
        low = label.copy()
        np.minimum.at(low, a, label[b])
        low = low[low]
        if (low == label).all():
            break
        label = low
    order = np.argsort(label, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], np.diff(label[order]) > 0, [True]]))
    return [order[x:y] for x, y in zip(edges[:-1], edges[1:])]


def cluster_names(members: DataFrame, label: str) -> DataFrame:
    """(cluster, name): the label that more than half of a cluster's labelled members carry; clusters without one are left out."""
    votes = members.where(F.col(label).isNotNull()).groupBy("cluster", label).count()
    best = votes.groupBy("cluster").agg(F.sum("count").alias("all"), F.max_by(label, F.struct("count", label)).alias("name"), F.max("count").alias("most"))
    return best.where(F.col("most") * 2 > F.col("all")).select("cluster", "name")


def describe_clusters(members: DataFrame, *, key: str = "id", typical: int = 5) -> DataFrame:
    """(cluster, size, typical): how many records a cluster has, and those nearest to its centre, ties by key."""
    near = F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc("closeness"), key))
    heads = members.withColumn("r", near).where(F.col("r") <= typical)
    heads = heads.groupBy("cluster").agg(F.transform(F.sort_array(F.collect_list(F.struct("r", key))), lambda e: e[key]).alias("typical"))
    return members.groupBy("cluster").agg(F.count("*").alias("size")).join(heads, "cluster")
