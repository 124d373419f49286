"""Voice prints of a video's speakers, and speakers across videos."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipweave.session import cut


def cosine(a: str | Column, b: str | Column) -> Column:
    """Cosine of two arrays of equal length, null if one is all zero."""

    def dot(x, y):
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)

    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / (np.linalg.norm(x, axis=-1, keepdims=True) + 1e-9)


def consistency(rows: DataFrame, *, keys: list[str], vector: str) -> DataFrame:
    """(*keys, least): the least cosine of a group's vectors to the mean of their directions.

    Means are taken value by value, with partial sums before the shuffle, and joined back; no group is gathered. Vectors are
    finite, of one length and not all zero.
    """
    length = F.sqrt(F.aggregate(F.col(vector), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    unit = rows.select(*keys, F.transform(vector, lambda x: x.cast("double")).alias("_v"), length.alias("_len"))
    values = unit.select(*keys, "_len", F.posexplode("_v").alias("_i", "_x")).groupBy(*keys, "_i").agg(F.avg(F.col("_x") / F.col("_len")).alias("_m"))
    means = values.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("_i", "_m"))), lambda e: e["_m"]).alias("_c"))  # as many as a vector has values
    return unit.join(means, keys).groupBy(*keys).agg(F.min(cosine("_v", "_c")).alias("least"))


def voice_prints(clips: DataFrame, *, outlier: float = 0.5, dims: int = 192, keys: tuple[str, ...] = ("video_id", "local_speaker")) -> DataFrame:
    """(*keys, print, seconds, members, sound) of every speaker of a video: the unit mean of its clips' embeddings, by length.

    Clips less similar than `outlier` to that mean are left out and the mean taken anew, if at least a quarter of them
    remain; seconds count all. Clips without a usable embedding don't count.
    """
    ok = (F.size("speaker_embedding") == dims) & ~F.exists("speaker_embedding", lambda v: v.isNull() | F.isnan(v))
    usable = clips.where(F.col("speaker_embedding").isNotNull() & ok).select(*keys, "duration", "speaker_embedding")

    def one(table: pa.Table) -> pa.Table:
        x = _unit(np.stack(table["speaker_embedding"].to_numpy(zero_copy_only=False)).astype(np.float64))
        d = np.nan_to_num(table["duration"].to_numpy(zero_copy_only=False).astype(float))
        order = np.lexsort((*x.T[:3], d))  # the same sums whatever the order of the rows
        x, d = x[order], d[order]
        c = _unit((x * d[:, None]).sum(axis=0))
        good = x @ c >= outlier
        if good.sum() >= max(1, len(x) // 4):
            c = _unit((x[good] * d[good, None]).sum(axis=0))
        row = {k: table[k][:1] for k in keys}
        return pa.table({**row, "print": pa.array([c.tolist()], pa.list_(pa.float64())), "seconds": pa.array([float(d.sum())]), "members": pa.array([len(x)], pa.int64()), "sound": pa.array([int(good.sum())], pa.int64())})

    spec = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in usable.select(*keys).schema)
    return usable.groupBy(*keys).applyInArrow(one, f"{spec}, print array<double>, seconds double, members bigint, sound bigint")


def average_linkage(x: np.ndarray, similarity: float) -> np.ndarray:
    """Labels of unit rows by agglomeration: the two clusters of highest mean cosine merge while it reaches `similarity`."""
    n = len(x)
    s = x @ x.T
    np.fill_diagonal(s, -np.inf)
    size, label, alive = np.ones(n), np.arange(n), np.ones(n, bool)
    while n > 1:
        i, j = divmod(int(s.argmax()), n)
        if not s[i, j] >= similarity:
            break
        i, j = min(i, j), max(i, j)
        merged = (size[i] * s[i] + size[j] * s[j]) / (size[i] + size[j])
        s[i], s[:, i] = merged, merged
        s[i, i] = -np.inf
        s[j], s[:, j] = -np.inf, -np.inf
        size[i] += size[j]
        alive[j] = False
        label[label == j] = i
    return np.unique(label, return_inverse=True)[1]


def assign_prints(prints: np.ndarray, seconds: np.ndarray, *, similarity: float = 0.65, least_sec: float = 30.0) -> np.ndarray:
    """Speaker numbers of voice prints: the long ones are clustered and moved once to the nearest centre, each short one joins
    the nearest centre if it is similar enough, else it is a speaker of its own."""
    x = _unit(prints.astype(float))
    big = seconds >= least_sec
    if not big.any():
        big = np.ones(len(x), bool)
    out = np.full(len(x), -1)
    label = average_linkage(x[big], similarity)

    def centres(label: np.ndarray) -> np.ndarray:
        sums = np.zeros((label.max() + 1, x.shape[1]))
        np.add.at(sums, label, x[big] * seconds[big, None])
        return _unit(sums)

    label = (x[big] @ centres(label).T).argmax(axis=1)
    label = np.unique(label, return_inverse=True)[1]
    c = centres(label)
    out[big] = label
    fresh = len(c)
    for i in np.flatnonzero(~big):
        near = x[i] @ c.T
        best = int(near.argmax())
        if near[best] >= similarity:
            out[i] = best
        else:
            out[i], fresh = fresh, fresh + 1
    return out


def linked_groups(x: np.ndarray, similarity: float) -> np.ndarray:
    """Labels of unit rows by average linkage with sums in place of the matrix of all pairs: memory grows with the rows only.

    The mean cosine of two clusters is the product of their mean vectors. Chains of nearest neighbours end in pairs that are
    each other's nearest, which average linkage merges too, sooner or later. A cluster whose nearest is below `similarity` is
    done: a merger of others is never nearer to it than both its parts were.
    """
    n = len(x)
    sums, size, label = x.astype(float), np.ones(n), np.arange(n)
    chain: list[int] = []
    left = n
    open_ = np.ones(n, bool)  # clusters that may still merge; one whose nearest is below `similarity` never does again
    while left:
        if not chain:
            chain = [int(open_.argmax())]
        i = chain[-1]
        mean = sums @ (sums[i] / size[i]) / size
        mean[~open_] = -np.inf
        mean[i] = -np.inf
        if len(chain) > 1 and mean[chain[-2]] >= mean.max():
            j = chain[-2]  # ties go back along the chain
        else:
            j = int(mean.argmax())
        if not mean[j] >= similarity:
            open_[i] = False
            left -= 1
            chain.pop()
            continue
        if len(chain) > 1 and j == chain[-2]:
            a, b = min(i, j), max(i, j)
            sums[a] += sums[b]
            size[a] += size[b]
            open_[b] = False
            left -= 1
            label[label == b] = a
            del chain[-2:]
        else:
            chain.append(j)
    return np.unique(label, return_inverse=True)[1]


#: Rows of a block; every two blocks are compared in one task, piece by piece.
BLOCK = 16_384
#: Rows of a piece of a block.
PIECE = 2_048
#: Cosines are compared with so much room when only links are looked for.
ROOM = 1e-6


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) of the graph of edges a-b."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = flat[: len(a)], flat[len(a) :]
    root = np.arange(len(nodes))
    while len(u):
        low = np.minimum(root[u], root[v])
        before = root.copy()
        np.minimum.at(root, before[u], low)
        np.minimum.at(root, before[v], low)
        while not np.array_equal(root, root[root]):
            root = root[root]
        apart = root[u] != root[v]
        u, v = u[apart], v[apart]
    return nodes, nodes[root]


def _stack(column: pa.ChunkedArray) -> np.ndarray:
    return np.stack(column.to_numpy(zero_copy_only=False)).astype(float)


def _links(prints: DataFrame, similarity: float, blocks: int) -> DataFrame:
    """(a, b): edges that connect all prints between which a path of cosines of `similarity` leads; every pair is looked at."""
    own = F.pmod(F.xxhash64("_n"), F.lit(blocks)).cast("int")
    paired = prints.select("_n", F.col("print").alias("v"), own.alias("own")).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    paired = paired.select("_n", "v", "own", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"))

    def link(table: pa.Table) -> pa.Table:
        n, own = (table[c].to_numpy() for c in ("_n", "own"))
        x = _unit(_stack(table["v"]))
        first, second = (np.flatnonzero(own == table[c][0].as_py()) for c in ("p", "q"))
        same = table["p"][0].as_py() == table["q"][0].as_py()
        ends: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64),) * 2]
        for i in range(0, len(first), PIECE):
            for j in range(i if same else 0, len(second), PIECE):
                f, s = first[i : i + PIECE], second[j : j + PIECE]
                r, c = np.nonzero(x[f] @ x[s].T >= similarity - ROOM)
                ends.append(forest(n[f[r]], n[s[c]]))
        a, b = forest(*(np.concatenate(e) for e in zip(*ends)))
        return pa.table({"a": a[a != b], "b": b[a != b]})

    return paired.groupBy("p", "q").applyInArrow(link, "a bigint, b bigint")


def _contracted(edges: DataFrame, blocks: int) -> DataFrame:
    """(_n, component) of all nodes with an edge: forests of parts of the edges, then of all that is left of them."""

    def shrink(table: pa.Table) -> pa.Table:
        a, b = forest(table["a"].to_numpy(), table["b"].to_numpy())
        return pa.table({"a": a, "b": b})

    part = F.pmod(F.xxhash64("b"), F.lit(blocks))
    shrunk = edges.groupBy(part).applyInArrow(shrink, "a bigint, b bigint").where("a <> b")
    return shrunk.groupBy(F.lit("")).applyInArrow(shrink, "a bigint, b bigint").select(F.col("a").alias("_n"), F.col("b").alias("component"))


def _centres(members: DataFrame) -> DataFrame:
    """(group, centre): the unit mean of each group's prints by seconds."""

    def mean(table: pa.Table) -> pa.Table:
        x = _unit(_stack(table["print"]))
        c = _unit((x * table["seconds"].to_numpy()[:, None]).sum(axis=0))
        return pa.table({"group": table["group"][:1], "centre": pa.array([c.tolist()], pa.list_(pa.float64()))})

    return members.select("group", "print", "seconds").groupBy("group").applyInArrow(mean, "group bigint, centre array<double>")


def _nearest(prints: DataFrame, centres: DataFrame, blocks: int) -> DataFrame:
    """(_n, group, near): the nearest of all centres to each print, the one of the lowest number among equals."""
    cells = max(1, -(-centres.count() // BLOCK))
    rows = prints.select("_n", F.col("print").alias("v"), F.pmod(F.xxhash64("_n"), F.lit(blocks)).alias("p"), F.explode(F.sequence(F.lit(0), F.lit(cells - 1))).alias("q"))
    grid = centres.select("group", F.col("centre").alias("v"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("p"), F.pmod(F.xxhash64("group"), F.lit(cells)).alias("q"))

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return pa.table({"_n": pa.array([], pa.int64()), "group": pa.array([], pa.int64()), "near": pa.array([], pa.float64())})
        number = right["group"].to_numpy()
        order = np.argsort(number)
        c, number, x = _stack(right["v"])[order], number[order], _unit(_stack(left["v"]))
        at, near = [], []
        for i in range(0, len(x), PIECE):
            s = x[i : i + PIECE] @ c.T
            at.append(s.argmax(axis=1))
            near.append(s.max(axis=1))
        return pa.table({"_n": left["_n"], "group": number[np.concatenate(at)], "near": np.concatenate(near)})

    found = rows.groupBy("p", "q").cogroup(grid.groupBy("p", "q")).applyInArrow(best, "_n bigint, group bigint, near double")
    top = F.max(F.struct("near", (-F.col("group")).alias("g")))
    return found.groupBy("_n").agg(top.alias("t")).select("_n", (-F.col("t.g")).alias("group"), F.col("t.near").alias("near"))


def speakers_across(prints: DataFrame, *, similarity: float = 0.65, least_sec: float = 30.0) -> DataFrame:
    """`prints` (without the vector) with speaker, numbered from 0 by total seconds, the largest first.

    Long prints are clustered by average linkage over the whole table and moved once to the nearest of all centres; each short
    one joins the nearest centre if it is similar enough, else it is a speaker of its own. Two clusters whose mean cosine
    reaches `similarity` hold a pair that does, so linkage within the connected components of such pairs is the same as over
    all. All pairs of long prints are compared, block by block: the work grows with the square of their number.
    """
    rest = [c for c in prints.columns if c != "print"]
    given = cut(prints.withColumn("_n", F.monotonically_increasing_id()), "prints")
    total, long_ = given.agg(F.count("*"), F.count_if(F.col("seconds") >= least_sec)).first()
    is_long = F.coalesce(F.col("seconds") >= least_sec, F.lit(False)) if long_ else F.lit(True)
    big, small = given.where(is_long), given.where(~is_long)
    blocks = max(1, -(-(long_ or total) // BLOCK))

    def cluster(table: pa.Table) -> pa.Table:
        x, seconds, n = _unit(_stack(table["print"])), table["seconds"].to_numpy(), table["_n"].to_numpy()
        order = np.lexsort((*x.T[:3], -seconds))
        label = linked_groups(x[order], similarity)
        first = np.full(label.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(first, label, n[order])
        return pa.table({"_n": n[order], "group": first[label]})

    component = cut(_contracted(_links(big, similarity, blocks), blocks), "components")
    joined = big.select("_n", "print", "seconds").join(component, "_n", "left").withColumn("component", F.coalesce("component", "_n"))
    groups = joined.groupBy("component").applyInArrow(cluster, "_n bigint, group bigint")
    centres = cut(_centres(big.join(groups, "_n")), "centres")
    moved = cut(_nearest(big, centres, blocks).select("_n", "group"), "moved")
    centres = cut(_centres(big.join(moved, "_n")), "centres")
    joins = _nearest(small, centres, max(1, -(-(total - (long_ or total)) // BLOCK)))
    placed = small.select("_n").join(joins, "_n", "left").select("_n", F.when(F.col("near") >= similarity, F.col("group")).otherwise(-1 - F.col("_n")).alias("group"))
    named = cut(given.drop("print").join(moved.unionByName(placed), "_n"), "speakers")
    order = Window.orderBy(F.desc("s"), "group")  # a row per speaker
    number = named.groupBy("group").agg(F.sum("seconds").alias("s")).select("group", (F.row_number().over(order) - 1).cast("long").alias("speaker"))
    return named.join(number, "group").select(*rest, "speaker")
