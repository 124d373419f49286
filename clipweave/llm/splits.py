"""Splits that keep related records together: a spanning forest by contraction, its roots dealt to splits."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipweave.session import cut, drop_cut

#: Roots of one stratum and size band numbered by one task; larger ones are dealt in several shuffled hands.
HAND = 20_000
#: Roots with at least this part of all records are dealt one by one, the largest first; there can be no more of them than its inverse.
LARGE = 1 / 20_000


def vertex(kind: str, column: str):
    """A vertex for a value of one kind of key: 128 bits, so that no two values of any corpus fall together."""
    return F.unhex(F.md5(F.concat_ws("\u0001", F.lit(kind), F.col(column).cast("string"))))


def record_edges(records: DataFrame, key: str, shared: list[str]) -> DataFrame:
    """Edges (u, v) from every record to each non-null value it shares with others."""
    parts = [
        records.where(F.col(key).isNotNull() & F.col(c).isNotNull()).select(vertex("record", key).alias("u"), vertex(c, c).alias("v"))
        for c in shared
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def spanning_forest(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(forest, roots) of an undirected graph given as pairs (u, v) of numbers or bytes, by Borůvka contraction.

    Every round each component takes its least edge (edges have a total order by a hash of both ends, then the ends),
    the chosen edges are contracted by pointer jumping, and edges inside a component or parallel to a smaller one go.
    The number of components at least halves, so rounds grow with the logarithm of the vertices. `forest` (u, v) holds
    the chosen edges, a table of its own for every round, `roots` (vertex, root) every vertex with the representative of
    its tree. All are written to the shared folder. Self-loops only make their vertex known; nulls are left out. Joins
    on a root put the many vertices of a hub on one key of their larger side only, which adaptive execution splits.
    """
    given = edges.where(F.col("u").isNotNull() & F.col("v").isNotNull()).select("u", "v")
    live = cut(
        given.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
        .select(F.xxhash64("u", "v").alias("w"), "u", "v", F.col("u").alias("a"), F.col("v").alias("b")),
        "forest-edges",
    )
    roots = given.select(F.col("u").alias("vertex")).unionByName(given.select(F.col("v").alias("vertex"))).distinct()
    roots = cut(roots.select("vertex", F.col("vertex").alias("root")), "forest-roots")
    forest = None
    while live.limit(1).count():
        edge = F.struct("w", "u", "v")
        ends = live.select(F.col("a").alias("c"), F.col("b").alias("o"), edge.alias("e")).unionByName(
            live.select(F.col("b").alias("c"), F.col("a").alias("o"), edge.alias("e"))
        )
        # Minima are taken before the shuffle too: a hub with a third of all edges sends a row per task.
        least = cut(ends.groupBy("c").agg(F.min_by("o", "e").alias("o"), F.min("e").alias("e")), "forest-least")
        chosen = least.select("e.u", "e.v").distinct()
        chosen = cut(chosen, "forest")
        forest = chosen if forest is None else forest.unionByName(chosen)
        parent = _jump(_break_pairs(least.select("c", F.col("o").alias("p"))))
        before = (live, roots, least)
        roots = cut(
            roots.join(parent.withColumnRenamed("c", "root"), "root", "left").select("vertex", F.coalesce("p", "root").alias("root")),
            "forest-roots",
        )
        moved = live.join(parent.select(F.col("c").alias("a"), F.col("p").alias("pa")), "a").join(
            parent.select(F.col("c").alias("b"), F.col("p").alias("pb")), "b"
        )
        moved = moved.where("pa <> pb").select("w", "u", "v", F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
        live = cut(moved.groupBy("a", "b").agg(F.min(F.struct("w", "u", "v")).alias("e")).select("e.w", "e.u", "e.v", "a", "b"), "forest-edges")
        for old in (*before, parent):
            drop_cut(old)
    if forest is None:
        forest = live.select("u", "v")
    return forest, roots


def _break_pairs(parent: DataFrame) -> DataFrame:
    """Of two components that chose the same edge, the smaller becomes the root; with ordered edges there are no longer cycles."""
    back = parent.select(F.col("c").alias("p"), F.col("p").alias("pp"))
    return parent.join(back, "p", "left").select("c", F.when((F.col("pp") == F.col("c")) & (F.col("c") < F.col("p")), F.col("c")).otherwise(F.col("p")).alias("p"))


def _jump(parent: DataFrame) -> DataFrame:
    """Parents replaced by roots, doubling the distance until nothing moves."""
    parent = cut(parent, "forest-parent")
    while True:
        up = parent.select(F.col("c").alias("p"), F.col("p").alias("pp"))
        nxt = cut(parent.join(up, "p", "left").select("c", F.coalesce("pp", "p").alias("n"), "p"), "forest-parent")
        drop_cut(parent)
        done = not nxt.where("n <> p").limit(1).count()
        parent = nxt.select("c", F.col("n").alias("p"))
        if done:
            return parent


def deal_splits(
    records: DataFrame,
    proportions: dict[str, float],
    *,
    key: str = "id",
    shared: tuple[str, ...] = ("speaker_id",),
    stratum: str | None = "gender",
    seed: int = 0,
) -> DataFrame:
    """(`key`, root, split) for every record, so that records connected by any of `shared` get the same split.

    `records` has one row per `key`. A record whose shared values are all null stands alone. Roots are put in strata by
    `stratum` (the value most of the root's records have) and size band (powers of two). Those that hold LARGE of all
    records or more are dealt one by one, the largest first: each goes to the split that is then furthest behind in
    records, over all strata its own records have. The rest are dealt systematically, band by band in shuffled hands: the
    share of a hand's records that stand before a root says the split, in proportion to what each split still lacks of
    the stratum. So the proportions hold but for one root per band and hand, none of which holds LARGE of the records;
    only a root larger than what a split may have makes them coarser. Nulls of `stratum` form a stratum of their own.
    An empty table gives an empty result; other columns are ignored.
    """
    _, roots = spanning_forest(record_edges(records, key, list(shared)))
    known = records.where(F.col(key).isNotNull()).select(key, vertex("record", key).alias("vertex"), F.coalesce(F.col(stratum).cast("string") if stratum else F.lit(None), F.lit("")).alias("stratum"))
    rooted = cut(known.join(roots, "vertex", "left").select(key, "stratum", F.coalesce("root", "vertex").alias("root")), "split-roots")
    # Two steps, so that a root with a third of all records is counted from partial sums.
    by = cut(rooted.groupBy("root", "stratum").agg(F.count("*").alias("n")), "split-counts")
    total = {r["stratum"]: r["n"] for r in by.groupBy("stratum").agg(F.sum("n").alias("n")).collect()}  # a row per stratum
    sized = by.groupBy("root").agg(F.sum("n").alias("n"), F.max_by("stratum", F.struct("n", "stratum")).alias("stratum"))
    sized = cut(sized, "split-sized")
    bar = max(1.0, sum(total.values()) * LARGE)
    large = sized.where((F.col("n") >= bar) & (F.col("n") > 1)).select("root", F.col("n").alias("size"))
    names, aim = list(proportions), {s: p / sum(proportions.values()) for s, p in proportions.items()}

    def deal(pdf: pd.DataFrame) -> pd.DataFrame:
        got = {s: dict.fromkeys(total, 0) for s in names}
        out = []
        for root, own in pdf.sort_values(["size", "root"], ascending=[False, True]).groupby("root", sort=False):
            counts = dict(zip(own["stratum"], own["n"]))
            # Every split's lag in each stratum, as a share of it, weighed by the root's own records.
            lag = {s: sum(c * (aim[s] * total[g] - got[s][g]) / (aim[s] * total[g]) for g, c in counts.items()) for s in names}
            split = max(names, key=lambda s: (lag[s], aim[s]))
            for g, c in counts.items():
                got[split][g] += c
            out.append((root, split))
        return pd.DataFrame(out, columns=["root", "split"])

    # At most 1 / LARGE roots, so one task.
    one_by_one = by.join(large, "root").withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(deal, f"root {sized.schema['root'].dataType.simpleString()}, split string")
    one_by_one = cut(one_by_one, "split-large")
    had = {(r["stratum"], r["split"]): r["n"] for r in by.join(one_by_one, "root").groupBy("stratum", "split").agg(F.sum("n").alias("n")).collect()}  # strata by splits
    edges = F.array()
    for g, n in total.items():
        lacks = [max(0.0, aim[s] * n - had.get((g, s), 0)) for s in names]
        upto = [sum(lacks[: i + 1]) / (sum(lacks) or 1.0) for i in range(len(names))]
        edges = F.when(F.col("stratum") == g, F.array(*[F.lit(float(e)) for e in upto])).otherwise(edges) if total else edges
    small = sized.join(one_by_one, "root", "left_anti").withColumn("band", F.floor(F.log2("n")))
    bands = small.groupBy("stratum", "band").agg(F.ceil(F.count("*") / HAND).alias("hands"))
    dealt = small.join(bands, ["stratum", "band"]).withColumn("hand", F.pmod(F.xxhash64(F.lit(seed), "root"), "hands"))
    hand = Window.partitionBy("stratum", "band", "hand")
    before = F.sum("n").over(hand.orderBy(F.xxhash64(F.lit(seed + 1), "root"), "root")) - F.col("n") / 2
    # Where a band holds few roots, each hand begins at another place, else all of them would begin with the first split.
    turn = F.pmod(before / F.sum("n").over(hand) + F.pmod(F.xxhash64(F.lit(seed + 2), "stratum", "band", "hand"), F.lit(1000)) / 1000, F.lit(1.0))
    placed = dealt.select("root", "stratum", turn.alias("turn")).withColumn("edges", edges)
    place = F.size(F.filter("edges", lambda e: e <= F.col("turn")))
    rest = placed.select("root", F.get(F.array(*[F.lit(s) for s in names]), F.least(place, F.lit(len(names) - 1))).alias("split"))
    return rooted.join(one_by_one.unionByName(rest), "root").select(key, "root", "split")


def leaking_values(records: DataFrame, assigned: DataFrame, *, key: str = "id", shared: str = "speaker_id", split: str = "split") -> DataFrame:
    """(`shared`) values whose records stand in more than one split of an earlier assignment (`key`, `split`).

    Built on the spanning forest of records and values: a tree with more than one split leaks. With one shared column
    every tree holds one value. Null splits and unknown keys don't count; a key repeated in one split counts once, a
    key in two splits leaks its value.
    """
    named = records.where(F.col(shared).isNotNull()).select(key, shared)
    _, roots = spanning_forest(record_edges(named, key, [shared]))
    given = assigned.where(F.col(split).isNotNull()).select(vertex("record", key).alias("vertex"), F.col(split).alias("split"))
    split_of = given.join(roots, "vertex").groupBy("root", "split").count().groupBy("root").agg(F.count("*").alias("n"))
    bad = split_of.where("n > 1").select("root")
    values = named.select(shared).distinct().withColumn("vertex", vertex(shared, shared))
    return values.join(roots, "vertex").join(bad, "root", "left_semi").select(shared)
