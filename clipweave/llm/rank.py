"""One ranking from several differently-scaled scores: the stationary order of a rank walk."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipweave.session import cut, drop_cut

#: The walk goes on with this probability, else it starts anew anywhere. Small, because every step climbs: with large
#: values the walk piles up on the heads of single scores, which few items stand above.
DAMPING = 0.15
TOLERANCE = 1e-7
MAX_ROUNDS = 40
#: Distinct values of a score that one task sums up in order.
PREFIX_BLOCK = 20_000


def rank_walk(items: DataFrame, scores: list[str], *, key: str = "id", damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(`key`, stationarity) for every item: the share of time a walk spends on it that climbs by single scores.

    From an item the walk picks one of `scores` at random and jumps to an item that stands higher in it, all of these
    equally likely; where none stands higher it starts anew anywhere, as it does after any item with probability
    1 - `damping`. Only the order of each score matters, never its scale. `items` has one row per `key` and no null or
    NaN score; equal values tie, neither stands above the other. Other columns are ignored. An empty table gives an
    empty result.

    Per score the probabilities, each shared out among the items above, are summed up in order of value, in blocks of value
    ranks; so a round costs one pass over the items and joins on the value, and no order over all items is ever built.
    """
    steps = range(len(scores))
    base = cut(items.select(F.col(key).alias("k"), *[F.col(s).cast("double").alias(f"v{i}") for i, s in enumerate(scores)]), "rank-items")
    ranks = _ranked(base, len(scores))
    if ranks is None:
        return items.select(key, F.lit(0.0).alias("stationarity")).limit(0)
    ranks, n = ranks
    placed = base
    for i in steps:
        own = ranks.where(F.col("i") == i).select(F.col("v").alias(f"v{i}"), F.col("d").alias(f"d{i}"), F.col("above").alias(f"a{i}"))
        placed = placed.join(own, f"v{i}")
    carried = ["k", *[f"d{i}" for i in steps], *[f"a{i}" for i in steps]]
    state = cut(placed.select(*carried, F.lit(1.0 / n).alias("p")), "rank-state")
    tops = sum((F.when(F.col(f"a{i}") == 0, F.col("p")).otherwise(0.0) for i in steps), F.lit(0.0)) / len(scores)
    restarts = state.agg(F.sum(tops)).first()[0]
    for _ in range(MAX_ROUNDS):
        sent = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"d{i}").alias("d"), F.when(F.col(f"a{i}") > 0, F.col("p") / F.col(f"a{i}")).otherwise(0.0).alias("m")) for i in steps])
        sums = state.select(F.inline(sent)).groupBy("i", "d").agg(F.sum("m").alias("m"))
        climbs = cut(_running(sums), "rank-climbs")
        step = state
        for i in steps:
            step = step.join(climbs.where(F.col("i") == i).select(F.col("d").alias(f"d{i}"), F.col("run").alias(f"in{i}")), f"d{i}")
        inflow = sum((F.col(f"in{i}") for i in steps), F.lit(0.0)) / len(scores) + F.lit(restarts / n)
        moved = cut(step.select(*carried, F.col("p").alias("old"), (F.lit((1 - damping) / n) + damping * inflow).alias("p")), "rank-state")
        drop_cut(state), drop_cut(climbs)
        state = moved.drop("old")
        change, restarts = moved.agg(F.sum(F.abs(F.col("p") - F.col("old"))), F.sum(tops)).first()
        if change < tolerance:
            break
    return state.select(F.col("k").alias(key), F.col("p").alias("stationarity"))


def _ranked(items: DataFrame, scores: int) -> tuple[DataFrame, int] | None:
    """((i, v, d, above), number of items) of the distinct values of score i: dense rank from below, and how many items stand higher."""
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"v{i}").alias("v")) for i in range(scores)])
    counts = cut(items.select(F.inline(pairs)).groupBy("i", "v").agg(F.count("*").alias("n")), "rank-counts")
    sizes = {r["i"]: (r["c"], r["n"]) for r in counts.groupBy("i").agg(F.count("*").alias("c"), F.sum("n").alias("n")).collect()}  # a row per score
    if not sizes:
        return None
    block = F.lit(0)
    for i, (distinct, _) in sizes.items():
        parts = -(-distinct // PREFIX_BLOCK)
        if parts > 1:
            # Blocks by fixed edges, not by partition, so that a repeated task sees the same blocks.
            edges = sorted(set(counts.where(F.col("i") == i).approxQuantile("v", [j / parts for j in range(1, parts)], 0.2 / parts)))
            block = F.when(F.col("i") == i, F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: F.col("v") >= e))).otherwise(block)
    inner = Window.partitionBy("i", "b").orderBy("v")
    local = counts.withColumn("b", block).select(
        "i", "v", "b", F.row_number().over(inner).alias("d"), F.sum("n").over(inner).alias("upto"), "n"
    )
    blocks = local.groupBy("i", "b").agg(F.count("*").alias("bd"), F.sum("n").alias("bn"))
    order = Window.partitionBy("i").orderBy("b")
    starts = blocks.select("i", "b", (F.sum("bd").over(order) - F.col("bd")).alias("d0"), (F.sum("bn").over(order) - F.col("bn")).alias("n0"))
    total = sizes[0][1]
    ranked = local.join(starts, ["i", "b"]).select(
        "i", "v", (F.col("d") + F.col("d0") - 1).cast("long").alias("d"), (F.lit(total) - F.col("upto") - F.col("n0")).alias("above")
    )
    return cut(ranked, "rank-values"), total


def _running(sums: DataFrame) -> DataFrame:
    """(i, d, run): sums of m over all lower dense ranks d, in blocks of PREFIX_BLOCK ranks."""
    inner = Window.partitionBy("i", "b").orderBy("d")
    local = sums.withColumn("b", F.floor(F.col("d") / PREFIX_BLOCK)).select("i", "d", "b", "m", F.sum("m").over(inner).alias("run"))
    blocks = local.groupBy("i", "b").agg(F.max("run").alias("bs"))
    starts = blocks.select("i", "b", (F.sum("bs").over(Window.partitionBy("i").orderBy("b")) - F.col("bs")).alias("s0"))
    return local.join(starts, ["i", "b"]).select("i", "d", (F.col("run") - F.col("m") + F.col("s0")).alias("run"))


def head(ranking: DataFrame, share: float, *, key: str = "id", by: str = "stationarity") -> DataFrame:
    """The best `share` of a ranking, rounded down; ties at the end go to the smaller key.

    Two approximate quantiles on either side of the end are counted exactly: what lies above the upper one is in, and only
    what lies between them is put in order. If the end isn't between them, they are moved apart.
    """
    # Digits that rounds of summing can differ in are cut off, so that equal items tie whatever the order of the sums.
    n = ranking.count()
    take = int(n * share + 1e-9)
    rounded = ranking.withColumn("_v", F.round(F.col(by) * n, 9))
    if not take:
        return ranking.limit(0)
    slack = max(1e-4, share / 100)
    while True:
        ends = [max(0.0, 1 - share - slack), min(1.0, 1 - share + slack)]
        low, high = rounded.agg(F.percentile_approx("_v", ends, int(min(10_000_000, 4 / slack)))).first()[0]
        above, within = rounded.agg(F.count_if(F.col("_v") > high), F.count_if(F.col("_v") >= low)).first()
        if above <= take <= within or slack > 1:
            break
        slack *= 4
    end = rounded.where((F.col("_v") <= high) & (F.col("_v") >= low)).orderBy(F.desc("_v"), key).limit(take - above)
    return rounded.where(F.col("_v") > high).unionByName(end).drop("_v")
