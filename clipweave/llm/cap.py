"""Capping records per dominant contributor, by parallel bisection of score cutoffs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from clipweave.session import cut

#: Equally spaced midpoints tried at once for every open contributor: four bits of the score range a round.
MIDPOINTS = 15
#: Boundary ties of one contributor up to this number are put in order in one task; more are narrowed down first.
TIE_BLOCK = 50_000


def cap_contributors(
    records: DataFrame,
    limit: float,
    *,
    key: str = "id",
    contributor: str = "contributor",
    score: str = "score",
    weight: str = "weight",
) -> DataFrame:
    """Mark which records each contributor keeps: best score first, as long as those kept before weigh less than `limit`.

    `records` has one row per `key`; `score` and `weight` are whole numbers (weight not negative; null counts as 0). A
    weight of 1 makes `limit` a count of records. Other columns are ignored, whatever their names. Returns
    (`key`, `contributor`, kept). Records of a null contributor are all kept; ties of score go to the smaller key; an
    empty table gives an empty result.

    Bounds lo and hi of the cutoff are held for every contributor. Each round sums the weight above all midpoints of all
    contributors in one pass over (contributor, score) totals, so a contributor with a third of all rows costs no more
    than its distinct scores and no group is ever sorted. Only the rows at the cutoff score are put in order by key.
    """
    rows = cut(
        records.select(
            F.col(key).alias("k"),
            F.col(contributor).alias("c"),
            F.coalesce(F.col(score).cast("long"), F.lit(0).cast("long")).alias("s"),
            F.greatest(F.coalesce(F.col(weight).cast("long"), F.lit(0).cast("long")), F.lit(0).cast("long")).alias("w"),
        ),
        "cap-rows",
    )
    owned = rows.where(F.col("c").isNotNull())
    totals = cut(owned.groupBy("c", "s").agg(F.sum("w").alias("w")), "cap-totals")
    cutoffs = _bisect(totals, limit)
    marked = owned.join(cutoffs, "c", "left")
    ties = marked.where(F.col("s") == F.col("cutoff")).select("c", "k", "w", "above")
    kept_ties = _resolve_ties(ties, limit)
    inside = marked.where(F.col("cutoff").isNull() | (F.col("s") != F.col("cutoff"))).select(
        "c", "k", (F.col("cutoff").isNull() | (F.col("s") > F.col("cutoff"))).alias("kept")
    )
    free = rows.where(F.col("c").isNull()).select("c", "k", F.lit(True).alias("kept"))
    out = inside.unionByName(kept_ties).unionByName(free)
    return out.select(F.col("k").alias(key), F.col("c").alias(contributor), "kept")


def _bisect(totals: DataFrame, limit: float) -> DataFrame:
    """(c, cutoff, above): the greatest score at and above which a contributor's weight reaches the limit, and the weight above it.

    Contributors that never reach it are left out: they keep everything.
    """
    bounds = totals.groupBy("c").agg(F.sum("w").alias("total"), F.min("s").alias("lo"), F.max("s").alias("hi"))
    bounds = cut(bounds.where(F.col("total") >= limit).select("c", "lo", "hi"), "cap-bounds")
    while bounds.where("lo < hi").limit(1).count():
        # From lo, which reaches the limit, to hi + 1, which doesn't; the midpoints cut [lo + 1, hi] evenly.
        span = F.col("hi") - F.col("lo")
        mids = [F.col("lo") + F.greatest(F.lit(1), F.floor(span * j / (MIDPOINTS + 1))).cast("long") for j in range(1, MIDPOINTS + 1)]
        mids.append(F.col("hi"))
        open_ = bounds.where("lo < hi").select("c", "lo", "hi", F.array_distinct(F.array(*mids)).alias("mids"))
        seen = totals.join(open_, "c").where(F.col("s") >= F.col("lo"))
        over = [F.sum(F.when(F.col("s") >= F.coalesce(F.get("mids", F.lit(j)), F.lit(1 << 62)), F.col("w")).otherwise(0)) for j in range(MIDPOINTS + 1)]
        sums = seen.groupBy("c", "lo", "hi", "mids").agg(F.array(*over).alias("over"))
        reached = F.expr("filter(mids, (m, i) -> over[i] >= {0})".format(repr(limit)))
        missed = F.expr("filter(mids, (m, i) -> over[i] < {0})".format(repr(limit)))
        narrowed = sums.select(
            "c",
            F.coalesce(F.array_max(reached), F.col("lo")).alias("lo"),
            F.coalesce(F.array_min(missed) - 1, F.col("hi")).alias("hi"),
        )
        bounds = cut(bounds.where("lo >= hi").unionByName(narrowed), "cap-bounds")
    final = bounds.select("c", F.col("lo").alias("cutoff"))
    above = totals.join(final, "c").groupBy("c", "cutoff").agg(F.sum(F.when(F.col("s") > F.col("cutoff"), F.col("w")).otherwise(0)).alias("above"))
    return cut(above, "cap-cutoffs")


def _resolve_ties(ties: DataFrame, limit: float) -> DataFrame:
    """(c, k, kept) of the rows at the cutoff, in order of key while `above` and what precedes stays under the limit.

    Groups over TIE_BLOCK are narrowed by the next character of the key: totals by character tell which characters lie
    wholly before or after the boundary, and only the one that holds it stays open. Whole numbers are written with
    twenty digits for that, so that their characters are in the order of the numbers.
    """
    spelt = F.col("k").cast("string")
    if isinstance(ties.schema["k"].dataType, IntegralType):
        spelt = F.lpad((F.col("k").cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("decimal(20,0)").cast("string"), 20, "0")
    ties = cut(ties, "cap-ties")
    settled: list[DataFrame] = []
    at = 0
    while True:
        sizes = ties.groupBy("c").count().where(F.col("count") > TIE_BLOCK).select("c")
        if not sizes.limit(1).count():
            break
        large = ties.join(sizes, "c", "left_semi").withColumn("ch", F.substring(spelt, at + 1, 1))
        small = ties.join(sizes, "c", "left_anti")
        order = Window.partitionBy("c").orderBy("ch")
        by_char = large.groupBy("c", "ch").agg(F.sum("w").alias("cw"), F.first("above").alias("above"))
        by_char = by_char.select("c", "ch", "cw", (F.col("above") + F.sum("cw").over(order) - F.col("cw")).alias("before"))
        placed = large.drop("above").join(by_char, ["c", "ch"])
        whole = placed.where((F.col("before") >= limit) | (F.col("before") + F.col("cw") < limit))
        settled.append(cut(whole.select("c", "k", (F.col("before") < limit).alias("kept")), "cap-settled"))
        rest = placed.where((F.col("before") < limit) & (F.col("before") + F.col("cw") >= limit))
        ties = cut(small.unionByName(rest.select("c", "k", "w", F.col("before").alias("above"))), "cap-ties")
        at += 1
    order = Window.partitionBy("c").orderBy("k")
    before = F.col("above") + F.sum("w").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("w")
    out = ties.select("c", "k", (before < limit).alias("kept"))
    for part in settled:
        out = out.unionByName(part)
    return out


def thousandths(value: Column) -> Column:
    """A number as whole thousandths, rounded half away from zero on its decimal digits."""
    return F.round(value.cast("double") * 1000).cast("long")
