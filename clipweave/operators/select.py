"""Selections: diverse caps, running limits, share caps, seeded samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipweave.operators.order import placed
from clipweave.session import cut


def clip_score(bak: str = "dnsmos_bak", sig: str = "dnsmos_sig", sim: str = "window_similarity") -> Column:
    """Background plus signal plus twice the voice consistency; null counts as 0."""
    zero = F.lit(0.0)
    return F.coalesce(F.col(bak), zero) + F.coalesce(F.col(sig), zero) + 2 * F.coalesce(F.col(sim), zero)


def quality_score(utmos: str = "utmos", ovrl: str = "dnsmos_ovrl", align: str = "align_score", weak: str = "weak_cut") -> Column:
    """Naturalness and overall quality about 3 (missing or 0 counts as 3), alignment about -1, less half a point for weak cuts."""

    def about(c: str) -> Column:
        return F.coalesce(F.nullif(F.col(c), F.lit(0.0)), F.lit(3.0)) - 3

    return about(utmos) + about(ovrl) + 0.5 * (F.coalesce(F.col(align), F.lit(0.0)) + 1) - F.when(F.col(weak), 0.5).otherwise(0.0)


def diverse_cap(clips: DataFrame, cap_ms: int, *, group: str = "speaker_id", video: str = "video_id", key: str = "id", ms: str = "ms", score: str = "score") -> DataFrame:
    """The clips each group keeps up to `cap_ms`, taken in turns from its videos so that no video crowds out the rest.

    Within a video the best come first; videos with more clips are served first in each turn, ties by their best clip.
    The last clip may overshoot. A video's clips beyond its own cap can't be taken and are left out before the sort of
    the whole group: those before them in their video come first in the group too and already fill the cap.
    """
    best_first = [F.desc(score), F.col(key)]
    own = Window.partitionBy(group, video).orderBy(*best_first)
    ranked = clips.withColumns({
        "_turn": F.row_number().over(own),
        "_n": F.count("*").over(Window.partitionBy(group, video)),
        "_own": F.coalesce(F.sum(ms).over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_lead": F.max(score).over(Window.partitionBy(group, video)),
        "_first": F.first(key).over(own),
    })
    few = ranked.where(F.col("_own") < cap_ms)
    turns = Window.partitionBy(group).orderBy("_turn", F.desc("_n"), F.desc("_lead"), "_first")
    before = F.coalesce(F.sum(ms).over(turns.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return few.withColumn("_before", before).where(F.col("_before") < cap_ms).drop("_turn", "_n", "_own", "_lead", "_first", "_before")


def best_until(clips: DataFrame, limit_ms: int, *, group: str, key: str = "id", ms: str = "ms", score: str = "score") -> DataFrame:
    """Of each group the best clips, as long as those before them amount to less than `limit_ms`.

    Totals by group and score, combined before the shuffle, tell each group's score at the limit; only clips of that score are
    put in order, so a group with a third of all clips is never sorted. A group has as many totals as distinct scores.
    """
    known = clips.where(F.col(group).isNotNull())
    totals = known.groupBy(group, score).agg(F.sum(ms).alias("_ms"))
    down = Window.partitionBy(group).orderBy(F.desc(score)).rowsBetween(Window.unboundedPreceding, -1)
    run = totals.withColumn("_above", F.coalesce(F.sum("_ms").over(down), F.lit(0))).where(F.col("_above") < limit_ms)
    edge = run.groupBy(group).agg(F.min_by(F.struct(F.col(score).alias("at"), "_above"), score).alias("_e"))
    marked = known.join(edge, group)
    order = Window.partitionBy(group).orderBy(F.col(key)).rowsBetween(Window.unboundedPreceding, -1)
    last = marked.where(F.col(score) == F.col("_e.at"))
    last = last.withColumn("_b", F.col("_e._above") + F.coalesce(F.sum(ms).over(order), F.lit(0))).where(F.col("_b") < limit_ms).drop("_b")
    return marked.where(F.col(score) > F.col("_e.at")).unionByName(last).drop("_e").select(*clips.columns)


def target_size(clips: DataFrame, limit_ms: int, *, key: str = "id", ms: str = "ms", score: str = "score", step: float = 0.001) -> DataFrame:
    """The best clips of all, as long as those before them amount to less than `limit_ms`; no sort of all rows in one task.

    Totals by score, in steps, find the step in which the limit falls; only the clips of that step are put in order.
    """
    stepped = clips.withColumn("_step", F.floor(F.col(score) / step).cast("long"))
    totals = cut(stepped.groupBy("_step").agg(F.sum(ms).alias("_ms"), F.count("*").alias("_n")), "target-steps")
    run = totals.withColumn("_before", F.sum("_ms").over(Window.orderBy(F.desc("_step"))) - F.col("_ms"))  # one row per step of the score
    edge = run.where(F.col("_before") < limit_ms).agg(F.min_by(F.struct("_step", "_before"), "_step").alias("e")).first()["e"]
    if edge is None:
        return clips.limit(0)
    at = Window.partitionBy("_step").orderBy(F.desc(score), F.col(key)).rowsBetween(Window.unboundedPreceding, -1)
    last = stepped.where(F.col("_step") == edge["_step"]).withColumn("_b", F.lit(edge["_before"]) + F.coalesce(F.sum(ms).over(at), F.lit(0)))
    return stepped.where(F.col("_step") > edge["_step"]).drop("_step").unionByName(last.where(F.col("_b") < limit_ms).drop("_step", "_b"))


def share_cap(totals: DataFrame, share: float, cap_ms: float | None = None, *, ms: str = "ms", rounds: int = 5) -> float:
    """The cap by which no group has more than `share` of what all keep: at most five rounds, ended when it moves less than a second."""
    cap = float("inf") if cap_ms is None else float(cap_ms)
    totals = totals.select(ms).cache()
    for _ in range(rounds):
        kept = totals.agg(F.sum(F.least(F.col(ms).cast("double"), F.lit(cap)))).first()[0] or 0.0
        new = min(cap, share * kept)
        if abs(new - cap) < 1000:
            break
        cap = new
    totals.unpersist()
    return cap


def seeded(*columns: str, seed: int = 0) -> Column:
    """A pseudo-random order that is the same in every engine: the MD5 of the seed and the columns."""
    return F.md5(F.concat_ws("\u0001", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]))


def seeded_sample(rows: DataFrame, n: int, key: str = "id", seed: int = 0) -> DataFrame:
    """`n` rows in seeded order (a top-n, not a sort of everything)."""
    return rows.orderBy(seeded(key, seed=seed), key).limit(n)


def sample_per_reason(clips: DataFrame, n: int, key: str = "id", seed: int = 0) -> DataFrame:
    """(`key`, reason): `n` seeded clips of each reason to reject, and of those kept, as reason "kept"."""
    named = clips.select(key, F.explode(F.when(F.size("reasons") == 0, F.array(F.lit("kept"))).otherwise(F.col("reasons"))).alias("reason"))
    order = Window.partitionBy("reason").orderBy(seeded(key, seed=seed), key)
    return named.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= n).drop("_r")


def test_speakers(totals: DataFrame, n: int, *, speaker: str = "speaker_id", ms: str = "ms", gender: str = "gender", least_ms: int = 180_000, seed: int = 0) -> DataFrame:
    """Speakers held out for testing: of the middle half by size, in seeded order, genders in turn, at most all but one.

    `totals` has one row per speaker. Places by size are counted in blocks; of each gender only the first `n` in seeded order
    can be taken, so no task orders all speakers.
    """
    pool, size = placed(totals.where(F.col(ms) >= least_ms), ms, speaker)
    low, high = size // 4, 3 * size // 4
    middle = pool if low >= high else pool.where((F.col("_place") > low) & (F.col("_place") <= high))
    turn = F.row_number().over(Window.partitionBy(gender).orderBy(seeded(speaker, seed=seed), speaker))
    first = middle.withColumn("_turn", turn).where(F.col("_turn") <= n)
    return first.orderBy("_turn", gender, speaker).limit(max(0, min(n, size - 1))).select(speaker)
