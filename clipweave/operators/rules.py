"""Rule filters: every clip gets the ordered list of the reasons to reject it; an empty list keeps it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """Reject where the metric lies beyond the limit; equality passes, and a null limit or metric passes."""

    metric: str
    side: str  # "min" or "max"
    limit: float | None
    reason: str

    def broken(self) -> Column | None:
        if self.limit is None:
            return None
        m = F.col(self.metric)
        return m < F.lit(self.limit) if self.side == "min" else m > F.lit(self.limit)


#: The metrics, sides and reasons of the quality rules, in order, with their usual limits.
QUALITY_RULES = (
    Rule("dnsmos_bak", "min", 3.6, "background"),
    Rule("window_similarity", "min", 0.78, "speaker_mix"),
    Rule("dnsmos_sig", "min", None, "signal"),
    Rule("dnsmos_ovrl", "min", None, "overall"),
    Rule("dnsmos_p808", "min", None, "p808"),
    Rule("utmos", "min", None, "naturalness"),
    Rule("speech_ratio", "min", None, "speech_ratio"),
    Rule("clip_ratio", "max", None, "clipping"),
    Rule("edge_db", "max", None, "edge_loudness"),
)


def with_limits(**limits: float | None) -> tuple[Rule, ...]:
    """The quality rules with some limits replaced, by metric."""
    return tuple(Rule(r.metric, r.side, limits.get(r.metric, r.limit), r.reason) for r in QUALITY_RULES)


def edge_db(start: str = "edge_start_db", end: str = "edge_end_db") -> Column:
    """The louder edge; null only if both are."""
    return F.greatest(F.col(start), F.col(end))


def reasons(rules: tuple[Rule, ...], shortest: float | None = None, longest: float | None = None, drop_weak: bool = False, slack: float = 0.05) -> Column:
    """The reasons to reject a row, in order: duration first, then the rules, weak cuts last."""
    tests: list[Column] = []
    if shortest is not None and longest is not None:
        d = F.col("duration")
        tests.append(F.when((d < shortest - slack) | (d > longest + slack), F.lit("duration")))
    for rule in rules:
        broken = rule.broken()
        if broken is not None:
            tests.append(F.when(broken, F.lit(rule.reason)))
    if drop_weak:
        tests.append(F.when(F.col("weak_cut"), F.lit("weak_cut")))
    return F.array_compact(F.array(*tests)) if tests else F.array().cast("array<string>")


def what_if(clips: DataFrame, rules: tuple[Rule, ...], ms: str = "ms") -> DataFrame:
    """One row: clips and milliseconds kept and rejected under a set of rules."""
    kept = F.size(reasons(rules)) == 0
    return clips.agg(
        F.count_if(kept).alias("kept"), F.count_if(~kept).alias("rejected"),
        F.sum(F.when(kept, F.col(ms)).otherwise(0)).alias("kept_ms"), F.sum(F.when(~kept, F.col(ms)).otherwise(0)).alias("rejected_ms"),
    )


def each_alone(clips: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(metric, rejected): what each rule with a limit would reject by itself, in one pass."""
    on = [r for r in rules if r.limit is not None]
    counts = clips.agg(*[F.count_if(r.broken()).alias(r.metric) for r in on])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(r.metric).alias("metric"), F.col(r.metric).alias("rejected")) for r in on])))


def confusion(clips: DataFrame, labels: DataFrame, rules: tuple[Rule, ...], key: str = "id") -> DataFrame:
    """One row: labelled clips, bad ones the rules accept, good ones they reject. Clips labelled both ways don't count."""
    one = labels.groupBy(F.col("clip_id").alias(key)).agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other")
    judged = clips.select(key, (F.size(reasons(rules)) == 0).alias("kept")).join(one, key)
    return judged.agg(
        F.count("*").alias("labelled"), F.count_if((F.col("label") == "bad") & F.col("kept")).alias("bad_accepted"),
        F.count_if((F.col("label") == "good") & ~F.col("kept")).alias("good_rejected"),
    )


def labelled(clips: DataFrame, labels: DataFrame, rules: tuple[Rule, ...], key: str = "id") -> DataFrame:
    """`clips` with kept, whether the rules keep them, and label; a clip labelled both ways or not at all has none."""
    one = labels.groupBy(F.col("clip_id").alias(key)).agg(F.min("label").alias("label"), F.max("label").alias("_other")).where(F.col("label") == F.col("_other")).drop("_other")
    return clips.withColumn("kept", F.size(reasons(rules)) == 0).join(one, key, "left")


def page(judged: DataFrame, *, show: str = "all", metric: str, threshold: float, order: str = "borderline", video: str | None = None, number: int = 0, size: int = 40, key: str = "id", seed: int = 0) -> DataFrame:
    """A page of labelled clips. show: all, labeled, unlabeled, or wrong (decided otherwise than labelled); order: borderline (nearest to the
    threshold), low, high or random. Without the metric clips come last; ties by key."""
    label, kept = F.col("label"), F.col("kept")
    wrong = F.coalesce(((label == "bad") & kept) | ((label == "good") & ~kept), F.lit(False))
    fit = {"all": F.lit(True), "labeled": label.isNotNull(), "unlabeled": label.isNull(), "wrong": wrong}[show]
    if video:
        fit = fit & (F.col("video_id") == video)
    value = F.round(F.col(metric) * 1000).cast("long")
    orders = {
        "borderline": F.round(F.abs(F.col(metric) - threshold) * 1000).cast("long").asc_nulls_last(), "low": value.asc_nulls_last(), "high": value.desc_nulls_last(),
        "random": F.md5(F.concat_ws("\u0001", F.lit(str(seed)), F.col(key).cast("string"))).asc(),
    }
    return judged.where(fit).orderBy(orders[order], key).offset(number * size).limit(size)


def ranges(clips: DataFrame, metrics: list[str]) -> DataFrame:
    """(metric, low, high, known): the range of every metric and how many clips have it, in one pass."""
    one = clips.agg(*[f(m).alias(f"{m}_{n}") for m in metrics for n, f in (("low", F.min), ("high", F.max), ("known", F.count))])
    return one.select(F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), *[F.col(f"{m}_{n}").alias(n) for n in ("low", "high", "known")]) for m in metrics])))
