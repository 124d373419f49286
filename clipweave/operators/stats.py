"""Aggregates: speaker statistics, shares, inequality, histograms, boxes, funnels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipweave.operators.order import placed


def hours(ms: str = "ms", digits: int = 6) -> Column:
    """Summed milliseconds in hours; null counts as 0."""
    return F.round(F.sum(F.coalesce(F.col(ms), F.lit(0))) / 3_600_000.0, digits)


def speaker_stats(clips: DataFrame, speaker: str = "speaker_id", ms: str = "ms") -> DataFrame:
    """One row over speakers (null is "?"): count, hours, mean, median, least and most."""
    per = clips.groupBy(F.coalesce(F.col(speaker), F.lit("?")).alias("s")).agg(F.sum(F.coalesce(F.col(ms), F.lit(0))).alias("ms"))
    zero = F.lit(0.0)
    h = 3_600_000.0
    return per.agg(
        F.count("*").alias("speakers"), F.round(F.coalesce(F.sum("ms"), F.lit(0)) / h, 6).alias("hours"), F.round(F.coalesce(F.sum("ms") / F.count("*"), zero) / h, 6).alias("mean_h"),
        F.round(F.coalesce(F.percentile("ms", 0.5), zero) / h, 6).alias("median_h"), F.round(F.coalesce(F.min("ms"), F.lit(0)) / h, 6).alias("min_h"), F.round(F.coalesce(F.max("ms"), F.lit(0)) / h, 6).alias("max_h"),
    )


def by_gender(clips: DataFrame, speaker: str = "speaker_id", gender: str = "gender", ms: str = "ms") -> DataFrame:
    """(gender, speakers, hours); a speaker has the gender most often given, ties by name, null is "?"."""
    votes = clips.groupBy(F.coalesce(F.col(speaker), F.lit("?")).alias("s"), F.coalesce(F.col(gender), F.lit("?")).alias("g")).agg(F.count("*").alias("n"), F.sum(F.coalesce(F.col(ms), F.lit(0))).alias("ms"))
    per = votes.groupBy("s").agg(F.max_by("g", F.struct("n", "g")).alias("gender"), F.sum("ms").alias("ms"))
    return per.groupBy("gender").agg(F.count("*").alias("speakers"), hours().alias("hours"))


def reject_counts(clips: DataFrame) -> DataFrame:
    """(reason, clips): a clip counts once for each of its reasons."""
    return clips.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("clips"))


def gini(values: DataFrame, column: str) -> DataFrame:
    """One row: the Gini coefficient, 0 for nothing or all zero. Equal values share their mean rank, so totals by value
    are enough; the order is over distinct values, not rows."""
    per = values.groupBy(F.col(column).alias("v")).agg(F.count("*").alias("c"))
    order = Window.orderBy("v")
    run = per.withColumn("upto", F.sum("c").over(order))
    # The ranks upto - c + 1 .. upto of a value sum to c * (2 * upto - c + 1) / 2.
    total = run.agg(
        F.sum(F.col("v") * F.col("c") * (2 * F.col("upto") - F.col("c") + 1)).alias("ranked"), F.sum(F.col("v") * F.col("c")).alias("sum"), F.sum("c").alias("n")
    )
    value = (F.col("ranked") - (F.col("n") + 1) * F.col("sum")) / (F.col("n") * F.nullif(F.col("sum"), F.lit(0)))
    return total.select(F.round(F.coalesce(value, F.lit(0.0)), 6).alias("gini"))


def lorenz(groups: DataFrame, key: str, column: str) -> DataFrame:
    """(`key`, place, share): cumulative share of the total, the smallest first, ties by key; sums run in blocks of values."""
    ordered, _ = placed(groups, column, key)
    total = groups.agg(F.sum(column)).first()[0]
    return ordered.select(key, F.col("_place").alias("place"), F.round(F.col("_running") / F.nullif(F.lit(total), F.lit(0)), 6).alias("share"))


def histogram(rows: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """(bin, n) of `bins` equal bins over the range of non-null values, the greatest value in the last; a range of 0 has width 1."""
    known = rows.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("x"))
    low, high = known.agg(F.min("x"), F.max("x")).first()
    low, high = low or 0.0, high or 0.0
    width = high - low if high > low else 1.0
    place = F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor((F.col("x") - low) / width * bins)))
    return known.groupBy(place.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def boxes(stages: dict[str, DataFrame], metrics: list[str]) -> DataFrame:
    """(stage, metric, q1, median, q3) of every metric in every stage, by linear interpolation."""
    out = None
    for stage, df in stages.items():
        melted = df.select([F.col(m).cast("double").alias(m) for m in metrics]).unpivot([], metrics, "metric", "value").where(F.col("value").isNotNull())
        q = melted.groupBy(F.lit(stage).alias("stage"), "metric").agg(F.percentile("value", [0.25, 0.5, 0.75]).alias("q"))
        q = q.select("stage", "metric", *[F.round(F.col("q")[i], 5).alias(n) for i, n in enumerate(("q1", "median", "q3"))])
        out = q if out is None else out.unionByName(q)
    return out


def flag_funnel(rows: DataFrame, stages: dict[str, Column], ms: str = "ms") -> DataFrame:
    """(stage, clips, hours) of the rows that are in each stage, by one aggregate; a null flag is no."""
    length = F.coalesce(F.col(ms), F.lit(0))
    counts = [F.count_if(F.coalesce(c, F.lit(False))).alias(f"n_{s}") for s, c in stages.items()]
    sums = [F.sum(F.when(c, length).otherwise(0)).alias(f"ms_{s}") for s, c in stages.items()]
    out = [F.struct(F.lit(s).alias("stage"), F.col(f"n_{s}").alias("clips"), F.round(F.coalesce(F.col(f"ms_{s}"), F.lit(0)) / 3_600_000.0, 6).alias("hours")) for s in stages]
    return rows.agg(*counts, *sums).select(F.inline(F.array(*out)))


def crosstab(rows: DataFrame, a: str, b: str, values: list[str]) -> DataFrame:
    """Counts of `a` by the given values of `b`, as columns; absent pairs are 0."""
    return rows.groupBy(a).pivot(b, values).count().na.fill(0)


def top_counts(rows: DataFrame, column: str, k: int) -> DataFrame:
    """(column, n) of the k most frequent values, ties by value."""
    return rows.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(k)


def top_hours(rows: DataFrame, column: str, k: int, ms: str = "ms") -> DataFrame:
    """(column, hours) of the k values with most hours, ties by value; nulls are left out."""
    per = rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.sum(F.coalesce(F.col(ms), F.lit(0))).alias("_ms"))
    return per.orderBy(F.desc("_ms"), column).limit(k).select(column, F.round(F.col("_ms") / 3_600_000.0, 6).alias("hours"))


def before_and_after(before: DataFrame, after: DataFrame, column: str, k: int, ms: str = "ms") -> DataFrame:
    """(column, before, after): hours of the k values that had most, and what they have now, null if nothing."""
    top = top_hours(before, column, k, ms).withColumnRenamed("hours", "before")
    now = after.groupBy(column).agg(hours(ms).alias("after"))
    return top.join(now, column, "left")


def cluster_report(speakers: DataFrame, ms: str = "ms", gender: str = "gender") -> DataFrame:
    """(gender, speakers, hours, share, mean_h, median_h, min_minutes, max_h, five_minutes, one_hour, ten_hours) for all speakers, as "all", and by gender.

    `speakers` has one row each; the last three count those with so much at least.
    """
    h = 3_600_000.0
    spread = speakers.select(F.explode(F.array(F.lit("all"), F.coalesce(F.col(gender), F.lit("?")))).alias("gender"), F.col(ms).alias("ms"))
    facts = spread.groupBy("gender").agg(
        F.count("*").alias("speakers"), F.sum("ms").alias("_ms"), F.percentile("ms", 0.5).alias("_mid"), F.min("ms").alias("_low"), F.max("ms").alias("_top"),
        *[F.count_if(F.col("ms") >= least).alias(name) for name, least in (("five_minutes", 300_000), ("one_hour", 3_600_000), ("ten_hours", 36_000_000))],
    )
    total = speakers.agg(F.sum(ms)).first()[0] or 1
    return facts.select(
        "gender", "speakers", F.round(F.col("_ms") / h, 6).alias("hours"), F.round(F.col("_ms") / total, 6).alias("share"), F.round(F.col("_ms") / F.col("speakers") / h, 6).alias("mean_h"),
        F.round(F.col("_mid") / h, 6).alias("median_h"), F.round(F.col("_low") / 60_000.0, 6).alias("min_minutes"), F.round(F.col("_top") / h, 6).alias("max_h"), "five_minutes", "one_hour", "ten_hours",
    )


def corpus_stats(clips: DataFrame, metrics: list[str], ms: str = "ms") -> DataFrame:
    """(name, value): clips, hours, distinct speakers, videos and channels, length and means of metrics, all in one pass."""
    sec = F.col(ms) / 1000.0
    wanted = {
        "clips": F.count("*").cast("double"), "hours": F.sum(F.coalesce(F.col(ms), F.lit(0))) / 3_600_000.0, "speakers": F.count_distinct("speaker_id").cast("double"), "videos": F.count_distinct("video_id").cast("double"),
        "channels": F.count_distinct("channel").cast("double"), "mean_sec": F.avg(sec), "median_sec": F.percentile(sec, 0.5), "min_sec": F.min(sec), "max_sec": F.max(sec), **{f"mean_{m}": F.avg(m) for m in metrics},
    }
    one = clips.agg(*[e.alias(n) for n, e in wanted.items()])
    return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("name"), F.round(F.col(n), 4).alias("value")) for n in wanted])))


def largest_share(groups: DataFrame, ms: str = "ms") -> DataFrame:
    """One row: the greatest group's share of all."""
    return groups.agg(F.round(F.max(ms) / F.nullif(F.sum(ms), F.lit(0)), 6).alias("share"))


def step_status(items: DataFrame, steps: dict[str, DataFrame], key: str = "id", ms: str = "ms") -> DataFrame:
    """(step, done, total, hours): of all items how many each step has done, and their hours; one left join and one pass."""
    marked = items
    for name, done in steps.items():
        marked = marked.join(done.select(F.col(key)).distinct().withColumn(f"_{name}", F.lit(True)), key, "left")
    length = F.coalesce(F.col(ms), F.lit(0))
    sums = marked.agg(F.count("*").alias("total"), *[F.count(f"_{n}").alias(f"n_{n}") for n in steps], *[F.sum(F.when(F.col(f"_{n}"), length).otherwise(0)).alias(f"ms_{n}") for n in steps])
    rows = [F.struct(F.lit(n).alias("step"), F.col(f"n_{n}").alias("done"), F.col("total"), F.round(F.col(f"ms_{n}") / 3_600_000.0, 6).alias("hours")) for n in steps]
    return sums.select(F.inline(F.array(*rows)))


def speaker_rollup(clips: DataFrame, speaker: str = "speaker_id", video: str = "video_id", channel: str = "channel", ms: str = "ms") -> DataFrame:
    """Per speaker: hours, clips, distinct videos and channels, and the channels by name."""
    known = clips.where(F.col(speaker).isNotNull())
    return known.groupBy(speaker).agg(
        hours(ms).alias("hours"), F.count("*").alias("n_clips"), F.count_distinct(video).alias("n_videos"), F.count_distinct(channel).alias("n_channels"), F.array_join(F.sort_array(F.collect_set(channel)), "|").alias("channels")
    )


def numbered(groups: DataFrame, prefix: str, order_by: str, key: str) -> DataFrame:
    """`groups` with a name made of the upper-case `prefix` column and a number of five digits, the largest first within a prefix."""
    place = F.row_number().over(Window.partitionBy(prefix).orderBy(F.desc(order_by), F.col(key)))
    return groups.withColumn("name", F.format_string("%s_%05d", F.upper(F.col(prefix)), place))


def polynomial(value: Column, coefficients: tuple[float, ...]) -> Column:
    """A polynomial of a value, highest power first, as a sum of powers."""
    out = F.lit(0.0)
    for power, c in zip(range(len(coefficients) - 1, -1, -1), coefficients):
        term = F.lit(c)
        for _ in range(power):
            term = term * value
        out = out + term
    return out
