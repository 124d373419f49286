"""Joins and set operations of a growing corpus: first deliveries, upserts, what is new, what overlaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(rows: DataFrame, key: str, *order: Column | str) -> DataFrame:
    """The first row of each key in the given order. Unlike dropDuplicates, which row that is doesn't depend on the run."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("_r", place).where(F.col("_r") == 1).drop("_r")


def upsert(known: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Known and new rows by key, whole rows of `new` winning; both have one row per key."""
    return known.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def pending(wanted: DataFrame, ready: DataFrame, done: DataFrame, key: str, *, force: bool = False, limit: int | None = None) -> DataFrame:
    """What is wanted, ready and not done (with `force` done or not), the first `limit` by key; 0 or None is no limit."""
    out = wanted.join(ready.select(key).distinct(), key, "left_semi")
    if not force:
        out = out.join(done.select(key).distinct(), key, "left_anti")
    return out.orderBy(key).limit(limit) if limit else out


def first_failure(rows: DataFrame, tests: list[tuple[str, Column]], name: str = "outcome") -> DataFrame:
    """The rows with the name of the first test each fails, "pass" if none; a test that is null fails."""
    out = F.lit("pass")
    for reason, ok in reversed(tests):
        out = F.when(F.coalesce(ok, F.lit(False)), out).otherwise(F.lit(reason))
    return rows.withColumn(name, out)


def interval_overlaps(left: DataFrame, right: DataFrame, *, group: str, start: str, end: str, bucket: float) -> DataFrame:
    """Pairs of intervals of a group that overlap: (group, left's and right's columns as l_ and r_), each pair once.

    Intervals are cut to buckets of fixed width and joined on equality; a pair is kept in the bucket of its later start,
    so that no pair comes out twice and no inequality join is needed.
    """

    def cut_up(df: DataFrame, side: str) -> DataFrame:
        renamed = df.select(F.col(group), *[F.col(c).alias(f"{side}_{c}") for c in df.columns if c != group])
        first, last = (F.floor(F.col(f"{side}_{c}") / bucket) for c in (start, end))
        return renamed.withColumn("_b", F.explode(F.sequence(first, F.greatest(first, last))))

    joined = cut_up(left, "l").join(cut_up(right, "r"), [group, "_b"])
    later = F.greatest(f"l_{start}", f"r_{start}")
    overlap = (F.col(f"l_{start}") < F.col(f"r_{end}")) & (F.col(f"r_{start}") < F.col(f"l_{end}"))
    return joined.where(overlap & (F.col("_b") == F.floor(later / bucket))).drop("_b")
