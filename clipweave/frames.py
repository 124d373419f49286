"""Frames for notebooks: clips with their scores, transcripts, and the final dataset with its splits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipweave.functions import text as T
from clipweave.plans.balance import balance_splits
from clipweave.plans.base import clips, transcripts


def clips_frame(spark: SparkSession, folder: str) -> DataFrame:
    """One row per clip with its scores, null where it has none, and its hours."""
    return clips(spark, folder).withColumn("hours", F.coalesce(F.col("ms"), F.lit(0)) / 3_600_000.0)


def transcripts_frame(spark: SparkSession, folder: str) -> DataFrame:
    """One row per transcript with the length of its clip, null where there is none, and whether it mixes languages."""
    said = transcripts(spark, folder).withColumn("code_switched", T.is_code_switched(F.col("text")))
    return said.join(clips(spark, folder).select("id", "duration", "speaker_id"), "id", "left")


def final_frame(spark: SparkSession, folder: str) -> DataFrame:
    """The final clips of all splits, one below the other, with split; a column that a split lacks is null there."""
    final = balance_splits(spark, folder).join(clips(spark, folder), "id")
    parts = [final.where(F.col("split") == s) for s in ("train", "validation", "test")]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
