"""Parquet tables of a corpus folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipweave.session import ship


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of a corpus folder; NTZ time stamps are read as UTC time stamps."""
    ship(spark)
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    ntz = {f.name: F.col(f.name).cast("timestamp") for f in df.schema if f.dataType.typeName() == "timestamp_ntz"}
    return df.withColumns(ntz) if ntz else df


def one_per_key(df: DataFrame, key: str, *columns: str) -> DataFrame:
    """One row per non-null key, holding `columns`. Repeated deliveries agree; should they not, the greatest row is taken."""
    kept = df.where(F.col(key).isNotNull())
    if not columns:
        return kept.select(key).distinct()
    packed = kept.groupBy(key).agg(F.max(F.struct(*columns)).alias("_row"))
    return packed.select(key, *[F.col("_row")[c].alias(c) for c in columns])


def clean_speaker(column: str = "speaker_id") -> Column:
    """A contributor name without outer white space, in upper case; null where nothing is left."""
    outer = r"(?U)^[\s\p{Z}\p{Cf}]+|[\s\p{Z}\p{Cf}]+$"
    return F.nullif(F.upper(F.regexp_replace(F.col(column), outer, "")), F.lit(""))


def usable(column: str, low: float, high: float) -> Column:
    """True where a score is neither null nor NaN and lies in its scale."""
    c = F.col(column)
    return F.coalesce(~F.isnan(c) & c.between(low, high), F.lit(False))
