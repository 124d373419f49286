"""Signal kernels over array columns: a wave or a level series per row, in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipweave.functions import kernels as K


def per_wave(rows: DataFrame, key: str, columns: list[str], kernel: Callable[..., list[tuple]], outputs: str) -> DataFrame:
    """(`key`, outputs) of the tuples a kernel gives for the arrays of a row; rows with a null array are left out."""
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [key, *[c.split()[0] for c in outputs.split(", ")]]
        for b in batches:
            out = [(k, *t) for k, *waves in zip(b[key], *[b[c] for c in columns]) for t in kernel(*(np.asarray(w, float) for w in waves))]
            yield pd.DataFrame(out, columns=names)

    given = rows.where(" AND ".join(f"`{c}` IS NOT NULL" for c in columns)).select(key, *columns)
    return given.mapInPandas(run, f"`{key}` {kind}, {outputs}")


def frame_levels(rows: DataFrame, *, key: str, wave: str, frame: int) -> DataFrame:
    """(`key`, frame, db): the smoothed level of every frame of a wave."""
    return per_wave(rows, key, [wave], lambda w: list(enumerate(K.frame_db(w, frame).tolist())), "frame bigint, db double")


def edge_levels(rows: DataFrame, *, key: str, wave: str, frame: int) -> DataFrame:
    """(`key`, edge_start_db, edge_end_db) of every wave."""
    return per_wave(rows, key, [wave], lambda w: [K.edge_levels(K.frame_db(w, frame))], "edge_start_db double, edge_end_db double")


def music_levels(rows: DataFrame, *, key: str, mixed: str, vocal: str) -> DataFrame:
    """(`key`, music_db): what a scaled vocal leaves of the mix."""
    return per_wave(rows, key, [mixed, vocal], lambda m, v: [(K.music_db(m, v),)], "music_db double")


def faded(rows: DataFrame, *, key: str, wave: str, k: int) -> DataFrame:
    """(`key`, at, x): the samples of every wave after fades of `k` samples at both ends."""
    return per_wave(rows, key, [wave], lambda w: list(enumerate(K.faded(w, k).tolist())), "at bigint, x double")


def clip_shares(rows: DataFrame, *, key: str, wave: str, limit: float = 0.999) -> DataFrame:
    """(`key`, clip_ratio): the share of samples at the limit, without leaving the JVM."""
    return rows.where(F.col(wave).isNotNull()).select(key, (F.size(F.filter(wave, lambda x: F.abs(x.cast("double")) >= limit)) / F.greatest(F.size(wave), F.lit(1))).alias("clip_ratio"))


def unit_vectors(rows: DataFrame, *, key: str, vector: str) -> DataFrame:
    """(`key`, at, x): vectors at unit length; an all-zero vector stays as it is."""
    length = F.sqrt(F.aggregate(F.col(vector), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))) + 1e-9
    return rows.where(F.col(vector).isNotNull()).select(key, length.alias("_l"), F.posexplode(vector).alias("at", "_x")).select(key, F.col("at").cast("long").alias("at"), (F.col("_x").cast("double") / F.col("_l")).alias("x"))


def pause_places(frames: DataFrame, *, least: int, strong: int, key: str = "video_id") -> DataFrame:
    """(`key`, at, quality, length) of the places to cut in the pauses inside every series (`key`, frame, pause, db), by one kernel per series."""
    kind = frames.schema[key].dataType.simpleString()

    def places(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("frame")
        found = K.pause_cuts(pdf["pause"].to_numpy(bool), pdf["db"].to_numpy(), least=least, strong=strong)
        first = int(pdf["frame"].iloc[0])
        return pd.DataFrame([(pdf[key].iloc[0], first + at, quality, n) for at, quality, n in found], columns=[key, "at", "quality", "length"])

    return frames.select(key, "frame", "pause", "db").groupBy(key).applyInPandas(places, f"`{key}` {kind}, at bigint, quality double, length bigint")
