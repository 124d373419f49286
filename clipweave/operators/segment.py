"""Clips from frame series: a kernel per video where the plan is sequential, plain frames in long form as input."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipweave.functions import kernels as K
from clipweave.operators.timeseries import speech_masks


def planned_clips(frames: DataFrame, *, settings: K.CutSettings = K.CutSettings(), guard_sec: float = 0.3, most_silence_sec: float = 1.5, allow_dips: bool = False) -> DataFrame:
    """(video_id, speaker, start, end, start_cut, end_cut, start_pause, end_pause, speech_ratio, max_internal_silence, weak) of the clips of every video and voice.

    `frames` has a row (video_id, frame, probs, vad, db) per step of `settings.step`, in any order: probs holds the
    probability of each speaker. A video's frames are one group: an hour has 360,000 of them.
    """
    s = settings
    fields = list(K.Clip._fields)

    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("frame")
        diar, vad, db = np.stack(pdf["probs"].to_numpy()), pdf["vad"].to_numpy(), pdf["db"].to_numpy()
        speech, pause = pdf["speech"].to_numpy(bool), pdf["pause"].to_numpy(bool)
        rows = []
        for k in range(diar.shape[1]):
            for region in K.own_regions(diar, speech, k, guard=round(guard_sec / s.step), most_silence=round(most_silence_sec / s.step), pad=round(s.pad / s.step)):
                rows += [(pdf["video_id"].iloc[0], k, *c, c.weak) for c in K.plan_clips(speech, pause, vad, db, region, s, allow_dips=allow_dips)]
        return pd.DataFrame(rows, columns=["video_id", "speaker", *fields, "weak"])

    picked = speech_masks(frames.select("video_id", "frame", "probs", "vad", "db"), keys=["video_id"])
    kinds = ", ".join(f"{f} {'string' if f.endswith('_cut') else 'double'}" for f in fields)
    return picked.groupBy("video_id").applyInPandas(plan, f"video_id string, speaker int, {kinds}, weak boolean")


def split_turns(turns: DataFrame, levels: DataFrame, *, step: float, longest: float = 30.0) -> DataFrame:
    """(video_id, speaker, start, stop) of turns in frames, those over `longest` seconds cut at their quietest places.

    `levels` (video_id, frame, db) joins only the long turns.
    """
    most = int(longest / step)
    long = turns.where(F.col("stop") - F.col("start") > most).select("video_id", "speaker", "start", "stop")
    frames = long.join(levels, "video_id").where((F.col("frame") >= F.col("start")) & (F.col("frame") < F.col("stop")))

    def cut(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("frame")
        first = pdf.iloc[0]
        at = K.quiet_splits(pdf["db"].to_numpy(), step=step, longest=longest)
        edges = [int(first["start"]), *[int(first["start"]) + a for a in at], int(first["stop"])]
        return pd.DataFrame([(first["video_id"], first["speaker"], a, b) for a, b in zip(edges, edges[1:])], columns=["video_id", "speaker", "start", "stop"])

    pieces = frames.groupBy("video_id", "speaker", "start", "stop").applyInPandas(cut, "video_id string, speaker int, start long, stop long")
    return turns.where(F.col("stop") - F.col("start") <= most).select("video_id", "speaker", F.col("start").cast("long"), F.col("stop").cast("long")).unionByName(pieces)


def stitched(windows: DataFrame, *, step: int, overlap: int) -> DataFrame:
    """(video_id, frame, probs) of overlapping windows (video_id, window, probs array of arrays), put together per video."""

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("window")
        whole = K.stitch([np.stack([np.asarray(r, float) for r in p]) for p in pdf["probs"]], step, overlap)
        return pd.DataFrame({"video_id": pdf["video_id"].iloc[0], "frame": np.arange(len(whole)), "probs": list(whole)})

    return windows.groupBy("video_id").applyInPandas(join, "video_id string, frame long, probs array<double>")


def alignment_gate(aligned: DataFrame, *, least_score: float = -3.0, edge: float = 0.03, timed: float = 0.9) -> DataFrame:
    """`aligned` (words, align_score, timed_ratio, duration) with edge_ok and align_ok: the first timed word starts, and the
    last ends, far enough from the clip's edges, the score is high and most words are timed. Without a timed word both are false."""
    known = F.filter("words", lambda w: w["start"].isNotNull())
    inside = (F.try_element_at(known, F.lit(1))["start"] >= edge) & (F.try_element_at(known, F.lit(-1))["end"] <= F.col("duration") - edge)
    ok = F.coalesce(inside, F.lit(False))
    sound = F.coalesce((F.col("align_score") >= least_score) & (F.col("timed_ratio") >= timed), F.lit(False))
    return aligned.withColumn("edge_ok", ok).withColumn("align_ok", ok & sound)


def other_voice(clips: DataFrame, frames: DataFrame, *, frame_sec: float) -> DataFrame:
    """(id, other_spk_max): the highest probability of any other voice in a clip's frames; clips are cut to frames and joined on equality."""
    spread = clips.select("id", "video_id", "local_speaker", F.explode(F.sequence(F.floor(F.col("start_sec") / frame_sec), F.greatest(F.floor(F.col("start_sec") / frame_sec), F.ceil(F.col("end_sec") / frame_sec) - 1))).alias("frame"))
    met = spread.join(frames, ["video_id", "frame"]).where(F.col("speaker") != F.col("local_speaker"))
    return clips.select("id").join(met.groupBy("id").agg(F.max("p").alias("other_spk_max")), "id", "left").na.fill(0.0, ["other_spk_max"])


def probe_windows(videos: DataFrame, *, count: int = 6, seconds: float = 10.0) -> DataFrame:
    """(id, n, start) of windows spread evenly between five and ninety-five hundredths of a length."""
    low = F.col("duration") * 0.05
    high = F.greatest(low, F.col("duration") * 0.95 - seconds)
    spread = videos.where(F.col("duration") > 0).select("id", low.alias("_l"), high.alias("_h"), F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("n"))
    return spread.select("id", "n", F.round(F.col("_l") + (F.col("_h") - F.col("_l")) * F.col("n") / max(1, count - 1), 3).alias("start"))


def validation_split(clips: DataFrame, fraction: float, *, key: str = "id", seed: int = 0) -> DataFrame:
    """`clips` with split: train, or validation for the first floor(n * fraction) in seeded order.

    The order is that of a hash, so the rows are picked by counting hash prefixes first; only those at the boundary are put
    in order.
    """
    from clipweave.operators.select import seeded

    hashed = clips.withColumn("_h", seeded(key, seed=seed)).withColumn("_p", F.substring("_h", 1, 3))
    take = int(clips.count() * fraction + 1e-9)
    counts = hashed.groupBy("_p").count()  # 4,096 prefixes at most
    run = counts.withColumn("_b", F.sum("count").over(Window.orderBy("_p")) - F.col("count"))
    place = F.row_number().over(Window.partitionBy("_p").orderBy("_h", key)) + F.col("_b")
    placed = hashed.join(run.select("_p", "_b"), "_p").withColumn("_r", place)
    return placed.withColumn("split", F.when(F.col("_r") <= take, "validation").otherwise("train")).drop("_h", "_p", "_b", "_r")
