"""Frame series: runs, single-speaker turns, dilation, moving averages, windows. All in long form, a row per frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def runs(frames: DataFrame, keys: list[str], frame: str = "frame") -> DataFrame:
    """(*keys, start, stop) of the runs of consecutive frames, stop exclusive; frames are distinct within the keys."""
    order = Window.partitionBy(*keys).orderBy(frame)
    island = F.col(frame) - F.row_number().over(order)
    return frames.withColumn("_i", island).groupBy(*keys, "_i").agg(F.min(frame).alias("start"), (F.max(frame) + 1).alias("stop")).drop("_i")


def probability_segments(frames: DataFrame, *, frame_sec: float = 0.08, threshold: float = 0.5, least_sec: float = 0.2) -> DataFrame:
    """(video_id, speaker, start, end) of the runs of frames above the threshold that last long enough, in seconds."""
    found = runs(frames.where(F.col("p") > threshold), ["video_id", "speaker"])
    return found.where((F.col("stop") - F.col("start")) * frame_sec >= least_sec).select(
        "video_id", "speaker", F.round(F.col("start") * frame_sec, 3).alias("start"), F.round(F.col("stop") * frame_sec, 3).alias("end")
    )


def single_speaker_turns(active: DataFrame, *, max_gap: int, pad: int, least: int) -> DataFrame:
    """(video_id, speaker, start, stop, share) of the turns in which one speaker alone is active, in frames.

    `active` has a row (video_id, frame, speaker) for every active speaker of a frame, and a row with a null speaker for
    every silent frame. Runs of a speaker alone merge over gaps of at most `max_gap` frames in which nobody is active;
    turns are padded by at most `pad` frames into silence only, and kept from `least` frames on. share is that of own
    frames in the unpadded turn.
    """
    per_frame = active.groupBy("video_id", "frame").agg(F.count("speaker").alias("cnt"), F.min("speaker").alias("speaker"))
    video = Window.partitionBy("video_id")
    in_video = video.orderBy("frame")
    voiced = per_frame.withColumn("mx", F.max("frame").over(video)).where("cnt > 0").withColumns({
        "before": F.lag("frame").over(in_video), "after": F.lead("frame").over(in_video), "seq": F.row_number().over(in_video),
    })
    alone = voiced.where("cnt = 1")
    own = Window.partitionBy("video_id", "speaker").orderBy("frame")
    # A step of more than one in the count of voiced frames means that someone else spoke in the gap.
    starts = F.lag("frame").over(own).isNull() | (F.col("frame") - F.lag("frame").over(own) - 1 > max_gap) | (F.col("seq") - F.lag("seq").over(own) > 1)
    merged = alone.withColumn("_new", starts.cast("int")).withColumn("_turn", F.sum("_new").over(own))
    turns = merged.groupBy("video_id", "speaker", "_turn").agg(
        F.min("frame").alias("a"), (F.max("frame") + 1).alias("b"), F.count("*").alias("n"), F.min(F.coalesce("before", F.lit(-1))).alias("lo"), F.max(F.coalesce(F.col("after"), F.col("mx") + 1)).alias("hi")
    )
    start, stop = F.greatest(F.col("a") - pad, F.col("lo") + 1), F.least(F.col("b") + pad, F.col("hi"))
    out = turns.select("video_id", "speaker", start.alias("start"), stop.alias("stop"), F.round(F.col("n") / (F.col("b") - F.col("a")), 6).alias("share"))
    return out.where(F.col("stop") - F.col("start") >= least)


def dilate(flag: Column, keys: list[str], frame: str, radius: int) -> Column:
    """Whether a flag is set within `radius` frames; frames may be missing."""
    return F.max(flag.cast("int")).over(Window.partitionBy(*keys).orderBy(frame).rangeBetween(-radius, radius)) == 1


def moving_average(value: Column, keys: list[str], frame: str, width: int) -> Column:
    """The mean of `width` frames about a frame; beyond the ends are zeros, so sums are always divided by the width."""
    back = width // 2
    return F.sum(value).over(Window.partitionBy(*keys).orderBy(frame).rowsBetween(-back, width - 1 - back)) / width


def is_local_minimum(value: Column, keys: list[str], frame: str, radius: int = 15) -> Column:
    """Whether a value is the least within `radius` frames."""
    return value == F.min(value).over(Window.partitionBy(*keys).orderBy(frame).rowsBetween(-radius, radius))


def speech_masks(frames: DataFrame, *, keys: list[str], voiced: float = 0.5, pause: float = 0.35, below_db: float = 25.0) -> DataFrame:
    """`frames` (vad, db) with speech and pause: voiced and not quiet; unvoiced or quiet. Quiet is `below_db` under the
    median level of voiced frames, or under the loudest frame where none is voiced."""
    levels = frames.groupBy(*keys).agg(
        F.percentile(F.when(F.col("vad") > voiced, F.col("db")), 0.5).alias("_mid"), F.max("db").alias("_top")
    )
    quiet = F.col("db") < F.coalesce("_mid", "_top") - below_db
    joined = frames.join(levels, keys)
    return joined.withColumns({"speech": (F.col("vad") > voiced) & ~quiet, "pause": (F.col("vad") < pause) | quiet}).drop("_mid", "_top")


def regrid(series: DataFrame, *, keys: list[str], value: str, frame_sec: float, step_sec: float = 0.01) -> DataFrame:
    """(*keys, frame, value) on another grid: step i takes the frame floor(i * step / frame), the last frame goes on to the end.

    Frames need not be whole multiples of steps: of 32 ms frames on a grid of 10 ms some make three steps and some four,
    so that nothing drifts. Each frame names the steps about it and keeps those that are its own; nothing is joined.
    """
    per = frame_sec / step_sec
    last = F.max("frame").over(Window.partitionBy(*keys))
    first = F.greatest(F.floor(F.col("frame") * per) - 1, F.lit(0))
    spread = series.withColumn("_l", last).select(*keys, F.col("frame").alias("_f"), value, "_l", F.explode(F.sequence(first, F.ceil((F.col("frame") + 1) * per) + 1)).alias("_i"))
    steps = F.round((F.col("_l") + 1) * per)
    own = spread.where((F.col("_i") < steps) & (F.least(F.floor(F.col("_i") * step_sec / frame_sec), F.col("_l")) == F.col("_f")))
    return own.select(*keys, F.col("_i").alias("frame"), value)


def window_cover(videos: DataFrame, *, key: str, duration: str, window: float, overlap: float, frame_sec: float = 0.08) -> DataFrame:
    """(`key`, n, start, end) of the windows that cover a length, each `overlap` into the next; the last ends with it.

    Windows begin and end on frames: window and step are whole numbers of frames, rounded down, at least one.
    """
    frames = max(1, int(window / frame_sec + 1e-9))
    step = max(1, int(frames - overlap / frame_sec + 1e-9)) * frame_sec
    size = frames * frame_sec
    count = 1 + F.greatest(F.lit(0), F.ceil((F.col(duration) - size) / step - 1e-9).cast("int"))
    cut = videos.where(F.col(duration) > 0).select(key, F.col(duration).alias("_d"), F.explode(F.sequence(F.lit(0), count - 1)).alias("n"))
    return cut.select(key, "n", F.round(F.col("n") * step, 3).alias("start"), F.round(F.least(F.col("n") * step + size, F.col("_d")), 3).alias("end"))


def sliding_windows(clips: DataFrame, *, key: str, duration: str, window: float = 3.0, hop: float = 1.5) -> DataFrame:
    """(`key`, start, end) of windows every `hop`, and one that ends with the clip where the last falls short; a shorter clip is one window."""
    count = F.greatest(F.lit(0), F.floor((F.col(duration) - window) / hop + 1e-9).cast("int"))
    starts = F.when(F.col(duration) <= window, F.array(F.lit(0.0))).otherwise(
        F.array_distinct(F.concat(F.transform(F.sequence(F.lit(0), count), lambda i: F.round(i * hop, 3)), F.array(F.round(F.col(duration) - window, 3))))
    )
    out = clips.where(F.col(duration) > 0).select(key, F.col(duration).alias("_d"), F.explode(starts).alias("start"))
    return out.select(key, "start", F.round(F.least(F.col("start") + window, F.col("_d")), 3).alias("end"))
