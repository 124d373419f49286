"""Putting clips together from the tables of several steps, and taking whole videos in and out of shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: The columns of a shard, in order, apart from the audio struct in front.
SHARD_COLUMNS = (
    "id string, duration float, speaker_id string, gender string, video_id string, video_title string, playlist string, channel string, local_speaker int, start double, end double, "
    "source string, music_db float, input_lufs float, clip_ratio float, start_cut string, end_cut string, start_pause float, end_pause float, speech_ratio float, max_internal_silence float, "
    "weak_cut boolean, edge_start_db float, edge_end_db float, other_spk_max float, dnsmos_p808 float, dnsmos_sig float, dnsmos_bak float, dnsmos_ovrl float, utmos float, "
    "window_similarity float, speaker_embedding array<float>"
)
#: Columns of a shard that a pull keeps in tables of their own, not with the clips.
QUALITY = ("dnsmos_p808", "dnsmos_sig", "dnsmos_bak", "dnsmos_ovrl", "utmos")
NOT_OF_CLIPS = (*QUALITY, "video_title", "playlist", "channel", "speaker_id", "gender", "speaker_embedding", "window_similarity")
#: The published columns, in order, apart from the audio in front.
PUBLISHED = (
    "id", "text", "text_tagged", "tags", "duration", "speaker_id", "gender", "code_switched", "words", "channel", "video_id", "video_url", "start", "end", "source", "dnsmos_ovrl", "dnsmos_sig",
    "dnsmos_bak", "utmos", "align_score", "asr_backend",
)


def merged_columns(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """The join by `key` with the right side's values where both have a column; in an outer join the left's where the right has no row."""
    twice = [c for c in right.columns if c != key and c in left.columns]
    there = right.select(F.col(key), *[F.col(c).alias(f"_{c}" if c in twice else c) for c in right.columns if c != key], F.lit(True).alias("_there"))
    joined = left.join(there, key, how)
    names = list(dict.fromkeys([*left.columns, *right.columns]))
    return joined.select(*[F.when(F.col("_there"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in twice else F.col(c) for c in names])


def joined_clips(clips: DataFrame, quality: DataFrame, similarity: DataFrame, *, key: str = "id", video: str = "video_id") -> DataFrame:
    """Clips with their quality and voice consistency, of the videos for which all three have been written; one join, two left out."""
    scored = merged_columns(merged_columns(clips, quality, key), similarity, key)
    done = [t.join(clips.select(key, video), key).select(video).distinct() for t in (quality, similarity)]
    return scored.join(done[0], video, "left_semi").join(done[1], video, "left_semi").select(*scored.columns)


def named_clips(clips: DataFrame, assignment: DataFrame, speakers: DataFrame, *, key: str = "id") -> DataFrame:
    """`clips` with speaker_id and gender by two lookups: of the clip in `assignment` (`key`, speaker_id), of that in `speakers` (speaker_id, gender)."""
    return clips.drop("speaker_id", "gender").join(assignment.select(key, "speaker_id"), key, "left").join(speakers.select("speaker_id", "gender"), "speaker_id", "left")


def hub_rows(clips: DataFrame, quality: DataFrame, similarity: DataFrame, assignment: DataFrame, speakers: DataFrame, videos: DataFrame) -> DataFrame:
    """Rows of shards in their fixed schema: clips with an embedding, quality and names where there are any; absent columns are null."""
    whole = merged_columns(clips.join(similarity, "id"), quality, "id", "left")
    about = videos.select(F.col("id").alias("video_id"), F.col("title").alias("video_title"), "playlist", "channel")
    rows = named_clips(whole.drop("video_title", "playlist", "channel"), assignment, speakers).join(about, "video_id", "left")
    schema = StructType.fromDDL(SHARD_COLUMNS)
    return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def clips_of_shards(rows: DataFrame) -> DataFrame:
    """The clips' own columns of pulled rows."""
    return rows.drop(*NOT_OF_CLIPS)


def imported_quality(rows: DataFrame, *, video: str = "video_id") -> DataFrame:
    """(id, quality columns) of the videos all rows of which have a background score; others are scored anew."""
    whole = rows.groupBy(video).agg(F.bool_and(F.col("dnsmos_bak").isNotNull()).alias("_ok")).where("_ok")
    return rows.join(whole, video, "left_semi").select("id", *QUALITY)


def download_plan(found: DataFrame, have: DataFrame, *, least_sec: float, most_sec: float, skip_live: bool = True, force: bool = False) -> DataFrame:
    """(id, status): what happens to every found video: have, live, length or todo, in this order; a length of null or 0 is none."""
    marked = found.join(have.select("id").distinct().withColumn("_have", F.lit(True)), "id", "left")
    length = F.coalesce(F.col("duration"), F.lit(0.0))
    status = F.when(F.col("_have") & F.lit(not force), "have").when(F.lit(skip_live) & F.col("live_status").isin("is_live", "is_upcoming"), "live")
    return marked.select("id", status.when((length != 0) & ~length.between(least_sec, most_sec), "length").otherwise("todo").alias("status"))


def without_broken(pending: DataFrame, failures: DataFrame, *, step: str, most_crashes: int = 2) -> DataFrame:
    """What is pending but for what has broken a step so often already."""
    broken = failures.where((F.col("step") == step) & (F.col("gpu_crashes") >= most_crashes)).select("id")
    return pending.join(broken, "id", "left_anti")


def manifest(clips: DataFrame, shards: DataFrame, *, video: str = "video_id", ms: str = "ms", first: int = 0, per_commit: int = 4) -> DataFrame:
    """(shard, commit, videos, clips, hours) of packed shards, numbered from `first` on, so many to a commit."""
    placed = clips.join(shards, video)
    facts = placed.groupBy("shard").agg(F.count_distinct(video).alias("videos"), F.count("*").alias("clips"), F.round(F.sum(F.coalesce(F.col(ms), F.lit(0))) / 3_600_000.0, 6).alias("hours"))
    number = F.col("shard") - 1
    return facts.select((number + first).cast("int").alias("shard"), F.floor(number / per_commit).cast("int").alias("commit"), "videos", "clips", "hours")


def to_push(clips: DataFrame, pushed: DataFrame, *, video: str = "video_id", force: bool = False, limit: int | None = None) -> DataFrame:
    """The videos that have clips and no shard yet (with `force` all of them), the first `limit` by id; 0 or None is no limit."""
    have = clips.where(F.col(video).isNotNull()).select(video).distinct()
    out = have if force else have.join(pushed.select(video), video, "left_anti")
    return out.orderBy(video).limit(limit) if limit else out


def shard_names(index: Column) -> Column:
    """The name of a shard's file."""
    return F.format_string("part-%05d.parquet", index)


def pulled_speakers(assigned: DataFrame, clips: DataFrame, *, ms: str = "ms") -> DataFrame:
    """(speaker_id, gender, hours, n_clips, videos) of pulled clips; the gender is that of the speaker's last clip by id."""
    known = assigned.where(F.col("speaker_id").isNotNull()).join(clips.select("id", "video_id", ms), "id")
    return known.groupBy("speaker_id").agg(
        F.max_by("gender", "id").alias("gender"), F.round(F.sum(F.coalesce(F.col(ms), F.lit(0))) / 3_600_000.0, 4).alias("hours"), F.count("*").alias("n_clips"), F.sort_array(F.collect_set("video_id")).alias("videos")
    )


def published_rows(clips: DataFrame) -> DataFrame:
    """The published columns: tagged text falls back to the plain one, missing tags are none, words hold word, start and end only."""
    own = {
        "text_tagged": F.coalesce(F.nullif(F.col("text_tagged"), F.lit("")), F.col("text")),
        "tags": F.coalesce(F.col("tags"), F.array().cast("array<string>")),
        "words": F.transform("words", lambda w: F.struct(w["word"].alias("word"), w["start"].alias("start"), w["end"].alias("end"))),
    }
    return clips.select(*[own.get(c, F.col(c)).alias(c) for c in PUBLISHED])


def release_name(base: str, clips: DataFrame, ms: str = "ms") -> DataFrame:
    """One row: the name of a release, its hours rounded to the nearest whole, halves to the even."""
    return clips.agg(F.concat(F.lit(f"{base}-"), F.bround(F.coalesce(F.sum(ms), F.lit(0)) / 3_600_000.0).cast("long"), F.lit("h")).alias("name"))


def diarized_minutes(segments: DataFrame, *, video: str = "video_id") -> DataFrame:
    """(`video`, speaker, minutes) of arrays of segments."""
    return segments.select(video, F.inline("segments")).groupBy(video, "speaker").agg(F.round(F.sum(F.round((F.col("end") - F.col("start")) * 1000).cast("long")) / 60_000.0, 6).alias("minutes"))


def window_means(windows: DataFrame, metrics: list[str], *, key: str = "id") -> DataFrame:
    """(`key`, metrics): the mean of every metric over a clip's windows."""
    return windows.groupBy(key).agg(*[F.avg(m).alias(m) for m in metrics])


def separation(levels: DataFrame, *, threshold: float, key: str = "id") -> DataFrame:
    """(`key`, separate): whether the loudest probed music of a video passes the threshold."""
    return levels.groupBy(key).agg((F.max("music_db") > threshold).alias("separate"))


def source_choice(music_db: Column, separated: Column, threshold: float) -> Column:
    """Which audio a clip is cut from: the vocals where music was taken out, the original where there was (almost) none."""
    return F.when(separated & (music_db > threshold), "vocals").otherwise("original")


def gender_votes(clips: DataFrame, *, speaker: str = "speaker_id", samples: int = 8, seed: int = 0, key: str = "id", ms: str = "ms", female: str = "p_female") -> DataFrame:
    """(`speaker`, gender, confidence) by the mean of a scorer's probabilities over `samples` of the longest 4 * `samples` clips in seeded order."""
    from clipweave.operators.select import seeded

    own = Window.partitionBy(speaker)
    longest = clips.where(F.col(speaker).isNotNull()).withColumn("_r", F.row_number().over(own.orderBy(F.desc(ms), key))).where(F.col("_r") <= 4 * samples)
    drawn = longest.withColumn("_d", F.row_number().over(own.orderBy(seeded(key, seed=seed), key))).where(F.col("_d") <= samples)
    p = F.avg(female)
    voted = drawn.groupBy(speaker).agg(p.alias("_p"))
    return voted.select(speaker, F.when(F.col("_p") >= 0.5, "female").otherwise("male").alias("gender"), F.round(F.abs(F.col("_p") - 0.5) * 2, 3).alias("confidence"))
