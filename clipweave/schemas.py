"""Explicit schemas of the entities; JSON lines and Parquet are read with them, never by inference."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BinaryType, BooleanType, DoubleType, FloatType, IntegerType, LongType, StringType, StructField, StructType,
)

_KINDS = {
    "s": StringType(), "d": DoubleType(), "f": FloatType(), "i": IntegerType(), "l": LongType(), "b": BooleanType(), "bin": BinaryType(),
    "[s]": ArrayType(StringType()), "[f]": ArrayType(FloatType()),
}


def _schema(spec: str) -> StructType:
    """A schema from 'kind:name name ...; kind:name ...'."""
    fields = []
    for part in spec.split(";"):
        kind, _, names = part.strip().partition(":")
        fields += [StructField(n, _KINDS[kind]) for n in names.split()]
    return StructType(fields)


SEGMENTS = ArrayType(StructType([StructField("start", DoubleType()), StructField("end", DoubleType()), StructField("speaker", StringType())]))
WORDS = ArrayType(StructType([StructField("word", StringType()), StructField("start", DoubleType()), StructField("end", DoubleType())]))

LINKS = _schema("s:url")
CATALOG = _schema("s:id url title playlist channel channel_id; d:duration; s:live_status")
VIDEOS = _schema("s:id title playlist url path; d:duration; i:sample_rate channels; l:size mtime; s:channel channel_id")
DIAR = _schema("s:video_id; d:frame_sec; i:n_frames n_speakers; d:duration window_sec").add("segments", SEGMENTS)
DIAR_FRAMES = _schema("s:video_id; i:frame speaker; f:p")
CHUNKS = _schema(
    "s:id video_id; i:local_speaker; s:path; d:start_sec end_sec duration; s:source; d:music_db input_lufs clip_ratio; s:start_cut end_cut; "
    "d:start_pause end_pause speech_ratio max_internal_silence; b:weak_cut; d:edge_start_db edge_end_db other_spk_max"
)
QUALITY = _schema("s:id; d:dnsmos_p808 dnsmos_sig dnsmos_bak dnsmos_ovrl utmos")
SPEAKER_EMB = _schema("s:id; i:local_speaker; [f]:embedding; f:window_similarity")
SPEAKERS = _schema("s:id gender; d:gender_confidence hours; i:n_clips n_videos; [s]:videos channels")
ASSIGNMENT = _schema("s:id speaker_id")
TRANSCRIPTS = _schema("s:id text; b:ok; [s]:flags; d:chars_per_sec arabic_ratio; s:backend text_tagged; [s]:tags")
ALIGNED = _schema("s:id").add("words", WORDS).add("align_score", DoubleType()).add("timed_ratio", DoubleType()).add("edge_ok", BooleanType()).add("align_ok", BooleanType())
FAILURES = _schema("s:step id path title error; i:gpu_crashes")
LABELS = _schema("s:clip_id label")
