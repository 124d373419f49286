"""Waves in and out: WAV content to samples, ranges of it, and clips as binary columns."""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipweave.functions import kernels


def pcm_samples(raw: bytes, width: int, channels: int) -> np.ndarray:
    """Mono samples between -1 and 1 of PCM data: unsigned bytes, or signed whole numbers of 2, 3 or 4 bytes, the lowest first."""
    if width == 1:
        values = np.frombuffer(raw, np.uint8).astype(float) - 128
    elif width == 3:
        parts = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        values = ((parts[:, 2] << 24 | parts[:, 1] << 16 | parts[:, 0] << 8) >> 8).astype(float)
    else:
        values = np.frombuffer(raw, {2: "<i2", 4: "<i4"}[width]).astype(float)
    return values.reshape(-1, channels).mean(axis=1) / float(1 << (8 * width - 1))


def decode_wav(source: bytes | str, start: float = 0.0, end: float | None = None, rate: int | None = None) -> tuple[np.ndarray, int]:
    """Mono samples of [start, end) seconds of a WAV, at `rate` if given. `source` is its content or its path on a file system that all
    workers share; only the frames asked for are read."""
    with wave.open(source if isinstance(source, str) else io.BytesIO(source)) as w:
        own, channels = w.getframerate(), w.getnchannels()
        first = min(int(start * own), w.getnframes())
        w.setpos(first)
        count = w.getnframes() - first if end is None else max(0, int(end * own) - first)
        samples = pcm_samples(w.readframes(count), w.getsampwidth(), channels)
    return (kernels.resampled(samples, own, rate), rate) if rate else (samples, own)


def encode_wav(samples: np.ndarray, rate: int) -> bytes:
    """A mono 16-bit WAV."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(np.clip(np.rint(samples * 32767), -32768, 32767).astype("<i2").tobytes())
    return out.getvalue()


def cut_clips(files: DataFrame, clips: DataFrame, *, loudness: float | None = -20.0, fade_ms: float = 5.0) -> DataFrame:
    """(id, audio, clip_ratio, edge_start_db, edge_end_db) of clips (id, path, start_sec, end_sec) of files (path[, content]).

    A file goes once to the task that cuts all of its clips. Without content the task opens the path, which must be on a
    file system that all workers share, and reads only what is cut. A file that can't be read gives its clips null audio.
    """
    listed = clips.groupBy("path").agg(F.collect_list(F.struct("id", "start_sec", "end_sec")).alias("clips"))  # the clips of one file
    content = F.col("content") if "content" in files.columns else F.lit(None).cast("binary").alias("content")
    joined = files.select("path", content).join(listed, "path")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, content, wanted in zip(b["path"], b["content"], b["clips"]):
                source = bytes(content) if content is not None else path.removeprefix("file://").removeprefix("file:")
                for c in wanted:
                    try:
                        x, rate = decode_wav(source, c["start_sec"], c["end_sec"])
                    except (wave.Error, EOFError, OSError):
                        rows.append((c["id"], None, None, None, None))
                        continue
                    levels = kernels.edge_levels(kernels.frame_db(x, max(1, int(rate * 0.032))))
                    share = kernels.clip_share(x)
                    if loudness is not None and len(x):
                        x = kernels.normalized_loudness(x, rate, loudness)
                    rows.append((c["id"], encode_wav(kernels.faded(x, int(fade_ms * rate / 1000)), rate), share, *levels))
            yield pd.DataFrame(rows, columns=["id", "audio", "clip_ratio", "edge_start_db", "edge_end_db"])

    return joined.mapInPandas(run, "id string, audio binary, clip_ratio double, edge_start_db double, edge_end_db double")
