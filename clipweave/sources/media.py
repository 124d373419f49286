"""Media index: names, headers, reuse of earlier rows, first file of an id."""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Audio files by extension, and marks of files still being written.
EXTENSIONS = ("wav", "flac", "mp3", "m4a", "opus", "ogg", "webm", "mp4", "mkv")
UNFINISHED = (".temp.", ".part", ".ytdl", ".tmp")
NAME = r"^(.*?)\s*\[([A-Za-z0-9_-]{11})\]$"


def list_files(spark: SparkSession, root: str, *, content: bool = False, least_age_sec: float = 0.0) -> DataFrame:
    """(path, modified, size[, content]) of the media files under a folder; hidden and unfinished files are left out, and so are those younger than
    `least_age_sec`, which may still be being written. Without `content` no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    name = F.element_at(F.split("path", "/"), -1)
    fit = F.lower(F.element_at(F.split(name, r"\."), -1)).isin(*EXTENSIONS) & ~name.startswith(".")
    for mark in UNFINISHED:
        fit = fit & ~name.contains(mark)
    if least_age_sec > 0:
        fit = fit & (F.unix_micros(F.current_timestamp()) - F.unix_micros("modificationTime") >= int(least_age_sec * 1_000_000))
    columns = ["path", F.col("modificationTime").alias("modified"), F.col("length").alias("size")]
    return files.where(fit).select(*columns, *(["content"] if content else []))


def enriched(index: DataFrame, catalog: DataFrame) -> DataFrame:
    """`index` with title, channel, channel_id, url and playlist of the catalog, by id, where it has any; empty strings are none."""
    about = catalog.select("id", *[F.nullif(F.col(c), F.lit("")).alias(f"_{c}") for c in ("title", "channel", "channel_id", "url", "playlist")])
    joined = index.join(about, "id", "left")
    for c in ("title", "channel", "channel_id", "url", "playlist"):
        joined = joined.withColumn(c, F.coalesce(F.col(f"_{c}"), F.col(c)) if c in index.columns else F.col(f"_{c}")).drop(f"_{c}")
    return joined


def parsed_name(path: Column) -> dict[str, Column]:
    """id, title, playlist and url of a path relative to the root: "Title [id].ext" in a folder named after the playlist.

    Without an id in brackets it is "f" and ten digits of the path's SHA-1, and there is no url. The folder "NA" and no
    folder are no playlist; of folders in folders the whole way is the name. Two look-alikes that file systems allow in
    titles stand for the characters they replace.
    """
    stem = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")
    given = F.nullif(F.regexp_extract(stem, NAME, 2), F.lit(""))
    title = F.when(given.isNotNull(), F.regexp_extract(stem, NAME, 1)).otherwise(stem)
    folder = F.nullif(F.regexp_replace(path, r"/?[^/]*$", ""), F.lit(""))
    return {
        "id": F.coalesce(given, F.concat(F.lit("f"), F.substring(F.sha1(path.cast("binary")), 1, 10))),
        "title": F.trim(F.translate(title, "⧸｜", "/|")),
        "playlist": F.when(~folder.isin("NA", "."), folder),
        "url": F.when(given.isNotNull(), F.concat(F.lit("https://www.youtube.com/watch?v="), given)),
    }


def probe_headers(files: DataFrame) -> DataFrame:
    """(path, duration, sample_rate, channels, error) from the headers of WAV files; null with an error where there is none to read."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, content in zip(b["path"], b["content"]):
                try:
                    with wave.open(io.BytesIO(content)) as w:
                        rows.append((path, w.getnframes() / w.getframerate(), w.getframerate(), w.getnchannels(), None))
                except (wave.Error, EOFError) as e:
                    rows.append((path, None, None, None, str(e) or "no header"))
            yield pd.DataFrame(rows, columns=["path", "duration", "sample_rate", "channels", "error"]).astype({"sample_rate": "Int32", "channels": "Int32"})

    return files.select("path", "content").mapInPandas(run, "path string, duration double, sample_rate int, channels int, error string")


def settle(described: DataFrame, least_sec: float) -> DataFrame:
    """`described` with outcome: error, duplicate (not the first path of its id), short or ok. Only sound files of enough length claim an id."""
    from pyspark.sql import Window

    claim = F.col("error").isNull() & (F.coalesce("duration", F.lit(0.0)) >= least_sec)
    first = F.min(F.when(claim, F.col("path"))).over(Window.partitionBy("id"))
    earlier = F.coalesce(first < F.col("path"), F.lit(False))
    outcome = F.when(F.col("error").isNotNull(), "error").when(earlier, "duplicate").when(~claim, "short").otherwise("ok")
    return described.withColumn("outcome", outcome)


def incremental(found: DataFrame, previous: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(reused, fresh): rows of the earlier index whose size and time still hold, and the files that must be probed."""
    same = found.alias("f").join(previous.alias("p"), "path")
    kept = same.where((F.col("f.size") == F.col("p.size")) & (F.col("f.mtime") == F.col("p.mtime"))).select("p.*")
    return kept, found.join(kept.select("path"), "path", "left_anti")
