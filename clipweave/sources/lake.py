"""Ledger of what is done, failures, and shards of whole videos."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipweave.operators.joins import upsert


class Ledger:
    """What each step has done: a row per (step, id), appended after the step's own write, so that a step that broke off runs again."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _read(self) -> DataFrame:
        fs_path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        if not fs_path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(fs_path):
            return self.spark.createDataFrame([], "step string, id string")
        return self.spark.read.schema("step string, id string").parquet(self.path)

    def done(self, step: str) -> DataFrame:
        """The ids a step has done."""
        return self._read().where(F.col("step") == step).select("id").distinct()

    def mark(self, step: str, ids: DataFrame) -> None:
        """Note ids as done."""
        ids.select(F.lit(step).alias("step"), F.col("id").cast("string").alias("id")).write.mode("append").parquet(self.path)


def merge_failures(old: DataFrame, new: DataFrame) -> DataFrame:
    """Failures by (step, id), the new ones winning and counting crashes on."""
    key = F.concat_ws("\u0001", "step", "id")
    a, b = old.withColumn("_k", key), new.withColumn("_k", key)
    counts = a.select("_k", F.col("gpu_crashes").alias("_before"))
    b = b.join(counts, "_k", "left").withColumn("gpu_crashes", F.coalesce("gpu_crashes", F.lit(0)) + F.coalesce("_before", F.lit(0))).drop("_before")
    return upsert(a, b, "_k").drop("_k")


def pack_shards(videos: DataFrame, most_bytes: int, *, key: str = "video_id", size: str = "bytes") -> DataFrame:
    """(`key`, shard): whole videos in order of key, a shard closed as soon as it reaches `most_bytes`.

    The count starts anew with every shard, which no window can say; the rows, one per video, are sorted and folded in
    batches by one task. A batch takes up the fill and the shard at which the one before it ended, so that the result is
    that of one fold at every size. Null sizes count as 0.
    """
    kind = videos.schema[key].dataType.simpleString()
    given = videos.select(F.col(key), F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("b"))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fill, no = 0, 1
        for batch in batches:
            shards = []
            for b in batch.column(1).to_pylist():
                shards.append(no)
                fill += b
                if fill >= most_bytes:
                    fill, no = 0, no + 1
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shards, pa.int32())], names=[key, "shard"])

    return given.repartition(1).sortWithinPartitions(key).mapInArrow(fold, f"`{key}` {kind}, shard int")


def write_shards(clips: DataFrame, shards: DataFrame, path: str, key: str = "video_id", *, group_bytes: int = 8 << 20, mode: str = "overwrite") -> None:
    """Clips as Parquet, a folder per shard, each written by one task, sorted by id and in small row groups, which a viewer reads one by one."""
    placed = clips.join(shards, key)
    ordered = placed.repartition("shard").sortWithinPartitions("shard", "id")
    ordered.write.mode(mode).option("parquet.block.size", group_bytes).partitionBy("shard").parquet(path)


def read_vectors(files: DataFrame) -> DataFrame:
    """(path, id, local_speaker, embedding, window_similarity) from the content of NPZ archives of ids, embeddings, similarities and voices.

    A one-off import: `files` (path, content) as `binaryFile` gives them; half-precision values become floats.
    """
    import pandas as pd

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io

        import numpy as np

        for b in batches:
            for path, content in zip(b["path"], b["content"]):
                z = np.load(io.BytesIO(content), allow_pickle=False)
                yield pd.DataFrame({
                    "path": path, "id": z["ids"].astype(str), "local_speaker": z["local_speaker"].astype("int32"),
                    "embedding": list(z["embeddings"].astype("float32")), "window_similarity": z["window_similarity"].astype("float32"),
                })

    return files.select("path", "content").mapInPandas(run, "path string, id string, local_speaker int, embedding array<float>, window_similarity float")
