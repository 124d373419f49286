"""JSON lines, link lists and plain documents."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clipweave.operators.joins import keep_first


def read_jsonl(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of a file or folder of JSON lines; a missing path gives no rows, blank lines are skipped, bad lines are null rows left out."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jvm_path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path).dropna("all")


def write_jsonl(rows: DataFrame, path: str) -> None:
    """Write rows as JSON lines, by the commit protocol, in place of what was there."""
    rows.write.mode("overwrite").json(path)


def read_links(spark: SparkSession, path: str) -> DataFrame:
    """(url, place) of a list of links: trimmed, without blanks and comments, each once at its first place."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("place", "line"))
    links = lines.select("place", F.trim("line").alias("url")).where((F.col("url") != "") & ~F.col("url").startswith("#"))
    return keep_first(links, "url", "place").select("url", "place")


def discover(entries: DataFrame) -> DataFrame:
    """Each id once, from the first link and place it was found at."""
    return keep_first(entries, "id", "link_place", "entry_place")


def read_document(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    """JSON documents, one to a file, over as many lines as they like: a row each, or one for each element of a list."""
    reader = spark.read.option("multiLine", "true")
    return (reader.schema(schema) if schema else reader).json(path)


def write_document(rows: DataFrame, path: str) -> int:
    """Few rows as one JSON document that replaces an older one in one step; returns their number. For reports, not for tables."""
    import json
    import os

    data = [json.loads(r) for r in rows.toJSON().collect()]
    with open(f"{path}.tmp", "w", encoding="utf-8") as f:
        json.dump(data, f, ensure_ascii=False, indent=1)
    os.replace(f"{path}.tmp", path)
    return len(data)


def expand_links(links: DataFrame, provider: Callable[[str], list[dict]], *, depth: int = 1) -> DataFrame:
    """(url, link_place, entry_place, id, title, duration, live_status) of what links stand for, for `discover`.

    A link stands for a video or for the entries of a list, of lists within lists down to `depth`. Only ids of eleven
    characters count. `provider` gives the entries of a url, each a mapping with id, or with url and list for a list
    within; it runs in tasks, and a link for which it fails gives nothing but a line in the log. `links` has (url, place).
    """
    fields = ("title", "duration", "live_status")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def entries(url: str, left: int) -> Iterator[dict]:
            for e in provider(url):
                if e.get("list"):
                    yield from entries(e["url"], left - 1) if left > 0 else ()
                elif len(e.get("id") or "") == 11:
                    yield e

        for b in batches:
            rows = []
            for url, place in zip(b["url"], b["place"]):
                try:
                    rows += [(url, place, i, e["id"], *(e.get(f) for f in fields)) for i, e in enumerate(entries(url, depth))]
                except Exception as error:  # noqa: BLE001 - a bad link must not end the rest
                    logging.getLogger(__name__).warning("%s: %s", url, error)
            out = pd.DataFrame(rows, columns=["url", "link_place", "entry_place", "id", *fields])
            yield out.astype({"link_place": "int64", "entry_place": "int64", "duration": "float64"})

    given = links.select("url", F.col("place").cast("long").alias("place"))
    return given.mapInPandas(run, "url string, link_place bigint, entry_place bigint, id string, title string, duration double, live_status string")
