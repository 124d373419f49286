"""Sessions, shared scratch storage and lineage cuts."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_local_scratch: str | None = None
_cuts: list[tuple[str, object, object]] = []  # path, and what deletes it even when the session has ended


def build_session(app: str = "clipweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC. `conf` keys use `__` for a dot."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in {**defaults, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application, wherever the driver has it from."""
    context = spark.sparkContext
    if getattr(context, "_clipweave_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="clipweave-code-")) / "clipweave.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._clipweave_shipped = True


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts.

    `spark.checkpoint.dir` of the session wins. Only where it is unset is a folder of our own taken: beside the
    warehouse on a cluster, a temporary one for a local master (tests).
    """
    global _local_scratch
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    if _local_scratch is None or not os.path.isdir(_local_scratch):
        _local_scratch = tempfile.mkdtemp(prefix="clipweave-")
    return "file://" + _local_scratch


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write `df` once to the shared folder and read it back: the plan starts anew and a lost executor costs no recomputation.

    A table is used in place of `checkpoint()` because the latter computes its input twice and keeps rows uncompressed.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _cuts.append((path, spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()))
    return spark.read.schema(df.schema).parquet(path)


def drop_cut(df: DataFrame) -> None:
    """Delete the files behind a frame made by `cut`, once nothing refers to it."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def qualified(name: str):
        path = jvm.org.apache.hadoop.fs.Path(name)
        fs = path.getFileSystem(conf)
        return fs, fs.makeQualified(path)

    base = qualified(scratch_dir(spark))[1].toString()
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        fs, path = qualified(folder)
        if path.toString().startswith(base):
            fs.delete(path, True)


def clear_cuts(spark: SparkSession | None = None) -> None:
    """Delete all tables cut so far by this driver; frames that still refer to them can't be read any more. Done when the driver ends too."""
    while _cuts:
        name, jvm, conf = _cuts.pop()
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)


def _at_exit() -> None:
    try:
        clear_cuts()
    except Exception:  # the JVM is gone already: what it left is in one folder
        _cuts.clear()


atexit.register(_at_exit)
