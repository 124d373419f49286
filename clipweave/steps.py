"""Steps by name: transforms whose results are tables in a work folder, run in order, one by one or from here to there."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipweave.plans import registry
from clipweave.sources.lake import Ledger

Transform = Callable[[SparkSession, str], DataFrame]
#: Stages of work, each the names of its steps in order. A step is a query unless it is registered otherwise.
STAGES: dict[str, tuple[str, ...]] = {
    "local": ("index_outcomes", "clip_names", "adjacent_similarity", "hub_rows", "manifest"),
    "gpu": ("pulled_clips", "imported_quality", "filter_kept", "align_gate", "balance_splits", "published"),
    "report": ("funnel", "corpus_stats", "cluster_report", "topic_names"),
}
_own: dict[str, Transform] = {}


def register(name: str, transform: Transform) -> None:
    """Make a transform of one's own known as a step."""
    _own[name] = transform


def chosen(stage: str | None = None, *, only: list[str] | None = None, first: str | None = None, last: str | None = None) -> list[str]:
    """The steps to run: those named by `only`, else those of a stage from `first` to `last`, both included; unknown names are errors."""
    known = _own.keys() | registry.queries().keys()
    names = list(only or STAGES.get(stage or "", ()))
    if stage and stage not in STAGES:
        raise KeyError(f"no stage {stage!r}; known: {', '.join(STAGES)}")
    for name in [*names, *filter(None, (first, last))]:
        if name not in known or (name in (first, last) and name not in names):
            raise KeyError(f"no step {name!r}")
    return names[names.index(first) if first else 0 : names.index(last) + 1 if last else None]


def run(spark: SparkSession, folder: str, work: str, names: list[str], *, limit: int | None = None, force: bool = False) -> list[str]:
    """Run steps that the ledger doesn't name as done (with `force` all of them) and write their tables; returns the steps run.

    A step is noted as done after its table is written, so one that broke off runs again. `limit` writes so many rows, for trials.
    """
    ledger = Ledger(spark, f"{work}/ledger")
    done = set() if force else {r["id"] for r in ledger.done("run").collect()}  # a row per step
    ran = []
    for name in names:
        if name in done:
            continue
        df = (_own.get(name) or registry.queries()[name])(spark, folder)
        (df.limit(limit) if limit else df).write.mode("overwrite").parquet(f"{work}/{name}")
        if not limit:
            ledger.mark("run", spark.range(1).select(F.lit(name).alias("id")))
        ran.append(name)
    return ran


def progress(done: int, total: int, *, audio_sec: float, elapsed_sec: float) -> str:
    """One line on a step under way: items, how many times faster than the audio plays, and the time still to go at this speed."""
    speed = audio_sec / elapsed_sec if elapsed_sec > 0 else 0.0
    left = elapsed_sec / done * (total - done) if done else 0.0
    share = f"{100 * done // total} %" if total else "-"
    return f"{done}/{total} ({share}), {speed:.1f}x real time, {int(left // 3600)}:{int(left // 60) % 60:02}:{int(left) % 60:02} to go"
