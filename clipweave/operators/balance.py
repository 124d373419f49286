"""The balance stage: gates, caps and splits of the final selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipweave.functions import text as T
from clipweave.operators import joins, segment, select
from clipweave.session import cut


def gated(clips: DataFrame, transcripts: DataFrame, aligned: DataFrame, assignment: DataFrame, *, verify: DataFrame | None = None, most_cer: float = 0.3) -> DataFrame:
    """`clips` with outcome, the first gate each fails or "pass", and the columns of what was joined.

    Gates in order: a transcript, its sanity, its alignment, a second transcript that agrees (only with `verify`), and a
    speaker. Forms of both transcripts are compared; where their lengths alone rule agreement out, no edits are counted.
    """
    rows = clips.drop("speaker_id").join(transcripts.withColumn("_said", F.lit(True)), "id", "left").join(aligned.select("id", "align_score", "align_ok"), "id", "left")
    rows = rows.join(assignment.select("id", "speaker_id"), "id", "left")
    tests = [("not_transcribed", F.col("_said")), ("transcript_sanity", F.col("ok")), ("alignment", F.col("align_ok"))]
    if verify is not None:
        rows = rows.join(verify.select("id", F.col("text").alias("_second")), "id", "left")
        # Forms in columns of their own, so that each is made once.
        rows = rows.withColumns({"_a": T.normalize_for_compare(F.col("text"), compose=False), "_b": T.normalize_for_compare(F.col("_second"), compose=False)})
        tests += [("not_verified", F.col("_second").isNotNull()), ("asr_disagreement", T.cer_within(F.col("_a"), F.col("_b"), most_cer))]
    out = joins.first_failure(rows, [*tests, ("no_speaker", F.col("speaker_id").isNotNull())])
    return out.drop("_said", "_second", "_a", "_b")


def balanced(candidates: DataFrame, *, share: float, target_ms: int | None = None, cap_ms: float | None = None) -> DataFrame:
    """The candidates (id, speaker_id, video_id, ms, score) that stay: each speaker under the common cap by which none has more than
    `share`, clips in turns from its videos, and of all of these the best up to `target_ms`."""
    totals = candidates.groupBy("speaker_id").agg(F.sum("ms").alias("ms"))
    cap = select.share_cap(totals, share, cap_ms)
    kept = select.diverse_cap(candidates, cap, group="speaker_id") if cap != float("inf") else candidates
    return select.target_size(kept, target_ms, step=1) if target_ms else kept


def split(final: DataFrame, *, test_speakers: int, test_ms: int, fraction: float, seed: int = 0) -> DataFrame:
    """`final` (id, speaker_id, gender, ms, score) with split: test holds unseen speakers, each with its best clips up to `test_ms` and the rest
    dropped; of the others a seeded fraction is for validation and the rest for training."""
    final = cut(final, "final")
    totals = final.groupBy("speaker_id").agg(F.max("gender").alias("gender"), F.sum("ms").alias("ms"))
    held = cut(select.test_speakers(totals, test_speakers, seed=seed), "test-speakers")
    test = select.best_until(final.join(held, "speaker_id", "left_semi"), test_ms, group="speaker_id").withColumn("split", F.lit("test"))
    rest = segment.validation_split(final.join(held, "speaker_id", "left_anti"), fraction, seed=seed)
    return test.unionByName(rest)
