"""Views shared by the queries, in Spark and in SQL: one clean row per clip, transcript and video."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipweave.operators import rules
from clipweave.sources.tables import clean_speaker, one_per_key, table

METRICS = (
    "dnsmos_bak", "dnsmos_sig", "dnsmos_ovrl", "dnsmos_p808", "utmos", "window_similarity", "speech_ratio", "clip_ratio", "edge_start_db", "edge_end_db",
)
PLAIN = ("video_id", "channel", "playlist", "source", "start_cut", "end_cut", "weak_cut", "local_speaker", "start_sec", "end_sec")


Query = Callable[[SparkSession, str], DataFrame]


def registrar() -> tuple[dict[str, Query], dict[str, str], Callable[..., Callable[[Query], Query]]]:
    """(queries, their SQL, a decorator that registers a query by its name with the SQL that says the same)."""
    queries: dict[str, Query] = {}
    sql: dict[str, str] = {}

    def query(text: str | None = None) -> Callable[[Query], Query]:
        def add(f: Query) -> Query:
            queries[f.__name__] = f
            if text:
                sql[f.__name__] = text
            return f

        return add

    return queries, sql, query


def rounded(column: str) -> Column:
    """A measure as a double of three decimals; NaN is null."""
    c = F.col(column).cast("double")
    return F.when(~F.isnan(c), F.round(c, 3))


def clips(spark: SparkSession, folder: str, *extra: str) -> DataFrame:
    """One row per clip: clean speaker and gender, milliseconds, duration and metrics as doubles, NaN as null."""
    names = dict.fromkeys(["speaker_id", "gender", "duration", *METRICS, *PLAIN, *extra])
    one = one_per_key(table(spark, folder, "chunks"), "id", *names)
    sex = F.substring(F.lower(F.trim("gender")), 1, 1)
    return one.select(
        "id", clean_speaker().alias("speaker_id"), F.when(sex == "m", "male").when(sex == "f", "female").alias("gender"),
        rounded("duration").alias("duration"), F.round(rounded("duration") * 1000).cast("long").alias("ms"),
        *[rounded(m).alias(m) for m in METRICS], *PLAIN, *extra,
    )


def judged(spark: SparkSession, folder: str) -> DataFrame:
    """Clips with the reasons to reject them by the usual limits, weak cuts included."""
    c = clips(spark, folder).withColumn("edge_db", rules.edge_db())
    return c.withColumn("reasons", rules.reasons(rules.QUALITY_RULES, 2.0, 30.0, drop_weak=True))


def transcripts(spark: SparkSession, folder: str) -> DataFrame:
    """One row per transcript."""
    return one_per_key(table(spark, folder, "transcripts"), "id", "text", "text_tagged", "ok", "flags", "tags", "backend", "chars_per_sec", "arabic_ratio")


def videos(spark: SparkSession, folder: str) -> DataFrame:
    """One row per video."""
    return one_per_key(table(spark, folder, "videos"), "id", "title", "playlist", "url", "path", "duration", "sample_rate", "channels", "size", "mtime", "channel", "channel_id")


def _sql_round(c: str) -> str:
    return f"CASE WHEN NOT isnan({c}) THEN round(CAST({c} AS DOUBLE), 3) END AS {c}"


CLIPS_SQL = f"""
raw AS (SELECT id, any_value(speaker_id) AS speaker_id, any_value(gender) AS gender, any_value(duration) AS duration,
  {", ".join(f"any_value({c}) AS {c}" for c in (*METRICS, *PLAIN))} FROM chunks WHERE id IS NOT NULL GROUP BY id),
timed AS (SELECT id, nullif(upper(regexp_replace(speaker_id, '^[\\s\\p{{Z}}\\p{{Cf}}]+|[\\s\\p{{Z}}\\p{{Cf}}]+$', '', 'g')), '') AS speaker_id,
  CASE left(lower(trim(gender)), 1) WHEN 'm' THEN 'male' WHEN 'f' THEN 'female' END AS gender,
  {_sql_round("duration")}, {", ".join(_sql_round(m) for m in METRICS)}, {", ".join(PLAIN)} FROM raw),
clips AS (SELECT *, CAST(round(duration * 1000) AS BIGINT) AS ms FROM timed)
"""

JUDGED_SQL = f"""{CLIPS_SQL},
judged AS (SELECT *, [x FOR x IN [
  CASE WHEN duration < 2.0::DOUBLE - 0.05::DOUBLE OR duration > 30.0::DOUBLE + 0.05::DOUBLE THEN 'duration' END,
  CASE WHEN dnsmos_bak < 3.6::DOUBLE THEN 'background' END,
  CASE WHEN window_similarity < 0.78::DOUBLE THEN 'speaker_mix' END,
  CASE WHEN weak_cut THEN 'weak_cut' END] IF x IS NOT NULL] AS reasons FROM clips)
"""

TRANSCRIPTS_SQL = """
transcript AS (SELECT id, any_value(text) AS text, any_value(text_tagged) AS text_tagged, any_value(ok) AS ok, any_value(flags) AS flags,
  any_value(tags) AS tags, any_value(backend) AS backend FROM transcripts WHERE id IS NOT NULL GROUP BY id)
"""

VIDEOS_SQL = """
video AS (SELECT id, any_value(title) AS title, any_value(playlist) AS playlist, any_value(url) AS url, any_value(path) AS path,
  any_value(duration) AS duration, any_value(sample_rate) AS sample_rate, any_value(size) AS size, any_value(channel) AS channel
  FROM videos WHERE id IS NOT NULL GROUP BY id)
"""
