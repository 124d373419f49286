"""Queries over clips and videos: filter, selection, statistics, joins."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from clipweave.operators import joins, rules, segment, select, stats
from clipweave.plans.base import CLIPS_SQL, JUDGED_SQL, TRANSCRIPTS_SQL, VIDEOS_SQL, clips, judged, registrar, transcripts, videos
from clipweave.sources.tables import table

CAP_MS = 600_000
QUERIES, SQL, query = registrar()


@query(f"WITH {JUDGED_SQL} SELECT id, array_to_string(reasons, '|') AS reasons FROM judged")
def filter_reasons(spark, folder):
    """Every clip with its reasons to be rejected."""
    return judged(spark, folder).select("id", F.array_join("reasons", "|").alias("reasons"))


@query(f"WITH {JUDGED_SQL} SELECT reason, count(*) AS clips FROM (SELECT unnest(reasons) AS reason FROM judged) GROUP BY reason")
def reject_counts(spark, folder):
    """How many clips each reason rejects."""
    return stats.reject_counts(judged(spark, folder))


_SCORED = f"""{JUDGED_SQL},
kept AS (SELECT *, CAST(round((coalesce(dnsmos_bak, 0) + coalesce(dnsmos_sig, 0) + 2 * coalesce(window_similarity, 0)) * 1000) AS BIGINT) AS score, coalesce(ms, 0) AS w,
  coalesce(speaker_id, id) AS grp FROM judged WHERE len(reasons) = 0)
"""
_CAPPED = f"""{_SCORED},
a AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY score DESC, id) AS rk, row_number() OVER (PARTITION BY grp, video_id ORDER BY score DESC, id) AS rnd,
  count(*) OVER (PARTITION BY grp, video_id) AS n FROM kept),
b AS (SELECT *, min(rk) OVER (PARTITION BY grp, video_id) AS best FROM a),
d AS (SELECT *, coalesce(sum(w) OVER (PARTITION BY grp ORDER BY rnd, n DESC, best ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prev FROM b),
capped AS (SELECT * FROM d WHERE prev < {CAP_MS})
"""


def _kept(spark, folder):
    """Clips that pass all rules, with their score in thousandths; clips without a speaker are groups of their own."""
    good = judged(spark, folder).where(F.size("reasons") == 0)
    return good.withColumns({"score": F.round(select.clip_score() * 1000).cast("long"), "w": F.coalesce("ms", F.lit(0)), "grp": F.coalesce("speaker_id", "id")})


def _capped(spark, folder):
    return select.diverse_cap(_kept(spark, folder), CAP_MS, group="grp", ms="w")


@query(f"WITH {_CAPPED} SELECT id, speaker_id, video_id, score FROM capped")
def filter_kept(spark, folder):
    """The clips that pass all rules, each speaker capped with clips taken in turns from its videos."""
    return _capped(spark, folder).select("id", "speaker_id", "video_id", "score")


@query(f"WITH {_CAPPED} SELECT grp, count(*) AS clips, count(DISTINCT video_id) AS videos, CAST(sum(w) AS BIGINT) AS ms FROM capped GROUP BY grp")
def diverse_cap(spark, folder):
    """What every group keeps under the diverse cap."""
    return _capped(spark, folder).groupBy("grp").agg(F.count("*").alias("clips"), F.count_distinct("video_id").alias("videos"), F.sum("w").alias("ms"))


_TARGET_MS = 3_600_000


@query(f"WITH {_SCORED}, run AS (SELECT *, coalesce(sum(w) OVER (ORDER BY score DESC, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prev FROM kept) SELECT id, score FROM run WHERE prev < {_TARGET_MS}")
def target_size(spark, folder):
    """The best clips up to one hour in all."""
    return select.target_size(_kept(spark, folder), _TARGET_MS, ms="w", step=1).select("id", "score")


@query(f"WITH {_SCORED}, run AS (SELECT *, coalesce(sum(w) OVER (PARTITION BY grp ORDER BY score DESC, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prev FROM kept) SELECT id FROM run WHERE prev < 300000")
def minutes_limit(spark, folder):
    """The best five minutes of every speaker."""
    return select.best_until(_kept(spark, folder), 300_000, group="grp", ms="w").select("id")


_H = 3_600_000.0


@query(f"""WITH {CLIPS_SQL}, per AS (SELECT coalesce(speaker_id, '?') AS s, sum(coalesce(ms, 0)) AS ms FROM clips GROUP BY 1)
SELECT count(*) AS speakers, round(sum(ms) / {_H}::DOUBLE, 6) AS hours, round(sum(ms) / count(*) / {_H}::DOUBLE, 6) AS mean_h, round(quantile_cont(CAST(ms AS DOUBLE), 0.5) / {_H}::DOUBLE, 6) AS median_h,
  round(min(ms) / {_H}::DOUBLE, 6) AS min_h, round(max(ms) / {_H}::DOUBLE, 6) AS max_h FROM per""")
def speaker_stats(spark, folder):
    """Hours per speaker: count, sum, mean, median, least, most."""
    return stats.speaker_stats(clips(spark, folder))


@query(f"""WITH {CLIPS_SQL}, votes AS (SELECT coalesce(speaker_id, '?') AS s, coalesce(gender, '?') AS g, count(*) AS n, sum(coalesce(ms, 0)) AS ms FROM clips GROUP BY 1, 2),
per AS (SELECT s, (list(g ORDER BY n DESC, g DESC))[1] AS gender, sum(ms) AS ms FROM votes GROUP BY s)
SELECT gender, count(*) AS speakers, round(sum(ms) / {_H}::DOUBLE, 6) AS hours FROM per GROUP BY gender""")
def speaker_gender_stats(spark, folder):
    """Speakers and hours per gender."""
    return stats.by_gender(clips(spark, folder))


@query(f"""WITH {CLIPS_SQL} SELECT speaker_id, round(sum(coalesce(ms, 0)) / {_H}::DOUBLE, 6) AS hours, count(*) AS n_clips, count(DISTINCT video_id) AS n_videos, count(DISTINCT channel) AS n_channels,
  coalesce(array_to_string(list_sort(list(DISTINCT channel) FILTER (channel IS NOT NULL)), '|'), '') AS channels FROM clips WHERE speaker_id IS NOT NULL GROUP BY speaker_id""")
def speaker_rollup(spark, folder):
    """Hours, clips, videos and channels of every speaker."""
    return stats.speaker_rollup(clips(spark, folder))


@query(f"""WITH {CLIPS_SQL}, per AS (SELECT speaker_id, max(gender) AS gender, sum(coalesce(ms, 0)) AS ms FROM clips WHERE speaker_id IS NOT NULL AND gender IS NOT NULL GROUP BY speaker_id)
SELECT speaker_id, upper(gender) || '_' || lpad(CAST(row_number() OVER (PARTITION BY gender ORDER BY ms DESC, speaker_id) AS VARCHAR), 5, '0') AS name FROM per""")
def speaker_names(spark, folder):
    """Speakers numbered by hours within their gender."""
    per = clips(spark, folder).where("speaker_id IS NOT NULL AND gender IS NOT NULL").groupBy("speaker_id").agg(F.max("gender").alias("gender"), F.sum(F.coalesce("ms", F.lit(0))).alias("ms"))
    return stats.numbered(per, "gender", "ms", "speaker_id").select("speaker_id", "name")


@query(f"""WITH {CLIPS_SQL}, per AS (SELECT speaker_id, sum(coalesce(ms, 0)) AS v FROM clips WHERE speaker_id IS NOT NULL GROUP BY 1), r AS (SELECT v, row_number() OVER (ORDER BY v) AS i, count(*) OVER () AS n FROM per)
SELECT round(coalesce(CAST(sum((2 * i - n - 1) * v) AS DOUBLE) / nullif(max(n) * sum(v), 0), 0), 6) AS gini FROM r""")
def gini(spark, folder):
    """Inequality of hours between speakers."""
    return stats.gini(_per_speaker(spark, folder), "ms")


def _per_speaker(spark, folder):
    return clips(spark, folder).where("speaker_id IS NOT NULL").groupBy("speaker_id").agg(F.sum(F.coalesce("ms", F.lit(0))).alias("ms"))


@query(f"""WITH {CLIPS_SQL}, per AS (SELECT speaker_id, sum(coalesce(ms, 0)) AS v FROM clips WHERE speaker_id IS NOT NULL GROUP BY 1)
SELECT speaker_id, row_number() OVER o AS place, round(CAST(sum(v) OVER (o ROWS UNBOUNDED PRECEDING) AS DOUBLE) / sum(v) OVER (), 6) AS share FROM per WINDOW o AS (ORDER BY v, speaker_id)""")
def lorenz(spark, folder):
    """Cumulative share of hours, the smallest speakers first."""
    return stats.lorenz(_per_speaker(spark, folder), "speaker_id", "ms")


@query(f"""WITH {CLIPS_SQL}, k AS (SELECT dnsmos_bak AS x FROM clips WHERE dnsmos_bak IS NOT NULL), e AS (SELECT min(x) AS lo, max(x) AS hi FROM k)
SELECT CAST(greatest(0, least(49, floor((x - lo) / CASE WHEN hi > lo THEN hi - lo ELSE 1 END * 50))) AS INTEGER) AS bin, count(*) AS n FROM k, e GROUP BY 1""")
def histogram50(spark, folder):
    """The background score in fifty bins."""
    return stats.histogram(clips(spark, folder), "dnsmos_bak")


def _box_sql(stage: str, view: str) -> str:
    return " UNION ALL ".join(f"SELECT '{stage}' AS stage, '{m}' AS metric, round(quantile_cont({m}, 0.25), 5) AS q1, round(quantile_cont({m}, 0.5), 5) AS median, round(quantile_cont({m}, 0.75), 5) AS q3 FROM {view}" for m in ("dnsmos_bak", "dnsmos_sig", "window_similarity"))


@query(f"WITH {JUDGED_SQL}, good AS (SELECT * FROM judged WHERE len(reasons) = 0) {_box_sql('all', 'judged')} UNION ALL {_box_sql('kept', 'good')}")
def box_stats(spark, folder):
    """Quartiles of three metrics before and after the filter."""
    j = judged(spark, folder)
    return stats.boxes({"all": j, "kept": j.where(F.size("reasons") == 0)}, ["dnsmos_bak", "dnsmos_sig", "window_similarity"])


def _stage_sql(name: str, source: str) -> str:
    return f"SELECT '{name}' AS stage, count(*) AS clips, round(coalesce(sum(coalesce(ms, 0)), 0) / {_H}::DOUBLE, 6) AS hours FROM {source}"


@query(f"""WITH {_CAPPED}, {VIDEOS_SQL}, v AS (SELECT id, CAST(round(coalesce(duration, 0) * 1000) AS BIGINT) AS ms FROM video), ok AS (SELECT id FROM transcripts GROUP BY id HAVING bool_or(ok)),
said AS (SELECT * FROM kept SEMI JOIN ok USING (id)), done AS (SELECT * FROM capped SEMI JOIN ok USING (id))
{_stage_sql('downloaded', 'v')} UNION ALL {_stage_sql('segmented', 'judged')} UNION ALL {_stage_sql('filtered', 'kept')} UNION ALL {_stage_sql('transcribed', 'said')} UNION ALL {_stage_sql('final', 'done')}""")
def funnel(spark, folder):
    """Videos or clips and hours left after each stage; the stages of clips in one pass over clips with flags."""
    ok = transcripts(spark, folder).where("ok").select("id", F.lit(True).alias("said"))
    capped = _capped(spark, folder).select("id", F.lit(True).alias("final"))
    flagged = judged(spark, folder).join(ok, "id", "left").join(capped, "id", "left").select("ms", (F.size("reasons") == 0).alias("fit"), "said", "final")
    v = videos(spark, folder).select(F.round(F.coalesce("duration", F.lit(0.0)) * 1000).cast("long").alias("ms"))
    stages = {"segmented": F.lit(True), "filtered": F.col("fit"), "transcribed": F.col("fit") & F.col("said"), "final": F.col("fit") & F.col("said") & F.col("final")}
    return stats.flag_funnel(flagged, stages).unionByName(stats.flag_funnel(v, {"downloaded": F.lit(True)}))


@query(f"""WITH {CLIPS_SQL} SELECT start_cut, count(*) FILTER (end_cut = 'pause') AS pause, count(*) FILTER (end_cut = 'split') AS split, count(*) FILTER (end_cut = 'turn') AS turn, count(*) FILTER (end_cut = 'weak') AS weak FROM clips GROUP BY 1""")
def cut_crosstab(spark, folder):
    """How clips begin by how they end."""
    return stats.crosstab(clips(spark, folder), "start_cut", "end_cut", ["pause", "split", "turn", "weak"])


@query(f"WITH {CLIPS_SQL} SELECT channel, count(*) AS n FROM clips GROUP BY 1 ORDER BY n DESC, channel NULLS FIRST LIMIT 40")
def top_channels(spark, folder):
    """The forty channels with most clips."""
    return stats.top_counts(clips(spark, folder), "channel", 40)


@query(f"WITH {VIDEOS_SQL} SELECT coalesce(playlist, '(no playlist)') AS playlist, count(*) AS videos, round(sum(CAST(round(coalesce(duration, 0) * 1000) AS BIGINT)) / {_H}::DOUBLE, 6) AS hours FROM video GROUP BY 1")
def playlist_hours(spark, folder):
    """Videos and hours per playlist."""
    v = videos(spark, folder).select(F.coalesce("playlist", F.lit("(no playlist)")).alias("playlist"), F.round(F.coalesce("duration", F.lit(0.0)) * 1000).cast("long").alias("ms"))
    return v.groupBy("playlist").agg(F.count("*").alias("videos"), stats.hours().alias("hours"))


@query(f"""WITH {CLIPS_SQL}, {TRANSCRIPTS_SQL}, {VIDEOS_SQL},
one AS (SELECT clip_id AS id FROM clip_labels GROUP BY 1 HAVING min(label) = max(label))
SELECT c.id, CASE WHEN t.id IS NULL THEN 'not_transcribed' WHEN NOT coalesce(t.ok, false) THEN 'transcript_sanity' WHEN one.id IS NULL THEN 'not_labelled' WHEN c.speaker_id IS NULL THEN 'no_speaker' ELSE 'pass' END AS outcome,
  v.channel AS video_channel FROM clips c LEFT JOIN transcript t ON c.id = t.id LEFT JOIN one ON one.id = c.id LEFT JOIN video v ON v.id = c.video_id""")
def gate_waterfall(spark, folder):
    """The first gate every clip fails, over left joins with transcripts, labels and videos."""
    t = transcripts(spark, folder).select("id", F.lit(True).alias("transcribed"), "ok")
    labels = table(spark, folder, "clip_labels").groupBy(F.col("clip_id").alias("id")).agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a = b").select("id", F.lit(True).alias("labelled"))
    v = videos(spark, folder).select(F.col("id").alias("video_id"), F.col("channel").alias("video_channel"))
    joined = clips(spark, folder).join(t, "id", "left").join(labels, "id", "left").join(v, "video_id", "left")
    tests = [("not_transcribed", F.col("transcribed")), ("transcript_sanity", F.col("ok")), ("not_labelled", F.col("labelled")), ("no_speaker", F.col("speaker_id").isNotNull())]
    return joins.first_failure(joined, tests).select("id", "outcome", "video_channel")


@query(f"WITH {CLIPS_SQL} SELECT id FROM clips SEMI JOIN (SELECT id FROM transcripts WHERE ok) USING (id)")
def semi_transcribed(spark, folder):
    """Clips with a sound transcript."""
    return clips(spark, folder).join(transcripts(spark, folder).where("ok"), "id", "left_semi").select("id")


@query("SELECT DISTINCT id FROM chunks WHERE id IS NOT NULL AND id NOT IN (SELECT id FROM transcripts WHERE id IS NOT NULL)")
def pending_transcription(spark, folder):
    """Clips still to be transcribed."""
    c = table(spark, folder, "chunks").where("id IS NOT NULL").select("id").distinct()
    return joins.pending(c, c, transcripts(spark, folder), "id")


@query("WITH k AS (SELECT id, min(split) AS split FROM draft_splits GROUP BY id), n AS (SELECT clip_id AS id, max(label) AS split FROM clip_labels GROUP BY 1) SELECT coalesce(n.id, k.id) AS id, coalesce(n.split, k.split) AS split FROM k FULL JOIN n ON k.id = n.id")
def upsert(spark, folder):
    """Known rows and new ones by key, the new ones winning."""
    known = table(spark, folder, "draft_splits").groupBy("id").agg(F.min("split").alias("split"))
    new = table(spark, folder, "clip_labels").groupBy(F.col("clip_id").alias("id")).agg(F.max("label").alias("split"))
    return joins.upsert(known, new, "id")


@query("SELECT id, epoch_us(min(ingested_at)) AS first_us FROM chunks WHERE id IS NOT NULL GROUP BY id")
def first_delivery(spark, folder):
    """The first delivery of every clip."""
    first = joins.keep_first(table(spark, folder, "chunks").where("id IS NOT NULL").select("id", "ingested_at"), "id", "ingested_at")
    return first.select("id", F.unix_micros("ingested_at").alias("first_us"))


@query(f"""WITH {CLIPS_SQL} SELECT a.id AS l_id, b.id AS r_id FROM clips a JOIN clips b ON a.video_id = b.video_id AND a.local_speaker < b.local_speaker AND a.start_sec < b.end_sec + 1.0::DOUBLE AND b.start_sec - 1.0::DOUBLE < a.end_sec""")
def neighbouring_voices(spark, folder):
    """Pairs of clips of one video and two speakers that lie within a second of each other: an interval join in buckets."""
    c = clips(spark, folder).where("start_sec <= end_sec").select("id", "video_id", "local_speaker", F.col("start_sec"), F.col("end_sec"))
    wide = c.withColumns({"start_sec": F.col("start_sec") - 1.0, "end_sec": F.col("end_sec") + 1.0})
    pairs = joins.interval_overlaps(c, wide, group="video_id", start="start_sec", end="end_sec", bucket=30.0)
    return pairs.where("l_local_speaker < r_local_speaker").select("l_id", "r_id")


_STRICT = {"dnsmos_bak": 3.9, "window_similarity": 0.8, "dnsmos_sig": 3.4, "speech_ratio": 0.9}
_STRICT_SQL = "NOT (coalesce(dnsmos_bak < 3.9::DOUBLE, false) OR coalesce(window_similarity < 0.8::DOUBLE, false) OR coalesce(dnsmos_sig < 3.4::DOUBLE, false) OR coalesce(speech_ratio < 0.9::DOUBLE, false))"


def _edged(spark, folder):
    return clips(spark, folder).withColumn("edge_db", rules.edge_db())


@query(f"WITH {CLIPS_SQL}, j AS (SELECT coalesce(ms, 0) AS ms, {_STRICT_SQL} AS k FROM clips) SELECT count(*) FILTER (k) AS kept, count(*) FILTER (NOT k) AS rejected, CAST(sum(ms) FILTER (k) AS BIGINT) AS kept_ms, CAST(sum(ms) FILTER (NOT k) AS BIGINT) AS rejected_ms FROM j")
def tuner_whatif(spark, folder):
    """What a stricter set of thresholds would keep."""
    return rules.what_if(_edged(spark, folder).withColumn("ms", F.coalesce("ms", F.lit(0))), rules.with_limits(**_STRICT))


@query("WITH " + CLIPS_SQL + " " + " UNION ALL ".join(f"SELECT '{m}' AS metric, count(*) FILTER ({m} < {v}::DOUBLE) AS rejected FROM clips" for m, v in _STRICT.items()))
def tuner_alone(spark, folder):
    """What each threshold would reject by itself."""
    return rules.each_alone(_edged(spark, folder), rules.with_limits(**_STRICT))


@query(f"""WITH {CLIPS_SQL}, one AS (SELECT clip_id AS id, min(label) AS label FROM clip_labels GROUP BY 1 HAVING min(label) = max(label)), j AS (SELECT label, {_STRICT_SQL} AS k FROM clips JOIN one USING (id))
SELECT count(*) AS labelled, count(*) FILTER (label = 'bad' AND k) AS bad_accepted, count(*) FILTER (label = 'good' AND NOT k) AS good_rejected FROM j""")
def tuner_confusion(spark, folder):
    """Labelled clips the thresholds judge otherwise."""
    return rules.confusion(_edged(spark, folder), table(spark, folder, "clip_labels"), rules.with_limits(**_STRICT))


@query(f"WITH {CLIPS_SQL} SELECT id, dnsmos_bak FROM clips ORDER BY CAST(round(abs(dnsmos_bak - 3.6) * 1000) AS BIGINT) NULLS LAST, id LIMIT 40")
def borderline(spark, folder):
    """The forty clips nearest to a threshold: a top-k report."""
    return clips(spark, folder).orderBy(F.round(F.abs(F.col("dnsmos_bak") - 3.6) * 1000).cast("long").asc_nulls_last(), "id").limit(40).select("id", "dnsmos_bak")


@query(f"""WITH {JUDGED_SQL}, named AS (SELECT id, unnest(CASE WHEN len(reasons) = 0 THEN ['kept'] ELSE reasons END) AS reason FROM judged), r AS (SELECT *, row_number() OVER (PARTITION BY reason ORDER BY md5('0' || chr(1) || id), id) AS k FROM named)
SELECT id, reason FROM r WHERE k <= 20""")
def review_sample(spark, folder):
    """Twenty seeded clips of every reason, and of those kept."""
    return select.sample_per_reason(judged(spark, folder), 20)


@query(f"""WITH {CLIPS_SQL}, known AS (SELECT speaker_id, max(gender) AS gender, sum(coalesce(ms, 0)) AS ms FROM clips WHERE speaker_id IS NOT NULL GROUP BY 1), pool AS (SELECT *, count(*) OVER () AS n, row_number() OVER (ORDER BY ms, speaker_id) - 1 AS i FROM known WHERE ms >= 180000),
mid AS (SELECT *, row_number() OVER (PARTITION BY gender ORDER BY md5('0' || chr(1) || speaker_id), speaker_id) AS turn FROM pool WHERE n // 4 >= (3 * n) // 4 OR (i >= n // 4 AND i < (3 * n) // 4)),
r AS (SELECT *, row_number() OVER (ORDER BY turn, gender NULLS FIRST, speaker_id) AS k FROM mid) SELECT speaker_id FROM r WHERE k <= 20 AND k <= n - 1""")
def test_speakers(spark, folder):
    """Speakers held out for testing, of the middle half by size, genders in turn."""
    per = clips(spark, folder).where("speaker_id IS NOT NULL").groupBy("speaker_id").agg(F.max("gender").alias("gender"), F.sum(F.coalesce("ms", F.lit(0))).alias("ms"))
    return select.test_speakers(per, 20)


@query(f"""WITH {CLIPS_SQL} SELECT video_id || '_s' || local_speaker || '_' || lpad(CAST(row_number() OVER (PARTITION BY video_id, local_speaker ORDER BY start_sec, id) - 1 AS VARCHAR), 4, '0') AS clip_id, id,
  CASE WHEN length(video_id) = 11 THEN 'https://youtu.be/' || video_id || '?t=' || CAST(floor(start_sec) AS BIGINT) || 's' END AS url, CAST(floor(start_sec / 60) AS BIGINT) || ':' || lpad(CAST(CAST(floor(start_sec) AS BIGINT) % 60 AS VARCHAR), 2, '0') AS label FROM clips""")
def clip_names(spark, folder):
    """Clip names numbered in time order within a video and speaker, with links and labels of their start."""
    place = F.row_number().over(Window.partitionBy("video_id", "local_speaker").orderBy("start_sec", "id")) - 1
    second = F.floor("start_sec")
    return clips(spark, folder).select(
        F.format_string("%s_s%d_%04d", "video_id", "local_speaker", place).alias("clip_id"), "id",
        F.when(F.length("video_id") == 11, F.concat(F.lit("https://youtu.be/"), "video_id", F.lit("?t="), second, F.lit("s"))).alias("url"),
        F.concat(F.floor(F.col("start_sec") / 60), F.lit(":"), F.lpad((second % 60).cast("string"), 2, "0")).alias("label"),
    )


@query(f"""WITH {CLIPS_SQL}, {TRANSCRIPTS_SQL} SELECT c.id, c.duration, c.speaker_id, c.gender, t.text, coalesce(nullif(t.text_tagged, ''), t.text) AS text_tagged, coalesce(array_to_string(t.tags, '|'), '') AS tags
FROM clips c JOIN transcript t USING (id) WHERE t.ok""")
def publish_projection(spark, folder):
    """What is published of a clip: tagged text falls back to the plain one, missing tags are none."""
    joined = clips(spark, folder).join(transcripts(spark, folder).where("ok"), "id")
    return joined.select("id", "duration", "speaker_id", "gender", "text", F.coalesce(F.nullif("text_tagged", F.lit("")), "text").alias("text_tagged"), F.coalesce(F.array_join("tags", "|"), F.lit("")).alias("tags"))


@query(f"""WITH {CLIPS_SQL}, r AS (SELECT id, row_number() OVER (ORDER BY md5('0' || chr(1) || id), id) AS k, count(*) OVER () AS n FROM clips) SELECT id, CASE WHEN k <= floor(n * 0.005::DOUBLE) THEN 'validation' ELSE 'train' END AS split FROM r""")
def validation_split(spark, folder):
    """A two-hundredth of the clips in seeded order for validation."""
    return segment.validation_split(clips(spark, folder).select("id"), 0.005)


@query(f"""WITH {VIDEOS_SQL}, v AS (SELECT id, duration * 0.05::DOUBLE AS l, greatest(duration * 0.05::DOUBLE, duration * 0.95::DOUBLE - 10) AS h FROM video WHERE duration > 0), x AS (SELECT id, l, h, unnest(range(0, 6)) AS n FROM v)
SELECT id, CAST(n AS INTEGER) AS n, round(l + (h - l) * n / 5.0::DOUBLE, 3) AS start FROM x""")
def probe_windows(spark, folder):
    """Six windows spread over every video, to be probed for music."""
    return segment.probe_windows(videos(spark, folder))


@query(f"""WITH {CLIPS_SQL}, s AS (SELECT id, min(split) AS split FROM draft_splits GROUP BY id)
SELECT split, count(*) AS clips, round(sum(coalesce(ms, 0)) / {_H}::DOUBLE, 6) AS hours, count(DISTINCT speaker_id) AS speakers FROM clips JOIN s USING (id) GROUP BY split""")
def split_summary(spark, folder):
    """Clips, hours and speakers of every split of the earlier assignment."""
    s = table(spark, folder, "draft_splits").groupBy("id").agg(F.min("split").alias("split"))
    return clips(spark, folder).join(s, "id").groupBy("split").agg(F.count("*").alias("clips"), stats.hours().alias("hours"), F.count_distinct("speaker_id").alias("speakers"))
