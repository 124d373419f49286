"""Queries over the tables of several steps: assembly of clips, shards in and out, what is to be done, and what was."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipweave.functions import text as T
from clipweave.operators import assembly, joins, stats
from clipweave.operators import timeseries as ts
from clipweave.plans.base import CLIPS_SQL, TRANSCRIPTS_SQL, VIDEOS_SQL, clips, registrar, transcripts, videos
from clipweave.plans.catalog import shard_pack
from clipweave.sources.tables import table

QUERIES, SQL, query = registrar()
_H = 3_600_000.0

# The three outputs of a clip's steps, taken from the one table of clips: a clip has a quality row where its background score is known, and a similarity row where that is.
_PARTS = f"""{CLIPS_SQL}, q AS (SELECT id, dnsmos_bak, dnsmos_sig, utmos, 'scored' AS source FROM clips WHERE dnsmos_bak IS NOT NULL), s AS (SELECT id, window_similarity FROM clips WHERE window_similarity IS NOT NULL)"""


def _parts(spark, folder):
    c = clips(spark, folder)
    own = c.select("id", "video_id", "local_speaker", "ms", "source", "start_sec", "end_sec")
    quality = c.where("dnsmos_bak IS NOT NULL").select("id", "dnsmos_bak", "dnsmos_sig", "utmos", F.lit("scored").alias("source"))
    return own, quality, c.where("window_similarity IS NOT NULL").select("id", "window_similarity")


@query(f"""WITH {_PARTS} SELECT c.id, c.video_id, coalesce(c.ms, 0) AS ms, q.source, q.dnsmos_bak, q.dnsmos_sig, s.window_similarity FROM clips c JOIN q ON q.id = c.id JOIN s ON s.id = c.id
WHERE c.video_id IN (SELECT video_id FROM clips JOIN q USING (id)) AND c.video_id IN (SELECT video_id FROM clips JOIN s USING (id))""")
def joined_clips(spark, folder):
    """Clips with quality and voice consistency, of the videos that have all three; the later table wins a column both have."""
    return assembly.joined_clips(*_parts(spark, folder)).select("id", "video_id", F.coalesce("ms", F.lit(0)).alias("ms"), "source", "dnsmos_bak", "dnsmos_sig", "window_similarity")


_SPEAKERS = "sp AS (SELECT speaker_id, (list(gender ORDER BY n DESC, gender DESC))[1] AS gender FROM (SELECT speaker_id, gender, count(*) AS n FROM clips WHERE speaker_id IS NOT NULL AND gender IS NOT NULL GROUP BY 1, 2) GROUP BY 1)"


def _speakers(spark, folder):
    votes = clips(spark, folder).where("speaker_id IS NOT NULL AND gender IS NOT NULL").groupBy("speaker_id", "gender").agg(F.count("*").alias("n"))
    return votes.groupBy("speaker_id").agg(F.max_by("gender", F.struct("n", "gender")).alias("gender"))


@query(f"WITH {CLIPS_SQL}, {_SPEAKERS} SELECT id, c.speaker_id, sp.gender FROM clips c LEFT JOIN sp ON sp.speaker_id = c.speaker_id")
def named_clips(spark, folder):
    """Every clip with its speaker and that speaker's gender, by two lookups."""
    c = clips(spark, folder)
    assigned = c.where("speaker_id IS NOT NULL").select("id", "speaker_id")
    return assembly.named_clips(c.select("id", "video_id"), assigned, _speakers(spark, folder)).select("id", "speaker_id", "gender")


_SHOWN = ("id", "duration", "speaker_id", "gender", "video_id", "video_title", "playlist", "channel", "local_speaker", "start", "source", "weak_cut", "dnsmos_bak", "utmos", "window_similarity")


@query(f"""WITH {_PARTS}, {VIDEOS_SQL}, {_SPEAKERS} SELECT c.id, round(CAST(CAST(c.duration AS FLOAT) AS DOUBLE), 3) AS duration, c.speaker_id, sp.gender, c.video_id, v.title AS video_title, v.playlist, v.channel, c.local_speaker, c.start_sec AS start,
  CASE WHEN q.id IS NULL THEN c.source ELSE q.source END AS source, c.weak_cut, round(CAST(CAST(q.dnsmos_bak AS FLOAT) AS DOUBLE), 3) AS dnsmos_bak, round(CAST(CAST(q.utmos AS FLOAT) AS DOUBLE), 3) AS utmos, round(CAST(CAST(s.window_similarity AS FLOAT) AS DOUBLE), 3) AS window_similarity
FROM clips c JOIN s ON s.id = c.id LEFT JOIN q ON q.id = c.id LEFT JOIN sp ON sp.speaker_id = c.speaker_id LEFT JOIN video v ON v.id = c.video_id""")
def hub_rows(spark, folder):
    """The scalar columns of shards: clips with a similarity, and quality, speaker and video where there are any."""
    c = clips(spark, folder)
    own = c.select("id", "video_id", "duration", "local_speaker", F.col("start_sec").alias("start"), F.col("end_sec").alias("end"), "source", "start_cut", "end_cut", "weak_cut")
    _, quality, similarity = _parts(spark, folder)
    rows = assembly.hub_rows(own, quality, similarity, c.where("speaker_id IS NOT NULL").select("id", "speaker_id"), _speakers(spark, folder), videos(spark, folder))
    return rows.select(*[F.round(F.col(f).cast("double"), 3).alias(f) if rows.schema[f].dataType.typeName() == "float" else f for f in _SHOWN])


@query(f"WITH {CLIPS_SQL} SELECT id, video_id, coalesce(ms, 0) AS ms, local_speaker, source FROM clips")
def pulled_clips(spark, folder):
    """What a pull keeps with the clips: their own columns."""
    rows = clips(spark, folder, "speaker_embedding")
    return assembly.clips_of_shards(rows).select("id", "video_id", F.coalesce("ms", F.lit(0)).alias("ms"), "local_speaker", "source")


@query(f"WITH {CLIPS_SQL}, ok AS (SELECT video_id FROM clips GROUP BY 1 HAVING bool_and(dnsmos_bak IS NOT NULL)) SELECT id, dnsmos_bak, dnsmos_sig, utmos FROM clips SEMI JOIN ok USING (video_id)")
def imported_quality(spark, folder):
    """Quality of the videos all of whose clips have it."""
    return assembly.imported_quality(clips(spark, folder)).select("id", "dnsmos_bak", "dnsmos_sig", "utmos")


_LIVE = "CASE WHEN length(title) % 7 = 0 THEN 'is_live' WHEN length(title) % 11 = 0 THEN 'was_live' END"


@query(f"""WITH {VIDEOS_SQL}, f AS (SELECT id, duration, {_LIVE} AS live, id IN (SELECT video_id FROM chunks) AND length(title) % 3 = 0 AS have FROM video)
SELECT id, CASE WHEN have THEN 'have' WHEN live = 'is_live' THEN 'live' WHEN coalesce(duration, 0) <> 0 AND NOT duration BETWEEN 1800 AND 7200 THEN 'length' ELSE 'todo' END AS status FROM f""")
def download_plan(spark, folder):
    """What is to be done with every video found: had already, live, too short or long, or to be fetched."""
    found = videos(spark, folder).withColumn("live_status", F.expr(_LIVE))
    have = found.where("length(title) % 3 = 0").select("id").join(table(spark, folder, "chunks").select(F.col("video_id").alias("id")).distinct(), "id", "left_semi")
    return assembly.download_plan(found, have, least_sec=1800, most_sec=7200)


@query(f"WITH {VIDEOS_SQL} SELECT id FROM video WHERE NOT coalesce(size % 5 >= 2 AND channel IS NOT NULL, false)")
def retry_list(spark, folder):
    """Videos still to be done, but for those that broke the step twice."""
    v = videos(spark, folder)
    failures = v.where("channel IS NOT NULL").select(F.lit("diarize").alias("step"), "id", (F.col("size") % 5).cast("int").alias("gpu_crashes"))
    return assembly.without_broken(v.select("id"), failures, step="diarize")




def _packed_sql() -> str:
    from clipweave.plans.catalog import SQL as catalog

    return catalog["shard_pack"]


@query(f"""WITH {CLIPS_SQL}, sh AS ({_packed_sql()}) SELECT shard - 1 AS shard, CAST(floor((shard - 1) / 4) AS INTEGER) AS "commit", count(DISTINCT video_id) AS videos, count(*) AS clips, round(sum(coalesce(ms, 0)) / {_H}::DOUBLE, 6) AS hours
FROM clips JOIN sh USING (video_id) GROUP BY shard""")
def manifest(spark, folder):
    """Videos, clips and hours of every shard, four shards to a commit."""
    return assembly.manifest(clips(spark, folder), shard_pack(spark, folder))


@query("SELECT DISTINCT video_id FROM chunks WHERE video_id IS NOT NULL AND video_id NOT IN (SELECT id FROM videos WHERE size % 2 = 0 AND id IS NOT NULL)")
def to_push(spark, folder):
    """Videos with clips that no shard holds yet; those of even size count as pushed."""
    pushed = table(spark, folder, "videos").where("size % 2 = 0").select(F.col("id").alias("video_id"))
    return assembly.to_push(table(spark, folder, "chunks"), pushed)


@query(f"""WITH {VIDEOS_SQL}, k AS (SELECT id, title FROM video WHERE size % 3 <> 0), r AS (SELECT id, upper(title) AS title FROM video WHERE size % 3 <> 1) SELECT coalesce(r.id, k.id) AS id, CASE WHEN r.id IS NULL THEN k.title ELSE r.title END AS title FROM k FULL JOIN r ON r.id = k.id""")
def pulled_videos(spark, folder):
    """Known videos and those of a pull by id, the pulled rows winning."""
    v = videos(spark, folder).select("id", "title", "size")
    return joins.upsert(v.where("size % 3 <> 0").select("id", "title"), v.where("size % 3 <> 1").select("id", F.upper("title").alias("title")), "id")


@query(f"""WITH {CLIPS_SQL} SELECT speaker_id, (list(gender ORDER BY id DESC) FILTER (gender IS NOT NULL))[1] AS gender, round(sum(coalesce(ms, 0)) / {_H}::DOUBLE, 4) AS hours, count(*) AS n_clips, coalesce(array_to_string(list_sort(list(DISTINCT video_id)), '|'), '') AS videos
FROM clips WHERE speaker_id IS NOT NULL GROUP BY 1""")
def pulled_speakers(spark, folder):
    """Speakers of pulled clips with hours, clips and videos."""
    c = clips(spark, folder)
    known = c.select("id", "speaker_id", F.col("gender"))
    out = assembly.pulled_speakers(known.withColumn("gender", F.col("gender")), c.select("id", "video_id", "ms"))
    last = c.where("gender IS NOT NULL AND speaker_id IS NOT NULL").groupBy("speaker_id").agg(F.max_by("gender", "id").alias("gender"))
    return out.drop("gender").join(last, "speaker_id", "left").withColumn("videos", F.array_join("videos", "|"))


# Words with times spread evenly over the clip, the Latin ones without: what an alignment gives.
_ALIGNED = f"""{CLIPS_SQL}, {TRANSCRIPTS_SQL}, tw AS (SELECT c.id, duration, window_similarity, [w FOR w IN string_split(trim(regexp_replace(regexp_replace(t.text, '{T.TAG}', ' ', 'g'), '\\s+', ' ', 'g')), ' ') IF w <> ''] AS w FROM clips c JOIN transcript t USING (id) WHERE t.ok AND duration > 0),
aw AS (SELECT id, duration, len(w) AS n, round(-1 - 10 * (1 - coalesce(window_similarity, 0)), 4) AS align_score, (duration - 0.1::DOUBLE) / greatest(len(w), 1) AS step, [i FOR i IN range(0, len(w)) IF NOT regexp_matches(w[i + 1], '[A-Za-z]')] AS timed FROM tw),
aligned AS (SELECT *, round(len(timed)::DOUBLE / greatest(n, 1), 3) AS timed_ratio, coalesce(round(0.05::DOUBLE + timed[1] * step, 3) >= 0.06::DOUBLE AND round(0.05::DOUBLE + (timed[-1] + 0.8::DOUBLE) * step, 3) <= duration - 0.06::DOUBLE, false) AS edge_ok FROM aw),
gated AS (SELECT *, edge_ok AND align_score >= -3 AND timed_ratio >= 0.9::DOUBLE AS align_ok FROM aligned)"""


def aligned_words(spark, folder):
    """Words of sound transcripts with times spread evenly over the clip, the Latin ones without, and their gate: what an alignment gives."""
    from clipweave.operators.segment import alignment_gate

    t = transcripts(spark, folder).where("ok").select("id", F.filter(F.split(T.strip_tags(F.col("text")), " "), lambda w: w != "").alias("w"))
    joined = clips(spark, folder).where("duration > 0").join(t, "id")
    step = (F.col("duration") - 0.1) / F.greatest(F.size("w"), F.lit(1))

    def word(w, i):
        latin = w.rlike("[A-Za-z]")
        return F.struct(w.alias("word"), F.when(~latin, F.round(0.05 + i * step, 3)).alias("start"), F.when(~latin, F.round(0.05 + (i + 0.8) * step, 3)).alias("end"))

    words = joined.withColumns({"words": F.transform("w", word), "align_score": F.round(-1 - 10 * (1 - F.coalesce("window_similarity", F.lit(0.0))), 4)})
    timed = F.size(F.filter("words", lambda x: x["start"].isNotNull()))
    return alignment_gate(words.withColumn("timed_ratio", F.round(timed / F.greatest(F.size("w"), F.lit(1)), 3)), edge=0.06)


@query(f"WITH {_ALIGNED} SELECT id, align_score, timed_ratio, edge_ok, align_ok FROM gated")
def align_gate(spark, folder):
    """Whether the aligned words of every clip keep off its edges and are many and good enough."""
    return aligned_words(spark, folder).select("id", "align_score", "timed_ratio", "edge_ok", "align_ok")


@query(f"""WITH {_ALIGNED}, {VIDEOS_SQL} SELECT c.id, t.text, coalesce(nullif(t.text_tagged, ''), t.text) AS text_tagged, coalesce(array_to_string(t.tags, '|'), '') AS tags, c.duration, c.speaker_id, c.gender,
  len(regexp_extract_all(trim(regexp_replace(regexp_replace(t.text, '{T.TAG}', ' ', 'g'), '\\s+', ' ', 'g')), '{T.LATIN_WORD.replace("'", "''")}')) > 0 AND regexp_matches(t.text, '{T.ARABIC}') AS code_switched, g.n AS words, len(g.timed) AS timed_words, v.channel, c.video_id, v.url AS video_url,
  c.start_sec AS start, c.end_sec AS "end", c.source, c.dnsmos_ovrl, c.dnsmos_sig, c.dnsmos_bak, c.utmos, g.align_score, t.backend AS asr_backend
FROM clips c JOIN gated g ON g.id = c.id JOIN transcript t ON t.id = c.id LEFT JOIN video v ON v.id = c.video_id WHERE g.align_ok""")
def published(spark, folder):
    """What is published of every clip that passed alignment: all columns, tags as one string, words by their numbers."""
    a = aligned_words(spark, folder).where("align_ok").drop("channel", "playlist")
    t = transcripts(spark, folder).select("id", "text", "text_tagged", "tags", F.col("backend").alias("asr_backend"))
    v = videos(spark, folder).select(F.col("id").alias("video_id"), F.col("url").alias("video_url"), "channel")
    rows = a.join(t, "id").join(v, "video_id", "left").withColumns({"code_switched": T.is_code_switched(F.col("text")), "start": F.col("start_sec"), "end": F.col("end_sec")})
    out = assembly.published_rows(rows)
    timed = F.size(F.filter("words", lambda w: w["start"].isNotNull()))
    return out.withColumns({"timed_words": timed, "tags": F.array_join("tags", "|")}).withColumn("words", F.size("words"))


@query(f"WITH {CLIPS_SQL} SELECT 'corpus-' || CAST(round_even(sum(ms) / {_H}::DOUBLE, 0) AS BIGINT) || 'h' AS name FROM clips")
def release_name(spark, folder):
    """The name of a release, with its hours."""
    return assembly.release_name("corpus", clips(spark, folder))


_LENGTH = "CAST(round(coalesce(duration, 0) * 1000) AS BIGINT)"


@query(f"""WITH {VIDEOS_SQL}, {CLIPS_SQL}, v AS (SELECT id, {_LENGTH} AS ms FROM video), done AS (SELECT 'segment' AS step, video_id AS id FROM clips UNION SELECT 'quality', video_id FROM clips WHERE dnsmos_bak IS NOT NULL
  UNION SELECT 'speaker_check', video_id FROM clips WHERE window_similarity IS NOT NULL UNION SELECT 'transcribe', c.video_id FROM clips c SEMI JOIN transcripts t ON t.id = c.id)
SELECT step, count(*) AS done, (SELECT count(*) FROM v) AS total, round(sum(ms) / {_H}::DOUBLE, 6) AS hours FROM done JOIN v USING (id) GROUP BY step""")
def step_status(spark, folder):
    """How many videos each step has done, and their hours."""
    c = clips(spark, folder).select("id", F.col("video_id"), "dnsmos_bak", "window_similarity")
    v = videos(spark, folder).select("id", F.round(F.coalesce("duration", F.lit(0.0)) * 1000).cast("long").alias("ms"))
    said = c.join(transcripts(spark, folder).select("id"), "id", "left_semi")
    parts = {"segment": c, "quality": c.where("dnsmos_bak IS NOT NULL"), "speaker_check": c.where("window_similarity IS NOT NULL"), "transcribe": said}
    return stats.step_status(v, {n: p.select(F.col("video_id").alias("id")) for n, p in parts.items()})


_SPK_MS = "per AS (SELECT speaker_id, max(gender) AS gender, CAST(sum(coalesce(ms, 0)) AS BIGINT) AS ms FROM clips WHERE speaker_id IS NOT NULL GROUP BY 1), every AS (SELECT 'all' AS gender, ms FROM per UNION ALL SELECT coalesce(gender, '?'), ms FROM per)"


def _speaker_ms(spark, folder):
    return clips(spark, folder).where("speaker_id IS NOT NULL").groupBy("speaker_id").agg(F.max("gender").alias("gender"), F.sum(F.coalesce("ms", F.lit(0))).alias("ms"))


@query(f"""WITH {CLIPS_SQL}, {_SPK_MS} SELECT gender, count(*) AS speakers, round(sum(ms) / {_H}::DOUBLE, 6) AS hours, round(sum(ms)::DOUBLE / (SELECT sum(ms) FROM per), 6) AS share, round(sum(ms)::DOUBLE / count(*) / {_H}::DOUBLE, 6) AS mean_h,
  round(quantile_cont(ms::DOUBLE, 0.5) / {_H}::DOUBLE, 6) AS median_h, round(min(ms) / 60000.0::DOUBLE, 6) AS min_minutes, round(max(ms) / {_H}::DOUBLE, 6) AS max_h, count(*) FILTER (ms >= 300000) AS five_minutes, count(*) FILTER (ms >= 3600000) AS one_hour, count(*) FILTER (ms >= 36000000) AS ten_hours FROM every GROUP BY gender""")
def cluster_report(spark, folder):
    """Speakers and their hours, for all and by gender."""
    return stats.cluster_report(_speaker_ms(spark, folder))


_STAT_METRICS = ("dnsmos_ovrl", "dnsmos_sig", "dnsmos_bak", "utmos")
_STATS = {
    "clips": "count(*)::DOUBLE", "hours": f"sum(coalesce(ms, 0)) / {_H}::DOUBLE", "speakers": "count(DISTINCT speaker_id)::DOUBLE", "videos": "count(DISTINCT video_id)::DOUBLE", "channels": "count(DISTINCT channel)::DOUBLE",
    "mean_sec": "avg(ms / 1000.0::DOUBLE)", "median_sec": "quantile_cont(ms / 1000.0::DOUBLE, 0.5)", "min_sec": "min(ms / 1000.0::DOUBLE)", "max_sec": "max(ms / 1000.0::DOUBLE)", **{f"mean_{m}": f"avg({m})" for m in _STAT_METRICS},
}


@query(f"WITH {CLIPS_SQL} " + " UNION ALL ".join(f"SELECT '{n}' AS name, round({e}, 4) AS value FROM clips" for n, e in _STATS.items()))
def corpus_stats(spark, folder):
    """The figures of a corpus: clips, hours, distinct values, lengths and mean scores."""
    return stats.corpus_stats(clips(spark, folder), list(_STAT_METRICS))


@query(f"WITH {CLIPS_SQL}, {_SPK_MS} SELECT round(max(ms)::DOUBLE / sum(ms), 6) AS share FROM per")
def largest_share(spark, folder):
    """The largest speaker's share of all hours."""
    return stats.largest_share(_speaker_ms(spark, folder))


@query(f"WITH {CLIPS_SQL} SELECT channel, round(sum(coalesce(ms, 0)) / {_H}::DOUBLE, 6) AS hours FROM clips WHERE channel IS NOT NULL GROUP BY 1 ORDER BY sum(coalesce(ms, 0)) DESC, channel LIMIT 40")
def channel_hours(spark, folder):
    """The forty channels with most hours: a top-k report."""
    return stats.top_hours(clips(spark, folder), "channel", 40)


@query(f"""WITH {CLIPS_SQL}, b AS (SELECT speaker_id, sum(coalesce(ms, 0)) AS m FROM clips WHERE speaker_id IS NOT NULL GROUP BY 1 ORDER BY m DESC, speaker_id LIMIT 40), a AS (SELECT speaker_id, round(sum(coalesce(ms, 0)) / {_H}::DOUBLE, 6) AS after FROM clips WHERE dnsmos_bak >= 3.9::DOUBLE GROUP BY 1)
SELECT speaker_id, round(m / {_H}::DOUBLE, 6) AS before, after FROM b LEFT JOIN a USING (speaker_id)""")
def hours_before_and_after(spark, folder):
    """The forty largest speakers' hours before and after a filter: a top-k report."""
    c = clips(spark, folder)
    return stats.before_and_after(c, c.where("dnsmos_bak >= 3.9D"), "speaker_id", 40)


@query(f"WITH {CLIPS_SQL} SELECT video_id, 'speaker_' || local_speaker AS speaker, round(sum(CAST(round((end_sec - start_sec) * 1000) AS BIGINT)) / 60000.0::DOUBLE, 6) AS minutes FROM clips WHERE start_sec < end_sec GROUP BY 1, 2")
def diarized_minutes(spark, folder):
    """Minutes of every voice of a video, from arrays of segments."""
    c = clips(spark, folder).where("start_sec < end_sec")
    name = F.format_string("speaker_%d", "local_speaker")
    segments = c.groupBy("video_id").agg(F.collect_list(F.struct(F.col("start_sec").alias("start"), F.col("end_sec").alias("end"), name.alias("speaker"))).alias("segments"))
    return assembly.diarized_minutes(segments)


@query(f"""WITH {CLIPS_SQL}, d AS (SELECT id, duration AS d, dnsmos_bak AS b FROM clips WHERE duration > 0 AND dnsmos_bak IS NOT NULL), s AS (SELECT id, b, unnest(CASE WHEN d <= 3 THEN [0.0::DOUBLE] ELSE list_distinct(list_concat([round(i * 1.5::DOUBLE, 3) FOR i IN range(0, greatest(0, CAST(floor((d - 3) / 1.5::DOUBLE + 0.000000001::DOUBLE) AS INTEGER)) + 1)], [round(d - 3, 3)])) END) AS start FROM d)
SELECT id, avg(CAST(round(b * 1000 + start * 1000) AS BIGINT)) AS score FROM s GROUP BY id""")
def window_means(spark, folder):
    """The mean of a score that rises within the clip over all its windows."""
    c = clips(spark, folder).where("dnsmos_bak IS NOT NULL")
    w = ts.sliding_windows(c, key="id", duration="duration").join(c.select("id", "dnsmos_bak"), "id")
    return assembly.window_means(w.select("id", F.round(F.col("dnsmos_bak") * 1000 + F.col("start") * 1000).cast("long").alias("score")), ["score"])


@query(f"WITH {VIDEOS_SQL} SELECT sample_rate FROM video WHERE sample_rate IS NOT NULL GROUP BY 1")
def sample_rates(spark, folder):
    """The sample rates there are."""
    rates = videos(spark, folder).agg(F.sort_array(F.collect_set("sample_rate")).alias("r"))
    return rates.select(F.explode("r").alias("sample_rate"))


@query(f"""WITH {VIDEOS_SQL}, x AS (SELECT id, unnest(range(0, 6)) AS n, size FROM video WHERE duration > 0 AND size IS NOT NULL) SELECT id, max((size + n * 7919) % 60 - 50) > 5 AS separate FROM x GROUP BY id""")
def separation(spark, folder):
    """Which videos have music taken out: those one of whose six probed levels passes the threshold."""
    from clipweave.operators.segment import probe_windows

    v = videos(spark, folder).where("size IS NOT NULL")
    probed = probe_windows(v).join(v.select("id", "size"), "id")
    return assembly.separation(probed.select("id", ((F.col("size") + F.col("n") * 7919) % 60 - 50).alias("music_db")), threshold=5)


@query("WITH one AS (SELECT id, any_value(music_db) AS m, any_value(local_speaker) AS l FROM chunks WHERE id IS NOT NULL GROUP BY id) SELECT id, CASE WHEN l % 2 = 0 AND CASE WHEN NOT isnan(m) THEN round(m::DOUBLE, 3) END > -40 THEN 'vocals' ELSE 'original' END AS source FROM one")
def source_choice(spark, folder):
    """Which audio every clip is cut from; even voices count as separated."""
    from clipweave.plans.base import rounded

    c = clips(spark, folder, "music_db")
    return c.select("id", assembly.source_choice(rounded("music_db"), F.coalesce(F.col("local_speaker") % 2 == 0, F.lit(False)), -40.0).alias("source"))


@query(f"""WITH {CLIPS_SQL}, p AS (SELECT id, speaker_id, coalesce(ms, 0) AS ms, CASE gender WHEN 'female' THEN 0.9::DOUBLE WHEN 'male' THEN 0.2::DOUBLE ELSE 0.5::DOUBLE END AS f FROM clips WHERE speaker_id IS NOT NULL),
l AS (SELECT *, row_number() OVER (PARTITION BY speaker_id ORDER BY ms DESC, id) AS r FROM p), d AS (SELECT *, row_number() OVER (PARTITION BY speaker_id ORDER BY md5('0' || chr(1) || id), id) AS k FROM l WHERE r <= 32)
SELECT speaker_id, CASE WHEN avg(f) >= 0.5 THEN 'female' ELSE 'male' END AS gender, round(abs(avg(f) - 0.5::DOUBLE) * 2, 3) AS confidence FROM d WHERE k <= 8 GROUP BY 1""")
def gender_votes(spark, folder):
    """The gender of every speaker, by a scorer's mean over eight of its longest clips; the given gender stands for the scorer."""
    p = F.when(F.col("gender") == "female", 0.9).when(F.col("gender") == "male", 0.2).otherwise(0.5)
    return assembly.gender_votes(clips(spark, folder).select("id", "speaker_id", F.coalesce("ms", F.lit(0)).alias("ms"), p.alias("p_female")))
