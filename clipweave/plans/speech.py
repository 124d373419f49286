"""Queries over transcripts and frame series."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipweave.functions import text as T
from clipweave.operators import stats
from clipweave.operators import timeseries as ts
from clipweave.plans.base import CLIPS_SQL, TRANSCRIPTS_SQL, VIDEOS_SQL, clips, registrar, transcripts, videos

QUERIES, SQL, query = registrar()


def _squeezed(expr: str) -> str:
    return f"trim(regexp_replace({expr}, '\\s+', ' ', 'g'))"


_BARE = _squeezed(f"regexp_replace(text, '{T.TAG}', ' ', 'g')")
_AR, _LA = f"len(regexp_extract_all({{0}}, '{T.ARABIC}'))", f"len(regexp_extract_all({{0}}, '{T.LATIN}'))"
_LATIN_SQL = T.LATIN_WORD.replace("'", "''")
_RATIO = f"coalesce({_AR.format('text')}::DOUBLE / nullif({_AR.format('text')} + {_LA.format('text')}, 0), 0)"
BARE_SQL = f"{TRANSCRIPTS_SQL}, bare AS (SELECT *, {_BARE} AS plain FROM transcript WHERE text IS NOT NULL)"
_WORDS = f"regexp_extract_all(plain, '{_LATIN_SQL}')"


def _texts(spark, folder):
    return transcripts(spark, folder).where("text IS NOT NULL")


@query(f"WITH {BARE_SQL} SELECT id, plain FROM bare")
def strip_tags(spark, folder):
    """Transcripts without bracket tags."""
    return _texts(spark, folder).select("id", T.strip_tags(F.col("text")).alias("plain"))


@query(f"WITH {BARE_SQL} SELECT id, round({_RATIO}, 6) AS ratio, {_AR.format('plain')} + {_LA.format('plain')} AS letters, array_to_string({_WORDS}, ' ') AS latin, len({_WORDS}) > 0 AND {_AR.format('text')} > 0 AS switched FROM bare")
def script_profile(spark, folder):
    """Share of Arabic letters, letters, Latin words and code switching of every transcript."""
    t = F.col("text")
    return _texts(spark, folder).select("id", F.round(T.arabic_ratio(t), 6).alias("ratio"), T.letters(t).alias("letters"), F.array_join(T.latin_words(t), " ").alias("latin"), T.is_code_switched(t).alias("switched"))


_NORM = f"regexp_replace(translate(regexp_replace(lower(plain), '{T.MARKS}', '', 'g'), 'أإآٱةىؤئ', 'ااااهيوي'), '[^\\p{{L}}\\p{{N}}\\s]', ' ', 'g')"


@query(f"WITH {BARE_SQL} SELECT id, {_squeezed(_NORM)} AS form FROM bare")
def normalized(spark, folder):
    """Transcripts in the form in which they are compared, without the compatibility composition that SQL lacks."""
    return _texts(spark, folder).select("id", T.normalize_for_compare(F.col("text"), compose=False).alias("form"))


@query()
def normalized_composed(spark, folder):
    """Transcripts in the form in which they are compared."""
    return _texts(spark, folder).select("id", T.normalize_for_compare(F.col("text")).alias("form"))


def _loop_sql(w: str) -> str:
    def one(n: int) -> str:
        blocks = f"[array_to_string({w}[k * {n} + 1:(k + 1) * {n}], ' ') FOR k IN range(0, len({w}) // {n})]"
        return f"coalesce(list_bool_or([len(list_distinct(bl[i:i + 5])) = 1 FOR i IN range(1, len(bl) - 4)]), false)".replace("bl", f"({blocks})")

    return " OR ".join(one(n) for n in (1, 2, 3))


@query(f"WITH {BARE_SQL}, w AS (SELECT id, plain, string_split(plain, ' ') AS w FROM bare) SELECT id, plain <> '' AND ({_loop_sql('w')}) AS looping FROM w")
def repetition_loop(spark, folder):
    """Transcripts in which one to three words follow each other six times."""
    return _texts(spark, folder).select("id", T.has_repetition_loop(F.col("text")).alias("looping"))


_RATE = f"(({_AR.format('plain')} + {_LA.format('plain')}) / greatest(coalesce(ms, 0) / 1000.0::DOUBLE, 0.000001::DOUBLE))"


@query(f"""WITH {CLIPS_SQL}, {BARE_SQL}, j AS (SELECT id, text, plain, ms, string_split(plain, ' ') AS w FROM bare JOIN clips USING (id))
SELECT id, round({_RATE}, 2) AS rate, array_to_string([x FOR x IN [CASE WHEN regexp_replace(text, '^\\s+|\\s+$', '', 'g') = '' THEN 'empty' END, CASE WHEN {_RATE} < 4 THEN 'too_slow' END, CASE WHEN {_RATE} > 28 THEN 'too_fast' END,
  CASE WHEN {_RATIO} < 0.5::DOUBLE THEN 'not_arabic' END, CASE WHEN plain <> '' AND ({_loop_sql('w')}) THEN 'repetition' END] IF x IS NOT NULL], '|') AS flags FROM j""")
def sanity_flags(spark, folder):
    """What is wrong with every transcript, given its clip's length."""
    joined = _texts(spark, folder).join(clips(spark, folder).select("id", "ms"), "id")
    t, seconds = F.col("text"), F.coalesce(F.col("ms"), F.lit(0)) / 1000.0
    rate = T.letters(t) / F.greatest(seconds, F.lit(1e-6))
    return joined.select("id", F.round(rate, 2).alias("rate"), F.array_join(T.sanity_flags(t, seconds), "|").alias("flags"))


# Every Arabic letter as an ASCII character that compared forms don't have, so that SQL, which counts bytes, counts characters.
_ARABIC, _AS_ASCII = "ابتثجحخدذرزسشصضطظعغفقكلمنهويء", "ABCDEFGHIJKLMNOPQRSTUVWXYZ!#$"


def spelt(text):
    """The compared form of a text, each Arabic letter as one ASCII character; other letters are left out."""
    return F.regexp_replace(F.translate(T.normalize_for_compare(text, compose=False), _ARABIC, _AS_ASCII), "[^ -~]", "")


def spelt_sql(column: str) -> str:
    """The same in SQL."""
    plain = _squeezed(f"regexp_replace({column}, '{T.TAG}', ' ', 'g')")
    form = f"regexp_replace(translate(regexp_replace(lower({plain}), '{T.MARKS}', '', 'g'), 'أإآٱةىؤئ', 'ااااهيوي'), '[^\\p{{L}}\\p{{N}}\\s]', ' ', 'g')"
    return f"regexp_replace(translate({_squeezed(form)}, '{_ARABIC}', '{_AS_ASCII}'), '[^ -~]', '', 'g')"


@query(f"WITH {TRANSCRIPTS_SQL}, p AS (SELECT id, {spelt_sql('text')} AS a, {spelt_sql('text_tagged')} AS b FROM transcript WHERE text IS NOT NULL AND text_tagged IS NOT NULL) SELECT id, round(CASE WHEN length(a) = 0 THEN CASE WHEN length(b) = 0 THEN 0 ELSE 1 END ELSE levenshtein(a, b)::DOUBLE / length(a) END, 6) AS cer FROM p")
def cer_pairs(spark, folder):
    """Edits per character between the compared forms of the plain and the tagged text, spelt so that SQL counts alike."""
    t = transcripts(spark, folder).where("text IS NOT NULL AND text_tagged IS NOT NULL")
    forms = t.select("id", spelt(F.col("text")).alias("a"), spelt(F.col("text_tagged")).alias("b"))
    return forms.select("id", F.round(T.cer(F.col("a"), F.col("b")), 6).alias("cer"))


@query()
def cer_pairs_whole(spark, folder):
    """Edits per character between the plain and the tagged text, on all their characters, which SQL counts as bytes."""
    t = transcripts(spark, folder).where("text IS NOT NULL AND text_tagged IS NOT NULL")
    return t.select("id", F.round(T.cer(F.col("text"), F.col("text_tagged")), 6).alias("cer"))


@query(f"WITH {TRANSCRIPTS_SQL}, w AS (SELECT unnest(regexp_extract_all({_BARE}, '[ء-ي]{{3,}}')) AS word FROM transcript WHERE text IS NOT NULL) SELECT word, count(*) AS n FROM w GROUP BY 1 ORDER BY n DESC, word LIMIT 40")
def top_tokens(spark, folder):
    """The forty most frequent Arabic words: a top-k report."""
    return stats.top_counts(_texts(spark, folder).select(F.explode(T.word_counts(F.col("text"))).alias("word")), "word", 40)


@query(f"WITH {CLIPS_SQL}, {TRANSCRIPTS_SQL}, total AS (SELECT sum(coalesce(ms, 0)) / 3600000.0::DOUBLE AS h FROM clips SEMI JOIN transcript USING (id)), x AS (SELECT unnest(tags) AS tag FROM transcript) SELECT tag, count(*) AS n, round(count(*) / max(h), 6) AS per_hour FROM x, total GROUP BY tag")
def tag_rates(spark, folder):
    """How often each tag occurs, and per hour of transcribed speech."""
    t = transcripts(spark, folder)
    h = (clips(spark, folder).join(t, "id", "left_semi").agg(F.sum(F.coalesce("ms", F.lit(0)))).first()[0] or 0) / 3_600_000.0
    return t.select(F.explode("tags").alias("tag")).groupBy("tag").agg(F.count("*").alias("n")).withColumn("per_hour", F.round(F.col("n") / F.nullif(F.lit(h), F.lit(0.0)), 6))


@query(f"WITH {TRANSCRIPTS_SQL}, x AS (SELECT unnest(flags) AS flag FROM transcript) SELECT flag, count(*) AS n FROM x GROUP BY flag")
def flag_counts(spark, folder):
    """How many transcripts have each flag."""
    return transcripts(spark, folder).select(F.explode("flags").alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))


@query(f"WITH {TRANSCRIPTS_SQL} SELECT backend, count(*) AS n, round(avg(CASE WHEN ok THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS ok_rate FROM transcript GROUP BY backend")
def ok_rates(spark, folder):
    """Share of sound transcripts by backend."""
    return transcripts(spark, folder).groupBy("backend").agg(F.count("*").alias("n"), F.round(F.avg(F.when(F.col("ok"), 1.0).otherwise(0.0)), 6).alias("ok_rate"))


@query(f"WITH {CLIPS_SQL}, {BARE_SQL} SELECT CASE WHEN len({_WORDS}) > 0 AND {_AR.format('text')} > 0 THEN 'mixed' WHEN {_AR.format('text')} > 0 THEN 'arabic' ELSE 'other' END AS kind, count(*) AS clips, round(sum(coalesce(ms, 0)) / 3600000.0::DOUBLE, 6) AS hours FROM bare JOIN clips USING (id) GROUP BY 1")
def code_switch_hours(spark, folder):
    """Hours by kind of language use."""
    t = F.col("text")
    kind = F.when(T.is_code_switched(t), "mixed").when(T.count_of(t, T.ARABIC) > 0, "arabic").otherwise("other")
    return _texts(spark, folder).join(clips(spark, folder), "id").groupBy(kind.alias("kind")).agg(F.count("*").alias("clips"), stats.hours().alias("hours"))


@query()
def clean_tags(spark, folder):
    """Tagged transcripts with only known tags, in canonical spelling, and every span closed."""
    cleaned = transcripts(spark, folder).where("text_tagged IS NOT NULL").select("id", T.tag_cleaner()("text_tagged").alias("c"))
    return cleaned.select("id", F.col("c.text").alias("text"), F.array_join("c.tags", "|").alias("tags"))


# Frame series of one second, made of the clips: who speaks when in a video.

_FRAMES = f"""{CLIPS_SQL},
act AS (SELECT DISTINCT video_id, unnest(range(CAST(floor(start_sec) AS BIGINT), CAST(ceil(end_sec) AS BIGINT))) AS frame, local_speaker AS speaker FROM clips WHERE start_sec < end_sec),
grid AS (SELECT video_id, unnest(range(0, max(frame) + 1)) AS frame FROM act GROUP BY video_id),
frames AS (SELECT g.video_id, g.frame, a.speaker FROM grid g LEFT JOIN act a ON a.video_id = g.video_id AND a.frame = g.frame)"""


def _active(spark, folder):
    c = clips(spark, folder).where("start_sec < end_sec")
    return c.select("video_id", F.explode(F.sequence(F.floor("start_sec"), F.ceil("end_sec") - 1)).alias("frame"), F.col("local_speaker").alias("speaker")).distinct()


def _frames(spark, folder):
    act = _active(spark, folder)
    grid = act.groupBy("video_id").agg(F.max("frame").alias("m")).select("video_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m"))).alias("frame"))
    return grid.join(act, ["video_id", "frame"], "left")


@query(f"WITH {_FRAMES}, i AS (SELECT *, frame - row_number() OVER (PARTITION BY video_id, speaker ORDER BY frame) AS g FROM act) SELECT video_id, speaker, min(frame) AS start, max(frame) + 1 AS stop FROM i GROUP BY video_id, speaker, g")
def runs(spark, folder):
    """Runs of consecutive seconds of every speaker."""
    return ts.runs(_active(spark, folder), ["video_id", "speaker"])


@query(f"""WITH {_FRAMES}, c AS (SELECT video_id, frame AS f, count(speaker) AS cnt, min(speaker) AS k1 FROM frames GROUP BY 1, 2), x AS (SELECT *, max(f) OVER (PARTITION BY video_id) AS mx FROM c),
nn AS (SELECT *, lag(f) OVER w AS pnn, lead(f) OVER w AS nnn, row_number() OVER w AS seq FROM x WHERE cnt > 0 WINDOW w AS (PARTITION BY video_id ORDER BY f)),
o AS (SELECT *, lag(f) OVER w AS pf, lag(seq) OVER w AS ps FROM nn WHERE cnt = 1 WINDOW w AS (PARTITION BY video_id, k1 ORDER BY f)),
i AS (SELECT *, sum(CASE WHEN pf IS NULL OR f - pf - 1 > 3 OR seq - ps > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY video_id, k1 ORDER BY f) AS isl FROM o),
t AS (SELECT video_id, k1, isl, min(f) AS a, max(f) + 1 AS b, count(*) AS own, min(coalesce(pnn, -1)) AS pnn, max(coalesce(nnn, mx + 1)) AS nnn FROM i GROUP BY 1, 2, 3)
SELECT video_id, k1 AS speaker, greatest(a - 1, pnn + 1) AS start, least(b + 1, nnn) AS stop, round(own::DOUBLE / (b - a), 6) AS share FROM t WHERE least(b + 1, nnn) - greatest(a - 1, pnn + 1) >= 4""")
def turns(spark, folder):
    """Turns in which one speaker alone speaks, over gaps of three silent seconds."""
    return ts.single_speaker_turns(_frames(spark, folder), max_gap=3, pad=1, least=4)


_COUNTED = f"{_FRAMES}, per AS (SELECT video_id, frame, count(speaker) AS n FROM frames GROUP BY 1, 2)"


def _counted(spark, folder):
    return _frames(spark, folder).groupBy("video_id", "frame").agg(F.count("speaker").alias("n"))


@query(f"WITH {_COUNTED} SELECT video_id, frame, max(CASE WHEN n > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY video_id ORDER BY frame RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING) = 1 AS blocked FROM per")
def dilate_guard(spark, folder):
    """Seconds within two seconds of overlapping speech."""
    return _counted(spark, folder).select("video_id", "frame", ts.dilate(F.col("n") > 1, ["video_id"], "frame", 2).alias("blocked"))


@query(f"WITH {_COUNTED} SELECT video_id, frame, round(sum(n) OVER (PARTITION BY video_id ORDER BY frame ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) / 3.0::DOUBLE, 6) AS smooth FROM per")
def moving_average(spark, folder):
    """Active speakers, smoothed over three seconds with zeros beyond the ends."""
    return _counted(spark, folder).select("video_id", "frame", F.round(ts.moving_average(F.col("n"), ["video_id"], "frame", 3), 6).alias("smooth"))


@query(f"WITH {_COUNTED} SELECT video_id, frame, n = min(n) OVER (PARTITION BY video_id ORDER BY frame ROWS BETWEEN 15 PRECEDING AND 15 FOLLOWING) AS low FROM per")
def local_minima(spark, folder):
    """Seconds with the least activity within fifteen seconds."""
    return _counted(spark, folder).select("video_id", "frame", ts.is_local_minimum(F.col("n"), ["video_id"], "frame").alias("low"))


@query(f"WITH {_COUNTED} SELECT video_id, frame * 4 + o AS frame, n FROM per, (SELECT unnest(range(0, 4)) AS o)")
def regrid(spark, folder):
    """The activity on a grid four times as fine."""
    return ts.regrid(_counted(spark, folder), keys=["video_id"], value="n", frame_sec=1.0, step_sec=0.25)


@query(f"""WITH {VIDEOS_SQL}, v AS (SELECT id, duration AS d, greatest(1, CAST(ceil((duration - 20) / 280) AS INTEGER)) AS k FROM video WHERE duration > 0), x AS (SELECT id, d, unnest(range(0, k)) AS n FROM v)
SELECT id, CAST(n AS INTEGER) AS n, round(n * 280.0::DOUBLE, 3) AS start, round(least(n * 280.0::DOUBLE + 300, d), 3) AS "end" FROM x""")
def window_cover(spark, folder):
    """Windows of five minutes with twenty seconds of overlap that cover every video."""
    return ts.window_cover(videos(spark, folder), key="id", duration="duration", window=300.0, overlap=20.0)


@query(f"""WITH {CLIPS_SQL}, d AS (SELECT id, duration AS d FROM clips WHERE duration > 0), s AS (SELECT id, d, unnest(CASE WHEN d <= 3 THEN [0.0::DOUBLE] ELSE list_distinct(list_concat([round(i * 1.5::DOUBLE, 3) FOR i IN range(0, greatest(0, CAST(floor((d - 3) / 1.5::DOUBLE + 0.000000001::DOUBLE) AS INTEGER)) + 1)], [round(d - 3, 3)])) END) AS start FROM d)
SELECT id, start, round(least(start + 3, d), 3) AS "end" FROM s""")
def sliding_windows(spark, folder):
    """Windows of three seconds every second and a half over every clip, and one at its end."""
    return ts.sliding_windows(clips(spark, folder), key="id", duration="duration")


@query("""WITH e AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events), s AS (SELECT *, sum(CASE WHEN p IS NULL OR ts - p >= INTERVAL 6 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM e)
SELECT user_id, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us, count(*) AS n FROM s GROUP BY user_id, k""")
def sessions(spark, folder):
    """Sessions of every user, ended by six quiet hours; an addition of ours, in built-in session windows."""
    from clipweave.sources.tables import table

    e = table(spark, folder, "events")
    grouped = e.groupBy("user_id", F.session_window("ts", "6 hours")).agg(F.min("ts").alias("a"), F.max("ts").alias("b"), F.count("*").alias("n"))
    return grouped.select("user_id", F.unix_micros("a").alias("first_us"), F.unix_micros("b").alias("last_us"), "n")


@query("SELECT event_type, epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) AS hour_us, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def hourly(spark, folder):
    """Events per type and hour, in built-in tumbling windows."""
    from clipweave.sources.tables import table

    e = table(spark, folder, "events")
    return e.groupBy("event_type", F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select("event_type", F.unix_micros("w.start").alias("hour_us"), "n", "total")
