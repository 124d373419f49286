"""Queries of the balance stage, the tuner and the analyses that follow."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from clipweave.functions import text as T
from clipweave.operators import balance, rules, select, stats, topics
from clipweave.operators import timeseries as ts
from clipweave.plans.assembly import _ALIGNED, _SPEAKERS, _speakers, aligned_words
from clipweave.plans.base import CLIPS_SQL, METRICS, TRANSCRIPTS_SQL, clips, registrar, transcripts
from clipweave.plans.speech import _counted, _COUNTED, spelt, spelt_sql
from clipweave.sources.tables import table

QUERIES, SQL, query = registrar()
_CER = 0.3

_FORMS = f"""forms AS (SELECT id, {spelt_sql('text')} AS a, {spelt_sql('text_tagged')} AS b FROM transcript WHERE text IS NOT NULL AND text_tagged IS NOT NULL),
agree AS (SELECT id, CASE WHEN length(a) = 0 THEN CASE WHEN length(b) = 0 THEN 0 ELSE 1 END ELSE levenshtein(a, b)::DOUBLE / length(a) END <= {_CER}::DOUBLE AS same FROM forms)"""
_GATED = f"""{_ALIGNED}, {_FORMS}, {_SPEAKERS}, outcomes AS (SELECT c.id, c.video_id, c.speaker_id, sp.gender, coalesce(c.ms, 0) AS ms, c.utmos, c.dnsmos_ovrl, c.weak_cut, g.align_score, CASE WHEN t.id IS NULL THEN 'not_transcribed' WHEN NOT coalesce(t.ok, false) THEN 'transcript_sanity'
  WHEN NOT coalesce(g.align_ok, false) THEN 'alignment' WHEN t.text_tagged IS NULL THEN 'not_verified' WHEN NOT coalesce(f.same, false) THEN 'asr_disagreement' WHEN c.speaker_id IS NULL THEN 'no_speaker' ELSE 'pass' END AS outcome
FROM clips c LEFT JOIN transcript t ON t.id = c.id LEFT JOIN gated g ON g.id = c.id LEFT JOIN agree f ON f.id = c.id LEFT JOIN sp ON sp.speaker_id = c.speaker_id)"""


def _gated(spark, folder):
    """Clips through all gates; the tagged text, spelt in ASCII as the plain one, stands for a second transcript."""
    c = clips(spark, folder)
    t = transcripts(spark, folder)
    spelled = t.select("id", "ok", spelt(F.col("text")).alias("text"))
    second = t.where("text_tagged IS NOT NULL").select("id", spelt(F.col("text_tagged")).alias("text"))
    aligned = aligned_words(spark, folder).select("id", "align_score", "align_ok")
    own = c.select("id", "video_id", "speaker_id", F.coalesce("ms", F.lit(0)).alias("ms"), "utmos", "dnsmos_ovrl", "weak_cut")
    return balance.gated(own, spelled, aligned, c.where("speaker_id IS NOT NULL").select("id", "speaker_id"), verify=second, most_cer=_CER).join(_speakers(spark, folder), "speaker_id", "left")


@query(f"WITH {_GATED} SELECT id, outcome FROM outcomes")
def balance_gates(spark, folder):
    """The first of six gates every clip fails."""
    return _gated(spark, folder).select("id", "outcome")


@query(f"WITH {_GATED} SELECT outcome, count(*) AS clips FROM outcomes GROUP BY 1")
def balance_waterfall(spark, folder):
    """How many clips each gate keeps back."""
    return _gated(spark, folder).groupBy("outcome").agg(F.count("*").alias("clips"))


# Candidates for the caps: sound transcripts of known speakers; alignment is too strict a gate for the caps to bind on so little.
_SCORE_SQL = "CAST(round(((coalesce(nullif(utmos, 0), 3) - 3) + (coalesce(nullif(dnsmos_ovrl, 0), 3) - 3) + 0.5::DOUBLE * (coalesce(align_score, 0) + 1) - CASE WHEN weak_cut THEN 0.5::DOUBLE ELSE 0 END) * 1000) AS BIGINT)"
_CANDIDATES = f"{_GATED}, cand AS (SELECT id, video_id, speaker_id, gender, ms, {_SCORE_SQL} AS score FROM outcomes WHERE outcome NOT IN ('not_transcribed', 'no_speaker') AND speaker_id IS NOT NULL)"
_SHARE, _TARGET = 0.04, 5_400_000


def _caps_sql(share: float, source: str) -> str:
    steps = ["c0 AS (SELECT 'Infinity'::DOUBLE AS c)"]
    for i in range(5):
        new = f"least(c, {share}::DOUBLE * (SELECT sum(least(ms::DOUBLE, c)) FROM {source}))"
        steps.append(f"c{i + 1} AS (SELECT CASE WHEN abs({new} - c) < 1000 THEN c ELSE {new} END AS c FROM c{i})")
    return ", ".join(steps)


_BALANCED = f"""{_CANDIDATES}, sums AS (SELECT speaker_id, sum(ms) AS ms FROM cand GROUP BY 1), {_caps_sql(_SHARE, "sums")},
a AS (SELECT *, row_number() OVER (PARTITION BY speaker_id, video_id ORDER BY score DESC, id) AS rnd, count(*) OVER (PARTITION BY speaker_id, video_id) AS n, row_number() OVER (PARTITION BY speaker_id ORDER BY score DESC, id) AS rk FROM cand),
b AS (SELECT *, min(rk) OVER (PARTITION BY speaker_id, video_id) AS best FROM a), d AS (SELECT *, coalesce(sum(ms) OVER (PARTITION BY speaker_id ORDER BY rnd, n DESC, best ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prev FROM b),
capped AS (SELECT * FROM d WHERE prev < (SELECT c FROM c5)), run AS (SELECT *, coalesce(sum(ms) OVER (ORDER BY score DESC, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS upto FROM capped),
final AS (SELECT id, video_id, speaker_id, gender, ms, score FROM run WHERE upto < {_TARGET})"""


def _candidates(spark, folder):
    rows = _gated(spark, folder).where("outcome NOT IN ('not_transcribed', 'no_speaker') AND speaker_id IS NOT NULL")
    return rows.select("id", "video_id", "speaker_id", "gender", "ms", F.round(select.quality_score() * 1000).cast("long").alias("score"))


@query(f"WITH {_CANDIDATES} SELECT id, score FROM cand")
def quality_scores(spark, folder):
    """The score by which the balance stage prefers clips, in thousandths."""
    return _candidates(spark, folder).select("id", "score")


@query(f"WITH {_BALANCED} SELECT id, speaker_id, score FROM final")
def balanced(spark, folder):
    """The final selection: a share cap, clips in turns from each speaker's videos, the best up to a target."""
    return balance.balanced(_candidates(spark, folder), share=_SHARE, target_ms=_TARGET).select("id", "speaker_id", "score")


_SPLITS = f"""{_BALANCED}, known AS (SELECT speaker_id, max(gender) AS gender, sum(ms) AS ms FROM final GROUP BY 1), pool AS (SELECT *, count(*) OVER () AS n, row_number() OVER (ORDER BY ms, speaker_id) - 1 AS i FROM known WHERE ms >= 180000),
mid AS (SELECT *, row_number() OVER (PARTITION BY gender ORDER BY md5('0' || chr(1) || speaker_id), speaker_id) AS turn FROM pool WHERE n // 4 >= (3 * n) // 4 OR (i >= n // 4 AND i < (3 * n) // 4)),
held AS (SELECT speaker_id FROM (SELECT *, row_number() OVER (ORDER BY turn, gender NULLS FIRST, speaker_id) AS k FROM mid) WHERE k <= 4 AND k <= n - 1),
tested AS (SELECT *, coalesce(sum(ms) OVER (PARTITION BY speaker_id ORDER BY score DESC, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM final SEMI JOIN held USING (speaker_id)),
others AS (SELECT id, speaker_id, ms, row_number() OVER (ORDER BY md5('0' || chr(1) || id), id) AS k, count(*) OVER () AS n FROM final ANTI JOIN held USING (speaker_id)),
splits AS (SELECT id, speaker_id, ms, 'test' AS split FROM tested WHERE b < 120000 UNION ALL SELECT id, speaker_id, ms, CASE WHEN k <= floor(n * 0.02::DOUBLE) THEN 'validation' ELSE 'train' END FROM others)"""


def _splits(spark, folder):
    return balance.split(balance.balanced(_candidates(spark, folder), share=_SHARE, target_ms=_TARGET), test_speakers=4, test_ms=120_000, fraction=0.02)


@query(f"WITH {_SPLITS} SELECT id, split FROM splits")
def balance_splits(spark, folder):
    """Train, validation and test of the final selection, unseen speakers in the last."""
    return _splits(spark, folder).select("id", "split")


@query(f"WITH {_SPLITS} SELECT split, count(*) AS clips, round(sum(ms) / 3600000.0::DOUBLE, 6) AS hours, count(DISTINCT speaker_id) AS speakers FROM splits GROUP BY 1")
def balance_summary(spark, folder):
    """Clips, hours and speakers of every split."""
    return _splits(spark, folder).groupBy("split").agg(F.count("*").alias("clips"), stats.hours().alias("hours"), F.count_distinct("speaker_id").alias("speakers"))


@query(f"WITH {_SPLITS} SELECT s.id, s.split, c.duration, c.video_id FROM splits s JOIN clips c USING (id)")
def final_frame(spark, folder):
    """The final clips of all splits with their columns."""
    from clipweave import frames

    return frames.final_frame(spark, folder).select("id", "split", "duration", "video_id")


@query(f"WITH {CLIPS_SQL}, {TRANSCRIPTS_SQL} SELECT t.id, c.duration, c.speaker_id, t.ok FROM transcript t LEFT JOIN clips c ON c.id = t.id")
def transcripts_frame(spark, folder):
    """Transcripts with the length and the speaker of their clips."""
    from clipweave import frames

    return frames.transcripts_frame(spark, folder).select("id", "duration", "speaker_id", "ok")


_PER = "per AS (SELECT speaker_id, sum(coalesce(ms, 0)) AS ms FROM clips WHERE speaker_id IS NOT NULL GROUP BY 1)"


@query(f"WITH {CLIPS_SQL}, {_PER}, {_caps_sql(0.05, 'per')} SELECT speaker_id, round(least(ms::DOUBLE, c), 3) AS kept_ms FROM per, c5")
def share_cap(spark, folder):
    """Each speaker's milliseconds under the cap by which none has more than five hundredths of all."""
    per = clips(spark, folder).where("speaker_id IS NOT NULL").groupBy("speaker_id").agg(F.sum(F.coalesce("ms", F.lit(0))).alias("ms"))
    cap = select.share_cap(per, 0.05)
    return per.select("speaker_id", F.round(F.least(F.col("ms").cast("double"), F.lit(cap)), 3).alias("kept_ms"))


@query(f"WITH {CLIPS_SQL} SELECT id FROM (SELECT id FROM clips ORDER BY md5('7' || chr(1) || id), id LIMIT 4000)")
def seeded_sample(spark, folder):
    """Four thousand clips in seeded order: a sample."""
    return select.seeded_sample(clips(spark, folder).select("id"), 4000, seed=7)


_PAGE = "SELECT id, video_id, dnsmos_bak, label, k FROM j WHERE (label = 'bad' AND k) OR (label = 'good' AND NOT k) ORDER BY CAST(round(abs(dnsmos_bak - 3.9::DOUBLE) * 1000) AS BIGINT) NULLS LAST, id LIMIT 40"


@query(f"""WITH {CLIPS_SQL}, one AS (SELECT clip_id AS id, min(label) AS label FROM clip_labels GROUP BY 1 HAVING min(label) = max(label)), j AS (SELECT id, video_id, dnsmos_bak, label, coalesce(dnsmos_bak >= 3.9::DOUBLE, true) AND coalesce(window_similarity >= 0.78::DOUBLE, true) AS k FROM clips LEFT JOIN one USING (id)) {_PAGE}""")
def tuner_page(spark, folder):
    """The first page of the labelled clips that a set of thresholds judges otherwise, the borderline ones first: a top-k report."""
    judged = rules.labelled(clips(spark, folder).withColumn("edge_db", rules.edge_db()), table(spark, folder, "clip_labels"), rules.with_limits(dnsmos_bak=3.9))
    page = rules.page(judged, show="wrong", metric="dnsmos_bak", threshold=3.9, order="borderline", size=40)
    return page.select("id", "video_id", "dnsmos_bak", "label", F.col("kept").alias("k"))


@query(f"WITH {CLIPS_SQL} " + " UNION ALL ".join(f"SELECT '{m}' AS metric, min({m}) AS low, max({m}) AS high, count({m}) AS known FROM clips" for m in METRICS))
def tuner_payload(spark, folder):
    """Range of every metric the tuner shows."""
    return rules.ranges(clips(spark, folder), list(METRICS))


# Frame series made of the clips' activity: levels by how many speak, a voice probability, and speaker probabilities.

_LEVELS = f"{_COUNTED}, lv AS (SELECT video_id, frame, n, CASE WHEN n = 0 THEN -60 ELSE -20 - (frame % 7) * 5 END::DOUBLE AS db, CASE WHEN n = 0 THEN 0.1::DOUBLE ELSE 0.9::DOUBLE - (frame % 5) * 0.1::DOUBLE END AS vad FROM per)"


def _levels(spark, folder):
    f = F.col("frame")
    return _counted(spark, folder).select("video_id", "frame", F.when(F.col("n") == 0, -60.0).otherwise(-20.0 - (f % 7) * 5).alias("db"), F.when(F.col("n") == 0, 0.1).otherwise(0.9 - (f % 5) * 0.1).alias("vad"))


@query(f"""WITH {_LEVELS}, l AS (SELECT video_id, quantile_cont(db, 0.5) FILTER (vad > 0.5::DOUBLE) AS mid, max(db) AS top FROM lv GROUP BY 1)
SELECT video_id, frame, vad > 0.5::DOUBLE AND db >= coalesce(mid, top) - 25 AS speech, vad < 0.35::DOUBLE OR db < coalesce(mid, top) - 25 AS pause FROM lv JOIN l USING (video_id)""")
def speech_masks(spark, folder):
    """Which seconds are speech and which pauses, by voice probability and level."""
    return ts.speech_masks(_levels(spark, folder), keys=["video_id"]).select("video_id", "frame", "speech", "pause")


@query(f"""WITH {_LEVELS}, p AS (SELECT video_id, 'speaker_0' AS speaker, frame, vad AS p FROM lv), i AS (SELECT *, frame - row_number() OVER (PARTITION BY video_id ORDER BY frame) AS g FROM p WHERE p > 0.5::DOUBLE)
SELECT video_id, speaker, round(min(frame) * 0.08::DOUBLE, 3) AS start, round((max(frame) + 1) * 0.08::DOUBLE, 3) AS "end" FROM i GROUP BY video_id, speaker, g HAVING (max(frame) + 1 - min(frame)) * 0.08::DOUBLE >= 0.2::DOUBLE""")
def probability_segments(spark, folder):
    """Segments of frames of high probability that last long enough."""
    return ts.probability_segments(_levels(spark, folder).select("video_id", F.lit("speaker_0").alias("speaker"), "frame", F.col("vad").alias("p")))


@query(f"WITH {_COUNTED} SELECT p.video_id, CAST(i AS BIGINT) AS frame, p.n FROM (SELECT video_id, unnest(range(0, CAST(round((max(frame) + 1) * 3.2::DOUBLE) AS BIGINT))) AS i, max(frame) AS l FROM per GROUP BY 1) g JOIN per p ON p.video_id = g.video_id AND p.frame = least(CAST(floor(i * 0.01::DOUBLE / 0.032::DOUBLE) AS BIGINT), l)")
def regrid_odd(spark, folder):
    """Activity in frames of 32 ms on a grid of 10 ms, of which no whole number makes a frame."""
    return ts.regrid(_counted(spark, folder), keys=["video_id"], value="n", frame_sec=0.032, step_sec=0.01)


@query(f"""WITH {CLIPS_SQL}, x AS (SELECT id, video_id, local_speaker, unnest(range(CAST(floor(start_sec / 0.5::DOUBLE) AS BIGINT), greatest(CAST(floor(start_sec / 0.5::DOUBLE) AS BIGINT), CAST(ceil(end_sec / 0.5::DOUBLE) AS BIGINT) - 1) + 1)) AS frame FROM clips WHERE start_sec < end_sec),
v AS (SELECT DISTINCT video_id, local_speaker FROM clips), f AS (SELECT DISTINCT x.video_id, x.frame, v.local_speaker AS speaker FROM x JOIN v USING (video_id)),
m AS (SELECT x.id, max((x.frame * 31 + f.speaker * 17) % 100) / 100.0::DOUBLE AS p FROM x JOIN f ON f.video_id = x.video_id AND f.frame = x.frame AND f.speaker <> x.local_speaker GROUP BY 1)
SELECT id, coalesce(p, 0) AS other_spk_max FROM clips LEFT JOIN m USING (id) WHERE start_sec < end_sec""")
def other_voice(spark, folder):
    """The highest probability of another voice within every clip."""
    from clipweave.operators import segment

    c = clips(spark, folder).where("start_sec < end_sec").select("id", "video_id", "local_speaker", "start_sec", "end_sec")
    voices = clips(spark, folder).select("video_id", F.col("local_speaker").alias("speaker")).distinct()
    spread = c.select("video_id", F.explode(F.sequence(F.floor(F.col("start_sec") / 0.5), F.greatest(F.floor(F.col("start_sec") / 0.5), F.ceil(F.col("end_sec") / 0.5) - 1))).alias("frame")).distinct()
    frames = spread.join(voices, "video_id").select("video_id", "frame", "speaker", (((F.col("frame") * 31 + F.col("speaker") * 17) % 100) / 100.0).alias("p"))
    return segment.other_voice(c, frames, frame_sec=0.5)


# Vectors.

_USABLE = "speaker_embedding IS NOT NULL AND len(speaker_embedding) = 192 AND list_bool_and([NOT isnan(x) FOR x IN speaker_embedding]) AND list_sum([abs(x) FOR x IN speaker_embedding]) > 0"
_UNIT = f"u AS (SELECT id, any_value(video_id) AS video_id, any_value(local_speaker) AS local_speaker, any_value(CAST(speaker_embedding AS DOUBLE[])) AS e FROM chunks WHERE id IS NOT NULL AND {_USABLE} GROUP BY id), n AS (SELECT *, sqrt(list_sum([x * x FOR x IN e])) AS len FROM u)"


@query(f"""WITH {_UNIT}, d AS (SELECT video_id, local_speaker, generate_subscripts(e, 1) AS i, unnest(e) / len AS x FROM n WHERE video_id IS NOT NULL AND local_speaker IS NOT NULL), m AS (SELECT video_id, local_speaker, i, avg(x) AS x FROM d GROUP BY 1, 2, 3), c AS (SELECT video_id, local_speaker, list(x ORDER BY i) AS c FROM m GROUP BY 1, 2)
SELECT video_id, local_speaker, round(min(list_cosine_similarity(e, c)), 4) AS least FROM n JOIN c USING (video_id, local_speaker) GROUP BY 1, 2""")
def voice_consistency(spark, folder):
    """The least similarity of a clip of every voice of a video to the voice's mean."""
    from clipweave.operators import speakers

    ok = (F.size("speaker_embedding") == 192) & ~F.exists("speaker_embedding", F.isnan) & F.exists("speaker_embedding", lambda x: x != 0)
    c = clips(spark, folder, "speaker_embedding").where("speaker_embedding IS NOT NULL AND video_id IS NOT NULL AND local_speaker IS NOT NULL").where(ok)
    return speakers.consistency(c, keys=["video_id", "local_speaker"], vector="speaker_embedding").select("video_id", "local_speaker", F.round("least", 4).alias("least"))


# Texts.

_STOP_SQL = ", ".join(f"'{w}'" for w in sorted(T.STOP_WORDS))


@query(f"WITH {TRANSCRIPTS_SQL}, w AS (SELECT unnest(regexp_extract_all(trim(regexp_replace(regexp_replace(text, '{T.TAG}', ' ', 'g'), '\\s+', ' ', 'g')), '[ء-ي]+')) AS word FROM transcript WHERE text IS NOT NULL) SELECT word, count(*) AS n FROM w WHERE length(word) > 2 AND word NOT IN ({_STOP_SQL}) GROUP BY 1 ORDER BY n DESC, word LIMIT 40")
def content_words(spark, folder):
    """The forty most frequent Arabic words that aren't stop words: a top-k report."""
    words = transcripts(spark, folder).where("text IS NOT NULL").select(F.explode(T.content_words(F.col("text"))).alias("word"))
    return stats.top_counts(words, "word", 40)


@query(f"WITH {TRANSCRIPTS_SQL}, w AS (SELECT lower(unnest(regexp_extract_all(trim(regexp_replace(regexp_replace(text, '{T.TAG}', ' ', 'g'), '\\s+', ' ', 'g')), '{T.LATIN_WORD.replace(chr(39), chr(39) * 2)}'))) AS word FROM transcript WHERE text IS NOT NULL) SELECT word, count(*) AS n FROM w GROUP BY 1 ORDER BY n DESC, word LIMIT 30")
def english_words(spark, folder):
    """The thirty most frequent Latin words: a top-k report."""
    words = transcripts(spark, folder).where("text IS NOT NULL").select(F.explode(F.transform(T.latin_words(F.col("text")), F.lower)).alias("word"))
    return stats.top_counts(words, "word", 30)


_QUOTES = "chr(34), chr(39), '«', '»', '“', '”'"


@query(f"""WITH a AS (SELECT DISTINCT doc_id, regexp_replace(regexp_replace(text, '(?m)^\\s*```\\w*\\s*$|```', '', 'g'), '^\\s+|\\s+$', '', 'g') AS t FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL),
b AS (SELECT doc_id, regexp_replace(regexp_replace(t, '(?i)^(transcript|transcription|النص|التفريغ)\\s*[:：]\\s*', ''), '^\\s+|\\s+$', '', 'g') AS t FROM a),
c AS (SELECT doc_id, CASE WHEN length(t) >= 2 AND t[1] = t[-1] AND t[1] IN ({_QUOTES}) THEN t[2:-2] ELSE t END AS t FROM b) SELECT doc_id, trim(regexp_replace(t, '\\s+', ' ', 'g')) AS text FROM c""")
def clean_answers(spark, folder):
    """Documents as a model's answers cleaned up: no code fences, no label, no quotes around it all."""
    d = table(spark, folder, "documents").where("text IS NOT NULL AND doc_id IS NOT NULL")
    return d.select("doc_id", T.clean_llm_output(F.col("text")).alias("text")).distinct()


_TOKENS = "unnest(list_filter(regexp_extract_all(lower(text), '[ء-ي]{3,}|[a-z]{3,}'), lambda t: t NOT IN (" + _STOP_SQL + ")))"
_TFIDF = f"""{TRANSCRIPTS_SQL}, n AS (SELECT count(*) AS n FROM transcript WHERE text IS NOT NULL), tf AS (SELECT id, term, count(*) AS tf FROM (SELECT id, {_TOKENS} AS term FROM transcript WHERE text IS NOT NULL) GROUP BY 1, 2),
df AS (SELECT term, count(*) AS df, sum(tf) AS total FROM tf GROUP BY 1 ORDER BY total DESC, term LIMIT 20000), raw AS (SELECT id, term, tf * (ln((1.0::DOUBLE + n) / (1.0::DOUBLE + df)) + 1) AS r FROM tf JOIN df USING (term), n),
weights AS (SELECT id, term, r / sqrt(sum(r * r) OVER (PARTITION BY id)) AS weight FROM raw), topic AS (SELECT id, backend AS topic FROM transcript WHERE text IS NOT NULL AND backend IS NOT NULL)"""


@query(f"""WITH {_TFIDF}, s AS (SELECT topic, count(*) AS n FROM topic GROUP BY 1), m AS (SELECT topic, term, round(sum(weight) / max(s.n), 9) AS w FROM weights JOIN topic USING (id) JOIN s USING (topic) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY w DESC, term) AS k FROM m) SELECT topic, string_agg(term, ', ' ORDER BY k) AS name FROM r WHERE k <= 4 GROUP BY 1""")
def topic_names(spark, folder):
    """The four weightiest terms of every topic, stop words left out; the backends stand for topics."""
    t = transcripts(spark, folder).where("text IS NOT NULL")
    weights = topics.tfidf(t, key="id", text="text", stop=T.STOP_WORDS)
    return topics.topic_names(weights, t.where("backend IS NOT NULL").select("id", F.col("backend").alias("topic")), key="id")


@query(f"WITH {CLIPS_SQL}, {TRANSCRIPTS_SQL} SELECT backend AS topic, round(sum(coalesce(ms, 0)) / 3600000.0::DOUBLE, 6) AS hours FROM transcript JOIN clips USING (id) WHERE backend IS NOT NULL GROUP BY 1")
def topic_hours(spark, folder):
    """Hours of every topic; the backends stand for topics."""
    t = transcripts(spark, folder).where("backend IS NOT NULL").select("id", F.col("backend").alias("topic"))
    return topics.topic_hours(t, clips(spark, folder))


@query("SELECT c_custkey, left(trim(regexp_replace(regexp_replace(c_name || ' / ' || c_mktsegment || ' ' || repeat('x', CAST(c_custkey % 130 AS INTEGER)), '[\\\\/:*?\"<>|]', ' ', 'g'), '\\s+', ' ', 'g')), 120) AS name FROM customer")
def safe_names(spark, folder):
    """Directory names of up to 120 bytes; these are of ASCII characters, which SQL counts alike."""
    c = table(spark, folder, "customer")
    name = F.concat("c_name", F.lit(" / "), "c_mktsegment", F.lit(" "), F.expr("repeat('x', CAST(c_custkey % 130 AS INT))"))
    return c.select("c_custkey", T.safe_name(name).alias("name"))


@query("WITH one AS (SELECT DISTINCT id, dnsmos_bak::DOUBLE AS x FROM chunks WHERE id IS NOT NULL AND dnsmos_bak IS NOT NULL AND NOT isnan(dnsmos_bak)) SELECT id, round(-0.0125::DOUBLE * x * x + 1.1::DOUBLE * x + 0.05::DOUBLE, 5) AS mapped FROM one")
def mapped_scores(spark, folder):
    """A raw score mapped by a quadratic."""
    c = table(spark, folder, "chunks").where("id IS NOT NULL AND dnsmos_bak IS NOT NULL AND NOT isnan(dnsmos_bak)").select("id", F.col("dnsmos_bak").cast("double").alias("x")).distinct()
    return c.select("id", F.round(stats.polynomial(F.col("x"), (-0.0125, 1.1, 0.05)), 5).alias("mapped"))


@query(f"WITH {CLIPS_SQL}, e AS (SELECT video_id, start_sec AS a, end_sec AS b, local_speaker AS s FROM clips WHERE start_sec < end_sec) SELECT video_id, round(a, 3) AS start, round(b, 3) AS \"end\", 'speaker_' || s AS speaker, count(*) AS n FROM e GROUP BY 1, 2, 3, 4")
def parsed_segments(spark, folder):
    """Segments read from lines of start, end and speaker."""
    c = clips(spark, folder).where("start_sec < end_sec")
    line = F.concat_ws(" ", F.round("start_sec", 3).cast("string"), F.round("end_sec", 3).cast("string"), F.concat(F.lit("speaker_"), F.col("local_speaker").cast("string")))
    lines = c.groupBy("video_id").agg(F.collect_list(line).alias("lines"))
    return lines.select("video_id", F.inline(T.parse_segments(F.col("lines")))).groupBy("video_id", "start", "end", "speaker").agg(F.count("*").alias("n"))
