"""Queries over media, voices, topics and kernels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from clipweave import scorers
from clipweave.functions import kernels
from clipweave.operators import joins, speakers, topics
from clipweave.plans.base import CLIPS_SQL, TRANSCRIPTS_SQL, VIDEOS_SQL, clips, registrar, transcripts, videos
from clipweave.sources import lake, media
from clipweave.sources.tables import table

QUERIES, SQL, query = registrar()


_STEM = "regexp_replace(list_last(string_split(path, '/')), '\\.[^.]*$', '')"
_GIVEN = f"nullif(regexp_extract({_STEM}, '^(.*?)\\s*\\[([A-Za-z0-9_-]{{11}})\\]$', 2), '')"
_FOLDER = "nullif(regexp_replace(path, '/?[^/]*$', ''), '')"


@query(f"""WITH {VIDEOS_SQL} SELECT path, coalesce({_GIVEN}, 'f' || left(sha1(path), 10)) AS id,
  trim(translate(CASE WHEN {_GIVEN} IS NOT NULL THEN regexp_extract({_STEM}, '^(.*?)\\s*\\[([A-Za-z0-9_-]{{11}})\\]$', 1) ELSE {_STEM} END, '⧸｜', '/|')) AS title,
  CASE WHEN {_FOLDER} NOT IN ('NA', '.') THEN {_FOLDER} END AS playlist, 'https://www.youtube.com/watch?v=' || {_GIVEN} AS url FROM video""")
def index_parse(spark, folder):
    """What the paths of the videos say: id, title, playlist and url."""
    parts = media.parsed_name(F.col("path"))
    return videos(spark, folder).select("path", *[c.alias(n) for n, c in parts.items()])


@query(f"""WITH {VIDEOS_SQL}, o AS (SELECT id, path, channel, coalesce(duration, 0) >= 600 AS fit, duration IS NULL AS bad FROM video),
f AS (SELECT *, min(path) FILTER (fit) OVER (PARTITION BY channel) AS first FROM o) SELECT id, CASE WHEN bad THEN 'error' WHEN coalesce(first < path, false) THEN 'duplicate' WHEN NOT fit THEN 'short' ELSE 'ok' END AS outcome FROM f""")
def index_outcomes(spark, folder):
    """Why a file is taken or not, by error, earlier claim and length; the channel stands for the id that is claimed."""
    v = videos(spark, folder).select(F.col("id").alias("video"), F.col("channel").alias("id"), "path", "duration", F.when(F.col("duration").isNull(), "no header").alias("error"))
    return media.settle(v, 600.0).select(F.col("video").alias("id"), "outcome")


_SHARD = 2_000_000_000


@query(f"""WITH RECURSIVE {VIDEOS_SQL}, v AS (SELECT id, coalesce(size, 0) AS b, row_number() OVER (ORDER BY id) AS i FROM video),
f(id, i, fill, no) AS (SELECT id, i, CASE WHEN b >= {_SHARD} THEN 0 ELSE b END, CASE WHEN b >= {_SHARD} THEN 1 ELSE 0 END FROM v WHERE i = 1
  UNION ALL SELECT v.id, v.i, CASE WHEN f.fill + v.b >= {_SHARD} THEN 0 ELSE f.fill + v.b END, CASE WHEN f.fill + v.b >= {_SHARD} THEN f.no + 1 ELSE f.no END FROM f JOIN v ON v.i = f.i + 1),
g AS (SELECT id, coalesce(lag(no) OVER (ORDER BY i), 0) AS no FROM f) SELECT id AS video_id, CAST(dense_rank() OVER (ORDER BY no) AS INTEGER) AS shard FROM g""")
def shard_pack(spark, folder):
    """Whole videos packed into shards of two gigabytes in order of their ids."""
    v = videos(spark, folder).select(F.col("id").alias("video_id"), F.coalesce("size", F.lit(0)).alias("bytes"))
    return lake.pack_shards(v, _SHARD)


_USABLE = "speaker_embedding IS NOT NULL AND len(speaker_embedding) = 192 AND list_bool_and([NOT isnan(x) FOR x IN speaker_embedding])"


@query(f"""WITH e AS (SELECT id, any_value(video_id) AS video_id, any_value(local_speaker) AS local_speaker, any_value(speaker_embedding) AS v FROM chunks WHERE {_USABLE} GROUP BY id),
p AS (SELECT video_id, local_speaker, id, v, lead(id) OVER w AS other, lead(v) OVER w AS u FROM e WINDOW w AS (PARTITION BY video_id, local_speaker ORDER BY id))
SELECT id, other, round(list_cosine_similarity(CAST(v AS DOUBLE[]), CAST(u AS DOUBLE[])), 4) AS similarity FROM p WHERE other IS NOT NULL AND list_sum([abs(x) FOR x IN v]) > 0 AND list_sum([abs(x) FOR x IN u]) > 0""")
def adjacent_similarity(spark, folder):
    """Cosine of each clip's embedding to that of the next clip of the same voice in its video."""
    ok = (F.size("speaker_embedding") == 192) & ~F.exists("speaker_embedding", F.isnan)
    e = table(spark, folder, "chunks").where(F.col("speaker_embedding").isNotNull() & ok)
    e = joins.keep_first(e.select("id", "video_id", "local_speaker", "speaker_embedding", "ingested_at"), "id", "ingested_at")
    w = Window.partitionBy("video_id", "local_speaker").orderBy("id")
    p = e.select("id", F.lead("id").over(w).alias("other"), "speaker_embedding", F.lead("speaker_embedding").over(w).alias("u")).where("other IS NOT NULL")
    return p.select("id", "other", F.round(speakers.cosine("speaker_embedding", "u"), 4).alias("similarity")).where("similarity IS NOT NULL")


def _voices(spark, folder):
    c = clips(spark, folder, "speaker_embedding")
    return speakers.voice_prints(c.select("video_id", "local_speaker", "duration", "speaker_embedding"))


@query(f"""WITH {CLIPS_SQL}, raw_e AS (SELECT id, any_value(speaker_embedding) AS v FROM chunks WHERE id IS NOT NULL AND speaker_embedding IS NOT NULL GROUP BY id), e AS (SELECT id, video_id, local_speaker, coalesce(duration, 0) AS d, CAST(v AS DOUBLE[]) AS v FROM clips JOIN raw_e USING (id) WHERE len(v) = 192 AND list_bool_and([NOT isnan(x) FOR x IN v])),
u AS (SELECT *, sqrt(list_sum([x * x FOR x IN v])) + 0.000000001::DOUBLE AS l FROM e), s AS (SELECT video_id, local_speaker, i, sum(x / l * d) AS x FROM (SELECT video_id, local_speaker, d, l, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM u) GROUP BY 1, 2, 3),
c AS (SELECT video_id, local_speaker, list(x ORDER BY i) AS c, sqrt(sum(x * x)) + 0.000000001::DOUBLE AS m FROM s GROUP BY 1, 2)
SELECT u.video_id, u.local_speaker, round(sum(d), 3) AS seconds, count(*) AS members, count(*) FILTER (list_inner_product(v, c) / l / m >= 0.5::DOUBLE) AS sound FROM u JOIN c ON c.video_id IS NOT DISTINCT FROM u.video_id AND c.local_speaker IS NOT DISTINCT FROM u.local_speaker GROUP BY 1, 2""")
def voice_prints(spark, folder):
    """The voice print of every speaker of a video: seconds, members and how many of them are sound."""
    return _voices(spark, folder).select("video_id", "local_speaker", F.round("seconds", 3).alias("seconds"), "members", "sound")


@query()
def speaker_assign(spark, folder):
    """Speakers across all videos, whatever their channels, by average linkage of their voice prints."""
    channel = clips(spark, folder).groupBy("video_id").agg(F.max("channel").alias("channel"))
    return speakers.speakers_across(_voices(spark, folder).join(channel, "video_id")).select("video_id", "local_speaker", "channel", "speaker")


_TOKENS = "unnest(regexp_extract_all(lower(text), '[ء-ي]{3,}|[a-z]{3,}'))"


@query(f"""WITH {TRANSCRIPTS_SQL}, n AS (SELECT count(*) AS n FROM transcript WHERE text IS NOT NULL), tf AS (SELECT id, term, count(*) AS tf FROM (SELECT id, {_TOKENS} AS term FROM transcript WHERE text IS NOT NULL) GROUP BY 1, 2),
df AS (SELECT term, count(*) AS df, sum(tf) AS total FROM tf GROUP BY 1 ORDER BY total DESC, term LIMIT 20000), raw AS (SELECT id, term, tf * (ln((1.0::DOUBLE + n) / (1.0::DOUBLE + df)) + 1) AS r FROM tf JOIN df USING (term), n)
SELECT id, term, round(r / sqrt(sum(r * r) OVER (PARTITION BY id)), 6) AS weight FROM raw""")
def topics_tfidf(spark, folder):
    """Weight of every term in every transcript."""
    t = transcripts(spark, folder).where("text IS NOT NULL")
    return topics.tfidf(t, key="id", text="text").select("id", "term", F.round("weight", 6).alias("weight"))


@query()
def topic_clusters(spark, folder):
    """Vectors of the public embedding table in ten clusters, with their sizes."""
    v = table(spark, folder, "embeddings")
    return topics.kmeans(v, key="vec_id", column="embedding", k=10).groupBy("topic").agg(F.count("*").alias("n"))


@query()
def pca_map(spark, folder):
    """Vectors on their first two principal axes."""
    out = topics.pca(table(spark, folder, "embeddings"), key="vec_id", column="embedding")
    return out.select("vec_id", *[F.round(F.col("components")[i], 4).alias(n) for i, n in enumerate("xy")])


@query(f"WITH {TRANSCRIPTS_SQL} SELECT id, length(coalesce(text, '')) AS chars FROM transcript")
def scored_lengths(spark, folder):
    """A scorer run over all transcripts in Arrow batches: the plug-in path of every model."""
    return scorers.apply(transcripts(spark, folder), scorers.scorer("text_length")).select("id", "chars")


@query()
def clip_plan(spark, folder):
    """Cut plans of whole videos' speech by dynamic programming, a plan per video and voice."""
    c = clips(spark, folder).where("start_sec < end_sec").select("video_id", "local_speaker", "start_sec", "end_sec")

    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        nodes = np.unique(np.concatenate([pdf["start_sec"].to_numpy(), pdf["end_sec"].to_numpy()]))
        pieces = kernels.cut_plan(nodes, np.zeros(len(nodes)), kernels.CutSettings())
        rows = [(pdf["video_id"].iloc[0], pdf["local_speaker"].iloc[0], round(float(nodes[i]), 3), round(float(nodes[j]), 3)) for i, j in pieces]
        return pd.DataFrame(rows, columns=["video_id", "local_speaker", "start", "end"])

    return c.groupBy("video_id", "local_speaker").applyInPandas(plan, "video_id string, local_speaker int, start double, end double")


@query(f"""WITH {CLIPS_SQL}, x AS (SELECT *, 9010 AS size FROM clips WHERE ms > 0) SELECT id, CAST(greatest(1, floor(d / 1000) - 9) AS BIGINT) AS windows FROM (SELECT id, CASE WHEN ms >= size THEN ms WHEN ms * 2 >= size THEN ms * 2 WHEN ms * 4 >= size THEN ms * 4
  WHEN ms * 8 >= size THEN ms * 8 WHEN ms * 16 >= size THEN ms * 16 WHEN ms * 32 >= size THEN ms * 32 ELSE ms * 64 END AS d FROM x)""")
def mos_windows(spark, folder):
    """How many windows of every clip are scored for quality, short clips doubled."""
    c = clips(spark, folder).where("ms > 0").select("id", "ms")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "windows": [len(kernels.score_windows(int(m), 1000)) for m in b["ms"]]})

    return c.mapInPandas(count, "id string, windows bigint")
