"""Queries of signal kernels: the public embedding vectors stand for waves, the clips' activity for levels."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipweave.functions import text as T
from clipweave.operators import rules, signal
from clipweave.operators import timeseries as ts
from clipweave.plans.balance import _LEVELS, _levels
from clipweave.plans.base import CLIPS_SQL, VIDEOS_SQL, clips, registrar, videos
from clipweave.sources.tables import table

QUERIES, SQL, query = registrar()
_FRAME = 4

_WAVES = "w AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL)"
_DB = f"""{_WAVES}, p AS (SELECT vec_id, f, 10 * log10(list_avg([x * x FOR x IN e[f * {_FRAME} + 1:(f + 1) * {_FRAME}]]) + 0.0000000001::DOUBLE) AS raw FROM (SELECT vec_id, e, unnest(range(0, len(e) // {_FRAME})) AS f FROM w)),
db AS (SELECT vec_id, f AS frame, (raw + coalesce(lag(raw) OVER o, 0) + coalesce(lead(raw) OVER o, 0)) / 3 AS db FROM p WINDOW o AS (PARTITION BY vec_id ORDER BY f))"""


@query(f"WITH {_DB} SELECT vec_id, frame, round(db, 5) AS db FROM db")
def frame_levels(spark, folder):
    """The level of every four values of a vector, smoothed over three frames."""
    out = signal.frame_levels(table(spark, folder, "embeddings"), key="vec_id", wave="embedding", frame=_FRAME)
    return out.select("vec_id", "frame", F.round("db", 5).alias("db"))


@query(f"""WITH {_DB}, t AS (SELECT vec_id, quantile_cont(db, 0.9) AS top, max(frame) AS l, count(*) AS n FROM db GROUP BY 1)
SELECT vec_id, CASE WHEN any_value(n) < 10 THEN 0 ELSE round(max(db) FILTER (frame < 4) - any_value(top), 1) END AS edge_start_db, CASE WHEN any_value(n) < 10 THEN 0 ELSE round(max(db) FILTER (frame > l - 4) - any_value(top), 1) END AS edge_end_db FROM db JOIN t USING (vec_id) GROUP BY 1""")
def edge_levels(spark, folder):
    """The loudest of the first and of the last frames of a vector, under its ninetieth percentile."""
    return signal.edge_levels(table(spark, folder, "embeddings"), key="vec_id", wave="embedding", frame=_FRAME)


@query(f"WITH {_WAVES} SELECT vec_id, len([x FOR x IN e IF abs(x) >= 0.2::DOUBLE])::DOUBLE / greatest(len(e), 1) AS clip_ratio FROM w")
def clip_shares(spark, folder):
    """Share of a vector's values of 0.2 or more."""
    return signal.clip_shares(table(spark, folder, "embeddings"), key="vec_id", wave="embedding", limit=0.2)


@query(f"""WITH {_WAVES}, p AS (SELECT vec_id, e AS m, lead(e) OVER (ORDER BY vec_id) AS v FROM w), g AS (SELECT *, list_inner_product(m, v) AS mv, list_inner_product(v, v) AS vv FROM p WHERE v IS NOT NULL)
SELECT vec_id, round(CASE WHEN vv < 0.0000000001::DOUBLE THEN CASE WHEN list_inner_product(m, m) > 0.0000000001::DOUBLE THEN 0 ELSE -100 END
  ELSE 10 * log10((list_sum([(z[1] - mv / vv * z[2]) * (z[1] - mv / vv * z[2]) FOR z IN list_zip(m, v)]) + 0.000000000001::DOUBLE) / (mv / vv * mv / vv * vv + 0.000000000001::DOUBLE)) END, 4) AS music_db FROM g""")
def music_levels(spark, folder):
    """What each vector holds beside its part along the next one, in dB."""
    e = table(spark, folder, "embeddings").where("embedding IS NOT NULL")
    following = e.select("vec_id", F.col("embedding").alias("vocal"))
    # The next vector by number, found by a join on places, not by an order of all rows in one task.
    from clipweave.operators.order import placed

    places, _ = placed(following, "vec_id", "vec_id")
    pairs = places.select("vec_id", F.col("vocal").alias("mixed"), F.col("_place").alias("p")).join(places.select((F.col("_place") - 1).alias("p"), "vocal"), "p")
    out = signal.music_levels(pairs, key="vec_id", mixed="mixed", vocal="vocal")
    return out.select("vec_id", F.round("music_db", 4).alias("music_db"))


@query(f"""WITH {_WAVES}, x AS (SELECT vec_id, len(e) AS n, generate_subscripts(e, 1) - 1 AS "at", unnest(e) AS x FROM w)
SELECT vec_id, CAST("at" AS BIGINT) AS "at", round(x * CASE WHEN "at" < 6 THEN 0.5 - 0.5 * cos(pi() * "at" / 6) WHEN "at" >= n - 6 THEN 0.5 - 0.5 * cos(pi() * (n - 1 - "at") / 6) ELSE 1 END, 6) + 0 AS x FROM x""")
def faded_waves(spark, folder):
    """Vectors with half-cosine fades of six values at both ends."""
    return signal.faded(table(spark, folder, "embeddings"), key="vec_id", wave="embedding", k=6).select("vec_id", "at", (F.round("x", 6) + 0.0).alias("x"))


@query(f"WITH {_WAVES} SELECT vec_id, CAST(generate_subscripts(e, 1) - 1 AS BIGINT) AS at, round(unnest(e) / (sqrt(list_inner_product(e, e)) + 0.000000001::DOUBLE), 6) AS x FROM w")
def unit_vectors(spark, folder):
    """Vectors at unit length."""
    return signal.unit_vectors(table(spark, folder, "embeddings"), key="vec_id", vector="embedding").select("vec_id", "at", F.round("x", 6).alias("x"))


@query(f"""WITH {_LEVELS}, l AS (SELECT video_id, quantile_cont(db, 0.5) FILTER (vad > 0.5::DOUBLE) AS mid, max(db) AS top, min(frame) AS f0, max(frame) AS f1 FROM lv GROUP BY 1),
m AS (SELECT lv.*, f0, f1, vad < 0.35::DOUBLE OR db < coalesce(mid, top) - 25 AS pause FROM lv JOIN l USING (video_id)),
i AS (SELECT *, frame - row_number() OVER (PARTITION BY video_id ORDER BY frame) AS g FROM m WHERE pause), r AS (SELECT video_id, min(frame) AS a, max(frame) + 1 AS b, arg_min(frame, db * 1000000 + frame) AS low, any_value(f0) AS f0, any_value(f1) AS f1 FROM i GROUP BY video_id, g)
SELECT video_id, CASE WHEN b - a >= 8 THEN (a + b) // 2 ELSE low END AS at, round(least(b - a, 4)::DOUBLE / 4, 6) AS quality, b - a AS length FROM r WHERE b - a >= 2 AND a > f0 AND b <= f1""")
def pause_places(spark, folder):
    """Where to cut in the pauses inside every video."""
    masked = ts.speech_masks(_levels(spark, folder), keys=["video_id"])
    return signal.pause_places(masked, least=2, strong=4).select("video_id", "at", F.round("quality", 6).alias("quality"), "length")


@query(f"WITH {CLIPS_SQL} SELECT id, array_to_string([x FOR x IN [CASE WHEN greatest(edge_start_db, edge_end_db) > -6 THEN 'edge_loudness' END, CASE WHEN weak_cut THEN 'weak_cut' END] IF x IS NOT NULL], '|') AS reasons FROM clips")
def edge_rules(spark, folder):
    """Clips whose louder edge is too loud, or whose cut is weak."""
    limits = {r.metric: None for r in rules.QUALITY_RULES} | {"edge_db": -6.0}
    c = clips(spark, folder).withColumn("edge_db", rules.edge_db())
    return c.select("id", F.array_join(rules.reasons(rules.with_limits(**limits), drop_weak=True), "|").alias("reasons"))


@query(f"WITH {VIDEOS_SQL}, l AS (SELECT id, CASE WHEN size % 2 = 0 THEN 'site ' || id WHEN size % 3 = 0 THEN id ELSE 'a ' || id || ' c' END AS line FROM video) SELECT id, CASE WHEN len(string_split(line, ' ')) = 2 THEN string_split(line, ' ')[2] END AS archived FROM l")
def archived_ids(spark, folder):
    """The ids that lines of an archive name: the second of exactly two words."""
    line = F.when(F.col("size") % 2 == 0, F.concat(F.lit("site "), "id")).when(F.col("size") % 3 == 0, F.col("id")).otherwise(F.concat(F.lit("a "), "id", F.lit(" c")))
    return videos(spark, folder).select("id", T.archived_id(line).alias("archived"))
