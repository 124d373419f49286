"""The pN_ queries, each over its whole tables with production parameters, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipweave.llm import cap, clusters, leakage, lookalike, neighbours, packing, rank, repetition, residue, splits, sql
from clipweave.session import cut
from clipweave.sources.tables import clean_speaker, one_per_key, table, usable

REPEATED_SHARE = 0.5
CAP_SECONDS = 600
NEIGHBOURS = 5
NEAR = 0.95
HEAD_SHARE = 0.01
SPLITS = {"train": 0.8, "validation": 0.1, "test": 0.1}
SCORES = {"dnsmos_bak": (1.0, 5.0), "dnsmos_sig": (1.0, 5.0), "utmos": (1.0, 5.0), "window_similarity": (-1.0, 1.0)}


def _repetition(spark: SparkSession, folder: str) -> DataFrame:
    return repetition.repetitive(one_per_key(table(spark, folder, "transcripts"), "id", "backend", "text"), groups=("backend",))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Transcripts rejected for repetition; an exact check keeps those of which at least half is repeated."""
    return _repetition(spark, folder).where(F.col("rejected") & (F.col("repeated") >= REPEATED_SHARE)).select("id")


def p1_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Every transcript with its shares of repeated content and its distance from what is usual in its language and source."""
    return _repetition(spark, folder)


def _canonical(spark: SparkSession, folder: str) -> DataFrame:
    return lookalike.canonical_texts(table(spark, folder, "transcripts"), ["text", "text_tagged"])


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of transcripts a text of which looks the same but has other characters."""
    return lookalike.alike_pairs(_canonical(spark, folder))


def p6_classes(spark: SparkSession, folder: str) -> DataFrame:
    """Every text that is also spelt otherwise, with its look and the number of such texts."""
    return lookalike.alike_classes(_canonical(spark, folder))


def p6_canonical(spark: SparkSession, folder: str) -> DataFrame:
    """Every text of every transcript in its one consistent form."""
    return _canonical(spark, folder).select("id", "field", "canonical").distinct()


def _voices(spark: SparkSession, folder: str) -> DataFrame:
    chunks = table(spark, folder, "chunks").select("id", clean_speaker().alias("speaker_id"), "speaker_embedding")
    return clusters.similarity_clusters(chunks, keep=("speaker_id",))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks whose speaker is missing or another than the one their group of one voice is named by."""
    members = _voices(spark, folder)
    named = members.join(clusters.cluster_names(members, "speaker_id"), "cluster")
    wrong = named.where(F.col("speaker_id").isNull() | (F.col("speaker_id") != F.col("name")))
    return wrong.select("id", F.col("name").alias("speaker_id"))


def p2_voices(spark: SparkSession, folder: str) -> DataFrame:
    """Every group of one voice with its size, its most typical chunks and its speaker."""
    members = _voices(spark, folder)
    described = clusters.describe_clusters(members).join(clusters.cluster_names(members, "speaker_id"), "cluster", "left")
    return described.select("cluster", "size", "typical", F.col("name").alias("speaker_id"))


def _capped(spark: SparkSession, folder: str) -> DataFrame:
    chunks = one_per_key(table(spark, folder, "chunks"), "id", "speaker_id", "dnsmos_bak", "window_similarity", "duration")

    def score(column: str) -> F.Column:
        return F.when(usable(column, *SCORES[column]), F.col(column).cast("double")).otherwise(0.0)

    seconds = F.when(~F.isnan("duration") & (F.col("duration") > 0), F.col("duration").cast("double")).otherwise(0.0)
    rows = chunks.select(
        "id",
        clean_speaker().alias("contributor"),
        cap.thousandths(score("dnsmos_bak") + 2 * score("window_similarity")).alias("score"),
        cap.thousandths(seconds).alias("weight"),
    )
    return cap.cap_contributors(rows, CAP_SECONDS * 1000)


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks dropped where each speaker keeps its best chunks up to ten minutes."""
    return _capped(spark, folder).where(~F.col("kept")).select("id")


def p3_capped(spark: SparkSession, folder: str) -> DataFrame:
    """Every chunk with its speaker and whether it is kept."""
    return _capped(spark, folder).select("id", F.col("contributor").alias("speaker_id"), "kept")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of chunks whose embeddings have a cosine of 0.95 or more."""
    near = neighbours.nearest_vectors(table(spark, folder, "chunks"), k=NEIGHBOURS, least=NEAR)
    return near.select(F.least("id", "neighbour").alias("id_a"), F.greatest("id", "neighbour").alias("id_b")).distinct()


def p4_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The five most similar chunks of every chunk."""
    return neighbours.nearest_vectors(table(spark, folder, "chunks"), k=NEIGHBOURS)


def _ranking(spark: SparkSession, folder: str) -> DataFrame:
    ok = F.lit(True)
    for column, scale in SCORES.items():
        ok = ok & usable(column, *scale)
    chunks = one_per_key(table(spark, folder, "chunks").where(ok), "id", *SCORES)
    return rank.rank_walk(chunks, list(SCORES))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """The best hundredth of the common ranking by four scores."""
    return rank.head(_ranking(spark, folder), HEAD_SHARE).select("id")


def p5_ranking(spark: SparkSession, folder: str) -> DataFrame:
    """Every usable chunk with its stationarity, the common measure of rank."""
    return _ranking(spark, folder)


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Speakers whose chunks stand in more than one split of the earlier assignment."""
    chunks = one_per_key(table(spark, folder, "chunks"), "id", "speaker_id").select("id", clean_speaker().alias("speaker_id"))
    return splits.leaking_values(chunks, table(spark, folder, "draft_splits"))


def _people(spark: SparkSession, folder: str) -> DataFrame:
    chunks = one_per_key(table(spark, folder, "chunks"), "id", "speaker_id", "gender")
    sex = F.substring(F.lower(F.trim("gender")), 1, 1)
    return chunks.select("id", clean_speaker().alias("speaker_id"), F.when(sex == "m", "male").when(sex == "f", "female").alias("gender"))


def p7_assigned(spark: SparkSession, folder: str) -> DataFrame:
    """Every chunk with a split of its own, no speaker in two of them."""
    return splits.deal_splits(_people(spark, folder), SPLITS).select("id", "split")


def p7_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the splits keep what they promise: of all chunks and of each gender the stated share within a point, no speaker torn apart."""
    people = _people(spark, folder)
    dealt = people.join(splits.deal_splits(people, SPLITS).select("id", "split"), "id")
    torn = dealt.where("speaker_id IS NOT NULL").groupBy("speaker_id").agg(F.count_distinct("split").alias("n")).where("n > 1")
    counts = dealt.groupBy("gender", "split").agg(F.count("*").alias("n"))
    group = F.explode(F.array(F.coalesce("gender", F.lit("unknown")), F.lit("all"))).alias("people")
    shares = counts.select(group, "split", "n").groupBy("people").pivot("split", list(SPLITS)).agg(F.sum("n"))
    total = sum((F.coalesce(F.col(s), F.lit(0)) for s in SPLITS), F.lit(0))
    close = [(F.abs(F.coalesce(F.col(s), F.lit(0)) / total - p) <= 0.01).alias(s) for s, p in SPLITS.items()]
    return shares.select("people", *close).crossJoin(torn.agg(F.count("*").alias("torn")))  # one row


def p8_packed(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its sequence, in tokens of a public tokenizer."""
    documents = one_per_key(table(spark, folder, "documents"), "doc_id", "text")
    return packing.pack(packing.token_counts(documents, tokenizer=packing.tokenizer_of(spark)))


def p8_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the packing keeps what it promises: one row of the documents laid down, and of how often a rule is broken."""
    documents = one_per_key(table(spark, folder, "documents"), "doc_id", "text")
    sizes = cut(packing.token_counts(documents, tokenizer=packing.tokenizer_of(spark)), "pack-sizes")
    packed = cut(packing.pack(sizes), "pack-checked")
    boxes = packed.groupBy("container").agg(F.sum("used").alias("fill"), F.max(F.col("offset") + F.col("used")).alias("end"), F.count_distinct("offset").alias("starts"), F.count("*").alias("n"))
    whole = packed.groupBy("doc_id").agg(F.sum("used").alias("laid"), F.count("*").alias("parts")).join(sizes, "doc_id", "full")
    bad = F.coalesce(F.col("laid"), F.lit(0)) != F.coalesce(F.col("tokens"), F.lit(0))
    counts = whole.agg(F.count_if(F.col("laid") > 0).alias("documents"), F.count_if(bad).alias("changed"), F.count_if((F.col("parts") > 1) & (F.col("tokens") <= packing.CAPACITY)).alias("cut_in_vain"))
    loose = boxes.agg(F.count_if(F.col("fill") > packing.CAPACITY).alias("overfull"), F.count_if((F.col("fill") != F.col("end")) | (F.col("starts") != F.col("n"))).alias("overlapping"))
    return counts.crossJoin(loose)  # a row each


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold twelve words of an evaluation item, or the whole of a shorter one."""
    return leakage.leaks(table(spark, folder, "documents"), table(spark, folder, "eval_items"))


def _residue(spark: SparkSession, folder: str) -> DataFrame:
    return residue.residue(table(spark, folder, "documents"))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold placeholders, filler, error messages or script notices."""
    return _residue(spark, folder).select("doc_id").distinct()


def p10_messages(spark: SparkSession, folder: str) -> DataFrame:
    """What residue each such document holds, and in how many sources it recurs."""
    return _residue(spark, folder)


SPEAKER_SQL = r"nullif(upper(regexp_replace(speaker_id, '^[\s\p{Z}\p{Cf}]+|[\s\p{Z}\p{Cf}]+$', '', 'g')), '')"

P3_CHUNKS_SQL = f"""
WITH one AS (
  SELECT id, max({SPEAKER_SQL}) AS speaker_id, max(dnsmos_bak) AS bak, max(window_similarity) AS sim, max(duration) AS dur
  FROM chunks WHERE id IS NOT NULL GROUP BY id),
scored AS (
  SELECT id, speaker_id,
    CAST(round((CASE WHEN NOT isnan(bak) AND bak BETWEEN 1 AND 5 THEN CAST(bak AS DOUBLE) ELSE 0 END
      + 2 * CASE WHEN NOT isnan(sim) AND sim BETWEEN -1 AND 1 THEN CAST(sim AS DOUBLE) ELSE 0 END) * 1000) AS BIGINT) AS score,
    CAST(round(CASE WHEN NOT isnan(dur) AND dur > 0 THEN CAST(dur AS DOUBLE) ELSE 0 END * 1000) AS BIGINT) AS ms
  FROM one),
run AS (
  SELECT *, coalesce(sum(ms) OVER (PARTITION BY speaker_id ORDER BY score DESC, id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM scored),
marked AS (SELECT id, speaker_id, speaker_id IS NULL OR before < {CAP_SECONDS * 1000} AS kept FROM run)
"""

P7_SQL = f"""
WITH one AS (SELECT id, max({SPEAKER_SQL}) AS speaker_id FROM chunks WHERE id IS NOT NULL GROUP BY id)
SELECT speaker_id FROM one JOIN draft_splits USING (id) WHERE speaker_id IS NOT NULL AND split IS NOT NULL
GROUP BY speaker_id HAVING count(DISTINCT split) > 1
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every pN_ query by name."""
    return {
        "p1_found": p1_found,
        "p1_shares": p1_shares,
        "p2_found": p2_found,
        "p2_voices": p2_voices,
        "p3_found": p3_found,
        "p3_capped": p3_capped,
        "p4_found": p4_found,
        "p4_neighbours": p4_neighbours,
        "p5_found": p5_found,
        "p5_ranking": p5_ranking,
        "p6_found": p6_found,
        "p6_classes": p6_classes,
        "p6_canonical": p6_canonical,
        "p7_found": p7_found,
        "p7_assigned": p7_assigned,
        "p7_checks": p7_checks,
        "p8_packed": p8_packed,
        "p8_checks": p8_checks,
        "p9_found": p9_found,
        "p10_found": p10_found,
        "p10_messages": p10_messages,
    }


def oracle_sql() -> dict[str, str]:
    """SQL for the pN_ queries that SQL can express."""
    return {
        "p3_found": P3_CHUNKS_SQL + "SELECT id FROM marked WHERE NOT kept",
        "p3_capped": P3_CHUNKS_SQL + "SELECT id, speaker_id, kept FROM marked",
        "p4_found": sql.P4,
        "p5_found": sql.P5,
        "p6_found": sql.P6,
        "p2_found": sql.P2,
        "p7_found": P7_SQL,
        "p7_checks": sql.P7_CHECKS,
        "p8_checks": sql.P8_CHECKS,
        "p9_found": sql.P9,
    }
