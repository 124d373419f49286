"""Topics of texts: TF-IDF, k-means and principal components."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TOKEN = r"([ء-ي]{3,}|[a-z]{3,})"


def tfidf(texts: DataFrame, *, key: str, text: str, most_terms: int = 20_000, stop: frozenset[str] = frozenset()) -> DataFrame:
    """(`key`, term, weight), stop words left out: counts times smooth inverse document frequency, of unit length per text, over the most frequent terms."""
    tokens = texts.select(key, F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit(TOKEN), F.lit(1))).alias("term"))
    if stop:
        tokens = tokens.where(~F.col("term").isin(sorted(stop)))
    tf = tokens.groupBy(key, "term").agg(F.count("*").alias("tf"))
    terms = tf.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("total"))
    vocabulary = terms.orderBy(F.desc("total"), "term").limit(most_terms)
    n = texts.count()
    raw = tf.join(vocabulary, "term").select(key, "term", (F.col("tf") * (F.log((1.0 + n) / (1.0 + F.col("df"))) + 1)).alias("raw"))
    return raw.select(key, "term", (F.col("raw") / F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(key)))).alias("weight"))


def topic_names(weights: DataFrame, topics: DataFrame, *, key: str, terms: int = 4) -> DataFrame:
    """(topic, name): the terms of highest mean weight in each topic."""
    sizes = topics.groupBy("topic").agg(F.count("*").alias("n"))
    mean = weights.join(topics, key).groupBy("topic", "term").agg(F.sum("weight").alias("w")).join(sizes, "topic").withColumn("w", F.col("w") / F.col("n"))
    top = mean.withColumn("r", F.row_number().over(Window.partitionBy("topic").orderBy(F.round("w", 9).desc(), "term"))).where(F.col("r") <= terms)
    return top.groupBy("topic").agg(F.transform(F.sort_array(F.collect_list(F.struct("r", "term"))), lambda e: e["term"]).alias("t")).select("topic", F.array_join("t", ", ").alias("name"))


def topic_hours(topics: DataFrame, clips: DataFrame, *, key: str = "id", ms: str = "ms") -> DataFrame:
    """(topic, hours) of the clips of each topic."""
    joined = topics.join(clips.select(key, ms), key)
    return joined.groupBy("topic").agg(F.round(F.sum(F.coalesce(F.col(ms), F.lit(0))) / 3_600_000.0, 6).alias("hours"))


def kmeans(vectors: DataFrame, *, key: str, column: str, k: int, seed: int = 0, starts: int = 3) -> DataFrame:
    """(`key`, topic) by the best of several k-means runs; k is at least 2 and at most a fifth of the rows."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    data = vectors.select(key, array_to_vector(F.col(column).cast("array<double>")).alias("features")).cache()
    n = data.count()
    models = [KMeans(k=max(2, min(k, n // 5)), seed=seed + i).fit(data) for i in range(starts)]
    best = min(models, key=lambda m: m.summary.trainingCost)
    return best.transform(data).select(key, F.col("prediction").alias("topic"))


def pca(vectors: DataFrame, *, key: str, column: str, k: int = 2) -> DataFrame:
    """(`key`, components) on the first principal axes."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    data = vectors.select(key, array_to_vector(F.col(column).cast("array<double>")).alias("features"))
    return PCA(k=k, inputCol="features", outputCol="o").fit(data).transform(data).select(key, vector_to_array("o").alias("components"))
