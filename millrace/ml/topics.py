"""Topic clusters of articles: term weights, k-means, cluster terms and a 2-D map."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.feature import (
    IDF,
    PCA,
    CountVectorizerModel,
    Normalizer,
    RegexTokenizer,
    SQLTransformer,
    StandardScaler,
    StopWordsRemover,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import joined_text
from millrace.ml.simple import kmeans_fit
from millrace.plans import news
from millrace.session import release, stage_table

CLUSTERS = 8
TERMS = 500


def word_stages() -> list:
    """Words of each text, then those that are no stop words; nothing is fitted."""
    return [
        RegexTokenizer(inputCol="body", outputCol="tokens", pattern=r"(?U)\b\w\w+\b", gaps=False),
        StopWordsRemover(inputCol="tokens", outputCol="kept_tokens"),
    ]


def term_stage(words: list[str]) -> SQLTransformer:
    """Terms of each text made of these words alone: the words, and pairs of them with no other word between."""
    # Words hold no quotes. One that is not listed keeps its place as a null, and so parts its neighbours.
    listed = ", ".join(f"'{w}'" for w in words) or "NULL"
    known = f"transform(kept_tokens, t -> CASE WHEN t IN ({listed}) THEN t END) AS known"
    pairs = "array_compact(zip_with(known, slice(known, 2, size(known)), (a, b) -> concat(a, ' ', b))) AS pairs"
    terms = "concat(array_compact(known), pairs) AS terms"
    return SQLTransformer(statement=f"SELECT *, {terms} FROM (SELECT *, {pairs} FROM (SELECT *, {known} FROM __THIS__))")


def most_frequent(texts: DataFrame, terms: int = TERMS) -> list[str]:
    """The words and pairs of words that occur most often in ``body``; ties by words first, then by spelling.

    A pair occurs no more often than either of its words. So pairs are counted only
    of words that occur more often than the last of the most frequent words, of
    which there are fewer than ``terms``, and no other pair is ever shuffled.
    """
    words, kept = word_stages()
    tokens = words.transform(texts).select("tokens")

    def counted(rows: DataFrame, column: str) -> DataFrame:
        # The outer form keeps the optimizer from testing the array's size first, which would make the words twice.
        each = rows.select(F.explode_outer(column).alias("term")).filter(F.col("term").isNotNull())
        return each.groupBy("term").agg(F.count(F.lit(1)).alias("n"))

    def first(found: DataFrame) -> list[tuple[int, str]]:
        return [(r["n"], r["term"]) for r in found.orderBy(F.desc("n"), "term").limit(terms).collect()]

    # Stop words are told from the rest once for each distinct word.
    distinct = counted(tokens, "tokens").withColumn("tokens", F.array("term"))
    singles = first(kept.transform(distinct).filter(F.size("kept_tokens") > 0))
    least = singles[-1][0] if len(singles) == terms else 0
    often = [w for n, w in singles if n > least]
    pairs = counted(term_stage(often).transform(kept.transform(tokens)), "pairs").filter(F.col("n") > least)
    both = [(-n, False, w) for n, w in singles] + [(-n, True, w) for n, w in first(pairs)]
    return [w for _, _, w in sorted(both)[:terms]]


def weight_stages() -> list:
    """Counts of the vocabulary, weighted and normalised."""
    return [IDF(inputCol="counts", outputCol="weighted"), Normalizer(inputCol="weighted", outputCol="features")]


def with_body(articles: DataFrame) -> DataFrame:
    return articles.withColumn("body", joined_text("title", "description"))


def fit(articles: DataFrame, k: int = CLUSTERS, starts: int = 10, terms: int = TERMS) -> tuple[PipelineModel, KMeansModel] | None:
    """Text and cluster models, or None when there are fewer articles than clusters."""
    if articles.limit(k).count() < k:
        return None
    texts = with_body(articles).select("body")
    # Words are as large as the texts, so they are made for each pass and never kept; counts have at most ``terms`` entries a row.
    known = most_frequent(texts, terms)
    if not known:
        raise ValueError("no article has a word")
    counter = CountVectorizerModel.from_vocabulary(known, inputCol="terms", outputCol="counts")
    split = PipelineModel([*word_stages(), term_stage([w for w in known if " " not in w]), counter])
    counts = stage_table(split.transform(texts).select("counts"), "term-counts")
    weights = Pipeline(stages=weight_stages()).fit(counts)
    clusters = kmeans_fit(weights.transform(counts), k, starts)
    release(counts)
    return PipelineModel([*split.stages, *weights.stages]), clusters


def assign(articles: DataFrame, models: tuple[PipelineModel, KMeansModel] | None) -> DataFrame:
    """Articles with their cluster; null when nothing was fitted."""
    if models is None:
        return articles.withColumn("cluster", F.lit(None).cast("int"))
    text, clusters = models
    vectors = text.transform(with_body(articles))
    return clusters.transform(vectors).withColumnRenamed("prediction", "cluster")


def enrich(articles: DataFrame, k: int = CLUSTERS, starts: int = 10) -> DataFrame:
    """Sentiment, keywords and, when there are enough articles, a cluster."""
    return news.enrich(assign(articles, fit(articles, k, starts)))


def cluster_terms(models: tuple[PipelineModel, KMeansModel], spark, top_n: int = 5) -> DataFrame:
    """Heaviest terms of each centre: (cluster, rank, term, weight). Centres are clusters x terms in size."""
    text, clusters = models
    vocabulary = next(s for s in text.stages if hasattr(s, "vocabulary")).vocabulary
    rows = [
        (cluster, rank, vocabulary[i], float(centre[i]))
        for cluster, centre in enumerate(clusters.clusterCenters())
        for rank, i in enumerate(centre.argsort()[::-1][:top_n], start=1)
    ]
    return spark.createDataFrame(rows, "cluster int, rank int, term string, weight double")


def projection(assigned: DataFrame, keys: list[str]) -> DataFrame:
    """Two principal components of the centred term weights, with the cluster."""
    pipeline = Pipeline(
        stages=[
            StandardScaler(inputCol="features", outputCol="centred", withMean=True, withStd=False),
            PCA(k=2, inputCol="centred", outputCol="xy"),
        ]
    )
    # Read for the means, the components and the result.
    rows = stage_table(assigned.select(*keys, "features", "cluster"), "weighted-articles")
    xy = vector_to_array("xy")
    return pipeline.fit(rows).transform(rows).select(*keys, xy[0].alias("x"), xy[1].alias("y"), "cluster")
