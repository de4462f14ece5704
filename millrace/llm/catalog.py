"""Registered queries of the subpackage and the SQL that checks them."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    hard_negatives,
    hyperminhash,
    jaccard,
    language,
    neighbours,
    packing,
    pages,
    personal,
    quality,
    sentencepiece_bpe,
    substrings,
    suffixes,
    whitening,
)

WORDS = corpus_pipeline.WORDS
PIECES = public_tokenizers.path("piece_bpe_32k.model")

RELAX = 1.1  # recall against brute force is in the README


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.digest(_documents(spark, sf_dir), PIECES)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_documents(spark, sf_dir), WORDS)


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(_documents(spark, sf_dir), with_text=False)


def op9_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(_documents(spark, sf_dir))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return quality.judge(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_documents(spark, sf_dir))


def op4_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.digest(_documents(spark, sf_dir))


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return neighbours.nearest_neighbours(vectors, vectors.filter("vec_id % 50 = 0"), k=5, relax=RELAX)


def op6_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(_documents(spark, sf_dir), size=3, percent=90)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.components(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), k=16)


def op12_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(_documents(spark, sf_dir), size=4, percent=80)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_quality": op2_quality,
    "op3_language": op3_language,
    "op4_personal": op4_personal,
    "op5_neighbours": op5_neighbours,
    "op6_pages": op6_pages,
    "op7_jaccard": op7_jaccard,
    "op8_substrings": op8_substrings,
    "op9_suffixes": op9_suffixes,
    "op10_packing": op10_packing,
    "op11_whitening": op11_whitening,
    "op12_hyperminhash": op12_hyperminhash,
    "op13_hard_negatives": op13_hard_negatives,
    "pipeline": corpus_pipeline.run,
}
def _links_sql(size: int, percent: int, more: str) -> str:
    """Components of documents whose shingle sets are alike."""
    return rf"""
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
        starts AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {size - 1}, least(len(w), 1)) + 1)) AS i FROM words),
        shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + {size - 1}], ' ') AS k FROM starts),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS m FROM shingles a JOIN shingles b USING (k) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
        links AS (SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * m >= {percent} * (a.n + b.n - m)),
        reached AS (SELECT doc_id AS x, doc_id AS y FROM words UNION SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y),
        lowest AS (SELECT x AS doc_id, min(y) AS component_id FROM reached GROUP BY x)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id{more} FROM lowest LEFT JOIN sizes USING (doc_id)"""


# The others learn, search approximately, decode markup or solve for eigenvectors, which SQL cannot express; tests/llm
# holds them against brute force.
ORACLE_SQL: dict[str, str] = {
    "op8_substrings": r"""
        WITH words AS (
            SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
        starts AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, w FROM words WHERE len(w) >= 13),
        windows AS (SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS k FROM starts),
        firsts AS (SELECT k, min(doc_id) AS low FROM windows GROUP BY k),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j FROM windows JOIN firsts USING (k) WHERE low < doc_id),
        places AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM words),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS text FROM places ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id),
        counts AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM words LEFT JOIN kept USING (doc_id) LEFT JOIN counts USING (doc_id)""",
}
ORACLE_SQL["op7_jaccard"] = _links_sql(3, 90, "")
ORACLE_SQL["op12_hyperminhash"] = _links_sql(4, 80, ", doc_id = component_id AS kept")
ORACLE_SQL["op13_hard_negatives"] = """
    WITH vectors AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
        FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scores AS (
        SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
        FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
    positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scores USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
    WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
    QUALIFY row_number() OVER best <= 5"""
if corpus_pipeline.ORACLE_SQL:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
