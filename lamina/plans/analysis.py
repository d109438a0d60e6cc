"""Seed stability and hyper-parameter search over a corpus with vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.operators import coherence, compare, runs, tokens
from lamina.session import cut


def stability(corpus: DataFrame, seeds=runs.SEEDS, min_cluster_size: int = 12, neighbours: int = 10, components: int = 5, top: int = 10, min_df: int = 2, key: str = "doc_id") -> dict[str, DataFrame]:
    """corpus (key, text, embedding) -> the comparison and word-stability
    tables; the first seed is the reference."""
    table = runs.grid(corpus.sparkSession, (min_cluster_size,), (neighbours,), seeds, components)
    found = cut(runs.fit(corpus, table, key=key))  # fits are dear; a row per run and document
    # the vectorizer sees one text per topic, so min_df counts topics
    words = cut(tokens.ctfidf_runs(corpus.select(key, "text"), found, top, min_df, key).where("topic <> -1"))  # a few words a topic
    compared = cut(compare.compare_topics(found, words, 0, key))
    return {"assignments": found, "topic_words": words, "topic_comparisons": compared, "word_stability": compare.stable_words(compared, words, 0)}


def search(corpus: DataFrame, sizes, neighbours, components: int = 5, seed: int = 42, top: int = 10, min_df: int = 2, key: str = "doc_id") -> DataFrame:
    """A row per grid point with its coherence, best first; a point without
    topics has none and comes last."""
    spark = corpus.sparkSession
    table = runs.grid(spark, sizes, neighbours, (seed,), components)
    found = cut(runs.fit(corpus, table, key=key))  # fits are dear; a row per run and document
    docs = corpus.select(F.col(key).alias("doc_id"), "text")
    made = docs.select("doc_id", tokens.tokens(F.col("text")).alias("t")).select("doc_id", F.concat("t", tokens.bigrams(F.col("t"))).alias("tokens"))
    made = cut(made)
    df = made.select("doc_id", F.explode("tokens").alias("term")).groupBy("term").agg(F.countDistinct("doc_id").alias("df")).where(F.col("df") >= min_df)
    words = tokens.ctfidf_runs(corpus.select(key, "text"), found, top, min_df, key).where("topic <> -1")
    valid = cut(coherence.valid_words(words, df))
    listed = [r[0] for r in valid.select("term").distinct().limit(coherence.MOST_WORDS + 1).collect()]
    scored = coherence.coherence(valid, coherence.window_counts(coherence.valid_tokens(made, df), listed))
    rows = runs.summary(table, found).join(scored, "run_id", "left")
    return rows.select(
        "min_cluster_size", "n_neighbors", "n_components", "n_topics", "n_outliers", (F.col("n_outliers") / F.nullif("n_documents", F.lit(0))).alias("outlier_proportion"), "coherence_cv"
    ).orderBy(F.desc_nulls_last("coherence_cv"))
