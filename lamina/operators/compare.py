"""Comparing topic runs with a reference run, all in one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def overlaps(assignments: DataFrame, reference: int, key: str = "doc_id") -> DataFrame:
    """(run_id, reference_topic, topic, overlap) for every pair of topics of
    the reference and another run, zeros included; noise is no topic."""
    real = assignments.where("topic <> -1")
    ref = real.where(F.col("run_id") == reference).select(key, F.col("topic").alias("reference_topic"))
    rest = real.where(F.col("run_id") != reference)
    met = rest.join(ref, key).groupBy("run_id", "reference_topic", "topic").agg(F.count(F.lit(1)).alias("overlap"))
    # topics are few per run; the product is what the comparison is about
    pairs = ref.select("reference_topic").distinct().crossJoin(rest.select("run_id", "topic").distinct())
    return pairs.join(met, ["run_id", "reference_topic", "topic"], "left").select("run_id", "reference_topic", "topic", F.coalesce("overlap", F.lit(0)).cast("long").alias("overlap"))


def best_matches(pairs: DataFrame) -> DataFrame:
    """(run_id, reference_topic, best_match, best_overlap); ties go to the lowest topic."""
    return pairs.groupBy("run_id", "reference_topic").agg(F.max_by("topic", F.struct("overlap", -F.col("topic"))).alias("best_match"), F.max("overlap").alias("best_overlap"))


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all words; null where both are empty."""
    return F.size(F.array_intersect(a, b)) / F.nullif(F.size(F.array_union(a, b)), F.lit(0))


def compare_topics(assignments: DataFrame, words: DataFrame, reference: int, key: str = "doc_id") -> DataFrame:
    """(comparison_run, reference_topic, best_match, best_overlap, preservation,
    word_jaccard).  ``words`` is (run_id, topic, rank, term).  A run without
    topics gives nulls for the match."""
    listed = words.groupBy("run_id", "topic").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda x: x["term"]).alias("ws"))
    best = best_matches(overlaps(assignments, reference, key))
    sizes = assignments.where((F.col("run_id") == reference) & (F.col("topic") != -1)).groupBy(F.col("topic").alias("reference_topic")).agg(F.count(F.lit(1)).alias("n"))
    others = assignments.select("run_id").where(F.col("run_id") != reference).distinct()
    all_ = others.crossJoin(sizes).join(best, ["run_id", "reference_topic"], "left")
    mine = listed.where(F.col("run_id") == reference).select(F.col("topic").alias("reference_topic"), F.col("ws").alias("a"))
    theirs = listed.select("run_id", F.col("topic").alias("best_match"), F.col("ws").alias("b"))
    none = F.array().cast("array<string>")
    return all_.join(mine, "reference_topic", "left").join(theirs, ["run_id", "best_match"], "left").select(
        F.col("run_id").alias("comparison_run"), "reference_topic", "best_match", "best_overlap", (F.col("best_overlap") / F.col("n")).alias("preservation"),
        F.when(F.col("best_match").isNotNull(), jaccard(F.coalesce("a", none), F.coalesce("b", none))).alias("word_jaccard"),
    )


def stable_words(comparisons: DataFrame, words: DataFrame, reference: int) -> DataFrame:
    """(reference_topic, word, seed_count, seed_proportion, position): in how
    many runs (the reference among them) a reference topic or its best match has
    the word; position orders by falling share, then first appearance."""
    own = words.where(F.col("run_id") == reference).select(F.col("topic").alias("reference_topic"), F.col("run_id"), "rank", "term")
    met = comparisons.select(F.col("comparison_run").alias("run_id"), "reference_topic", F.col("best_match").alias("topic")).join(words, ["run_id", "topic"]).select("reference_topic", "run_id", "rank", "term")
    runs = comparisons.agg(F.countDistinct("comparison_run").alias("k")).select((F.col("k") + 1).alias("k"))
    first = F.min(F.struct(F.when(F.col("run_id") == reference, -1).otherwise(F.col("run_id")).alias("r"), "rank"))
    counted = own.unionByName(met).groupBy("reference_topic", F.col("term").alias("word")).agg(F.countDistinct("run_id").alias("seed_count"), first.alias("f"))
    shared = counted.crossJoin(F.broadcast(runs)).withColumn("seed_proportion", F.col("seed_count") / F.col("k"))
    w = Window.partitionBy("reference_topic").orderBy(F.col("seed_count").desc(), "f", "word")
    return shared.withColumn("position", F.row_number().over(w)).select("reference_topic", "word", "seed_count", "seed_proportion", "position")
