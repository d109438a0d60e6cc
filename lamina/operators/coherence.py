"""Topic coherence over sliding windows, and the hyper-parameter search."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.session import by_key, cut
from lamina.sources.corpus import numbered

WINDOW, EPSILON = 110, 1e-12
#: Terms of a vocabulary that go to every task; more are joined by a shuffle.
MOST_TERMS = 500_000
#: Distinct topic words that may be sent to every task.
MOST_WORDS = 100_000


def valid_words(words: DataFrame, vocabulary: DataFrame, least: int = 2) -> DataFrame:
    """Topic words that the dictionary has, of topics with at least ``least``."""
    known = words.join(vocabulary.select("term"), "term", "left_semi")
    able = known.groupBy("run_id", "topic").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    return known.join(able.select("run_id", "topic"), ["run_id", "topic"], "left_semi")


def dictionary(tokens: DataFrame, least: int = 1) -> DataFrame:
    """(id, term, df, tf) of the terms in at least ``least`` documents of
    ``tokens`` (doc_id, tokens), numbered from 0 by term."""
    each = by_key(tokens, "doc_id").select("doc_id", F.explode("tokens").alias("term")).groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("n"))
    found = each.groupBy("term").agg(F.count("doc_id").alias("df"), F.sum("n").alias("tf"))
    return numbered(cut(found.where(F.col("df") >= least)), "term").select(F.col("doc_idx").alias("id"), "term", "df", "tf")


def valid_tokens(tokens: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(doc_id, tokens) without tokens that the vocabulary lacks; repeats and order stay."""
    known = cut(vocabulary.select("term"))
    few = known.count() <= MOST_TERMS
    flat = by_key(tokens, "doc_id").select("doc_id", F.posexplode("tokens").alias("pos", "term"))
    kept = flat.join(F.broadcast(known) if few else known, "term", "left_semi")
    return kept.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "term"))), lambda x: x["term"]).alias("tokens"))


def window_counts(tokens: DataFrame, words: list[str], window: int = WINDOW) -> DataFrame:
    """(a, b, n): windows that hold a and b (a = b: that hold a); the row
    ('', '') counts all windows.

    Each document's windows are marked by where its topic words stand, so a
    document costs its length times its topic words; only counts are shuffled.
    """
    if len(words) > MOST_WORDS:
        raise ValueError(f"{MOST_WORDS} topic words at most")
    shared = tokens.sparkSession.sparkContext.broadcast(frozenset(words))

    def count(batches):
        for t in batches:
            total: dict[tuple[str, str], int] = {}
            for ts in t["tokens"]:
                ts = [] if ts is None else list(ts)
                n = max(1, len(ts) - window + 1)
                places: dict[str, list[int]] = {}
                for i, w in enumerate(ts):
                    if w in shared.value:
                        places.setdefault(w, []).append(i)
                marks = {}
                for w, at in places.items():
                    edge = np.zeros(n + 1, np.int64)
                    np.add.at(edge, np.maximum(0, np.array(at) - window + 1), 1)
                    np.add.at(edge, np.minimum(n, np.array(at) + 1), -1)
                    marks[w] = np.cumsum(edge[:-1]) > 0
                total["", ""] = total.get(("", ""), 0) + n
                for w, m in marks.items():
                    total[w, w] = total.get((w, w), 0) + int(m.sum())
                for a, b in combinations(sorted(marks), 2):
                    both = int((marks[a] & marks[b]).sum())
                    if both:
                        total[a, b] = total.get((a, b), 0) + both
            yield pd.DataFrame([(a, b, n) for (a, b), n in total.items()], columns=["a", "b", "n"])

    # a row for each pair of topic words, which every step of the scores reads
    return cut(tokens.select("tokens").mapInPandas(count, "a string, b string, n long").groupBy("a", "b").agg(F.sum("n").alias("n")))


def npmi(counts: DataFrame) -> DataFrame:
    """(a, b, npmi) of unordered pairs that share a window."""
    all_ = counts.where("a = ''").select(F.col("n").alias("t"))
    single = counts.where("a = b AND a <> ''")
    x, y = single.select("a", F.col("n").alias("na")), single.select("b", F.col("n").alias("nb"))
    p = F.col("n") / F.col("t") + EPSILON
    value = F.log(p / (F.col("na") / F.col("t") * F.col("nb") / F.col("t"))) / -F.log(p)
    return counts.where("a <> b").join(x, "a").join(y, "b").crossJoin(F.broadcast(all_)).select("a", "b", value.alias("npmi"))  # one row


def coherence(words: DataFrame, counts: DataFrame) -> DataFrame:
    """(run_id, coherence_cv): mean over topics of the mean cosine between each
    word's NPMI vector and the topic's sum of them."""
    all_ = counts.where("a = ''").select(F.col("n").alias("t"))
    half = npmi(counts)
    both = half.unionByName(half.select(F.col("b").alias("a"), F.col("a").alias("b"), "npmi"))
    p = F.col("n") / F.col("t")
    own = counts.where("a = b AND a <> ''").crossJoin(F.broadcast(all_)).select("a", "b", (F.log((p + EPSILON) / (p * p)) / -F.log(p + EPSILON)).alias("npmi"))
    table = both.unionByName(own)
    w = words.select("run_id", "topic", "term").distinct()
    pairs = w.withColumnRenamed("term", "a").join(w.withColumnRenamed("term", "b"), ["run_id", "topic"])
    # a pair that never meets: the log of epsilon over its own negative log
    singles = counts.where("a = b AND a <> ''").select("a", F.col("n").alias("n1"))
    vec = pairs.join(table, ["a", "b"], "left").join(singles, "a", "left").join(singles.select(F.col("a").alias("b"), F.col("n1").alias("n2")), "b", "left").crossJoin(F.broadcast(all_))
    apart = F.log(F.lit(EPSILON) / (F.col("n1") / F.col("t") * F.col("n2") / F.col("t"))) / -F.log(F.lit(EPSILON))
    vec = vec.select("run_id", "topic", "a", "b", F.coalesce("npmi", apart, F.lit(0.0)).alias("v"))
    total = vec.groupBy("run_id", "topic", "b").agg(F.sum("v").alias("s"))
    cos = vec.join(total, ["run_id", "topic", "b"]).groupBy("run_id", "topic", "a").agg(
        (F.sum(F.col("v") * F.col("s")) / F.nullif(F.sqrt(F.sum(F.col("v") ** 2)) * F.sqrt(F.sum(F.col("s") ** 2)), F.lit(0.0))).alias("c")
    )
    topics = cos.groupBy("run_id", "topic").agg(F.avg(F.coalesce("c", F.lit(0.0))).alias("c"))
    return topics.groupBy("run_id").agg(F.avg("c").alias("coherence_cv"))
