"""Topic runs: one fit per row of a parameter table, spread over the cluster."""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.operators import density
from lamina.operators.tokens import relabel_by_size
from lamina.session import cut

SEEDS = (42, 7, 13, 21, 33, 57, 64, 88, 99, 123, 2024)
RUNS = "run_id int, seed int, min_cluster_size int, n_neighbors int, n_components int"


def grid(spark: SparkSession, sizes=(12,), neighbours=(10,), seeds=(42,), components: int = 5) -> DataFrame:
    """The Cartesian product, sizes outermost."""
    rows = [(i, s, m, k, components) for i, (m, k, s) in enumerate(product(sizes, neighbours, seeds))]
    return spark.createDataFrame(rows, RUNS)


def fit(vectors: DataFrame, runs: DataFrame, vec: str = "embedding", key: str = "vec_id", samples: int = 2) -> DataFrame:
    """(run_id, key, topic) of every run; topics by falling size, -1 noise.

    The vectors, as they are typed, go to every task once: who is near whom
    takes all of them.  What runs share is made once, the components in one
    task and the neighbours in many; a run's task has only its components and
    neighbours, and nowhere is there a matrix of all pairs.
    """
    spark, sc, kind = vectors.sparkSession, vectors.sparkSession.sparkContext, dict(vectors.dtypes)[key]
    rows = vectors.select(key, vec).orderBy(key).toArrow().combine_chunks()
    ids, n = rows[key].to_numpy(), len(rows)
    m = np.asarray(rows[vec].combine_chunks().flatten().to_numpy(zero_copy_only=False)).reshape(n, -1) if n else np.zeros((0, 0))
    del rows
    table = runs.select("n_components", "n_neighbors").distinct().collect()
    widths, sizes = sorted({r[0] for r in table}), sorted({min(r[1], n - 1) for r in table})
    points = sc.broadcast(m)
    del m

    def components(batches):
        for t in batches:
            x = points.value.astype(np.float64)
            yield pd.DataFrame({"c": t["id"], "y": [density.principal(x, int(c)).tobytes() for c in t["id"]]})

    def near(batches):
        unit = density.units(points.value.astype(np.float64))
        for t in batches:
            lo, hi = int(t["id"].iloc[0]), int(t["id"].iloc[-1]) + 1
            for k, x in density.nearest(unit, lo, hi, sizes).items():
                yield pd.DataFrame({"k": [k], "lo": [lo], "x": [x.tobytes()]})

    # a row of each is a piece of a table of a few numbers for each vector
    made = spark.createDataFrame([(c,) for c in widths if n], "id int").coalesce(1).mapInPandas(components, "c int, y binary").collect()
    laid = {r.c: np.frombuffer(r.y, np.float64).reshape(n, -1) for r in made}
    near_of = {k: np.empty((n, k), np.int32) for k in sizes if n >= 3}
    if near_of:
        parts = max(1, min(n // 256, 8 * sc.defaultParallelism))
        for r in spark.range(0, n, 1, parts).mapInPandas(near, "k int, lo long, x binary").collect():
            x = np.frombuffer(r.x, np.int32).reshape(-1, r.k)
            near_of[r.k][r.lo : r.lo + len(x)] = x
    points.unpersist()
    shared = sc.broadcast((ids, laid, near_of))

    def one(run: pd.DataFrame) -> pd.DataFrame:
        ids, laid, near_of = shared.value
        r = run.iloc[0]
        labels = np.zeros(0, "int32")
        if len(ids):
            y = density.layout(laid[int(r["n_components"])], near_of.get(min(int(r["n_neighbors"]), len(ids) - 1)), int(r["seed"]))
            labels = density.cluster(y, int(r["min_cluster_size"]), samples)
        return pd.DataFrame({"run_id": np.full(len(ids), r["run_id"], "int32"), key: ids, "topic": labels})

    made = runs.repartition(max(1, runs.count()), "run_id").groupBy("run_id").applyInPandas(one, f"run_id int, {key} {kind}, topic int")
    return relabel_by_size(cut(made), ["run_id"], key)  # fits are dear, and two branches read them


def summary(runs: DataFrame, assignments: DataFrame) -> DataFrame:
    """runs with n_documents, n_topics and n_outliers."""
    per = assignments.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_documents"), F.countDistinct(F.when(F.col("topic") != -1, F.col("topic"))).alias("n_topics"), F.count_if(F.col("topic") == -1).alias("n_outliers")
    )
    return runs.join(per, "run_id", "left")


def members(assignments: DataFrame, key: str = "vec_id") -> DataFrame:
    """(run_id, topic, doc_count, doc_indices): members in document order."""
    return assignments.groupBy("run_id", "topic").agg(F.count(F.lit(1)).alias("doc_count"), F.array_sort(F.collect_list(key)).alias("doc_indices"))
