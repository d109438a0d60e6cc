"""Vectors of texts: a model of the caller's, or hashed term weights."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.operators import tokens


def embed(docs: DataFrame, make: Callable[[], Callable[[list[str]], np.ndarray]], text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, embedding): unit vectors by any encoder.  ``make`` builds it, once
    in each task; it gets the texts of a batch and returns a row for each."""

    def run(batches):
        encode = make()
        for t in batches:
            m = np.asarray(encode(t[text].fillna("").tolist()), np.float64).reshape(len(t), -1)
            m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
            yield pd.DataFrame({key: t[key].to_numpy(), "embedding": list(m)})

    return docs.select(key, text).mapInPandas(run, f"{key} {dict(docs.dtypes)[key]}, embedding array<double>")


def hashed(docs: DataFrame, width: int = 256, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, embedding): where there is no encoder, term counts weighted by
    inverse document frequency, added up by hash with a sign, scaled to length
    one.  A text without terms has the zero vector.  Built-in functions only;
    what is shuffled are term counts."""
    n = docs.count()
    counts = tokens.exploded(docs, [key], text, pairs=False).groupBy(key, "term").agg(F.count(F.lit(1)).alias("n"))
    df = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    h = F.xxhash64("term")
    weight = F.col("n") * (F.log((F.lit(n) + 1) / (F.col("df") + 1)) + 1) * F.when(h.bitwiseAND(F.lit(1 << 62)) == 0, 1.0).otherwise(-1.0)
    cells = counts.join(df, "term").groupBy(key, F.pmod(h, F.lit(width)).cast("int").alias("cell")).agg(F.sum(weight).alias("w"))
    rows = cells.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("cell", "w"))).alias("cells"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    vector = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.coalesce(F.try_element_at("cells", i) / F.nullif("length", F.lit(0.0)), F.lit(0.0)))
    return docs.select(key).join(rows, key, "left").select(key, F.when(F.col("cells").isNotNull(), vector).otherwise(F.array_repeat(F.lit(0.0), width)).alias("embedding"))
