"""Case folders: numbering, regrouping, token budgets and summary requests."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.operators.grouped import by_group

BUDGET, WINDOW_SECONDS = 100_000, 60


def number_files(files: DataFrame) -> DataFrame:
    """(path, folder) with n and new_name: files numbered within their top folder by path."""
    n = F.row_number().over(Window.partitionBy("folder").orderBy("path"))
    return files.withColumn("n", n).withColumn("new_name", F.concat("folder", F.lit("_"), F.col("n"), F.lit(".pdf")))


def case_name(name: Column) -> Column:
    """The part of a file name before its running number."""
    return F.get(F.split(name, "_[0-9]+.txt"), F.lit(0))


def regroup(documents: DataFrame) -> DataFrame:
    """(case, name, text) -> (case, n_documents, texts in order of name)."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("name", "text"))), lambda x: x["text"])
    return documents.groupBy("case").agg(F.count(F.lit(1)).alias("n_documents"), ordered.alias("texts"))


def approximate_tokens(c: Column) -> Column:
    """A quarter of the characters, rounded up: an approximation, labelled so."""
    return F.ceil(F.length(c) / 4).cast("long")


def token_counts(df: DataFrame, make: Callable[[], Callable[[str], int]], text: str = "text", to: str = "tokens") -> DataFrame:
    """df with ``to``, the tokens of ``text`` by a tokenizer: ``make`` builds a
    counter, once in each task.  A null text has none."""

    def count(parts):
        counter = make()
        for part in parts:
            yield part.map(lambda t: 0 if t is None else counter(t)).astype("int64")

    return df.withColumn(to, F.pandas_udf(count, "long", F.PandasUDFType.SCALAR_ITER)(F.col(text)))


def schedule(batched: DataFrame, per_minute: int, order: str = "case", group: str | None = None, window: int = WINDOW_SECONDS) -> DataFrame:
    """``batches`` with not_before, in seconds from the start: a request waits
    for its token window and keeps the interval that ``per_minute`` allows."""
    w = Window.partitionBy(group).orderBy(order) if group else Window.orderBy(order)
    return batched.withColumn("not_before", F.greatest((F.col("batch_no") * window).cast("double"), (F.row_number().over(w) - 1) * F.lit(60.0 / per_minute)))


def answers(requests: DataFrame, ask: Callable[[str], str]) -> DataFrame:
    """(case, answer, error): what ``ask`` gives for each request body.

    Who is asked is the caller's affair; a case that fails has the error and no
    answer, and the others go on.  A task that runs again asks again.
    """

    def run(parts):
        for t in parts:
            rows = []
            for case, body in zip(t["case"], t["request"]):
                try:
                    rows.append((case, ask(body), None))
                except Exception as e:  # whatever a service raises concerns this case only
                    rows.append((case, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["case", "answer", "error"])

    return requests.select("case", "request").mapInPandas(run, f"case {dict(requests.dtypes)['case']}, answer string, error string")


def _walk(budget: int):
    def walk(tokens):
        used, no, out = 0, 0, []
        for t in tokens.tolist():
            if used > 0 and used + t > budget:
                used, no = 0, no + 1
            used += t
            out.append(no)
        return range(len(out)), out

    return walk


def batches(requests: DataFrame, tokens: str = "tokens", order: str = "case", budget: int = BUDGET, group: str | None = None) -> DataFrame:
    """requests with batch_no: a new batch starts where the running total would
    pass the budget.  The total resets at each start, so each group is walked
    in one task, on two narrow columns; without ``group`` all are one walk."""
    g = F.lit(1) if group is None else F.col(group)
    lean = requests.select(g.alias("__g"), F.col(order).alias("__o"), F.col(tokens).alias("__t"))
    rows = by_group(lean, ["__g"], ["__o", "__t"], ["__t"], ["__g", "__o"], _walk(budget), [("batch_no", pa.int32())])
    return requests.join(rows, (requests[order] == rows["__o"]) & (g == rows["__g"])).drop("__g", "__o")


def requests(cases: DataFrame, system: str, temperature: float = 1.0) -> DataFrame:
    """cases (case, texts) with the request body as JSON; nothing is sent."""
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    body = F.struct(F.array(message("system", F.lit(system)), message("user", F.array_join("texts", "\n\n"))).alias("messages"), F.lit(temperature).alias("temperature"))
    return cases.select("case", F.to_json(body).alias("request"))
