"""Case folders over conversations: a conversation is a case, a turn a file."""

from __future__ import annotations

from pyspark.sql import functions as F

from lamina.operators import cases


def _turns(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return c.select(F.concat(F.lit("case"), "conv_id").alias("folder"), F.concat(F.lit("case"), "conv_id", F.lit("_"), F.col("turn") + 1, F.lit(".txt")).alias("name"), "turn", F.coalesce("text", F.lit("")).alias("text"))


_TURNS = "t AS (SELECT 'case' || conv_id AS folder, 'case' || conv_id || '_' || (turn + 1) || '.txt' AS name, turn, coalesce(text, '') AS text FROM conversations)"


def file_numbering(spark, sf_dir):
    t = _turns(spark, sf_dir).select("folder", F.concat("folder", F.lit("/"), F.sha2("text", 256), F.lit("-"), "turn", F.lit(".pdf")).alias("path"))
    return cases.number_files(t)


def case_regroup(spark, sf_dir):
    t = _turns(spark, sf_dir).select(cases.case_name(F.col("name")).alias("case"), "name", "text")
    return cases.regroup(t).select("case", "n_documents", F.sha2(F.array_join("texts", "\n"), 256).alias("texts_sha"))


def _requests(spark, sf_dir):
    t = _turns(spark, sf_dir)
    return t.groupBy(F.col("folder").alias("case")).agg(F.sum(cases.approximate_tokens(F.col("text"))).alias("tokens"), (F.substring("folder", 5, 1)).alias("provider"))


def token_batches(spark, sf_dir):
    """One walk per provider (the first digit of the case), 3,000 tokens a window."""
    return cases.batches(_requests(spark, sf_dir), budget=3_000, group="provider")


_BATCHES = f"""
WITH RECURSIVE {_TURNS}, r AS (SELECT folder AS "case", substr(folder, 5, 1) AS provider, CAST(sum(ceil(length(text) / 4)) AS BIGINT) AS tokens FROM t GROUP BY folder),
n AS (SELECT *, row_number() OVER (PARTITION BY provider ORDER BY "case") AS k FROM r),
w AS (SELECT provider, k, tokens AS used, 0 AS batch_no FROM n WHERE k = 1 UNION ALL
    SELECT n.provider, n.k, CASE WHEN w.used > 0 AND w.used + n.tokens > 3000 THEN n.tokens ELSE w.used + n.tokens END, CASE WHEN w.used > 0 AND w.used + n.tokens > 3000 THEN batch_no + 1 ELSE batch_no END FROM w JOIN n ON n.provider = w.provider AND n.k = w.k + 1)
SELECT "case", tokens, n.provider, batch_no FROM n JOIN w ON w.provider = n.provider AND w.k = n.k
"""


def request_schedule(spark, sf_dir):
    return cases.schedule(token_batches(spark, sf_dir), 15, group="provider").select("case", "provider", "batch_no", "not_before")


def summary_requests(spark, sf_dir):
    t = _turns(spark, sf_dir).select(F.col("folder").alias("case"), "name", "text")
    return cases.requests(cases.regroup(t), "Summarise the case.").select("case", F.get_json_object("request", "$.messages[0].content").alias("system"), F.length(F.get_json_object("request", "$.messages[1].content")).cast("long").alias("n_chars"))


QUERIES = {f.__name__: f for f in (file_numbering, case_regroup, token_batches, request_schedule, summary_requests)}
ORACLES = {
    "file_numbering": f"WITH {_TURNS}, p AS (SELECT folder, folder || '/' || sha256(text) || '-' || turn || '.pdf' AS path FROM t), n AS (SELECT folder, path, CAST(row_number() OVER (PARTITION BY folder ORDER BY path) AS INTEGER) AS n FROM p) SELECT *, folder || '_' || n || '.pdf' AS new_name FROM n",
    "case_regroup": f"""WITH {_TURNS} SELECT folder AS "case", count(*) AS n_documents, sha256(string_agg(text, chr(10) ORDER BY name)) AS texts_sha FROM t GROUP BY folder""",
    "token_batches": _BATCHES,
    "request_schedule": f"SELECT s.\"case\", provider, batch_no, greatest(batch_no * 60, 4 * (row_number() OVER (PARTITION BY provider ORDER BY s.\"case\") - 1))::DOUBLE AS not_before FROM ({_BATCHES}) s",
    "summary_requests": f"""WITH {_TURNS} SELECT folder AS "case", 'Summarise the case.' AS system, CAST(sum(length(text)) + 2 * (count(*) - 1) AS BIGINT) AS n_chars FROM t GROUP BY folder""",
}
