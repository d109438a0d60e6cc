"""Chat formatting of reply trees.

``paths`` turns messages with parents into root-to-leaf paths by iterative
self-joins that double the ancestors known each round, so a thread of length n
takes log2(n) rounds.  ``rank_branches`` orders a root's paths by score.
``format_turns`` writes a path as one conversation; ``read_back`` parses it.

Template: a turn is ``<|role|>`` + newline + text + ``<|end|>`` + newline.  In
roles and texts the character ``\\`` becomes ``\\\\`` and ``<`` becomes ``\\l``, ``[`` becomes
``\\b``; so no control string of this or the common bracket templates survives
inside a text, and unescaping gives the text back.  The loss mask covers the
texts of assistant turns.

Rows: null texts are empty, null roles "unknown"; messages whose parent is not
there are roots; equal scores are ordered by leaf; repeated ids are told apart
by row order within equal (turn, role, text).  Cycles, which have no root, give
no path.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm.util import cut

_ESCAPE = {"\\": "\\\\", "<": "\\l", "[": "\\b"}
_BACK = {"\\": "\\", "l": "<", "b": "["}
_TURN = re.compile(r"<\|((?:[^<|]|\|(?!>))*)\|>\n([^<]*)<\|end\|>\n")


def escape(text: str) -> str:
    return re.sub(r"[\\<\[]", lambda m: _ESCAPE[m[0]], text)


def unescape(text: str) -> str:
    return re.sub(r"\\([\\lb])", lambda m: _BACK[m[1]], text)


def _role(role: str | None) -> str:
    # a role stands between bars: it may hold none
    return escape(role or "unknown").replace("|", "\\p")


def _unrole(role: str) -> str:
    return re.sub(r"\\([\\lbp])", lambda m: {**_BACK, "p": "|"}[m[1]], role)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """(text, loss spans): the conversation and the code points of it that are learnt."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"<|{_role(role)}|>\n", escape(text or "")
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, "<|end|>\n"]
        at += len(head) + len(body) + 8
    return "".join(out), spans


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        turns.append((_unrole(m[1]), unescape(m[2])))
        at = m.end()
    return turns


def paths(messages: DataFrame, rounds: int = 40) -> DataFrame:
    """(leaf, depth, msg): for each leaf every message on its way from the
    root, with its depth from 0.

    ``messages`` has msg (unique) and parent (null at roots).  Round k links
    each message with its ancestor 2**k up, which also gives its depth and
    root; walking down from leaves then needs as many joins as rounds.
    """
    m = messages.select("msg", "parent")
    known = m.select(F.col("msg").alias("p"))
    m = m.join(known, m["parent"] == known["p"], "left").select("msg", F.col("p").alias("up"))
    jump, jumps = cut(m.withColumn("depth", F.when(F.col("up").isNull(), 0).otherwise(1))), []
    left = -1
    for _ in range(rounds):
        jumps.append(jump)
        # depths have no holes: a round that reaches no further root leaves only messages on or under cycles
        before, left = left, jump.where("up IS NOT NULL").count()
        if left in (0, before):
            break
        far = jump.select(F.col("msg").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("d2"))
        jump = cut(jump.join(far, "up", "left").select("msg", F.col("up2").alias("up"), (F.col("depth") + F.coalesce("d2", F.lit(0))).alias("depth")))
    depth = jumps[-1].where("up IS NULL").select("msg", "depth")
    leaves = depth.join(m.select(F.col("up").alias("msg")).where("msg IS NOT NULL").distinct(), "msg", "left_anti")
    way = leaves.select(F.col("msg").alias("leaf"), "depth", "msg")
    for jump in reversed(jumps[:-1]):
        # everything on the way, and everything 2**k above it
        above = way.join(jump.where("up IS NOT NULL").select("msg", "up"), "msg").select("leaf", F.col("up").alias("msg"))
        way = cut(way.select("leaf", "msg").unionByName(above).distinct().join(depth, "msg").select("leaf", "depth", "msg"))
    return way


def rank_branches(way: DataFrame, messages: DataFrame) -> DataFrame:
    """way with ``branch``, a path's rank (from 1) under its root by mean
    message score, best first, and ``root``.

    ``messages`` has msg and score; a null score counts as 0."""
    scored = way.join(messages.select("msg", F.coalesce("score", F.lit(0.0)).alias("score")), "msg")
    roots = way.where("depth = 0").select("leaf", F.col("msg").alias("root"))
    per = scored.groupBy("leaf").agg(F.avg("score").alias("mean")).join(roots, "leaf")
    ranked = per.withColumn("branch", F.row_number().over(Window.partitionBy("root").orderBy(F.col("mean").desc(), "leaf")))
    return way.join(ranked.select("leaf", "root", "branch"), "leaf")


def format_paths(way: DataFrame, messages: DataFrame) -> DataFrame:
    """(leaf, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars,
    formatted, loss_spans): each path as one conversation, and what reading it
    back gives.

    ``messages`` has msg, role and text.  A path's turns become one row: it is
    a single conversation, which has to fit a task anyway.
    """

    def each(batches):
        sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
        for batch in batches:
            rows = []
            for turns in batch.column(1).to_pylist():
                text, spans = format_turns([(t["role"] if t["role"] is not None else "unknown", t["text"] or "") for t in turns])
                back = read_back(text)
                learnt = "".join(unescape(text[a:b]) for a, b in spans)
                rows.append((len(back), sha("".join(f"{r}\n{t}\n" for r, t in back)), len(learnt), sha(learnt), len(text), text, [list(s) for s in spans]))
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))], names=["leaf", *names])

    names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "formatted", "loss_spans"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64()))]
    rows = way.join(messages.select("msg", "role", "text"), "msg")
    turns = rows.groupBy("leaf").agg(F.array_sort(F.collect_list(F.struct("depth", "role", "text"))).alias("turns"))
    schema = f"leaf {dict(way.dtypes)['leaf']}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, formatted string, loss_spans array<array<long>>"
    return turns.mapInArrow(each, schema)


def op6_chat_formatting(spark, sf_dir: str) -> DataFrame:
    """Each conversation is a tree in which a turn replies to the turn before."""
    trick = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-1, 0, "user", trick), (-1, 1, "assistant", trick)], "conv_id long, turn long, role string, text string")
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").unionByName(added)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.withColumn("n", F.row_number().over(order))
    # a null conv_id is a conversation of its own
    name = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("-")), F.lit(""))
    messages = cut(
        rows.select(
            "conv_id", "role", "text", F.lit(0.0).alias("score"),
            F.concat(name, F.col("n")).alias("msg"),
            F.when(F.col("n") > 1, F.concat(name, F.col("n") - 1)).alias("parent"),
        )
    )
    best = rank_branches(paths(messages), messages).where("branch = 1")
    done = format_paths(best.select("leaf", "depth", "msg"), messages)
    ids = messages.select(F.col("msg").alias("leaf"), "conv_id")
    return done.join(ids, "leaf").select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


#: Formatted length follows from the template: 13 signs around each turn's role and escaped text.
ORACLE_SQL = r"""
WITH r AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
g AS (SELECT conv_id, count(*) AS n, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS t,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS l,
    sum(13 + length(role) + 2 * length(text) - length(regexp_replace(text, '[<\[\\]', '', 'g'))) AS f FROM r GROUP BY conv_id)
SELECT conv_id, n AS n_turns, sha256(t) AS turns_sha256, CAST(length(l) AS BIGINT) AS loss_chars, sha256(l) AS loss_sha256, CAST(f AS BIGINT) AS formatted_chars FROM g
"""
