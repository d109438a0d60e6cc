"""Mixing sources to target weights by entropy balancing.

Targets: sources, by code point with null last, weigh 5, 2, 1 in turn and share
all words; a target stops at three times its source's words and the excess is
shared again by weight.

Rates: of all document rates r that reach each source's target in words, the
one closest in entropy to "every document once" is wanted, with r at most 3.
Its dual is one convex problem per source whose solution tilts exponentially,
r = min(3, exp(lambda * size)).  Newton steps, kept inside a shrinking bracket
that is proven to hold the solution, solve all sources at once: each round
aggregates a (source, size) histogram.  Should they not settle within the
rounds allowed, that is an error, never a result.

Copies: documents of a source are taken in order of size (and a hash within a
size); copies are the steps of the running total of rates, rounded down after a
shift.  Neighbours have almost equal sizes, so a source's words miss its target
by about one of its longest documents at most, however many documents it has.

Rows: null and empty texts have size 0, are kept out of rates and taken 0 times
whatever the copies; null is a source of its own; rows that repeat are separate
documents; texts of any length are read whole; an empty table gives no rows;
other columns, whatever their names, pass (``mixed``) or are ignored (``mix``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm.util import WORD, cut, rank_within, skewed_join

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
ROWS_PER_BUCKET = 200_000
TOLERANCE = 1e-9


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, most: float = MOST_COPIES) -> DataFrame:
    """(sid, source, source_size, target) from (source, source_size) rows.

    Sources are numbered by a distributed sort.  Water-filling: each round caps
    the sources whose share exceeds the limit and shares the rest again; every
    round caps at least one more, and in practice a few rounds do.
    """
    ordered = cut(sizes.orderBy(F.col("source").asc_nulls_last()).withColumn("at", F.monotonically_increasing_id()))
    # row index within its part of the sort, and rows of the parts before it; parts are few
    part = F.shiftright("at", 33)
    per = ordered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shift = per.select("part", before.alias("before"))
    numbered = ordered.withColumn("part", part).join(shift, "part").withColumn("sid", F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("sid", F.lit(len(weights))) + 1).cast("int"))
    s = cut(numbered.select("sid", "source", "source_size", weight.alias("w"), (F.col("source_size") * float(most)).alias("most")))
    total = s.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1  # words per unit of weight; a source stays capped once most <= level * w
    while True:
        got = s.agg(
            F.sum(F.when(F.col("most") <= level * F.col("w"), F.col("most")).otherwise(0.0)),
            F.sum(F.when(F.col("most") <= level * F.col("w"), 0.0).otherwise(F.col("w"))),
            F.count_if(F.col("most") <= level * F.col("w")),
        ).first()
        if got[2] == capped or not got[1]:
            break
        capped, level = got[2], (total - got[0]) / got[1]
    return s.select("sid", "source", "source_size", F.least("most", F.lit(level) * F.col("w")).alias("target"))


def rates(histogram: DataFrame, goals: DataFrame, most: float = MOST_COPIES, rounds: int = 200) -> DataFrame:
    """(sid, lam, mean): the dual variable of each source; a document's rate is
    least(most, exp(lam * size / mean)).

    ``histogram`` is (sid, size, n) with positive sizes, ``goals`` (sid,
    source_size, target).
    """
    means = histogram.groupBy("sid").agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean"), F.min("size").alias("least"))
    # at hi the shortest documents, and so all, have the full rate; at lo words are at most source_size * exp(lo * least / mean)
    step = F.col("mean") / F.col("least")
    hi, lo = step * math.log(most) * 1.01 + 1, -step * F.greatest(F.log(F.col("source_size") / F.col("target")), F.lit(0.0)) * 1.01 - 1
    state = cut(goals.where("source_size > 0 AND target > 0").join(means, "sid").select("sid", "mean", "target", lo.alias("lo"), hi.alias("hi"), F.lit(0.0).alias("lam"), F.lit(False).alias("done")))
    for _ in range(rounds):
        e = F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean"), F.lit(50.0)))
        words, full = F.col("n") * F.col("size"), e >= most
        sums = histogram.join(state.where("NOT done"), "sid").groupBy("sid").agg(
            F.sum(words * F.least(e, F.lit(float(most)))).alias("f"),
            F.sum(F.when(full, 0.0).otherwise(words * e * F.col("size") / F.col("mean"))).alias("slope"),
        )
        over = F.col("f") > F.col("target")
        lo, hi = F.when(over, F.col("lo")).otherwise(F.col("lam")), F.when(over, F.col("lam")).otherwise(F.col("hi"))
        step = F.col("lam") - (F.col("f") - F.col("target")) / F.when(F.col("slope") > 0, F.col("slope"))
        inside = F.when((step > lo) & (step < hi), step)
        # outside the bracket: halve it, or double lambda while the bracket is wide
        stride = F.greatest(F.abs("lam"), F.lit(1.0))
        middle = F.when(over, F.greatest((lo + hi) / 2, F.col("lam") - stride)).otherwise(F.least((lo + hi) / 2, F.col("lam") + stride))
        done = (F.abs(F.col("f") - F.col("target")) <= F.greatest(F.lit(TOLERANCE) * F.col("target"), F.lit(1e-6))) | (hi - lo < 1e-12 * F.greatest(F.abs(lo), F.lit(1.0)))
        moved = state.join(sums, "sid", "left").select(
            "sid", "mean", "target",
            F.when(F.col("done"), F.col("lo")).otherwise(lo).alias("lo"),
            F.when(F.col("done"), F.col("hi")).otherwise(hi).alias("hi"),
            F.when(F.col("done") | done, F.col("lam")).otherwise(F.coalesce(inside, middle)).alias("lam"),
            (F.col("done") | done).alias("done"),
        )
        state = cut(moved)
        if state.where("NOT done").isEmpty():
            break
    else:
        raise RuntimeError(f"rates did not settle in {rounds} rounds")
    return state.select("sid", "lam", "mean")


def _named(source: str) -> Column:
    """The source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")).alias("key")


def mix(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST_COPIES, keep: list[str] | None = None) -> DataFrame:
    """(doc_id, size, source_size, target, copies[, keep...]) of every row.

    Rows that agree in doc_id, source, size and ``keep`` may swap places, which
    changes nothing that can be seen.  Reruns give the same copies.
    """
    keep = keep or []
    sized = cut(docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), F.xxhash64("text").alias("th")))
    per = cut(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    goals = cut(targets(per.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, most))
    keyed = per.join(goals.select("sid", F.col("source").alias("s")), F.col("source").eqNullSafe(F.col("s")))
    histogram = cut(keyed.where("size > 0").select("sid", "size", "n"))
    lam = rates(histogram, goals, most)
    rate = F.least(F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean"), F.lit(50.0))), F.lit(float(most)))
    steps = histogram.join(lam, "sid").select("sid", "size", "n", rate.alias("rate"))
    before = Window.partitionBy("sid").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.withColumn("start", F.coalesce(F.sum(F.col("n") * F.col("rate")).over(before), F.lit(0.0)))
    slots = goals.join(steps, "sid", "left").select("sid", F.col("source").alias("s"), "source_size", "target", "size", "rate", "start")
    sizes = cut(per.groupBy(_named("source")).agg(F.sum("n").alias("n")))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    known = goals.select("sid", "source_size", "target", _named("source"))
    named = skewed_join(sized.select("doc_id", "size", "th", _named("source")), known, ["key"], sizes, total).drop("key")
    order = [F.xxhash64("doc_id", "th", F.lit(11)), F.col("doc_id"), F.col("th")]
    ranked = rank_within(named, ["sid", "size"], order, F.xxhash64("doc_id", "th", F.lit(3)), max(1, math.ceil(total / ROWS_PER_BUCKET)))
    placed = skewed_join(ranked, slots.select("sid", "size", "rate", "start"), ["sid", "size"], keyed.select("sid", "size", "n"), total, "left")
    # a full rate always gives full copies: the sums then move by whole steps
    run = lambda k: F.floor(F.round(F.col("start") + F.col("rate") * k, 6) + 0.5)
    copies = F.coalesce(run(F.col("rank") + 1) - run(F.col("rank")), F.lit(0))
    return placed.select("doc_id", "th", "size", "source_size", "target", F.least(copies, F.lit(most)).cast("long").alias("copies"))


def mixed(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """The rows of docs, each as many times as the mix takes it; columns stay.

    Rows of equal doc_id and text share the copies that the mix gives them,
    in the order of a hash of the whole row.
    """
    key = [F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id")]
    per = mix(docs, weights, most).groupBy(*key, "th").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows")).where("copies > 0")
    per = cut(per)
    joined = docs.select(F.struct("*").alias("row"), *key, F.xxhash64("text").alias("th")).join(per, ["none", "id", "th"])
    if per.where("rows > 1").isEmpty():
        return joined.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
    once = joined.where("rows = 1").select("row", "copies")
    # rows that are equal in all columns become one with their number
    same = joined.where("rows > 1").groupBy("none", "id", "th", "copies", "rows", "row").agg(F.count(F.lit(1)).alias("m"))
    h = F.xxhash64("row")
    spread = rank_within(same, ["none", "id", "th"], [h, F.col("row")], h, 16, weight="m")
    upto = lambda k: F.floor(F.col("copies") * k / F.col("rows"))
    many = spread.select("row", (upto(F.col("rank") + F.col("m")) - upto(F.col("rank"))).alias("copies")).where("copies > 0")
    taken = once.unionByName(many)
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


def op9_mixing_sources(spark, sf_dir: str) -> DataFrame:
    out = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
