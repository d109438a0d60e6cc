"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.session import cut, shared_checkpoints

__all__ = ["SPACE", "WORD", "below", "cut", "let", "rank_within", "running", "shared_checkpoints", "skewed_join"]

#: ASCII white space as the contracts define it, and the complement.
SPACE = "\\x20\\x09-\\x0D"
WORD = f"[^{SPACE}]+"


def rank_within(df: DataFrame, keys: list[str], order: list[Column], salt: Column, buckets: int, name: str = "rank", weight: str | None = None) -> DataFrame:
    """df with ``name``: a row's number, from 0, among the rows of equal keys;
    with ``weight``, a column of longs, the weights of the rows before it.

    A group is cut into ``buckets`` by ``salt``, rows are numbered within each
    and shifted by the sizes of the buckets before, so that no task ever holds
    a whole hot group.  Keys must not be null.  The numbering is reproducible
    if ``order`` tells rows apart (rows that it can't tell apart are equal).
    """
    b, n = "__bucket", "__rows"
    df = df.withColumn(b, F.pmod(salt, F.lit(buckets)).cast("int"))
    sizes = df.groupBy(*keys, b).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias(n))
    before = Window.partitionBy(*keys).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select(*keys, b, F.coalesce(F.sum(n).over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy(*keys, b).orderBy(*order)
    own = F.sum(weight).over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col(weight) if weight else F.row_number().over(inside) - 1
    ranked = df.withColumn("__own", own).join(base, [*keys, b])
    return ranked.withColumn(name, F.col("__base") + F.col("__own")).drop(b, "__own", "__base")


def skewed_join(left: DataFrame, right: DataFrame, keys: list[str], sizes: DataFrame, rows: int, how: str = "inner") -> DataFrame:
    """left joined with right, whose ``keys`` are unique, when some keys hold
    many rows of left: those meet right in a broadcast, so no task gets them all.

    ``sizes`` is (keys, n), the rows of left per key, and ``rows`` their sum.
    Keys are hot from a share of 1 / MOST_HOT on, so at most MOST_HOT rows are
    ever broadcast.  Keys must not be null.
    """
    hot = sizes.where(F.col("n") > max(HOT_ROWS, rows // MOST_HOT)).select(*keys)
    if rows <= HOT_ROWS or hot.isEmpty():
        return left.join(right, keys, how)
    hot = cut(hot.join(right, keys, how))
    rest = left.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return left.join(F.broadcast(hot), keys).unionByName(rest.join(right, keys, how))


#: A key with more rows than this, and than a share of 1 / MOST_HOT, is hot.
HOT_ROWS, MOST_HOT = 100_000, 10_000


# SQL text: expressions with many lambdas are parsed far faster than they are built call by call.  What a lambda
# reads besides its own variables has to be bound by ``let``: a column that is read once, in a lambda, would be
# computed anew for every element when the optimizer merges projections.


def let(name: str, fields: dict[str, str], body: str) -> str:
    """``body``, in which name.field stands for the value of each of ``fields``."""
    struct = ", ".join(f"'{k}', {v}" for k, v in fields.items())
    return f"get(transform(array(named_struct({struct})), {name} -> {body}), 0)"


def below(values: str, v: str, tag: str) -> str:
    """How many of ``values``, an ascending array, are less than v; by halving."""
    a, mid = f"{tag}_a", f"shiftright({tag}_a.lo + {tag}_a.hi, 1)"
    # 31 halvings are enough for any array
    return (
        f"aggregate(sequence(1, 31), named_struct('lo', 0, 'hi', size({values})), ({a}, {tag}_i) -> CASE WHEN {a}.lo >= {a}.hi THEN {a} "
        f"WHEN get({values}, {mid}) < {v} THEN named_struct('lo', {mid} + 1, 'hi', {a}.hi) ELSE named_struct('lo', {a}.lo, 'hi', {mid}) END, {a} -> {a}.lo)"
    )


def running(values: str, zero: str, op: Callable[[str, str], str]) -> str:
    """array<int>: for each of ``values``, ``op`` over zero and all values before it.

    Arrays are folded in blocks of 64, whose totals are folded first: a fold
    copies its result at every step, so one over the whole array would be
    quadratic.
    """
    none = "cast(array() AS array<int>)"

    def fold(xs: str, start: str, v: str) -> str:
        step = f"named_struct('at', {op(f'{v}.at', f'{v}_x')}, 'out', concat({v}.out, array({v}.at)))"
        return f"aggregate({xs}, named_struct('at', {start}, 'out', {none}), ({v}, {v}_x) -> {step}, {v} -> {v}.out)"

    parts = "transform(sequence(0, shiftright(size(rv.v) - 1, 6)), rb -> slice(rv.v, rb * 64 + 1, 64))"
    totals = f"transform(rp.p, rt -> aggregate(rt, {zero}, (ra, rx) -> {op('ra', 'rx')}))"
    whole = let("rp", {"p": parts}, f"flatten(zip_with(rp.p, {fold(totals, zero, 'rs')}, (rq, rw) -> {fold('rq', 'rw', 'rf')}))")
    return let("rv", {"v": values}, f"CASE WHEN size(rv.v) = 0 THEN {none} ELSE {whole} END")
