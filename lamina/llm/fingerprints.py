"""SimHash fingerprints of whole texts, and the tables that search them.

Terms are the word shingles of a text; a term's weight is the number of code
points in its words, so that runs of short function words say little.  A term's
two 64-bit hashes vote on 128 signed bits.  The votes are counted by codegen'd
sums: a hash, shifted by j and masked, adds bits j and j + 32 to the two halves
of one long, so 32 sums hold the 64 counters of a hash, exact up to a total
weight of 2**31 for a text.

``near_pairs`` finds every pair of fingerprints within a Hamming radius by
permuted block tables: of radius + 1 + extra blocks some set of 1 + extra
blocks must agree, so each table keys fingerprints by one such set of blocks.
Blocks go over all lanes; hot ones are compared chunk by chunk.

``fingerprints`` looks every document's fingerprint up in these tables.

Only column expressions run here.  Rows: null and empty texts have the zero
fingerprint; texts shorter than a shingle count as one term; texts of any
length are read whole; documents of equal doc_id follow each other by a hash of
their texts; rows that repeat stay apart (they are told apart by their place in
the order, not by doc_id); null doc_ids come last; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm.util import SPACE, below, cut, skewed_join

LANES = 2
SHINGLE = 3
_HALVES = (1 << 32) | 1
#: Rows per range of the order, quantiles of doc_id, and even steps between two of them.
#: There are never more than 3 * MOST_RANGES * MOST_STEPS ranges, so their table (32 bytes each) may be broadcast.
ROWS_PER_RANGE, MOST_RANGES, MOST_STEPS = 500, 1_024, 64
RADIUS = 3


def prints(df: DataFrame, keys: list[str], text: str = "text", lanes: int = LANES, shingle: int = SHINGLE) -> DataFrame:
    """(keys, h0, h1, ...): the fingerprint of ``text`` in 64-bit lanes.

    ``keys`` tell rows apart and are not null.
    """
    words = df.select(*keys, F.filter(F.split(F.col(text), f"[{SPACE}]+"), lambda w: w != "").alias("w"))
    n = F.size("w")
    shifted = [F.col("w").alias("w0")] + [F.slice("w", i + 1, F.greatest(n - i, F.lit(0))).alias(f"w{i}") for i in range(1, shingle)]
    terms = words.select(*keys, n.alias("__n"), F.inline_outer(F.arrays_zip(*shifted)))
    last = F.col(f"w{shingle - 1}")
    # shorter texts keep their first row as the only term; empty ones have a row of nulls, which weighs nothing
    parts = [F.col(f"w{i}") for i in range(shingle)]
    weight = reduce(lambda a, b: a + b, [F.coalesce(F.length(p), F.lit(0)) for p in parts]).cast("long")
    whole = last.isNotNull() | (F.col("__n") < shingle)
    hashed = terms.where(whole).select(*keys, weight.alias("wt"), *[F.xxhash64(*parts, F.lit(lane)).alias(f"x{lane}") for lane in range(lanes)])
    votes = [
        F.sum(F.shiftrightunsigned(F.col(f"x{lane}"), j).bitwiseAND(F.lit(_HALVES)) * F.col("wt")).alias(f"v{lane}_{j}")
        for lane in range(lanes)
        for j in range(32)
    ]
    voted = hashed.groupBy(*keys).agg(F.sum("wt").alias("total"), *votes)

    def lane_bits(lane: int) -> Column:
        def half(j: int, high: bool) -> Column:
            v = F.col(f"v{lane}_{j}")
            count = F.shiftrightunsigned(v, 32) if high else v.bitwiseAND(F.lit(0xFFFFFFFF))
            bit = 1 << (j + 32 * high)
            return F.when(count * 2 > F.col("total"), F.lit(bit - (1 << 64) if bit >> 63 else bit)).otherwise(F.lit(0))

        return reduce(lambda a, b: a.bitwiseOR(b), [half(j, high) for j in range(32) for high in (False, True)])

    return voted.select(*keys, *[lane_bits(lane).alias(f"h{lane}") for lane in range(lanes)])


def as_hex(lanes: list[Column]) -> Column:
    return F.concat(*[F.lpad(F.lower(F.hex(h)), 16, "0") for h in lanes])


def likeness(a: list[Column], b: list[Column]) -> Column:
    """1 - the share of differing bits."""
    differing = reduce(lambda x, y: x + y, [F.bit_count(p.bitwiseXOR(q)) for p, q in zip(a, b)])
    return F.lit(1.0) - differing / F.lit(64.0 * len(a))


def near_pairs(df: DataFrame, radius: int, blocks: int | None = None, fp: str | list[str] = "fp", hot: int = 1000) -> DataFrame:
    """(a, b, distance), a < b: all pairs of different fingerprints in ``df``
    that differ in at most ``radius`` bits.

    ``fp`` names a column of 64-bit longs, or several, the lanes of one
    fingerprint: blocks and distances go over all their bits, and a and b are
    arrays.  A block that more than ``hot`` fingerprints share is compared
    chunk by chunk, so no key of the join has more than about 2 * ``hot`` rows.

    Copies are one class here: who has a fingerprint is told by ``df`` itself.
    """
    lanes = [fp] if isinstance(fp, str) else fp
    blocks = blocks or radius + 2
    if blocks <= radius:
        raise ValueError("more blocks than differing bits are needed")
    ends = [round(64 * len(lanes) * i / blocks) for i in range(blocks + 1)]

    def block(i: int) -> list[Column]:
        """The bits of block i, a long for each lane that it meets."""
        parts = []
        for lane in range(len(lanes)):
            lo, hi = max(ends[i], 64 * lane) - 64 * lane, min(ends[i + 1], 64 * lane + 64) - 64 * lane
            if lo < hi:
                parts.append(F.shiftrightunsigned(F.get("fp", F.lit(lane)), lo).bitwiseAND(F.lit(-1 if hi - lo == 64 else (1 << (hi - lo)) - 1)))
        return parts

    distinct = df.select(F.array(*lanes).alias("fp")).where(~F.exists("fp", lambda x: x.isNull())).distinct()
    sets = list(combinations(range(blocks), blocks - radius))
    keys = F.array(*[F.xxhash64(F.lit(i), *[c for j in s for c in block(j)]) for i, s in enumerate(sets)])
    rows = distinct.select("fp", F.explode(keys).alias("k"))
    # chunks of a hot block meet in pairs; all others have one chunk
    crowds = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).select("k", F.ceil(F.col("n") / hot).cast("int").alias("chunks"))
    rows = rows.join(crowds, "k", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    own = F.pmod(F.xxhash64("fp", F.lit("chunk")), F.col("chunks")).cast("int")
    rows = rows.withColumn("own", own).select("fp", "k", "own", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    rows = rows.select("fp", "k", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))
    d = reduce(lambda x, y: x + y, [F.bit_count(F.get("a", F.lit(i)).bitwiseXOR(F.get("b", F.lit(i)))) for i in range(len(lanes))])
    found = rows.withColumnRenamed("fp", "a").join(rows.withColumnRenamed("fp", "b"), ["k", "lo", "hi"])
    found = found.where((F.col("a") < F.col("b")) & (d <= radius)).select("a", "b", d.alias("distance")).distinct()
    return found if len(lanes) > 1 or not isinstance(fp, str) else found.select(F.get("a", F.lit(0)).alias("a"), F.get("b", F.lit(0)).alias("b"), "distance")


def lanes_of(hexed: Column, lanes: int = LANES) -> list[Column]:
    """The lanes, as signed longs, of a fingerprint that ``as_hex`` wrote."""
    return [F.conv(F.substring(hexed, 16 * i + 1, 16), 16, -10).cast("long") for i in range(lanes)]


def in_order(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) with their place in descending doc_id: ``r`` (range),
    ``i`` (row in it, from 1), and the row after: ``next_text``; ``extra`` marks
    the copy of each range's follower, which only lends its text.

    Ranges are cut at quantiles of doc_id and evenly between them, so no task
    sorts the whole table and texts are shuffled once.  A doc_id that holds two
    quantiles or more, and null, is cut by the hash of the text instead, which
    orders rows within a doc_id; others hold at most 2 / MOST_RANGES of all
    rows.  The first row of each range also closes the range before.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    n, nulls, lo, hi = rows.agg(F.count(F.lit(1)), F.count_if(F.col("doc_id").isNull()), F.min("doc_id"), F.max("doc_id")).first()
    wanted = max(1, math.ceil(n / ROWS_PER_RANGE))
    q = min(wanted, MOST_RANGES)
    cuts = rows.agg(F.percentile_approx("doc_id", [i / q for i in range(1, q)], 10 * q)).first()[0] if q > 1 and lo is not None else []
    held = Counter(cuts)
    cuts, fine = sorted(held), min(MOST_STEPS, math.ceil(wanted / q))
    as_long = lambda x: f"{x}L" if x > -(1 << 63) else "(-9223372036854775807L - 1L)"
    listed = lambda xs: f"array({', '.join(map(as_long, xs))})" if xs else "cast(array() AS array<bigint>)"
    steps = listed([held[c] * fine if held[c] > 1 else 0 for c in cuts])  # of a doc_id that is cut by hash
    of_nulls = min(MOST_RANGES * MOST_STEPS, math.ceil(nulls / ROWS_PER_RANGE) or 1)
    placed = rows.selectExpr("*", f"{below(listed(cuts), 'doc_id', 'e')} AS k").selectExpr(
        "*", f"coalesce(get({listed(cuts)}, k), {as_long(hi or 0)}) AS upper", f"coalesce(CASE WHEN k > 0 THEN get({listed(cuts)}, k - 1) END, {as_long(lo or 0)}) AS lower", f"coalesce(get({steps}, k), 0L) AS steps"
    )
    by_hash = lambda n: f"least({n} - 1, floor((double(th) / 1.8446744073709552E19D + 0.5D) * {n}))"
    evenly = f"least({fine - 1}, floor((double(upper) - double(doc_id)) * {fine} / greatest(double(upper) - double(lower), 1D)))"
    r = f"""CASE WHEN doc_id IS NULL THEN {(2 * len(cuts) + 2) << 20}L + {by_hash(of_nulls)}
        WHEN steps > 0 AND doc_id = upper THEN shiftleft(2L * ({len(cuts)} - k), 20) + {by_hash('steps')}
        ELSE shiftleft(2L * ({len(cuts)} - k) + 1L, 20) + {evenly} END"""
    rows = placed.selectExpr("doc_id", "text", "th", f"{r} AS r")
    # each range's first row, and the range whose last row it follows
    used = rows.groupBy("r").agg(F.max(F.struct("doc_id", F.bitwise_not("th").alias("th"))).alias("first"))
    before = F.lag("r").over(Window.orderBy("r"))
    wrap = F.max("r").over(Window.partitionBy())
    heads = F.broadcast(used.select("r", "first", F.coalesce(before, wrap).alias("prev")))  # bounded above
    near = rows.join(heads, "r", "left").withColumn("lends", F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("th") == F.bitwise_not("first.th")))
    both = near.select("doc_id", "text", "th", F.explode(F.when(F.col("lends"), F.array(F.struct("r", F.lit(0).alias("extra")), F.struct(F.col("prev").alias("r"), F.lit(1).alias("extra")))).otherwise(F.array(F.struct("r", F.lit(0).alias("extra"))))).alias("x"))
    w = Window.partitionBy("r").orderBy("extra", F.col("doc_id").desc_nulls_last(), "th", "text")
    return both.select("doc_id", "text", "th", F.col("x.r").alias("r"), F.col("x.extra").alias("extra")).withColumn("i", F.row_number().over(w)).withColumn("next_text", F.lead("text").over(w)).drop("th")


def with_edits(docs: DataFrame) -> DataFrame:
    """(r, i, extra, doc_id, text, edited): edited is text with its last
    floor(n/2) code points replaced by the first as many of the next document's."""
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    return in_order(docs).withColumn("edited", edited)


def fingerprints(docs: DataFrame, lanes: int = LANES, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, n_near) of every document; n_near counts the other
    fingerprints within RADIUS bits of the document's."""
    ordered = with_edits(docs)
    both = ordered.select(
        "r", "i", "extra", "doc_id",
        F.explode(F.array(F.struct(F.lit(0).alias("e"), F.col("text").alias("t")), F.struct(F.lit(1).alias("e"), F.col("edited").alias("t")))).alias("x"),
    ).select("r", "i", "extra", "doc_id", F.col("x.e").alias("e"), F.col("x.t").alias("t"))
    # what is said of a text beside its terms rides along as group keys
    both = both.where("e = 0 OR extra = 0").withColumn("n", F.length("t")).withColumn("sha", F.when(F.col("e") == 1, F.sha2("t", 256)).otherwise(F.lit("")))
    both = both.withColumn("doc", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    made = prints(both, ["r", "i", "extra", "doc", "e", "n", "sha"], "t", lanes, shingle)
    hs = [f"h{lane}" for lane in range(lanes)]
    row = made.groupBy("r", "i").agg(
        F.first("doc").alias("doc"),
        F.first("extra").alias("extra"),
        F.max(F.when(F.col("e") == 0, F.col("n"))).alias("n"),
        F.max("sha").alias("sha"),
        *[F.max(F.when(F.col("e") == k, F.col(h))).alias(f"{h}_{k}") for h in hs for k in (0, 1)],
    )
    w = Window.partitionBy("r").orderBy("i")
    own, edited = [F.col(f"{h}_0") for h in hs], [F.col(f"{h}_1") for h in hs]
    linked = row.select("*", *[F.lead(f"{h}_0").over(w).alias(f"{h}_n") for h in hs])
    # texts beyond the last copy of a range head never count
    made = linked.where("extra = 0").select(
        F.when(F.col("doc") != "", F.col("doc")).cast("long").alias("doc_id"),
        F.col("n").cast("long").alias("n_chars"),
        F.col("sha").alias("edited_sha256"),
        as_hex(own).alias("fingerprint"),
        as_hex(edited).alias("edited_fingerprint"),
        likeness(own, edited).alias("near_edited"),
        likeness(own, [F.col(f"{h}_n") for h in hs]).alias("near_next"),
    )
    made = cut(made)
    distinct = made.select("fingerprint").distinct().select(*[c.alias(h) for c, h in zip(lanes_of(F.col("fingerprint"), lanes), hs)])
    pairs = near_pairs(distinct, RADIUS, fp=hs)
    hexed = lambda c: as_hex([F.get(c, F.lit(k)) for k in range(lanes)])
    counts = pairs.select(F.explode(F.array(hexed("a"), hexed("b"))).alias("fingerprint")).groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n_near"))
    copies = made.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n"))
    joined = skewed_join(made, counts, ["fingerprint"], copies, made.count(), "left")
    return joined.select(*made.columns, F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"))


def op5_document_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
