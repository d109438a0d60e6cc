"""SimHash near-duplicates by multi-index hashing.

1. ``simhash``: each text becomes a 64-bit fingerprint of its word shingles.
2. ``links``: all pairs of distinct fingerprints within the radius.  The bits
   are cut into segments with radii such that every such pair lies within the
   radius of at least one segment; each fingerprint looks up its small Hamming
   ball in that segment's table, and complete distances verify the matches.
3. ``components``: alternating large-star/small-star contraction, written to
   the checkpoint folder each round.

Nothing is capped.  Where a table bucket holds more than ``hot`` fingerprints,
its members are not paired up: two fingerprints are within four bits exactly
if some value lies within two bits of both, so each member is spread to the
values within half the radius and joined with the least member that reaches
the same value.  That costs a fixed number of rows (2,081) per member of such a
bucket and keeps every component, though not every single link.  ``layout``
takes wider keys as fingerprints grow in number, so buckets stay small on
average and only crowds of texts that differ in few bits take this way.

Rows: null and empty texts have fingerprint zero and are linked like any other;
texts shorter than a shingle use their whole word sequence; exact copies share
one fingerprint, so they cost one node.  Rows that repeat get the same class.
A row whose doc_id is null gets the class of its group's least doc_id.  An
empty table gives no rows.  Other columns of the input are ignored.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm.util import cut, skewed_join
from lamina.session import spread

#: (bits, radius) of the segments; radius + 1 over all segments exceeds the Hamming radius by one.
_LAYOUTS = {
    4: (((16, 1), (16, 0), (16, 0), (16, 0)), ((22, 1), (22, 1), (20, 0)), ((32, 2), (32, 1))),
}


def _ball(bits: int, radius: int) -> list[int]:
    """XOR masks of at most ``radius`` set bits."""
    return [sum(1 << b for b in c) for k in range(radius + 1) for c in combinations(range(bits), k)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def simhash(docs: DataFrame, words: int = 4, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, carry, fp): fp as a signed long; its bits are set where over half
    of the shingles' XXH64 (seed 42) have them set.  ``carry`` names columns of
    longs that go along."""
    names = ["doc_id", *carry]
    schema = pa.schema([(c, pa.int64()) for c in (*names, "fp")])

    def fingerprint(text: str | None) -> int:
        import xxhash

        parts = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z and ASCII white space only
        if not parts:
            return 0
        size = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
        ends = np.cumsum(size)
        starts = (ends - size).tolist()
        last = max(0, len(parts) - words)
        joined, digest = b" ".join(parts), xxhash.xxh64_intdigest
        to = (ends[min(words, len(parts)) - 1 :] - 1).tolist()
        h = np.fromiter((digest(joined[a:e], 42) for a, e in zip(starts[: last + 1], to)), np.uint64, last + 1)
        votes = np.zeros(64, np.int64)
        for at in range(0, len(h), 8192):  # bounded memory for the longest texts
            votes += np.unpackbits(h[at : at + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        return _signed(sum(1 << int(b) for b in np.flatnonzero(2 * votes > len(h))))

    def of(batches):
        for batch in batches:
            fps = [fingerprint(t.as_py()) for t in batch.column(len(names))]
            yield pa.RecordBatch.from_arrays([*[batch.column(i).cast(pa.int64()) for i in range(len(names))], pa.array(fps, pa.int64())], schema=schema)

    return docs.select(*names, "text").mapInArrow(of, ", ".join(f"{c} long" for c in (*names, "fp")))


def layout(count: int, radius: int = 4) -> tuple[tuple[int, int], ...]:
    """The segments that need the fewest look-ups and matches for ``count`` fingerprints."""

    def cost(parts) -> float:
        return sum(sum(comb(b, k) for k in range(r + 1)) * (1 + count / 2**b / 2) for b, r in parts)

    return min(_LAYOUTS[radius], key=cost)


def links(fps: DataFrame, count: int, radius: int = 4, hot: int = 1000) -> DataFrame:
    """(a, b), a < b: distinct fingerprints to be joined.

    ``fps`` has distinct ``fp``; ``count`` is how many, for the choice of
    segments only.  Every pair within the radius is returned, or connected
    through returned pairs that are themselves within the radius.
    """
    at, rows, probes = 0, [], []
    for t, (bits, r) in enumerate(layout(count, radius)):
        key = F.shiftrightunsigned(F.col("fp"), at).bitwiseAND(F.lit((1 << bits) - 1)) if bits < 64 else F.col("fp")
        tag = t << 60
        rows.append(key.bitwiseOR(F.lit(_signed(tag))))
        probes += [key.bitwiseXOR(F.lit(m)).bitwiseOR(F.lit(_signed(tag))) for m in ([0] if not r else [])]
        if r:
            masks = F.array(*[F.lit(m) for m in _ball(bits, r)])
            probes.append((key, masks, _signed(tag)))
        at += bits
    table = fps.select("fp", F.explode(F.array(*rows)).alias("k"))
    asked = reduce(
        DataFrame.unionByName,
        [
            fps.select("fp", F.explode(p[1]).alias("m"), p[0].alias("key"), F.lit(p[2]).alias("tag")).select("fp", F.col("key").bitwiseXOR(F.col("m")).bitwiseOR(F.col("tag")).alias("k"))
            if isinstance(p, tuple)
            else fps.select("fp", p.alias("k"))
            for p in probes
        ],
    )
    sizes = cut(table.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).select("k"))
    crowded = not sizes.isEmpty()
    cold, cold_asked = (table.join(sizes, "k", "left_anti"), asked.join(sizes, "k", "left_anti")) if crowded else (table, asked)
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    pairs = cold_asked.withColumnRenamed("fp", "a").join(cold.withColumnRenamed("fp", "b"), "k").where((F.col("a") < F.col("b")) & near)
    found = pairs.select("a", "b")
    if crowded:
        pool = table.join(sizes, "k").select("fp").unionByName(asked.join(sizes, "k").select("fp")).distinct()
        found = found.unionByName(_through_middles(pool, radius))
    return found.distinct()


def _through_middles(pool: DataFrame, radius: int) -> DataFrame:
    """Joins fingerprints within an even radius through values half-way between.

    No join: estimates don't count what explode adds, so the side with the least
    members would be broadcast, 2,081 rows per fingerprint, through the driver's
    memory.  A value has 2,081 members at most, so a window over it stays small.
    """
    if radius % 2:
        raise ValueError("half-way values need an even radius")
    masks = F.array(*[F.lit(_signed(m)) for m in _ball(64, radius // 2)])
    spread = pool.select("fp", F.explode(masks).alias("m")).select("fp", F.col("fp").bitwiseXOR(F.col("m")).alias("z"))
    least = F.min("fp").over(Window.partitionBy("z")).alias("a")
    return spread.select(least, F.col("fp").alias("b")).where("a < b").distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the least node reachable."""
    e = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    mark = None
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(down.select("u", F.col("m").alias("v"))).distinct()
        e = cut(small)
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def classes(docs: DataFrame, words: int = 4, radius: int = 4, hot: int = 1000) -> DataFrame:
    """(doc_id, fp, component_id) of every document."""
    return rooted(docs, words, radius, hot).select("doc_id", "fp", "component_id")


def rooted(docs: DataFrame, words: int = 4, radius: int = 4, hot: int = 1000, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, carry, fp, root, component_id) of every document; root, a
    fingerprint, tells groups apart also where no row has a doc_id or several
    groups have the same."""
    prints = cut(simhash(docs, words, carry))
    nodes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")))
    count, rows = nodes.agg(F.count(F.lit(1)), F.sum("n")).first()
    joined = components(links(nodes.select("fp"), count, radius, hot))
    roots = cut(nodes.join(joined.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "n", "least", F.coalesce("root", "fp").alias("root")))
    ids = roots.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("n"))
    # copies of one text, or a component of most texts, may be a third of all rows
    labels = skewed_join(roots.select("fp", "root"), ids.select("root", "component_id"), ["root"], ids.select("root", "n"), count)
    return skewed_join(prints, labels, ["fp"], nodes.select("fp", "n"), rows or 0).select("doc_id", *carry, "fp", "root", "component_id")


def op10_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    found = classes(spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
