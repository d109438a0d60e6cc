import random

import pytest
import xxhash

from lamina.llm import neardup


def _fingerprint(text, k=4):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in (text or ""))
    words = [w for w in __import__("re").split("[ \t-\r]+", text) if w]
    grams = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def _groups(fps, radius=4):
    up = {f: f for f in fps}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    fps = sorted(fps)
    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if bin((a ^ b) & (2**64 - 1)).count("1") <= radius:
                up[top(a)] = top(b)
    out = {}
    for f in fps:
        out.setdefault(top(f), set()).add(f)
    return {frozenset(v) for v in out.values()}


def _signed(x):
    return x - 2**64 if x >> 63 else x


TEXTS = [None, "", "one two three", "One TWO three", "É é a b c d", "a b c d e f g " * 30, "a b c d e f g " * 30 + "h", " x\x0by\tz\n w ", "x y z w", "x y z w q"]


def test_simhash_equals_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r.doc_id: r.fp for r in neardup.simhash(docs).collect()}
    assert got == {i: _signed(_fingerprint(t)) for i, t in enumerate(TEXTS)}


@pytest.mark.parametrize("hot,count", [(1000, 100), (1, 100), (1000, 10**9), (3, 10**5)])
def test_components_equal_brute_force(spark, hot, count):
    rng = random.Random(hot + count)
    fps = {0, 2**64 - 1}
    for _ in range(40):
        f = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 6])):
            fps.add(f)
            for b in rng.sample(range(64), rng.randint(1, 5)):
                f ^= 1 << b
    fps = {_signed(f) for f in fps}
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    links = neardup.links(df, count, hot=hot)
    assert all(bin((r.a ^ r.b) & (2**64 - 1)).count("1") <= 4 for r in links.collect())
    found = {}
    for r in neardup.components(links).collect():
        found.setdefault(r.root, set()).add(r.node)
    assert {frozenset(v) for v in found.values()} == {g for g in _groups(fps) if len(g) > 1}
    assert all(root == min(v) for root, v in found.items())


def test_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    rows = neardup.components(edges).collect()
    assert len(rows) == 201 and {r.root for r in rows} == {0}


def test_classes_with_nulls_copies_and_empty_tables(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(5, text, 1), (3, text, 2), (9, text + " w1", 3), (None, text, 4), (3, text, 2), (7, None, 5), (8, "", 6), (6, "something else entirely different here", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = neardup.classes(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r.component_id for r in got}
    assert by[5] == by[3] == by[None] == 3 and by[7] == by[8] == 7 and by[6] == 6
    assert neardup.classes(docs.limit(0)).count() == 0


def test_query_on_small_documents(spark):
    out = neardup.op10_simhash_near_dedup(spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    prints = {r.doc_id: _signed(_fingerprint(r.text)) for r in docs}
    groups = {}
    for g in _groups(set(prints.values())):
        ids = [i for i, f in prints.items() if f in g]
        groups |= {i: min(ids) for i in ids}
    for r in out.collect():
        assert r.fingerprint == f"{prints[r.doc_id] & (2**64 - 1):016x}" and r.component_id == groups[r.doc_id]
