import random

from pyspark.sql import functions as F

from lamina.llm import mixing


def _targets(sizes, weights=(5, 2, 1), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, done = sum(sizes.values()), {}
    while True:
        left = [s for s in order if s not in done]
        rest = total - sum(done.values())
        share = {s: rest * w[s] / sum(w[x] for x in left) for s in left}
        over = [s for s in left if share[s] >= most * sizes[s]]
        if not over:
            return done | share
        done |= {s: most * sizes[s] for s in over}
        if len(done) == len(order):
            return done


def _docs(spark, n=900):
    rng = random.Random(2)
    sources = ["b", "a", None, "é", "Z", "tiny", "none"]
    rows = []
    for i in range(n):
        s = "b" if i % 3 == 0 else rng.choice(sources[:5])
        rows.append((i, " ".join("w" for _ in range(rng.choice([0, 1, 5, 40, 40, 200]))), s))
    rows += [(5000, "only a few words", "tiny"), (5001, None, "none"), (5002, "", "none"), (5000, "only a few words", "tiny")]
    return rows


def test_targets_and_taken_words(spark):
    rows = _docs(spark)
    docs = spark.createDataFrame([(*r, 7, 8) for r in rows], "doc_id long, text string, source string, size long, rank int")
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    src = {}
    for i, t, s in rows:
        src[s] = src.get(s, 0) + len((t or "").split())
    goal = _targets(src)
    by = {i: s for i, _, s in rows}
    taken, longest = {}, {}
    for r in got:
        s = by[r.doc_id]
        assert r.source_size == src[s] and abs(r.target - goal[s]) < 1e-6 * max(1, goal[s]) and 0 <= r.copies <= 3
        taken[s] = taken.get(s, 0) + r.copies * r.size
        longest[s] = max(longest.get(s, 0), r.size)
    for s in src:
        assert abs(taken[s] - goal[s]) <= 3 * longest[s] + 1, (s, taken[s], goal[s])
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted((r.doc_id, r.th, r.copies) for r in again) == sorted((r.doc_id, r.th, r.copies) for r in got)


def test_rates_solve_the_dual(spark):
    hist = spark.createDataFrame([(0, 10, 50), (0, 100, 20), (0, 3000, 2), (1, 7, 9), (2, 5, 4)], "sid long, size long, n long")
    goals = spark.createDataFrame([(0, "a", 8500, 3000.0), (1, "b", 63, 189.0), (2, "c", 20, 50.0)], "sid long, source string, source_size long, target double")
    lam = mixing.rates(hist, goals)
    r = F.least(F.exp(F.col("lam") * F.col("size") / F.col("mean")), F.lit(3.0))
    words = {x.sid: x.w for x in hist.join(lam, "sid").groupBy("sid").agg(F.sum(F.col("n") * F.col("size") * r).alias("w")).collect()}
    assert abs(words[0] - 3000) < 1e-3 and abs(words[1] - 189) < 1e-3 and abs(words[2] - 50) < 1e-3


def test_mixed_rows_repeat_documents(spark):
    rows = _docs(spark, 200)
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, source string, lang string")
    counts = {}
    for r in mixing.mix(docs).collect():
        counts[r.doc_id] = counts.get(r.doc_id, 0) + r.copies
    out = mixing.mixed(docs)
    got = {}
    for r in out.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert out.columns == docs.columns and got == {k: v for k, v in counts.items() if v}
    assert mixing.mixed(docs.limit(0)).count() == 0 and mixing.mix(docs.limit(0)).count() == 0
