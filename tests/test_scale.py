"""What has to hold at any size: no bound on rows, nothing that depends on how rows are cut."""

import numpy as np

from pyspark.sql import functions as F

from lamina.functions import text as tx
from lamina.operators import chrome, coherence, dedupe, density, neighbours, runs, tokens
from lamina.queries import topics
from lamina.sources import blocks as src
from lamina.sources import corpus


def test_tree_and_core_equal_those_of_the_whole_matrix():
    rng = np.random.default_rng(5)
    points = np.concatenate([rng.normal(c, 0.3, size=(400, 3)) for c in (0, 3)] + [rng.uniform(-2, 5, size=(200, 3)), np.ones((9, 3))])
    d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    core = np.partition(d, 2, axis=1)[:, 2]
    assert np.allclose(density.core_distances(points, 2), core, atol=1e-12)
    m = np.maximum(d, np.maximum(core[:, None], core[None, :]))
    inside, best, total = np.zeros(len(m), bool), np.full(len(m), np.inf), []
    best[0] = 0
    for _ in range(len(m)):
        at = int(np.argmin(np.where(inside, np.inf, best)))
        inside[at] = True
        total.append(best[at])
        best = np.minimum(best, m[at])
    assert np.allclose(density.spanning_tree(points, density.core_distances(points, 2))[:, 2], np.sort(total)[1:], atol=1e-12)


def test_a_run_takes_any_number_of_vectors(spark):
    n = 20_100
    rng = np.random.default_rng(8)
    v = rng.normal(scale=0.05, size=(n, 2)) + np.array([(0, 0), (9, 0), (0, 9)])[np.arange(n) % 3]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    got = runs.fit(df, runs.grid(spark, (2000,), (5,), (1,), 2)).toPandas()
    assert len(got) == n and got["vec_id"].is_unique
    assert set(got["topic"]) - {-1}


def test_numbers_follow_the_order_whatever_the_parts(spark):
    was = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.parallelismFirst")}
    for k, v in zip(was, ("40", "100k", "false")):
        spark.conf.set(k, v)
    try:
        rows = spark.range(60_000).select(F.sha2(F.col("id").cast("string"), 256).alias("name"), F.repeat(F.lit("x"), (F.col("id") % 50).cast("int")).alias("more"))
        got = corpus.numbered(rows).select("name", "doc_idx", "more").toArrow().sort_by("doc_idx").to_pydict()
        assert got["doc_idx"] == list(range(60_000)) and got["name"] == sorted(got["name"])
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def _plans(monkeypatch, module):
    """Plans of what a module cuts."""
    seen, real = [], module.cut
    monkeypatch.setattr(module, "cut", lambda df: (seen.append(df._jdf.queryExecution().toString()), real(df))[1])
    return seen


def _docs(spark):
    rows = [(1, "en", "solar panels make power"), (1, "en", "solar power"), (2, "fr", "le soleil power"), (3, None, "panels"), (None, "fr", "soleil soleil")]
    return spark.createDataFrame(rows, "doc_id long, lang string, text string")


def test_terms_of_a_class_are_not_brought_to_one_task(spark, monkeypatch):
    plans = _plans(monkeypatch, tokens)
    got = tokens.ctfidf(_docs(spark), ["lang"], 3, pairs=False)
    assert {r.lang for r in got.collect()} == {"en", "fr"} and "SortMergeJoin" not in plans[-1] and len(plans) == 2
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_word_count_is_that_of_split_and_makes_no_list(spark):
    texts = ["", " ", "a", " a  b ", "a\tb\u00a0c", "\u2003a \u3000\n b", "a\x1cb c", "  \n\n  ", "é — ü", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", tx.word_count(F.col("t")).alias("n"))
    assert [r.n for r in df.collect()] == [None if t is None else len(t.split()) for t in texts]
    assert "regexp_count" not in df._jdf.queryExecution().optimizedPlan().toString().lower()


def _lines(spark):
    page = "Menu|Daily Herald|a long line of words that fills the page with text of its own {}|Sign In|Most read|page foot"
    return src.line_blocks(spark.createDataFrame([(d, "\n".join(page.format(d * 7 + p) for p in range(4)).replace("|", "\n")) for d in range(6)], "doc_id long, text string"), 6)


def test_texts_are_judged_once(spark, monkeypatch):
    b = _lines(spark)
    plans = _plans(monkeypatch, chrome)
    found = chrome.page_chrome(b)
    assert len(plans) == 2 and "split" not in found._jdf.queryExecution().optimizedPlan().toString().lower()
    assert {r.reason for r in found.select("reason").distinct().collect()} >= {"chrome-phrase"}
    plans = _plans(monkeypatch, dedupe)
    gone = dedupe.repeated(b, src.pages_of(b))
    assert len(plans) == 1 and "split" not in gone._jdf.queryExecution().optimizedPlan().toString().lower()
    assert {r.signature for r in gone.collect()} >= {"menu", "daily herald", "sign in"}


def test_neighbours_are_found_once_and_travel_as_typed(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(4)
    v = np.float32(rng.normal(size=(90, 8)))
    v[50:70] = v[1]
    spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    sent, real = [], spark.sparkContext.broadcast
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda x: (sent.append(x), real(x))[1])
    monkeypatch.setattr(neighbours, "_CHUNK", 16, raising=False)
    found = topics.mutual_reachability(spark, str(tmp_path))
    assert "MapInPandas" not in found._jdf.queryExecution().executedPlan().toString() and sent[0][1].dtype == np.float32
    s = v.astype(float) @ v.astype(float).T
    want = {(i, j, r + 1) for i in range(90) for r, j in enumerate(sorted((j for j in range(90) if j != i), key=lambda j: (-round(s[i, j], 9), j))[:5])}
    assert {(r.vec_id, r.neighbour, r["rank"]) for r in found.collect()} == want
    far = spark.createDataFrame([(i, [float(x) * 1e30 for x in w]) for i, w in enumerate(v[:9])], "vec_id long, embedding array<double>")
    assert neighbours.knn(far, 3).count() == 27


def test_occurrences_are_not_shuffled(spark):
    docs = _docs(spark)
    found = tokens.document_frequency(docs, pairs=False)
    assert sorted((r.term, r.df, r.tf) for r in found.collect()) == sorted([("solar", 1, 2), ("panels", 2, 2), ("make", 1, 1), ("power", 2, 3), ("le", 1, 1), ("soleil", 1, 3)])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "hashpartitioning(" in x and "doc_id" in x and "term" in x]


def test_window_counts_are_made_once(spark):
    df = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["a", "b"])], "doc_id long, tokens array<string>")
    assert "MapInPandas" not in coherence.npmi(coherence.window_counts(df, ["a", "b"], 4))._jdf.queryExecution().executedPlan().toString()


def test_combinations_of_runs_are_short_keys(spark, monkeypatch):
    plans = _plans(monkeypatch, tokens)
    docs = spark.createDataFrame([(i, "alpha beta" if i % 2 else "gamma alpha") for i in range(8)], "doc_id long, text string")
    runs_ = spark.createDataFrame([(r, i, (i % 2) - r) for r in range(2) for i in range(8) if i != 3 or r], "run_id int, doc_id long, topic int")
    got = {(r.run_id, r.topic, r.term) for r in tokens.ctfidf_runs(docs, runs_, 5, pairs=False).collect()}
    assert got == {(r, t - r, w) for r in range(2) for t in range(2) for w in (("alpha", "beta") if t else ("gamma", "alpha"))}
    assert len(plans) == 2 and "keys=[__c" in plans[0]
