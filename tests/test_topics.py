import math

import numpy as np
from pyspark.sql import functions as F

from lamina.operators import cases, coherence, compare, density, neighbours, runs, tokens
from lamina.sources import corpus
from lamina.streaming import ingest


def test_tokens_bridge_stop_words(spark):
    r = spark.range(1).select(tokens.terms(F.lit("The café of Ünal was a_b x 42"), ["the", "of", "was"])).first()[0]
    assert r == ["café", "ünal", "a_b", "42", "café ünal", "ünal a_b", "a_b 42"]


def test_ctfidf_by_hand(spark):
    docs = spark.createDataFrame([("a", "cat cat dog"), ("b", "dog dog dog")], "c string, text string")
    got = {(r.c, r.term): r.weight for r in tokens.ctfidf(docs, ["c"], 5, pairs=False).collect()}
    assert abs(got["a", "cat"] - 2 / 3 * math.log(1 + 3 / 2)) < 1e-12 and abs(got["b", "dog"] - math.log(1 + 3 / 4)) < 1e-12
    assert {r.term for r in tokens.ctfidf(docs, ["c"], 5, min_classes=2, pairs=False).collect()} == {"dog"}


def test_density_finds_blobs_and_noise():
    rng = np.random.default_rng(0)
    blobs = np.concatenate([rng.normal(c, 0.1, size=(30, 2)) for c in ((0, 0), (5, 5), (0, 6))])
    labels = density.cluster(np.concatenate([blobs, [[20, 20], [-15, 9]]]), 10)
    assert [len(set(labels[i * 30 : i * 30 + 30])) for i in range(3)] == [1, 1, 1] and len(set(labels[:90])) == 3 and list(labels[90:]) == [-1, -1]
    assert (density.cluster(rng.normal(size=(5, 2)), 10) == -1).all()
    perm = rng.permutation(90)
    again = density.cluster(blobs[perm], 10)
    assert len(set(zip(density.cluster(blobs, 10)[perm], again))) == 3
    y = density.reduce(rng.normal(size=(40, 8)), 3, 7)
    x = np.random.default_rng(1).normal(size=(40, 8))
    assert y.shape == (40, 3) and np.array_equal(density.reduce(x, 3, 7), density.reduce(x, 3, 7)) and not np.array_equal(density.reduce(x, 3, 7), density.reduce(x, 3, 8))


def test_knn_by_hashing_agrees_mostly(spark, monkeypatch):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(20, 16))
    v = np.concatenate([base + rng.normal(scale=0.05, size=base.shape) for _ in range(6)])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    exact = {(r.vec_id, r.neighbour) for r in neighbours.knn(df, 5).collect()}
    monkeypatch.setattr(neighbours, "MOST_BROADCAST", 0)
    hashed = {(r.vec_id, r.neighbour) for r in neighbours.knn(df, 5).collect()}
    assert len(exact) == 600 and len(exact & hashed) / len(exact) > 0.9


def test_knn_is_exact_beyond_one_block(spark, monkeypatch):
    rng = np.random.default_rng(6)
    v = rng.normal(size=(150, 16))
    v[40:60] = v[3]  # ties by key, across blocks
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    s = np.float32(v).astype(float) @ np.float32(v).astype(float).T
    slow = {(i, j, r + 1) for i in range(150) for r, j in enumerate(sorted((j for j in range(150) if j != i), key=lambda j: (-round(s[i, j], 9), j))[:7])}
    monkeypatch.setattr(neighbours, "MOST_BROADCAST", 0)
    monkeypatch.setattr(neighbours, "LEAST_ROWS", 40, raising=False)
    near = neighbours.knn(df, 7)
    assert {(r.vec_id, r.neighbour, r["rank"]) for r in near.collect()} == slow
    core = neighbours.core_distances(near, 7)
    assert core.count() == 150 and neighbours.mutual_reachability(near, core).count() == 1050
    few = neighbours.knn(df.where("vec_id < 3").withColumn("vec_id", F.concat(F.lit("é"), "vec_id")), 7)
    assert sorted((r.vec_id, r.neighbour) for r in few.collect()) == [(f"é{i}", f"é{j}") for i in range(3) for j in range(3) if i != j]


def test_comparison_by_hand(spark):
    a = spark.createDataFrame([(0, d, t) for d, t in enumerate([0, 0, 0, 1, 1, -1])] + [(1, d, t) for d, t in enumerate([1, 1, 0, 0, -1, 0])] + [(2, d, -1) for d in range(6)], "run_id int, doc_id int, topic int")
    w = spark.createDataFrame([(0, 0, 1, "x"), (0, 0, 2, "y"), (0, 1, 1, "z"), (1, 1, 1, "y"), (1, 0, 1, "q")], "run_id int, topic int, rank int, term string")
    got = {(r.comparison_run, r.reference_topic): r for r in compare.compare_topics(a, w, 0).collect()}
    assert (got[1, 0].best_match, got[1, 0].best_overlap) == (1, 2) and abs(got[1, 0].preservation - 2 / 3) < 1e-9 and got[1, 0].word_jaccard == 0.5
    assert got[1, 1].best_match == 0 and got[1, 1].word_jaccard == 0.0 and got[2, 0].best_match is None and got[2, 0].word_jaccard is None
    stable = {(r.reference_topic, r.word): r.seed_count for r in compare.stable_words(compare.compare_topics(a, w, 0), w, 0).collect()}
    assert stable == {(0, "x"): 1, (0, "y"): 2, (1, "z"): 1, (1, "q"): 1}


def test_window_counts_and_coherence(spark):
    toks = [["a", "b", "c"] * 5, ["a"], [], ["c", "d"]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(toks)], "doc_id int, tokens array<string>")
    got = {(r.a, r.b): r.n for r in coherence.window_counts(df, ["a", "b", "d"], 4).collect()}
    slow = {}
    for t in toks:
        for i in range(max(1, len(t) - 3)):
            w = set(t[i : i + 4]) & {"a", "b", "d"}
            slow["", ""] = slow.get(("", ""), 0) + 1
            for x in w:
                for y in w:
                    if x <= y:
                        slow[x, y] = slow.get((x, y), 0) + 1
    assert got == slow
    words = spark.createDataFrame([(0, 0, "a"), (0, 0, "b")], "run_id int, topic int, term string")
    assert 0 < coherence.coherence(words, coherence.window_counts(df, ["a", "b"], 4)).first().coherence_cv <= 1 + 1e-9


def test_runs_relabel_and_grid(spark):
    table = runs.grid(spark, (5, 10), (3, 4), (1,))
    assert [(r.min_cluster_size, r.n_neighbors) for r in table.orderBy("run_id").collect()] == [(5, 3), (5, 4), (10, 3), (10, 4)]
    a = spark.createDataFrame([(1, 7), (2, 7), (3, 2), (4, -1)], "doc_id int, topic int")
    assert {r.doc_id: r.topic for r in tokens.relabel_by_size(a, []).collect()} == {1: 0, 2: 0, 3: 1, 4: -1}


def test_batches_reset(spark):
    df = spark.createDataFrame([("a", 60), ("b", 50), ("c", 40), ("d", 200), ("e", 1)], "case string, tokens long")
    assert {r.case: r.batch_no for r in cases.batches(df, budget=100).collect()} == {"a": 0, "b": 1, "c": 1, "d": 2, "e": 3}
    assert spark.range(1).select(cases.case_name(F.lit("Case_A_12.txt"))).first()[0] == "Case_A"


def test_text_files_and_stream(spark, tmp_path):
    d = tmp_path / "in" / "g1"
    d.mkdir(parents=True)
    (d / "b_1.txt").write_text("two\nlines")
    (d / "b_1.excluded.txt").write_text("x")
    got = corpus.text_files(spark, str(tmp_path / "in"), recursive=True)
    assert {(r.name, r.group) for r in got.collect()} == {("b_1.txt", "g1"), ("b_1.excluded.txt", "g1")}
    assert corpus.text_files(spark, str(tmp_path / "in"), True, sidecars=False).count() == 1
    assert [r.doc_idx for r in corpus.numbered(got).orderBy("name").collect()] == [0, 1]
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    spark.createDataFrame([(1, "see www.x.org")], "id long, text string").write.parquet(src)
    stream = ingest.clean_stream(spark, src, "id long, text string")
    ingest.run_available(stream, out, str(tmp_path / "ck"))
    assert spark.read.parquet(out).first().urls_removed == 1
    seen = []
    ingest.run_batches(spark, src, "id long, text string", lambda df, e: seen.append(df.count()), str(tmp_path / "ck2"))
    assert sum(seen) == 1
