"""Buckets with more fingerprints than ``hot``: what they become must not pass through the driver."""

import random

import corpus_pipeline
from lamina.llm import neardup
from test_neardup import _fingerprint, _groups, _signed

#: Look-ups of a fingerprint where they are few in number; Spark may broadcast those of a small table.
ASKED = 20


def _broadcast_rows(df):
    """Rows of the largest broadcast of a DataFrame that has run."""

    def walk(plan):
        kind = plan.getClass().getSimpleName()
        if kind == "BroadcastExchangeExec":
            yield plan.metrics().get("numOutputRows").get().value()
        if kind == "AdaptiveSparkPlanExec":
            yield from walk(plan.executedPlan())
        elif kind.endswith("QueryStageExec"):
            yield from walk(plan.plan())
        for i in range(plan.children().size()):
            yield from walk(plan.children().apply(i))

    return max(walk(df._jdf.queryExecution().executedPlan()), default=0)


def test_half_way_values_are_not_broadcast(spark):
    rng = random.Random(5)
    base = rng.getrandbits(64)
    fps = {_signed(base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5)))) for _ in range(60)}
    pool = spark.createDataFrame([(f,) for f in fps], "fp long").distinct()
    met = neardup._through_middles(pool, 4)
    rows = met.collect()
    assert rows and all(r.a < r.b and bin((r.a ^ r.b) & (2**64 - 1)).count("1") <= 4 for r in rows)
    found = {}
    for r in neardup.components(met).collect():
        found.setdefault(r.root, set()).add(r.node)
    assert {frozenset(v) for v in found.values()} == {g for g in _groups(fps) if len(g) > 1}
    assert _broadcast_rows(met) <= len(fps)  # not 2,081 rows of each


def test_stage_joins_a_crowd_of_near_copies(spark, monkeypatch):
    body = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join([*body[:i], f"other{i}", *body[i + 1 :]])) for i in range(0, 120, 2)] + [(1000 + i, " ".join(f"z{i}y{j}" for j in range(60))) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    met, rooted, middles = [], neardup.rooted, neardup._through_middles
    monkeypatch.setattr(neardup, "rooted", lambda *args, **more: rooted(*args, **more, hot=5))
    monkeypatch.setattr(neardup, "_through_middles", lambda *args: met.append(middles(*args)) or met[-1])
    got = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()}
    monkeypatch.undo()
    assert got == {r.component_id for r in neardup.classes(docs).collect()} and 0 in got and len(got) < len(rows)
    assert len(met) == 1 and met[0].collect() and _broadcast_rows(met[0]) <= ASKED * len(rows)


def test_query_joins_a_crowd_of_near_copies(spark, monkeypatch, tmp_path):
    body = [f"w{i}" for i in range(300)]
    texts = {i: " ".join([*body[:i], f"other{i}", *body[i + 1 :]]) for i in range(0, 120, 2)} | {1000 + i: " ".join(f"z{i}y{j}" for j in range(60)) for i in range(5)}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    met, links, middles = [], neardup.links, neardup._through_middles
    monkeypatch.setattr(neardup, "links", lambda fps, count, radius, hot: links(fps, count, radius, 5))
    monkeypatch.setattr(neardup, "_through_middles", lambda *args: met.append(middles(*args)) or met[-1])
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in neardup.op10_simhash_near_dedup(spark, str(tmp_path)).collect()}
    prints = {i: _signed(_fingerprint(t)) for i, t in texts.items()}
    ids = {f: min(i for i, p in prints.items() if p in g) for g in _groups(set(prints.values())) for f in g}
    assert got == {i: (f"{p & (2**64 - 1):016x}", ids[p]) for i, p in prints.items()}
    assert len(met) == 1 and met[0].collect() and _broadcast_rows(met[0]) <= ASKED * len(texts)
