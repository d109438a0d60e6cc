import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lamina import session
from lamina.operators import cases, coherence, embedding, grouped, layout, tokens
from lamina.plans import extraction
from lamina.sources import blocks as src


def test_groups_over_batch_borders(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None, "d"]), rng.randint(0, 9), i, float(rng.randint(0, 99))) for i in range(700)]
    df = spark.createDataFrame(rows, "g string, p int, i int, x double")
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = grouped.by_group(df, ["g", "p"], ["i"], ["x"], ["g", "p", "i"], lambda x: (np.argsort(-x, kind="stable")[:2], np.sort(-x)[:2]), [("top", pa.float64())]).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    groups = {}
    for r in sorted(rows, key=lambda r: r[2]):
        groups.setdefault(r[:2], []).append(r)
    want = [(*k, r[2], -r[3]) for k, rs in groups.items() for r in sorted(rs, key=lambda r: -r[3])[:2]]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert grouped.by_group(df.limit(0), ["g", "p"], ["i"], ["x"], ["g"], lambda x: ([0],), []).count() == 0


def test_reader_isolates_broken_files(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "good.pdf").write_bytes(b"two")
    (tmp_path / "bad.pdf").write_bytes(b"not a pdf")
    (tmp_path / "none.pdf").write_bytes(b"zero")

    def parse(content):
        if content == b"two":
            block = (0, 60.0, 100.0, 520.0, 300.0, "words of a page " * 20, [11.0])
            return [{"width": 600.0, "height": 800.0, "image_area_frac": 0.0, "blocks": [block]}, {"width": 600.0, "height": 800.0, "image_area_frac": 0.9, "blocks": []}]
        if content == b"zero":
            return []
        raise ValueError("no objects found")

    pages = src.pdf_pages(spark, str(tmp_path), parse).cache()
    documents, page_rows, blocks = src.tables_of(pages)
    assert {r.filename: r.error for r in documents.collect()} == {"good.pdf": None, "bad.pdf": "ValueError: no objects found"}
    assert sorted((r.page_index, r.has_text_layer) for r in page_rows.collect()) == [(0, True), (1, False)] and blocks.count() == 1
    out = {r.source_path: r for r in extraction.extract(documents, page_rows, blocks).collect()}
    assert out["good.pdf"].success and not out["bad.pdf"].success and "1 page(s) without text layer not read" in " ".join(out["good.pdf"].flag_reasons)
    images = spark.createDataFrame([(r.doc_id, 1, b"img") for r in page_rows.where("page_index = 1").collect()] + [("x", 0, b"")], "doc_id string, page_index int, image binary")
    assert layout.ocr_text(images, None).count() == 0

    def read(image):
        if not image:
            raise OSError("empty")
        return " read by a machine "

    ocr = layout.ocr_text(images, read)
    assert {(r.page_index, r.text, r.error) for r in ocr.collect()} == {(1, "read by a machine", None), (0, None, "OSError: empty")}
    again = {r.source_path: r for r in extraction.extract(documents, page_rows, blocks, ocr=ocr.select("doc_id", "page_index", "text")).collect()}
    assert again["good.pdf"].ocr_pages_used == [1] and "read by a machine" in again["good.pdf"].text


def test_answers_counts_and_schedule(spark):
    rows = spark.createDataFrame([("a", "{}"), ("b", "fail")], "case string, request string")

    def ask(body):
        if body == "fail":
            raise TimeoutError("late")
        return body.upper() + "!"

    assert sorted(map(tuple, cases.answers(rows, ask).collect())) == [("a", "{}!", None), ("b", None, "TimeoutError: late")]
    texts = spark.createDataFrame([(1, "one two"), (2, None)], "i int, text string")
    assert {r.i: r.tokens for r in cases.token_counts(texts, lambda: lambda t: len(t.split())).collect()} == {1: 2, 2: 0}
    batched = spark.createDataFrame([("a", 0), ("b", 0), ("c", 2)], "case string, batch_no int")
    assert [r.not_before for r in cases.schedule(batched, 15).orderBy("case").collect()] == [0.0, 4.0, 120.0]


def test_embeddings(spark):
    rows = [(1, "solar panels make power from light"), (2, "solar panels make power from sunlight"), (3, "the court found against the appeal"), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: np.array(r.embedding) for r in embedding.hashed(docs, 64).collect()}
    assert len(got) == 5 and all(len(v) == 64 for v in got.values()) and not got[4].any() and not got[5].any()
    assert all(abs(np.linalg.norm(got[i]) - 1) < 1e-9 for i in (1, 2, 3)) and got[1] @ got[2] > 0.5 > abs(got[1] @ got[3])
    own = {r.doc_id: r.embedding for r in embedding.embed(docs, lambda: lambda ts: [[len(t), 3.0] for t in ts]).collect()}
    assert own[4] == [0.0, 1.0] and abs(np.linalg.norm(own[1]) - 1) < 1e-9


def test_runs_are_tokenised_once_with_equal_words(spark):
    rng = random.Random(2)
    docs = spark.createDataFrame([(i, " ".join(rng.choice("alpha beta gamma delta omega sigma".split()) for _ in range(9))) for i in range(40)], "doc_id long, text string")
    runs = spark.createDataFrame([(r, i, (i + r) % 3) for r in range(3) for i in range(40)], "run_id int, doc_id long, topic int")
    one = tokens.ctfidf(docs.join(runs, "doc_id"), ["run_id", "topic"], 5, 2)
    many = tokens.ctfidf_runs(docs, runs, 5, 2)
    show = lambda d: sorted((r.run_id, r.topic, r["rank"], r.term, round(r.weight, 9)) for r in d.collect())
    assert show(one) == show(many) and len(show(one)) == 45
    table = coherence.dictionary(docs.select("doc_id", tokens.tokens(F.col("text")).alias("tokens")))
    assert [r.term for r in table.orderBy("id").collect()] == sorted("alpha beta gamma delta omega sigma".split())


def test_spread_moves_small_inputs_only(spark):
    cores = spark.sparkContext.defaultParallelism
    assert session.spread(spark.range(10).coalesce(1)).rdd.getNumPartitions() == cores
    many = spark.range(100, numPartitions=cores + 3)
    assert session.spread(many) is many
