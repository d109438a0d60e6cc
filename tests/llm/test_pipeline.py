import pytest

import corpus_pipeline
from lamina.llm import mixing, neardup, quality


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    body = lambda k, n=90: " ".join(f"t{k}x{i}" for i in range(n))
    rows = [(i, body(i) + ("\nAll rights reserved." if i % 3 == 0 else ""), "en", f"s{i % 4}", 0) for i in range(24)]
    rows += [(100, body(5), "en", "s1", 0), (101, body(5), "en", "s2", 0), (102, "too short", "en", "s1", 0), (103, None, "en", None, 0), (104, body(50) + " mail me@x.org please", "de", "s3", 0), (5, body(5), "en", "s1", 0)]
    rows += [(200, " | ".join(body(9, 80).split()), "en", "s0", 0)]
    folder = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(folder / "documents.parquet"))
    return str(folder)


def test_stages_do_what_they_say(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_duplicates", "personal_data", "source_mix", "packed_sequences"]
    a = corpus_pipeline.quality_rules(spark, docs, small).cache()
    assert a.columns == columns
    judged = {r.doc_id: quality.measure(r.text, least=1) for r in docs.collect()}
    expected = {i: m[-1] for i, m in judged.items() if m[-2]}
    assert {r.doc_id: r.text for r in a.collect()} == expected and {103, 200} & set(expected) == set() and 102 in expected
    b = corpus_pipeline.near_duplicates(spark, a, small).cache()
    ids = [r.doc_id for r in b.collect()]
    assert b.columns == columns and len(ids) == len(set(ids)) and set(ids) == {r.component_id for r in neardup.classes(a).collect()} and 5 in ids and 100 not in ids
    c = corpus_pipeline.personal_data(spark, b, small).cache()
    assert c.columns == columns and c.count() == b.count() and "[EMAIL]" in c.where("doc_id = 104").first().text
    d = corpus_pipeline.source_mix(spark, c, small).cache()
    copies = {r.doc_id: r.copies for r in mixing.mix(c).collect()}
    seen = {}
    for r in d.collect():
        seen[r.doc_id] = seen.get(r.doc_id, 0) + 1
    assert d.columns == columns and seen == {k: v for k, v in copies.items() if v}
    e = corpus_pipeline.packed_sequences(spark, d, small)
    assert e.where("piece = 0").count() == d.count()


def test_run_equals_the_stages_and_survives_an_empty_table(spark, small, tmp_path):
    out = corpus_pipeline.run(spark, small)
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0
    spark.read.parquet(f"{small}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert corpus_pipeline.ORACLE_SQL is None


def test_each_group_keeps_one_row_with_null_or_repeated_ids(spark):
    body = lambda k: " ".join(f"w{k}y{i}" for i in range(60))
    # lone texts without ids; a copy without id of one that has an id; one id with two lone texts, one with a copy and a lone text
    rows = [(None, body(i), "a") for i in range(5)] + [(1, body(20), "a"), (None, body(20), "a"), (2, body(30), "a"), (2, body(31), "a"), (3, body(20), "a"), (3, body(40), "a")]
    rows += [(None, body(0), "b"), (None, body(0), "a"), (4, body(50), "b"), (4, body(50), "a"), (5, None, "a"), (None, None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted((tuple(r) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()), key=str)
    assert got == sorted([(None, body(i), "a") for i in range(5)] + [(1, body(20), "a"), (2, body(30), "a"), (2, body(31), "a"), (3, body(40), "a"), (4, body(50), "a"), (5, None, "a")], key=str)
    assert corpus_pipeline.near_duplicates(spark, docs.where("text IS NULL OR doc_id = 1"), "").count() == 2


_CLASH = "`__th` int, `__n` string, `__c` int, `__spans` string, row int, th string, n int, copies int, none boolean, id int, root string, rows int, m int, rank int, key string, sid int, hit int, spans string, `__rows` int, `__bucket` int"
_MORE = (1, "b", 3, "s", 5, "t", 7, 8, True, 10, "r", 12, 13, 14, "k", 16, 17, "p", 19, 20)


def test_columns_of_any_name_stay_as_they_are(spark):
    body = lambda k: " ".join(f"w{k}y{i}" for i in range(60)) + "."
    rows = [(1, body(1), "s"), (2, body(2) + " me@x.org ok.", "s"), (3, body(2) + " me@x.org ok.", "s"), (4, body(4), None), (4, body(4), None), (None, body(5), "u"), (5, None, "u"), (6, "", "u")]
    docs = spark.createDataFrame([(*r, *_MORE) for r in rows], "doc_id long, text string, source string, " + _CLASH)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        got = out.collect()
        assert out.columns == docs.columns and got and all(tuple(r)[3:] == _MORE for r in got), name
    assert corpus_pipeline.near_duplicates(spark, docs, "").count() == 5
    assert corpus_pipeline.packed_sequences(spark, docs, "").count() == len(rows)


def test_repeated_rows_share_the_copies_of_the_mix(spark):
    body = lambda k, n: " ".join(f"w{k}y{i}" for i in range(n))
    rows = [(1, body(1, 30), "a", 0)] * 7 + [(1, body(1, 30), "a", 1)] * 3 + [(None, body(2, 50), "b", k) for k in range(5)] + [(i, body(i, 20 + i), "c", 0) for i in range(10, 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, k int")
    want = {}
    for r in mixing.mix(docs).collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + r.copies
    got = {}
    for r in mixing.mixed(docs).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
        assert (r.doc_id, r.text, r.source, r.k) in rows
    assert got == {k: v for k, v in want.items() if v}
