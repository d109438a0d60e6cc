import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from lamina.llm import quality

ROWS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "word " * 49), (5, "word " * 60), (6, " ".join(f"w{i}" for i in range(80))),
    (7, "\n".join(["Home | About | Contact | More"] * 3 + [" ".join(f"w{i}" for i in range(70))])),
    (8, " ".join(f"w{i}###" for i in range(80))), (9, "BUY!! NOW!! CHEAP!! GOODS!! " * 3 + "\n" + " ".join(f"v{i}" for i in range(90))),
    (10, " ".join(f"w{i}" for i in range(80)) + "\nAll rights reserved.\nLicensed under CC BY-NC 4.0."), (11, "é ü ñ " * 40 + "\x0b".join(f"x{i}" for i in range(40))),
    (12, "LOUD WORDS ARE SHOUTED HERE!!\n" * 5 + "calm " * 10 + " ".join(f"k{i}" for i in range(50))), (6, " ".join(f"w{i}" for i in range(80))),
]


def _slow_repeats(words, size=3):
    hit = set()
    grams = [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]
    for i, g in enumerate(grams):
        if grams.count(g) > 1:
            hit |= set(range(i, i + size))
    return len(hit)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=25))
def test_repeated_words_equal_brute_force(words):
    assert quality.repeated_words(words) == _slow_repeats(words)


def test_equals_the_sql_on_edge_cases(spark):
    docs = spark.createDataFrame(sorted(set(ROWS), key=str), "doc_id long, text string")
    got = {r.doc_id: tuple(r) for r in quality.judge(docs).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", sorted(set(ROWS), key=str))
    for row in con.execute(quality.ORACLE_SQL).fetchall():
        assert got[row[0]] == row


def test_verdicts():
    kept = {i: quality.measure(t)[6] for i, t in ROWS}
    assert kept[6] and kept[10] and kept[7] and not kept[8] and not kept[4] and not kept[5] and not kept[1]
    assert quality.line_fault("All rights reserved.") == "boilerplate" and quality.line_fault("a | b | c") == "navigation" and quality.line_fault("A plain sentence.") is None


def test_filter_keeps_columns_and_drops_lines(spark):
    docs = spark.createDataFrame([(i, t, "en", n, 9) for n, (i, t) in enumerate(ROWS)], "doc_id long, text string, lang string, kept long, n_chars long")
    out = quality.keep_good(docs)
    rows = {r.doc_id: r for r in out.collect()}
    assert out.columns == docs.columns and 8 not in rows and "rights" not in rows[10].text and rows[10].n_chars == len(rows[10].text) and rows[10].lang == "en"
    assert sum(r.doc_id == 6 for r in out.collect()) == 2
    assert quality.keep_good(docs.limit(0)).count() == 0 and quality.judge(docs.limit(0)).count() == 0
