import random

import numpy as np

from lamina.operators import chrome, dedupe, geometry, layout, order, overrides, quality
from lamina.plans import extraction
from lamina.schema import BLOCKS
from lamina.sources import blocks as src


def _b(doc, page, i, x0, y0, x1, y1, text, font=10.0, w=600.0, h=800.0):
    return (doc, page, i, w, h, float(x0), float(y0), float(x1), float(y1), text, [font])


def _frame(spark, rows):
    return spark.createDataFrame(rows, BLOCKS)


def _para(k, n=40):
    return " ".join(f"w{k}n{i}" for i in range(n))


def test_nav_row_and_decorative_title(spark):
    nav = [_b("a", 1, i, 10 + 110 * i, 30, 70 + 110 * i, 42, f"Item{i}") for i in range(5)]
    title = [_b("b", 1, i, 10 + 110 * i, 90, 70 + 110 * i, 130, f"Frag{i}", 28.0 + 4 * i) for i in range(5)]
    rows = chrome.nav_rows(layout.with_geometry(_frame(spark, nav + title))).collect()
    assert {r.doc_id for r in rows if r.nav} == {"a"}


def test_card_grid_cases():
    wide = [(60, 40 + 60 * k, 520, 80 + 60 * k, 300) for k in range(6)]
    cards = [(50 + 110 * i, 500, 140 + 110 * i, 560, 30) for i in range(4)]
    run = lambda rows, garbled=False: geometry.card_grid(*[np.array(c, float) / d for c, d in zip(zip(*[r[:4] for r in rows]), (600, 800, 600, 800))], np.array([r[4] for r in rows]), np.full(len(rows), garbled))
    assert run(wide + cards).tolist() == [False] * 6 + [True] * 4
    assert not run(wide + cards, True).any() and not run([(50 + 25 * i, 500, 70 + 25 * i, 560, 9) for i in range(20)]).any()
    many = [(20 + 35 * i, 500, 50 + 35 * i, 560, 9) for i in range(15)]
    assert not run(wide + many).any()


def test_main_column_prefers_long_text():
    x0, x1, n = np.array([0.1, 0.1, 0.7, 0.7]), np.array([0.6, 0.62, 0.9, 0.9]), np.array([200, 90, 20, 20])
    assert geometry.main_column(x0, x1, n) == (0.1, 0.62)
    assert geometry.main_column(x0, x1, np.array([10, 10, 20, 20])) == (0.1, 0.62)
    assert geometry.main_column(np.array([0.1, 0.5, 0.5]), np.array([0.3, 0.9, 0.9]), np.array([85, 70, 70])) == (0.5, 0.9)


def test_clusters_equal_first_fit(spark):
    rng = random.Random(1)
    rows = [_b("d", p, 0, 60 + rng.randint(0, 90), 700, 200 + rng.randint(0, 9), 712, f"- {p} -") for p in range(30)] + [_b("d", p, 1, 60, 100, 500, 200, _para(p)) for p in range(30)]
    blocks = _frame(spark, rows)
    c = dedupe.clusters(dedupe.candidates(blocks, src.pages_of(blocks)).where("n_words <= 25")).collect()
    places, of = [], {}
    for r in sorted(c, key=lambda r: r.page_index):
        box = np.array([r.x0f, r.y0f, r.x1f, r.y1f])
        hit = next((i for i, m in enumerate(places) if any((abs(box - b) <= 0.04).all() for b in m)), len(places))
        places[hit:hit] = [[]] if hit == len(places) else []
        places[hit].append(box)
        of[r.page_index] = hit
    assert {r.page_index: r.cluster for r in c} == of and max(of.values()) > 0


def test_repeated_furniture(spark):
    rows = []
    for p in range(8):
        rows += [_b("d", p, 0, 250, 40, 350, 52, f"Page: {p + 1}"), _b("d", p, 1, 60, 100, 520, 300, _para(p)), _b("d", p, 2, 60, 760, 200, 772, "Journal" if p % 2 == 0 else f"Other {'x' * p}")]
    rows += [_b("two", p, 0, 250, 40, 350, 52, "Letterhead") for p in range(2)] + [_b("two", 0, 1, 0, 0, 99, 9, "2024-03-01, 9:41 PM page")]
    blocks = _frame(spark, rows)
    got = {(r.doc_id, r.page_index, r.block_index): r.reason for r in dedupe.repeated(blocks, src.pages_of(blocks)).collect()}
    assert got == {("d", p, 0): "repeated" for p in range(8)} | {("d", p, 2): "repeated-even" for p in range(0, 8, 2)} | {("two", 0, 1): "print-stamp"}


def test_page_chrome_keeps_the_article(spark):
    rows = [_b("n", 0, 0, 60, 200, 400, 300, _para(1)), _b("n", 0, 1, 60, 310, 400, 400, _para(2)), _b("n", 0, 2, 430, 200, 590, 212, "Popular now"), _b("n", 0, 3, 430, 230, 590, 250, "Teaser headline about a thing"), _b("n", 0, 4, 60, 20, 200, 32, "Daily News"), _b("n", 0, 5, 60, 150, 300, 170, "The headline itself", 16.0)]
    got = {r.block_index: r.reason for r in chrome.page_chrome(_frame(spark, rows)).collect()}
    assert got == {2: "chrome-phrase", 3: "side-rail", 4: "top-strip"}


def _slow_order(blocks, width):
    def gap(iv, least):
        merged = []
        for a, b in sorted(iv):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        best = None
        for p, q in zip(merged, merged[1:]):
            if q[0] - p[1] > least:
                least, best = q[0] - p[1], (p[1] + q[0]) / 2
        return best

    if len(blocks) <= 1:
        return blocks
    for lo, hi, least in ((2, 4, 0.0), (1, 3, width * 0.015)):
        cut = gap([(b[lo], b[hi]) for b in blocks], least)
        if cut is not None:
            return _slow_order([b for b in blocks if b[hi] <= cut], width) + _slow_order([b for b in blocks if b[lo] >= cut], width)
    return sorted(blocks, key=lambda b: (b[2], b[1]))


def test_reading_order_equals_recursion(spark):
    rng = random.Random(5)
    rows = []
    for d in range(30):
        for i in range(rng.randint(1, 9)):
            x, y = rng.randint(0, 500), rng.randint(0, 700)
            rows.append(_b(f"d{d}", 0, i, x, y, x + rng.randint(5, 250), y + rng.randint(5, 120), f"t{i}"))
    blocks = _frame(spark, rows)
    got = {}
    for r in order.reading_order(blocks).collect():
        got.setdefault(r.doc_id, {})[r.pos] = r.block_index
    for d in {r[0] for r in rows}:
        mine = [(r[2], *r[5:9]) for r in rows if r[0] == d]
        assert [got[d][k] for k in range(len(mine))] == [b[0] for b in _slow_order(mine, 600.0)]


def test_two_columns_and_page_breaks(spark):
    rows = [_b("c", 0, 0, 72, 100, 290, 400, "left"), _b("c", 0, 1, 320, 100, 540, 400, "right"), _b("c", 1, 0, 72, 100, 290, 400, " next ")]
    blocks = _frame(spark, rows)
    assert order.reassemble(blocks, order.reading_order(blocks)).first().text == "left\n\nright\n\n\n\nnext"


def test_text_layer_and_ocr(spark):
    pages = spark.createDataFrame([("d", 0, 600.0, 800.0), ("d", 1, 600.0, 800.0), ("d", 2, 600.0, 800.0)], "doc_id string, page_index int, width double, height double")
    images = spark.createDataFrame([("d", 1, 600.0, 500.0)], "doc_id string, page_index int, w double, h double")
    blocks = _frame(spark, [_b("d", 0, 0, 0, 0, 9, 9, "long enough text"), _b("d", 1, 0, 0, 0, 9, 9, "a caption on a scan")])
    layered = layout.text_layer(layout.image_share(pages, images), blocks)
    assert {r.page_index: r.has_text_layer for r in layered.collect()} == {0: True, 1: False, 2: False}
    ocr = spark.createDataFrame([("d", 1, "read text"), ("d", 2, "")], "doc_id string, page_index int, text string")
    assert sorted((r.page_index, r.text) for r in layout.inject_ocr(blocks, layered, ocr).collect()) == [(0, "long enough text"), (1, "read text")]


def test_extraction_end_to_end(spark, tmp_path):
    rows = []
    for p in range(3):
        rows += [_b("1", p, 0, 250, 40, 350, 52, f"Page: {p + 1}"), _b("1", p, 1, 60, 100, 520, 300, _para(p, 60)), _b("1", p, 2, 60, 320, 520, 500, f"More at www.site.org/{p}. " + _para(p + 9, 40))]
    rows += [_b("2", 0, i, 60, 100 + 55 * i, 200, 140 + 55 * i, w, 36.0) for i, w in enumerate(["The", "Big", "Cover", "Page"])] + [_b("2", 0, 4, 260, 600, 500, 640, "A subtitle on three short lines of text", 12.0)]
    rows += [_b("4", 0, 0, 60, 100, 520, 300, _para(3, 60))]
    blocks = _frame(spark, rows)
    docs = spark.createDataFrame([("1", "one.pdf", None), ("2", "cover.pdf", None), ("3", "empty.pdf", None), ("4", "skip-me.pdf", None), ("5", "bad.pdf", "ValueError: broken")], "doc_id string, filename string, error string")
    rules = overrides.rules_table(spark, [{"match": "skip-*.pdf", "mode": "skip", "reason": "by hand"}])
    out = extraction.extract(docs, src.pages_of(blocks), blocks, rules).cache()
    got = {r.doc_id: r for r in out.collect()}
    assert "Page:" not in got["1"].text and "w2n59" in got["1"].text and got["1"].urls_removed == 3 and not got["1"].flagged and got["1"].page_count == 3
    assert got["2"].auto_excluded_pages == [0] and got["2"].text == "" and "Cover" in got["2"].excluded_text and got["2"].flagged
    assert got["3"].flag_reasons == ["document had zero pages"] and got["4"].text is None and got["4"].override_mode == "skip" and got["4"].success
    assert not got["5"].success and got["5"].flagged
    report = quality.report(out)
    assert len(report.columns) == 18 and report.where("source_file = 'cover.pdf'").first().auto_excluded_pages == "1"
    total = quality.batch_summary(out).first()
    assert (total.documents, total.failed, total.flagged) == (5, 1, 4)
    from lamina.sources import sinks

    sinks.write_texts(out, str(tmp_path / "texts"))
    assert sorted(p.name for p in (tmp_path / "texts").iterdir()) == ["cover.excluded.txt", "cover.txt", "empty.txt", "one.txt"]


def test_rules(spark, tmp_path):
    (tmp_path / "r.yaml").write_text("overrides:\n- match: a*.pdf\n  pages: [2]\n- match: '*'\n  mode: skip\n")
    rules = overrides.load_rules(spark, str(tmp_path / "r.yaml"))
    names = spark.createDataFrame([("a1.pdf",), ("b.pdf",)], "filename string")
    assert {r.filename: r["mode"] for r in overrides.match_rules(names, rules).collect()} == {"a1.pdf": "pages", "b.pdf": "skip"}
    (tmp_path / "e.yaml").write_text("")
    assert overrides.load_rules(spark, None).count() == overrides.load_rules(spark, str(tmp_path / "e.yaml")).count() == 0
    b = _frame(spark, [_b("d", 0, i, 0, 0, 1, 1, t) for i, t in enumerate(["intro", "START here", "body", "the End", "after"])]).withColumns({"start_heading": __import__("pyspark").sql.functions.lit("start"), "end_heading": __import__("pyspark").sql.functions.lit("end")})
    assert [r.text for r in overrides.heading_range(b).orderBy("block_index").collect()] == ["START here", "body"]
