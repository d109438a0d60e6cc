"""Operators over small hand-made pages, on which every rule fires.

The tables of the driver hold no positioned blocks, and the pseudo layouts made
from them reach few of the page rules.  Here the rows are written out, and so
is what they must give: the SQL is the expected table, not a second program.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lamina.operators import chrome, overrides, quality
from lamina.plans import extraction
from lamina.queries.sql import q
from lamina.schema import BLOCKS
from lamina.sources import blocks as src


def _block(doc, page, i, x0, y0, x1, y1, text, font=10.0):
    return doc, page, i, 600.0, 800.0, float(x0), float(y0), float(x1), float(y1), text, [font]


def _body(k: int, n: int = 60) -> str:
    return " ".join(f"body{k}n{i}" for i in range(n))


_NAV = [_block("nav", 1, i, 10 + 110 * i, 30, 70 + 110 * i, 42, f"Item{i}") for i in range(5)] + [_block("nav", 1, 5, 60, 200, 520, 300, _body(1))]
_CARDS = [_block("cards", 0, k, 60, 60 + 70 * k, 520, 110 + 70 * k, _body(k)) for k in range(6)] + [_block("cards", 0, 6 + i, 50 + 110 * i, 500, 140 + 110 * i, 560, f"Card {i}\nshort line\nend", 11.0) for i in range(4)]
_TITLE = [_block("title", 1, i, 10 + 110 * i, 90, 70 + 110 * i, 130, f"Frag{i}", 28.0 + 4 * i) for i in range(5)]
_ALONE = [
    _block("alone", 0, 0, 60, 20, 200, 50, "Daily News"), _block("alone", 0, 1, 60, 120, 400, 220, _body(2)), _block("alone", 0, 2, 60, 230, 400, 330, _body(3)), _block("alone", 0, 3, 60, 400, 200, 412, "Read  more"),
    _block("alone", 0, 4, 60, 450, 200, 490, "Share\nPrint\nMenu"), _block("alone", 0, 5, 60, 500, 590, 512, "Alpha beta\nGamma delta\nEps zeta\nEta theta\nIota kappa\nLam mu", 8.0), _block("alone", 0, 6, 430, 230, 590, 250, "Teaser headline about a thing"),
]
_WIDGET = [_block("widget", 1, 0, 60, 100, 240, 300, _body(4)), _block("widget", 1, 1, 270, 100, 420, 112, "Popular now"), _block("widget", 1, 2, 270, 130, 420, 150, "Another story of the day"), _block("widget", 1, 3, 60, 310, 240, 420, _body(5))]


def chrome_fixtures(spark, sf_dir):
    """The reason of every removed block of pages that hold each kind of navigation."""
    return chrome.page_chrome(spark.createDataFrame(_NAV + _CARDS + _TITLE + _ALONE + _WIDGET, BLOCKS))


_REASONS = (
    [("nav", 1, i, "nav-row") for i in range(5)] + [("cards", 0, 6 + i, "card-grid") for i in range(4)]
    + [("title", 1, i, "side-rail") for i in (3, 4)]  # beyond the lone first column
    + [("alone", 0, 0, "top-strip"), ("alone", 0, 3, "chrome-phrase"), ("alone", 0, 4, "merged-chrome"), ("alone", 0, 5, "packed-lines"), ("alone", 0, 6, "side-rail"), ("widget", 1, 1, "chrome-phrase"), ("widget", 1, 2, "widget-sibling")]
)

_CUT_OFF = "ab\ncd\nef\ngh\nij"
_PAGES = (
    [_block("torn", 0, i, 60, 100 + 80 * i, 100, 170 + 80 * i, _CUT_OFF) for i in range(2)] + [_block("torn", 0, 2, 60, 400, 520, 500, _body(6))]
    + [_block("once", 0, 0, 60, 100, 100, 170, _CUT_OFF), _block("once", 0, 1, 60, 400, 520, 500, _body(6)), _block("once", 0, 2, 60, 520, 100, 600, _CUT_OFF, 32.0), _block("once", 0, 3, 60, 620, 100, 640, "ab\ncd")]
    + [_block("glued", 0, i, 60, 100 + 80 * i, 520, 170 + 80 * i, f"so|me wo~rds ar^e {_body(i, 20)}") for i in range(2)]
    + [_block("cover", 0, i, 60, 100 + 55 * i, 200, 140 + 55 * i, w, 36.0) for i, w in enumerate(("The", "Big", "Cover", "Page"))] + [_block("cover", 0, 4, 260, 600, 500, 640, "A subtitle on three short lines of text", 12.0)]
    + [_block("plain", 0, i, 60, 100 + 120 * i, 520, 200 + 120 * i, _body(i)) for i in range(3)]
    + [_block("broken", 0, i, 72, 60 + 13 * i, 200, 70 + 13 * i, f"short line {i:02d} here", 8.0) for i in range(55)]
)


def verdict_fixtures(spark, sf_dir):
    """Page verdicts: truncated and corrupted text layers, covers, fragments."""
    judged = quality.verdicts(quality.page_stats(spark.createDataFrame(_PAGES, BLOCKS)))
    return judged.select("doc_id", "garbled_text_layer_block_count", "weird_glued_symbol_word_count", "decorative", "garbled", "char_garbled", "safe", "exclude")


_JUDGED = [("torn", 2, 0, False, True, False, False, False), ("once", 1, 0, False, False, False, True, False), ("glued", 0, 6, False, False, True, False, False), ("cover", 0, 0, True, False, False, True, True), ("plain", 0, 0, False, False, False, False, False), ("broken", 0, 0, True, False, False, False, False)]

_SHEETS = [_block("ruling", p, i, *box, t, f) for p in range(3) for i, (box, t, f) in enumerate([((250, 40, 350, 52), f"Page: {p + 1}", 10.0), ((60, 100, 520, 300), _body(10 + p), 11.0), ((60, 320, 520, 500), f"More at www.site.org/{p}. {_body(20 + p, 40)}", 11.0), ((580, 300, 596, 500), "CERTIFIED COPY", 8.0)])]
_COLUMNS = [_block("columns", 0, 0, 320, 100, 540, 400, _body(31)), _block("columns", 0, 1, 72, 100, 290, 400, _body(30))]
_RANGE = [_block("range", 0, i, 60, 100 + 60 * i, 520, 150 + 60 * i, t) for i, t in enumerate([_body(40), "FINDINGS of the court " + _body(41), _body(42), "Annex " + _body(43)])]
_FILES = [("ruling", "ruling.pdf", None), ("columns", "columns.pdf", None), ("cover", "cover.pdf", None), ("empty", "empty.pdf", None), ("byhand", "skip-me.pdf", None), ("corrupt", "corrupt.pdf", "FileDataError: no objects found"), ("range", "range.pdf", None), ("broken", "broken.pdf", None)]


def extract_fixtures(spark, sf_dir):
    """The whole extraction over documents of every kind, with all review reasons in words."""
    blocks = spark.createDataFrame(_SHEETS + _COLUMNS + _RANGE + [b for b in _PAGES if b[0] in ("cover", "broken")] + [_block("byhand", 0, 0, 60, 100, 520, 300, _body(50))], BLOCKS)
    rules = overrides.rules_table(spark, [{"match": "skip-*.pdf", "mode": "skip"}, {"match": "range.pdf", "mode": "heading_range", "start_heading": "findings", "end_heading": "annex"}])
    found = extraction.extract(spark.createDataFrame(_FILES, "doc_id string, filename string, error string"), src.pages_of(blocks), blocks, rules)
    return found.select("doc_id", "success", "flagged", "page_count", "override_mode", "urls_removed", F.array_join("flag_reasons", " | ").alias("reasons"), F.array_join("auto_excluded_pages", ",").alias("excluded"), "text")


_PAGE_BREAK = "\n"  # empty lines go with the residue
_TEXTS = {
    "ruling": _PAGE_BREAK.join(f"{_body(10 + p)}\nMore at. {_body(20 + p, 40)}" for p in range(3)),
    "columns": f"{_body(30)}\n{_body(31)}",
    "range": f"FINDINGS of the court {_body(41)}\n{_body(42)}",
    "broken": "\n".join(f"short line {i:02d} here" for i in range(55)),
}
_EXTRACTED = [
    ("ruling", True, False, 3, "", 3, "", "", _TEXTS["ruling"]), ("columns", True, False, 1, "", 0, "", "", _TEXTS["columns"]),
    ("cover", True, True, 1, "", 0, "entire document excluded as decorative layout", "0", ""), ("empty", True, True, 0, "", 0, "document had zero pages", "", ""), ("byhand", True, True, 0, "skip", 0, "marked as manual-only by override", "", None),
    ("corrupt", False, True, 0, "", 0, "error during processing: FileDataError: no objects found", "", None), ("range", True, True, 1, "heading_range", 0, "heading range applied: check the headings", "", _TEXTS["range"]),
    ("broken", True, True, 1, "", 0, "possibly decorative, was NOT auto-excluded: pages [1]", "", _TEXTS["broken"]),
]


def _results(spark):
    rows = [(d, f, e is None, n, n > 0, "", r, e) for d, f, e, n, r in [("a", "a.pdf", None, 3, []), ("b", "b.pdf", None, 2, ["low text yield: 3 chars/page", "zero characters extracted"]), ("c", "c.pdf", "ValueError: x", 0, ["error during processing: ValueError: x"])]]
    return spark.createDataFrame([(*r[:4], bool(r[6]), *r[5:7], r[7]) for r in rows] + [("d", "d.pdf", True, 1, True, "", [], None)], "doc_id string, source_path string, success boolean, page_count long, flagged boolean, override_mode string, flag_reasons array<string>, error string")


def flagged_fixtures(spark, sf_dir):
    """The listing of documents to review, with their reasons in one line."""
    return quality.flagged(_results(spark))


def _values(rows: list[tuple], types: dict[str, str]) -> str:
    say = lambda v: "NULL" if v is None else q(v).replace("\n", "' || chr(10) || '") if isinstance(v, str) else str(v).lower() if isinstance(v, bool) else str(v)
    listed = ", ".join("(" + ", ".join(map(say, r)) + ")" for r in rows)
    return f"SELECT {', '.join(f'CAST({c} AS {t}) AS {c}' for c, t in types.items())} FROM (VALUES {listed}) t({', '.join(types)})"


QUERIES = {f.__name__: f for f in (chrome_fixtures, verdict_fixtures, extract_fixtures, flagged_fixtures)}
ORACLES = {
    "chrome_fixtures": _values(_REASONS, {"doc_id": "VARCHAR", "page_index": "INTEGER", "block_index": "INTEGER", "reason": "VARCHAR"}),
    "verdict_fixtures": _values(
        _JUDGED, {"doc_id": "VARCHAR", "garbled_text_layer_block_count": "BIGINT", "weird_glued_symbol_word_count": "BIGINT", **dict.fromkeys(("decorative", "garbled", "char_garbled", "safe", "exclude"), "BOOLEAN")}
    ),
    "flagged_fixtures": _values([("b.pdf", "low text yield: 3 chars/page; zero characters extracted"), ("c.pdf", "error during processing: ValueError: x"), ("d.pdf", "unspecified")], {"source_file": "VARCHAR", "reasons": "VARCHAR"}),
    "extract_fixtures": _values(
        _EXTRACTED, {"doc_id": "VARCHAR", "success": "BOOLEAN", "flagged": "BOOLEAN", "page_count": "BIGINT", "override_mode": "VARCHAR", "urls_removed": "BIGINT", "reasons": "VARCHAR", "excluded": "VARCHAR", "text": "VARCHAR"}
    ),
}
