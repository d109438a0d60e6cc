"""Layout operators over the two pseudo layouts."""

from __future__ import annotations

from pyspark.sql import functions as F

from lamina.functions import text as tx
from lamina.operators import chrome, dedupe, layout, order, overrides, quality
from lamina.plans import extraction
from lamina.queries.sql import LINK_BLOCKS, NL, chrome_key, is_phrase, is_stamp, line_blocks, lines, q, repeat_key, strip, wc
from lamina.sources import blocks as src

_RULES = [
    {"match": "doc_1[0-4]*.pdf", "mode": "pages", "pages": [1], "reason": "first page only"},
    {"match": "doc_?.pdf", "mode": "skip", "reason": "by hand"},
    {"match": "doc_[!1-5]*.pdf", "mode": "heading_range", "start_heading": "the", "end_heading": "and that"},
    {"match": "*", "mode": "pages"},
]
_RULE_SQL = (
    "CASE WHEN regexp_matches(f, '^doc_1[0-4].*\\.pdf$') THEN 0 WHEN regexp_matches(f, '^doc_.\\.pdf$') THEN 1 WHEN regexp_matches(f, '^doc_[^1-5].*\\.pdf$') THEN 2 ELSE 3 END"
)


def _docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")


def _lines(spark, sf_dir, n=12):
    return src.line_blocks(_docs(spark, sf_dir), n)


def _links(spark, sf_dir):
    return src.link_blocks(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def _menus(spark, sf_dir):
    """A page's links as one block of lines; in every third page each second line is a stock phrase."""
    items = F.regexp_extract_all("html", F.lit("<li><a[^>]*>([^<]*)</a>"), F.lit(1))
    mixed = F.transform(items, lambda x, i: F.when((F.col("page_id") % 3 == 0) & (i % 2 == 0), F.lit("Read  More")).otherwise(x))
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", F.array_join(mixed, "\n").alias("text"), (F.col("page_id") % 4 * 12 + 12).cast("double").alias("height"), F.lit(10.0).alias("font"))


_MENUS = f"""
m AS (SELECT page_id, regexp_extract_all(html, '<li><a[^>]*>([^<]*)</a>', 1) AS items FROM pages),
menus AS (SELECT page_id, array_to_string([CASE WHEN page_id % 3 = 0 AND i % 2 = 0 THEN 'Read  More' ELSE items[i + 1] END FOR i IN range(len(items))], {NL}) AS text, (page_id % 4 * 12 + 12)::DOUBLE AS height, 10.0::DOUBLE AS font FROM m)"""


def norm_dedup(spark, sf_dir):
    return _lines(spark, sf_dir).groupBy(tx.repeat_key(F.col("text")).alias("norm")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id").alias("docs"))


def print_stamp(spark, sf_dir):
    made = F.when(F.col("block_index") == 0, F.concat(F.lit("2024-03-0"), F.col("doc_id") % 9 + 1, F.lit(", 9:41 PM "), "text")).when(F.col("block_index") == 1, F.concat(F.lit("page "), F.col("page_index") + 1, F.lit(" of 9\n"), "text"))
    b = _lines(spark, sf_dir).withColumn("text", F.when(F.col("doc_id") % 2 == 0, F.coalesce(made, "text")).otherwise(F.col("text")))
    return b.where(tx.is_print_stamp(F.col("text"))).select("doc_id", "page_index", "block_index")


def repeat_removal(spark, sf_dir):
    """Four lines to a page, so that documents have pages to repeat on."""
    b = _lines(spark, sf_dir, 4)
    return dedupe.repeated(b, src.pages_of(b))


def coverage(spark, sf_dir):
    """Pages on which a line recurs, over all and over the same side of the sheet."""
    b = _lines(spark, sf_dir, 4)
    c = dedupe.candidates(b, src.pages_of(b)).where((F.col("n_words") <= dedupe.MAX_WORDS) & (F.col("norm") != ""))
    even = F.when(F.col("page_index") % 2 == 0, F.col("page_index"))
    hits = c.groupBy("doc_id", "norm").agg(F.countDistinct("page_index").alias("hit"), F.countDistinct(even).alias("hit_even"), F.first("n_pages").alias("n_pages"), F.first("n_even").alias("n_even"))
    return hits.where("hit > 1").select("doc_id", "norm", "hit", "hit_even", F.round(F.col("hit") / F.col("n_pages"), 6).alias("coverage"), F.round(F.col("hit_even") / F.col("n_even"), 6).alias("coverage_even"))


_COVERAGE = f"""
WITH {line_blocks(4)}, b AS (SELECT doc_id, page_index, {repeat_key('text')} AS norm, {wc('text')} AS w FROM blocks),
p AS (SELECT doc_id, count(DISTINCT page_index) AS np, count(DISTINCT page_index) FILTER (page_index % 2 = 0) AS ne FROM b GROUP BY doc_id),
h AS (SELECT doc_id, norm, count(DISTINCT page_index) AS hit, count(DISTINCT page_index) FILTER (page_index % 2 = 0) AS hit_even FROM b WHERE w <= 25 AND norm <> '' GROUP BY ALL)
SELECT doc_id, norm, hit, hit_even, round(hit / np, 6) AS coverage, round(hit_even / ne, 6) AS coverage_even FROM h JOIN p USING (doc_id) WHERE hit > 1
"""


def chrome_phrase(spark, sf_dir):
    b = _links(spark, sf_dir)
    b = b.withColumn("text", F.when(F.col("block_index") % 4 == 0, F.element_at(F.array(*map(F.lit, ("Menu", "12:30", "3", "1,204 comments", "Most read in Arts & Culture", "Sponsored by us", "• Sign In |"))), (F.col("doc_id") % 7 + 1).cast("int"))).otherwise(F.col("text")))
    return b.select("doc_id", "block_index", tx.chrome_key(F.col("text")).alias("key"), tx.is_chrome_phrase(F.col("text")).alias("chrome"))


_CHROME = f"""
WITH {LINK_BLOCKS}, b AS (SELECT doc_id, block_index, CASE WHEN block_index % 4 = 0 THEN ['Menu', '12:30', '3', '1,204 comments', 'Most read in Arts & Culture', 'Sponsored by us', '• Sign In |'][doc_id % 7 + 1] ELSE text END AS text FROM blocks)
SELECT doc_id, block_index, {chrome_key('text')} AS key, {is_phrase('text')} AS chrome FROM b
"""


def merged_chrome(spark, sf_dir):
    return _menus(spark, sf_dir).select("page_id", tx.is_merged_chrome(F.col("text")).alias("merged"))


_MERGED = f"""
WITH {_MENUS}, l AS (SELECT page_id, {lines('text')} AS ls FROM menus), h AS (SELECT page_id, len(ls) AS n, len([x FOR x IN ls IF {is_phrase('x')}]) AS k FROM l)
SELECT page_id, CASE WHEN n < 2 THEN false WHEN n = 2 THEN k = 2 ELSE k / n >= 0.4 END AS merged FROM h
"""


def packed_lines(spark, sf_dir):
    return _menus(spark, sf_dir).select("page_id", tx.is_packed(F.col("text"), F.col("height"), F.col("font")).alias("packed"))


_PACKED = f"""
WITH {_MENUS}, l AS (SELECT page_id, height, font, {lines('text')} AS ls FROM menus)
SELECT page_id, len(ls) >= 2 AND coalesce(list_sum([{wc('x')} FOR x IN ls]), 0) <= 30 AND len([x FOR x IN ls IF {wc('x')} > 4 OR regexp_matches(x, '[0-9/#]')]) = 0 AND height / nullif(len(ls) * font, 0) < 0.7 AS packed FROM l
"""


def top_strip(spark, sf_dir):
    b = layout.with_geometry(_lines(spark, sf_dir))
    return b.where((F.col("page_index") == 0) & (F.col("n_words") <= chrome.TOP_WORDS) & (F.col("y1f") <= chrome.TOP_EDGE)).select("doc_id", "block_index", "text")


_TOP = f"WITH {line_blocks()} SELECT doc_id, block_index, text FROM blocks WHERE page_index = 0 AND {wc('text')} <= 10 AND y1 / page_height <= 0.07"


def nav_row(spark, sf_dir):
    return chrome.nav_rows(layout.with_geometry(_links(spark, sf_dir))).select("doc_id", "block_index", "island", "nav")


_NAV = f"""
WITH {LINK_BLOCKS}, e AS (SELECT *, y0 / page_height AS a, y1 / page_height AS b FROM blocks WHERE {wc('text')} <= 4),
o AS (SELECT *, CASE WHEN a < max(b) OVER (PARTITION BY doc_id ORDER BY a, b, block_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM e),
i AS (SELECT *, CAST(sum(fresh) OVER (PARTITION BY doc_id ORDER BY a, b, block_index ROWS UNBOUNDED PRECEDING) AS INTEGER) AS island FROM o)
SELECT doc_id, block_index, island, count(*) OVER w >= 5 AND max(x1 / page_width) OVER w - min(x0 / page_width) OVER w >= 0.5 AND max(font) OVER w / min(font) OVER w <= 1.3 AND max(font) OVER w <= 16 AS nav
FROM i WINDOW w AS (PARTITION BY doc_id, island)
"""


def card_stack(spark, sf_dir):
    return chrome.card_stacks(layout.with_geometry(_lines(spark, sf_dir))).groupBy("doc_id", "page_index", "x0", "card").agg(F.count(F.lit(1)).alias("n"), F.max("y1").alias("bottom"))


_CARDS = f"""
WITH {line_blocks()}, c AS (SELECT *, CASE WHEN y0 / page_height - lag(y1 / page_height) OVER (PARTITION BY doc_id, page_index, x0 ORDER BY y0, block_index) <= 0.05 THEN 0 ELSE 1 END AS fresh FROM blocks),
k AS (SELECT *, CAST(sum(fresh) OVER (PARTITION BY doc_id, page_index, x0 ORDER BY y0, block_index ROWS UNBOUNDED PRECEDING) AS INTEGER) AS card FROM c)
SELECT doc_id, page_index, x0, card, count(*) AS n, max(y1) AS bottom FROM k GROUP BY ALL
"""


def card_grid(spark, sf_dir):
    """Link rows above four wide paragraphs."""
    b = _links(spark, sf_dir)
    wide = b.select("doc_id").distinct().withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(3)))).select(
        "doc_id", F.lit(0).alias("page_index"), (1000 + F.col("k")).cast("int").alias("block_index"), F.lit(600.0).alias("page_width"), F.lit(800.0).alias("page_height"),
        F.lit(60.0).alias("x0"), (400.0 + 60 * F.col("k")).alias("y0"), F.lit(560.0).alias("x1"), (440.0 + 60 * F.col("k")).alias("y1"), F.lit("wide " * 30).alias("text"), F.array(F.lit(11.0)).alias("font_sizes"),
    )
    return chrome.card_grids(layout.with_geometry(b.unionByName(wide)))


def main_column(spark, sf_dir):
    return chrome.main_columns(layout.with_geometry(_lines(spark, sf_dir)))


_MAIN = f"""
WITH {line_blocks()}, c AS (SELECT doc_id, page_index, x0, count(*) AS n, sum(length(text)) AS s, max(length(text)) >= 80 AS long, max(x1) AS x1, max(x1) FILTER (length(text) >= 80) AS x1_long FROM blocks GROUP BY ALL),
a AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_index, long ORDER BY s DESC, x0) AS k, row_number() OVER (PARTITION BY doc_id, page_index ORDER BY n = 1, x0) AS j FROM c),
m AS (SELECT doc_id, page_index, bool_or(long) AS any_long, max(x0) FILTER (long AND k = 1) AS bx, max(x1_long) FILTER (long AND k = 1) AS b1, max(s) FILTER (long AND k = 1) AS bs,
    max(x0) FILTER (NOT long AND k = 1) AS rx, max(x1) FILTER (NOT long AND k = 1) AS r1, max(s) FILTER (NOT long AND k = 1) AS rs, max(n) FILTER (NOT long AND k = 1) AS rn, max(x0) FILTER (j = 1) AS fx, max(x1) FILTER (j = 1) AS f1
    FROM a GROUP BY doc_id, page_index)
SELECT doc_id, page_index, CASE WHEN NOT any_long THEN fx WHEN rn > 1 AND rs > bs THEN rx ELSE bx END / 600 AS main_x0, CASE WHEN NOT any_long THEN f1 WHEN rn > 1 AND rs > bs THEN r1 ELSE b1 END / 600 AS main_x1 FROM m
"""
_REPEATED = f"""
WITH RECURSIVE {line_blocks(4)}, b AS (SELECT doc_id, page_index, block_index, [x0 / page_width, y0 / page_height, x1 / page_width, y1 / page_height] AS box, {repeat_key('text')} AS norm, {wc('text')} AS w, {is_stamp('text')} AS stamp FROM blocks),
p AS (SELECT doc_id, count(DISTINCT page_index) AS np, count(DISTINCT page_index) FILTER (page_index % 2 = 0) AS ne FROM b GROUP BY doc_id),
g AS (SELECT b.*, np, ne, row_number() OVER (PARTITION BY doc_id, norm ORDER BY page_index, block_index) AS k FROM b JOIN p USING (doc_id) WHERE np >= 3 AND w <= 25 AND norm <> ''),
f AS (SELECT doc_id, norm, k, 0 AS c, [{{'c': 0, 'box': box}}] AS seen FROM g WHERE k = 1 UNION ALL
    SELECT doc_id, norm, k, c, list_append(seen, {{'c': c, 'box': box}}) FROM (
        SELECT g.doc_id, g.norm, g.k, g.box, f.seen,
            coalesce(list_min([s.c FOR s IN f.seen IF list_max([abs(s.box[i] - g.box[i]) FOR i IN [1, 2, 3, 4]]) <= 0.04]), list_max([s.c FOR s IN f.seen]) + 1) AS c
        FROM f JOIN g ON g.doc_id = f.doc_id AND g.norm = f.norm AND g.k = f.k + 1)),
placed AS (SELECT g.*, c FROM g JOIN f USING (doc_id, norm, k)),
h AS (SELECT doc_id, norm, c, any_value(np) AS np, any_value(ne) AS ne, count(DISTINCT page_index) AS hit, count(DISTINCT page_index) FILTER (page_index % 2 = 0) AS he, count(DISTINCT page_index) FILTER (page_index % 2 = 1) AS ho FROM placed GROUP BY ALL),
r AS (SELECT doc_id, norm, c, CASE WHEN hit / np >= 0.6 THEN 'repeated' WHEN he >= 3 AND he / ne >= 0.6 THEN 'repeated-even' WHEN ho >= 3 AND ho / (np - ne) >= 0.6 THEN 'repeated-odd' END AS reason FROM h)
SELECT doc_id, page_index, block_index, reason, norm AS signature FROM placed JOIN r USING (doc_id, norm, c) WHERE NOT stamp AND (reason = 'repeated' OR (reason = 'repeated-even' AND page_index % 2 = 0) OR (reason = 'repeated-odd' AND page_index % 2 = 1))
UNION ALL SELECT doc_id, page_index, block_index, 'print-stamp', norm FROM b WHERE stamp
"""


def page_chrome(spark, sf_dir):
    return chrome.page_chrome(_lines(spark, sf_dir)).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def _stats(spark, sf_dir):
    return quality.page_stats(_lines(spark, sf_dir))


def page_stats(spark, sf_dir):
    rounded = ("avg_chars_per_block", "font_size_ratio", "short_block_fraction")
    return _stats(spark, sf_dir).withColumns({c: F.round(c, 6) for c in rounded})


_STATS = f"""
{line_blocks()},
k AS (SELECT *, length(text) AS n FROM blocks WHERE {strip('text')} <> ''),
body AS (SELECT doc_id, page_index, font AS body FROM k QUALIFY row_number() OVER (PARTITION BY doc_id, page_index ORDER BY n DESC, block_index) = 1),
stats AS (SELECT doc_id, page_index, count(*) AS block_count, round(avg(n), 6) AS avg_chars_per_block, CAST(sum(n) AS BIGINT) AS total_chars, round(max(font) / min(font), 6) AS font_size_ratio,
    count(*) FILTER (font >= body * 1.8 AND n <= 15) AS large_short_block_count, round(count(*) FILTER (n <= 20) / count(*), 6) AS short_block_fraction, 0::BIGINT AS garbled_text_layer_block_count,
    CAST(sum(len([w FOR w IN string_split_regex(text, '[{tx.WS}]+') IF regexp_matches(w, {q(tx.GLUED_SYMBOL)})])) AS BIGINT) AS weird_glued_symbol_word_count,
    count(*) FILTER (len([w FOR w IN string_split_regex(text, '[{tx.WS}]+') IF regexp_matches(w, {q(tx.GLUED_SYMBOL)})]) > 0) AS weird_glued_symbol_block_count
    FROM k JOIN body USING (doc_id, page_index) GROUP BY doc_id, page_index)"""


def decorative_pages(spark, sf_dir):
    return quality.verdicts(_stats(spark, sf_dir)).select("doc_id", "page_index", "decorative", "garbled", "char_garbled", "safe", "exclude")


_VERDICTS = f"""
WITH {_STATS}, v AS (SELECT *, large_short_block_count >= 2 OR (block_count >= 8 AND (avg_chars_per_block <= 20 OR short_block_fraction >= 0.65)) AS decorative, garbled_text_layer_block_count >= 2 AS garbled,
    weird_glued_symbol_word_count >= 5 AND weird_glued_symbol_block_count >= 2 AS char_garbled FROM stats)
SELECT doc_id, page_index, decorative, garbled, char_garbled, NOT garbled AND NOT char_garbled AND total_chars <= 900 AS safe, decorative AND NOT garbled AND NOT char_garbled AND total_chars <= 900 AS exclude FROM v
"""


def xycut_level1(spark, sf_dir):
    """The widest horizontal gap of each page, where the first cut goes."""
    return order.widest_gap(_lines(spark, sf_dir), "y0", "y1").select("doc_id", "page_index", F.round("cut", 6).alias("cut"))


_CUT = f"""
WITH {line_blocks()}, g AS (SELECT doc_id, page_index, y0, lag(y1) OVER (PARTITION BY doc_id, page_index ORDER BY y0) AS up FROM blocks)
SELECT doc_id, page_index, round(arg_max((up + y0) / 2, (y0 - up) * 10000 - y0) FILTER (y0 > up), 6) AS cut FROM g GROUP BY doc_id, page_index
"""


def reading_order(spark, sf_dir):
    b = _links(spark, sf_dir)
    b = b.withColumn("block_index", F.col("block_index") * 7 % 61)  # the table's order says nothing
    return order.reading_order(b).join(b, ["doc_id", "page_index", "block_index"]).select("doc_id", "pos", "x0", "y0")


_ORDER = f"WITH {LINK_BLOCKS} SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY floor(y0 / 40), x0) - 1 AS INTEGER) AS pos, x0, y0 FROM blocks WHERE {strip('text')} <> ''"


def reassembled_text(spark, sf_dir):
    b = _lines(spark, sf_dir)
    return order.reassemble(b, order.reading_order(b))


_REASSEMBLED = f"""
WITH {line_blocks()}, k AS (SELECT doc_id, page_index, y0, {strip('text')} AS s FROM blocks WHERE {strip('text')} <> ''),
p AS (SELECT doc_id, page_index, string_agg(s, repeat({NL}, 2) ORDER BY y0) AS t FROM k GROUP BY ALL)
SELECT doc_id, {strip(f"string_agg(t, repeat({NL}, 4) ORDER BY page_index)")} AS text FROM p GROUP BY doc_id
"""


def _names(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.concat(F.lit("doc_"), "doc_id", F.lit(".pdf")).alias("filename"))


def override_match(spark, sf_dir):
    return overrides.match_rules(_names(spark, sf_dir), overrides.rules_table(spark, _RULES)).select("doc_id", "rule_idx", "mode", "reason")


_OVERRIDE = f"""
SELECT doc_id, CAST(r AS INTEGER) AS rule_idx, ['pages', 'skip', 'heading_range', 'pages'][r + 1] AS mode, CASE r WHEN 0 THEN 'first page only' WHEN 1 THEN 'by hand' END AS reason
FROM (SELECT doc_id, {_RULE_SQL} AS r FROM (SELECT doc_id, 'doc_' || doc_id || '.pdf' AS f FROM documents))
"""


def page_filter(spark, sf_dir):
    b = _lines(spark, sf_dir)
    named = overrides.match_rules(_names(spark, sf_dir), overrides.rules_table(spark, _RULES))
    return overrides.page_filter(src.pages_of(b).join(named, "doc_id")).select("doc_id", "page_index")


_PAGE_FILTER = f"""
WITH {line_blocks()}, p AS (SELECT DISTINCT doc_id, page_index FROM blocks), r AS (SELECT doc_id, {_RULE_SQL} AS r FROM (SELECT doc_id, 'doc_' || doc_id || '.pdf' AS f FROM documents))
SELECT doc_id, page_index FROM p JOIN r USING (doc_id) WHERE r <> 0 OR page_index = 0
"""


def heading_range(spark, sf_dir):
    b = _lines(spark, sf_dir).withColumns({"start_heading": F.lit("THE "), "end_heading": F.lit(" and that")})
    return overrides.heading_range(b).select("doc_id", "page_index", "block_index")


_HEADING = f"""
WITH {line_blocks()}, n AS (SELECT *, page_index * 12 + block_index AS p FROM blocks), s AS (SELECT doc_id, min(p) AS s FROM n WHERE contains(lower(text), 'the ') GROUP BY doc_id),
e AS (SELECT doc_id, min(p) AS e FROM n JOIN s USING (doc_id) WHERE p >= s AND contains(lower(text), ' and that') GROUP BY doc_id)
SELECT doc_id, page_index, block_index FROM n JOIN s USING (doc_id) LEFT JOIN e USING (doc_id) WHERE p >= s AND (e IS NULL OR p < e)
"""


def _extracted(spark, sf_dir):
    b = _lines(spark, sf_dir).withColumn("text", F.coalesce("text", F.lit("")))
    return extraction.extract(_names(spark, sf_dir), src.pages_of(b), b, overrides.rules_table(spark, _RULES[:3]))


def extract_pipeline(spark, sf_dir):
    return _extracted(spark, sf_dir).drop("excluded_text")


def report_rows(spark, sf_dir):
    return quality.report(_extracted(spark, sf_dir))


def batch_summary(spark, sf_dir):
    return quality.batch_summary(_extracted(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        norm_dedup, print_stamp, repeat_removal, coverage, chrome_phrase, merged_chrome, packed_lines, top_strip, nav_row, card_stack, card_grid, main_column, page_chrome, page_stats, decorative_pages, xycut_level1,
        reading_order, reassembled_text, override_match, page_filter, heading_range, extract_pipeline, report_rows, batch_summary,
    )
}
_STAMPED = f"(SELECT doc_id, page_index, block_index, CASE WHEN doc_id % 2 = 0 AND block_index = 0 THEN '2024-03-0' || (doc_id % 9 + 1) || ', 9:41 PM ' || text WHEN doc_id % 2 = 0 AND block_index = 1 THEN 'page ' || (page_index + 1) || ' of 9' || {NL} || text ELSE text END AS text FROM blocks)"
ORACLES = {
    "norm_dedup": f"WITH {line_blocks()} SELECT {repeat_key('text')} AS norm, count(*) AS n, count(DISTINCT doc_id) AS docs FROM blocks GROUP BY 1",
    "print_stamp": f"WITH {line_blocks()} SELECT doc_id, page_index, block_index FROM {_STAMPED} WHERE {is_stamp('text')}",
    "coverage": _COVERAGE,
    "main_column": _MAIN,
    "repeat_removal": _REPEATED,
    "chrome_phrase": _CHROME,
    "merged_chrome": _MERGED,
    "packed_lines": _PACKED,
    "top_strip": _TOP,
    "nav_row": _NAV,
    "card_stack": _CARDS,
    "page_stats": f"WITH {_STATS} SELECT * FROM stats",
    "decorative_pages": _VERDICTS,
    "xycut_level1": _CUT,
    "reading_order": _ORDER,
    "reassembled_text": _REASSEMBLED,
    "override_match": _OVERRIDE,
    "page_filter": _PAGE_FILTER,
    "heading_range": _HEADING,
}
