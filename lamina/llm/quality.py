"""Line-first quality cleaning.

Every line of a text is judged by itself.  A line fails if it is

* *boilerplate*: one of a few fixed notices (rights, cookies, subscriptions,
  licence lines);
* *navigation*: separators such as ``|`` make up at least a sixth of its words;
* *symbols*: the characters ``#*$%&|<>`` number at least half its words, with
  two words or more;
* *shouting*: capitals are at least 70 % of its letters, and it has four
  shouted words (or a doubled exclamation mark);
* *punctuation*: it has eight words or more, and none of its last eight ends a
  sentence or clause (``.!?…:;``, before closing quotes or brackets or not);
* *repeated*: it equals an earlier line of the text.

Failing lines are removed.  A document is rejected if it fails the base tests
(fewer than 50 words, or over half of its words in repeated three-word windows)
or if removing lines costs it more than ``loss`` percent of its words.

Rows: null and empty texts have no words and fail.  Ties do not arise (no
ordering is involved), rows that repeat are judged alike, an empty table gives
no rows, texts of any length are read whole, and other columns, whatever their
names, stay (``keep_good``) or are ignored (``judge``).
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from lamina.session import spread

MIN_WORDS, MAX_REPEAT, LOSS = 50, 50, 40  # the last two in percent of the words
_SYMBOLS = "#*$%&|<>"
_SEPARATORS = {"|", "||", "/", "»", "«", "›", "‹", "·", "•", "::", ">", "<", ">>", "<<"}
#: Understood alike by Python and DuckDB.
_NOTICE = (
    r"(?i)^[ \t.,;:!*#|()-]*(all rights reserved|copyright .{0,80}|©.{0,80}|(licensed|released|this work is licensed) under .{0,80}|(accept|we use) .{0,20}cookies.{0,160}"
    r"|(click here|subscribe now|sign up|sign in|log in|read more|share this|skip to content|back to top|terms of use|terms of service|privacy policy)( .{0,80})?)[ \t.,;:!*#|()-]*$"
)
_BOILERPLATE, _WORDS = re.compile(_NOTICE), re.compile("[^ \t-\r]+")
_CAPITALS, _SMALL = re.compile("[A-ZÀ-ÖØ-Þ]"), re.compile("[a-zß-öø-ÿ]")
#: A word that ends a sentence or clause, and the words at a line's end of which one has to.
_ENDS, TAIL = re.compile(r"[.!?…:;][\"')\]»”’]*$"), 8
_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def line_fault(line: str) -> str | None:
    """The rule that the line breaks; None if it may stay."""
    words = _WORDS.findall(line)
    if not words:
        return None
    if _BOILERPLATE.search(line):
        return "boilerplate"
    if 6 * sum(w in _SEPARATORS for w in words) >= len(words) and len(words) > 1:
        return "navigation"
    if len(words) >= 2 and 2 * sum(map(line.count, _SYMBOLS)) >= len(words):
        return "symbols"
    capitals = len(_CAPITALS.findall(line))
    if capitals >= 4:
        small = len(_SMALL.findall(line))
        if 10 * capitals >= 7 * (capitals + small) and ("!!" in line or sum(len(w) > 1 and w.upper() == w and w.lower() != w for w in words) >= 4):
            return "shouting"
    if len(words) >= TAIL and not any(map(_ENDS.search, words[-TAIL:])):
        return "punctuation"
    return None


def repeated_words(words: list, size: int = 3) -> int:
    """Words that lie in a window of ``size`` words found twice or more."""
    windows = list(zip(*(words[i:] for i in range(size))))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    total, upto = 0, 0  # words before upto are counted
    for i, w in enumerate(windows):
        if times[w] > 1:
            total += i + size - max(i, upto)
            upto = i + size
    return total


def measure(text: str | None, loss: int = LOSS, least: int = MIN_WORDS) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, cleaned)."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()  # bytes split at ASCII white space only
    n = len(words)
    chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    symbols = sum(map(text.count, _SYMBOLS))
    repeats = repeated_words(words)
    seen, dups, lost, lines, faults = set(), 0, 0, [], {}
    for line in text.split("\n"):
        size = len(line.encode("utf-8", "surrogatepass").split())
        if size:
            if line in seen:
                dups += 1
                lost += size
                continue
            seen.add(line)
            if line_fault(line):
                lost += size
                continue
        lines.append(line)
    failed = n < least or 100 * repeats > MAX_REPEAT * n
    return n, chars, symbols, dups, repeats, failed, not failed and 100 * lost <= loss * n, "\n".join(lines)


def judge(docs: DataFrame, loss: int = LOSS, with_text: bool = False) -> DataFrame:
    """(doc_id, five measures, base_failed, kept[, cleaned]) of every document."""
    fields = [("doc_id", pa.int64()), *((c, pa.int64()) for c in _COLUMNS), ("base_failed", pa.bool_()), ("kept", pa.bool_())] + [("cleaned", pa.string())] * with_text
    schema = pa.schema(fields)

    def of(batches):
        for batch in batches:
            rows = []
            for t in batch.column(1):
                rows.append(measure(t.as_py(), loss)[: len(fields) - 1])
            columns = list(zip(*rows)) or [()] * (len(fields) - 1)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *(pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:]))], schema=schema)

    ddl = "doc_id long, " + ", ".join(f"{c} long" for c in _COLUMNS) + ", base_failed boolean, kept boolean" + ", cleaned string" * with_text
    return docs.select("doc_id", "text").mapInArrow(of, ddl)


def keep_good(docs: DataFrame, loss: int = LOSS, least: int = MIN_WORDS) -> DataFrame:
    """The rows of docs whose text is kept, with failing lines gone; all columns
    stay.  Texts of fewer than ``least`` words, and those left without any, go.

    ``n_chars``, if there, follows the cleaned text.
    """
    schema = docs.schema
    names = [f.name for f in schema]

    def of(batches):
        for batch in batches:
            judged = [measure(t, loss, least)[-2:] for t in batch.column(names.index("text")).to_pylist()]
            stays = [k and bool(_WORDS.search(c)) for k, c in judged]
            mask = pa.array(stays, pa.bool_())
            texts = [c for k, (_, c) in zip(stays, judged) if k]
            out = batch.filter(mask)
            out = out.set_column(names.index("text"), out.schema.field("text"), pa.array(texts, out.schema.field("text").type))
            if "n_chars" in names:
                i = names.index("n_chars")
                out = out.set_column(i, out.schema.field(i), pa.array(list(map(len, texts)), out.schema.field(i).type))
            yield out

    return docs.mapInArrow(of, schema)


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    return judge(spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))


#: The same in SQL.  DuckDB's regular expressions have no look-around, and need none here.
ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, [x FOR x IN string_split_regex(text, '[ \t-\r]+') IF x <> ''] AS ws FROM d),
m AS (SELECT doc_id, text, ws, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[ \t-\r]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols FROM w),
g AS (SELECT doc_id, unnest(range(1, greatest(len(ws) - 1, 1))) AS i, ws FROM m),
g3 AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS s FROM g),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM g3) WHERE c > 1),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM d),
lw AS (SELECT *, [x FOR x IN string_split_regex(line, '[ \t-\r]+') IF x <> ''] AS lws FROM l),
lm AS (SELECT doc_id, line, k, lws, len(lws) AS size, row_number() OVER (PARTITION BY doc_id, line ORDER BY k) > 1 AS dup,
    len(regexp_extract_all(line, '[A-ZÀ-ÖØ-Þ]')) AS up, len(regexp_extract_all(line, '[a-zß-öø-ÿ]')) AS low FROM lw WHERE len(lws) > 0),
lf AS (SELECT doc_id, size, dup, dup
    OR regexp_matches(line, '__NOTICE__')
    OR (size > 1 AND 6 * len([x FOR x IN lws IF x IN ('|', '||', '/', '»', '«', '›', '‹', '·', '•', '::', '>', '<', '>>', '<<')]) >= size)
    OR (size >= 2 AND 2 * (length(line) - length(regexp_replace(line, '[#*$%&|<>]', '', 'g'))) >= size)
    OR (up >= 4 AND 10 * up >= 7 * (up + low) AND (contains(line, '!!') OR len([x FOR x IN lws IF length(x) > 1 AND upper(x) = x AND lower(x) <> x]) >= 4))
    OR (size >= 8 AND len([x FOR x IN lws[-8:] IF regexp_matches(x, '[.!?…:;]["'')\]»”’]*$')]) = 0) AS bad FROM lm),
ls AS (SELECT doc_id, CAST(count(*) FILTER (dup) AS BIGINT) AS dups, coalesce(sum(size) FILTER (bad), 0) AS lost FROM lf GROUP BY doc_id)
SELECT m.doc_id, n_words, word_chars, n_symbols, coalesce(dups, 0) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
    n_words < 50 OR 100 * coalesce(r.n, 0) > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * coalesce(r.n, 0) > 50 * n_words) AND 100 * coalesce(lost, 0) <= 40 * n_words AS kept
FROM m LEFT JOIN r USING (doc_id) LEFT JOIN ls USING (doc_id)
""".replace("__NOTICE__", _NOTICE)
