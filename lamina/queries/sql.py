"""Pieces of DuckDB SQL that the oracles share."""

from __future__ import annotations

from lamina.functions import text as tx

NL = "chr(10)"


def q(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def words(x: str) -> str:
    return f"[w FOR w IN string_split_regex({x}, {q(f'[{tx.WS}]+')}) IF w <> '']"


def wc(x: str) -> str:
    return f"len({words(x)})"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q(f'^[{tx.WS}]+|[{tx.WS}]+$')}, '', 'g')"


def lines(x: str) -> str:
    return f"[z FOR z IN [{strip('y')} FOR y IN string_split({x}, {NL})] IF z <> '']"


def collapse(x: str) -> str:
    return f"array_to_string({words(x)}, ' ')"


def repeat_key(x: str) -> str:
    return rf"regexp_replace(lower({collapse(x)}), '\p{{Nd}}+', '#', 'g')"


def chrome_key(x: str) -> str:
    return f"trim(lower({collapse(x)}), {q(tx.EDGE_MARKS)})"


def is_phrase(x: str) -> str:
    k = chrome_key(x)
    listed = ", ".join(q(p) for p in tx.CHROME_PHRASES)
    return (
        f"({k} <> '' AND ({k} IN ({listed}) OR " + " OR ".join(f"regexp_matches({k}, {q(p)})" for p in (tx.DURATION_OR_RANK, tx.COMMENT_COUNT, tx.POPULAR_WIDGET, tx.PAID_OR_SIGN_UP)) + f" OR (starts_with({k}, 'estimated') AND contains({k}, 'min'))))"
    )


def is_stamp(x: str) -> str:
    first = strip(f"string_split({x}, {NL})[1]")
    return f"(regexp_matches({first}, {q(tx.PRINT_HEADER)}) OR regexp_matches({first}, {q(tx.PRINT_FOOTER)}))"


def line_blocks(n: int = 12) -> str:
    return f"""
raw AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), {NL})) AS text, generate_subscripts(string_split(coalesce(text, ''), {NL}), 1) - 1 AS k FROM documents),
blocks AS (SELECT doc_id, CAST(k // {n} AS INTEGER) AS page_index, CAST(k % {n} AS INTEGER) AS block_index, 600.0::DOUBLE AS page_width, 800.0::DOUBLE AS page_height,
    (CASE WHEN length(text) % 5 = 0 THEN 380 ELSE 60 END)::DOUBLE AS x0, (40 + 60 * (k % {n}))::DOUBLE AS y0,
    least((CASE WHEN length(text) % 5 = 0 THEN 380 ELSE 60 END) + least(length(text) * 5, 480), 600)::DOUBLE AS x1,
    (40 + 60 * (k % {n}) + 12 + 12 * (length(text) % 3))::DOUBLE AS y1, text, (10 + length(text) % 3)::DOUBLE AS font FROM raw)"""


LINK_BLOCKS = r"""
raw AS (SELECT page_id AS doc_id, unnest(regexp_extract_all(html, '<li><a[^>]*>([^<]*)</a>', 1)) AS text, generate_subscripts(regexp_extract_all(html, '<li><a[^>]*>([^<]*)</a>', 1), 1) - 1 AS k FROM pages),
blocks AS (SELECT doc_id, 0 AS page_index, CAST(k AS INTEGER) AS block_index, 600.0::DOUBLE AS page_width, 800.0::DOUBLE AS page_height, (10 + 98 * (k % 6))::DOUBLE AS x0,
    (40 + 40 * (k // 6) + 4 * (k % 2))::DOUBLE AS y0, (70 + 98 * (k % 6))::DOUBLE AS x1, (52 + 40 * (k // 6) + 4 * (k % 2))::DOUBLE AS y1, text, (10 + length(text) % 2)::DOUBLE AS font FROM raw)"""
