"""Artifact repair over web pages with a fixed set of artifacts appended."""

from __future__ import annotations

from pyspark.sql import functions as F

from lamina.functions import artifacts as af
from lamina.queries.sql import NL, q

_EXTRA = {
    0: "\nThe oﬃce ﬁles ★ are 🀄 here.\n-----\nWebsite: https://a.example.org/x-\ny?z=1).\nFacebook: www.example.org/me",
    1: "\nwrite to me@site.example.org, or see www.example.net. [ ] ( )\n_____\n• \nx < 5 stays <b >bold</b>\ne-mail: you@example.org  ",
    2: "\nnothing here  at all ;\n     \n— — —\nwebsite at ",
}


def _source(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html")
    tail = F.lit("")
    for k, v in _EXTRA.items():
        tail = F.when(F.col("page_id") % 5 == k, F.lit(v)).otherwise(tail)
    return pages.select("page_id", F.concat(F.coalesce("html", F.lit("")), tail).alias("text"))


_SQL = f"SELECT page_id, coalesce(html, '') || CASE page_id % 5 {' '.join(f'WHEN {k} THEN {q(v)}' for k, v in _EXTRA.items())} ELSE '' END AS t FROM pages"


def _count(p):
    return f"len(regexp_extract_all(t, {q(p)}))"


def _links(t):
    return f"regexp_replace(regexp_replace({t}, {q(f'({af.LINK})')}, chr(1) || '\\1' || chr(2), 'g'), {q(chr(1) + '[^' + chr(2) + ']*?(' + af.TRAIL + '*)' + chr(2))}, '\\1', 'g')"


def _folded(t):
    for point, letters in af.LIGATURES.items():
        t = f"replace({t}, chr({point}), '{letters}')"
    return t


def _drop(t, p):
    return f"regexp_replace({t}, {q(p)}, '', 'g')"


def _dividers(t):
    return f"array_to_string([l FOR l IN string_split({t}, {NL}) IF NOT regexp_matches(l, {q(af.DIVIDER)})], {NL})"


def _residue(t):
    return f"array_to_string([l FOR l IN string_split({t}, {NL}) IF trim(l, {q(af.RESIDUE)}) <> ''], {NL})"


def _spaces(t):
    return f"regexp_replace(regexp_replace({t}, ' {{2,}}', ' ', 'g'), ' +([.,;:])', '\\1', 'g')"


_CHAIN = f"""
WITH s0 AS ({_SQL}),
s1 AS (SELECT page_id, {_count(af.LIGATURE)} AS ligatures_normalized, {_folded('t')} AS t FROM s0),
s2 AS (SELECT *, {_count(af.ICON)} AS icon_glyphs_removed, {_drop('t', af.ICON)} AS u FROM s1),
s3 AS (SELECT * EXCLUDE (t, u), u AS t FROM s2),
s4 AS (SELECT * EXCLUDE (t), {_count(af.TAG)} AS html_tags_removed, {_drop('t', af.TAG)} AS t FROM s3),
s5 AS (SELECT * EXCLUDE (t), {_count(af.LINK)} AS urls_removed, {_links('t')} AS t FROM s4),
s6 AS (SELECT * EXCLUDE (t), {_count(af.ADDRESS)} AS emails_removed, {_drop('t', af.ADDRESS)} AS t FROM s5),
s7 AS (SELECT * EXCLUDE (t), len([l FOR l IN string_split(t, {NL}) IF regexp_matches(l, {q(af.DIVIDER)})]) AS separator_lines_removed, {_dividers('t')} AS t FROM s6),
s8 AS (SELECT * EXCLUDE (t), {_drop('t', af.EMPTY_PAIR)} AS t FROM s7),
s9 AS (SELECT * EXCLUDE (t), CASE WHEN urls_removed + emails_removed > 0 THEN {_drop('t', '(?im)' + af.LABEL)} ELSE t END AS t FROM s8),
s10 AS (SELECT * EXCLUDE (t), {_residue(_spaces('t'))} AS clean_text FROM s9)
"""


def artifact_clean_text(spark, sf_dir):
    return af.clean(_source(spark, sf_dir)).select("page_id", "clean_text", *af.COUNTS)


def artifact_counts(spark, sf_dir):
    counts = af.clean(_source(spark, sf_dir))
    return counts.agg(*[F.sum(c).alias(c) for c in af.COUNTS], F.sum(F.length("clean_text").cast("long")).alias("clean_chars"))


def _single(step):
    def run(spark, sf_dir):
        return _source(spark, sf_dir).select("page_id", step(F.col("text")).alias("t"))

    return run


_STEPS = {
    "ligature_fold": (af.fold_ligatures, _folded("t")),
    "icon_strip": (af.strip_icons, _drop("t", af.ICON)),
    "html_strip": (af.strip_tags, _drop("t", af.TAG)),
    "url_strip": (af.strip_links, _links("t")),
    "email_strip": (af.strip_addresses, _drop("t", af.ADDRESS)),
    "separator_drop": (af.drop_dividers, _dividers("t")),
    "bracket_drop": (lambda c: F.regexp_replace(c, af.EMPTY_PAIR, ""), _drop("t", af.EMPTY_PAIR)),
    "introducer_drop": (af.drop_labels, _drop("t", "(?im)" + af.LABEL)),
    "spacing_tidy": (af.tidy_spaces, _spaces("t")),
    "residue_drop": (af.drop_residue, _residue("t")),
}


def artifact_toggles(spark, sf_dir):
    """Links and addresses switched off: only markup, glyphs and dividers go."""
    out = af.clean(_source(spark, sf_dir), on=af.Switches(urls=False, emails=False))
    return out.select("page_id", "clean_text", "urls_removed", "html_tags_removed")


_TOGGLED = f"""
WITH s0 AS ({_SQL}), s1 AS (SELECT page_id, {_drop(_folded('t'), af.ICON)} AS t FROM s0),
s2 AS (SELECT page_id, {_count(af.TAG)} AS html_tags_removed, {_dividers(_drop('t', af.TAG))} AS t FROM s1)
SELECT page_id, 0 AS urls_removed, html_tags_removed, {_residue(_spaces(_drop('t', af.EMPTY_PAIR)))} AS clean_text FROM s2
"""

QUERIES = {"artifact_clean_text": artifact_clean_text, "artifact_counts": artifact_counts, "artifact_toggles": artifact_toggles, **{k: _single(s) for k, (s, _) in _STEPS.items()}}
ORACLES = {
    "artifact_clean_text": f"{_CHAIN} SELECT page_id, clean_text, {', '.join(af.COUNTS)} FROM s10",
    "artifact_counts": f"{_CHAIN} SELECT {', '.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in af.COUNTS)}, CAST(sum(length(clean_text)) AS BIGINT) AS clean_chars FROM s10",
    "artifact_toggles": _TOGGLED,
    **{k: f"SELECT page_id, {s} AS t FROM ({_SQL})" for k, (_, s) in _STEPS.items()},
}
