"""Repair of extraction artifacts, one projection per step.

Order: ligatures, icon glyphs, markup, links, addresses, divider lines, then
the cosmetic steps.  Each step is a column expression; ``clean`` chains those
that are switched on and counts what each removed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.functions.text import WS

#: code point -> letters; the last two are forms of "st".
LIGATURES = dict(zip(range(0xFB00, 0xFB07), ("ff", "fi", "fl", "ffi", "ffl", "st", "st")))
LIGATURE = r"[\x{FB00}-\x{FB06}]"
ICON = r"[\x{2600}-\x{27BF}\x{E000}-\x{F8FF}\x{1F000}-\x{1FFFF}\x{F0000}-\x{FFFFD}]"
TAG = rf"<[{WS}]*/?[A-Za-z][0-9A-Za-z]*(?:[{WS}][^<>]{{0,200}})?>"
LINK = rf"(?i)(?:www\.|https?://)(?:-\n|[^{WS}])+"
TRAIL = r"[.,;:!?'\")\]}”’]"
ADDRESS = r"[0-9a-zA-Z%+._-]+@[0-9a-zA-Z.-]+\.[a-zA-Z]{2,}"
DIVIDER = rf"^[{WS}\-\x{{2010}}-\x{{2015}}_=]{{5,}}$"
EMPTY_PAIR = rf"[(\[][{WS}]*[)\]]"
#: A label that announced a link, at the end of a line.  ``d`` (Java) makes $ match at \n only.
LABEL = r"[;,]?[\t ]*\b(?:website|instagram|linkedin|twitter|facebook|e-?mail)[{ws}]*:[ \t]*$|\bwebsite[{ws}]+at[ \t]*$".replace("{ws}", WS)
RESIDUE = " .,;:()[]“”‘’•●◦-"


@dataclass(frozen=True)
class Switches:
    urls: bool = True
    emails: bool = True
    separators: bool = True
    ligatures: bool = True
    icons: bool = True
    tags: bool = True


COUNTS = tuple("urls_removed emails_removed separator_lines_removed ligatures_normalized icon_glyphs_removed html_tags_removed".split())


def count(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern)).cast("long")


def fold_ligatures(c: Column) -> Column:
    for point, letters in LIGATURES.items():
        c = F.replace(c, F.lit(chr(point)), F.lit(letters))
    return c


def strip_icons(c: Column) -> Column:
    return F.regexp_replace(c, ICON, "")


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, TAG, "")


def strip_links(c: Column) -> Column:
    """Links go, the closing punctuation glued to them stays."""
    marked = F.regexp_replace(c, f"({LINK})", "\x01$1\x02")
    return F.regexp_replace(marked, f"\x01[^\x02]*?({TRAIL}*)\x02", "$1")


def strip_addresses(c: Column) -> Column:
    return F.when(c.contains("@"), F.regexp_replace(c, ADDRESS, "")).otherwise(c)


def drop_dividers(c: Column) -> Column:
    return F.array_join(F.filter(F.split(c, "\n"), lambda x: ~x.rlike(DIVIDER)), "\n")


def drop_labels(c: Column) -> Column:
    return F.regexp_replace(c, f"(?imd){LABEL}", "")


def tidy_spaces(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, " {2,}", " "), " +([.,;:])", "$1")


def drop_residue(c: Column) -> Column:
    return F.array_join(F.filter(F.split(c, "\n"), lambda x: F.btrim(x, F.lit(RESIDUE)) != ""), "\n")


def clean(df: DataFrame, text: str = "text", to: str = "clean_text", on: Switches = Switches()) -> DataFrame:
    """df with ``to`` and the six counts.  A null text counts as empty."""
    t = "__t"
    df = df.withColumn(t, F.coalesce(F.col(text), F.lit("")))
    zero = F.lit(0).cast("long")
    for name, wanted, pattern, step in (
        ("ligatures_normalized", on.ligatures, LIGATURE, fold_ligatures),
        ("icon_glyphs_removed", on.icons, ICON, strip_icons),
        ("html_tags_removed", on.tags, TAG, strip_tags),
        ("urls_removed", on.urls, LINK, strip_links),
        ("emails_removed", on.emails, ADDRESS, strip_addresses),
    ):
        counted = F.when(F.col(t).contains("@"), count(F.col(t), pattern)).otherwise(zero) if name == "emails_removed" else count(F.col(t), pattern)
        df = df.select(*[c for c in df.columns if c != t], (counted if wanted else zero).alias(name), (step(F.col(t)) if wanted else F.col(t)).alias(t))
    if on.separators:
        fewer = drop_dividers(F.col(t))
        gone = F.size(F.filter(F.split(F.col(t), "\n"), lambda x: x.rlike(DIVIDER))).cast("long")
        df = df.select(*[c for c in df.columns if c != t], gone.alias("separator_lines_removed"), fewer.alias(t))
    else:
        df = df.withColumn("separator_lines_removed", zero)
    if on.urls or on.emails or on.icons or on.tags:
        df = df.withColumn(t, F.regexp_replace(t, EMPTY_PAIR, ""))
        df = df.withColumn(t, F.when(F.col("urls_removed") + F.col("emails_removed") > 0, drop_labels(F.col(t))).otherwise(F.col(t)))
        df = df.withColumn(t, drop_residue(tidy_spaces(F.col(t))))
    return df.withColumnRenamed(t, to)
