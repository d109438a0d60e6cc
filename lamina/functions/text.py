"""Text predicates as column expressions.

Patterns spell Unicode classes out, so that Java's and RE2's engines read them
alike; ``WS`` is what Python's ``str.split()`` takes for white space.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column
from pyspark.sql import functions as F

WS = r"\t-\r\x1c-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
#: The same without the blank.
ODD_WS = WS.replace(r"\x1c-\x20", r"\x1c-\x1f")
WORDCHAR = r"\p{L}\p{N}_"

#: Lone phrases of site furniture, after normalisation.
CHROME_PHRASES = tuple(
    sorted(
        "accept cookies|advertisement|back to top|comments|cookie policy|copy link|email|estimated|facebook|instagram|keep watching|linkedin|listen to this article|log in|manage preferences|menu|most popular|most read|my account|popular now|print|"
        "read more|recommended for you|recommended videos|related|related articles|related bulletins|related stories|search|share|share this article|sign in|sign up|skip navigation|skip to main content|sponsored|sponsored content|"
        "story continues below|subscribe|top stories|trending|trending now|trending videos|twitter|up next|video|view all|you might also like".split("|")
    )
)
DURATION_OR_RANK = r"^\p{Nd}{1,2}(?::\p{Nd}{2})?$"
COMMENT_COUNT = rf"^[\p{{Nd}},]+[{WS}]+comments?$"
POPULAR_WIDGET = rf"^(?:(?:popular|trending) now|trending|most (?:popular|read)|recommended(?: for you)?)(?:[{WS}]+(?:in|on)[{WS}]+[{WORDCHAR}][{WORDCHAR}{WS}&]*)?$"
PAID_OR_SIGN_UP = rf"^(?:(?:sponsored|promoted)[{WS}]+by(?:$|[^{WORDCHAR}])|subscribe[{WS}]*\$|sign up now(?:$|[^{WORDCHAR}]))"
PRINT_HEADER = rf"(?i)^\p{{Nd}}{{4}}-\p{{Nd}}{{2}}-\p{{Nd}}{{2}},[{WS}]*\p{{Nd}}{{1,2}}:\p{{Nd}}{{2}}[{WS}]*(?:AM|PM)(?:$|[^{WORDCHAR}])"
PRINT_FOOTER = rf"(?i)^Page[{WS}]+\p{{Nd}}+[{WS}]+of[{WS}]+\p{{Nd}}+(?:$|[^{WORDCHAR}])"
GLUED_SYMBOL = r"[a-zA-Z][`|^~\\][a-zA-Z]"
EDGE_MARKS = " •-|:"

SHORT_BLOCK_WORDS, MERGED_MAX_WORDS, MERGED_MIN_SHARE = 6, 20, 0.4
PACKED_MAX_LINE_WORDS, PACKED_MAX_WORDS, PACKED_MAX_RATIO = 4, 30, 0.7
GARBLED_MIN_LINES, GARBLED_MAX_LINE, GARBLED_MAX_FONT = 3, 6, 13.0


def words(c: Column) -> Column:
    return F.filter(F.split(c, f"[{WS}]+"), lambda w: w != "")


def word_count(c: Column) -> Column:
    """Blanks of the collapsed text and one; regexp_count would make a list of all words first."""
    blanks = lambda k: F.when(k == "", 0).otherwise(F.length(k) - F.length(F.replace(k, F.lit(" "))) + 1)
    return F.when(c.isNotNull(), F.get(F.transform(F.array(collapse(c)), blanks), F.lit(0)))  # so that the text is collapsed once


def has_text(c: Column) -> Column:
    """Whether anything but white space is there."""
    return c.rlike(f"[^{WS}]")


def strip(c: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(c, f"^[{WS}]+|[{WS}]+$", "")


def collapse(c: Column) -> Column:
    # lone blanks are right already, so only other white space is replaced
    return F.btrim(F.regexp_replace(c, f" ?(?:[{ODD_WS}]|  )[{WS}]*", " "), F.lit(" "))


def repeat_key(c: Column) -> Column:
    """What repeated furniture has in common: case, spacing and digits aside."""
    return F.regexp_replace(F.lower(collapse(c)), r"\p{Nd}+", "#")


def chrome_key(c: Column) -> Column:
    return F.btrim(F.lower(collapse(c)), F.lit(EDGE_MARKS))


def lines(c: Column) -> Column:
    """Stripped lines that aren't blank."""
    return F.filter(F.transform(F.split(c, "\n"), strip), lambda x: x != "")


def is_chrome_phrase(c: Column) -> Column:
    k = chrome_key(c)
    return (k != "") & (
        k.isin(*CHROME_PHRASES)
        | k.rlike(DURATION_OR_RANK)
        | k.rlike(COMMENT_COUNT)
        | k.rlike(POPULAR_WIDGET)
        | k.rlike(PAID_OR_SIGN_UP)
        | (k.startswith("estimated") & k.contains("min"))
    )


def is_widget_header(c: Column) -> Column:
    able = functools.reduce(operator.or_, [F.lower(c).contains(w) for w in ("popular", "trending", "most", "recommended")])
    return F.when(able, chrome_key(c).rlike(POPULAR_WIDGET)).otherwise(F.when(c.isNotNull(), False))


def is_merged_chrome(c: Column) -> Column:
    """Several phrases in one block: both of two lines, or two fifths of more."""
    ls = lines(c)
    hits = F.size(F.filter(ls, is_chrome_phrase))
    n = F.size(ls)
    return F.when(~c.contains("\n"), False).otherwise(F.when(n < 2, False).when(n == 2, hits == 2).otherwise(hits / n >= MERGED_MIN_SHARE))


def is_packed(c: Column, height: Column, font: Column) -> Column:
    """Short lines that share less height than they would need one below another."""
    ls = lines(c)
    packed = (
        (F.size(ls) >= 2)
        & (F.aggregate(ls, F.lit(0), lambda a, x: a + word_count(x)) <= PACKED_MAX_WORDS)
        & F.forall(ls, lambda x: (word_count(x) <= PACKED_MAX_LINE_WORDS) & ~x.rlike("[0-9/#]"))
        & (font > 0)
        & (height / F.nullif(F.size(ls) * font, F.lit(0.0)) < PACKED_MAX_RATIO)
    )
    return F.when(~c.contains("\n"), False).otherwise(packed)


def is_garbled(c: Column, font: Column) -> Column:
    """Three lines or more that hold a few characters each, in body size."""
    ls = lines(c)
    total = F.aggregate(ls, F.lit(0), lambda a, x: a + F.length(x))
    return F.when(~c.contains("\n"), False).otherwise((F.size(ls) >= GARBLED_MIN_LINES) & (total <= GARBLED_MAX_LINE * F.size(ls)) & (F.coalesce(font, F.lit(0.0)) <= GARBLED_MAX_FONT))


def is_print_stamp(c: Column) -> Column:
    first = F.substring_index(c, "\n", 1)
    return first.rlike(PRINT_HEADER.replace("^", f"^[{WS}]*", 1)) | first.rlike(PRINT_FOOTER.replace("^", f"^[{WS}]*", 1))


def glued_words(c: Column) -> Column:
    return F.when(~c.rlike(GLUED_SYMBOL), 0).otherwise(F.size(F.filter(words(c), lambda w: w.rlike(GLUED_SYMBOL))))  # few texts have any


def mean_font(sizes: Column) -> Column:
    n = F.size(sizes)
    return F.when(n > 0, F.aggregate(sizes, F.lit(0.0), lambda a, x: a + x.cast("double")) / n).otherwise(0.0)


def glob_to_regex(glob: str) -> str:
    """Shell pattern (``* ? [seq] [!seq]``) to a regular expression that matches whole names."""
    import re

    out, i = "", 0
    while i < len(glob):
        c = glob[i]
        if c == "*":
            out += ".*"
        elif c == "?":
            out += "."
        elif c == "[" and "]" in glob[i + 2 :]:
            j = glob.index("]", i + 2)
            body = glob[i + 1 : j].replace("\\", "\\\\")
            out += f"[{'^' + body[1:] if body[0] == '!' else body}]"
            i = j
        else:
            out += re.escape(c)
        i += 1
    return f"(?s)^{out}$"
