"""Main text of web pages from flat text blocks and a decision tree.

A page is read once, left to right, into blocks: runs of text between
block-level tags, with their words, link density, and what the enclosing
elements say by tag, role, class and id.  A decision tree looks at a block's
own figures, those of the neighbours before and after, its size beside the
page's, and those hints, and says whether the block belongs to the article.
The tree is fitted on the driver to ``TRAIN_PAGES`` generated pages whose
blocks are labelled.  Where it takes nothing of a page that marks no article,
the blocks that neither hints nor links speak against are the text.

Scripts, styles, comments, markup, hidden elements and the page's head are
never text.  Character references are decoded within each text node, white
space inside a block becomes one space, kept blocks are joined by one newline.

Rows: null and empty pages give the empty text; broken markup (unclosed or
crossed tags, a page that ends inside a tag, a comment or a reference) is read
as far as it goes, in time linear in the page; media elements without an end
hide nothing; very long pages are read whole; rows that repeat give equal
results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lamina.llm.trees import fit_tree, tree_value

TRAIN_PAGES = 1500
_TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
#: Elements whose content is no markup, up to their end tag.
_RAW = {"script", "style", "title", "textarea", "iframe", "noembed", "noframes", "xmp"}
#: Elements that hide what they hold, if they have an end tag.
_UNSEEN = {"template", "svg", "math", "object", "select", "canvas", "audio", "video"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = {
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
    "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "noscript", "ol", "optgroup", "option", "p", "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
_INLINE_HINTS = {"a", "span", "button", "label"}
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Bits of what enclosing elements say.
NAV, HEADER, FOOTER, ASIDE, FORM, AD, NOTICE, COMMENT, HIDDEN, MAIN, LINK, HEADING = (1 << i for i in range(12))
_AGAINST = NAV | HEADER | FOOTER | ASIDE | FORM | AD | NOTICE | COMMENT
_BY_TAG = {
    "nav": NAV, "menu": NAV, "header": HEADER, "footer": FOOTER, "aside": ASIDE, "form": FORM, "button": FORM, "fieldset": FORM, "label": FORM, "dialog": NOTICE, "search": FORM,
    "noscript": HIDDEN, "head": HIDDEN, "article": MAIN, "main": MAIN, "a": LINK, **{f"h{i}": HEADING for i in range(1, 7)},
}
_BY_ROLE = {"navigation": NAV, "banner": HEADER, "contentinfo": FOOTER, "complementary": ASIDE, "search": FORM, "form": FORM, "dialog": NOTICE, "alert": NOTICE, "alertdialog": NOTICE, "main": MAIN, "article": MAIN}
_BY_NAME = [
    (re.compile(r"(?:^|[-_\s])(?:nav|navbar|navigation|menu|breadcrumbs?|pagination|pager|toc|tabs|skip)(?:$|[-_\s])"), NAV),
    (re.compile(r"(?:^|[-_\s])(?:header|site-?header|page-?header|masthead|topbar|top-?bar|banner|logo)(?:$|[-_\s])"), HEADER),
    (re.compile(r"(?:^|[-_\s])(?:footer|site-?footer|colophon|copyright|legal|bottom)(?:$|[-_\s])"), FOOTER),
    (re.compile(r"(?:^|[-_\s])(?:sidebar|side|aside|related|recommended|recommendations|widgets?|trending|popular|more-?stories|read-?more|also|tags?|share|social|sharing|author-?box)(?:$|[-_\s])"), ASIDE),
    (re.compile(r"(?:^|[-_\s])(?:form|login|signup|search)(?:$|[-_\s])"), FORM),
    (re.compile(r"(?:^|[-_\s])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|commercial|teaser)(?:$|[-_\s])"), AD),
    (re.compile(r"(?:^|[-_\s])(?:cookies?|cookie\w+|consent|gdpr|notices?|alerts?|popup|modal|newsletter|subscri\w+|paywall|disclaimer|toast|overlay|warning)(?:$|[-_\s])"), NOTICE),
    (re.compile(r"(?:^|[-_\s])(?:comments?|commentlist|comment-\w+|repl(?:y|ies)|disqus|discussion|responses|(?:user|customer|reader)-?reviews?)(?:$|[-_\s])"), COMMENT),
    (re.compile(r"(?:^|[-_\s])(?:hidden|sr-only|visually-hidden|d-none)(?:$|[-_\s])"), HIDDEN),
    (re.compile(r"(?:^|[-_\s])(?:article|article-?body|post|post-?body|post-?content|entry|entry-?content|main|main-?content|content|story|story-?body)(?:$|[-_\s])"), MAIN),
]
_SPLIT_NAME = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
FEATURES = (
    "words", "density", "words_before", "density_before", "words_after", "density_after", "nav", "header", "footer", "aside", "form", "ad", "notice", "comment", "main", "heading", "page_has_main", "ends_sentence",
    "size_beside_largest", "stock_phrase",
)
_STOCK = re.compile(r"(?i)©|\bcopyright\b|all rights reserved|\bcookies?\b|privacy policy|terms of (?:use|service)|\bsubscribe\b|\bnewsletter\b|\bsign (?:up|in)\b|\blog ?in\b|\badvert|\bsponsored\b")


@lru_cache(maxsize=4096)
def _hints(tag: str, attributes: str) -> int:
    """What an element says of its content."""
    found = _BY_TAG.get(tag, 0)
    if attributes and attributes != "/":
        for m in _ATTR.finditer(attributes):
            name, value = m[1].lower(), (m[2] or "").strip("\"'")
            if name in ("class", "id"):
                value = _SPLIT_NAME.sub("-", value).lower()
                bits = 0
                for pattern, bit in _BY_NAME:
                    if pattern.search(value):
                        bits |= bit
                # a main menu or a content footer is a menu or a footer
                found |= bits & ~MAIN if bits & _AGAINST else bits
            elif name == "role":
                found |= _BY_ROLE.get(value.lower(), 0)
            elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                found |= HIDDEN
    if tag in ("body", "html"):
        found &= HIDDEN
    if tag == "a" or tag in ("span", "p", "h1", "h2", "h3", "h4", "h5", "h6"):
        found &= ~MAIN  # too small to be the article itself
    return found


@lru_cache(maxsize=64)
def _end_of(tag: str):
    return re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I)


@lru_cache(maxsize=64)
def _start_of(tag: str):
    return re.compile(rf"<{tag}\b", re.I)


def blocks(html: str | None) -> list[tuple[str, int, float, int]]:
    """(text, words, link density, hints) of every block, in page order."""
    out: list[tuple[str, int, float, int]] = []
    stack: list[tuple[str, int]] = []  # (tag, hints of it and all around)
    opened: Counter = Counter()  # tags on the stack
    ends: dict[str, int] = {}  # where the next end tag of an unseen element is; -1: nowhere
    hints, parts, linked, at = 0, [], 0, 0
    if not html:
        return out

    def close() -> None:
        nonlocal linked
        if parts:
            words = "".join(parts).split()
            if words:
                n = len(words)
                out.append((" ".join(words), n, min(1.0, linked / n), said))
            parts.clear()
        linked = 0

    def has_end(tag: str) -> bool:
        """Whether an end tag follows, before another start for those that don't nest."""
        if tag not in ends or -1 < ends[tag] < at:
            e = _end_of(tag).search(html, at)
            ends[tag] = e.start() if e else -1
        if ends[tag] < 0 or tag in ("object", "template", "svg"):
            return ends[tag] >= 0
        again = _start_of(tag).search(html, at, ends[tag])
        return again is None

    said = 0
    end = len(html)
    while at < end:
        m = _TOKEN.search(html, at)
        stop = m.start() if m else end
        if stop > at:
            text = html[at:stop]
            if not hints & HIDDEN:
                if "&" in text:
                    text = unescape(text)
                if not parts:
                    said = hints & ~LINK
                elif text.strip():
                    said |= hints & ~LINK
                parts.append(text)
                if hints & LINK:
                    linked += len(text.split())
        if not m:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing, attributes = m[1] or m[4], m[3] or m[6] or ""
        if closing:
            if tag in _BLOCK:
                close()
            elif tag == "br":
                parts.append(" ")
            if opened[tag]:
                while True:
                    top = stack.pop()[0]
                    opened[top] -= 1
                    if top == tag:
                        break
                hints = stack[-1][1] if stack else 0
            continue
        if tag in _RAW:
            e = _end_of(tag).search(html, at)
            at = e.end() if e else end
            continue
        if tag in _UNSEEN:
            if not attributes.endswith("/") and has_end(tag):
                stack.append((tag, hints | HIDDEN))
                opened[tag] += 1
                hints |= HIDDEN
            continue
        if tag in _BLOCK:
            close()
            over = _CLOSES.get(tag)
            if tag not in ("li", "dt", "dd", "tr", "td", "th", "option"):
                over = {"p"}
            while stack and over and stack[-1][0] in over:
                opened[stack.pop()[0]] -= 1
            hints = stack[-1][1] if stack else 0
        elif tag == "br":
            parts.append(" ")
        if tag in _VOID:
            continue
        if tag in _BLOCK or tag in _INLINE_HINTS or tag in _BY_TAG:
            own = _hints(tag, attributes.strip())
            if hints & MAIN:
                own &= ~HEADER  # the article's own heading
            if tag == "body":
                hints &= ~HIDDEN  # an unclosed head ends here
                stack.clear()
                opened.clear()
            if tag == "p" and stack and stack[-1][0] == "p":
                opened[stack.pop()[0]] -= 1
            stack.append((tag, hints | own))
            opened[tag] += 1
            hints |= own
    close()
    return out


def features(page: list[tuple[str, int, float, int]]) -> list[list[float]]:
    has_main = float(any(b[3] & MAIN for b in page))
    largest = max((b[1] for b in page if b[2] < 0.5), default=1)
    rows = []
    for i, (text, words, density, hints) in enumerate(page):
        _, wb, db, _ = page[i - 1] if i else ("", 0, 0.0, 0)
        _, wa, da, _ = page[i + 1] if i + 1 < len(page) else ("", 0, 0.0, 0)
        flags = [float(bool(hints & f)) for f in (NAV, HEADER, FOOTER, ASIDE, FORM, AD, NOTICE, COMMENT, MAIN, HEADING)]
        rows.append([words, density, wb, db, wa, da, *flags, has_main, float(text[-1] in ".!?:;…»”\"')"), words / largest, float(_STOCK.search(text) is not None)])
    return rows


def training_table(pages: int = TRAIN_PAGES, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of generated pages with labels (1: article).

    Three layouts: tags that say what they hold, plain elements with telling
    classes, and plain elements that say nothing, where only figures help.
    """
    rng = random.Random(seed)

    def words(n: int, stop: str = ".") -> str:
        return " ".join(rng.choice(["ba", "re", "tion", "le", "en", "der"]) * rng.randint(1, 2) for _ in range(n)) + stop

    def links(n: int, item: str) -> str:
        return "".join(f"<{item}><a href='/x'>{words(rng.randint(1, 4), '')}</a></{item}>" for _ in range(n))

    x, y = [], []
    for _ in range(pages):
        layout = rng.choice(["tags", "classes", "plain"])
        name = lambda tag, cls: {"tags": f"<{tag}>", "classes": f"<div class='{cls}'>", "plain": "<div>"}[layout]
        over = lambda tag: f"</{tag}>" if layout == "tags" else "</div>"
        brief = layout == "plain" and rng.random() < 0.35  # a page of a few short blocks
        body = [f"<h1>{words(rng.randint(2, 14), '')}</h1>"] * (rng.random() < (0.5 if brief else 0.9))
        for _ in range(rng.randint(1, 3) if brief else rng.randint(1, 12)):
            # in a page that says nothing, an article is recognised by its longer paragraphs
            short = brief or rng.random() < (0.25 if layout != "plain" else 0.1)
            body.append(f"<p>{words(rng.randint(1, 8) if short else rng.randint(9, 140))}</p>")
            if layout != "plain" and rng.random() < 0.12:
                body.append(f"<h2>{words(rng.randint(1, 5), '')}</h2>")
            if rng.random() < 0.1:
                body.append("<ul>" + "".join(f"<li>{words(rng.randint(2, 12))}</li>" for _ in range(3)) + "</ul>")
            if rng.random() < 0.1:
                body.append(f"<p>{words(12)} <a href='/y'>{words(3, '')}</a> {words(9)}</p>")
        if layout != "plain" and rng.random() < 0.2:
            body = []  # nothing but what surrounds articles
        inside = []
        if layout != "plain":
            inside = [f"{name('aside', 'related')}{words(rng.randint(2, 40))}{over('aside')}"] * (rng.random() < 0.25)
            inside += [f"<div class='ad'>{words(rng.randint(2, 30))}</div>"] * (rng.random() < 0.3)
            inside += [f"<div class='comments'><p>{words(rng.randint(3, 60))}</p></div>"] * (rng.random() < 0.25)
            inside += [f"<form><p>{words(rng.randint(2, 20))}</p></form>"] * (rng.random() < 0.15)
        rest = [
            (0.9, f"{name('nav', 'menu')}<ul>{links(rng.randint(3, 9), 'li')}</ul>{over('nav')}"),
            (0.4, f"{name('header', 'site-header')}<p>{words(rng.randint(1, 9), '')}</p>{over('header')}"),
            (0.1 if brief else 0.5, f"<div class='ad'>{words(rng.randint(3, 30))}</div>" if layout != "plain" else f"<div>{words(rng.randint(2, 6), '')}</div>"),
            (0.1 if brief else 0.3, f"<div class='cookie-notice'><p>{words(rng.randint(5, 40))}</p></div>" if layout != "plain" else f"<p>{words(4)} <a>{words(3, '')}</a></p>"),
        ]
        tail = [
            (0.4, f"{name('aside', 'sidebar')}<p>{words(rng.randint(3, 50))}</p><ul>{links(4, 'li')}</ul>{over('aside')}" if layout != "plain" else f"<ul>{links(6, 'li')}</ul>"),
            (0.3, f"<section id='comments'><p>{words(rng.randint(2, 60))}</p><p>{words(rng.randint(2, 60))}</p></section>" if layout != "plain" else ""),
            (0.3, f"<form><label>{words(2, '')}</label><p>{words(rng.randint(2, 15))}</p></form>"),
            (0.2, f"<div><p>{words(rng.randint(5, 60))}</p></div>" if layout != "plain" else ""),  # outside the article, unnamed
            (0.9, f"{name('footer', 'footer')}{words(rng.randint(2, 30))}{over('footer')}" if layout != "plain" else f"<div>&copy; {words(rng.randint(2, 7))}</div>"),
        ]
        few = 0.3 if not body else 1.0
        head = "".join(t for p, t in rest if rng.random() < p * few)
        foot = "".join(t for p, t in tail if rng.random() < p * few)
        html = f"{head}{name('article', 'post-content')}<!--a-->{''.join(body)}<!--b-->{''.join(inside)}{over('article')}{foot}"
        sure = {b[0] for b in blocks("".join(body))}
        page = blocks(html)
        n_before = len(blocks(head))
        n_body = len(blocks("".join(body)))
        x += features(page)
        y += [float(n_before <= i < n_before + n_body and b[0] in sure) for i, b in enumerate(page)]
    return np.array(x, float), np.array(y)


@lru_cache(maxsize=1)
def fitted():
    x, y = training_table()
    return fit_tree(x, y, np.ones(len(y)), depth=12, least=4)


def main_text(html: str | None, tree) -> str:
    page = blocks(html)
    kept = [b[0] for b, f in zip(page, features(page)) if tree_value(tree, f) >= 0.5]
    if not kept and not any(b[3] & MAIN for b in page):
        kept = [b[0] for b in page if not b[3] & _AGAINST and b[2] < 0.5]
    return "\n".join(kept)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page (page_id, url, html)."""
    tree = fitted()
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def of(batches):
        for batch in batches:
            texts = [main_text(h.as_py(), tree) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.string()), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], schema=schema)

    return pages.select("page_id", "url", "html").mapInArrow(of, "page_id long, url string, text string, n_chars long")


def op2_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
