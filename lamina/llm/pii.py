"""Personal data: fixed patterns plus boosted trees over generous candidates.

*Base spans* come from four patterns (e-mail, IPv4 address, payment card,
international phone) with their checks; failing matches are dropped, never
retried.  *Candidates* come from generators of high recall, one for each shape
(national phone numbers, cards, social-security numbers, IBANs, spelled-out
e-mails); candidates of different generators may overlap, so numbers that stand
side by side are proposed one by one as well.  Gradient-boosted trees score
each by its format and by the words before it; thresholds, one for each kind,
calibrated on held-out rows for precision, select; of overlapping selections
the better score stays, and base spans always stay.

Everything that touches documents is column expressions: patterns written so
that Java matches them without deep recursion or quadratic rescans, positions
in code points from the lengths between matches, trees as constant arrays of
nodes.  Sums over matches run in blocks, overlaps are found by halving in
sorted arrays, and pieces of a text are taken from its chunks, so a text costs
about its length plus its matches, however many it has.
The trees are fitted on the driver from ``TRAIN_ROWS`` generated rows.

Rows: null and empty texts have no spans.  Equal starts are ordered by kind as
listed in ``KINDS``; of overlapping candidates with equal scores the kind listed
first stays, then the one that starts first; rows that repeat give equal
results; texts of any length are read whole; an empty table gives no rows.
``redact`` passes all other columns on, whatever their names; ``find`` ignores
them.
"""

from __future__ import annotations

import random
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm import trees
from lamina.llm.util import below, let, running

KINDS = ("email", "ip", "card", "phone", "ssn", "iban")
TRAIN_ROWS = 9000
#: Words that tell the kinds apart when they stand shortly before a candidate.
CUES = {
    "phone": r"\b(?:phone|tel|call|mobile|cell|fax|contact|ring|text me|whatsapp|telefon|anruf|appel|llam)",
    "card": r"\b(?:card|visa|master|amex|credit|debit|payment|karte|carte|tarjeta)",
    "ssn": r"\b(?:ssn|social|security no|tax id|steuer)",
    "iban": r"\b(?:iban|account|bank|konto|compte|cuenta)",
    "email": r"\b(?:mail|contact|write|reach)",
    "other": r"\b(?:order|invoice|ref|isbn|version|serial|sku|page|code|item|part|model|date|bestell|commande|pedido)",
}
WINDOW, CHUNK = 32, 512
ROUNDS, DEPTH = 30, 3
#: Base patterns.  Possessive runs after a look-behind (or \G, the end of the match before) start where the plain
#: pattern's leftmost match would, without trying every later start; Java matches possessive groups without recursion.
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"(?<![0-9])[0-9](?:[ -]?[0-9])++"
_PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
#: Generators: (kind, pattern, a cheap test of texts that may match).  Matches of one don't overlap, those of several may.
_GENERATORS = [
    ("phone", r"(?<![0-9A-Za-z+(])\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9A-Za-z])", "[0-9]{4}"),
    ("phone", r"(?<![0-9A-Za-z+(])\(?0[0-9]{1,4}\)?(?:[ ./-]?[0-9]{2,4}){2,4}(?![0-9A-Za-z])", "0[0-9]"),
    ("phone", r"(?<![0-9A-Za-z+(])00[1-9](?:[ ().-]{0,2}[0-9]){7,13}(?![0-9A-Za-z])", "00[1-9]"),
    ("phone", r"(?<![0-9A-Za-z+(])\(?[0-9][0-9 ().-]{5,24}[0-9](?![0-9A-Za-z])", r"[0-9][0-9 ().-]{5}"),
    ("card", r"(?<![0-9A-Za-z])[0-9]{4}[ ._/-]?[0-9]{4}[ ._/-]?[0-9]{4}[ ._/-]?[0-9]{2,7}(?![0-9A-Za-z])", "[0-9]{4}[ ._/-]?[0-9]{4}"),
    ("card", r"(?<![0-9A-Za-z])3[0-9]{3}[ ._/-]?[0-9]{6}[ ._/-]?[0-9]{5}(?![0-9A-Za-z])", "[0-9]{5}"),
    ("ssn", r"(?<![0-9A-Za-z-])[0-9]{3}[- ][0-9]{2}[- ][0-9]{4}(?![0-9A-Za-z-])", "[0-9]{3}[- ][0-9]{2}[- ]"),
    ("iban", r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])", "[A-Z]{2}[0-9]{2}"),
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}(?: ?[\[(]dot[\])] ?[A-Za-z0-9-]{1,63}){1,4}", r"[\[(]at[\])]"),
]
FEATURES = (
    "n_chars", "n_digits", "n_seps", "n_kinds_of_seps", "n_groups", "longest_run", "first_run", "last_run", "luhn", "mod97", "opens", "year_like",
    "cue_phone", "cue_card", "cue_ssn", "cue_iban", "cue_email", "cue_other", "kind",
)


# SQL

_TEXT = "coalesce(text, '')"
_SPAN = "array<struct<s:int,k:int,e:int>>"


def _placed(df: DataFrame, patterns: dict[str, tuple[str, str]]) -> DataFrame:
    """df with ``p_<name>``, array<struct<s,e,t>>: a pattern's matches in
    ``text`` with code-point offsets, in order.  ``patterns`` has name:
    (pattern, guard).

    The text between matches, from split(), and the matches, from
    regexp_extract_all(), come from the same matcher, so lengths add up.
    """
    none = "cast(array() AS array<string>)"
    kept = df.columns
    df = df.selectExpr("*", *[f"CASE WHEN {g} THEN regexp_extract_all({_TEXT}, r'{p}', 0) ELSE {none} END AS m_{k}" for k, (p, g) in patterns.items()])
    df = df.selectExpr("*", *[f"CASE WHEN size(m_{k}) > 0 THEN split({_TEXT}, r'{p}', -1) ELSE {none} END AS g_{k}" for k, (p, _) in patterns.items()])

    def places(k: str) -> str:
        width = "zip_with(pz.m, slice(pz.g, 1, size(pz.m)), (pm, pg) -> length(pg) + length(pm))"
        named = "zip_with(py.m, py.w, (pm, pw) -> named_struct('m', pm, 'w', pw))"
        placed = f"zip_with({named}, {running('py.w', '0', '{} + {}'.format)}, (px, pa) -> named_struct('s', pa + px.w - length(px.m), 'e', pa + px.w, 't', px.m))"
        return let("pz", {"m": f"m_{k}", "g": f"g_{k}"}, let("py", {"m": "pz.m", "w": width}, placed))

    return df.selectExpr(*kept, *[f"{places(k)} AS p_{k}" for k in patterns])


def _digits(t: str) -> str:
    return f"regexp_replace({t}, '[^0-9]', '')"


def _luhn(digits: str) -> str:
    value = "CASE WHEN li % 2 = 0 THEN cast(ld AS int) ELSE cast(ld AS int) * 2 - CASE WHEN cast(ld AS int) > 4 THEN 9 ELSE 0 END END"
    return f"(length({digits}) > 0 AND aggregate(transform(filter(split(reverse({digits}), ''), lf -> lf <> ''), (ld, li) -> {value}), 0, (la, lx) -> la + lx) % 10 = 0)"


def base_spans(df: DataFrame) -> DataFrame:
    """df with ``b_<kind>``, array<struct<s,e,t>>, for the four base kinds."""
    part = "^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"
    ok = {
        "email": "true",
        "ip": rf"forall(split(x.t, r'\.'), q -> q rlike '{part}')",
        "card": let("d", {"v": _digits("x.t")}, f"length(d.v) BETWEEN 14 AND 19 AND {_luhn('d.v')}"),
        "phone": f"length({_digits('x.t')}) BETWEEN 10 AND 15",
    }
    kept = df.columns
    found = _placed(
        df,
        {
            "email": (_EMAIL, f"contains({_TEXT}, '@')"),
            "ip": (_IP, rf"{_TEXT} rlike r'[0-9]\.[0-9]'"),
            "card": (_CARD, f"{_TEXT} rlike '[0-9]{{2}}|[0-9][ -][0-9]'"),
            "phone": (_PHONE, f"contains({_TEXT}, '+')"),
        },
    )
    return found.selectExpr(*kept, *[f"filter(p_{k}, x -> {ok[k]}) AS b_{k}" for k in ok])


_CHUNKS = f"regexp_extract_all({_TEXT}, r'(?s).{{1,{CHUNK}}}', 0)"


def _piece(parts: str, start: str, n: str) -> str:
    """n code points from ``start`` of the text that ``parts`` are the chunks
    of; n is at most CHUNK, start within the text."""
    i = f"cast({start} div {CHUNK} AS int)"
    return f"substring(concat(get({parts}, {i}), coalesce(get({parts}, {i} + 1), '')), {start} % {CHUNK} + 1, {n})"


def _between(parts: str, start: str, end: str) -> str:
    """The code points from start to end, any number of them."""
    i, j = f"cast({start} div {CHUNK} AS int)", f"cast({end} div {CHUNK} AS int)"
    first = f"substring(get({parts}, {i}), {start} % {CHUNK} + 1, CASE WHEN {i} = {j} THEN {end} - {start} ELSE {CHUNK} END)"
    last = f"substring(coalesce(get({parts}, {j}), ''), 1, {end} % {CHUNK})"
    return f"CASE WHEN {end} <= {start} THEN '' WHEN {i} = {j} THEN {first} ELSE concat({first}, array_join(slice({parts}, {i} + 2, greatest({j} - {i} - 1, 0)), ''), {last}) END"


def _features(x: str, parts: str) -> str:
    """array<double> of FEATURES of candidate x in the text of chunks ``parts``."""
    bound = {
        "t": f"{x}.t",
        "digits": _digits(f"{x}.t"),
        "seps": f"regexp_replace({x}.t, '[0-9A-Za-z]', '')",
        "runs": f"filter(split({x}.t, '[^0-9]+'), fr -> fr <> '')",
        "before": f"CASE WHEN {x}.s > 0 THEN lower({_piece(parts, f'greatest({x}.s - {WINDOW}, 0)', f'least({x}.s, {WINDOW})')}) ELSE '' END",
        # IBAN check: letters to numbers, first four characters last, remainder mod 97 digit by digit
        "plain": f"upper(regexp_replace({x}.t, '[^0-9A-Za-z]', ''))",
    }
    turned = "filter(split(concat(substring(f.plain, 5, 60), substring(f.plain, 1, 4)), ''), fc -> fc <> '')"
    rest = f"aggregate({turned}, 0, (fa, fc) -> CASE WHEN fc rlike '[0-9]' THEN (fa * 10 + ascii(fc) - 48) % 97 ELSE (fa * 100 + ascii(fc) - 55) % 97 END)"
    values = {
        "n_chars": "length(f.t)",
        "n_digits": "length(f.digits)",
        "n_seps": "length(f.seps)",
        "n_kinds_of_seps": "size(array_distinct(filter(split(f.seps, ''), fc -> fc <> '')))",
        "n_groups": "size(f.runs)",
        "longest_run": "coalesce(array_max(transform(f.runs, fr -> length(fr))), 0)",
        "first_run": "coalesce(length(get(f.runs, 0)), 0)",
        "last_run": "coalesce(length(get(f.runs, size(f.runs) - 1)), 0)",
        "luhn": f"int({_luhn('f.digits')})",
        "mod97": f"int(length(f.plain) > 4 AND {rest} = 1)",
        "opens": "int(startswith(f.t, '('))",
        "year_like": "int(f.t rlike '^(?:19|20)[0-9]{2}[-. ]')",
        **{f"cue_{k}": f"int(f.before rlike r'{v}')" for k, v in CUES.items()},
        "kind": f"{x}.k",
    }
    return let("f", bound, f"array({', '.join(f'double({values[n]})' for n in FEATURES)})")


def _score(f: str, model: list) -> str:
    """Log odds by the trees, walked in constant arrays of nodes."""
    which, cuts, leaves = trees.as_arrays(model, DEPTH)
    which, cuts, leaves = (f"array({', '.join(xs)})" for xs in (map(str, which), [f"{x!r}D" for x in cuts], [f"{x!r}D" for x in leaves]))
    inner, last = 2**DEPTH - 1, 2**DEPTH
    at = f"aggregate(sequence(1, {DEPTH}), 0, (ti, tj) -> ti * 2 + 1 + CASE WHEN get({f}, get({which}, tt * {inner} + ti)) > get({cuts}, tt * {inner} + ti) THEN 1 ELSE 0 END)"
    return f"aggregate(sequence(0, {len(model) - 1}), 0D, (ta, tt) -> ta + get({leaves}, tt * {last} + {at} - {inner}))"


def extra_spans(df: DataFrame) -> DataFrame:
    """df with ``extra``, array<struct<s,k,e>>: the selected candidates that
    overlap no span of ``sure``, which is sorted by start."""
    model, thresholds = fitted()
    kept = df.columns
    found = _placed(df, {f"x{i}": (p, f"{_TEXT} rlike r'{g}'") for i, (_, p, g) in enumerate(_GENERATORS)})
    all_ = ", ".join(f"transform(p_x{i}, x -> named_struct('s', x.s, 'k', {KINDS.index(k)}, 'e', x.e, 't', x.t))" for i, (k, _, _) in enumerate(_GENERATORS))
    once = let("z", {"c": f"array_sort(concat({all_}))"}, "filter(z.c, (x, i) -> i = 0 OR x <> get(z.c, i - 1))")
    df = found.selectExpr(*kept, f"{once} AS c")
    # of the sure spans that start before a candidate's end none may reach beyond its start
    bound = {"c": "c", "s": "transform(sure, b -> b.s)", "e": "transform(sure, b -> b.e)", "upto": running("transform(sure, b -> b.e)", "-1", "greatest({}, {})".format)}
    clear = let("n", {"v": below("z.s", "x.e", "cb")}, "n.v = 0 OR greatest(get(z.upto, n.v - 1), get(z.e, n.v - 1)) <= x.s")
    df = df.selectExpr(*kept, f"CASE WHEN size(c) = 0 THEN c ELSE {let('z', bound, f'filter(z.c, x -> {clear})')} END AS c")
    described = f"transform(z.c, x -> named_struct('s', x.s, 'k', x.k, 'e', x.e, 'f', {_features('x', 'z.parts')}))"
    described = let("z", {"c": "c", "parts": f"CASE WHEN size(c) > 0 THEN {_CHUNKS} END"}, described)
    scored = f"transform({described}, x -> named_struct('s', x.s, 'k', x.k, 'e', x.e, 'p', {_score('x.f', model)}))"
    least = ", ".join(f"double('{'Infinity' if np.isinf(thresholds[k]) else repr(thresholds[k])}')" for k in KINDS)
    df = df.selectExpr(*kept, f"filter({scored}, x -> x.p >= get(array({least}), x.k)) AS c", f"cast(array() AS {_SPAN}) AS extra")
    for _ in range(2):  # a candidate that lost only to a loser stays too
        df = _best(df, kept)
    return df.selectExpr(*kept, "extra")


def _best(df: DataFrame, kept: list[str]) -> DataFrame:
    """df with those of ``c`` that no better one overlaps moved to ``extra``;
    candidates that overlap them are gone from ``c``."""

    def any_near(items: str, test: str) -> str:
        """Whether the test holds for one of z.items, sorted by start, that overlap x."""
        near = f"slice(z.{items}, n.lo + 1, {below('z.s', 'x.e', 'nb')} - n.lo)"
        return let("n", {"lo": below("z.s", "x.s - z.longest + 1", "na")}, f"exists({near}, y -> y.s < x.e AND x.s < y.e AND {test})")

    def with_bounds(items: str) -> dict[str, str]:
        return {items: items, "s": f"transform({items}, b -> b.s)", "longest": f"coalesce(array_max(transform({items}, b -> b.e - b.s)), 0)"}

    better = "(y.p > x.p OR (y.p = x.p AND (y.k < x.k OR (y.k = x.k AND y.s < x.s))))"
    won = let("z", with_bounds("c"), f"filter(z.c, x -> NOT {any_near('c', better)})")
    df = df.selectExpr(*kept, "c", "extra", f"{won} AS won")
    left = let("z", with_bounds("won") | {"c": "c"}, f"filter(z.c, x -> NOT {any_near('won', 'true')})")
    return df.selectExpr(*kept, f"{left} AS c", "concat(extra, transform(won, x -> named_struct('s', x.s, 'k', x.k, 'e', x.e))) AS extra")


def with_spans(texts: DataFrame) -> DataFrame:
    """texts, whose columns are ``row``, of any type, and ``text``, with
    ``b_<kind>`` (matches of the four kinds), ``sure`` (the same as
    array<struct<s,k,e>>) and ``spans`` (all spans), sorted by start and kind."""
    sure = ", ".join(f"transform(b_{k}, x -> named_struct('s', x.s, 'k', {i}, 'e', x.e))" for i, k in enumerate(KINDS[:4]))
    found = extra_spans(base_spans(texts).selectExpr("*", f"array_sort(concat({sure})) AS sure"))
    return found.selectExpr("*", "array_sort(concat(sure, extra)) AS spans")


def _joined(spans: str) -> str:
    names = f"array({', '.join(map(repr, KINDS))})"
    return f"array_join(transform({spans}, x -> concat_ws(':', get({names}, x.k), x.s, x.e)), ',')"


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans)."""
    found = with_spans(docs.select(F.col("doc_id").alias("row"), "text"))
    counts = [f"cast(size(b_{k}) AS bigint) AS n_{k}" for k in KINDS[:4]]
    return found.selectExpr("row AS doc_id", *counts, f"sha2({_joined('sure')}, 256) AS base_sha256", f"{_joined('spans')} AS spans", "cast(size(spans) AS bigint) AS n_spans")


def redact(docs: DataFrame) -> DataFrame:
    """docs with every span of ``text`` replaced by its kind in brackets;
    overlapping spans become one, named by the first.  A null text stays null.
    ``n_chars``, if there, follows."""
    names = ", ".join(f"'[{k.upper()}]'" for k in KINDS)
    # what stands before a span, and its name; nothing for one that overlaps an earlier one
    piece = f"CASE WHEN x.s >= at THEN concat({_between('z.parts', 'at', 'x.s')}, get(array({names}), x.k)) ELSE '' END"
    rest = _between("z.parts", "array_max(z.ends)", "z.n")
    bound = {"spans": "spans", "ends": "transform(spans, x -> x.e)", "parts": _CHUNKS, "n": f"length({_TEXT})"}
    pieces = f"zip_with(z.spans, {running('z.ends', '0', 'greatest({}, {})'.format)}, (x, at) -> {piece})"
    clean = let("z", bound, f"concat(array_join({pieces}, ''), {rest})")
    out = with_spans(docs.select(F.struct("*").alias("row"), "text"))
    out = out.selectExpr("row", f"CASE WHEN size(spans) > 0 THEN {clean} ELSE text END AS text", "size(spans) > 0 AS hit")

    def column(c: str):
        old = F.col("row").getField(c)
        if c == "text":
            return F.col("text")
        return F.when(F.col("hit"), F.length("text").cast(docs.schema[c].dataType)).otherwise(old).alias(c) if c == "n_chars" else old.alias(c)

    return out.select(*map(column, docs.columns))


# The model


def _luhn_sum(digits: str) -> int:
    return sum(int(d) if i % 2 == 0 else int(d) * 2 - (9 if int(d) > 4 else 0) for i, d in enumerate(reversed(digits)))


def feature_row(t: str, before: str, kind: int) -> list[float]:
    """The features of one candidate in Python; the same as ``_features``."""
    import re

    digits = re.sub("[^0-9]", "", t)
    seps = re.sub("[0-9A-Za-z]", "", t)
    runs = [r for r in re.split("[^0-9]+", t) if r]
    before = before[-WINDOW:].lower()
    total = _luhn_sum(digits)
    plain = re.sub("[^0-9A-Za-z]", "", t).upper()
    rest = 0
    for c in plain[4:] + plain[:4]:
        rest = (rest * 10 + ord(c) - 48) % 97 if c.isdigit() else (rest * 100 + ord(c) - 55) % 97
    return [
        len(t), len(digits), len(seps), len(set(seps)), len(runs), max(map(len, runs), default=0), len(runs[0]) if runs else 0, len(runs[-1]) if runs else 0,
        float(bool(digits) and total % 10 == 0), float(len(plain) > 4 and rest == 1), float(t.startswith("(")), float(bool(re.match("(?:19|20)[0-9]{2}[-. ]", t))),
        *(float(bool(re.search(v, before))) for v in CUES.values()), float(kind),
    ]


def training_table(rows: int = TRAIN_ROWS, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Generated candidates with their labels: formats of personal data in
    fitting or neutral context, and look-alikes (orders, dates, versions, plain
    numbers) in theirs."""
    rng = random.Random(seed)
    n = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    word = lambda: "".join(rng.choice(["er", "on", "ti", "le", "an", "de", "sch"]) for _ in range(rng.randint(1, 3)))
    cue = {
        "phone": ["phone", "tel", "call", "mobile", "fax", "call me at", "contact"],
        "card": ["card", "visa", "credit card", "payment card"],
        "ssn": ["ssn", "social security number", "tax id"],
        "iban": ["iban", "account", "bank account"],
        "email": ["mail", "write to", "contact", ""],
        "other": ["order", "invoice", "ref", "isbn", "version", "serial", "item", "page", "date", "code", "part"],
    }

    def luhn(k: int) -> str:
        d = n(k - 1)
        return next(d + c for c in "0123456789" if _luhn_sum(d + c) % 10 == 0)

    def iban() -> str:
        bank = "".join(rng.choice("ABCDEFGH") for _ in range(4)) * (rng.random() < 0.3)
        body = rng.choice(["DE", "FR", "ES", "GB", "IT", "BE"]) + "00" + bank + n(rng.randint(12, 23))
        value = int("".join(str(int(c, 36)) for c in body[4:] + body[:4]))
        return body[:2] + f"{98 - value % 97:02d}" + body[4:]

    def positive() -> tuple[str, str, str]:
        kind = rng.choice(["phone", "phone", "card", "ssn", "iban", "email"])
        said = rng.choice(cue[kind])
        if kind == "phone":
            t = rng.choice(
                [f"({n(3)}) {n(3)}-{n(4)}", f"{n(3)}-{n(3)}-{n(4)}", f"{n(3)}.{n(3)}.{n(4)}", f"{n(3)} {n(3)} {n(4)}", f"001 {n(3)} {n(3)} {n(4)}", f"0{n(3)} {n(7)}", f"0{n(3)}/{n(6)}", f"0{n(1)} {n(2)} {n(2)} {n(2)} {n(2)}", n(10)]
            )
            if not t.startswith("(") and not t.isdigit() and rng.random() < 0.15:
                said = word()
        elif kind == "card":
            d, s = luhn(16), rng.choice("./_ -") * (rng.random() < 0.7)
            t = s.join(d[i : i + 4] for i in range(0, 16, 4))
            if rng.random() < 0.2:
                d = "3" + luhn(14)
                d = next(d[:-1] + c for c in "0123456789" if _luhn_sum(d[:-1] + c) % 10 == 0)
                t = s.join((d[:4], d[4:10], d[10:]))
            said = rng.choice([said, word()])
        elif kind == "ssn":
            t = f"{n(3)}-{n(2)}-{n(4)}"
        elif kind == "iban":
            d = iban()
            t = rng.choice([d, " ".join(d[i : i + 4] for i in range(0, len(d), 4))])
            said = rng.choice([said, word()])
        else:
            t = f"{word()}.{n(2)} [at] {word()} [dot] com"
        return kind, t, said

    def negative() -> tuple[str, str, str]:
        kind = rng.choice(["phone", "phone", "phone", "card", "ssn", "iban"])
        said = rng.choice(cue["other"] + [word()] * 12)
        if kind == "phone":
            t = rng.choice([n(rng.randint(7, 24)), f"{rng.randint(1900, 2030)}-{n(2)}-{n(2)}", f"{n(1)}.{n(2)}.{n(3)}.{n(4)}", f"{n(3)} {n(3)} {n(3)}", f"{n(4)}-{n(4)}", f"{n(2)} {n(2)} {n(2)} {n(2)}", f"{n(5)}.{n(5)}", f"{n(3)}-{n(3)}-{n(4)}", f"{n(8)}-{n(2)}", luhn(16), n(10), f"978-{n(1)}-{n(2)}-{n(6)}-{n(1)}", f"{n(4)} {n(4)} {n(4)} {n(4)}"])
            if t.count("-") == 2 and t[3] == "-":
                said = rng.choice(cue["other"])
            if rng.random() < 0.15:  # two numbers in one, or too long a one, however they are announced
                t, said = rng.choice([n(rng.randint(16, 24)), f"{n(3)}-{n(3)}-{n(4)} {n(3)}-{n(3)}-{n(2)}", f"{n(10)} {n(3)}", f"{n(16)} {n(8)}", f"{n(3)} {n(3)} {n(4)} {n(3)} {n(3)}"]), rng.choice(cue["phone"] + cue["card"])
        elif kind == "card":
            d, s = luhn(16), rng.choice("./_ -") * (rng.random() < 0.7)
            d = d[:-1] + str((int(d[-1]) + rng.randint(1, 9)) % 10)
            t = s.join(d[i : i + 4] for i in range(0, 16, 4))
            if rng.random() < 0.2:
                t = s.join((d[:4], d[4:8], d[8:12], n(rng.choice([2, 3, 6]))))
                said = rng.choice(cue["other"] + [word()])
        elif kind == "ssn":
            t = rng.choice([f"{n(3)} {n(2)} {n(4)}", f"{n(3)}-{n(2)}-{n(4)}"])
        else:
            t = rng.choice(["AB", "KX", "DE", "US"]) + n(2) + "".join(rng.choice("ABCDEFGH0123456789") for _ in range(rng.randint(12, 26)))
            if rng.random() < 0.5:  # of the right shape, with another check sum
                t = iban()
                t = t[:2] + f"{(int(t[2:4]) + rng.randint(1, 60)) % 97:02d}" + t[4:]
                t = rng.choice([t, " ".join(t[i : i + 4] for i in range(0, len(t), 4))])
        return kind, t, said

    x, y = [], []
    for _ in range(rows):
        label = rng.random() < 0.45
        kind, t, said = (positive if label else negative)()
        before = f"{word()} {word()} {said}{rng.choice([': ', ' ', ' is ', ' no. '])}"
        x.append(feature_row(t, before, KINDS.index(kind)))
        y.append(float(label))
    return np.array(x), np.array(y)


@lru_cache(maxsize=1)
def fitted(precision: float = 0.995) -> tuple[list, dict[str, float]]:
    """(trees, for each kind the threshold on their sum): fitted on two thirds
    of the table, calibrated for precision on each kind's rows of the rest.  A
    kind that no threshold makes precise enough selects nothing."""
    x, y = training_table()
    cut = 2 * len(y) // 3
    model = trees.fit_boosted(x[:cut], y[:cut], rounds=ROUNDS, depth=DEPTH)
    scores, kind = sum(trees.tree_values(t, x[cut:]) for t in model), x[cut:, FEATURES.index("kind")]
    return model, {k: trees.threshold_for(scores[kind == i], y[cut:][kind == i], precision) for i, k in enumerate(KINDS)}


def op7_pii_boosted(spark, sf_dir: str) -> DataFrame:
    return find(spark.read.parquet(f"{sf_dir}/documents.parquet"))
