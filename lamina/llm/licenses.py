"""Licence recognition by sentences and ordered rules.

Texts are cut into sentences: they end after ``.!?;:`` before a blank or line
end, and at blank lines.  Sentences may be wrapped over lines, with comment
marks or without; lines count as sentences too.  Normalised to lower-case
letters and digits, with one way of saying "licensed under", a sentence that equals a known licence sentence gets its
identifier, once per sentence.  The identifiers of a text, in order, form a
sequence in which the rules, one after the other, replace their own sequences
(without gaps) by the licence they name, so what a longer rule has used is no
evidence for a shorter one.  ``license`` is that of the first rule that was
used, ``licenses`` are all, in order of the text, each with the numbers of its
first and last sentence.

The GNU notices name family, version and "or later" in one clause or in
several; each way is a rule of its own, so -only and -or-later, and GPL, LGPL
and AGPL, stay apart.

Only column expressions run here.  The table of known sentences is part of the
program (some hundred rows), so it is broadcast.

Rows: null and empty texts have no sentences; equal sentences of one text are
told apart by their place; rows that repeat give equal results; texts of any
length are read whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How sentences begin that name a licence; all such beginnings become "under ".
_UNDER = "^(?:this (?:work|project|software|program|file|code|library|package) is )?(?:released|licensed|distributed|available|published|provided|made available) under (?:the )?(?:terms of (?:the )?)?"
#: What a licence is called after "under the" or "under".
NAMES: dict[str, list[str]] = {
    "MIT": ["MIT License", "MIT license (MIT)", "MIT"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache 2.0", "Apache-2.0", "Apache License v2.0"],
    "BSD-3-Clause": ["3-clause BSD License", "BSD 3-Clause License", "New BSD License", "modified BSD License", "BSD-3-Clause"],
    "BSD-2-Clause": ["2-clause BSD License", "BSD 2-Clause License", "Simplified BSD License", "BSD-2-Clause"],
    "ISC": ["ISC License", "ISC"],
    "Zlib": ["zlib License", "zlib/libpng License"],
    "BSL-1.0": ["Boost Software License, Version 1.0", "Boost Software License 1.0"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0", "MPL-2.0"],
    "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License, Version 2.0", "Eclipse Public License v2.0", "EPL-2.0"],
    "Unlicense": ["Unlicense"],
    "WTFPL": ["WTFPL", "Do What The Fuck You Want To Public License"],
    "CC0-1.0": ["CC0 1.0", "CC0", "CC0-1.0", "CC0 1.0 Universal", "Creative Commons CC0 1.0 Universal"],
    "CC-BY-4.0": ["CC BY 4.0", "CC-BY-4.0", "Creative Commons Attribution 4.0 International License", "Creative Commons Attribution 4.0"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0", "CC-BY-ND-4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0", "CC-BY-NC-SA-4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"],
    "CC-BY-NC-ND-4.0": ["CC BY-NC-ND 4.0", "CC-BY-NC-ND-4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"],
}
#: GNU families: their name, abbreviation, versions, and the date lines of their full texts.
_GNU = {
    "AGPL": ("GNU Affero General Public License", {"3": "Version 3, 19 November 2007"}),
    "LGPL": ("GNU Lesser General Public License", {"2.1": "Version 2.1, February 1999", "3": "Version 3, 29 June 2007"}),
    "GPL": ("GNU General Public License", {"2": "Version 2, June 1991", "3": "Version 3, 29 June 2007"}),
}
for _short, (_name, _versions) in _GNU.items():
    for _v in _versions:
        _full = _v if "." in _v else _v + ".0"
        _called = [f"{_name}, version {_v}", f"{_name} version {_v}", f"{_name} v{_v}", f"{_name} v{_full}", f"{_name} {_full}", f"{_short}v{_v}", f"{_short} v{_v}", f"{_short}-{_full}", f"GNU {_short} v{_v}", f"GNU {_short} version {_v}"]
        NAMES[f"{_short}-{_full}-only"] = [*_called, f"{_short}-{_full}-only", f"{_name}, version {_v} only"]
        NAMES[f"{_short}-{_full}-or-later"] = [f"{c} or {more}" for c in _called for more in ("later", "any later version", "(at your option) any later version")] + [f"{_short}-{_full}-or-later", f"{_name}, either version {_v} of the License, or (at your option) any later version"]

_MIT_GRANT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, '
    "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"
)
_ISC_GRANT = "Permission to use, copy, modify, {} distribute this software for any purpose with or without fee is hereby granted"
#: identifier -> sentences, as they read; all of them count as that identifier.
SENTENCES: dict[str, list[str]] = {
    "mit-grant": [f"{_MIT_GRANT}, subject to the following conditions:"],
    "mit-0-grant": [f"{_MIT_GRANT}."],
    "mit-notice": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.", "The above copyright notice and this permission notice (including the next paragraph) shall be included in all copies or substantial portions of the Software."],
    "mit-as-is": ['THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.'],
    "mit-liable": ["IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."],
    "isc-grant": [_ISC_GRANT.format(c) + ", provided that the above copyright notice and this permission notice appear in all copies." for c in ("and/or", "and")],
    "zero-bsd-grant": [_ISC_GRANT.format("and/or") + "."],
    "bsd-grant": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "bsd-source": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."],
    "bsd-binary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."],
    "bsd-adverts": ["All advertising materials mentioning features or use of this software must display the following acknowledgement:"],
    "bsd-names": [
        f"Neither the name of {who} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission." for who in ("the copyright holder", "the copyright holders", "the University", "the author", "the organization", "the company")
    ],
    "apache-header": ['Licensed under the Apache License, Version 2.0 (the "License");'],
    "apache-use": ["you may not use this file except in compliance with the License.", "you may not use this work except in compliance with the License."],
    "apache-terms": ["TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"],
    "apache-grant": [
        "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, "
        "publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form."
    ],
    "zlib-as-is": ["This software is provided 'as-is', without any express or implied warranty."],
    "zlib-grant": ["Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"],
    "boost-grant": [
        'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and '
        "transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:"
    ],
    "unlicense-domain": ["This is free and unencumbered software released into the public domain."],
    "unlicense-grant": ["Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."],
    "mpl2-form": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "epl2-terms": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"],
    "cc0-waiver": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide."],
    "reserved": ["All rights reserved.", "All rights are reserved."],
}
_slug = lambda s: re.sub("[^a-z0-9]+", "-", s.lower()).strip("-")
for _lic, _called in NAMES.items():
    SENTENCES["name-" + _slug(_lic)] = [f"Licensed under the {c}." for c in _called] + [f"SPDX-License-Identifier-{_lic}", f"SPDX-License-Identifier-{_lic.removesuffix('-only')}"]
#: Longer evidence first.  A rule is a sequence of places, a place one of several identifiers.
RULES: list[tuple[tuple[tuple[str, ...], ...], str]] = [
    ((("bsd-grant",), ("bsd-source",), ("bsd-binary",), ("bsd-adverts",)), "BSD-4-Clause"),
    ((("bsd-grant",), ("bsd-source",), ("bsd-binary",), ("bsd-names",)), "BSD-3-Clause"),
    ((("bsd-grant",), ("bsd-source",), ("bsd-binary",)), "BSD-2-Clause"),
    ((("mit-grant",), ("mit-notice",), ("mit-as-is",), ("mit-liable",)), "MIT"),
    ((("mit-grant",), ("mit-notice",), ("mit-as-is",)), "MIT"),
    ((("mit-grant",), ("mit-notice",)), "MIT"),
    ((("mit-0-grant",), ("mit-as-is",)), "MIT-0"),
    ((("apache-header",), ("apache-use",)), "Apache-2.0"),
    ((("apache-terms",), ("apache-grant",)), "Apache-2.0"),
    ((("isc-grant",),), "ISC"),
    ((("zero-bsd-grant",),), "0BSD"),
    ((("zlib-as-is",), ("zlib-grant",)), "Zlib"),
    ((("boost-grant",),), "BSL-1.0"),
    ((("unlicense-domain",), ("unlicense-grant",)), "Unlicense"),
    ((("unlicense-domain",),), "Unlicense"),
]
for _short, (_name, _versions) in _GNU.items():
    _own, _terms = _short.lower(), f"it under the terms of the {_name}"
    SENTENCES[f"{_own}-title"] = [_name]
    SENTENCES[f"{_own}-terms"] = [f"you can redistribute it and/or modify {_terms} as published by the Free Software Foundation"]
    for _v, _dated in _versions.items():
        _id, _full = _slug(_v), _v if "." in _v else _v + ".0"
        SENTENCES[f"dated-{_slug(_dated)}"] = [_dated]
        SENTENCES[f"v{_id}-later"] = [f"either version {_v} of the License, or (at your option) any later version."]
        SENTENCES[f"v{_id}-only"] = [f"version {_v} of the License.", f"version {_v}.", f"only version {_v} of the License.", f"version {_v} of the License only."]
        _whole = f"you can redistribute it and/or modify {_terms}"
        SENTENCES[f"{_own}-{_id}-later"] = [f"{_whole} as published by the Free Software Foundation, either version {_v} of the License, or (at your option) any later version."]
        SENTENCES[f"{_own}-{_id}-only"] = [f"{_whole} as published by the Free Software Foundation, version {_v} of the License.", f"{_whole} as published by the Free Software Foundation, version {_v}.", f"{_whole} version {_v} as published by the Free Software Foundation.", f"{_whole}, version {_v}, as published by the Free Software Foundation."]
        RULES += [
            (((f"{_own}-terms",), (f"v{_id}-later",)), f"{_short}-{_full}-or-later"),
            (((f"{_own}-terms",), (f"v{_id}-only",)), f"{_short}-{_full}-only"),
            (((f"{_own}-{_id}-later",),), f"{_short}-{_full}-or-later"),
            (((f"{_own}-{_id}-only",),), f"{_short}-{_full}-only"),
            (((f"{_own}-title",), (f"dated-{_slug(_dated)}",)), f"{_short}-{_full}-only"),
        ]
RULES += [((("mpl2-form",),), "MPL-2.0"), ((("epl2-terms",),), "EPL-2.0"), ((("cc0-waiver",),), "CC0-1.0"), ((("apache-header",),), "Apache-2.0")]
RULES += [(((f"name-{_slug(lic)}",),), lic) for lic in NAMES]
RULES += [((("reserved",),), "proprietary")]
#: Licences in the order of the rules that name them.
LICENSES = list(dict.fromkeys(lic for _, lic in RULES))

# Understood alike by Java and RE2; (pattern, replacement with the group written {}1, pattern for Java if that one rescans blanks).
_STEPS = [
    (r"(?i)(spdx-license-identifier):[ \t]*", "{}1-", None),
    (r"\b([vV])\.[ \t]+", "{}1.", None),
    (r"([0-9])\+", "{}1-or-later", None),
    (r"^[ \t\r#*/;>-]+", "", None),
    (r"[ \t\r]*\n[ \t\r#*/;>-]*", "\n", r"(?<![ \t\r])[ \t\r]*+\n[ \t\r#*/;>-]*+"),
    (r"([.!?;:])(?:\n|[ \t]+)", "{}1\x01", None),
    (r"\n\n", "\x01", None),
]


def normalise(sentence: str) -> str:
    for pattern, by, _ in _STEPS[:3]:
        sentence = re.sub(pattern, by.format("\\"), sentence)
    return re.sub(_UNDER, "under ", re.sub("[^a-z0-9]+", " ", sentence.lower()).strip(" "))


def known_sentences() -> list[tuple[str, str]]:
    """(normalised sentence, identifier)."""
    table: dict[str, str] = {}
    for k, ss in SENTENCES.items():
        for s in ss:
            if table.setdefault(normalise(s), k) != k:
                raise ValueError(f"{s!r} has two identifiers")
    return sorted(table.items())


def _pattern(places: tuple[tuple[str, ...], ...]) -> tuple[str, str]:
    """A rule's pattern over `` id@number `` tokens, and the group of its last number."""
    number = [r"([0-9]+)" if i in (0, len(places) - 1) else "[0-9]+" for i in range(len(places))]
    return "".join(f" (?:{'|'.join(p)})@{n} " for p, n in zip(places, number)), "2" if len(places) > 1 else "1"


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_sentences, sentence_ids, license, licenses) of every document.

    license is null where no rule matches; identifiers are joined by blanks,
    licences too, each as name@first-last by sentence number, from 0.
    """
    spark = docs.sparkSession
    table = known_sentences()
    known = spark.createDataFrame(table, "norm string, sid string")
    keyed = docs.select("doc_id", F.xxhash64("text").alias("th"), F.coalesce("text", F.lit("")).alias("text"))
    text = F.col("text")
    for pattern, by, java in _STEPS:
        text = F.regexp_replace(text, java or pattern, by.format("$"))
    cut_up = keyed.select("doc_id", "th", F.posexplode(F.split(text, "\x01")).alias("pos", "s"))
    # a sentence of several lines counts as a whole, and each of its lines
    shortest = min(len(n) for n, _ in table)
    lines = F.when(F.col("s").contains("\n"), F.concat(F.array("s"), F.split("s", "\n"))).otherwise(F.array("s"))
    cut_up = cut_up.where(F.length("s") >= shortest).select("doc_id", "th", "pos", F.posexplode(lines).alias("line", "s"))
    norm = F.regexp_replace(F.trim(F.regexp_replace(F.lower("s"), "[^a-z0-9]+", " ")), _UNDER, "under ")
    hits = cut_up.where(F.length("s") >= shortest).select("doc_id", "th", "pos", "line", norm.alias("norm")).join(F.broadcast(known), "norm")
    once = hits.groupBy("doc_id", "th", "pos", "sid").agg(F.min("line").alias("line"))
    seqs = once.groupBy("doc_id", "th").agg(F.array_sort(F.collect_list(F.struct("pos", "line", "sid"))).alias("found"))
    tokens = F.array_join(F.transform("found", lambda x: F.concat(F.lit(" "), x["sid"], F.lit("@"), x["pos"].cast("string"), F.lit(" "))), "")
    for places, lic in RULES:
        pattern, last = _pattern(places)
        tokens = F.regexp_replace(tokens, pattern, f" ={lic}@$1-${last} ")
    seqs = seqs.select("doc_id", "th", F.size("found").cast("long").alias("n"), F.array_join("found.sid", " ").alias("ids"), tokens.alias("tokens"))
    name = F.coalesce(*[F.when(F.col("tokens").contains(f" ={lic}@"), F.lit(lic)) for lic in LICENSES])
    all_ = F.array_join(F.transform(F.filter(F.split("tokens", " "), lambda x: x.startswith("=")), lambda x: F.substring(x, 2, 99)), " ")
    named = seqs.select("doc_id", "th", "n", "ids", name.alias("license"), all_.alias("licenses"))
    left, right = keyed.select("doc_id", "th").alias("l"), named.alias("r")
    both = left.join(right, F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("l.th") == F.col("r.th")), "left")
    return both.select(F.col("l.doc_id").alias("doc_id"), F.coalesce("n", F.lit(0).cast("long")).alias("n_sentences"), F.coalesce("ids", F.lit("")).alias("sentence_ids"), "license", F.coalesce("licenses", F.lit("")).alias("licenses"))


def op4_license_scans(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"('{n}', '{k}')" for n, k in known_sentences())
    text = "coalesce(text, '')"
    for pattern, by, _ in _STEPS:
        parts = [quoted(p) for p in re.split("[\n\x01]", by.format("\\"))]
        marks = [f"chr({ord(c)})" for c in re.findall("[\n\x01]", by)]
        text = f"regexp_replace({text}, {quoted(pattern)}, {' || '.join(x for pair in zip(parts, [*marks, None]) for x in pair if x)}, 'g')"
    tokens = "t"
    for places, lic in RULES:
        pattern, last = _pattern(places)
        tokens = f"regexp_replace({tokens}, '{pattern}', ' ={lic}@\\1-\\{last} ', 'g')"
    names = " ".join(f"WHEN contains(t, ' ={lic}@') THEN '{lic}'" for lic in LICENSES)
    return f"""
WITH known(norm, sid) AS (VALUES {values}),
p AS (SELECT doc_id, string_split({text}, chr(1)) AS ps FROM documents),
s AS (SELECT doc_id, unnest(ps) AS s, generate_subscripts(ps, 1) - 1 AS pos FROM p),
l AS (SELECT doc_id, pos, CASE WHEN contains(s, chr(10)) THEN [s] || string_split(s, chr(10)) ELSE [s] END AS ls FROM s),
x AS (SELECT doc_id, pos, unnest(ls) AS s, generate_subscripts(ls, 1) AS line FROM l),
h AS (SELECT doc_id, pos, sid, min(line) AS line FROM (SELECT doc_id, pos, line, regexp_replace(trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g')), '{_UNDER}', 'under ') AS norm FROM x) JOIN known USING (norm) GROUP BY ALL),
g AS (SELECT doc_id, count(*) AS n, string_agg(sid, ' ' ORDER BY pos, line, sid) AS ids, string_agg(' ' || sid || '@' || pos || ' ', '' ORDER BY pos, line, sid) AS t FROM h GROUP BY doc_id),
r AS (SELECT doc_id, n, ids, {tokens} AS t FROM g)
SELECT d.doc_id, coalesce(n, 0) AS n_sentences, coalesce(ids, '') AS sentence_ids, CASE {names} END AS license,
    coalesce(array_to_string([substr(k, 2) FOR k IN string_split(t, ' ') IF k[1] = '='], ' '), '') AS licenses FROM documents d LEFT JOIN r USING (doc_id)
"""


ORACLE_SQL = _sql()
