"""Secret scan: generous patterns, then a random forest against false alarms.

Patterns propose candidates: keys with known prefixes, values assigned to
telling names, and long mixed strings.  Each is described by its length, its
character transitions and entropy, how much of it common word pieces cover,
the names and words before and after it, and the path it comes from; a random forest
fitted on the driver to ``TRAIN_ROWS`` generated, labelled findings decides.

Rows: null and empty texts have no findings; texts are read whole; of
overlapping candidates the most telling kind, then the first, is judged;
rows that repeat give equal results; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import math
import random
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lamina.llm.trees import fit_forest, forest_value

TRAIN_ROWS = 4000
KINDS = ("prefixed", "assigned", "key_block", "mixed")
_PREFIXED = re.compile(r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|ASIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}+|glpat-[A-Za-z0-9_-]{16,}+|xox[abpr]-[A-Za-z0-9-]{10,}+|sk_live_[A-Za-z0-9]{16,}+|AIza[A-Za-z0-9_-]{30,}+|eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+)(?![A-Za-z0-9])")
_HINTS = ("AKIA", "ASIA", "gh", "glpat-", "xox", "sk_live_", "AIza", "eyJ")
_ASSIGNED = re.compile(r"(?i)(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth[_-]?key|private[_-]?key|credential)s?[\"']?\s{0,3}(?:=|:|=>)\s{0,3}[\"']?([^\s\"'<>,;]{6,})")
#: A key block goes to its END line, header lines with hyphens included; one without END, as one before another BEGIN, to its first hyphen.
_BLOCK = re.compile(r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----(?:(?:[^-]++|-(?!----(?:BEGIN|END) ))*+-----END [A-Z ]{0,30}PRIVATE KEY-----|[^-]*+)")
_MIXED = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{20,}+={0,2}(?![A-Za-z0-9+/_=-])")
_PIECES = re.compile(
    "the|and|tion|ing|that|with|for|ment|ent|able|ble|ness|ous|con|pro|pre|com|der|die|das|ung|heit|keit|sch|ein|ich|que|les|des|eau|eux|ello|ado|ando|example|sample|test|dummy|placeholder|change|your|password|secret|token|user|admin|"
    "null|none|true|false|default|value|string|key|here|name|file|path|data|version|config|http|www|html|json|class|function"
)
_CUE = re.compile("(?i)password|passwd|pwd|secret|token|key|auth|credential|login|bearer|private")
_DOUBT = re.compile("(?i)example|sample|placeholder|dummy|test|hash|sha|md5|commit|checksum|digest|uuid|version|session|image|build|revision")
_FAKE = re.compile(r"(?i)^(?:x+|\*+|\.+|<.*>|\$\{.*|\{\{.*|your.*|change.?me.*|none|null|true|false|undefined|secret|password|(.)\1+)$")
FEATURES = ("length", "transitions", "entropy", "dictionary", "digits", "uppers", "hex", "cue", "doubt", "doubt_after", "doubt_path", "fake", "kind", "repeats")
NEAR = 40  # characters before and after a candidate that count as its neighbourhood


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) that do not overlap."""
    found = []
    if any(h in text for h in _HINTS):
        found += [(m.start(), m.end(), 0) for m in _PREFIXED.finditer(text)]
    if "=" in text or ":" in text:
        found += [(m.start(1), m.end(1), 1) for m in _ASSIGNED.finditer(text)]
    if "-----BEGIN" in text:
        found += [(m.start(), m.end(), 2) for m in _BLOCK.finditer(text)]
    for m in _LONG.finditer(text):
        if m2 := _MIXED.match(text, m.start()):
            found.append((m2.start(), m2.end(), 3))
    out: list[tuple[int, int, int]] = []  # of overlapping ones the most telling kind stays, then the first
    for s, e, k in sorted(found, key=lambda x: (x[2], x[0], x[0] - x[1])):
        i = bisect.bisect(out, (s, e, k))
        if (i == 0 or out[i - 1][1] <= s) and (i == len(out) or out[i][0] >= e):
            out.insert(i, (s, e, k))
    return out


_LONG = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20}")


def describe(value: str, before: str, after: str, path: str, kind: int) -> list[float]:
    n = len(value)
    classes = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.isalpha() else "o" for c in value]
    counts = [value.count(c) for c in set(value)]
    return [
        min(n, 300),
        sum(a != b for a, b in zip(classes, classes[1:])) / max(1, n - 1),
        -sum(c / n * math.log2(c / n) for c in counts),
        sum(len(m) for m in _PIECES.findall(value.lower())) / n,
        classes.count("d") / n,
        classes.count("u") / n,
        float(re.fullmatch("[0-9a-fA-F]+", value) is not None),
        float(_CUE.search(before) is not None),
        float(_DOUBT.search(before) is not None),
        float(_DOUBT.search(after) is not None),
        float(_DOUBT.search(path or "") is not None),
        float(_FAKE.match(value) is not None),
        kind,
        max(counts) / n,
    ]


def training_table(rows: int = TRAIN_ROWS, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Generated findings: real formats in fitting places, and false alarms
    (placeholders, prose, digests, identifiers, long words)."""
    rng = random.Random(seed)
    pick = lambda a, n: "".join(rng.choice(a) for _ in range(n))
    low, up, dig, hexa = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "0123456789abcdef"
    prose = lambda n: "".join(rng.choice(["the", "tion", "ing", "er", "on", "sch", "heit", "eau", "que", "ble"]) for _ in range(n))
    x, y = [], []
    for _ in range(rows):
        label = rng.random() < 0.5
        before, path, kind = f"{prose(2)} {prose(1)} ", rng.choice(["src1", "app/main", "docs", "web"]), 1
        if label:
            kind = rng.choice([0, 1, 1, 1, 2, 3])
            if kind == 0:
                value = rng.choice(["AKIA" + pick(up + dig, 16), "ghp_" + pick(low + up + dig, 36), "sk_live_" + pick(low + up + dig, 24), "eyJ" + pick(low + up + dig, 20) + "." + pick(low + up + dig, 30) + "." + pick(low + up + dig, 30)])
            elif kind == 1:
                value = rng.choice([pick(hexa, rng.choice([8, 12, 16, 18, 24, 32, 36, 40])), pick(low + up + dig, rng.randint(8, 40)), pick(low + up + dig + "!#%&+/-_", rng.randint(8, 24))])
                before += rng.choice(["password=", 'token = "', "secret: ", "api_key=", "pwd="])
            elif kind == 2:
                value = "-----BEGIN RSA PRIVATE KEY-----\n" + pick(low + up + dig + "+/", 200)
            else:
                value = pick(low + up + dig + "+/", rng.randint(24, 64))
                before += rng.choice(["bearer ", "auth ", "the key is ", "secret "])
        else:
            kind = rng.choice([1, 1, 3, 3])
            if kind == 1:
                value = rng.choice(["xxxxxxxx", "********", "your_password_here", "changeme", "${PASSWORD}", "<password>", "example-token", prose(3), prose(2), "required", "undefined", "string,"])
                before += rng.choice(["password=", 'token = "', "secret: ", "api_key="])
            else:
                value = rng.choice([pick(hexa, 40), pick(hexa, 64), f"{pick(hexa, 8)}-{pick(hexa, 4)}-{pick(hexa, 4)}-{pick(hexa, 4)}-{pick(hexa, 12)}", prose(6) + pick(dig, 2), "page-" + prose(5) + "-" + pick(dig, 3), "2024-01-01-" + prose(4), pick(dig, 18) + "a"])
                before += rng.choice(["commit ", "sha256 ", "version ", "checksum ", "", "", "id "])
            if rng.random() < 0.1:
                kind, value, before = 0, "AKIA" + rng.choice(["EXAMPLE", "XXXXXXX"]) + "X" * 9, "example "
        after = prose(1) + " " + prose(2)
        if not label and rng.random() < 0.3:
            after = rng.choice([" is an example", "  # placeholder", " (dummy)", " as a test", " checksum of it"]) + after
            if rng.random() < 0.5:  # what follows is all that tells
                kind, value, before = 1, pick(low + up + dig, rng.randint(12, 32)), f"{prose(2)} " + rng.choice(["token = ", "api_key=", "secret: "])
        x.append(describe(value, before[-NEAR:], after[:NEAR], path, kind))
        y.append(float(label))
    return np.array(x), np.array(y)


@lru_cache(maxsize=1)
def fitted() -> list:
    return fit_forest(*training_table(), trees=25, depth=8, seed=1)


def find(text: str | None, path: str | None, forest: list, threshold: float = 0.5) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the secrets in a text, in order."""
    text = text or ""
    return [(s, e, KINDS[k]) for s, e, k in candidates(text) if forest_value(forest, describe(text[s:e], text[max(0, s - NEAR) : s], text[e : e + NEAR], path or "", k)) >= threshold]


def scan(docs: DataFrame, path: str = "source") -> DataFrame:
    """(doc_id, n_secrets, spans) of every document; spans as kind:start:end in
    code points, end exclusive, joined by commas."""
    forest = fitted()
    schema = pa.schema([("doc_id", pa.int64()), ("n_secrets", pa.int64()), ("spans", pa.string())])

    def of(batches):
        for batch in batches:
            found = [find(t.as_py(), p.as_py(), forest) for t, p in zip(batch.column(1), batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(list(map(len, found)), pa.int64()), pa.array([",".join(f"{k}:{s}:{e}" for s, e, k in f) for f in found], pa.string())], schema=schema
            )

    return docs.select("doc_id", "text", path).mapInArrow(of, "doc_id long, n_secrets long, spans string")


def op8_secret_scans(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
