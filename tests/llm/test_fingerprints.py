import hashlib
import random
import re

import xxhash

from lamina.llm import fingerprints as fp

M = 2**64 - 1


def _hash(parts, lane):
    h = 42
    for p in parts:
        if p is not None:
            h = xxhash.xxh64_intdigest(p.encode(), h)
    return xxhash.xxh64_intdigest(lane.to_bytes(4, "little"), h)


def _slow(text, lanes=2, k=3):
    words = [w for w in re.split("[ \t-\r]+", text) if w]
    terms = [words[i : i + k] for i in range(len(words) - k + 1)] or ([words + [None] * (k - len(words))] if words else [])
    out = ""
    for lane in range(lanes):
        votes, total = [0] * 64, 0
        for t in terms:
            w, h = sum(len(p) for p in t if p), _hash(t, lane)
            total += w
            for b in range(64):
                votes[b] += w * (h >> b & 1)
        out += f"{sum(1 << b for b in range(64) if 2 * votes[b] > total):016x}"
    return out


def _docs():
    rng = random.Random(1)
    rows = [(i * 3, " ".join(rng.choice(["the", "of", "Été", "long-word", "x", "🎉"]) for _ in range(rng.randint(0, 30)))) for i in range(60)]
    return rows + [(500, None), (501, ""), (502, "one"), (503, "one\ttwo"), (504, "a b c")]


def test_query_columns_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(fp, "ROWS_PER_RANGE", 9)
    rows = _docs()
    got = {r.doc_id: r for r in fp.fingerprints(spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, r string")).collect()}
    text = {i: t or "" for i, t in rows}
    ids = sorted(text, reverse=True)
    for i, nxt in zip(ids, ids[1:] + ids[:1]):
        t, half = text[i], len(text[i]) // 2
        edited = t[: len(t) - half] + text[nxt][:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(t), hashlib.sha256(edited.encode()).hexdigest(), _slow(t), _slow(edited))
        others = {_slow(x) for x in text.values()} - {r.fingerprint}
        assert r.n_near == sum(bin(int(r.fingerprint, 16) ^ int(o, 16)).count("1") <= fp.RADIUS for o in others)
        assert abs(r.near_next - (1 - bin(int(_slow(t), 16) ^ int(_slow(text[nxt]), 16)).count("1") / 128)) < 1e-12


def test_hot_and_null_ids_keep_their_order(spark, monkeypatch):
    monkeypatch.setattr(fp, "ROWS_PER_RANGE", 5)
    rng = random.Random(6)
    ids = [7] * 60 + [None] * 50 + list(range(-20, 40)) + [2**63 - 1, -(2**63), 3, 3, 3]
    rows = [(i, " ".join(rng.choice(["the", "of", "été", "word"]) for _ in range(rng.randint(0, 9)))) for i in ids]
    signed = lambda h: h - 2**64 if h >> 63 else h
    th = lambda t: signed(xxhash.xxh64_intdigest(t.encode(), 42))
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), th(r[1]), r[1]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = fp.in_order(docs)
    ordered = [r for r in got.orderBy("r", "extra", "i").collect() if not r.extra]
    assert [(r.doc_id, r.text) for r in ordered] == want and len({r.r for r in ordered}) > 25
    assert max(sum(r.r == x.r for x in ordered) for r in ordered) < 30
    assert [r.next_text for r in ordered] == [t for _, t in want[1:] + want[:1]]
    assert got.where("extra = 0").count() == len(rows)
    digests = sorted((str(r.doc_id), r.edited_sha256) for r in fp.fingerprints(docs).collect())
    edit = lambda t, n: t[: len(t) - len(t) // 2] + n[: len(t) // 2]
    assert digests == sorted((str(i), hashlib.sha256(edit(t, n).encode()).hexdigest()) for (i, t), (_, n) in zip(want, want[1:] + want[:1]))


def test_a_very_long_text_among_short_ones(spark):
    rows = [(1, "a b"), (2, "word " * 300_000), (3, "c " * 9)]
    got = {r.doc_id: r for r in fp.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[2].n_chars == 1_500_000 and got[2].fingerprint == _slow("word word word") and got[3].near_next == 1 - bin(int(got[3].fingerprint, 16) ^ int(got[2].fingerprint, 16)).count("1") / 128


def test_repeats_nulls_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, None), (1, None), (None, "a b c d"), (None, "a b c d"), (2, "")], "doc_id long, text string")
    got = fp.fingerprints(docs).collect()
    assert len(got) == 5 and sum(r.doc_id is None for r in got) == 2 and len({r.fingerprint for r in got if r.doc_id is None}) == 1
    assert fp.fingerprints(docs.limit(0)).count() == 0
    one = fp.fingerprints(docs.where("doc_id = 2")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_tables_find_all_pairs(spark):
    rng = random.Random(4)
    fps = set()
    for _ in range(30):
        f = rng.getrandbits(64)
        for _ in range(4):
            fps.add(f)
            for b in rng.sample(range(64), rng.randint(1, 3)):
                f ^= 1 << b
    fps = sorted(f - 2**64 if f >> 63 else f for f in fps)
    for radius, blocks in ((3, None), (2, 6), (0, 1)):
        got = {(r.a, r.b, r.distance) for r in fp.near_pairs(spark.createDataFrame([(f,) for f in fps] + [(fps[0],), (None,)], "fp long"), radius, blocks).collect()}
        d = lambda a, b: bin((a ^ b) & M).count("1")
        assert got == {(a, b, d(a, b)) for i, a in enumerate(fps) for b in fps[i + 1 :] if d(a, b) <= radius}


def test_neighbours_of_whole_fingerprints(spark):
    rng = random.Random(8)
    base = [[rng.choice("abcdefgh") * rng.randint(1, 9) for _ in range(300)] for _ in range(6)]
    rows = [(i, " ".join(base[i % 6][: 300 - i // 6] + [f"x{i}"])) for i in range(48)]
    made = fp.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"))
    lanes = made.select(*[c.alias(f"h{i}") for i, c in enumerate(fp.lanes_of(made["fingerprint"]))])
    whole = sorted({r.fingerprint for r in made.collect()})
    d = lambda a, b: bin(int(a, 16) ^ int(b, 16)).count("1")
    for blocks, hot in ((None, 1000), (9, 4)):
        got = fp.near_pairs(lanes, 6, blocks, ["h0", "h1"], hot).collect()
        as_hex = lambda x: "".join(f"{v & M:016x}" for v in x)
        found = {(*sorted((as_hex(r.a), as_hex(r.b))), r.distance) for r in got}
        assert len(found) == len(got) > 0 and found == {(a, b, d(a, b)) for i, a in enumerate(whole) for b in whole[i + 1 :] if d(a, b) <= 6}
