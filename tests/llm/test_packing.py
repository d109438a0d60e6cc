import zlib
from functools import lru_cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lamina.llm import packing
from lamina.llm.wordbpe import WordBpe


@pytest.fixture(scope="module")
def model():
    return WordBpe(packing.vocabulary_path())


@lru_cache(maxsize=1)
def _untouched():
    return Tokenizer.from_file(packing.vocabulary_path())


def _stock(model, text):
    return _untouched().encode(text, add_special_tokens=False).ids


EDGES = ["", " ", "it's I'LL 'start don't", "a²b½ ÀÉ ÿĀ", "<|endoftext|> <|startoftext|>x", "hello <|endoftext|> world", "a<|startoftext|>b<|EndOfText|> <|endoftext", "<|", "x < y |> z", "İstanbul ΣΑΣ", "a\x1cb\x1fc", "“q” — 10€…", "é x\xa0y ", "é ﬁ 漢字 🎉🎉", "x" * 5000, "a.b,c!!??", "\t\n\r\x0b\x0c", "\x00\x7f"]


@pytest.mark.parametrize("text", EDGES)
def test_ids_equal_the_stock_encoder(model, text):
    assert np.frombuffer(model.encode(text), "<u4").tolist() == _stock(model, text)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x24F), st.sampled_from("'sStTrReE vVmMlLdD“”—…€"), st.characters(exclude_categories=("Cs",))), max_size=60))
def test_ids_equal_the_stock_encoder_on_any_text(model, text):
    assert np.frombuffer(model.encode(text), "<u4").tolist() == _stock(model, text)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 300), max_size=30))
def test_plan_places_every_piece_without_overlap(histogram):
    cap = 64
    rows = packing.plan(histogram, cap)
    used: dict[int, list] = {}
    for length, n in histogram.items():
        mine = sorted(r for r in rows if r[0] == length)
        for i, (_, rank, first, each, offset) in enumerate(mine):
            upto = mine[i + 1][1] if i + 1 < len(mine) else n
            assert rank == (0 if i == 0 else rank) and upto > rank
            for k in range(rank, upto):
                used.setdefault(first + (k - rank) // each, []).append((offset + (k - rank) % each * length, length))
    assert sum(map(len, used.values())) == sum(histogram.values())
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= cap
    rooms: list[int] = []  # the same by single pieces
    for length in sorted((k for k, v in histogram.items() for _ in range(v)), reverse=True):
        fit = [r for r in rooms if r >= length]
        if fit:
            rooms.remove(min(fit))
        rooms.append((min(fit) if fit else cap) - length)
    assert len(used) == len(rooms)


def test_plan_size_does_not_follow_the_counts():
    assert len(packing.plan({k: 10**9 + k for k in range(1, 257)}, 256)) < 256 * 2 * 8 + 256


def test_packs_nulls_repeats_and_long_texts(spark, model):
    rows = [(1, None, "x"), (2, "", "x"), (3, "word " * 50, "y"), (3, "word " * 50, "y"), (4, "one two", None), (None, "lost id", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string")
    got = packing.pack_documents(docs, packing.vocabulary_path(), capacity=16).collect()
    by_seq: dict = {}
    for r in got:
        by_seq.setdefault(r.sequence_id, []).append(r)
    for rs in by_seq.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 16
    expected = sum(len(_stock(model, t or "")) + 1 for _, t, _ in rows)
    assert sum(r.length for r in got) == expected and len(by_seq) == -(-expected // 16)
    ids = np.array(_stock(model, "word " * 50) + [1], "<u4")
    threes = sorted((r for r in got if r.doc_id == 3), key=lambda r: (r.start, r.sequence_id))
    assert [r.start for r in threes] == sorted([0, 16, 32, 48] * 2)
    assert {r.ids_crc32 for r in threes if r.start == 48} == {zlib.crc32(ids[48:].tobytes())}
    assert packing.pack_documents(docs.limit(0), packing.vocabulary_path()).count() == 0


def test_hot_lengths_are_ranked_across_buckets(spark, monkeypatch):
    monkeypatch.setattr(packing, "ROWS_PER_BUCKET", 10)
    docs = spark.createDataFrame([(i, "a b") for i in range(300)], "doc_id long, text string")
    got = packing.pack_documents(docs, packing.vocabulary_path(), capacity=9).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == 300 and len({r.sequence_id for r in got}) == 100
