"""Token ids of the word-piece vocabulary, several times faster than the stock encoder.

The vocabulary file describes a lower-casing byte-pair model whose words carry
an end marker.  Its ids can be computed by the rank-merging encoder of
``tiktoken`` when the end marker is written as a blank, a byte that no
pre-token can hold: the two-byte symbols "last byte + blank" get the ids of the
marked bytes, which rank below every merge and are therefore formed first, just
as the stock encoder starts from them.

Only texts whose every character lies in the ranges where the two Unicode
tables certainly agree take that way (``FAST``).  All others go through the
stock encoder, so ids never depend on the route (``tests/llm/test_packing.py``
compares both).  Special tokens written out in a text are special tokens there
as well: such texts take the stock encoder too.
"""

from __future__ import annotations

import json
import re

import numpy as np

#: Any character outside these makes a text take the stock encoder.
_SLOW = re.compile("[^\t-\r -~\xa0-ɏ‐-―‘-‟…€]")
_L, _N = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ", "0-9\xb2\xb3\xb9\xbc-\xbe"
_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^\\s{_L}{_N}]+")
_DOT = "İ"  # lower-cases to two characters, one of them a combining mark


def _byte_chars() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for bytes."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(keep)]
    return {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Words(dict):
    """Id bytes by white-space-delimited word; holds at most ``most`` words."""

    def __init__(self, encode, most: int):
        self.encode_word, self.most = encode, most

    def __missing__(self, word: str) -> bytes:
        got = self.encode_word(word)
        if len(self) < self.most and len(word) <= 40:
            self[word] = got
        return got


class WordBpe:
    """``encode(text)`` gives the ids as little-endian uint32 bytes; null counts
    as empty.  ``cache`` bounds the words remembered, not the vocabulary."""

    def __init__(self, path: str, cache: int = 600_000):
        import tiktoken
        from tokenizers import Tokenizer

        self.stock = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        back, ranks = _byte_chars(), {}
        special = {t["content"] for t in spec["added_tokens"]}
        # added tokens may be matched in the normalised text, which is lower-cased
        self.special = tuple(sorted(t.lower() for t in special))
        for token, i in spec["model"]["vocab"].items():
            if token in special:
                continue
            end = token.endswith("</w>")
            ranks[bytes(back[c] for c in (token[:-4] if end else token)) + b" " * end] = i
        self.fast = tiktoken.Encoding("word", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={})
        self.words = _Words(self._word, cache)

    def _word(self, word: str) -> bytes:
        pieces = _PIECE.findall(word.lower())
        if not pieces:
            return b""
        return self.fast.encode_to_numpy(" ".join(pieces) + " ").astype("<u4", copy=False).tobytes()

    def _names_special(self, text: str) -> bool:
        if not any(t[0] in text or t[0].upper() in text for t in self.special):
            return False
        low = text.lower()
        return any(t in low for t in self.special)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if _SLOW.search(text) or _DOT in text or self._names_special(text):
            return np.array(self.stock.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.words.__getitem__, text.split()))
