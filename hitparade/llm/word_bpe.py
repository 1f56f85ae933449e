"""Encoding with a tokenizers-library vocabulary of word BPE.

The tokenizer's own normaliser and pre-tokenizer never join text across white
space, nor at a mark after a letter, so a text's ids are those of the chunks between them in
order. Chunks are encoded by the library's BPE model once and remembered. Texts holding the
separators U+001C to U+001F, which Python splits at and the tokenizer's pattern
does not, or the content of an added token (``<|endoftext|>``), which the library
matches before its pattern, are encoded whole by the library.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import regex
from tokenizers import Tokenizer

#: Chunks remembered in a Python worker, in two generations (results do not depend on it).
MEMORY = 800_000
#: Longer chunks are encoded without being remembered.
LONGEST_REMEMBERED = 48
# Between a Latin-1 letter and a mark there is always an end of a pre-token.
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_BOUNDARY = re.compile(f"(?<=[{_LETTER}])(?=[.,!?;:])")
_LETTERS = re.compile(f"[{_LETTER}]+").fullmatch
_SEPARATORS = "\x1c\x1d\x1e\x1f"
# The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from U+0100 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_ALPHABET = {b: chr(b) for b in _PRINTABLE}
_ALPHABET |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _ALPHABET)}


class Memory(dict):
    """Remembers what ``make`` gives for short keys: those met lately, and those met before the last turn."""

    def __init__(self, make):
        super().__init__()
        self.make = make
        self.older: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        made = self.older.get(key)
        if made is None:
            made = self.make(key)
        if len(key) <= LONGEST_REMEMBERED:
            self[key] = made
        return made

    def bound(self) -> None:
        """A full generation becomes the older one; what it does not meet again is forgotten at the next turn."""
        if len(self) > MEMORY // 2:
            self.older = dict(self)
            self.clear()


class WordEncoder:
    """``encoder(texts) -> id arrays``, each with ``end_id`` appended."""

    def __init__(self, tokenizer_json: str, end_id: int):
        self.tok = Tokenizer.from_str(tokenizer_json)
        self.tok.no_truncation()
        self.tok.no_padding()
        spec = json.loads(tokenizer_json)
        self.added = [t["content"] for t in spec["added_tokens"]]
        if any(t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("added tokens must be matched in the text as it is")
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if split["type"] != "Split" or not split["invert"] or split["behavior"] != "Removed":
            raise ValueError("the tokenizer's pre-tokens must be the matches of one pattern")
        self.find = regex.compile(split["pattern"]["Regex"]).findall
        self.model = self.tok.model
        self.end = np.array([end_id], "<u4").tobytes()
        self.chunks = Memory(self._chunk)

    def _in_chunks(self, text: str) -> bool:
        """Whether the text's ids are those of its chunks."""
        return not any(c in text for c in _SEPARATORS) and not any(a in text for a in self.added)

    def _whole(self, texts: list[str]) -> list[bytes]:
        got = self.tok.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in got]

    def _word(self, word: str) -> bytes:
        """The ids of a normalised pre-token, by the library's model alone."""
        mapped = word if word.isascii() else word.encode().decode("latin-1").translate(_ALPHABET)
        return array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        """The ids of a chunk, from those of its normalised pre-tokens."""
        if _LETTERS(chunk):
            return self._word(chunk.lower())
        split = self.find(chunk.lower() if chunk.isascii() else self.tok.normalizer.normalize_str(chunk))
        return b"".join([self._word(w) for w in split])

    @staticmethod
    def _split(text: str) -> list[str]:
        try:  # Latin-1 text is normal but for its capitals
            text.encode("latin-1")
            text = text.lower()
        except UnicodeEncodeError:
            pass
        return _BOUNDARY.sub(" ", text).split()

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        out = []
        for t in texts:
            if not t:
                ids = b""
            elif self._in_chunks(t):
                ids = b"".join(map(self.chunks.__getitem__, self._split(t)))
                self.chunks.bound()
            else:
                ids = self._whole([t])[0]
            out.append(np.frombuffer(ids + self.end, "<u4"))
        return out


_ENCODERS: dict[tuple[int, int], WordEncoder] = {}


def encoder(tokenizer_json: str, end_id: int) -> WordEncoder:
    """One encoder a worker process."""
    key = (hash(tokenizer_json), end_id)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = WordEncoder(tokenizer_json, end_id)
    return _ENCODERS[key]
