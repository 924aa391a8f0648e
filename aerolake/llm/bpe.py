"""Byte-pair vocabularies and pre-tokens.

Merges never cross a pre-token, so the ids of a text are those of its pre-tokens
one after the other. Each worker keeps the pre-tokens it has met, in a cache of
bounded size, and looks up instead of merging again.
"""

from __future__ import annotations

import base64
import json
import re

import numpy as np
import regex
import tiktoken
from tokenizers import Tokenizer

# Alternatives that cannot begin alike may change places; letters come first
# because most pre-tokens are words.
_ANY = regex.compile(
    r" ?\p{L}+| ?\p{N}+|'(?:[stmd]|re|ve|ll)| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# The same for texts of ASCII and the letters of Latin-1.
_LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(
    rf" ?[{_LATIN}]+| ?[0-9]+|'(?:[stmd]|re|ve|ll)| ?[^\s0-9{_LATIN}]+|\s+(?!\S)|\s+"
)
_ODD = re.compile(rf"[^\t-\r -~{_LATIN}]")
_LOWER_ANY = regex.compile(r"'(?:[stmd]|re|ve|ll)|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
_LOWER_PLAIN = re.compile(rf"[{_LATIN}]+|'(?:[stmd]|re|ve|ll)|[0-9]|[^\s0-9{_LATIN}]+")

#: Entries a worker's cache may hold before it starts afresh.
CACHE_ENTRIES = 400_000
#: Longer pre-tokens are not kept.
CACHE_LENGTH = 64


def pre_tokens(text: str) -> list[str]:
    """Pre-tokens of the byte-level pattern; joined they give the text."""
    return (_ANY if _ODD.search(text) else _PLAIN).findall(text)


class Cache(dict):
    """pre-token -> bytes, filled on demand by ``make``."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, piece):
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        value = self.make(piece)
        if len(piece) <= CACHE_LENGTH:
            self[piece] = value
        return value


def ranks_of(path: str) -> dict[bytes, int]:
    """Token bytes to id of a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merger(ranks: dict[bytes, int]) -> tiktoken.Encoding:
    return tiktoken.Encoding("ranks", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})


def byte_of_char() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for bytes."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(kept)]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(rest)}


def special_splitter(specials: dict[str, int]):
    """Pattern that cuts a text at special strings, kept as odd items."""
    longest_first = sorted(specials, key=len, reverse=True)
    return re.compile("(" + "|".join(map(re.escape, longest_first)) + ")")


class ByteLevel:
    """A byte-level vocabulary in a tokenizers file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split = special_splitter(self.specials)
        chars = byte_of_char()
        self.ranks = {
            bytes(chars[c] for c in token): i
            for token, i in spec["model"]["vocab"].items()
            if token not in self.specials
        }
        self.core = merger(self.ranks)
        self.ids = Cache(self._ids)

    def _ids(self, piece: str) -> bytes:
        return np.array(self.core._encode_single_piece(piece.encode()), "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers."""
        found = self.ids
        if "<" not in text or not self.split.search(text):
            return b"".join([found[p] for p in pre_tokens(text)])
        out = []
        for i, part in enumerate(self.split.split(text)):
            if i % 2:
                out.append(np.array([self.specials[part]], "<u4").tobytes())
            else:
                out += [found[p] for p in pre_tokens(part)]
        return b"".join(out)


class WordLevel:
    """A lower-casing vocabulary with word ends in a tokenizers file."""

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split = special_splitter(self.specials)
        self.to_chars = {b: c for c, b in byte_of_char().items()}
        self.ids = Cache(self._ids)

    def _ids(self, piece: str) -> bytes:
        chars = piece.encode().decode("latin-1").translate(self.to_chars)
        return np.array([t.id for t in self.whole.model.tokenize(chars)], "<u4").tobytes()

    def _pieces(self, text: str) -> list[str]:
        if _ODD.search(text):
            return _LOWER_ANY.findall(self.whole.normalizer.normalize_str(text))
        return _LOWER_PLAIN.findall(text.lower())

    def encode(self, text: str) -> bytes:
        found = self.ids
        if "<" not in text or not self.split.search(text):
            return b"".join([found[p] for p in self._pieces(text)])
        out = []
        for i, part in enumerate(self.split.split(text)):
            if i % 2:
                out.append(np.array([self.specials[part]], "<u4").tobytes())
            else:
                out += [found[p] for p in self._pieces(part)]
        return b"".join(out)


_LOADED: dict = {}


def loaded(kind, path: str):
    """One copy per worker process, shared by the tasks it runs."""
    key = (kind, path)
    if key not in _LOADED:
        _LOADED[key] = kind(path)
    return _LOADED[key]
