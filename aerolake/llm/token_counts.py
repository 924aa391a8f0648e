"""Exact token count at every prefix of a text.

Within a pre-token, the last token of each prefix follows by dynamic programming:
it is the one token t ending there for which the pair (last token before t, t)
encodes to itself, and the count is one more than before t. Each distinct
pre-token is solved once; a text's table is their steps one after the other, with
the places mended where a cut falls inside a run of white space or a special string.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.bpe import (
    CACHE_ENTRIES,
    CACHE_LENGTH,
    ByteLevel,
    Cache,
    loaded,
    pre_tokens,
)
from aerolake.llm.common import map_arrow

# Runs of white space as the pre-token pattern knows it: without the separators
# that Python's \s adds.
_RUN = re.compile(r"[^\S\x1c-\x1f]{2,}(?=[\S\x1c-\x1f])")

#: Texts whose new pre-tokens are solved together.
TOGETHER = 200


def _by_char(data: bytes, chars: int, counts: list[int]) -> bytes:
    """Steps of the counts at the ends of code points."""
    if len(data) != chars:
        # a code point ends where the next byte is no continuation
        ends = [i for i in range(1, len(data)) if data[i] & 0xC0 != 0x80]
        counts = [0, *(counts[i] for i in ends), counts[-1]]
    return bytes([(b - a) & 255 for a, b in zip(counts, counts[1:], strict=False)])


class PrefixCounter:
    """Steps of the token count, one per code point of the text."""

    def __init__(self, path: str):
        self.vocabulary = ByteLevel(path)
        self.ranks = self.vocabulary.ranks
        self.tokens = {i: t for t, i in self.ranks.items()}
        self.longest = max(map(len, self.ranks))
        self.pairs: dict[tuple[int, int], bool] = {}
        self.steps = Cache(lambda piece: self._steps(piece).tobytes())

    def _stays(self, left: int, right: int) -> bool:
        """Whether the two tokens side by side encode to themselves."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) > 1_000_000:
                self.pairs.clear()
            both = self.tokens[left] + self.tokens[right]
            known = self.vocabulary.core._encode_single_piece(both) == [left, right]
            self.pairs[left, right] = known
        return known

    def counts(self, data: bytes) -> list[int]:
        """Tokens of each prefix of one pre-token, from the empty one on."""
        last, count = [-1], [0]
        self._extend(data, last, count)
        return count

    def _extend(self, data: bytes, last: list[int], count: list[int]) -> None:
        """Carry the last tokens and counts on to the end of ``data``."""
        rank, pairs, stays, longest = self.ranks.get, self.pairs.get, self._stays, self.longest
        for end in range(len(last), len(data) + 1):
            for start in range(max(0, end - longest), end):
                token = rank(data[start:end])
                if token is None:
                    continue
                before = last[start]
                if before < 0:
                    break
                ok = pairs((before, token))
                if stays(before, token) if ok is None else ok:
                    break
            last.append(token)
            count.append(count[start] + 1)

    def learn(self, pieces: set[str]) -> None:
        """Solve new pre-tokens in order, each from where it parts from the one before."""
        before, last, count = b"", [-1], [0]
        for piece in sorted(pieces - self.steps.keys()):
            if piece[0] == "'" or len(piece) > CACHE_LENGTH:
                continue
            data, k = piece.encode(), 0
            for x, y in zip(data, before, strict=False):
                if x != y:
                    break
                k += 1
            del last[k + 1 :], count[k + 1 :]
            self._extend(data, last, count)
            before = data
            if len(self.steps) >= CACHE_ENTRIES:
                self.steps.clear()
            self.steps[piece] = _by_char(data, len(piece), count)

    def _steps(self, piece: str) -> np.ndarray:
        data = piece.encode()
        if len(piece) == 3 and piece[0] == "'" and piece[1].isalpha():
            # a contraction of two letters; cut after one of them, it is none
            rest = self.counts(piece[1].encode())[-1]
            first = self.counts(b"'")[-1]
            counts = [0, first, first + rest, self.counts(data)[-1]]
            return np.diff(counts).astype(np.int8)
        return np.frombuffer(_by_char(data, len(piece), self.counts(data)), np.int8)

    def _ordinary(self, text: str, pieces: list[str] | None = None) -> bytes:
        found = self.steps
        steps = b"".join([found[p] for p in (pre_tokens(text) if pieces is None else pieces)])
        run = _RUN.search(text)
        if not run:
            return steps
        mended = np.frombuffer(steps, np.int8).copy()
        for run in _RUN.finditer(text):
            a, b = run.span()
            own = np.frombuffer(found[text[a:b]], np.int8)
            mended[b] += mended[a:b].sum(dtype=int) - own.sum(dtype=int)
            mended[a:b] = own
        return mended.tobytes()

    def tables(self, texts: list[str]) -> list[bytes]:
        """The table of each text."""
        out = []
        for i in range(0, len(texts), TOGETHER):
            some = texts[i : i + TOGETHER]
            cut = [pre_tokens(t) for t in some]
            self.learn(set().union(*cut))
            out += [self.table(t, p) for t, p in zip(some, cut, strict=True)]
        return out

    def table(self, text: str, pieces: list[str] | None = None) -> bytes:
        """Step of the count at each code point, as signed bytes; the sum of the
        first n is the count of the prefix of n code points."""
        if "<" not in text or not self.vocabulary.split.search(text):
            return self._ordinary(text, pieces)
        out, items = [], self.vocabulary.split.split(text)
        for i in range(0, len(items), 2):
            if i + 1 == len(items):
                out.append(self._ordinary(items[i]))
                break
            # up to its last character a special string is ordinary text
            cut = np.frombuffer(self._ordinary(items[i] + items[i + 1][:-1]), np.int8)
            plain = np.frombuffer(self._ordinary(items[i]), np.int8).sum(dtype=int)
            out += [cut.tobytes(), np.int8(plain + 1 - cut.sum(dtype=int)).tobytes()]
        return b"".join(out)


def prefix_counts(steps: bytes) -> np.ndarray:
    """Token count of every prefix, the empty one first."""
    return np.concatenate(([0], np.cumsum(np.frombuffer(steps, np.int8), dtype=np.int64)))


def longest_within(steps: bytes, budget: int) -> int:
    """Most code points whose prefix has at most ``budget`` tokens."""
    return int(np.flatnonzero(prefix_counts(steps) <= budget)[-1])


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens and ``steps``, the prefix table of every text.

    Null texts count as empty (0 tokens, empty table). Special strings count as
    one token, as the library has it. Every row gives a row, also repeated ones
    and those without doc_id; further columns are not looked at.
    """

    def make():
        counter = loaded(PrefixCounter, path)

        def step(batch: pa.RecordBatch):
            tables = counter.tables([t or "" for t in batch["text"].to_pylist()])
            totals = [int(np.frombuffer(s, np.int8).sum(dtype=np.int64)) for s in tables]
            yield {
                "doc_id": batch["doc_id"],
                "n_bytes": batch["n_bytes"],
                "n_tokens": pa.array(totals, pa.int64()),
                "steps": pa.array(tables, pa.binary()),
            }

        return step

    text = F.col("text").cast("string")
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text.alias("text"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
    )
    return map_arrow(own, make, "doc_id long, n_bytes long, n_tokens long, steps binary")


def truncate(docs: DataFrame, path: str, budget: int) -> DataFrame:
    """doc_id, text: the longest prefix of at most ``budget`` tokens."""

    def make():
        counter = loaded(PrefixCounter, path)

        def step(batch: pa.RecordBatch):
            texts = [t or "" for t in batch["text"].to_pylist()]
            cut = [t[: longest_within(counter.table(t), budget)] for t in texts]
            yield {"doc_id": batch["doc_id"], "text": pa.array(cut, pa.string())}

        return step

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(own, make, "doc_id long, text string")
