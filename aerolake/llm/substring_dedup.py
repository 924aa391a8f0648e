"""Removal of long repeated word sequences, found in FM-indexes.

Windows of ``length`` words are put where equal ones meet: each window's anchor is
the least hash among its runs of eight words, and consecutive windows of a text
with the same anchor form one segment. Only segments whose anchor stands in two
documents go on, equal ones once with their least doc_id. They are dealt by anchor
to shards of bounded size. A shard's segments are indexed: suffixes are sorted by
their first ``length`` words, the preceding words stand in a wavelet tree, and
every segment is streamed through it backwards. The matching statistics give, for
each place, the rows that begin with the words from there, and so the least doc_id
with the same window. Anchors with more segments than a shard should hold are cut
into single windows, which equal ones share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import map_arrow, shards_for, stored
from aerolake.llm.hashing import grams, mix, word_hashes

LENGTH = 50
#: Words of the runs among which anchors are chosen.
ANCHOR = 8
#: Words of a shard's segments, about.
SHARD_WORDS = 1_500_000
#: Distinct segments of one anchor beyond which it is cut into single windows.
ANCHOR_SEGMENTS = 15_000

_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


class Bits:
    """Bits with the number of ones before any place."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 8, np.uint8)
        packed = np.packbits(bits, bitorder="little")
        padded[: len(packed)] = packed
        self.words = padded.view("<u8")
        ones = np.cumsum(np.bitwise_count(self.words), dtype=np.int64)
        self.before = np.concatenate(([0], ones[:-1])).astype(np.int32)

    def rank(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletTree:
    """A sequence of symbols below ``2 ** depth``, level by level."""

    def __init__(self, symbols: np.ndarray, first: np.ndarray, depth: int):
        """``first[c]``: how many symbols are less than c, for c up to 2 ** depth."""
        self.depth, self.first, self.levels = depth, first, []
        rest = symbols
        for level in range(depth):
            shift = depth - 1 - level
            self.levels.append(Bits((rest >> shift) & 1 == 1))
            # within each node the zeros come first, so the next level is in
            # order of the first level + 1 bits
            rest = rest[np.argsort(rest >> shift, kind="stable")]

    def rank(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of each symbol before two places."""
        for level, bits in enumerate(self.levels):
            shift = self.depth - level
            node = self.first[symbol >> shift << shift]
            base = bits.rank(node)
            ones_low, ones_high = bits.rank(node + low) - base, bits.rank(node + high) - base
            one = (symbol >> (shift - 1)) & 1 == 1
            low = np.where(one, ones_low, low - ones_low)
            high = np.where(one, ones_high, high - ones_high)
        return low, high


class FMIndex:
    """Word sequences indexed for matches of up to ``length`` words."""

    def __init__(self, sequences: list[np.ndarray], owners: np.ndarray, length: int):
        """owners: a number per sequence; of equal windows the least is found."""
        self.length = length
        sizes = np.fromiter(map(len, sequences), np.int64, len(sequences))
        self.words, inner = np.unique(np.concatenate(sequences), return_inverse=True)
        # each sequence is followed by the separator, symbol 0
        ends = np.cumsum(sizes + 1)
        text = np.zeros(int(ends[-1]), np.int64)
        inside = np.ones(len(text), bool)
        inside[ends - 1] = False
        text[inside] = inner + 1
        n = len(text)
        rank, reach = text, 1
        self.suffixes = np.argsort(rank, kind="stable")
        saved = {1: rank}
        while reach < length:
            step = min(reach, length - reach)
            follow = np.zeros(n, np.int64)
            follow[: n - step] = rank[step:] + 1
            key = rank * (n + 2) + follow
            self.suffixes = np.argsort(key, kind="stable")
            ordered = key[self.suffixes]
            new = np.empty(n, np.int64)
            new[self.suffixes] = np.cumsum(np.concatenate(([0], ordered[1:] != ordered[:-1])))
            rank, reach = new, reach + step
            saved[reach] = rank
        self._saved = saved
        counts = np.bincount(text, minlength=len(self.words) + 1)
        depth = max(1, int(len(self.words)).bit_length())
        first = np.full((1 << depth) + 1, n, np.int64)
        first[: len(counts)] = np.cumsum(counts) - counts
        self.first = first
        self.tree = WaveletTree(text[self.suffixes - 1], first, depth)
        # rows of equal windows stand together: the least owner of each group
        final = rank[self.suffixes]
        self.starts = {length: np.flatnonzero(np.concatenate(([True], final[1:] != final[:-1])))}
        owner = np.repeat(owners, sizes + 1)[self.suffixes]
        self.least = np.minimum.reduceat(owner, self.starts[length])
        self.size = n

    def _groups(self, length: int) -> np.ndarray:
        """First rows of the groups that share their first ``length`` words."""
        if length not in self.starts:
            if length == 0:
                self.starts[0] = np.zeros(1, np.int64)
            else:
                reach = max(r for r in self._saved if r <= length)
                rank, n = self._saved[reach], self.size
                head = rank[self.suffixes]
                tail = np.full(n, -1, np.int64)
                at = self.suffixes + length - reach
                tail[at < n] = rank[at[at < n]]
                change = (head[1:] != head[:-1]) | (tail[1:] != tail[:-1])
                self.starts[length] = np.flatnonzero(np.concatenate(([True], change)))
        return self.starts[length]

    def _widen(self, low: np.ndarray, high: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows that share the first ``length`` words with the row ``low``."""
        starts = self._groups(length)
        group = np.searchsorted(starts, low, side="right") - 1
        return starts[group], np.append(starts, self.size)[group + 1]

    def stream(self, patterns: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each place of each pattern: the length of the longest match that
        begins there, up to ``length``, and the least owner of its rows if it is
        of full length (-1 otherwise). All patterns move on together."""
        sizes = np.fromiter(map(len, patterns), np.int64, len(patterns))
        base = np.cumsum(sizes) - sizes
        flat = np.concatenate(patterns)
        symbols = np.minimum(np.searchsorted(self.words, flat), len(self.words) - 1)
        symbols = np.where(self.words[symbols] == flat, symbols + 1, -1)
        matched, owner = np.zeros(len(flat), np.int64), np.full(len(flat), -1, np.int64)
        place = sizes - 1
        low, high = np.zeros(len(sizes), np.int64), np.full(len(sizes), self.size, np.int64)
        length = np.zeros(len(sizes), np.int64)
        active = np.flatnonzero(sizes > 0)
        while len(active):
            full = active[length[active] == self.length]
            if len(full):
                low[full], high[full] = self._widen(low[full], high[full], self.length - 1)
                length[full] -= 1
            at = base[active] + place[active]
            symbol = symbols[at]
            known = np.maximum(symbol, 0)
            a, b = self.tree.rank(known, low[active], high[active])
            a, b = self.first[known] + a, self.first[known] + b
            found = (symbol > 0) & (a < b)
            hit = active[found]
            low[hit], high[hit] = a[found], b[found]
            length[hit] += 1
            matched[at[found]] = length[hit]
            whole = hit[length[hit] == self.length]
            group = np.searchsorted(self.starts[self.length], low[whole], side="right") - 1
            owner[base[whole] + place[whole]] = self.least[group]
            missed = active[~found]
            none = missed[(length[missed] == 0) | (symbol[~found] < 0)]
            shorter = np.setdiff1d(missed, none, assume_unique=True)
            low[none], high[none], length[none] = 0, self.size, 0
            for size in np.unique(length[shorter]):
                some = shorter[length[shorter] == size]
                low[some], high[some] = self._widen(low[some], high[some], int(size) - 1)
                length[some] -= 1
            done = np.concatenate((hit, none))
            place[done] -= 1
            active = active[place[active] >= 0]
        parts = zip(base.tolist(), (base + sizes).tolist(), strict=True)
        return [(matched[a:b], owner[a:b]) for a, b in parts]


def _anchors(values: np.ndarray, span: int) -> np.ndarray:
    """Place of the first least value among each ``span`` consecutive ones."""
    n = len(values) - span + 1
    place, least, reach = np.arange(len(values)), values, 1
    while reach < span:
        step = min(reach, span - reach)
        right = least[step:]
        left = least[: len(right)]
        take = right < left
        place = np.where(take, place[step:], place[: len(right)])
        least = np.where(take, right, left)
        reach += step
    return place[:n]


def _runs(words: np.ndarray, offsets: np.ndarray, length: int):
    """Segments of documents: document, first and last window, anchor, content hash."""
    if len(words) < length:
        return None
    values = grams(words, ANCHOR)
    place = _anchors(values, length - ANCHOR + 1)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    window = np.arange(len(place))
    whole = doc[window] == doc[window + length - 1]  # not across documents
    window = window[whole]
    if not len(window):
        return None
    place, doc = place[window], doc[window]
    new = np.ones(len(window), bool)
    new[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(window)) - 1
    start, stop = window[first], window[last]
    powers = np.cumprod(np.full(len(words), _P))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * powers, dtype=np.uint64)))
    inverse = np.cumprod(np.full(len(words), _P_INVERSE))
    content = mix((sums[stop + length] - sums[start]) * inverse[start] + (stop - start).astype(np.uint64))
    own = offsets[doc[first]]
    return doc[first], start - own, stop - own, values[place[first]], content


def _find_runs(docs: DataFrame, length: int) -> DataFrame:
    def make():
        def step(batch: pa.RecordBatch):
            for start, words, offsets in word_hashes(batch["text"], False):
                found = _runs(words, offsets, length)
                if found is None:
                    continue
                doc, first, last, anchor, content = found
                at = pa.array(doc + start)
                yield {
                    "key": batch["key"].take(at),
                    "doc_id": batch["doc_id"].take(at),
                    "first": pa.array(first, pa.int32()),
                    "last": pa.array(last, pa.int32()),
                    "anchor": pa.array(anchor.view(np.int64), pa.int64()),
                    "content": pa.array(content.view(np.int64), pa.int64()),
                }

        return step

    return map_arrow(docs, make, "key long, doc_id long, first int, last int, anchor long, content long")


def _cut(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """anchor, content, doc_id, words of the wanted segments, from their texts."""

    def make():
        def step(batch: pa.RecordBatch):
            lists = batch["wanted"].to_pylist()
            anchors, contents, ids, words = [], [], [], []
            for start, hashes, offsets in word_hashes(batch["text"], False):
                for i in range(len(offsets) - 1):
                    own = hashes[offsets[i] : offsets[i + 1]]
                    for segment in lists[start + i]:
                        anchors.append(segment["anchor"])
                        contents.append(segment["content"])
                        ids.append(segment["doc_id"])
                        words.append(own[segment["first"] : segment["last"] + length].tobytes())
            yield {
                "anchor": pa.array(anchors, pa.int64()),
                "content": pa.array(contents, pa.int64()),
                "doc_id": pa.array(ids, pa.int64()),
                "words": pa.array(words, pa.binary()),
            }

        return step

    by_text = wanted.groupBy("key").agg(
        F.collect_list(F.struct("anchor", "content", "doc_id", "first", "last")).alias("wanted")
    )
    # repeated rows have one key and one text
    texts = docs.join(by_text, "key").dropDuplicates(["key"]).select("text", "wanted")
    return map_arrow(texts, make, "anchor long, content long, doc_id long, words binary")


def _search(length: int):
    """Matching statistics of a shard's segments: the windows that a document with
    a smaller doc_id has too, as bits."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("anchor", "ascending"), ("content", "ascending")])
        owners = rows["doc_id"].to_numpy()
        sequences = [np.frombuffer(w, "<u8") for w in rows["words"].to_pylist()]
        index = FMIndex(sequences, owners, length)
        masks = []
        for (matched, owner), own in zip(index.stream(sequences), owners.tolist(), strict=True):
            earlier = (matched == length) & (owner < own)
            masks.append(sum(1 << i for i in np.flatnonzero(earlier).tolist()))
        return pa.table(
            {"anchor": rows["anchor"], "content": rows["content"], "mask": pa.array(masks, pa.int64())}
        )

    return run


def _cover(docs: DataFrame, spans: DataFrame, length: int, untouched: bool) -> DataFrame:
    """Every row with its text without the words of repeated windows."""
    kept = [c for c in docs.columns if c not in ("_key", "text", "kept", "n_words", "n_removed")]

    def make():
        def step(batch: pa.RecordBatch):
            texts, counts, removed = [], [], []
            for text, runs in zip(batch["text"].to_pylist(), batch["_runs"].to_pylist(), strict=True):
                words = (text or "").encode().split()
                counts.append(len(words))
                if runs:
                    change = np.zeros(len(words) + 1, np.int32)
                    for run in runs:
                        mask, at = run["mask"], run["first"]
                        while mask:
                            skip = (mask & -mask).bit_length() - 1
                            mask >>= skip
                            ones = (~mask & (mask + 1)).bit_length() - 1
                            change[at + skip] += 1
                            change[at + skip + ones - 1 + length] -= 1
                            mask >>= ones
                            at += skip + ones
                    stay = np.cumsum(change[:-1]) == 0
                    words = [words[i] for i in np.flatnonzero(stay).tolist()]
                removed.append(counts[-1] - len(words))
                texts.append((text or "").encode() if untouched and not removed[-1] else b" ".join(words))
            yield {
                **{c: batch[c] for c in kept},
                "kept": pa.array(texts, pa.binary()),
                "n_words": pa.array(counts, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
            }

        return step

    by_text = spans.groupBy(F.col("key").alias("_key")).agg(
        F.collect_list(F.struct("first", "mask")).alias("_runs")
    )
    joined = docs.join(by_text, "_key", "left").select(*(f"`{c}`" for c in kept), "text", "_runs")
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    out = map_arrow(joined, make, f"{fields}, kept binary, n_words long, n_removed long")
    return out.withColumn("kept", F.col("kept").cast("string"))


def dedup(docs: DataFrame, length: int = LENGTH, untouched: bool = False) -> DataFrame:
    """Every row (all columns but text) with kept, n_words and n_removed.

    ``kept`` is the text's words joined by a space, without those covered by a
    window of ``length`` words that a document with a smaller doc_id has too; with
    ``untouched``, texts that lose nothing stay as they are.
    Windows are judged on the texts given, not on what is left of them. Null and
    empty texts have no words. Rows without doc_id lose nothing and take nothing;
    rows of one doc_id take nothing from each other. Columns named like the new
    ones are replaced. Segments have at most 43 windows for the default length.
    """
    if not ANCHOR < length <= ANCHOR + 61:
        raise ValueError("length must be from 9 to 69 words")
    docs = docs.withColumn("text", F.col("text").cast("string"))
    docs = docs.withColumn("_key", F.xxhash64(F.col("doc_id").cast("long"), "text"))
    own = docs.where("doc_id is not null").select(F.col("_key").alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    runs = stored(_find_runs(own, length), "runs")
    # written, so that the join's sides are plain shuffles and a hot anchor can be split
    shared = stored(
        runs.groupBy("anchor")
        .agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
        .where("a < b")
        .select("anchor"),
        "shared-anchors",
    )
    runs = stored(runs.join(shared, "anchor"), "shared-runs")
    segments = runs.groupBy("anchor", "content").agg(
        F.min("doc_id").alias("least"), F.min_by(F.struct("key", "first", "last"), "doc_id").alias("at")
    )
    segments = stored(segments, "segments")
    crowded = segments.groupBy("anchor").count().where(F.col("count") > ANCHOR_SEGMENTS).select("anchor")
    crowded = stored(crowded, "crowded")
    if not crowded.isEmpty():
        runs, segments = _single_windows(own, runs, segments, crowded, length)
    words = segments.agg(F.sum(F.expr("at.last - at.first") + length)).first()[0] or 0
    shards = shards_for(words, SHARD_WORDS)
    wanted = segments.select("anchor", "content", F.col("least").alias("doc_id"), "at.key", "at.first", "at.last")
    masks = (
        _cut(own, wanted, length)
        .withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
        .groupBy("shard")
        .applyInArrow(_search(length), "anchor long, content long, mask long")
    )
    known = stored(segments.select("anchor", "content", "least").join(masks, ["anchor", "content"]), "masks")
    # all windows of a segment that an earlier document has whole
    every = F.expr("shiftleft(1L, last - first + 1) - 1")
    spans = (
        runs.join(known, ["anchor", "content"])
        .select("key", "first", F.when(F.col("doc_id") > F.col("least"), every).otherwise(F.col("mask")).alias("mask"))
        .where("mask <> 0")
        .distinct()
    )
    return _cover(docs, stored(spans, "spans"), length, untouched)


def _single_windows(docs: DataFrame, runs: DataFrame, segments: DataFrame, crowded: DataFrame, length: int):
    """Cut the segments of crowded anchors into windows, with the window's own hash
    as anchor and content."""

    def make():
        def step(batch: pa.RecordBatch):
            lists, keys, ids = batch["wanted"].to_pylist(), batch["key"].to_pylist(), batch["doc_id"].to_pylist()
            out: dict[str, list] = {c: [] for c in ("key", "doc_id", "first", "anchor")}
            for start, hashes, offsets in word_hashes(batch["text"], False):
                for i in range(len(offsets) - 1):
                    own = hashes[offsets[i] : offsets[i + 1]]
                    for segment in lists[start + i]:
                        a, b = segment["first"], segment["last"]
                        part = own[a : b + length]
                        total = np.zeros(b - a + 1, np.uint64)
                        for k in range(length):
                            total = mix(total + part[k : k + b - a + 1])
                        out["key"] += [keys[start + i]] * (b - a + 1)
                        out["doc_id"] += [ids[start + i]] * (b - a + 1)
                        out["first"] += range(a, b + 1)
                        out["anchor"] += total.view(np.int64).tolist()
            yield {
                "key": pa.array(out["key"], pa.int64()),
                "doc_id": pa.array(out["doc_id"], pa.int64()),
                "first": pa.array(out["first"], pa.int32()),
                "last": pa.array(out["first"], pa.int32()),
                "anchor": pa.array(out["anchor"], pa.int64()),
                "content": pa.array(out["anchor"], pa.int64()),
            }

        return step

    by_text = (
        runs.join(crowded, "anchor", "left_semi")
        .groupBy("key")
        .agg(F.collect_list(F.struct("first", "last")).alias("wanted"))
    )
    texts = docs.join(by_text, "key").dropDuplicates(["key"]).select("key", "doc_id", "text", "wanted")
    schema = "key long, doc_id long, first int, last int, anchor long, content long"
    windows = stored(map_arrow(texts, make, schema), "windows")
    alone = windows.groupBy("anchor", "content").agg(
        F.min("doc_id").alias("least"),
        F.max("doc_id").alias("most"),
        F.min_by(F.struct("key", "first", "last"), "doc_id").alias("at"),
    )
    alone = stored(alone.where("least < most").drop("most"), "window-segments")
    rest_runs = runs.join(crowded, "anchor", "left_anti").select("key", "doc_id", "first", "last", "anchor", "content")
    rest = segments.join(crowded, "anchor", "left_anti").select("anchor", "content", "least", "at")
    return rest_runs.unionByName(windows), rest.unionByName(alone)
