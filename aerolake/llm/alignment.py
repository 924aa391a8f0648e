"""Groups of tokens of two tokenizers that cover the same bytes, and their link counts.

A text is cut into ranges of bytes. The tokens that end in a range give a fragment: an
open prefix up to the first offset where tokens of both kinds end, the closed groups,
and an open suffix. Fragments of neighbouring ranges compose (the suffix and the prefix
between them close one more group), and composing is associative, so the ranges of a
very long text are encoded by different tasks and reduced as a tree of shuffles.

Both tokenizers see some text before and after the range: up to a single space between
two other characters, where neither lets a token cross. Words between such spaces
are encoded once per worker.

Link counts: a block of texts keeps its distinct pairs and sends only these to be
counted; what comes back is a row a block with the count of each of its pairs.
"""

from __future__ import annotations

import re
import uuid
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.bpe import ByteLevel, loaded, pre_tokens
from aerolake.llm.common import map_arrow, parts, stored, tune

#: Bytes of a range; longer texts are divided.
RANGE_BYTES = 1 << 16
#: Bytes of text after which a block is closed; a worker holds about twenty times as many.
BLOCK_BYTES = 2 << 20
#: Words that a worker keeps solved, and texts whose new words it solves at a time.
WORDS = 200_000
TOGETHER = 200
#: Fragments composed by one task at a time.
FAN = 16
#: Pairs are numbered a * PAIR + b.
PAIR = 1 << 31

#: Neither tokenizer lets a token cross the space in such a place.
_SAFE = re.compile(r"(?<=\S) (?=\S)")

FRAGMENT = (
    "closed boolean, prefix_a string, prefix_b string, groups string, suffix_a string, suffix_b string,"
    " n_a long, n_b long, n_groups long, sound boolean"
)
_FRAGMENT = [f.split()[0] for f in FRAGMENT.split(",")]


# --- the monoid ----------------------------------------------------------------------


@dataclass(frozen=True)
class Fragment:
    """Tokens of a range: ids are text, separated by commas. Without a common end all
    of them are the prefix. ``sound``: the tokens' bytes are those of the text."""

    closed: bool = False
    prefix_a: str = ""
    prefix_b: str = ""
    groups: str = ""
    suffix_a: str = ""
    suffix_b: str = ""
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    sound: bool = True

    def then(self, other: Fragment) -> Fragment:
        """The fragment of both ranges, this one first."""
        totals = {
            "n_a": self.n_a + other.n_a,
            "n_b": self.n_b + other.n_b,
            "n_groups": self.n_groups + other.n_groups,
            "sound": self.sound and other.sound,
        }
        if not self.closed:
            a, b = _comma(self.prefix_a, other.prefix_a), _comma(self.prefix_b, other.prefix_b)
            return Fragment(other.closed, a, b, other.groups, other.suffix_a, other.suffix_b, **totals)
        a, b = _comma(self.suffix_a, other.prefix_a), _comma(self.suffix_b, other.prefix_b)
        if not other.closed:
            return Fragment(True, self.prefix_a, self.prefix_b, self.groups, a, b, **totals)
        # the first common end of the other one closes what was open between them
        between = [g for g in (self.groups, f"{a}|{b}", other.groups) if g]
        totals["n_groups"] += 1
        return Fragment(
            True, self.prefix_a, self.prefix_b, ";".join(between), other.suffix_a, other.suffix_b, **totals
        )

    def whole(self) -> tuple[str, int]:
        """Groups of a whole text, whose prefix is a group too, and how many."""
        if not self.closed:
            return "", 0
        first = f"{self.prefix_a}|{self.prefix_b}"
        return (f"{first};{self.groups}" if self.groups else first), self.n_groups + 1


def _comma(a: str, b: str) -> str:
    return f"{a},{b}" if a and b else a or b


# --- tokens --------------------------------------------------------------------------


class Pair:
    """Both tokenizers, with the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        self.a = ByteLevel(path_a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        size_a, size_b = max(self.a.ranks.values()) + 1, self.b.get_piece_size()
        self.bytes_a = [b""] * size_a
        for token, i in self.a.ranks.items():
            self.bytes_a[i] = token
        self.bytes_b = [self._bytes(i) for i in range(size_b)]
        self.size_a, self.size_b = ([len(t) for t in x] for x in (self.bytes_a, self.bytes_b))
        self.length_a, self.length_b = np.array(self.size_a, np.int64), np.array(self.size_b, np.int64)
        self.text_a, self.text_b = [str(i) for i in range(size_a)], [str(i) for i in range(size_b)]
        inside = any("▁" in self.b.id_to_piece(i).lstrip("▁") for i in range(size_b))
        # were there pieces across words, only whole texts could be encoded
        self.divides = not inside
        self.known: dict[str, tuple | None] = {}

    def _bytes(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def words(self, text: str) -> list[str]:
        return _SAFE.split(text) if self.divides else [text]

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray, bool]:
        """Ids of both for a space and the text, and whether they give its bytes."""
        ids, data = self.a.ids, (" " + text).encode()
        a = np.frombuffer(b"".join([ids[p] for p in pre_tokens(" " + text)]), "<u4")
        b = np.array([*chain.from_iterable(self.b.encode(self.words(text), num_threads=1))], "<u4")
        both = zip((self.bytes_a, self.bytes_b), (a, b), strict=True)
        return a, b, all(b"".join([known[i] for i in own.tolist()]) == data for known, own in both)

    def learn(self, words: set[str]) -> None:
        """Solve the words that were not met yet, and keep them up to a bound."""
        if len(self.known) > WORDS:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        merge = self.a.core._encode_single_piece
        for word, b in zip(new, self.b.encode(new, num_threads=1), strict=True):
            spaced = " " + word
            a = [i for p in pre_tokens(spaced) for i in merge(p.encode())]
            self.known[word] = self._solved(spaced.encode(), a, b)

    def _solved(self, data: bytes, a: list[int], b: list[int]) -> tuple[str, int, int, int, bytes] | None:
        """Groups, tokens of both, how many groups, and linked pairs of a whole word; None if its bytes
        are not those of the tokens."""
        bytes_a, bytes_b, size_a, size_b = self.bytes_a, self.bytes_b, self.size_a, self.size_b
        if b"".join([bytes_a[i] for i in a]) != data or b"".join([bytes_b[i] for i in b]) != data:
            return None
        text_a, text_b = self.text_a, self.text_b
        groups, links = [], []
        end_a = end_b = from_a = from_b = m = 0
        for k, i in enumerate(a, 1):
            end_a += size_a[i]
            while end_b < end_a:
                end_b += size_b[b[m]]
                m += 1
            if end_a == end_b:
                if k - from_a == m - from_b == 1:
                    groups.append(f"{i}|{b[from_b]}")
                else:
                    groups.append(
                        ",".join([text_a[t] for t in a[from_a:k]]) + "|" + ",".join([text_b[t] for t in b[from_b:m]])
                    )
                links.append(i * PAIR + b[m - 1])
                from_a, from_b = k, m
        return ";".join(groups), len(a), len(b), len(groups), array("q", links).tobytes()

    def whole(self, words: list[str]) -> tuple[Fragment, np.ndarray]:
        """Fragment of a whole text: its words' fragments are closed at both ends, so
        composing them lists their groups. The words must have been learned."""
        known = self.known
        found = [known[w] for w in words]
        if None in found:
            return Fragment(sound=False), np.zeros(0, np.int64)
        groups, n_a, n_b, n_groups, links = zip(*found, strict=True)
        first, _, rest = ";".join(groups).partition(";")
        a, _, b = first.partition("|")
        fragment = Fragment(True, a, b, rest, n_a=sum(n_a), n_b=sum(n_b), n_groups=sum(n_groups) - 1)
        return fragment, np.frombuffer(b"".join(links), np.int64)

    def fragment(self, text: str, start: int, stop: int) -> tuple[Fragment, np.ndarray]:
        """Fragment of the tokens that end after ``start`` and up to ``stop``, counted in
        bytes of a space and the text, and the numbers of its linked pairs."""
        a, b, sound = self.tokens(text)
        end_a, end_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        if not sound:
            return Fragment(sound=False), np.zeros(0, np.int64)
        own_a, own_b = (slice(*np.searchsorted(e, (start, stop), side="right")) for e in (end_a, end_b))
        a, b, end_a, end_b = a[own_a], b[own_b], end_a[own_a], end_b[own_b]
        marks = np.zeros(stop - start + 1, bool)
        marks[end_b - start] = True
        last_a = np.flatnonzero(marks[end_a - start])
        last_b = np.searchsorted(end_b, end_a[last_a])
        links = a[last_a].astype(np.int64) * PAIR + b[last_b]
        shown_a, shown_b = ([names[i] for i in ids.tolist()] for names, ids in ((self.text_a, a), (self.text_b, b)))
        if not len(links):
            return Fragment(False, ",".join(shown_a), ",".join(shown_b), n_a=len(a), n_b=len(b)), links
        cuts_a, cuts_b = (last_a + 1).tolist(), (last_b + 1).tolist()
        groups = [
            f"{','.join(shown_a[i:j])}|{','.join(shown_b[k:m])}"
            for i, j, k, m in zip(cuts_a, cuts_a[1:], cuts_b, cuts_b[1:], strict=False)
        ]
        return Fragment(
            True,
            ",".join(shown_a[: cuts_a[0]]),
            ",".join(shown_b[: cuts_b[0]]),
            ";".join(groups),
            ",".join(shown_a[cuts_a[-1] :]),
            ",".join(shown_b[cuts_b[-1] :]),
            len(a),
            len(b),
            len(groups),
        ), links


def _pair(paths: str) -> Pair:
    return Pair(*paths.split("\0"))


def ranges(text: str, size: int = RANGE_BYTES) -> Iterator[tuple[str, int, int]]:
    """Windows of a text with the range of each, in bytes of a space and the window.

    Ranges have ``size`` bytes, at no regard to words; the window goes on to the
    places before and after where no token crosses. Without such a place for another
    ``size`` bytes the range goes on too.
    """
    data = (" " + text).encode()
    # offsets of the spaces at which windows may begin or end
    safe = [0]
    for found in _SAFE.finditer(text):
        safe.append(found.start())
    if not text.isascii():
        points = np.frombuffer(text.encode("utf-32-le"), "<u4")
        widths = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
        before = np.concatenate(([0], np.cumsum(widths)))
        safe = before[np.array(safe)].tolist()
    safe = np.array([0, *[s + 1 for s in safe[1:]]])  # the space before the text counts
    at = 0
    while at < len(data):
        stop = min(at + size, len(data))
        first = int(safe[np.searchsorted(safe, at, side="right") - 1])
        k = int(np.searchsorted(safe, stop))
        last = int(safe[k]) if k < len(safe) else len(data)
        if last - stop > size:
            stop = last
        # both begin with a space, which the tokenizers put there themselves
        yield data[first + 1 : last].decode(), at - first, stop - first
        at = stop


def steps(places: np.ndarray) -> bytes:
    """Places in ascending order, each as its distance from the one before: as many bytes
    255 as it holds, and one byte for the rest."""
    whole, rest = np.divmod(np.diff(np.sort(places), prepend=0), 255)
    out = np.full(len(places) + int(whole.sum()), 255, np.uint8)
    out[np.cumsum(whole + 1) - 1] = rest
    return out.tobytes()


def places_of(data: bytes) -> np.ndarray:
    """The places that `steps` was given, in order."""
    found = np.frombuffer(data, np.uint8)
    return np.cumsum(found, dtype=np.int64)[found != 255]


# --- in Spark ------------------------------------------------------------------------

WINDOWS = "row string, doc_id long, part int, parts int, text string, start int, stop int"
BLOCKS = (
    f"row string, doc_id long, part int, parts int, {FRAGMENT}, block string, links binary,"
    " pairs array<struct<pair: bigint, n: bigint>>"
)


def _windows(docs: DataFrame, paths: str) -> DataFrame:
    """Rows of ``WINDOWS``: short texts whole, those of several ranges spread over tasks.
    A long text with a range that is not given back byte by byte becomes an empty row."""

    def checked():
        pair = loaded(_pair, paths)

        def step(batch: pa.RecordBatch):
            sound = [pair.tokens(t)[2] for t in batch["text"].to_pylist()]
            yield {"row": batch["row"], "sound": pa.array(sound, pa.bool_())}

        return step

    def make():
        def step(batch: pa.RecordBatch):
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                cut, row = list(ranges(text, RANGE_BYTES)), uuid.uuid4().hex
                n = len(cut)
                yield {
                    "row": pa.array([row] * n, pa.string()),
                    "doc_id": pa.array([doc] * n, pa.int64()),
                    "part": pa.array(range(n), pa.int32()),
                    "parts": pa.array([n] * n, pa.int32()),
                    "text": pa.array([c[0] for c in cut], pa.string()),
                    "start": pa.array([c[1] for c in cut], pa.int32()),
                    "stop": pa.array([c[2] for c in cut], pa.int32()),
                }

        return step

    size = F.octet_length("text")
    whole = docs.where(F.col("text").isNull() | (size < RANGE_BYTES)).select(
        F.lit(None).cast("string").alias("row"),
        "doc_id",
        F.lit(0).alias("part"),
        F.lit(1).alias("parts"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.lit(0).alias("start"),
        (F.coalesce(size, F.lit(0)) + 1).alias("stop"),
    )
    cut = map_arrow(docs.where(size >= RANGE_BYTES), make, WINDOWS)
    # written: the names given to rows must stay when a task runs again
    spread = stored(cut.repartition(parts(docs.sparkSession), "row", "part"), "windows")
    unsound = map_arrow(spread.select("row", "text"), checked, "row string, sound boolean")
    unsound = stored(unsound.where("NOT sound").select("row").distinct(), "unsound")
    if not unsound.isEmpty():
        blank = spread.where("part = 0").join(unsound, "row").withColumns(
            {"parts": F.lit(1), "text": F.lit(""), "start": F.lit(0), "stop": F.lit(1)}
        )
        spread = spread.join(unsound, "row", "left_anti").unionByName(blank)
    return whole.unionByName(spread)


def _blocks(windows: DataFrame, paths: str) -> DataFrame:
    """Fragments with their links as places among the pairs of their block; the pairs
    stand in the block's first row."""
    fields = [f.split()[0] for f in WINDOWS.split(",")][:4]
    kinds = {"boolean": pa.bool_(), "string": pa.string(), "long": pa.int64()}

    def close(rows: list[dict], fragments: list[Fragment], links: list[np.ndarray]) -> pa.RecordBatch:
        name = uuid.uuid4().hex
        pairs, places, times = np.unique(np.concatenate(links), return_inverse=True, return_counts=True)
        bounds = np.cumsum([0, *map(len, links)]).tolist()
        # frequent pairs come first, so the steps between a row's places are small
        order = np.argsort(-times, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        places, pairs, times = rank[places], pairs[order], times[order]
        columns = {
            "row": pa.array([r["row"] or f"{name}-{i}" for i, r in enumerate(rows)], pa.string()),
            **{f: pa.array([r[f] for r in rows], pa.int64() if f == "doc_id" else pa.int32()) for f in fields[1:]},
            **{
                f: pa.array([getattr(x, f) for x in fragments], kinds[kind])
                for f, kind in (c.split() for c in FRAGMENT.split(","))
            },
            "block": pa.array([name] * len(rows), pa.string()),
            "links": pa.array([steps(places[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)], pa.binary()),
            "pairs": pa.ListArray.from_arrays(
                pa.array([0] + [len(pairs)] * len(rows), pa.int32()),
                pa.StructArray.from_arrays([pa.array(pairs, pa.int64()), pa.array(times, pa.int64())], ["pair", "n"]),
            ),
        }
        return pa.RecordBatch.from_pydict(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = loaded(_pair, paths)
        rows, fragments, links, size = [], [], [], 0
        for batch in batches:
            learned = 0
            given = batch.to_pylist()
            for at, row in enumerate(given):
                if at == learned:
                    # texts are solved some at a time, so that their words are kept until then
                    learned = min(at + TOGETHER, len(given))
                    some = given[at:learned]
                    words = [pair.words(r["text"]) if r["parts"] == 1 and r["text"] else [] for r in some]
                    pair.learn(set(chain.from_iterable(words)))
                    first = at
                text = row.pop("text")
                if row["parts"] > 1:
                    fragment, own = pair.fragment(text, row["start"], row["stop"])
                elif text:
                    fragment, own = pair.whole(words[at - first])
                else:
                    fragment, own = Fragment(sound=False), np.zeros(0, np.int64)
                rows.append(row)
                fragments.append(fragment)
                links.append(own)
                size += len(text) + 100
                if size >= BLOCK_BYTES:
                    block = close(rows, fragments, links)
                    # not held while the block is sent
                    rows, fragments, links, size = [], [], [], 0
                    yield block
                    del block
        if rows:
            yield close(rows, fragments, links)

    return windows.mapInArrow(run, BLOCKS)


def _reduced(fragments: DataFrame, fan: int) -> DataFrame:
    """One fragment for each text of several ranges: neighbours are composed by ``fan``,
    again and again until one is left."""
    schema = f"row string, doc_id long, part int, parts int, {FRAGMENT}"
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}

    def compose(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("part")
        found = [Fragment(**r) for r in rows.select(_FRAGMENT).to_pylist()]
        whole = reduce(Fragment.then, found)
        values = {f: getattr(whole, f) for f in _FRAGMENT}
        values |= {c: rows[c][0].as_py() for c in ("row", "doc_id", "part", "parts")}
        values |= {"part": values["part"] // fan, "parts": -(-values["parts"] // fan)}
        return pa.table({f: pa.array([values[f]], kinds[k]) for f, k in (c.split() for c in schema.split(","))})

    while (fragments.agg(F.max("parts")).first()[0] or 1) > 1:
        near = fragments.withColumn("_near", F.floor(F.col("part") / fan))
        fragments = stored(near.groupBy("row", "_near").applyInArrow(compose, schema), "fragments")
    return fragments


class Alignment:
    """What `align` found; ``row`` names a row of the input.

    ``groups``: row, doc_id, n_a, n_b, n_groups, groups. ``pairs``: a, b, count, best (no
    other pair of this b has a higher count). ``links``: row, n_links, n_best, count_sum;
    rows without links may be absent.
    """

    def __init__(self, blocks: DataFrame):
        self.blocks = blocks

    @cached_property
    def groups(self) -> DataFrame:
        names = ["row", "doc_id", "part", "parts", *_FRAGMENT]
        one = self.blocks.where("parts = 1").select(*names)
        several = _reduced(self.blocks.where("parts > 1").select(*names), FAN)
        whole = one.unionByName(several)
        first = F.concat("prefix_a", F.lit("|"), "prefix_b")
        joined = F.when(F.col("groups") == "", first).otherwise(F.concat(first, F.lit(";"), "groups"))
        zero = F.lit(0).cast("long")
        good = F.col("sound") & F.col("closed")
        return whole.select(
            "row",
            "doc_id",
            F.when(good, F.col("n_a")).otherwise(zero).alias("n_a"),
            F.when(good, F.col("n_b")).otherwise(zero).alias("n_b"),
            F.when(good, F.col("n_groups") + 1).otherwise(zero).alias("n_groups"),
            F.when(good, joined).otherwise("").alias("groups"),
        )

    @cached_property
    def _sent(self) -> DataFrame:
        """block, place, pair, n: the distinct pairs of each block."""
        return self.blocks.where(F.size("pairs") > 0).select(
            "block", F.posexplode("pairs").alias("place", "found")
        ).select("block", "place", "found.pair", "found.n")

    @cached_property
    def _counted(self) -> DataFrame:
        counts = self._sent.groupBy("pair").agg(F.sum("n").alias("count"))
        counts = stored(counts.withColumn("b", F.col("pair") % PAIR), "pair-counts")
        most = counts.groupBy("b").agg(F.max("count").alias("most"))
        return stored(
            counts.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best")),
            "pairs",
        )

    @property
    def pairs(self) -> DataFrame:
        return self._counted.select(
            F.floor(F.col("pair") / PAIR).cast("int").alias("a"), (F.col("pair") % PAIR).cast("int").alias("b"), "count", "best"
        )

    @cached_property
    def links(self) -> DataFrame:
        answers = (
            self._sent.join(self._counted, "pair")
            .groupBy("block")
            .agg(F.collect_list(F.struct("place", "count", "best")).alias("answer"))
        )
        own = self.blocks.select("block", "row", "links").where(F.octet_length("links") > 0)
        packed = own.groupBy("block").agg(F.collect_list(F.struct("row", "links")).alias("rows"))
        sums = packed.join(answers, "block").select("rows", "answer").mapInArrow(
            _sums, "row string, n_links long, n_best long, count_sum long"
        )
        return sums.groupBy("row").agg(*[F.sum(c).alias(c) for c in ("n_links", "n_best", "count_sum")])


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over the links of each row of a block."""
    for batch in batches:
        for rows, answer in zip(batch["rows"], batch["answer"], strict=True):
            answer = answer.values
            place, count, best = (answer.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            order = np.argsort(place)
            count, best = count[order], best[order].astype(np.int64)
            names, links = rows.values.field(0), rows.values.field(1)
            own = [places_of(x) for x in links.to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "row": names,
                    "n_links": pa.array([len(x) for x in own], pa.int64()),
                    "n_best": pa.array([int(best[x].sum()) for x in own], pa.int64()),
                    "count_sum": pa.array([int(count[x].sum()) for x in own], pa.int64()),
                }
            )


def align(docs: DataFrame, path_a: str, path_b: str) -> Alignment:
    """Align the tokens of a byte-level vocabulary (``path_a``, of a space and the text)
    and of a piece model (``path_b``, which adds the space itself).

    Special strings inside texts are ordinary text. Null and empty texts, and texts
    that either tokenizer does not give back byte by byte, have no tokens. Every row has a
    row in the result, also repeated ones and those without doc_id; further columns
    are not looked at. An empty table gives no rows.
    """
    tune(docs.sparkSession)
    paths = f"{path_a}\0{path_b}"
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return Alignment(stored(_blocks(_windows(own, paths), paths), "alignment"))


def spans(groups: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, number, start, stop, a, b: a row for each group, with the range it covers
    in the bytes of a space and the text."""

    def make():
        pair = loaded(_pair, f"{path_a}\0{path_b}")

        def step(batch: pa.RecordBatch):
            for doc, shown in zip(batch["doc_id"].to_pylist(), batch["groups"].to_pylist(), strict=True):
                both = [[list(map(int, side.split(","))) for side in g.split("|")] for g in shown.split(";") if g]
                stops = np.cumsum([sum(len(pair.bytes_a[i]) for i in a) for a, _ in both])
                yield {
                    "doc_id": pa.array([doc] * len(both), pa.int64()),
                    "number": pa.array(range(len(both)), pa.int64()),
                    "start": pa.array([0, *stops[:-1]] if both else [], pa.int64()),
                    "stop": pa.array(stops if both else [], pa.int64()),
                    "a": pa.array([a for a, _ in both], pa.list_(pa.int32())),
                    "b": pa.array([b for _, b in both], pa.list_(pa.int32())),
                }

        return step

    schema = "doc_id long, number long, start long, stop long, a array<int>, b array<int>"
    return map_arrow(groups.select("doc_id", "groups"), make, schema)
