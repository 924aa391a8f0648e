"""Interpolated modified Kneser-Ney model of runs of words, of any order from 2.

Runs of ``order`` words are counted where their last word but one is dealt to. The
shorter runs a run ends with, and the words each of these follows, share that word:
so the shard knows the counts of every length. It writes its distinct longest runs as
one pack to a file of the shared folder. The longest runs count their uses, shorter
ones the words seen before them, and their uses if they begin a text. The shards' last
words make the vocabulary, dealt by word and written as arrays. For scoring, runs of
all texts go to their shard, whose task makes sorted hash arrays of the runs and
contexts of each length from the file, looks up and gives each text's share of the sum.

A last word but one that is frequent beyond a shard's share is dealt together with
the last word; there are at most a few such words for each shard. Their totals as
contexts of one word are summed on the driver; longer contexts that end in them are
summed by hash and written like the vocabulary. Runs travel in packs, sorted by the
last two words. A pack names frequent words by their rank in one list of bounded size
that every task has, and holds the others once each: so a run takes about as many bytes
in the small packs of many shards as in large ones.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import map_arrow, qualified, scratch, shards_for, stored
from aerolake.llm.hashing import mix, word_hashes

#: Words that begin and end every text; no text can hold them.
BEGIN, END = np.uint64(1), np.uint64(2)
#: Tokens that are packed together, and texts at most.
FLUSH_TOKENS = 3_000_000
FLUSH_TEXTS = 60_000
#: Tokens whose pairs one shard counts and scores, about.
SHARD_TOKENS = 5_000_000
#: A first word with this share of a shard's tokens is dealt by both words.
HOT_SHARE = 0.25
#: Frequent words that packs name by rank, at most.
COMMON = 1 << 18
#: Sums of one text by shards at most; with more shards, so many groups of them are scored.
GROUPS = 128
_SLOTS = np.uint64((1 << 21) - 1)
_TWO = np.uint64(0x9E3779B97F4A7C15)


# ---- packs and files -------------------------------------------------------


def freeze(**arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value, byte by byte, since sorted hashes and small
    numbers have like high bytes."""
    head = [(name, a.dtype.str, len(a)) for name, a in arrays.items()]
    body = [
        np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.dtype.itemsize).T).tobytes()
        for a in arrays.values()
    ]
    text = json.dumps(head).encode()
    return zstandard.compress(np.uint32(len(text)).tobytes() + text + b"".join(body), 1)


def thaw(value: bytes) -> dict[str, np.ndarray]:
    raw = zstandard.decompress(value)
    at = 4 + int(np.frombuffer(raw, "<u4", 1)[0])
    out = {}
    for name, kind, n in json.loads(raw[4:at]):
        kind = np.dtype(kind)
        part = np.frombuffer(raw, np.uint8, n * kind.itemsize, at)
        out[name] = np.ascontiguousarray(part.reshape(kind.itemsize, n).T).reshape(-1).view(kind)
        at += n * kind.itemsize
    return out


def _write(path: str, arrays: dict[str, np.ndarray]) -> None:
    """Write arrays to a file of the shared folder; it shows only when whole, and a
    repeated task puts the same in its place."""
    head = json.dumps([(n, a.dtype.str, len(a)) for n, a in arrays.items()]).encode()
    head = np.uint64(len(head)).tobytes() + head + b" " * (-len(head) % 8)
    store, name = fs.FileSystem.from_uri(path if urlparse(path).scheme else f"file://{path}")
    store.create_dir(os.path.dirname(name), recursive=True)
    part = f"{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(part) as f:
        f.write(head)
        for a in arrays.values():
            f.write(a.tobytes() + b"\0" * (-a.nbytes % 8))
    store.move(part, name)


def _open(path: str) -> dict[str, np.ndarray]:
    """The arrays of a file, mapped into memory where the folder is mounted."""
    store, name = fs.FileSystem.from_uri(path if urlparse(path).scheme else f"file://{path}")
    if isinstance(store, fs.LocalFileSystem):
        raw = np.memmap(name, np.uint8, "r")
    else:
        with store.open_input_file(name) as f:
            raw = np.frombuffer(f.read(), np.uint8)
    size = int(raw[:8].view("<u8")[0])
    at, out = 8 + size + -size % 8, {}
    for key, kind, n in json.loads(raw[8 : 8 + size].tobytes()):
        kind = np.dtype(kind)
        out[key] = raw[at : at + n * kind.itemsize].view(kind)
        at += n * kind.itemsize + -(n * kind.itemsize) % 8
    return out


def _short(keys: np.ndarray, name: str) -> dict[str, np.ndarray]:
    """Sorted hashes by their highest 48 bits: 32 of them, and where each value of
    the 16 above begins. A hash that is not there is found by mistake with a chance
    of one in a hundred million for a shard of some million."""
    top = (keys >> np.uint64(48)).astype(np.int64)
    return {
        f"{name}_at": np.searchsorted(top, np.arange(65537)).astype("<u4"),
        name: (keys >> np.uint64(16)).astype("<u4"),
    }


def _find(arrays: dict[str, np.ndarray], name: str, keys: np.ndarray) -> np.ndarray:
    """Place of each hash in a sorted array, -1 if it is not there."""
    low, index = arrays[name], arrays[f"{name}_at"]
    if not len(low):
        return np.full(len(keys), -1, np.int64)
    top, want = (keys >> np.uint64(48)).astype(np.int64), (keys >> np.uint64(16)).astype("<u4")
    a, end = index[top].astype(np.int64), index[top + 1].astype(np.int64)
    b = end.copy()
    while (open_ := a < b).any():
        mid = (a + b) // 2
        less = low[np.minimum(mid, len(low) - 1)] < want
        a, b = np.where(open_ & less, mid + 1, a), np.where(open_ & ~less, mid, b)
    found = (a < end) & (low[np.minimum(a, len(low) - 1)] == want)
    return np.where(found, a, -1)


# ---- runs of words ---------------------------------------------------------


def _route(first: np.ndarray, second: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    return _dealt(np.where(_is_hot(first, hot), _pair(first, second), mix(first)), shards)


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * _TWO + mix(second))


def _pairs(
    column: pa.Array, order: int = 2
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """(first text, first words, second words, text of each pair, words before the
    first one, nearest first), with begin and end."""
    for start, words, offsets in word_hashes(column, True):
        n = len(offsets) - 1
        sizes = np.diff(offsets)
        doc = np.repeat(np.arange(n), sizes + 1)
        ends = np.cumsum(sizes + 1) - 1
        second = np.empty(len(words) + n, np.uint64)
        inside = np.ones(len(second), bool)
        inside[ends] = False
        second[inside] = np.maximum(words, np.uint64(3))
        second[ends] = END
        first = np.empty(len(second), np.uint64)
        first[1:] = second[:-1]
        first[ends - sizes] = BEGIN
        before = [first]
        for _ in range(order - 2):
            last = np.empty(len(second), np.uint64)
            last[1:] = before[-1][:-1]
            last[ends - sizes] = BEGIN
            before.append(last)
        yield start, first, second, doc, before[1:]


def _runs(first: np.ndarray, second: np.ndarray, before: list[np.ndarray]) -> list[np.ndarray]:
    """Hashes of the runs of 2, 3, ... words."""
    out = [_pair(first, second)]
    for words in before:
        out.append(_pair(words, out[-1]))
    return out


def _contexts(first: np.ndarray, before: list[np.ndarray]) -> list[np.ndarray]:
    """Hashes of the contexts of 1, 2, ... words."""
    out = [mix(first)]
    for words in before:
        out.append(_pair(words, out[-1]))
    return out


def _is_hot(first: np.ndarray, hot: np.ndarray) -> np.ndarray:
    if not len(hot):
        return np.zeros(len(first), bool)
    return hot[np.minimum(np.searchsorted(hot, first), len(hot) - 1)] == first


def _dealt(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)


def _by_part(route: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """Places of the rows of each part that has any."""
    order = np.argsort(route.astype(np.uint16) if parts <= 65536 else route, kind="stable")
    bounds = np.searchsorted(route[order], np.arange(parts + 1)).tolist()
    for k in range(parts):
        if bounds[k] < bounds[k + 1]:
            yield k, order[bounds[k] : bounds[k + 1]]


def _narrow(values: np.ndarray) -> np.ndarray:
    return values.astype("<u2" if not len(values) or int(values.max()) < 65536 else "<u4")


def _slots(common: np.ndarray) -> np.ndarray:
    """Place of a frequent word by the lowest bits of its hash; of words that share these
    the most frequent one has it, and the others are not named by rank."""
    slots = np.zeros(int(_SLOTS) + 1, np.uint32)
    slots[(common & _SLOTS)[::-1]] = np.arange(len(common), dtype=np.uint32)[::-1]
    return slots


def _numbered(words: np.ndarray, common: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of words: ranks of frequent ones, then places among the others; and those, in order."""
    numbers = slots[words & _SLOTS]
    other = common[numbers] != words
    rest, place = np.unique(words[other], return_inverse=True)
    numbers[other] = len(common) + place
    return numbers, rest


def _named(numbers: np.ndarray, common: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """The words that ``_numbered`` gave these numbers."""
    numbers = numbers.astype(np.int64)
    out = common[np.minimum(numbers, len(common) - 1)]
    other = np.flatnonzero(numbers >= len(common))
    out[other] = rest[numbers[other] - len(common)]
    return out


def _pack(
    first: np.ndarray, second: np.ndarray, extra: np.ndarray, before: list[np.ndarray],
    common: np.ndarray, slots: np.ndarray,
) -> bytes:
    numbers, rest = _numbered(np.concatenate((first, second, *before)), common, slots)
    first, second, *before = numbers.reshape(-1, len(first))
    order = np.argsort(first.astype(np.int64) << 32 | second)
    first, second, extra = first[order], second[order], extra[order]
    new = np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1])))
    return freeze(
        words=rest,
        run=_narrow(np.diff(first[new].astype(np.int64), prepend=0)),
        size=_narrow(np.diff(new, append=len(first))),
        second=_narrow(second),
        extra=_narrow(extra),
        **{f"before{i}": _narrow(b[order]) for i, b in enumerate(before)},
    )


def _firsts(pack: dict[str, np.ndarray], common: np.ndarray) -> np.ndarray:
    return _named(np.cumsum(pack["run"], dtype=np.int64), common, pack["words"])


def _before(pack: dict[str, np.ndarray], common: np.ndarray) -> list[np.ndarray]:
    return [_named(pack[f"before{i}"], common, pack["words"]) for i in range(len(pack) - 5)]


def _unpack(value: bytes, common: np.ndarray) -> tuple[np.ndarray, ...]:
    """First and second words, counts, and the words before, of a pack."""
    pack = thaw(value)
    first, second = np.repeat(_firsts(pack, common), pack["size"]), _named(pack["second"], common, pack["words"])
    return first, second, pack["extra"].astype(np.int64), *_before(pack, common)


def _sum_by(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, the place of one row of each, and sums."""
    order = np.argsort(keys)
    ordered = keys[order]
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(keys) else np.zeros(0, int)
    sums = tuple(np.add.reduceat(v[order], starts) if len(starts) else v[:0] for v in values)
    return ordered[starts], order[starts], *sums


def _head(batch: pa.RecordBatch, start: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """doc_id (0 for null) of some rows, and flags: 1 held out, 2 not known to be, 4 no doc_id."""
    ids, held = batch["doc_id"].slice(start, n), batch["held_out"].slice(start, n)
    flags = held.fill_null(False).to_numpy(zero_copy_only=False).astype(np.uint8)
    flags += 2 * held.is_null().to_numpy(zero_copy_only=False).astype(np.uint8)
    flags += 4 * ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8)
    return ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), flags


def _deal(shards: int, hot: np.ndarray, training: bool, length: int, common: Broadcast):
    """Packs of runs of ``length`` words by shard: counted ones of the training texts, or each with
    its text for scoring. Then a pack of the texts' doc_id and held_out by place
    goes with them, under a shard below 0 of its own."""

    def close(flush: int, texts: list, heads: list, slots: np.ndarray) -> pa.RecordBatch:
        first, second, doc, *before = map(np.concatenate, zip(*texts, strict=True))
        if training:
            _, at, doc = _sum_by(_runs(first, second, before)[-1], np.ones(len(first), np.int64))
            first, second, before = first[at], second[at], [b[at] for b in before]
        packs = [
            (k, _pack(first[own], second[own], doc[own], [b[own] for b in before], common.value, slots))
            for k, own in _by_part(_route(first, second, hot, shards), shards)
        ]
        if heads:
            ids, flags = map(np.concatenate, zip(*heads, strict=True))
            packs.append((-1 - flush, freeze(doc_id=ids, flags=flags)))
        return pa.RecordBatch.from_pydict(
            {
                "shard": pa.array([k for k, _ in packs], pa.int64()),
                "flush": pa.array([flush] * len(packs), pa.int64()),
                "pack": pa.array([p for _, p in packs], pa.binary()),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, serial, size, texts = TaskContext.get().partitionId() << 32, 0, 0, 0
        found, heads, slots = [], [], _slots(common.value)
        for batch in batches:
            for start, first, second, doc, before in _pairs(batch["text"], length):
                n = int(doc[-1]) + 1
                found.append((first, second, doc + texts, *before))
                if not training:
                    heads.append(_head(batch, start, n))
                size, texts = size + len(first), texts + n
                if size >= FLUSH_TOKENS or texts >= FLUSH_TEXTS:
                    yield close(task + serial, found, heads, slots)
                    serial, size, texts = serial + 1, 0, 0
                    found, heads = [], []
        if found:
            yield close(task + serial, found, heads, slots)

    return run


# ---- counting --------------------------------------------------------------


@dataclass
class Model:
    """Where the arrays lie, and the few numbers that concern all shards."""

    path: str
    shards: int
    vocabulary_shards: int
    order: int = 2
    hot: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    #: Frequent words, the most frequent first.
    common: Broadcast | None = None
    hot_totals: dict[int, tuple[int, int, int, int]] = field(default_factory=dict)
    #: Discounts of the runs of 2, 3, ... words.
    discounts: list[tuple[float, float, float]] = field(default_factory=list)
    word_discounts: tuple[float, float, float] = (0.5, 1.0, 1.5)
    tokens: int = 0
    words: int = 0
    pairs: int = 0
    word_classes: tuple[int, int, int] = (0, 0, 0)
    #: Names of the files that were written; one that cannot be read is an error.
    files: frozenset[str] = frozenset()


def _frequent(docs: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """Words that are frequent beyond a shard's share, the ``COMMON`` most frequent words
    or a few less, with begin and end, and all tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts, size, total = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0, 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            own, _, n = _sum_by(np.concatenate(words), np.concatenate(counts))
            if len(own) > 4 * COMMON:
                kept = np.argpartition(n, -4 * COMMON)[-4 * COMMON :]
                own, n = own[kept], n[kept]
            return own, n

        for batch in batches:
            for _, first, *_ in _pairs(batch["text"]):
                total += len(first)
                own, _, n = _sum_by(first, np.ones(len(first), np.int64))
                words.append(own)
                counts.append(n)
                size += len(own)
                if size >= 8 * COMMON:
                    own, n = merged()
                    words, counts, size = [own], [n], len(own)
        own, n = merged()
        # a word seen once in a task is neither frequent nor common
        own, n = own[n > 1], n[n > 1]
        yield pa.RecordBatch.from_pydict(
            {
                "word": pa.array(np.concatenate(([0], own.view(np.int64))), pa.int64()),
                "n": pa.array(np.concatenate(([total], n)), pa.int64()),
            }
        )

    counted = docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = stored(counted, "word-counts").withColumn("size", F.floor(F.log2("n") * 8))
    total = found.where("word = 0").agg(F.sum("n")).first()[0] or 0
    least = HOT_SHARE * min(SHARD_TOKENS, max(total, 1))
    words = found.where("word <> 0")
    # at most total / least words
    rows = words.where(F.col("n") >= least).collect() if total > SHARD_TOKENS else []
    hot = np.sort(np.array([r["word"] for r in rows], np.int64).view(np.uint64))
    inner, room, bound = words.where(F.col("word") != int(BEGIN)), COMMON, None
    for size, n in inner.groupBy("size").agg(F.count("*")).orderBy(F.desc("size")).collect():  # a few hundred
        room -= n
        if room < 0:
            break
        bound = size
    common = inner.where(F.col("size") >= F.lit(bound)).select("word", "n").toArrow()
    word, n = (common[c].to_numpy() for c in ("word", "n"))
    common = np.concatenate(([BEGIN, END], word[np.lexsort((word, -n))].view(np.uint64)))
    return hot, common, total


def _context_arrays(keys: np.ndarray, stats: list[np.ndarray], n: int) -> dict[str, np.ndarray]:
    """Sorted contexts of one length with total and numbers of runs seen once, twice
    and more; those with one run that was seen once are kept apart."""
    plain = (stats[0] == 1) & (stats[1] == 1)
    return (
        _short(keys[plain], f"once{n}")
        | _short(keys[~plain], f"word{n}")
        | {f"{c}_{n}": v[~plain].astype("<u4") for c, v in zip(("total", "n1", "n2", "n3"), stats, strict=True)}
    )


def _levels(columns: tuple[np.ndarray, ...], hot: np.ndarray) -> Iterator[tuple]:
    """By length, the longest first, of a shard's runs: (length, distinct runs as columns,
    arrays for lookups, counts, and hash, last word and numbers of contexts that end in
    hot words). Then (1, last words with kinds and uses)."""
    first, second, count, *before = columns
    del columns
    length = len(before) + 2
    uses, keys = count, _runs(first, second, before)[-1]
    for n in range(length, 1, -1):
        keys, at, count, uses = _sum_by(keys, count, uses)
        first, second, before = first[at], second[at], [b[at] for b in before[: n - 2]]
        # runs of begins are only there for shorter runs
        real = np.ones(len(keys), bool) if n == 2 else ~((before[-1] == BEGIN) & ([first, *before][-2] == BEGIN))
        context, own = _contexts(first, before)[-1][real], count[real]
        single = own == 1
        arrays = (
            _short(keys[real][single], f"single{n}")
            | _short(keys[real][~single], f"many{n}")
            | {f"many_n{n}": own[~single].astype("<u4")}
        )
        kinds = [(own == 1).astype(np.int64), (own == 2).astype(np.int64), (own > 2).astype(np.int64)]
        context, at, *stats = _sum_by(context, own, *kinds)
        ends = first[real][at]
        is_hot = _is_hot(ends, hot)
        arrays |= _context_arrays(context[~is_hot], [x[~is_hot] for x in stats], n)
        ending = context[is_hot], ends[is_hot], [x[is_hot] for x in stats]
        yield n, (first, second, count, *before), arrays, own, ending
        # a shorter run counts the words before it; at the begin of a text, its uses
        keys = _runs(first, second, before)[n - 3] if n > 2 else second
        count = np.where([first, *before][n - 3] == BEGIN, uses, 1) if n > 2 else np.ones(len(second), np.int64)
    yield 1, (second, count, uses), {}, None, None


def _count(path: str, hot: np.ndarray, parts: int, length: int, common: Broadcast):
    """Count a shard's runs and write them; gives packs of second words, of
    longer contexts that end in hot words, and the shard's numbers."""

    def run(rows: pa.Table) -> pa.Table:
        shard = rows["shard"][0].as_py()
        columns = zip(*(_unpack(value, common.value) for value in rows["pack"].to_pylist()), strict=True)
        numbers, totals, out = [], [], []
        for n, runs, _, own, ending in _levels(tuple(map(np.concatenate, columns)), hot):
            if n == 1:
                second, count, uses = runs
                break
            if n == length:
                first, second, count, *before = runs
                pack = _pack(first, second, count, before, common.value, _slots(common.value))
                _write(f"{path}/pairs-{shard}", {"runs": np.frombuffer(pack, np.uint8)})
                del first, second, count, before, pack
            del runs
            context, ends, stats = ending
            if n == 2:
                totals = [[int(word), *(int(x[i]) for x in stats)] for i, word in enumerate(ends)]
            else:
                for k, at in _by_part(_dealt(context, parts), parts):
                    values = {c: _narrow(x[at]) for c, x in zip(("total", "n1", "n2", "n3"), stats, strict=True)}
                    out.append(((n - 2) * parts + k, freeze(words=context[at], **values)))
            numbers.append([int((own == k).sum()) for k in (1, 2, 3, 4)])
        out.append((-1, json.dumps([f"pairs-{shard}", numbers[::-1], totals]).encode()))
        seen, _, kinds, uses = _sum_by(second, count, uses)
        for k, own in _by_part(_dealt(mix(seen), parts), parts):
            out.append((k, freeze(words=seen[own], kinds=_narrow(kinds[own]), uses=_narrow(uses[own]))))
        return pa.table(
            {"part": pa.array([k for k, _ in out], pa.int32()), "pack": pa.array([p for _, p in out], pa.binary())}
        )

    return run


def _vocabulary(path: str, parts: int):
    """Write one part of the vocabulary, or of the longer contexts that end in hot
    words; gives the vocabulary's numbers."""

    def run(rows: pa.Table) -> pa.Table:
        packs = [thaw(v) for v in rows["pack"].to_pylist()]
        words = np.concatenate([p["words"] for p in packs])
        n, part = divmod(rows["part"][0].as_py(), parts)
        names = ("total", "n1", "n2", "n3") if n else ("kinds", "uses")
        words, _, *values = _sum_by(words, *(np.concatenate([p[c].astype(np.int64) for p in packs]) for c in names))
        if n:
            _write(f"{path}/hot{n + 2}-{part}", _context_arrays(words, values, n + 2))
            return pa.table({f"v{i}": pa.array([0], pa.int64()) for i in range(7)})
        kinds, uses = values
        once = (kinds == 1) & (uses == 1)
        _write(
            f"{path}/words-{part}",
            {
                "once": words[once].astype("<u8"),
                "word": words[~once].astype("<u8"),
                "kinds": kinds[~once].astype("<u4"),
                "uses": uses[~once].astype("<u8"),
            },
        )
        numbers = [int((kinds == k).sum()) for k in (1, 2, 3, 4)]
        columns = [len(words), int(uses.sum()), int(kinds.sum()), *numbers]
        return pa.table({f"v{i}": pa.array([v], pa.int64()) for i, v in enumerate(columns)})

    return run


def _discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and more, from how many there
    are of counts 1 to 4; half a count each step where those are too few to tell."""
    n1, n2, n3, n4 = n
    if not (n1 and n2 and n3 and n4):
        return (0.5, 1.0, 1.5)
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.01), k - 0.01) for k, d in enumerate(found, 1))


def fit(docs: DataFrame, path: str, order: int = 2) -> Model:
    """Count the runs of up to ``order`` words of all texts of ``docs`` and write the
    arrays under ``path``."""
    if order < 2:
        raise ValueError(f"the order is 2 at least, not {order}")
    path = qualified(docs.sparkSession, path)
    texts = docs.select(F.col("text").cast("string").alias("text"))
    hot, common, total = _frequent(texts)
    shards = shards_for(total * (order - 1), SHARD_TOKENS)  # runs of each length
    parts = shards_for(shards, 8)  # there are far fewer words
    common = docs.sparkSession.sparkContext.broadcast(common)
    if not total:
        return Model(path, 0, 0, order, common=common)
    counted = stored(
        texts.mapInArrow(_deal(shards, hot, True, order, common), "shard long, flush long, pack binary")
        .groupBy("shard")
        .applyInArrow(_count(path, hot, parts, order, common), "part int, pack binary"),
        "pair-counts",
    )
    run_n, totals, files = np.zeros((order - 1, 4), np.int64), {}, set()
    for row in counted.where("part < 0").collect():  # one row for each shard
        name, numbers, words = json.loads(bytes(row["pack"]))
        files.add(name)
        run_n += np.array(numbers)
        for word, *values in words:
            totals[word] = tuple(a + b for a, b in zip(totals.get(word, (0, 0, 0, 0)), values, strict=True))
    schema = ", ".join(f"v{i} long" for i in range(7))
    numbers = (
        counted.where("part >= 0")
        .groupBy("part")
        .applyInArrow(_vocabulary(path, parts), schema)
        .agg(*(F.sum(f"v{i}").alias(f"v{i}") for i in range(7)))
        .first()
    )
    for row in counted.where("part >= 0").select("part").distinct().collect():  # a file for each
        n, part = divmod(row["part"], parts)
        files.add(f"hot{n + 2}-{part}" if n else f"words-{part}")
    words, tokens, pairs, *word_n = (int(x) for x in numbers)
    classes = (word_n[0], word_n[1], words - word_n[0] - word_n[1])
    discounts = [_discounts(n) for n in run_n.tolist()]
    return Model(
        path, shards, parts, order, hot, common, totals, discounts, _discounts(word_n), tokens, words, pairs, classes,
        frozenset(files),
    )


# ---- scoring ---------------------------------------------------------------


def _discount(count: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(count, 3)]


class _Lookup:
    """One shard of the model as arrays, and the vocabulary as mapped ones."""

    def __init__(self, model: Model, shard: int):
        self.model = model
        # without a file no training text has a pair of this shard
        written, self.pairs = self._file(f"pairs-{shard}"), None
        if written is not None:
            levels = _levels(_unpack(written["runs"].tobytes(), model.common.value), model.hot)
            self.pairs = {name: a for _, _, arrays, *_ in levels for name, a in arrays.items()}
        self.words = {}

    def _file(self, name: str) -> dict[str, np.ndarray] | None:
        return _open(f"{self.model.path}/{name}") if name in self.model.files else None

    def _part(self, k: int, kind: str = "words") -> dict[str, np.ndarray] | None:
        if (kind, k) not in self.words:
            self.words[kind, k] = self._file(f"{kind}-{k}")
        return self.words[kind, k]

    def vocabulary(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Kinds of first words before each word, and its uses, in training."""
        kinds, uses = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        if not self.model.shards:
            return kinds, uses
        route = ((mix(words) >> np.uint64(20)) % np.uint64(self.model.vocabulary_shards)).astype(np.int64)
        for k in np.unique(route).tolist():
            part, own = self._part(k), np.flatnonzero(route == k)
            if part is None:
                continue
            for name in ("once", "word"):
                keys = part[name]
                if not len(keys):
                    continue
                at = np.minimum(np.searchsorted(keys, words[own]), len(keys) - 1)
                hit = keys[at] == words[own]
                kinds[own[hit]] = 1 if name == "once" else part["kinds"][at[hit]]
                uses[own[hit]] = 1 if name == "once" else part["uses"][at[hit]]
        return kinds, uses

    def contexts(self, n: int, keys: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """total, n1, n2, n3 of contexts of runs of n words, given their hashes and
        last words; zeros if they were never one."""
        out = np.zeros((len(keys), 4), np.int64)
        if self.pairs is not None:
            self._fill(out, self.pairs, n, keys, np.arange(len(keys)))
        if n == 2:
            for word, values in self.model.hot_totals.items():
                out[ends == np.uint64(word)] = values
        elif self.model.shards:
            some = np.flatnonzero(_is_hot(ends, self.model.hot))
            for k, own in _by_part(_dealt(keys[some], self.model.vocabulary_shards), self.model.vocabulary_shards):
                part = self._part(k, f"hot{n}")
                if part is not None:
                    self._fill(out, part, n, keys[some[own]], some[own])
        return out

    @staticmethod
    def _fill(out: np.ndarray, arrays: dict[str, np.ndarray], n: int, keys: np.ndarray, rows: np.ndarray) -> None:
        once = _find(arrays, f"once{n}", keys) >= 0
        out[rows[once]] = (1, 1, 0, 0)
        keys, rows = keys[~once], rows[~once]
        at = _find(arrays, f"word{n}", keys)
        rows, at = rows[at >= 0], at[at >= 0]
        for i, name in enumerate(("total", "n1", "n2", "n3")):
            out[rows, i] = arrays[f"{name}_{n}"][at]

    def counts(self, n: int, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), np.int64)
        if self.pairs is not None:
            single = _find(self.pairs, f"single{n}", keys) >= 0
            out[single] = 1
            rest = np.flatnonzero(~single)
            at = _find(self.pairs, f"many{n}", keys[rest])
            out[rest[at >= 0]] = self.pairs[f"many_n{n}"][at[at >= 0]]
        return out

    def score(self, value: bytes) -> tuple[np.ndarray, ...]:
        """Per text of a pack: place, tokens, known ones, base and model scores."""
        m, common = self.model, self.model.common.value
        pack = thaw(value)
        runs, size = _firsts(pack, common), pack["size"].astype(np.int64)
        seen, second = np.unique(pack["second"], return_inverse=True)
        words = _named(seen, common, pack["words"])
        kinds, uses = self.vocabulary(words)
        base = np.log10((uses + 0.1) / (m.tokens + 0.1 * (m.words + 1)))
        d = m.word_discounts
        left = sum(x * n for x, n in zip(d, m.word_classes, strict=True))
        chance = (
            (kinds - np.minimum(_discount(kinds, d), kinds) + left / (m.words + 1)) / m.pairs
            if m.pairs
            else np.ones(len(words))
        )
        p, first, last = chance[second], np.repeat(runs, size), words[second]
        before = _before(pack, common)
        run, context = _runs(first, last, before), _contexts(first, before)
        for n, d in enumerate(m.discounts, 2):
            stats = (
                np.repeat(self.contexts(2, context[0][np.cumsum(size) - size], runs), size, axis=0)
                if n == 2
                else self.contexts(n, context[n - 2], first)
            )
            total, count = stats[:, 0], self.counts(n, run[n - 2])
            found = (count - _discount(count, d) + stats[:, 1:] @ np.array(d) * p) / np.maximum(total, 1)
            p = np.where(total > 0, found, p)
        doc = pack["extra"].astype(np.int64)
        n = int(doc.max()) + 1
        tokens = np.bincount(doc, minlength=n)
        place = np.flatnonzero(tokens)
        sums = (np.bincount(doc, w, minlength=n)[place] for w in ((uses > 0)[second], base[second], np.log10(p)))
        known, base_sum, score = sums
        return place, tokens[place], known.astype(np.int64), base_sum, score


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, base_score, score of every row.

    Both scores are sums of base-10 logarithms over the words and the end. Null and
    empty texts have the end alone. Repeated rows and rows without doc_id are
    scored like others. Without training texts every token has the same chance
    in the base score and a chance of 1 in the model's.
    """
    texts = docs.select("doc_id", "held_out", F.col("text").cast("string").alias("text"))
    shards = max(1, model.shards)
    each = shards_for(shards, GROUPS)

    def summed(flush: int, found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        place, *values = map(np.concatenate, zip(*found, strict=True))
        if len(found) > 1:
            place, _, *values = _sum_by(place, *values)
        tokens, known, base, own = values
        pack = freeze(place=_narrow(place), tokens=_narrow(tokens), known=_narrow(known), base=base, own=own)
        return pa.RecordBatch.from_pydict({"flush": [flush], "pack": [pack], "head": [False]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of a flush's packs of a group of shards; packs come by group, then by flush."""
        group, flush, lookups, found = None, None, {}, []
        for batch in batches:
            for its_group, its_flush, shard, pack in zip(*(batch[c] for c in ("group", "flush", "shard", "pack")), strict=True):
                key = its_group.as_py(), its_flush.as_py()
                if found and key != (group, flush):
                    yield summed(flush, found)
                    found = []
                if key[0] != group:
                    lookups = {}
                (group, flush), shard, value = key, shard.as_py(), pack.as_py()
                if shard < 0:  # doc_id and held_out of a flush
                    yield pa.RecordBatch.from_pydict({"flush": [flush], "pack": [value], "head": [True]})
                    continue
                if shard not in lookups:
                    lookups[shard] = _Lookup(model, shard)
                found.append(lookups[shard].score(value))
        if found:
            yield summed(flush, found)

    def add(rows: pa.Table) -> pa.Table:
        packs = [(h.as_py(), thaw(v.as_py())) for h, v in zip(rows["head"], rows["pack"], strict=True)]
        (head,) = (p for h, p in packs if h)
        packs = [p for h, p in packs if not h]
        place = np.concatenate([p["place"] for p in packs]).astype(np.int64)
        flags, n = head["flags"], len(head["doc_id"])
        tokens, known, base, own = (
            np.bincount(place, np.concatenate([p[c] for p in packs]), minlength=n) for c in ("tokens", "known", "base", "own")
        )
        return pa.table(
            {
                "doc_id": pa.array(head["doc_id"], pa.int64(), mask=flags & 4 > 0),
                "held_out": pa.array(flags & 1 > 0, pa.bool_(), mask=flags & 2 > 0),
                "n_tokens": pa.array(tokens.astype(np.int64), pa.int64()),
                "n_known": pa.array(known.astype(np.int64), pa.int64()),
                "base_score": pa.array(base, pa.float64()),
                "score": pa.array(own, pa.float64()),
            }
        )

    dealt = texts.mapInArrow(
        _deal(shards, model.hot, False, model.order, model.common), "shard long, flush long, pack binary"
    )
    return (
        dealt.withColumn("group", F.floor(F.col("shard") / each))
        .repartition("group")
        .sortWithinPartitions("group", "flush", "shard")
        .mapInArrow(run, "flush long, pack binary, head boolean")
        .groupBy("flush")
        .applyInArrow(
            add, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
        )
    )


def score_documents(docs: DataFrame, held_out, order: int = 2) -> DataFrame:
    """Learn runs of up to ``order`` words from the rows for which ``held_out`` is not
    true, and score every row.

    Adds train_tokens, the tokens learned from. See ``score`` for odd rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out.alias("held_out"))
    model = fit(docs.where(~F.coalesce("held_out", F.lit(False))), scratch(docs.sparkSession, "kneser-ney"), order)
    return score(docs, model).withColumn("train_tokens", F.lit(model.tokens).cast("long"))
