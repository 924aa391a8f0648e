"""Byte-level BPE over distinct words, and decoding by the token-byte table.

A block is a run of documents of one input task. It is cut into pre-tokens; the
block keeps the positions as one sequence of local word numbers, and sends each
of its distinct words once, in packs by hash, to the task that encodes every
distinct word of the corpus a single time. The ids come back to the block, which
puts them in place by position. A word as frequent as it may be is one entry in
each block, so no key is hot, and text itself is never shuffled.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.bpe import merger, pre_tokens, ranks_of
from aerolake.llm.common import parts, scratch

#: Pre-tokens after which a block is closed; a document is never divided.
BLOCK_PIECES = 1_500_000
_HEAD = np.dtype([("doc_id", "<i8"), ("known", "?"), ("pieces", "<i8")])


class _Numbers(dict):
    """Numbers words in the order they come."""

    def __missing__(self, word):
        self[word] = number = len(self)
        return number


def _pack(words: list[bytes]) -> bytes:
    sizes = np.fromiter(map(len, words), "<u4", len(words))
    return zstandard.compress(np.uint32(len(words)).tobytes() + sizes.tobytes() + b"".join(words), 1)


def _unpack(pack: bytes) -> list[bytes]:
    raw = zstandard.decompress(pack)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    ends = np.cumsum(np.frombuffer(raw, "<u4", n, 4), dtype=np.int64) + 4 + 4 * n
    starts = np.concatenate(([4 + 4 * n], ends[:-1])) if n else ends
    return [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


#: Ranks below the first take one byte, below the second two, others five.
_ONE, _TWO = 192, 192 + 63 * 256


def _write_ranks(ranks: np.ndarray) -> bytes:
    """Numbers, mostly small, as streams of first, second and further bytes."""
    two, more = (ranks >= _ONE) & (ranks < _TWO), ranks >= _TWO
    first = np.where(two, _ONE + (ranks - _ONE >> 8), np.where(more, 255, ranks)).astype(np.uint8)
    second = (ranks[two] - _ONE & 255).astype(np.uint8)
    rest = ranks[more].astype("<u4")
    return np.array([len(ranks), len(second)], "<u8").tobytes() + first.tobytes() + second.tobytes() + rest.tobytes()


def _read_ranks(raw: bytes) -> np.ndarray:
    n, m = (int(x) for x in np.frombuffer(raw, "<u8", 2))
    ranks = np.frombuffer(raw, np.uint8, n, 16).astype(np.int64)
    two, more = (ranks >= _ONE) & (ranks < 255), ranks == 255
    ranks[two] = (ranks[two] - _ONE << 8) + np.frombuffer(raw, np.uint8, m, 16 + n) + _ONE
    ranks[more] = np.frombuffer(raw[16 + n + m :], "<u4")
    return ranks


def spread(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """values[starts[i] : starts[i] + sizes[i]] for all i, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.arange(total) + np.repeat(starts - (ends - sizes), sizes)]


def _blocks(buckets: int):
    """Cut the documents of a task into blocks; rows of kind "words" and "places"."""

    def close(block: int, numbers: _Numbers, places: list, heads: list) -> pa.RecordBatch:
        line = np.concatenate(places) if places else np.zeros(0, np.uint32)
        names = list(numbers)
        by_use = np.argsort(-np.bincount(line, minlength=len(names)), kind="stable")
        rank = np.empty(len(names), np.int64)
        rank[by_use] = np.arange(len(names))
        words = [names[i].encode() for i in by_use]
        at = np.fromiter((zlib.crc32(w) % buckets for w in words), "<u4", len(words))
        order = np.argsort(at, kind="stable")  # within a pack words keep their order
        bounds = np.searchsorted(at[order], np.arange(buckets + 1))
        packs = []
        for k in range(buckets):
            if bounds[k] < bounds[k + 1]:
                packs.append((k, _pack([words[i] for i in order[bounds[k] : bounds[k + 1]]])))
        head = np.array(heads, _HEAD).tobytes()
        payload = np.array([len(head), len(at)], "<u8").tobytes() + head + at.tobytes() + _write_ranks(rank[line])
        return pa.RecordBatch.from_pydict(
            {
                "block": pa.array([block] * (1 + len(packs)), pa.int64()),
                "bucket": pa.array([-1, *(k for k, _ in packs)], pa.int32()),
                "payload": pa.array([zstandard.compress(payload, 1), *(p for _, p in packs)], pa.binary()),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        serial, size = 0, 0
        numbers, places, heads = _Numbers(), [], []
        for batch in batches:
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                pieces = pre_tokens(text or "")
                places.append(np.fromiter(map(numbers.__getitem__, pieces), np.uint32, len(pieces)))
                heads.append((doc or 0, doc is not None, len(pieces)))
                size += len(pieces)
                if size >= BLOCK_PIECES:
                    yield close(task + serial, numbers, places, heads)
                    serial, size = serial + 1, 0
                    numbers, places, heads = _Numbers(), [], []
        if heads:
            yield close(task + serial, numbers, places, heads)

    return run


def _encode_words(path: str):
    """Encode the words of the buckets a task holds; each distinct word once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        core, known = merger(ranks_of(path)), {}
        for batch in batches:
            packs = []
            for pack in batch["payload"].to_pylist():
                found = []
                for word in _unpack(pack):
                    ids = known.get(word)
                    if ids is None:
                        ids = np.array(core._encode_single_piece(word), "<u4").tobytes()
                        known[word] = ids
                    found.append(ids)
                packs.append(_pack(found))
            yield pa.RecordBatch.from_pydict(
                {
                    "block": batch["block"].cast(pa.int64()),
                    "bucket": batch["bucket"].cast(pa.int32()),
                    "payload": pa.array(packs, pa.binary()),
                }
            )

    return run


def _reassemble(own: pa.Table, encoded: pa.Table) -> pa.Table:
    """Ids of the documents of one block."""
    sizes, ids = [np.zeros(0, np.int64)], [np.zeros(0, "<u4")]
    for _, pack in sorted(zip(encoded["bucket"].to_pylist(), encoded["payload"].to_pylist(), strict=True)):
        raw = zstandard.decompress(pack)
        n = int(np.frombuffer(raw, "<u4", 1)[0])
        sizes.append(np.frombuffer(raw, "<u4", n, 4).astype(np.int64) // 4)
        ids.append(np.frombuffer(raw, "<u4", -1, 4 + 4 * n))
    sizes, ids = np.concatenate(sizes), np.concatenate(ids)
    starts = np.cumsum(sizes) - sizes
    raw = zstandard.decompress(own["payload"][0].as_py())
    head_size, words = (int(x) for x in np.frombuffer(raw, "<u8", 2))
    heads = np.frombuffer(raw[16 : 16 + head_size], _HEAD)
    at = np.frombuffer(raw, "<u4", words, 16 + head_size)
    place = np.empty(words, np.int64)  # of each word, in the order of the packs
    place[np.argsort(at, kind="stable")] = np.arange(words)
    line = place[_read_ranks(raw[16 + head_size + 4 * words :])]
    out, at = [], 0
    for n in heads["pieces"].tolist():
        pieces = line[at : at + n]
        out.append(spread(ids, starts[pieces], sizes[pieces]).tobytes())
        at += n
    return pa.table(
        {
            "doc_id": pa.array(heads["doc_id"], pa.int64(), mask=~heads["known"]),
            "n_tokens": pa.array([len(x) // 4 for x in out], pa.int64()),
            "ids": pa.array(out, pa.binary()),
        }
    )


def encode(docs: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) of every row.

    A null or empty text has no ids; special strings are ordinary text; repeated
    rows and null doc_ids give a row each; other columns are not looked at.
    """
    spark = docs.sparkSession
    buckets = parts(spark)
    schema = "block long, bucket int, payload binary"
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    name = f"bpe_blocks_{uuid.uuid4().hex}"
    (
        own.mapInArrow(_blocks(buckets), schema)
        .write.option("path", scratch(spark, "bpe-blocks"))
        .option("compression", "zstd")
        .bucketBy(buckets, "block")
        .saveAsTable(name)
    )
    cut = spark.table(name)
    words = (
        cut.where("bucket >= 0")
        .repartition(buckets, "bucket")
        .mapInArrow(_encode_words(ranks_path), schema)
    )
    return (
        cut.where("bucket < 0")
        .groupBy("block")
        .cogroup(words.groupBy("block"))
        .applyInArrow(_reassemble, "doc_id long, n_tokens long, ids binary")
    )


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """Add ``decoded``: the bytes of each row's ids, joined from the token-byte table.

    The table has one row per token of the vocabulary, which the rank file fixes
    (some 50,000), so each task holds it whole as one run of bytes with offsets.
    An id beyond the table raises. Null ids give null bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = ranks_of(ranks_path)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            tokens[i] = token
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        starts, data = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(tokens), np.uint8)
        for batch in batches:
            texts = []
            for ids in batch["ids"].to_pylist():
                at = np.frombuffer(ids or b"", "<u4")
                texts.append(None if ids is None else spread(data, starts[at], sizes[at]).tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.binary())], [*batch.schema.names, "decoded"]
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(run, f"{fields}, decoded binary")
