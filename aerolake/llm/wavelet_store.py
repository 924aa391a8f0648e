"""Token ids in wavelet matrices, one compressed file image per shard.

A shard holds the ids of consecutive documents as bit planes, highest bit first,
each plane the stable partition of the one above, with ranks at fixed distances.
From it any token, any count and any occurrence is answered without unpacking.
Shards are rows of a Parquet table, so they are committed, listed and recovered
like any Spark output, on any file system.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerolake.llm.bpe import ByteLevel, loaded
from aerolake.llm.common import map_arrow, parts, tune

#: Tokens after which a shard is closed; a document is never divided.
SHARD_TOKENS = 2_000_000
#: Bits between stored ranks.
STEP = 512
END_ID = 0
_MAGIC = b"WVM1"


class Plane:
    """Bits with rank and select."""

    def __init__(self, words: np.ndarray, size: int, ranks: np.ndarray | None = None):
        self.words, self.size = words, size  # 64-bit words
        if ranks is None:
            ones = np.bitwise_count(words).reshape(-1, STEP // 64).sum(axis=1, dtype=np.int64)
            ranks = np.concatenate(([0], np.cumsum(ones))).astype("<u4")
        self.ranks = ranks

    @classmethod
    def of(cls, bits: np.ndarray) -> Plane:
        padded = np.zeros(-(-max(len(bits), 1) // STEP) * STEP // 8, np.uint8)
        packed = np.packbits(bits, bitorder="little")
        padded[: len(packed)] = packed
        return cls(padded.view("<u8"), len(bits))

    def bits(self) -> np.ndarray:
        return np.unpackbits(self.words.view(np.uint8), bitorder="little")[: self.size].view(bool)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)).astype(np.int64) & 1

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        at = np.asarray(at, np.int64)
        block = at // STEP
        total = self.ranks[block].astype(np.int64)
        word, last = block * (STEP // 64), at >> 6
        for k in range(STEP // 64):
            whole = word + k < last
            if not whole.any():
                break
            total += np.where(whole, np.bitwise_count(self.words[np.minimum(word + k, len(self.words) - 1)]), 0)
        rest = (at & 63).astype(np.uint64)
        part = self.words[np.minimum(last, len(self.words) - 1)] & ((np.uint64(1) << rest) - np.uint64(1))
        return total + np.bitwise_count(part)

    def select(self, k: np.ndarray, one: bool) -> np.ndarray:
        """Place of the k-th (from 0) one, or zero, by halving over ranks."""
        k = np.asarray(k, np.int64)
        low, high = np.zeros_like(k), np.full_like(k, self.size)
        while (low < high).any():
            mid = (low + high) // 2
            ones = self.rank(mid + 1)
            have = ones if one else mid + 1 - ones
            enough = have > k
            high, low = np.where(enough & (low < high), mid, high), np.where(~enough & (low < high), mid + 1, low)
        return low


class WaveletMatrix:
    """A sequence of ids below 2 ** len(planes)."""

    def __init__(self, size: int, planes: list[Plane], zeros: list[int]):
        self.size, self.planes, self.zeros = size, planes, zeros

    @classmethod
    def of(cls, ids: np.ndarray, width: int) -> WaveletMatrix:
        rest = ids.astype(np.uint16 if width <= 16 else np.uint32)
        planes, zeros = [], []
        for level in range(width - 1, -1, -1):
            bits = (rest >> level) & 1 != 0
            planes.append(Plane.of(bits))
            low = rest[~bits]
            zeros.append(len(low))
            rest = np.concatenate((low, rest[bits]))
        return cls(len(ids), planes, zeros)

    def to_bytes(self) -> bytes:
        head = np.array([self.size, len(self.planes), *self.zeros], "<u8").tobytes()
        body = b"".join(p.words.tobytes() + p.ranks.tobytes() for p in self.planes)
        return head + body

    @classmethod
    def from_bytes(cls, data: memoryview | bytes) -> WaveletMatrix:
        size, width = (int(x) for x in np.frombuffer(data, "<u8", 2))
        zeros = np.frombuffer(data, "<u8", width, 16).astype(int).tolist()
        at, planes = 16 + 8 * width, []
        blocks = -(-max(size, 1) // STEP)
        for _ in range(width):
            words = np.frombuffer(data, "<u8", blocks * STEP // 64, at)
            at += words.nbytes
            ranks = np.frombuffer(data, "<u4", blocks + 1, at)
            at += ranks.nbytes
            planes.append(Plane(words, size, ranks))
        return cls(size, planes, zeros)

    def all(self) -> np.ndarray:
        """The whole sequence, plane by plane from the lowest."""
        low = np.zeros(self.size, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for level, (plane, z) in enumerate(zip(self.planes[::-1], self.zeros[::-1], strict=True)):
            bits = plane.bits()
            here = np.empty_like(low)
            here[~bits] = low[:z]
            here[bits] = low[z:] | low.dtype.type(1 << level)
            low = here
        return low

    def access(self, at: np.ndarray) -> np.ndarray:
        """The ids at these places."""
        at, value = np.asarray(at, np.int64), 0
        for plane, z in zip(self.planes, self.zeros, strict=True):
            bit, ones = plane.get(at), plane.rank(at)
            at = np.where(bit == 1, z + ones, at - ones)
            value = value << 1 | bit
        return value

    def _path(self, token: int, at: np.ndarray) -> np.ndarray:
        for i, (plane, z) in enumerate(zip(self.planes, self.zeros, strict=True)):
            ones = plane.rank(at)
            at = z + ones if token >> (len(self.planes) - 1 - i) & 1 else at - ones
        return at

    def count(self, token: int, start: int, end: int) -> int:
        """Occurrences of the token in [start, end)."""
        a, b = self._path(token, np.array([start, end], np.int64))
        return int(b - a)

    def occurrences(self, token: int) -> np.ndarray:
        """Every place of the token, ascending."""
        a, b = self._path(token, np.array([0, self.size], np.int64))
        at = np.arange(a, b)
        for i in range(len(self.planes) - 1, -1, -1):
            one = bool(token >> (len(self.planes) - 1 - i) & 1)
            at = self.planes[i].select(at - self.zeros[i] if one else at, one)
        return at


_DOC = np.dtype([("doc_id", "<i8"), ("known", "?"), ("tokens", "<i8")])


def shard_image(docs: list[tuple[int | None, bytes]], width: int) -> bytes:
    """The file image of some documents' ids."""
    table = np.array([(d or 0, d is not None, len(i) // 4) for d, i in docs], _DOC)
    ids = np.frombuffer(b"".join(i for _, i in docs), "<u4")
    return (
        _MAGIC
        + np.uint32(len(table)).tobytes()
        + table.tobytes()
        + WaveletMatrix.of(ids, width).to_bytes()
    )


def open_image(image: bytes) -> tuple[np.ndarray, WaveletMatrix]:
    """Document table and matrix of a file image."""
    if image[:4] != _MAGIC:
        raise ValueError("not a wavelet shard")
    n = int(np.frombuffer(image, "<u4", 1, 4)[0])
    table = np.frombuffer(image, _DOC, n, 8)
    return table, WaveletMatrix.from_bytes(memoryview(image)[8 + table.nbytes :])


def write_shards(docs: DataFrame, tokenizer_path: str, path: str) -> None:
    """Encode all texts and write their shards under ``path``.

    Documents stand in ascending doc_id order, those without doc_id last; rows
    with the same doc_id by text. A null or empty text is its end id alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = loaded(ByteLevel, tokenizer_path)
        width = max([*level.ranks.values(), *level.specials.values()]).bit_length()
        end = np.array([END_ID], "<u4").tobytes()
        part, serial, held, size, before = TaskContext.get().partitionId(), 0, [], 0, 0

        def close() -> pa.RecordBatch:
            image = shard_image(held, width)
            return pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int32()),
                    "serial": pa.array([serial], pa.int32()),
                    "before": pa.array([before], pa.int64()),
                    "n_tokens": pa.array([size], pa.int64()),
                    "image": pa.array([image], pa.binary()),
                }
            )

        for batch in batches:
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                ids = level.encode(text or "") + end
                held.append((doc, ids))
                size += len(ids) // 4
                if size >= SHARD_TOKENS:
                    yield close()
                    before, serial, held, size = before + size, serial + 1, [], 0
        if held:
            yield close()

    spark = docs.sparkSession
    order = F.col("doc_id").asc_nulls_last()
    sorted_docs = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .repartitionByRange(parts(spark), order)
        .sortWithinPartitions(order, "text")
    )
    schema = "part int, serial int, before long, n_tokens long, image binary"
    sorted_docs.mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """part, serial, start (ids in all shards before), n_tokens, image."""
    shards = tune(spark).read.parquet(path)
    # one row per range partition, however many shards there are
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("own"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("base"))
    return shards.join(bases, "part").select(
        "part", "serial", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "image"
    )


def read_documents(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read from the shards."""

    def make():
        def step(batch: pa.RecordBatch):
            for start, image in zip(batch["start"].to_pylist(), batch["image"], strict=True):
                table, matrix = open_image(image.as_py())
                ids, n = matrix.all(), table["tokens"]
                ends = np.cumsum(n)
                crcs = [zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip((ends - n).tolist(), ends.tolist(), strict=True)]
                yield {
                    "doc_id": pa.array(table["doc_id"], pa.int64(), mask=~table["known"]),
                    "start": pa.array(start + ends - n, pa.int64()),
                    "n_tokens": pa.array(n, pa.int64()),
                    "ids_crc32": pa.array(crcs, pa.int64()),
                }

        return step

    return map_arrow(
        shards.select("start", "image"), make, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def find_token(shards: DataFrame, token: int) -> DataFrame:
    """doc_id, position: every occurrence of the token, by select on the planes."""

    def make():
        def step(batch: pa.RecordBatch):
            for image in batch["image"]:
                table, matrix = open_image(image.as_py())
                ends = np.cumsum(table["tokens"])
                at = matrix.occurrences(token)
                doc = np.searchsorted(ends, at, side="right")
                yield {
                    "doc_id": pa.array(table["doc_id"][doc], pa.int64(), mask=~table["known"][doc]),
                    "position": pa.array(at - (ends - table["tokens"])[doc], pa.int64()),
                }

        return step

    return map_arrow(shards.select("image"), make, "doc_id long, position long")
