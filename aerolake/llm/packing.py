"""Best-two-fit packing of documents into token sequences of one length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.bpe import WordLevel, loaded
from aerolake.llm.common import map_arrow, shards_for, stored

CAPACITY = 2048
END_ID = 0
#: Pieces packed together. Each group can leave one sequence part-filled.
GROUP_PIECES = 200_000


def tokenize(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Add ``ids`` (little-endian 32-bit, with the end id); null text is empty."""

    def make():
        level = loaded(WordLevel, tokenizer_path)
        end = np.array([END_ID], "<u4").tobytes()

        def step(batch: pa.RecordBatch):
            ids = [level.encode(t or "") + end for t in batch["text"].to_pylist()]
            yield {"doc_id": batch["doc_id"], "ids": pa.array(ids, pa.binary())}

        return step

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(own, make, "doc_id long, ids binary")


def pieces(tokens: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids: only documents beyond the capacity are cut."""
    total = (F.octet_length("ids") / 4).cast("long")
    last = ((total - 1) / capacity).cast("int")
    cut = tokens.select(
        "doc_id", "ids", total.alias("total"), F.explode(F.sequence(F.lit(0), last)).alias("piece")
    ).withColumn("start", F.col("piece").cast("long") * capacity)
    length = F.least(F.lit(capacity).cast("long"), F.col("total") - F.col("start"))
    return cut.select(
        "doc_id",
        "piece",
        "start",
        length.alias("length"),
        F.substr("ids", (F.col("start") * 4 + 1).cast("int"), (length * 4).cast("int")).alias("ids"),
    )


class _Shelf:
    """Unpacked lengths: how many of each, and the largest not above a bound."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        self.count = np.bincount(lengths, minlength=capacity + 1).tolist()
        self.mask = sum(1 << i for i, n in enumerate(self.count) if n)
        self.left = len(lengths)

    def fit(self, most: int) -> int:
        """Largest length up to ``most``, 0 if none."""
        return (self.mask & ((1 << (most + 1)) - 1)).bit_length() - 1 if most > 0 else 0

    def take(self, length: int) -> None:
        self.count[length] -= 1
        self.left -= 1
        if not self.count[length]:
            self.mask ^= 1 << length

    def put(self, length: int) -> None:
        if not self.count[length]:
            self.mask |= 1 << length
        self.count[length] += 1
        self.left += 1


def best_two_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Lengths by sequence. A bin takes the largest that fits until none does;
    then its smallest gives way to the two unpacked ones whose sum fills the gap
    it leaves best, if they fill it better than it did."""
    shelf, bins = _Shelf(lengths, capacity), []
    while shelf.left:
        held, gap = [], capacity
        while (length := max(shelf.fit(gap), 0)) > 0:
            shelf.take(length)
            held.append(length)
            gap -= length
        if gap and shelf.left > 1:
            small = held[-1]
            room, best = gap + small, (small, 0, 0)
            a = shelf.fit(room - 1)
            while a > 0 and 2 * a > best[0]:
                shelf.take(a)
                b = max(shelf.fit(min(a, room - a)), 0)
                shelf.put(a)
                if b and a + b > best[0]:
                    best = (a + b, a, b)
                    if a + b == room:
                        break
                a = shelf.fit(a - 1)
            if best[1]:
                held.pop()
                shelf.put(small)
                for length in best[1:]:
                    shelf.take(length)
                    held.append(length)
        bins.append(held)
    return bins


def assign(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each item."""
    by_length = np.argsort(lengths, kind="stable")
    first = np.searchsorted(lengths[by_length], np.arange(capacity + 2)).tolist()
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for number, held in enumerate(best_two_fit(lengths, capacity)):
        at = 0
        for length in held:
            item = by_length[first[length]]
            first[length] += 1
            sequence[item], offset[item] = number, at
            at += length
    return sequence, offset


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to rows that have doc_id, piece and length.

    Whole pieces fill a sequence alone and are not shuffled. The others are dealt
    by hash to groups of bounded size, each packed by itself; ids of sequences are
    unique. An empty table gives no rows. Repeated rows are packed each.
    """
    items = stored(items.withColumn("_row", F.monotonically_increasing_id()), "pack-pieces")
    parted = items.where(F.col("length") < capacity)
    groups = shards_for(parted.count(), GROUP_PIECES)
    schema = f"{_ddl(parted)}, sequence_id long, offset long"

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("_row")
        sequence, offset = assign(rows["length"].to_numpy(), capacity)
        group = rows["_group"][0].as_py()
        return (
            rows.drop_columns(["_group"])
            .append_column("sequence_id", pa.array(sequence * groups + group, pa.int64()))
            .append_column("offset", pa.array(offset, pa.int64()))
        )

    packed = (
        parted.withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(groups)))
        .groupBy("_group")
        .applyInArrow(run, schema)
    )
    # negative numbers cannot meet those of the groups
    whole = items.where(F.col("length") >= capacity).select(
        "*", (-F.col("_row") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return packed.unionByName(whole).drop("_row")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
