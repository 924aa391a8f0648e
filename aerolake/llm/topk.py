"""Exact top-k inner products by columnar branch and bound.

Vectors become integers and stand in blocks, a row for each dimension. A query
adds up its scores with a block's vectors some dimensions at a time. What the
other dimensions can still add is at most the product of the lengths of the two
remainders; vectors that cannot reach the k-th best any more are dropped from the
block's working set, and the next dimensions are read for the others only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolake.llm.common import stored

SCALE = 1024
BLOCK_VECTORS = 4096
#: Queries that one task scores, and blocks of vectors it scores them against.
BLOCK_QUERIES = 2048
CHUNK_BLOCKS = 16
STEP_DIMENSIONS = 16
_LONG = 2**63


def _quantize(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places and integer components of the vectors that take part."""
    places, vectors = [], []
    for i, vector in enumerate(column):
        if not vector.is_valid or vector.values.null_count:
            continue
        x = np.floor(SCALE * vector.values.to_numpy(zero_copy_only=False).astype(np.float64))
        if np.isfinite(x).all():
            places.append(i)
            vectors.append(x)
    return np.array(places, np.int64), vectors


def _block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of vectors of one dimension: ids, then components by dimension."""
    held: dict[int, tuple[list[int], list[np.ndarray]]] = {}
    serial, task = 0, TaskContext.get().partitionId() << 32

    def close(size: int) -> pa.RecordBatch:
        ids, vectors = held.pop(size)
        matrix = np.array(vectors).reshape(len(ids), size).T
        return pa.RecordBatch.from_pydict(
            {
                "block": pa.array([task + serial], pa.int64()),
                "dimensions": pa.array([size], pa.int32()),
                "ids": pa.array([np.array(ids, "<i8").tobytes()], pa.binary()),
                "matrix": pa.array([np.ascontiguousarray(matrix, "<f8").tobytes()], pa.binary()),
            }
        )

    for batch in batches:
        places, vectors = _quantize(batch["vector"])
        for i, vector in zip(places.tolist(), vectors, strict=True):
            ids, rows = held.setdefault(len(vector), ([], []))
            ids.append(batch["vec_id"][i].as_py())
            rows.append(vector)
            if len(ids) == BLOCK_VECTORS:
                yield close(len(vector))
                serial += 1
    for size in sorted(held):
        yield close(size)
        serial += 1


def _select(every: int):
    """The queries of each block, with the numbers of their rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], "<i8")
                at = np.flatnonzero(ids % every == 0)
                matrix = np.frombuffer(row["matrix"], "<f8").reshape(row["dimensions"], len(ids))
                n = len(at)
                yield pa.RecordBatch.from_pydict(
                    {
                        "dimensions": pa.array([row["dimensions"]] * n, pa.int32()),
                        "query_id": pa.array(ids[at], pa.int64()),
                        "query_block": pa.array([row["block"]] * n, pa.int64()),
                        "query_place": pa.array(at, pa.int64()),
                        "query": pa.array([matrix[:, i].tobytes() for i in at], pa.binary()),
                    }
                )

    return run


def _exact(matrix: np.ndarray) -> bool:
    """Whether sums of products stay exact in floating point."""
    most = float(np.abs(matrix).max(initial=0))
    return most * most * max(1, len(matrix)) < 2**52


class _Best:
    """The k best of a query so far: by score, then by id, then by row."""

    def __init__(self, k: int):
        self.k, self.rows, self.least = k, [], None

    def add(self, scores, ids, block: int, places) -> None:
        new = zip(scores, ids, [block] * len(ids), places, strict=True)
        self.rows = sorted([*self.rows, *new], key=lambda r: (-r[0], r[1], r[2], r[3]))[: self.k]
        if len(self.rows) == self.k:
            self.least = self.rows[-1][0]


def search_block(
    query: np.ndarray, ids: np.ndarray, matrix: np.ndarray, rest: np.ndarray, block: int, own: int, best: _Best
) -> int:
    """Score one block; gives how many components were read.

    rest[s]: lengths of the vectors' remainders after s steps; own: the place of
    the query in this block, -1 if it is in another.
    """
    alive = np.arange(len(ids))
    if own >= 0:
        alive = np.delete(alive, own)
    score, read = np.zeros(len(alive)), 0
    tail = np.sqrt(np.append(np.cumsum((query * query)[::-1])[::-1], 0.0))
    for step, start in enumerate(range(0, len(query), STEP_DIMENSIONS)):
        part = slice(start, start + STEP_DIMENSIONS)
        if best.least is not None and len(alive):
            # 1 more than rounding could take away
            reach = score + tail[start] * rest[step][alive] + 1
            stay = reach >= best.least
            alive, score = alive[stay], score[stay]
        if not len(alive):
            return read
        rows = matrix[part]
        score = score + query[part] @ (rows if len(alive) == len(ids) else rows[:, alive])
        read += len(alive) * len(rows)
    if len(alive) > best.k:
        # ties of the k-th stay
        least = np.partition(score, len(score) - best.k)[len(score) - best.k]
        stay = score >= least
        alive, score = alive[stay], score[stay]
        order = np.lexsort((alive, ids[alive], -score))[: best.k]
        alive, score = alive[order], score[order]
    best.add(score.astype(np.int64).tolist(), ids[alive].tolist(), block, alive.tolist())
    return read


def _search(k: int):
    def run(rows: pa.Table) -> pa.Table:
        out = {c: [] for c in ("query_id", "query_block", "query_place", "score", "vec_id", "block", "place")}
        queries = [r for r in rows.select(["query_id", "query_block", "query_place", "query"]).to_pylist() if r["query"] is not None]
        bests = [_Best(k) for _ in queries]
        vectors = [np.frombuffer(q["query"], "<f8") for q in queries]
        for row in rows.select(["block", "dimensions", "ids", "matrix"]).to_pylist():
            if row["ids"] is None:
                continue
            ids = np.frombuffer(row["ids"], "<i8")
            matrix = np.frombuffer(row["matrix"], "<f8").reshape(row["dimensions"], len(ids))
            starts = range(0, len(matrix), STEP_DIMENSIONS)
            exact = _exact(matrix)
            rest = [np.sqrt((matrix[a:] ** 2).sum(axis=0)) for a in starts]
            for query, vector, best in zip(queries, vectors, bests, strict=True):
                own = query["query_place"] if query["query_block"] == row["block"] else -1
                if exact and _exact(np.append(matrix.max(initial=0), vector)[None].repeat(len(vector), 0)):
                    search_block(vector, ids, matrix, rest, row["block"], own, best)
                else:
                    _plain(vector, ids, matrix, row["block"], own, best)
        for query, best in zip(queries, bests, strict=True):
            for score, vec_id, block, place in best.rows:
                values = (query["query_id"], query["query_block"], query["query_place"], score, vec_id, block, place)
                for column, value in zip(out.values(), values, strict=True):
                    column.append(value)
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})

    return run


def _plain(query: np.ndarray, ids: np.ndarray, matrix: np.ndarray, block: int, own: int, best: _Best) -> None:
    """Every score in whole numbers of any size, for components too large for
    exact floating point."""
    whole = [int(x) for x in query]
    places = [i for i in range(len(ids)) if i != own]
    scores = [sum(a * int(b) for a, b in zip(whole, matrix[:, i], strict=True)) for i in places]
    scores = [max(-_LONG, min(_LONG - 1, s)) for s in scores]
    best.add(scores, ids[places].tolist(), block, places)


def top_k(vectors: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for every query row.

    Queries are the rows whose vec_id is divisible by ``every``; candidates are all
    rows but the query's own. Components are floor(1024 * x). Vectors that are null
    or hold null or non-finite components, and rows without vec_id, take no part;
    vectors of other lengths than the query's are no candidates. Ties go to the
    smaller vec_id. Repeated rows are rows of their own. Scores beyond 64 bits stand
    at the limit. Columns other than vec_id and embedding are not looked at.
    """
    own = vectors.where("vec_id is not null").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")
    )
    schema = "block long, dimensions int, ids binary, matrix binary"
    blocks = stored(own.mapInArrow(_block, schema), "vector-blocks")
    chosen = "dimensions int, query_id long, query_block long, query_place long, query binary"
    queries = stored(blocks.mapInArrow(_select(every), chosen), "queries")
    # numbered in runs of bounded size, block by block and query by query
    chunks = _numbered(blocks, ["block"], CHUNK_BLOCKS, "chunk")
    groups = _numbered(queries, ["query_block", "query_place"], BLOCK_QUERIES, "group")
    pairs = (
        chunks.select("dimensions", "chunk")
        .distinct()
        .join(groups.select("dimensions", "group").distinct(), "dimensions")
    )
    left = pairs.join(groups, ["dimensions", "group"])
    right = pairs.join(chunks, ["dimensions", "chunk"])
    found = (
        left.unionByName(right, allowMissingColumns=True)
        .groupBy("dimensions", "group", "chunk")
        .applyInArrow(
            _search(k),
            "query_id long, query_block long, query_place long, score long, vec_id long, block long, place long",
        )
    )
    rank = Window.partitionBy("query_id", "query_block", "query_place").orderBy(
        F.desc("score"), "vec_id", "block", "place"
    )
    return (
        found.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )


def _numbered(rows: DataFrame, order: list[str], each: int, name: str) -> DataFrame:
    """Deal rows by hash into as many groups as hold about ``each`` of them."""
    sizes = rows.groupBy("dimensions").agg(F.ceil(F.count("*") / each).alias("n"))
    return (
        rows.join(sizes, "dimensions")
        .withColumn(name, F.pmod(F.xxhash64(*order), F.col("n")).cast("int"))
        .drop("n")
    )
