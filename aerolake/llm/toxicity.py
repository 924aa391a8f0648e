"""Toxicity by a support vector machine over a subsequence string kernel.

The kernel of two words counts the subsequences of three characters they share,
each weighted by decay ** span, so a letter put in or left out, or a mark between
letters, costs little. Words of labelled texts, pieces of long ones and runs of
spaced letters are the windows it learns from: those that stand in toxic texts more
often than chance allows have a label for each such text and one against it for each
other text, those left that stand in other texts are against it. Landmark words of
both kinds give a Nyström map, a linear machine is
trained in it, and its decision folds into one weight per subsequence: scoring a
word needs no landmark any more and gives the same value. A text is as toxic as
its worst word; a logistic curve fitted on labelled texts that did not train the
machine turns that into a probability.
"""

from __future__ import annotations

import math
import re
import warnings
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import map_arrow, stored

DECAY = 0.7
SPAN = 6
#: Longer words are scored in windows of this many characters, half overlapping.
WINDOW = 24
#: Labelled rows a fit may use, taken in order of a hash of doc_id.
FIT_ROWS = 12_000
#: Words a fit may use of either kind.
CLEAN_WORDS = 60_000
TOXIC_WORDS = 1_000
#: Landmarks of either kind, and how often the clean words that look most toxic
#: join the training set.
LANDMARKS = 200
ROUNDS = 4
HARD_WORDS = 1_500
THRESHOLD = 0.3
CACHE_WORDS = 400_000
# Letters set apart by single spaces are one word.
_SPACED = re.compile(r"(?<!\S)\w(?: \w){2,}(?!\S)")

_OFFSETS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]
_WEIGHTS = np.array([DECAY ** (b + 1) for _, b in _OFFSETS])


def _char_classes() -> np.ndarray:
    """Six bits for each code point up to 255: letters keep apart, marks do not. Those
    above have 64 classes more, in which neighbours of an alphabet keep apart."""
    classes = np.full(256, 62, np.int32)
    classes[ord("a") : ord("z") + 1] = np.arange(1, 27)
    classes[ord("0") : ord("9") + 1] = 27
    classes[0xDF:0x100] = np.arange(28, 28 + 0x100 - 0xDF)
    return classes


_CLASSES = _char_classes()
_EDGE = 63
#: Subsequences: six bits of each class, then the seventh bits.
_CODES = 1 << 21


def words_of(text: str) -> set[str]:
    low = text.lower()
    words = set(low.split())
    for run in _SPACED.findall(low):
        words.add(run.replace(" ", ""))
    return words


def _windows(words: list[str]) -> tuple[list[str], np.ndarray]:
    """Words, or their windows if long, and the place of the word each is from."""
    cut, owner = [], []
    for i, word in enumerate(words):
        if len(word) <= WINDOW:
            cut.append(word)
            owner.append(i)
        else:
            for a in range(0, len(word) - WINDOW // 2, WINDOW // 2):
                cut.append(word[a : a + WINDOW])
                owner.append(i)
    return cut, np.array(owner, np.int64)


def _subsequences(words: list[str]):
    """By length: places of the words, codes and weights of their subsequences."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        text = "".join(words[i] for i in at)
        points = np.frombuffer(text.encode("utf-32-le"), "<u4").reshape(len(at), size)
        codes = np.full((len(at), size + 2), _EDGE, np.int32)
        codes[:, 1:-1] = np.where(
            points < 256, _CLASSES[np.minimum(points, 255)], 64 + (points ^ points >> 6 & ~np.uint32(31)) % 64
        )
        low, high = codes & 63, codes >> 6
        out, weights = [], []
        for (a, b), weight in zip(_OFFSETS, _WEIGHTS, strict=True):
            n = size + 2 - b
            if n > 0:
                own = low[:, :n] << 12 | low[:, a : a + n] << 6 | low[:, b : b + n]
                if high.any():
                    own |= high[:, :n] << 20 | high[:, a : a + n] << 19 | high[:, b : b + n] << 18
                out.append(own)
                weights.append(np.full(n, weight))
        if out:
            yield at, np.concatenate(out, axis=1), np.concatenate(weights)


def _norms(codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Length of each word's feature vector; equal subsequences add up first."""
    order = np.argsort(codes, axis=1)
    ordered = np.take_along_axis(codes, order, 1)
    values = weights[order].ravel()
    new = np.ones(ordered.shape, bool)
    new[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
    starts = np.flatnonzero(new.ravel())
    squares = np.add.reduceat(values, starts) ** 2
    rows = np.searchsorted(starts, np.arange(len(codes)) * codes.shape[1])
    return np.sqrt(np.add.reduceat(squares, rows))


def decide(words: list[str], table: np.ndarray, bias: float) -> np.ndarray:
    """Value of the machine for each word."""
    cut, owner = _windows(words)
    values = np.zeros(len(cut))
    for at, codes, weights in _subsequences(cut):
        for a in range(0, len(at), 20_000):
            some = codes[a : a + 20_000]
            values[at[a : a + 20_000]] = (table[some] @ weights) / _norms(some, weights)
    best = np.full(len(words), -np.inf)
    np.maximum.at(best, owner, values)
    return best + bias


def _features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normed feature vectors as (row, code, value)."""
    rows, codes, values = [], [], []
    for at, own, weights in _subsequences(words):
        normed = weights[None, :] / _norms(own, weights)[:, None]
        rows.append(np.repeat(at, own.shape[1]))
        codes.append(own.ravel())
        values.append(normed.ravel())
    return np.concatenate(rows), np.concatenate(codes), np.concatenate(values)


def _kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    row, code, value = _features(landmarks)
    known, at = np.unique(code, return_inverse=True)
    dense = np.zeros((len(known), len(landmarks)))
    np.add.at(dense, (at, row), value)
    row, code, value = _features(words)
    at = np.minimum(np.searchsorted(known, code), len(known) - 1)
    hit = known[at] == code
    row, at, value = row[hit], at[hit], value[hit]
    out = np.zeros((len(words), len(landmarks)))
    for a in range(0, len(row), 10_000):
        part = slice(a, a + 10_000)
        np.add.at(out, row[part], dense[at[part]] * value[part, None])
    return out


def _machine(z: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-4) -> np.ndarray:
    """Linear machine with squared hinge loss, by Newton steps; last is the bias."""
    x = np.hstack([z, np.ones((len(z), 1))])
    w = np.zeros(x.shape[1])
    penalty = ridge * weight.sum() * np.eye(x.shape[1])
    penalty[-1, -1] *= 1e-3
    for _ in range(50):
        inside = y * (x @ w) < 1
        xs, ws = x[inside], weight[inside]
        new = np.linalg.solve(penalty + xs.T @ (xs * ws[:, None]), xs.T @ (ws * y[inside]))
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of P(y = 1 | x); targets drawn in, so both stay finite."""
    n1, n0 = y.sum(), len(y) - y.sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 0.0, math.log((n1 + 1) / (n0 + 1))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g, h = p - t, np.maximum(p * (1 - p), 1e-9)
        m = np.array([[(h * x * x).sum() + 1e-6, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(m, [(g * x).sum() + 1e-6 * a, g.sum()])
        step *= min(1.0, 5 / (np.abs(step).max() + 1e-12))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


@dataclass
class Model:
    """Weights per subsequence with bias, and the curve from value to probability."""

    table: np.ndarray | None
    bias: float
    slope: float
    intercept: float


class Scorer:
    """Scores texts; words it has met are kept, up to a bound."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def values(self, texts: list[str]) -> list[float]:
        """Value of the worst word of each text; without words that of none."""
        if self.model.table is None:
            return [0.0] * len(texts)
        words = [words_of(t) for t in texts]
        new = list(set().union(*words) - self.known.keys())
        if len(self.known) + len(new) > CACHE_WORDS:
            self.known.clear()
            new = list(set().union(*words))
        if new:
            found = decide(new, self.model.table, self.model.bias)
            self.known.update(zip(new, found.tolist(), strict=True))
        get = self.known.__getitem__
        return [max(map(get, w), default=self.model.bias - 1) for w in words]

    def scores(self, texts: list[str]) -> np.ndarray:
        x = np.array(self.values(texts))
        return 1 / (1 + np.exp(-np.clip(self.model.slope * x + self.model.intercept, -30, 30)))


def _enriched(stats: DataFrame, pos: int, neg: int) -> dict[str, float]:
    """Words that stand in toxic texts more often than chance would give among so
    many words, with the share of toxic ones among their texts."""
    n, k, share = F.col("pos") + F.col("neg"), F.col("pos"), pos / (pos + neg)
    gain = k * F.log(k / (n * share)) + F.when(
        F.col("neg") > 0, F.col("neg") * F.log(F.col("neg") / (n * (1 - share)))
    ).otherwise(0.0)
    tested = math.log(max(stats.count(), 1)) + 1
    rows = (
        stats.where(k > n * share)
        .withColumn("gain", gain)
        .where(F.col("gain") > tested)
        .orderBy(F.desc("gain"), "word")
        .limit(TOXIC_WORDS)
        .collect()
    )
    return {r["word"]: r["pos"] / (r["pos"] + r["neg"]) for r in rows}


def _train(shares: dict[str, float], clean: list[str]) -> tuple[np.ndarray, float]:
    """Subsequence weights and bias. A word of ``shares`` has labels of both kinds,
    weighted by the share of its texts that are toxic. The clean words that score highest join the
    training set and the landmarks, round by round."""
    toxic, share = list(shares), np.array(list(shares.values()))
    used = clean[: 2 * HARD_WORDS]
    for _ in range(ROUNDS):
        landmarks = toxic[:LANDMARKS] + used[-LANDMARKS:]
        words = toxic + used
        y = np.array([1.0] * len(toxic) + [-1.0] * (len(used) + len(toxic)))
        each = 0.5 * len(words) / len(toxic)
        weight = np.concatenate((each * share, np.full(len(used), 0.5 * len(words) / len(used)), each * (1 - share)))
        values, vectors = np.linalg.eigh(_kernel(landmarks, landmarks))
        kept = values > 1e-6
        root = vectors[:, kept] / np.sqrt(values[kept])
        z = _kernel(words, landmarks) @ root
        w = _machine(np.concatenate((z, z[: len(toxic)])), y, weight)
        table = np.zeros(_CODES)
        row, code, value = _features(landmarks)
        np.add.at(table, code, value * (root @ w[:-1])[row])
        have = set(used)
        worst = np.argsort(-decide(clean, table, 0.0), kind="stable")[: 2 * HARD_WORDS]
        hard = [clean[i] for i in worst if clean[i] not in have][:HARD_WORDS]
        used = used + hard[::-1]  # the hardest last, so that they are landmarks
    return table, float(w[-1])


def _signatures(text: str) -> list[int]:
    """Least hashes of the five-word shingles under three hash functions."""
    words = text.lower().split()
    shingles = [" ".join(words[a : a + 5]) for a in range(max(1, len(words) - 4))]
    hashes = np.array([zlib.crc32(x.encode()) for x in shingles], np.uint64)
    return [int((hashes * np.uint64(m) & np.uint64(0xFFFFFFFF)).min()) for m in (1, 2654435761, 2246822519)]


def _without_copies(texts: DataFrame) -> DataFrame:
    """Texts that share no least hash with one before them: words of a text that
    was copied often would look like words of its class."""

    def rows():
        def step(batch: pa.RecordBatch):
            found = [_signatures(t or "") for t in batch["text"].to_pylist()]
            for k in range(3):
                yield {
                    "place": batch["place"],
                    "kind": pa.array([k] * len(found), pa.int32()),
                    "value": pa.array([x[k] for x in found], pa.int64()),
                }

        return step

    hashes = map_arrow(texts.select("place", "text"), rows, "place long, kind int, value long")
    first = hashes.groupBy("kind", "value").agg(F.min("place").alias("first"))
    later = hashes.join(first, ["kind", "value"]).where("place > first").select("place").distinct()
    return texts.join(later, "place", "left_anti")


def fit(docs: DataFrame, labels: DataFrame, learn) -> Model:
    """Train on at most FIT_ROWS labelled rows of ``labels`` for which ``learn`` holds.

    Two thirds of them, without copies, give words and train the machine, the rest
    fit the curve; all of them do if the rest lacks a class. Labels that are null are
    passed over. If one class is missing or no word stands out, there is a warning,
    every text gets the share of toxic labels as score, less than the threshold in any
    case, and ``flagged`` flags none.
    """
    sample = (
        labels.where(learn & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .withColumn("place", F.xxhash64("doc_id"))
        .orderBy("place", "doc_id", "toxic")
        .limit(FIT_ROWS)
    )
    texts = stored(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .join(F.broadcast(sample), "doc_id")  # at most FIT_ROWS rows of numbers
        .select("place", "text", "toxic"),
        "toxicity-sample",
    )
    own, rest = F.pmod("place", F.lit(3)) > 0, F.pmod("place", F.lit(3)) == 0
    totals = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    pos, neg = totals.get(1, 0), totals.get(0, 0)
    # without a machine the score stays below the threshold: one for all flags nobody
    below = math.log(THRESHOLD / (1 - THRESHOLD)) - 0.05
    flat = Model(None, 0.0, 0.0, min(math.log((pos + 1) / (neg + 1)), below))
    if not pos or not neg:
        warnings.warn(f"no toxicity machine: {pos} toxic and {neg} other labelled texts", stacklevel=2)
        return flat

    def word_rows():
        def step(batch: pa.RecordBatch):
            counts: dict[str, list[int]] = {}
            for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist(), strict=True):
                for word in set(_windows(list(words_of(text or "")))[0]):
                    counts.setdefault(word, [0, 0])[toxic] += 1
            yield {
                "word": pa.array(list(counts), pa.string()),
                "neg": pa.array([c[0] for c in counts.values()], pa.int64()),
                "pos": pa.array([c[1] for c in counts.values()], pa.int64()),
            }

        return step

    stats = stored(
        map_arrow(
            _without_copies(texts.where(own)).select("text", "toxic"), word_rows, "word string, neg long, pos long"
        )
        .groupBy("word")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")),
        "toxicity-words",
    )
    toxic = _enriched(stats, pos, neg)
    common = stats.where("neg > 0").orderBy(F.desc("neg"), "word").limit(HARD_WORDS)
    some = stats.where("neg > 0").orderBy(F.xxhash64("word"), "word").limit(CLEAN_WORDS)
    chosen = common.select("word").collect() + some.select("word").collect()
    clean = [w for w in dict.fromkeys(r["word"] for r in chosen) if w not in toxic]
    if not toxic or not clean:
        warnings.warn("no toxicity machine: no word stands out", stacklevel=2)
        return flat
    table, bias = _train(toxic, clean)
    model = Model(table, bias, 1.0, 0.0)

    def value_rows():
        scorer = Scorer(model)

        def step(batch: pa.RecordBatch):
            found = scorer.values([t or "" for t in batch["text"].to_pylist()])
            yield {"toxic": batch["toxic"], "value": pa.array(found, pa.float64())}

        return step

    for part in (texts.where(rest), texts):
        # at most FIT_ROWS pairs of numbers
        pairs = map_arrow(part.select("text", "toxic"), value_rows, "toxic int, value double").collect()
        y = np.array([r["toxic"] for r in pairs])
        if len(y) and y.min() < y.max():
            break
    model.slope, model.intercept = _logistic(np.array([r["value"] for r in pairs]), y)
    return model


def flagged(model: Model, column: str = "score") -> Column:
    """Whether a scored row counts as toxic; none does without a machine, whose one
    score for all texts is below the threshold."""
    return F.col(column) >= THRESHOLD


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """Every row with its score from 0 to 1.

    All columns are kept (one named like ``column`` is replaced). Null and empty
    texts have no words and score low. Each row is scored alone, so repeated rows
    score alike.
    """
    kept = docs.drop(column)

    def make():
        scorer = Scorer(model)

        def step(batch: pa.RecordBatch):
            found = scorer.scores([t or "" for t in batch["_text"].to_pylist()])
            yield {
                **{f.name: batch[f.name] for f in batch.schema if f.name != "_text"},
                column: pa.array(found, pa.float64()),
            }

        return step

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return map_arrow(
        kept.withColumn("_text", F.col("text").cast("string")), make, f"{fields}, `{column}` double"
    )
