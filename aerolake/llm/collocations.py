"""Phrases whose words occur together more often than apart, by prefix-free parsing.

A piece of text is parsed into chunks at places that its content triggers (a window of
``OVERLAP`` words whose last word has a hash divisible by ``TRIGGER``); a chunk ends with such a
window and the next one begins with it, so equal passages give equal chunks wherever
they stand. The corpus is then a dictionary of distinct chunks with their frequencies
in the parse. Word runs of up to ``OVERLAP`` + 1 words are counted inside each distinct
chunk, times its frequency; a run that begins in the closing window belongs to the
chunk that follows, so every occurrence is counted once.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolake.llm.common import looked_up, map_arrow, parts, stored, tune
from aerolake.llm.hashing import mix, word_hashes

#: Words that neighbouring chunks share; runs of one word more are counted.
OVERLAP = 2
#: One word of so many (a power of two) closes a window that triggers a cut.
TRIGGER = 16
#: Words after which a chunk is cut in any case.
LONGEST = 64
#: Distinct chunks or runs gathered before they are handed on.
FLUSH = 100_000
#: Power of two of the bits that frequent words or pairs may take on the driver.
BITS = 27
#: What ends a piece, and what parts its words.
PIECE_END = b".,;:!?\x0a\x0b\x0c\x0d"
WORD_GAP = b"\x20\x09"
# Bytes of texts as they are parsed: A-Z in lower case, one sign for each of the above.
_PARSED = bytes.maketrans(
    bytes(range(ord("A"), ord("Z") + 1)) + PIECE_END + WORD_GAP,
    bytes(range(ord("a"), ord("z") + 1)) + b"\n" * len(PIECE_END) + b" " * len(WORD_GAP),
)
#: Language of rows without one.
NO_LANG = "und"


class _Triggers(dict):
    """Whether a window that closes with a word triggers a cut; kept for the words met so
    far, up to a bound."""

    def __missing__(self, word: str) -> bool:
        if len(self) >= FLUSH:
            self.clear()
        value = self[word] = zlib.crc32(word.encode("utf-8", "surrogatepass")) * 2654435761 % 2**32 >> 8 & TRIGGER - 1 == 0
        return value


def chunks(words: list[str], triggers: dict[str, bool]) -> Iterator[tuple[int, list[str]]]:
    """(own, words) of each chunk of a piece; the first ``own`` words begin the runs
    that are counted in this chunk."""
    start, n = 0, len(words)
    if n > OVERLAP + 1:
        marks = [triggers[w] for w in words]
        if n > LONGEST or True in marks[OVERLAP:-1]:
            # a window ends before place i; the last one of the piece triggers nothing
            for i in range(OVERLAP + 1, n):
                if marks[i - 1] or i - start >= LONGEST:
                    yield i - OVERLAP - start, words[start:i]
                    start = i - OVERLAP
    yield n - start, words[start:]


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct chunks of the texts with their frequencies."""
    found: dict[tuple[str, int, str], int] = {}
    triggers, get = _Triggers(), found.get
    for batch in batches:
        texts = batch["text"].cast(pa.binary())
        for lang, text in zip(batch["lang"].to_pylist(), texts, strict=True):
            for piece in text.as_py().translate(_PARSED).decode().split("\n"):
                words = piece.split(" ")
                if "" in words:
                    words = [w for w in words if w]
                    if not words:
                        continue
                for own, some in chunks(words, triggers):
                    key = (lang, own, " ".join(some))
                    found[key] = get(key, 0) + 1
            if len(found) >= FLUSH:
                yield _chunk_batch(found)
                found.clear()
    if found:
        yield _chunk_batch(found)


def _chunk_batch(found: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {
            "lang": pa.array([k[0] for k in found], pa.string()),
            "own": pa.array([k[1] for k in found], pa.int32()),
            "chunk": pa.array([k[2] for k in found], pa.string()),
            "n": pa.array(found.values(), pa.int64()),
        }
    )


def dictionary(docs: DataFrame) -> DataFrame:
    """lang, own, chunk, n, part: the distinct chunks of all texts, how many of a chunk's words
    are its own, its frequency in the parse, and a number that chunks of one partition share."""
    tune(docs.sparkSession)
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"),
        F.col("text").cast("string").alias("text"),
    ).where("text <> ''")
    parsed = texts.mapInArrow(_parse, "lang string, own int, chunk string, n long")
    summed = parsed.groupBy("lang", "own", "chunk").agg(F.sum("n").alias("n"))
    return summed.withColumn("part", F.expr(f"pmod(hash(lang, own, chunk), {parts(docs.sparkSession)})"))


# --- counting runs -------------------------------------------------------------------


class _Bits:
    """A set of hashes as bits: all that were put in are found, few others are."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.shift = bits, np.uint64(64 - int(len(bits) * 64).bit_length() + 1)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> self.shift
        return (self.bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) != 0


def _bits(hashes: DataFrame) -> np.ndarray:
    """Bits of the distinct hashes (column ``h``) in a table. Their number goes with the table's, up to
    2 ** ``BITS``, so this many bits at most come to the driver; with more hashes than that
    fewer runs are ruled out, and counts are the same."""
    power = max(min(int(16 * hashes.count()).bit_length(), BITS), 6)
    at = F.expr(f"shiftrightunsigned(h, {64 - power})")
    placed = hashes.select(at.alias("at"))
    words = placed.select(F.shiftright("at", 6).alias("i"), F.expr("shiftleft(1L, CAST(at & 63 AS INT))").alias("w"))
    rows = words.groupBy("i").agg(F.bit_or("w").alias("w")).toArrow()
    bits = np.zeros(1 << (power - 6), np.uint64)
    bits[rows["i"].to_numpy()] = rows["w"].to_numpy().view(np.uint64)
    return bits


class _Words:
    """Hashes of the words of a batch of chunks, mixed with the language's."""

    def __init__(self, batch: pa.RecordBatch):
        parts, lengths = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for _, hashes, before in word_hashes(batch["chunk"], False):
            parts.append(hashes)
            lengths.append(np.diff(before))
        lengths = np.concatenate(lengths)
        langs = batch["lang"].dictionary_encode()
        salts = [hashlib.sha256(x.encode()).digest()[:8] for x in langs.dictionary.to_pylist()]
        salt = np.frombuffer(b"".join(salts), np.uint64)[langs.indices.to_numpy()]
        self.chunk = np.repeat(np.arange(len(lengths)), lengths)
        self.hashes = mix(np.concatenate(parts) + salt[self.chunk])
        self.place = np.arange(len(self.chunk)) - (np.cumsum(lengths) - lengths)[self.chunk]
        self.own = self.place < batch["own"].to_numpy()[self.chunk]
        self.part = batch["part"].to_numpy()

    def runs(self, bits: list[_Bits]) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the run of one word more than there are ``bits`` that begins at each
        word, and whether it lies in one chunk, belongs to it, and its parts may all be
        frequent."""
        hashes, fit, words = self.hashes, np.ones(len(self.hashes), bool), self.hashes
        for known in bits:
            fit = fit & known.has(hashes)
            words = words[1:]
            hashes = mix(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + words)
            fit = fit[:-1] & fit[1:] & (self.chunk[: len(words)] == self.chunk[len(self.chunk) - len(words) :])
        return hashes, fit & self.own[: len(fit)]


def _hash_counts(chunks_df: DataFrame, smaller: list) -> DataFrame:
    """h, f, part: occurrences by hash of the runs whose parts may all be frequent, and
    the first part of the dictionary that has the run."""

    def summed(hashes: list[np.ndarray], times: list[np.ndarray], places: list[np.ndarray]) -> pa.RecordBatch:
        each, n, part = np.concatenate(hashes), np.concatenate(times), np.concatenate(places)
        order = np.argsort(each)
        each = each[order]
        first = np.flatnonzero(np.concatenate(([True], each[1:] != each[:-1])))
        return pa.RecordBatch.from_pydict(
            {
                "h": pa.array(each[first].view(np.int64), pa.int64()),
                "f": pa.array(np.add.reduceat(n[order], first), pa.int64()),
                "part": pa.array(np.minimum.reduceat(part[order], first), pa.int32()),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = [_Bits(b.value) for b in smaller]
        hashes, times, places, size = [], [], [], 0
        for batch in batches:
            words = _Words(batch)
            each, fit = words.runs(bits)
            at = np.flatnonzero(fit)
            hashes.append(each[at])
            times.append(batch["n"].to_numpy()[words.chunk[at]])
            places.append(words.part[words.chunk[at]])
            size += len(at)
            if size >= 10 * FLUSH:
                yield summed(hashes, times, places)
                hashes, times, places, size = [], [], [], 0
        if size:
            yield summed(hashes, times, places)

    found = chunks_df.select("lang", "own", "chunk", "n", "part").mapInArrow(run, "h long, f long, part int")
    return found.groupBy("h").agg(F.sum("f").alias("f"), F.min("part").alias("part"))


def _there(hashes: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Hash of a run together with a part of the dictionary."""
    return mix(hashes + part.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))


def _with_part(counts: DataFrame) -> DataFrame:
    """The same hashes of runs and their parts, as a table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = _there(batch["h"].to_numpy().view(np.uint64), batch["part"].to_numpy())
            yield pa.RecordBatch.from_pydict({"h": pa.array(both.view(np.int64), pa.int64())})

    return counts.select("h", "part").mapInArrow(run, "h long")


def _texts(chunks_df: DataFrame, frequent_bits: list, part_bits: list) -> DataFrame:
    """words, h, lang, phrase of the runs that may be frequent. Each is given by the part of the
    dictionary that its count names, and by few others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, here = ([_Bits(b.value) for b in some] for some in (frequent_bits, part_bits))
        seen: list[set[int]] = [set() for _ in bits]
        for batch in batches:
            words = _Words(batch)
            langs, texts = batch["lang"].to_pylist(), batch["chunk"].to_pylist()
            out: dict[str, list] = {"words": [], "h": [], "lang": [], "phrase": []}
            for size, met in enumerate(seen, 1):
                if len(met) > 5 * FLUSH:
                    met.clear()
                each, fit = words.runs(bits[: size - 1])
                at = np.flatnonzero(fit & bits[size - 1].has(each))
                at = at[here[size - 1].has(_there(each[at], words.part[words.chunk[at]]))]
                hashes, first = np.unique(each[at], return_index=True)
                fresh = [i for i, h in enumerate(hashes.tolist()) if h not in met]
                met.update(hashes[fresh].tolist())
                at = at[first[fresh]]
                chunk, place = words.chunk[at].tolist(), words.place[at].tolist()
                out["words"] += [size] * len(chunk)
                out["h"] += each[at].view(np.int64).tolist()
                out["lang"] += [langs[c] for c in chunk]
                out["phrase"] += [" ".join(texts[c].split(" ")[i : i + size]) for c, i in zip(chunk, place, strict=True)]
            kinds = (pa.int32(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_pydict({c: pa.array(v, k) for (c, v), k in zip(out.items(), kinds, strict=True)})

    schema = "words int, h long, lang string, phrase string"
    return chunks_df.select("lang", "own", "chunk", "n", "part").mapInArrow(run, schema)


def frequent(chunks_df: DataFrame, least: int) -> DataFrame:
    """lang, words, phrase, f of all runs of 1 to 3 words that occur ``least`` times.

    Runs are counted by 64-bit hash, longer ones only where all their parts may be
    frequent, and the texts of the frequent hashes are looked up, each in one part of the
    dictionary. Among a billion
    different runs, a million of them frequent, the chance that any of these has the hash of
    another one (and so a count too high) is 1 in 20,000.
    """
    broadcast = chunks_df.sparkSession.sparkContext.broadcast
    counts, bits, there = [], [], []
    for size in range(1, OVERLAP + 2):
        found = _hash_counts(chunks_df, bits).where(F.col("f") >= least)
        counts.append(stored(found.select(F.lit(size).alias("words"), "h", "f", "part"), "run-counts"))
        bits.append(broadcast(_bits(counts[-1])))
        there.append(broadcast(_bits(_with_part(counts[-1]))))
    named = _texts(chunks_df, bits, there).groupBy("words", "h").agg(F.min(F.struct("lang", "phrase")).alias("text"))
    both = reduce(DataFrame.unionByName, counts).join(named, ["words", "h"])
    return both.select("text.lang", "words", "text.phrase", "f")


def _key(lang: str, phrase: str):
    return F.concat(F.col(lang), F.lit("\0"), F.col(phrase))


def _scored(often: DataFrame) -> DataFrame:
    """lang, words, phrase, a, l, r, score of phrases of several words: the cut with the
    lowest score, of equal ones the first."""
    several = often.where("words > 1").select("lang", "words", "phrase", F.col("f").alias("a"))
    cuts = several.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    sides = F.expr("array(substring_index(phrase, ' ', k), substring_index(phrase, ' ', k - words))")
    halves = cuts.select("*", F.posexplode(sides).alias("side", "part")).withColumn("at", _key("lang", "part"))
    # every part is at least as frequent as its phrase, so it is known
    times = halves.groupBy("at").agg(F.count("*").alias("weight"))
    known = often.select(_key("lang", "phrase").alias("at"), "f")
    facts = stored(known.join(times, "at"), "parts")
    found = looked_up(halves, facts, "at", "weight", salt=["lang", "phrase", "k"])
    whole = found.groupBy("lang", "words", "phrase", "a", "k").agg(
        F.max(F.when(F.col("side") == 0, F.col("f"))).alias("l"),
        F.max(F.when(F.col("side") == 1, F.col("f"))).alias("r"),
    )
    wide = [f"CAST({c} AS DECIMAL(19, 0))" for c in ("a", "l", "r")]
    score = F.expr(f"({wide[0]} * {wide[0]} * 1000000BD) DIV ({wide[1]} * {wide[2]})")
    best = whole.withColumn("score", score).groupBy("lang", "words", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    return best.select("lang", "words", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(
    docs: DataFrame, *, least: int = 10, top: int = 2_000, inside: int = 50
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases of 2 to
    ``OVERLAP`` + 1 words with at least ``least`` occurrences.

    Texts are split at punctuation and line ends into pieces, those at spaces and tabs
    into words; A-Z count as lower case. n counts the language's words, a the phrase, l
    and r its parts at the cut with the lowest score, a * a / (l * r) in millionths,
    rounded down. A phrase goes if a longer candidate around it has ``inside`` percent
    of its occurrences. Order: score, then a, then the phrase's bytes.
    Null and empty texts have no words, rows without lang are ``und``; repeated rows
    count each time; doc_id and further columns are not looked at. An empty table
    gives no rows.
    """
    known = stored(dictionary(docs), "dictionary")
    totals = known.groupBy("lang").agg(F.sum(F.col("n") * F.col("own")).alias("n"))
    often = stored(frequent(known, least), "phrases")
    scored = stored(_scored(often), "scored")
    longer = scored.where("words > 2").select(
        "lang",
        F.explode(
            F.array(
                F.substring_index("phrase", " ", 2), F.substring_index("phrase", " ", -2)
            )
        ).alias("phrase"),
        "a",
    )
    around = longer.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    kept = scored.join(around, ["lang", "phrase"], "left").where(
        F.coalesce(100 * F.col("around") < inside * F.col("a"), F.lit(True))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
