"""SpotSigs fingerprints with DataFrame functions only.

Each common word is an anchor; it and the next two content words (anchors between
them are skipped) form a signature. A text's fingerprint is the sorted set of its
signatures' hashes. Texts are compared by the Jaccard similarity of the sets.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolake.llm.common import parts, stored

#: Frequent words of English, German, French and Spanish.
ANCHORS = (
    "the of and to in a that is was he for it with as his on be at by are this from "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine "
    "de la le et les en un du une que est pour qui dans par sur "
    "el y los se del las por con no su para al lo como"
).split()
#: Content words in a signature.
CHAIN = 2
#: Fixed value: characters of scripts that put no spaces between words; each is a word.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"

# In marked texts an anchor begins with this character, which no word has.
_MARK = "\\x01"
_CONTENT = f" ([^{_MARK} ][^ ]*)"
_ANY_CHAIN = " (?=([^ ]+(?: [^ ]+){" + str(CHAIN) + "}) )"


def _marked(text: Column, anchors: list[str]) -> Column:
    """The text's words in lower case with a space around each, anchors marked."""
    low = F.lower(text)
    spaced = F.when(F.regexp_like(low, F.lit(UNSPACED)), F.regexp_replace(low, f"({UNSPACED})", " $1 ")).otherwise(low)
    words = F.split(F.trim(F.regexp_replace(spaced, "[^\\p{L}\\p{N}]+", " ")), " ")
    marked = F.transform(words, lambda w: F.when(w.isin(anchors), F.concat(F.lit("\x01"), w)).otherwise(w))
    return F.concat(F.lit(" "), F.array_join(marked, " "), F.lit(" "))


def _hashes(found: Column) -> Column:
    return F.sort_array(F.array_distinct(F.transform(found, lambda s: F.crc32(s.cast("binary")))))


def _chains(name: str) -> Column:
    """Each anchor with the next ``CHAIN`` content words. The anchors before a content
    word stand in the gap before it, so the word's place gives the chain, however many
    anchors there are."""
    words = F.col(f"_c_{name}")

    def of_gap(gap: Column, k: Column) -> Column:
        chain = F.concat_ws(" ", *[F.get(words, k + i) for i in range(CHAIN)])
        return F.when(F.length(gap) < 2, F.array().cast("array<string>")).otherwise(
            F.transform(F.split(F.trim(gap), " "), lambda anchor: F.concat_ws(" ", anchor, chain))
        )

    full = F.greatest(F.size(words) - (CHAIN - 1), F.lit(0))
    return F.flatten(F.transform(F.slice(f"_g_{name}", F.lit(1), full), of_gap))


def with_signatures(df: DataFrame, texts: dict[str, str], anchors: list[str] | None = None) -> DataFrame:
    """Add, for each text column (new name: text), the sorted distinct hashes of
    its signatures; ``anchors`` are other common words than those of ``ANCHORS``.

    Texts with no anchor before content words give all chains of three words, and
    those of fewer words the whole text; null and empty texts give an empty set.
    What a step uses twice is a column of the step before, so it is computed once.
    """
    common = ANCHORS if anchors is None else list(anchors)
    marked = df.withColumns({f"_m_{n}": _marked(F.coalesce(F.col(t), F.lit("")), common) for n, t in texts.items()})
    parted = marked.withColumns(
        {f"_c_{n}": F.regexp_extract_all(f"_m_{n}", F.lit(_CONTENT), F.lit(1)) for n in texts}
        | {f"_g_{n}": F.split(f"_m_{n}", _CONTENT, -1) for n in texts}
    )
    spots = parted.withColumns({f"_s_{n}": _chains(n) for n in texts})

    def chosen(n: str) -> Column:
        words, found = F.col(f"_m_{n}"), F.col(f"_s_{n}")
        chains = F.regexp_extract_all(words, F.lit(_ANY_CHAIN), F.lit(1))
        return (
            F.when(F.size(found) > 0, found)
            .when(F.length(words) <= 2, F.array().cast("array<string>"))
            .when(F.regexp_like(words, F.lit(_ANY_CHAIN)), chains)
            .otherwise(F.array(words))
        )

    return spots.withColumns({n: _hashes(chosen(n)) for n in texts}).drop(
        *(f"_{kind}_{n}" for kind in "mcgs" for n in texts)
    )


def fingerprint(found: Column) -> Column:
    """The set as text, nine hex digits a signature, the first always 1."""
    return F.array_join(F.transform(found, lambda x: F.hex(x + 2**32)), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets; 1 if both are empty."""
    common = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - common
    return F.when(either == 0, 1.0).otherwise(common / either)


def _block(bounds: list[int]) -> Column:
    """How many of the sorted bounds are not above doc_id, in two steps of about
    the root of their number."""
    each = max(1, math.isqrt(len(bounds)))
    coarse, fine = F.lit(bounds[each - 1 :: each]), F.lit(bounds)
    below = F.size(F.filter(coarse, lambda x: x <= F.col("doc_id"))) * each
    return below + F.size(F.filter(F.slice(fine, below + 1, each), lambda x: x <= F.col("doc_id")))


def _with_next(own: DataFrame) -> DataFrame:
    """Add the next document's text. Documents are dealt to blocks of consecutive
    doc_ids, and each block also gets the first document of the one after it, so
    texts are shuffled once."""
    count = parts(own.sparkSession)
    steps = F.lit([i / count for i in range(1, count)] or [0.5])
    # one number for each partition
    bounds = own.agg(F.percentile_approx("doc_id", steps, F.lit(100_000))).first()[0] or [0]
    blocks = own.withColumn("block", _block(sorted(set(bounds)))).withColumn("guest", F.lit(False))
    order = F.struct("doc_id", F.xxhash64("text"))
    # at most one document for each block
    firsts = stored(
        blocks.groupBy("block").agg(F.min_by(F.struct("doc_id", "text"), order).alias("first")), "first-documents"
    )
    over = Window.orderBy("block")
    every = over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    guests = firsts.select(
        F.coalesce(F.lag("block").over(over), F.last("block").over(every)).alias("block"), "first.*"
    ).withColumn("guest", F.lit(True))
    inside = Window.partitionBy("block").orderBy("guest", "doc_id", F.xxhash64("text"))
    return (
        blocks.unionByName(guests)
        .withColumn("next_text", F.lead("text").over(inside))
        .where(~F.col("guest"))
        .select("doc_id", "text", "next_text")
    )


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, and how alike they are.

    The edited text has its last half (rounded down) replaced by as much of the
    start of the next document's, by ascending doc_id, the first following the
    last; rows of one doc_id, repeated ones too, follow each other by a hash of the
    text. Null texts are empty. Rows without doc_id have no next document: an
    empty text stands for it. Other columns are not looked at.
    """
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    half = F.floor(F.length("text") / 2).cast("int")
    numbered = _with_next(own.where("doc_id is not null"))
    loose = own.where("doc_id is null").withColumn("next_text", F.lit(""))
    rows = (
        numbered.unionByName(loose)
        .withColumn(
            "edited",
            F.concat(
                F.substring("text", F.lit(1), (F.length("text") - half).cast("int")),
                F.substring("next_text", F.lit(1), half),
            ),
        )
        .withColumn("n_chars", F.length("text").cast("long"))
        .withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    )
    rows = with_signatures(rows, {"a": "text", "b": "edited", "c": "next_text"})
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("a")).alias("fingerprint"),
        fingerprint(F.col("b")).alias("edited_fingerprint"),
        likeness(F.col("a"), F.col("b")).alias("near_edited"),
        likeness(F.col("a"), F.col("c")).alias("near_next"),
    )
