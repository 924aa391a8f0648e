"""The registered queries of the subpackage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.llm import (
    alignment,
    bpe_codec,
    collocations,
    jaccard_join,
    kneser_ney,
    packing,
    spotsigs,
    substring_dedup,
    token_counts,
    topk,
    toxicity,
    warc,
    wavelet_store,
)
from aerolake.llm.common import scratch, stored, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without windows of 50 words seen before."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.dedup(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best inner products of every hundredth vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings"))


ORACLES["op2_topk"] = """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id,
               CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
    ), ranked AS (
        SELECT query_id, vec_id, score,
               CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
        FROM scored
    )
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near duplicates of every document."""
    return jaccard_join.join(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id"
    )


@query
def op4_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document; a tenth by hash of doc_id is held out."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    return kneser_ney.score_documents(table(spark, sf_dir, "documents"), held_out, order=3).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query
def op5_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and what they decode to, as digests."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe_codec.encode(table(spark, sf_dir, "documents"), ranks)
    return bpe_codec.decode(encoded, ranks).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every document, the last entry of its prefix table."""
    counted = token_counts.count_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )
    return counted.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit")
    )


def packed(docs: DataFrame) -> DataFrame:
    """Every document's pieces with their place in a sequence."""
    tokens = packing.tokenize(docs, public_tokenizers.path("word_bpe_49k.json"))
    cut = packing.pieces(tokens).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(cut).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query
def op7_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents packed into sequences of 2048 tokens."""
    return packed(table(spark, sf_dir, "documents"))


def held_out_of_four() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; a quarter by hash of doc_id is held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = held_out_of_four()
    model = toxicity.fit(docs, labels, ~held_out)
    return toxicity.score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        toxicity.flagged(model).cast("int").alias("predicted"),
    )


@query
def op9_wavelet_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as the wavelet shards give it back."""
    path = scratch(spark, "wavelet")
    wavelet_store.write_shards(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path
    )
    return wavelet_store.read_documents(wavelet_store.read_shards(spark, path))


@query
def op10_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document, of its edited form, and their likeness."""
    return spotsigs.compare_with_next(table(spark, sf_dir, "documents"))


@query
def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as the archives give it back."""
    path = scratch(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    found = warc.read(spark, path).drop("payload")
    return warc.resolve(stored(found, "warc-records"))


ORACLES["op11_warc"] = """
    WITH p AS (
        SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS size,
               sha256(coalesce(html, '')) AS digest
        FROM pages
    ), firsts AS (
        SELECT *, CASE WHEN size >= 100 THEN min(page_id) OVER (PARTITION BY html) ELSE page_id END AS first FROM p
    )
    SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, digest AS payload_digest,
           CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN first <> page_id THEN first END AS refers_to
    FROM firsts
"""


@query
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and link counts of two tokenizers over every document."""
    found = alignment.align(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    about = found.groups.select("row", "doc_id", "n_a", "n_b", "n_groups", digest.alias("groups_sha256"))
    zero = F.lit(0).cast("long")
    return about.join(found.links, "row", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        *[F.coalesce(c, zero).alias(c) for c in ("n_links", "n_best", "count_sum")],
        "groups_sha256",
    )


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of each language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLES["op13_collocations"] = """
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(string_split_regex(
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[.,;:!?\\x0A-\\x0D]')) AS piece
        FROM documents WHERE text IS NOT NULL
    ), w AS (
        SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM pieces
    ), runs AS (
        SELECT lang, 1 AS words, unnest(ws) AS phrase FROM w
        UNION ALL
        SELECT lang, 2, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) FROM w
        UNION ALL
        SELECT lang, 3, unnest(list_transform(range(1, len(ws) - 1),
                                              lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) FROM w
    ), f AS (
        SELECT lang, words, phrase, count(*) AS f FROM runs GROUP BY ALL
    ), totals AS (
        SELECT lang, sum(f) AS n FROM f WHERE words = 1 GROUP BY lang
    ), candidates AS (
        SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE words > 1 AND f >= 10
    ), cuts AS (
        SELECT c.*, k, array_to_string(ws[1:k], ' ') AS first_part, array_to_string(ws[k + 1:], ' ') AS rest
        FROM candidates c, (VALUES (1), (2)) cut(k) WHERE k < words
    ), scored AS (
        SELECT c.lang, c.words, c.phrase, c.a, k, p.f AS l, q.f AS r,
               CAST(CAST(c.a AS HUGEINT) * c.a * 1000000 // (CAST(p.f AS HUGEINT) * q.f) AS BIGINT) AS score
        FROM cuts c
        JOIN f p ON p.lang = c.lang AND p.phrase = first_part AND p.words = k
        JOIN f q ON q.lang = c.lang AND q.phrase = rest AND q.words = c.words - k
    ), best AS (
        SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
    ), inner_phrases AS (
        SELECT lang, unnest([ws[1] || ' ' || ws[2], ws[2] || ' ' || ws[3]]) AS phrase, a FROM candidates WHERE words = 3
    ), around AS (
        SELECT lang, phrase, max(a) AS longer FROM inner_phrases GROUP BY ALL
    ), ranked AS (
        SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
        FROM best b LEFT JOIN around o ON o.lang = b.lang AND o.phrase = b.phrase
        WHERE longer IS NULL OR 100 * longer < 50 * a
    )
    SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score
    FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
