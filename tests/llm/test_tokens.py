"""Token operators against the libraries themselves."""

import base64
import random
import zlib

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

from aerolake.llm import bpe, bpe_codec, packing, token_counts, wavelet_store
from aerolake.llm.common import scratch

from .conftest import ODD

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

PARTS = [
    "a", "the", "'", "'s", "'re", "'r", " ", "  ", "\n", "é", "İ", "²", "Ⅷ", "中", "🙂", "é", "\x1c",
    "_", "-", "!", "<|endoftext|>", "<|endoftext", "<|startoftext|>", "ing", "1", "２", "ſ", "hello", "://",
]


def texts(n):
    rng = random.Random(5)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 9))) for _ in range(n)]


def ids(value):
    return np.frombuffer(value, "<u4").tolist()


def test_cached_encoders_equal_the_library():
    for kind, path in ((bpe.ByteLevel, BYTES), (bpe.WordLevel, WORDS)):
        own, library = kind(path), Tokenizer.from_file(path)
        for text in texts(1500):
            assert ids(own.encode(text)) == library.encode(text, add_special_tokens=False).ids, text


def test_every_prefix_has_its_exact_count():
    own, library = token_counts.PrefixCounter(BYTES), Tokenizer.from_file(BYTES)
    for text in texts(600):
        found = token_counts.prefix_counts(own.tables([text])[0]).tolist()
        assert found == [
            len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)
        ], text


def test_truncation_keeps_the_longest_prefix_in_budget(odd):
    library = Tokenizer.from_file(BYTES)
    for row in token_counts.truncate(odd, BYTES, 5).collect():
        assert len(library.encode(row["text"], add_special_tokens=False).ids) <= 5


def test_counts(odd, none):
    library = Tokenizer.from_file(BYTES)
    found = sorted(
        ((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in token_counts.count_tokens(odd, BYTES).collect()), key=str
    )
    assert found == sorted(
        ((d, len((t or "").encode()), len(library.encode(t or "").ids)) for d, t in ODD), key=str
    )
    assert token_counts.count_tokens(none, BYTES).collect() == []


def test_codec_encodes_like_the_library_and_decodes_to_the_text(odd, none):
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding(
        "t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    rows = bpe_codec.decode(bpe_codec.encode(odd, RANKS), RANKS).collect()
    found = sorted(((r["doc_id"], ids(r["ids"]), bytes(r["decoded"]).decode()) for r in rows), key=str)
    assert found == sorted(((d, library.encode_ordinary(t or ""), t or "") for d, t in ODD), key=str)
    assert all(r["n_tokens"] == len(ids(r["ids"])) for r in rows)
    assert bpe_codec.decode(bpe_codec.encode(none, RANKS), RANKS).collect() == []


def test_codec_over_many_blocks(spark, odd, monkeypatch):
    monkeypatch.setattr(bpe_codec, "BLOCK_PIECES", 10)
    rows = bpe_codec.decode(bpe_codec.encode(odd, RANKS), RANKS).collect()
    assert sorted(bytes(r["decoded"]).decode() for r in rows) == sorted(t or "" for _, t in ODD)


def test_rank_streams_round_trip():
    ranks = np.array([0, 191, 192, 447, 448, 16319, 16320, 16321, 70000, 5])
    assert bpe_codec._read_ranks(bpe_codec._write_ranks(ranks)).tolist() == ranks.tolist()


def test_wavelet_matrix_answers_like_the_sequence():
    rng = np.random.default_rng(3)
    for size, width in ((0, 3), (1, 1), (513, 5), (5000, 16)):
        sequence = rng.integers(0, 1 << width, size)
        image = wavelet_store.WaveletMatrix.of(sequence, width).to_bytes()
        matrix = wavelet_store.WaveletMatrix.from_bytes(image)
        assert matrix.all().tolist() == sequence.tolist()
        if size:
            at = rng.integers(0, size, 40)
            assert matrix.access(at).tolist() == sequence[at].tolist()
            for token in {int(sequence[0]), int(sequence[-1]), 0}:
                assert matrix.occurrences(token).tolist() == np.flatnonzero(sequence == token).tolist()
                a, b = sorted(rng.integers(0, size, 2).tolist())
                assert matrix.count(token, a, b) == int((sequence[a:b] == token).sum())


def test_shards_give_back_every_document_in_order(spark, odd, none, monkeypatch):
    monkeypatch.setattr(wavelet_store, "SHARD_TOKENS", 20)
    path = scratch(spark, "test-wavelet")
    wavelet_store.write_shards(odd, BYTES, path)
    shards = wavelet_store.read_shards(spark, path)
    library = Tokenizer.from_file(BYTES)
    order = sorted(ODD, key=lambda r: (r[0] is None, r[0], r[1] is not None, r[1]))
    start, expected = 0, []
    for doc, text in order:
        own = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        expected.append((doc, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        start += len(own)
    found = sorted(wavelet_store.read_documents(shards).collect(), key=lambda r: r["start"])
    assert [tuple(r) for r in found] == expected
    token = library.encode("the").ids[0]
    hits = wavelet_store.find_token(shards, token).count()
    assert hits == sum(library.encode(t or "", add_special_tokens=False).ids.count(token) for _, t in ODD)
    empty = scratch(spark, "test-wavelet")
    wavelet_store.write_shards(none, BYTES, empty)
    assert wavelet_store.read_documents(wavelet_store.read_shards(spark, empty)).collect() == []


def test_packing_is_gapless_and_whole(odd, none):
    tokens = packing.tokenize(odd, WORDS)
    rows = packing.pack(packing.pieces(tokens)).collect()
    library = Tokenizer.from_file(WORDS)
    wanted = sorted(([*library.encode(t or "", add_special_tokens=False).ids, 0] for _, t in ODD), key=str)
    sequences, docs = {}, {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert r["start"] == r["piece"] * 2048 and len(ids(r["ids"])) == r["length"]
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r["length"] for r in rows)
    assert total == sum(map(len, wanted))
    assert len(sequences) <= -(-total // 2048) + 1
    assert packing.pack(packing.pieces(packing.tokenize(none, WORDS))).collect() == []


def test_best_two_fit_replaces_the_smallest():
    # greedy takes 6 + 3 and leaves 1; 2 + 2 fill the gap that 3 leaves
    assert sorted(map(sorted, packing.best_two_fit(np.array([6, 3, 2, 2]), 10))) == [[2, 2, 6], [3]]
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 2048, 3000)
    bins = packing.best_two_fit(lengths)
    assert sorted(x for b in bins for x in b) == sorted(lengths.tolist())
    assert all(sum(b) <= 2048 for b in bins)
    assert len(bins) <= lengths.sum() / 2048 * 1.02 + 1
