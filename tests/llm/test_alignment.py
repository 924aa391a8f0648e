import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from aerolake.llm import alignment, queries
from aerolake.llm.alignment import Fragment, Pair, ranges
from aerolake.llm.bpe import byte_of_char

from .conftest import ODD, frame

PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def slow(libraries, texts):
    """Per text: (n_a, n_b, groups, links), by the libraries on whole texts."""
    a, b = libraries
    chars = byte_of_char()
    out = []
    for text in texts:
        if not text:
            out.append((0, 0, "", []))
            continue
        ids_a = a.encode(" " + text, add_special_tokens=False).ids
        ids_b = b.encode(text)
        bytes_a = [bytes(chars[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [
            bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
            for i in ids_b
        ]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            out.append((0, 0, "", []))
            continue
        end_a, end_b = (np.cumsum([len(t) for t in x]).tolist() for x in (bytes_a, bytes_b))
        groups, links, i, k = [], [], 0, 0
        after_a, after_b = ({e: n for n, e in enumerate(ends, 1)} for ends in (end_a, end_b))
        for end in sorted(set(end_a) & set(end_b)):
            j, m = after_a[end], after_b[end]
            groups.append(f"{','.join(map(str, ids_a[i:j]))}|{','.join(map(str, ids_b[k:m]))}")
            links.append((ids_a[j - 1], ids_b[m - 1]))
            i, k = j, m
        out.append((len(ids_a), len(ids_b), ";".join(groups), links))
    return out


def expected(libraries, rows):
    found = slow(libraries, [t for _, t in rows])
    counts = Counter(p for f in found for p in f[3])
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return sorted(
        (
            str(doc), n_a, n_b, groups.count(";") + 1 if groups else 0, len(links),
            sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
            hashlib.sha256(groups.encode()).hexdigest() if groups else "",
        )
        for (doc, _), (n_a, n_b, groups, links) in zip(rows, found, strict=True)
    )


MIXED = "naïve Öl 中文字 mixed 🙂 text’s end  two\n\nlines\tand tabs, x1y2 don't "
ROWS = [
    *ODD,
    (20, MIXED * 40),
    (21, "without any space" .replace(" ", "") * 300),
    (22, "an ▁ that is no space, " * 80),
    (23, " leading and trailing "),
    (24, "<s> </s> <unk> <0x41> in text"),
    (25, "中文" * 900),
    (26, "\x00\x1c \x1d odd \x85 gaps\xa0here"),
]


def asked(spark, rows, monkeypatch):
    monkeypatch.setattr(queries, "table", lambda *_: frame(spark, rows))
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    found = queries.op12_alignment(spark, "").select(*columns).collect()
    return sorted((str(r[0]), *r[1:]) for r in found)


def test_alignment_equals_brute_force(spark, libraries, monkeypatch):
    assert asked(spark, ROWS, monkeypatch) == expected(libraries, ROWS)


def test_small_ranges_and_blocks_give_the_same(spark, libraries, monkeypatch):
    monkeypatch.setattr(alignment, "RANGE_BYTES", 97)
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 2_000)
    monkeypatch.setattr(alignment, "FAN", 3)
    rows = [(d, t if t is None else t[:5_000]) for d, t in ROWS]
    assert asked(spark, rows, monkeypatch) == expected(libraries, rows)


def test_alignment_of_an_empty_table(spark, monkeypatch):
    assert asked(spark, [], monkeypatch) == []


def test_ranges_of_any_size_compose_to_the_whole(libraries):
    pair = Pair(*PATHS)
    for text in (MIXED * 3, "x" * 50 + " y" * 40, "中文" * 30 + " a b"):
        groups = slow(libraries, [text])[0][2]
        for size in (1, 2, 7, 31, 10_000):
            whole = Fragment()
            for window, start, stop in ranges(text, size):
                whole = whole.then(pair.fragment(window, start, stop)[0])
            assert whole.whole()[0] == groups
            assert whole.sound


def test_spans_cover_the_text(spark):
    text = "The cat’s mat, naïvely 中文"
    found = alignment.align(frame(spark, [(1, text), (2, None)]), *PATHS)
    data, pair = (" " + text).encode(), Pair(*PATHS)
    at = 0
    for r in alignment.spans(found.groups, *PATHS).orderBy("number").collect():
        assert r["start"] == at
        own = data[r["start"] : r["stop"]]
        assert own == b"".join(pair.bytes_a[i] for i in r["a"]) == b"".join(pair.bytes_b[i] for i in r["b"])
        at = r["stop"]
    assert at == len(data)
    assert sum(r["count"] for r in found.pairs.collect()) == found.links.first()["n_links"]


@given(st.lists(st.integers(0, 3_000)))
def test_steps_come_back(places):
    found = alignment.places_of(alignment.steps(np.array(places, np.int64)))
    assert found.tolist() == sorted(places)


_ids = st.lists(st.integers(0, 9).map(str), max_size=2).map(",".join)
_groups = st.lists(st.just("1|2"), max_size=2)


@st.composite
def fragments(draw):
    closed = draw(st.booleans())
    own = draw(_groups) if closed else []
    return Fragment(
        closed, draw(_ids), draw(_ids), ";".join(own), draw(_ids) if closed else "", draw(_ids) if closed else "",
        n_groups=len(own), sound=draw(st.booleans()),
    )


@settings(max_examples=200, deadline=None)
@given(fragments(), fragments(), fragments())
def test_composition_is_associative_with_an_identity(x, y, z):
    assert x.then(y).then(z) == x.then(y.then(z))
    assert Fragment().then(x) == x == x.then(Fragment())


def test_a_worker_holds_little_text_in_a_block():
    class Windows:
        def mapInArrow(self, run, schema):
            return run

    text = "the cat sat on the mat " * 800
    n = 300
    same = {"row": [None] * n, "part": [0] * n, "parts": [1] * n, "start": [0] * n, "stop": [len(text) + 1] * n}
    batch = pa.RecordBatch.from_pydict({**same, "doc_id": list(range(n)), "text": [text] * n})
    blocks = list(alignment._blocks(Windows(), "\0".join(PATHS))(iter([batch])))
    assert sum(len(b) for b in blocks) == n
    assert max(len(b) for b in blocks) * len(text) < 3 << 20
