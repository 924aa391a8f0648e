import random
import re
from collections import Counter

import pytest

from aerolake.llm import collocations
from aerolake.llm.common import tune


def table(spark, rows):
    return tune(spark).createDataFrame(rows, "lang string, text string, n long, phrase string, own int").repartition(3)


def brute(rows, least=10, top=2000, inside=50):
    counts, totals = {}, Counter()
    for lang, text, *_ in rows:
        own = counts.setdefault(lang or "und", Counter()) if text else {}
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate({c: c + 32 for c in range(65, 91)})):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for n in (1, 2, 3):
                own.update(" ".join(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if " " in p and a >= least}
        scored = []
        for phrase, a in found.items():
            w = phrase.split(" ")
            longer = [b for q, b in found.items() if q != phrase and f" {phrase} " in f" {q} "]
            if any(100 * b >= inside * a for b in longer):
                continue
            cuts = []
            for k in range(1, len(w)):
                l, r = f[" ".join(w[:k])], f[" ".join(w[k:])]
                cuts.append((1_000_000 * a * a // (l * r), k, l, r))
            score, _, l, r = min(cuts)
            scored.append((-score, -a, phrase.encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


def invented(seed=5):
    rng = random.Random(seed)
    words = ["The", "of", "cat", "Ünder", "new", "york", "a\x1cb", "x\xa0y", "São", "z"]
    rows = []
    for i in range(120):
        text = "".join(
            rng.choices(words, [9, 7, 3, 2, 4, 4, 1, 1, 2, 1])[0] + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"])
            for _ in range(rng.randrange(90))
        )
        rows.append((rng.choice(["en", "de", None]), text, 1, "p", 2))
    return rows


def test_collocations_equal_brute_force(spark):
    rows = [
        *invented(),
        ("en", None, 1, "p", 2),
        ("en", "", 1, "p", 2),
        ("fr", " \t.,;", 1, "p", 2),
        ("es", "one two " * 3_000, 1, "p", 2),
        ("es", "q " * 500, 1, "p", 2),
        *[("it", "same row here", 1, "p", 2)] * 12,
    ]
    assert found(collocations.collocations(table(spark, rows))) == brute(rows)
    assert found(collocations.collocations(table(spark, rows), least=3, top=4, inside=90)) == brute(rows, 3, 4, 90)


@pytest.mark.parametrize("trigger, flush", [(1, 5), (2, 10_000), (1 << 20, 7)])
def test_cuts_do_not_change_counts(spark, monkeypatch, trigger, flush):
    monkeypatch.setattr(collocations, "TRIGGER", trigger)
    monkeypatch.setattr(collocations, "FLUSH", flush)
    rows = invented(7)[:40]
    assert found(collocations.collocations(table(spark, rows), least=2)) == brute(rows, 2)


def test_few_bits_do_not_change_counts(spark, monkeypatch):
    monkeypatch.setattr(collocations, "BITS", 6)
    rows = invented(9)
    assert found(collocations.collocations(table(spark, rows), least=4)) == brute(rows, 4)


def test_chunks_overlap_and_are_few_for_repeats(spark):
    words = [f"w{i}" for i in range(60)] * 50
    some = list(collocations.chunks(words, collocations._Triggers()))
    assert [w for own, c in some for w in c[:own]] == words
    for (own, left), (_, right) in zip(some, some[1:], strict=False):
        assert left[own:] == right[: collocations.OVERLAP]
    assert len({(own, tuple(c)) for own, c in some}) < len(some) / 5
    texts = table(spark, [("en", " ".join(words), 1, "p", 2)] * 3)
    parsed = collocations.dictionary(texts)
    assert parsed.agg({"n": "sum"}).first()[0] == 3 * len(some)


def test_products_beyond_64_bits(spark):
    big = 3_000_000_000_000
    often = spark.createDataFrame(
        [("en", 1, "new", 2 * big), ("en", 1, "york", big + 1), ("en", 2, "new york", big)],
        "lang string, words int, phrase string, f long",
    )
    row = collocations._scored(often).first()
    assert row["score"] == 1_000_000 * big * big // (2 * big * (big + 1))


def test_collocations_of_an_empty_table(spark):
    assert found(collocations.collocations(table(spark, []))) == []


def test_a_text_comes_once_or_a_few_times(spark, monkeypatch):
    """Runs that many parts of the dictionary have are named by one of them."""
    rng = random.Random(3)
    rows = [("en", " ".join(f"w{rng.randrange(30)}" for _ in range(60)), 1, "p", 2) for _ in range(400)]
    given, texts = [], collocations._texts
    monkeypatch.setattr(collocations, "_texts", lambda *some: given.append(texts(*some)) or given[-1])
    known = collocations.stored(collocations.dictionary(table(spark, rows)), "dictionary").repartition(8, "part")
    often = collocations.frequent(known, 10)
    assert given[0].count() <= 1.5 * often.count()
