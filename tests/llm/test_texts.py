"""Text operators against brute force on small tables."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolake.llm import jaccard_join, kneser_ney, spotsigs, substring_dedup, topk, toxicity
from aerolake.llm.common import scratch, tune
from aerolake.llm.graph import components

from .conftest import ODD, frame


def words(text):
    return (text or "").encode().split()


# ---- repeated passages


def remove_repeats(rows, length):
    seen = {}
    for doc, text in rows:
        own = words(text)
        for i in range(len(own) - length + 1):
            if doc is not None:
                seen[tuple(own[i : i + length])] = min(doc, seen.get(tuple(own[i : i + length]), doc))
    out = []
    for doc, text in rows:
        own = words(text)
        gone = set()
        for i in range(len(own) - length + 1):
            if doc is not None and seen[tuple(own[i : i + length])] < doc:
                gone.update(range(i, i + length))
        kept = b" ".join(w for i, w in enumerate(own) if i not in gone).decode()
        out.append((doc, len(own), len(gone), kept))
    return sorted(out, key=str)


def repeated_texts(seed, n):
    rng = random.Random(seed)
    pool = [" ".join(f"p{k}q{rng.randint(0, 30)}" for _ in range(40)) for k in range(4)]
    rows = []
    for doc in range(n):
        text = []
        for _ in range(rng.randint(0, 4)):
            if rng.random() < 0.6:
                own = rng.choice(pool).split()
                a = rng.randint(0, 20)
                text += own[a : a + rng.randint(5, 40)]
            else:
                text += [f"u{rng.randint(0, 9)}" for _ in range(rng.randint(1, 30))]
        if rng.random() < 0.2:
            text = ["so"] * rng.randint(0, 60)
        rows.append((doc, " ".join(text)))
    return rows


@pytest.mark.parametrize("crowd", [15_000, 2])
def test_substring_dedup_equals_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(substring_dedup, "ANCHOR_SEGMENTS", crowd)
    monkeypatch.setattr(substring_dedup, "SHARD_WORDS", 2_000)
    rows = repeated_texts(1, 80)
    found = substring_dedup.dedup(frame(spark, rows), length=12)
    got = sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in found.collect()), key=str)
    assert got == remove_repeats(rows, 12)
    assert sum(r[2] for r in got) > 100


def test_substring_dedup_of_odd_rows(odd, none):
    found = substring_dedup.dedup(odd)
    got = sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in found.collect()), key=str)
    assert got == remove_repeats(ODD, 50)
    assert {"key", "score", "node", "n_chars"} <= set(found.columns)
    assert substring_dedup.dedup(none).collect() == []
    as_is = {r["kept"] for r in substring_dedup.dedup(odd, untouched=True).collect()}
    assert "The cat sat on the mat, it's said; don't  they\n\nknow?" in as_is


def test_fm_index_matching_statistics_for_unknown_texts():
    rng = np.random.default_rng(4)
    texts = [rng.integers(0, 6, n).astype(np.uint64) for n in (40, 25, 1)]
    index = substring_dedup.FMIndex(texts, np.array([5, 3, 9]), 7)
    patterns = [rng.integers(0, 7, 60).astype(np.uint64), np.zeros(0, np.uint64), texts[1]]
    for pattern, (matched, owner) in zip(patterns, index.stream(patterns), strict=True):
        for i in range(len(pattern)):
            for size in range(min(7, len(pattern) - i), -1, -1):
                part = pattern[i : i + size].tolist()
                hits = [
                    o
                    for t, o in zip(texts, (5, 3, 9), strict=True)
                    if any(t[a : a + size].tolist() == part for a in range(len(t) - size + 1))
                ]
                if hits or not size:
                    break
            assert matched[i] == size
            assert owner[i] == (min(hits) if size == 7 else -1)


# ---- near duplicates


def shingles(text):
    own = [w.lower() for w in words(text)]
    if len(own) < 5:
        return frozenset([tuple(own)]) if own else frozenset()
    return frozenset(tuple(own[i : i + 5]) for i in range(len(own) - 4))


def groups(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i][1], sets[j][1]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, s) in enumerate(sets):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(
        ((d, len(s), None if d is None else least[root(i)]) for i, (d, s) in enumerate(sets)), key=str
    )


def near_texts(seed, n):
    rng = random.Random(seed)
    bases = [[f"b{k}w{rng.randint(0, 400)}" for _ in range(rng.choice([6, 9, 12, 20, 40, 90, 200]))] for k in range(12)]
    rows = []
    for doc in range(n):
        text = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            at = rng.randint(0, len(text) - 1)
            if rng.random() < 0.5:
                text[at] = f"n{rng.randint(0, 5)}"
            else:
                del text[at:]
                text = text or ["x"]
        if rng.random() < 0.3:
            text += [f"n{rng.randint(0, 3)}"] * rng.randint(1, 3)
        rows.append((doc, " ".join(text)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_join_equals_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(jaccard_join, "FLUSH", 700)
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    rows = near_texts(seed, 240)
    found = jaccard_join.join(frame(spark, rows)).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found), key=str) == groups(rows)


def test_every_linked_pair_shares_a_signature():
    rng = random.Random(9)
    pairs = 0
    for _ in range(4000):
        size = rng.randint(4, 60)
        a = rng.sample(range(10**6), size)
        cut = rng.randint(0, max(1, size // 5))
        b = a[cut:] + rng.sample(range(10**6, 2 * 10**6), rng.randint(0, max(1, size // 9)))
        x, y = (np.sort(jaccard_join.mix(np.array(v, np.uint64))) for v in (a, b))
        if not jaccard_join.linked(x, y) or set(a) == set(b):
            continue
        pairs += 1
        keys, owners = jaccard_join._signatures([x, y])
        assert set(keys[owners == 0].tolist()) & set(keys[owners == 1].tolist())
    assert pairs > 500


def test_jaccard_join_of_odd_rows(odd, none):
    found = jaccard_join.join(odd).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found), key=str) == groups(ODD)
    assert jaccard_join.join(none).collect() == []
    kept = jaccard_join.one_of_each(odd)
    assert kept.columns == odd.columns
    left = Counter(r["doc_id"] for r in kept.collect())
    assert left == Counter([1, 2, 3, 4, 6, 7, 8, None, 9, 10, 11])


def test_components(spark):
    edges = [(1, 2), (3, 2), (9, 8), (8, 7), (7, 6), (6, 5), (4, 4)]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r["node"], r["component"]) for r in found} == {
        *((n, 1) for n in (1, 2, 3)),
        *((n, 5) for n in (5, 6, 7, 8, 9)),
    }


# ---- language model


def reference_scores(rows, held):
    tokens = [[w.lower() for w in words(t)] + [None] for _, t in rows]
    uses, pairs = Counter(), Counter()
    for own, out in zip(tokens, held, strict=True):
        if not out:
            uses.update(own)
            pairs.update(zip([0, *own[:-1]], own, strict=True))
    n, v = sum(uses.values()), len(uses)
    kinds, total, classes = Counter(c for _, c in pairs), Counter(), defaultdict(lambda: [0, 0, 0])
    for (b, _), k in pairs.items():
        total[b] += k
        classes[b][min(k, 3) - 1] += 1
    d, e = (
        (0, *kneser_ney._discounts([sum(1 for x in c.values() if x == k) for k in (1, 2, 3, 4)]))
        for c in (pairs, kinds)
    )
    left = sum(e[min(k, 3)] for k in kinds.values())

    def single(c):
        return (kinds[c] - e[min(kinds[c], 3)] + left / (v + 1)) / sum(kinds.values())

    def pair(b, c):
        if b not in total:
            return single(c)
        k = pairs[b, c]
        return (k - d[min(k, 3)] + sum(x * y for x, y in zip(d[1:], classes[b], strict=True)) * single(c)) / total[b]

    out = []
    for own in tokens:
        base = sum(math.log10((uses[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        score = sum(math.log10(pair(b, c)) for b, c in zip([0, *own[:-1]], own, strict=True))
        out.append((len(own), sum(w in uses for w in own), n, round(base, 6), round(score, 6)))
    return out


@pytest.mark.parametrize("shard", [5_000_000, 40])
def test_kneser_ney_equals_reference(spark, monkeypatch, shard):
    monkeypatch.setattr(kneser_ney, "SHARD_TOKENS", shard)  # 40: many shards, frequent words split
    monkeypatch.setattr(kneser_ney, "FLUSH_TOKENS", 100)
    rng = random.Random(7)
    vocabulary = [f"v{int(rng.paretovariate(0.7))}" for _ in range(60)]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 12)))) for i in range(60)] + ODD[:5]
    held = [r[0] is not None and r[0] % 10 == 0 for r in rows]
    found = kneser_ney.score_documents(frame(spark, rows), F.col("doc_id") % 10 == 0).collect()
    got = sorted(
        (r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6)) for r in found
    )
    for a, b in zip(got, sorted(reference_scores(rows, held)), strict=True):
        assert a[:3] == b[:3] and a[3:] == pytest.approx(b[3:], abs=1e-5)


def reference_of_order(rows, held, order):
    """Score of every row by the recursive definition, with whole words as keys."""
    cut = [[0] * (order - 1) + [w.lower() for w in words(t)] + [1] for _, t in rows]
    counts = [{} for _ in range(order + 1)]  # by length of the run
    for own, out in zip(cut, held, strict=True):
        if not out:
            for i in range(order - 1, len(own)):
                run = tuple(own[i - order + 1 : i + 1])
                counts[order][run] = counts[order].get(run, 0) + 1
    used = counts[order]
    for n in range(order - 1, 0, -1):
        for run in counts[n + 1]:
            counts[n][run[1:]] = counts[n].get(run[1:], 0) + 1
        for run in counts[n]:  # at the begin of a text nothing differs before it
            if n > 1 and run[0] == 0:
                counts[n][run] = sum(k for r, k in used.items() if r[-n:] == run)
        counts[n + 1] = {r: k for r, k in counts[n + 1].items() if r[:2] != (0, 0)}
    d = [None] + [(0, *kneser_ney._discounts([list(c.values()).count(k) for k in (1, 2, 3, 4)])) for c in counts[1:]]
    v, pairs = len(counts[1]), sum(counts[1].values())

    def chance(run):
        n = len(run)
        if n == 1:
            k = counts[1].get(run, 0)
            return (k - d[1][min(k, 3)] + sum(d[1][min(x, 3)] for x in counts[1].values()) / (v + 1)) / pairs
        after = [k for r, k in counts[n].items() if r[:-1] == run[:-1]]
        k = counts[n].get(run, 0)
        below = chance(run[1:])
        return (k - d[n][min(k, 3)] + sum(d[n][min(x, 3)] for x in after) * below) / sum(after) if after else below

    return [
        sum(math.log10(chance(tuple(own[i - order + 1 : i + 1]))) for i in range(order - 1, len(own))) for own in cut
    ]


@pytest.mark.parametrize("order, shard", [(3, 5_000_000), (3, 40), (4, 40)])
def test_kneser_ney_of_higher_order_equals_reference(spark, monkeypatch, order, shard):
    monkeypatch.setattr(kneser_ney, "SHARD_TOKENS", shard)
    monkeypatch.setattr(kneser_ney, "FLUSH_TOKENS", 100)
    rng = random.Random(11)
    vocabulary = [f"v{int(rng.paretovariate(0.7))}" for _ in range(25)]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 14)))) for i in range(80)]
    held = [r[0] % 10 == 0 for r in rows]
    found = kneser_ney.score_documents(frame(spark, rows), F.col("doc_id") % 10 == 0, order=order).collect()
    got = {r["doc_id"]: r["score"] for r in found}
    assert [got[i] for i, _ in rows] == pytest.approx(reference_of_order(rows, held, order), abs=1e-6)


def test_kneser_ney_scores_stay_with_long_texts(spark, monkeypatch):
    """Batches of texts over 8 KB end by bytes, and several flushes come from one task."""
    monkeypatch.setattr(kneser_ney, "FLUSH_TOKENS", 1_000)
    docs = tune(spark).range(0, 5_000, 1, 1).select(
        F.col("id").alias("doc_id"), F.expr("concat(repeat('w ', int(id % 97) + 1), repeat('x', 9000))").alias("text")
    )
    rows = kneser_ney.score_documents(docs, F.col("doc_id") % 10 == 0).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(5_000))
    assert [r["doc_id"] for r in rows if r["n_tokens"] != r["doc_id"] % 97 + 3] == []
    assert all(r["held_out"] == (r["doc_id"] % 10 == 0) for r in rows)


def test_kneser_ney_of_odd_rows(odd, none):
    rows = kneser_ney.score_documents(odd, F.col("doc_id") == 1).collect()
    assert len(rows) == len(ODD) and all(math.isfinite(r["score"]) and r["score"] <= 0 for r in rows)
    assert kneser_ney.score_documents(none, F.lit(False)).collect() == []
    untrained = kneser_ney.score_documents(odd, F.lit(True)).collect()
    assert len(untrained) == len(ODD) and {r["train_tokens"] for r in untrained} == {0}


# ---- toxicity


def labelled(spark, n, seed):
    rng = random.Random(seed)
    rows, labels = [], []
    for doc in range(n):
        text = ["".join(rng.choice("abcdehiklmnorstu") for _ in range(rng.randint(2, 8))) for _ in range(30)]
        bad = rng.random() < 0.3
        if bad:
            text.insert(rng.randint(0, 30), rng.choice(["gruffwit", "zounderpate", "blightmuck"]))
        rows.append((doc, " ".join(text)))
        labels.append((doc, int(bad)))
    return frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels)


def test_toxicity_learns_and_tolerates_gaps(spark, odd):
    docs, labels, truth = labelled(spark, 900, 2)
    model = toxicity.fit(docs, labels, F.col("doc_id") % 4 != 2)
    held = toxicity.score(docs, model).where("doc_id % 4 = 2").collect()
    right = sum((r["score"] >= toxicity.THRESHOLD) == bool(truth[r["doc_id"]]) for r in held)
    assert right >= 0.98 * len(held)
    probe = [
        (1, "lorem gruff-wit dolor"),
        (2, "lorem zounxderpate dolor"),
        (3, "lorem b l i g h t m u c k dolor"),
        (4, "lorem orange wonder tales"),
    ]
    found = {r["doc_id"]: r["score"] for r in toxicity.score(frame(spark, probe), model).collect()}
    assert min(found[1], found[2], found[3]) > 0.3 > found[4]
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["score"] < 0.3 for r in rows if not (r["text"] or "").strip())


def test_toxicity_learns_from_noisy_labels_long_words_and_other_scripts(spark):
    rng = random.Random(5)
    insults = ["gruffwit", "мракобес", "ab" + "zounderpate" * 3]
    rows, labels, truth = [], [], {}
    for doc in range(1_500):
        letters = rng.choice(["abcdehiklmnorstu", "абвгдежзиклмнопр"])
        text = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 10))) for _ in range(20)]
        truth[doc] = rng.random() < 0.3
        if truth[doc]:
            text.insert(rng.randint(0, 20), rng.choice(insults))
        rows.append((doc, " ".join(text)))
        labels.append((doc, int(truth[doc] != (rng.random() < 0.15))))  # 15 % of the labels are wrong
    docs = frame(spark, rows)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), F.col("doc_id") % 4 != 2)
    held = toxicity.score(docs, model).withColumn("bad", toxicity.flagged(model)).where("doc_id % 4 = 2").collect()
    for insult in insults:
        own = [r["bad"] for r in held if insult in r["text"]]
        assert sum(own) >= 0.9 * len(own) > 10
    wrong = [r["bad"] for r in held if not truth[r["doc_id"]]]
    assert sum(wrong) <= 0.05 * len(wrong)


def test_toxicity_without_usable_labels(spark, odd, none):
    labels = spark.createDataFrame([(1, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(odd, labels, F.lit(True))
    assert len({r["score"] for r in toxicity.score(odd, model).collect()}) == 1
    assert toxicity.score(none, model).collect() == []


def test_folded_machine_equals_the_kernel_form():
    some = ["gruffwit", "gruf-fwit", "zounds", "abcabcabc"]
    marks = ["gruffwit", "zounderpate", "abcabc"]
    kernel = toxicity._kernel(some, marks)
    table = np.zeros(1 << 18)
    row, code, value = toxicity._features(marks)
    np.add.at(table, code, value)
    assert toxicity.decide(some, table, 0.0) == pytest.approx(kernel.sum(axis=1))
    assert kernel[0, 0] == pytest.approx(1.0)


# ---- fingerprints and vectors


def test_spotsigs_of_odd_rows(odd, none):
    order = sorted((r for r in ODD if r[0] is not None), key=lambda r: r[0])
    rows = spotsigs.compare_with_next(odd).collect()
    assert len(rows) == len(ODD)
    by_id = {r["doc_id"]: r for r in rows}
    for (doc, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        if doc in (6, 7, 8):  # several rows have the number 7 or 8
            continue
        text, after = text or "", after or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert by_id[doc]["n_chars"] == len(text)
        assert by_id[doc]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        if edited == text:
            assert by_id[doc]["near_edited"] == 1.0
    assert by_id[1]["fingerprint"] == by_id[5]["fingerprint"] != ""
    assert by_id[3]["fingerprint"] == by_id[4]["fingerprint"] == ""
    assert spotsigs.compare_with_next(none).collect() == []


def test_spotsigs_sees_shared_halves(spark):
    rng = random.Random(1)

    def text():
        return " ".join(rng.choice(["the", "of", *(f"w{rng.randint(0, 999)}" for _ in range(3))]) for _ in range(300))

    for r in spotsigs.compare_with_next(frame(spark, [(i, text()) for i in range(20)])).collect():
        assert r["near_edited"] > 0.2 > r["near_next"]


def test_spotsigs_runs_no_python(odd, capsys):
    spotsigs.compare_with_next(odd).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_VECTORS", 16)
    monkeypatch.setattr(topk, "CHUNK_BLOCKS", 2)
    monkeypatch.setattr(topk, "STEP_DIMENSIONS", 3)
    rng = random.Random(3)
    rows = [(i, [rng.choice([-0.5, 0.25, 0.1, rng.random()]) for _ in range(8)]) for i in range(150)]
    rows += [(100, rows[7][1]), (7, rows[7][1]), (200, None), (300, [1.0, None]), (400, [float("nan")]), (None, [0.1])]
    rows += [(500, [1e9, -1e9]), (501, [1e9, 2e9]), (502, [3e8, 5.0]), (600, []), (601, [])]
    df = tune(spark).createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = Counter(tuple(r) for r in topk.top_k(df, k=4).collect())
    usable = [
        (i, [math.floor(1024 * x) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    expected = Counter()
    for a, (i, v) in enumerate(usable):
        if i % 100 == 0:
            scored = [
                (max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(v, w, strict=True)))), j)
                for b, (j, w) in enumerate(usable)
                if b != a and len(w) == len(v)
            ]
            for rank, (score, j) in enumerate(sorted(scored, key=lambda r: (-r[0], r[1]))[:4], 1):
                expected[(i, rank, j, score)] += 1
    assert found == expected
    assert topk.top_k(df.limit(0)).collect() == []


def test_branch_and_bound_reads_less():
    rng = np.random.default_rng(0)
    matrix = np.floor(1024 * rng.normal(size=(64, 2000)))
    matrix[32:] /= 50
    matrix = np.floor(matrix)
    rest = [np.sqrt((matrix[a:] ** 2).sum(axis=0)) for a in range(0, 64, topk.STEP_DIMENSIONS)]
    best = topk._Best(10)
    ids = np.arange(2000)
    topk.search_block(matrix[:, 0].copy(), ids, matrix, rest, 0, 0, best)
    read = topk.search_block(matrix[:, 0].copy(), ids, matrix, rest, 1, -1, best)
    assert read < 0.8 * matrix.size
