"""Fingerprints and likeness by hand, models without data or with a file lost."""

import random
import time
import zlib
from pathlib import Path
from urllib.parse import urlparse

import pytest
import regex
from pyspark.sql import functions as F

from aerolake.llm import kneser_ney, spotsigs, toxicity
from aerolake.llm.common import stored

from .conftest import frame

CLOSE = r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]"


def signatures(text, anchors=spotsigs.ANCHORS):
    low = regex.sub(f"({CLOSE})", r" \1 ", text.lower())
    words = regex.sub(r"[^\p{L}\p{N}]+", " ", low).strip(" ").split(" ")
    words = [w for w in words if w]
    found = set()
    for i, word in enumerate(words):
        if word in anchors:
            after = [w for w in words[i + 1 :] if w not in anchors][:2]
            if len(after) == 2:
                found.add(" ".join(["\x01" + word, *after]))
    marked = [("\x01" + w if w in anchors else w) for w in words]
    if not found and words:
        found = {" ".join(marked[i : i + 3]) for i in range(len(words) - 2)} or {f" {' '.join(marked)} "}
    return sorted({zlib.crc32(s.encode()) for s in found})


def alike(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def sets(spark, texts, **options):
    df = frame(spark, list(enumerate(texts)))
    found = spotsigs.with_signatures(df, {"found": "text"}, **options)
    return [r["found"] for r in found.orderBy("doc_id").collect()]


def texts():
    rng = random.Random(4)
    words = ["the", "of", "und", "la", "alpha", "Beta", "gamma,", "delta.", "x1", "ünder", "中文", "e"]
    some = [" ".join(rng.choices(words, k=rng.randrange(60))) for _ in range(60)]
    return some + [
        "the " + "of " * 30 + "alpha beta gamma",
        "of " * 2_000 + "alpha beta",
        "the of and",
        "alpha beta",
        "",
        " . ",
        "今天天气很好我们去公园",
        "今天天气不好我们去公园",
        "ภาษาไทย no spaces",
    ]


def test_signatures_equal_those_by_hand(spark):
    assert sets(spark, texts()) == [signatures(t) for t in texts()]


def test_runs_of_anchors_hold_no_content(spark):
    some = sets(spark, ["the " + "of " * 25 + "alpha beta gamma", "of " * 200_000 + "alpha beta gamma"])
    assert list(map(len, some)) == [2, 1]


def test_other_anchors(spark):
    some = ["alpha beta gamma delta the beta e f", "beta beta x y"]
    assert sets(spark, some, anchors=["beta"]) == [signatures(t, ["beta"]) for t in some]


def test_likeness_is_exact(spark):
    rng = random.Random(8)
    long = " ".join(f"the w{rng.randrange(10**6)} v{rng.randrange(10**6)}" for _ in range(400))
    rows = [(i, t) for i, t in enumerate([long, " ".join(long.split(" ")[:30]), *texts()[:40], *texts()[-3:]])]
    found = {r["doc_id"]: r for r in spotsigs.compare_with_next(frame(spark, rows)).collect()}
    for i, (doc, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b, c = map(signatures, (text, edited, after))
        row = found[doc]
        assert row["fingerprint"] == "".join(f"{x + 2**32:X}" for x in a)
        assert row["edited_fingerprint"] == "".join(f"{x + 2**32:X}" for x in b)
        assert (row["near_edited"], row["near_next"]) == (alike(a, b), alike(a, c))
    assert 0 < found[0]["near_next"] < 0.05


def test_one_class_of_labels_flags_nobody(spark):
    docs = frame(spark, [(i, f"text number {i}") for i in range(40)])
    labels = spark.createDataFrame([(i, 1) for i in range(40)], "doc_id long, toxic int")
    with pytest.warns(UserWarning):
        model = toxicity.fit(docs, labels, F.lit(True))
    scored = toxicity.score(docs, model).withColumn("flagged", toxicity.flagged(model))
    assert scored.where("flagged or score >= 0.3").isEmpty()


@pytest.mark.parametrize("kind", ["pairs", "words"])
def test_a_lost_file_of_the_model_is_an_error(spark, tmp_path, kind):
    docs = frame(spark, [(i, f"one two three {i} four five {i % 3}") for i in range(30)]).withColumn("held_out", F.lit(False))
    path = str(tmp_path / "model")
    model = kneser_ney.fit(docs, path, order=3)
    assert model.files == {p.name for p in Path(path).iterdir()}
    total = kneser_ney.score(docs, model).agg(F.sum("score")).first()[0]
    assert total < 0
    next(Path(urlparse(model.path).path).glob(f"{kind}-*")).unlink()
    with pytest.raises(Exception, match="No such file|FileNotFoundError"):
        kneser_ney.score(docs, model).agg(F.sum("score")).first()


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {blocks.apply(i).getName() for i in range(blocks.size()) if blocks.apply(i).getName().startswith("shuffle")}


def test_a_stored_frame_leaves_no_shuffle(spark):
    before = shuffle_files(spark)
    kept = stored(spark.range(10_000).groupBy((F.col("id") % 997).alias("k")).count(), "test")
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert kept.count() == 997


def test_runs_and_their_model_are_small(spark, monkeypatch, tmp_path):
    """Bytes of a run do not grow with the shards, and the model holds each but once."""
    monkeypatch.setattr(kneser_ney, "SHARD_TOKENS", 2_000)
    rng = random.Random(5)
    rows = [(i, " ".join(f"v{int(rng.paretovariate(0.6)) % 20_000}" for _ in range(500))) for i in range(120)]
    docs = frame(spark, rows).withColumn("held_out", F.lit(False))
    path = str(tmp_path / "model")
    model = kneser_ney.fit(docs, path, order=3)
    assert model.shards > 50
    deal = kneser_ney._deal(model.shards, model.hot, False, 3, model.common)
    dealt = docs.mapInArrow(deal, "shard long, flush long, pack binary")
    sizes = dealt.where("shard >= 0").agg(F.sum(F.length("pack"))).first()[0]
    written = sum(p.stat().st_size for p in Path(path).glob("pairs-*"))
    assert sizes < 12 * model.tokens and written < 12 * model.tokens
