"""The pipeline and the registered queries against brute force."""

import random

import duckdb
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from aerolake.llm import queries, toxicity

from .conftest import DOCS, frame
from .test_texts import groups, remove_repeats

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus(spark):
    """Documents with toxic words, copies, near copies and shared passages."""
    rng = random.Random(11)

    def text(n):
        return [f"w{rng.randint(0, 5000)}" for _ in range(n)]

    passage = text(70)
    rows, labels = [], []
    for doc in range(400):
        own = text(rng.randint(20, 120))
        toxic = doc % 4 == 1 and doc > 40
        if toxic:
            own.insert(3, rng.choice(["gruffwit", "blightmuck"]))
        elif doc % 10 == 0:
            own = own[:10] + passage + own[10:]
        elif doc % 10 == 4 and rows:
            own = rows[-1][1].split() if rng.random() < 0.5 else rows[-1][1].split() + ["more"]
            toxic = bool(labels[-1][1])
        rows.append((doc, " ".join(own)))
        labels.append((doc, int(toxic)))
    rows += [(400, None), (401, ""), (402, " ".join(passage))]
    docs = frame(spark, rows).selectExpr("doc_id", "text", "'xx' AS lang", "'s' AS source", "length(text) AS n_chars")
    return docs, labels


def test_each_stage_does_its_work_on_what_the_one_before_kept(spark, tmp_path):
    docs, labels = corpus(spark)
    truth = dict(labels)
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    given = {r["doc_id"]: r["text"] for r in docs.collect()}
    (_, clean), (_, one_copy), (_, without_repeats), (_, sequences) = corpus_pipeline.STAGES

    kept = clean(spark, docs, str(tmp_path))
    assert kept.columns == COLUMNS
    left = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert left == {d: t for d, t in given.items() if not truth.get(d) or "gruffwit" not in t and "blightmuck" not in t}

    kept.write.parquet(str(tmp_path / "a"))
    single = one_copy(spark, spark.read.parquet(str(tmp_path / "a")), str(tmp_path))
    assert single.columns == COLUMNS
    wanted = {d for d, _, component in groups(sorted(left.items())) if d == component}
    assert {r["doc_id"] for r in single.collect()} == wanted and len(wanted) < len(left)

    single.write.parquet(str(tmp_path / "b"))
    rows = sorted((r["doc_id"], r["text"]) for r in single.collect() if r["text"] is not None)
    after = without_repeats(spark, spark.read.parquet(str(tmp_path / "b")), str(tmp_path))
    assert after.columns == COLUMNS
    found = {r["doc_id"]: (r["text"] or "", r["n_chars"]) for r in after.collect()}
    for doc, n_words, n_removed, text in remove_repeats(rows, 50):
        if n_words and n_words == n_removed:
            assert doc not in found
        else:
            assert found[doc][0] == (text if n_removed else given[doc])
            assert found[doc][1] == len(found[doc][0])

    packed = sequences(spark, after, str(tmp_path)).collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    total = {d: len(library.encode(t, add_special_tokens=False).ids) + 1 for d, (t, _) in found.items()}
    assert sum(r["length"] for r in packed) == sum(total.values())
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    fields = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(tuple(r[c] for c in fields) for r in whole) == sorted(tuple(r[c] for c in fields) for r in packed)


def test_pipeline_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], DOCS).selectExpr("doc_id", "text", "key AS lang", "node AS source", "n_chars").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_registered_queries_give_a_row_for_each_document(spark):
    docs, pages = (spark.read.parquet(f"{SF}/{t}.parquet").count() for t in ("documents", "pages"))
    for name, run in queries.QUERIES.items():
        # searches, pieces and phrases have rows of their own number
        if name not in ("op2_topk", "op7_best_two_fit", "op13_collocations"):
            assert run(spark, SF).count() == (pages if name == "op11_warc" else docs), name
    assert set(queries.ORACLES) <= set(queries.QUERIES)


def test_top_k_equals_its_sql(spark):
    connection = duckdb.connect()
    connection.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    expected = sorted(connection.execute(queries.ORACLES["op2_topk"]).fetchall())
    assert sorted(tuple(r) for r in queries.QUERIES["op2_topk"](spark, SF).collect()) == expected


@pytest.mark.parametrize("name", ["op11_warc", "op13_collocations"])
def test_new_queries_equal_their_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages"):
        connection.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    found = queries.QUERIES[name](spark, SF)
    columns = ", ".join(found.columns)
    expected = connection.execute(f"select {columns} from ({queries.ORACLES[name]}) q").fetchall()
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))


def test_threshold_is_the_contracts():
    assert toxicity.THRESHOLD == 0.3


@pytest.mark.parametrize("chosen", ["false", "cast(null AS boolean)", "toxic = 1", "toxic = 0", "crc32(string(doc_id)) % 4 = 2"])
def test_no_document_goes_without_a_machine(spark, tmp_path, chosen):
    docs, labels = corpus(spark)
    known = spark.createDataFrame(labels, "doc_id long, toxic int").selectExpr("doc_id", "toxic", f"{chosen} AS chosen")
    if "null" in chosen:
        known = known.selectExpr("doc_id", "int(chosen) AS toxic", "true AS chosen")
    known.where("chosen").drop("chosen").write.parquet(str(tmp_path / "labels.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    with pytest.warns(UserWarning, match="no toxicity machine"):
        kept = corpus_pipeline.clean(spark, docs, str(tmp_path))
    assert kept.count() == docs.count()
    with pytest.warns(UserWarning, match="no toxicity machine"):
        assert queries.op8_toxicity(spark, str(tmp_path)).where("predicted <> 0").count() == 0


def test_the_curve_is_fitted_though_the_last_third_lacks_a_class(spark):
    docs, labels = corpus(spark)
    known = spark.createDataFrame(labels, "doc_id long, toxic int").where("toxic = 0 OR pmod(xxhash64(doc_id), 3) > 0")
    model = toxicity.fit(docs, known, F.lit(True))
    found = toxicity.score(docs, model).withColumn("bad", toxicity.flagged(model)).collect()
    assert model.table is not None
    assert all(r["bad"] == any(w in (r["text"] or "") for w in ("gruffwit", "blightmuck")) for r in found)
