"""The registered queries and the pipeline on the small tables."""

import re
import zlib

import duckdb
import numpy as np
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from marketlens.llm import queries


@pytest.fixture(scope="module")
def answers(spark, sf_dir):
    found = {}

    def answer(name):
        if name not in found:
            found[name] = driver.queries()[name](spark, sf_dir).toPandas()
        return found[name]

    return answer


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").toPandas()


def test_all_are_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries.registered())
    assert numbers == list(range(1, 14))
    assert {"pipeline", *queries.registered()} <= set(driver.queries())


def test_chat_against_sql(answers, sf_dir):
    connection = duckdb.connect()
    connection.execute(f"create view conversations as select * from '{sf_dir}/conversations.parquet'")
    expected = connection.execute(queries.oracle_sql()["op9_chat_formatting"]).fetchall()
    found = answers("op9_chat_formatting").itertuples(index=False, name=None)
    assert sorted(map(repr, found)) == sorted(map(repr, expected))


@pytest.mark.parametrize(
    ("name", "table"),
    [
        ("op2_license_scan", "documents"),
        ("op3_simhash_near_dedup", "documents"),
        ("op4_html_extraction", "pages"),
        ("op5_quality_classifier", "documents"),
        ("op6_substring_dedup", "documents"),
        ("op8_language_id", "documents"),
    ],
)
def test_every_row_has_an_answer(spark, sf_dir, answers, name, table):
    assert len(answers(name)) == spark.read.parquet(f"{sf_dir}/{table}.parquet").count()


def test_held_out_language_and_quality(spark, sf_dir, answers, documents):
    found = answers("op8_language_id").merge(documents, on="doc_id")
    assert (found.held_out == [zlib.crc32(str(k).encode()) % 4 == 2 for k in found.doc_id]).all()
    kept = found[found.held_out & found.lang.notna()]
    assert (kept.lang == kept.lang_pred).mean() > 0.95
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas()
    found = answers("op5_quality_classifier").merge(labels, on="doc_id")
    assert (found.held_out == [zlib.crc32(str(k).encode()) % 3 == 1 for k in found.doc_id]).all()
    kept = found[found.held_out]
    assert (kept.predicted == kept.quality).mean() > 0.9


def test_neighbours_recall(spark, sf_dir, answers):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    vectors, ids = np.stack(rows.embedding).astype(float), rows.vec_id.to_numpy()
    found = answers("op1_nearest_neighbours").groupby("query_id").vec_id.apply(set)
    hits = [
        len(found[a] & set(ids[ids != a][np.argsort(-(vectors[ids != a] @ v))[:20]]))
        for a, v in zip(ids, vectors, strict=True)
        if a % 20 == 0
    ]
    assert sum(hits) / (20 * len(hits)) >= 0.95


def test_leaks_are_found(spark, sf_dir, answers, documents):
    def plain(text):
        return " ".join(re.findall(r"[^\W_]+", (text or "").lower()))

    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").toPandas()
    texts = [(d, plain(t)) for d, t in zip(documents.doc_id, documents.text, strict=True)]
    whole = {(d, i) for i, item in zip(items.item_id, items.text, strict=True) for d, t in texts if plain(item) in t}
    found = answers("op7_benchmark_decontamination")
    assert whole <= set(zip(found.doc_id, found.item_id, strict=True))


def test_pipeline_stages(spark, sf_dir, documents):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kinds = docs.schema
    counts = [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, sf_dir).cache()
        counts.append(docs.count())
        assert k == 4 or docs.schema == kinds
    assert counts[0] == counts[1] > counts[2] > counts[3] > counts[4] > 0
    assert counts[5] >= counts[4]
    ends = docs.selectExpr("sequence_id", "offset + length as e").toPandas()
    assert ends.e.max() <= 4096
    assert ends.sequence_id.nunique() <= -(-docs.toPandas().length.sum() // 4096) + 1
    assert corpus_pipeline.run(spark, sf_dir).count() == counts[5]
