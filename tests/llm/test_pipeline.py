"""The pipeline against its stages, and the subpackage's entries."""

import random

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.conftest import prose
from tilewright.llm import queries, simhash


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(1)
    root = str(tmp_path_factory.mktemp("tables"))
    docs = [(k, prose(rng, 60, 4000)) for k in range(120)]
    docs += [(200 + k, " ".join(w.upper() + "!!" for w in prose(rng, 60, 4000).split())) for k in range(60)]
    docs += [(300 + k, docs[k][1]) for k in range(5)]
    items = [(k, prose(rng, 30, 4000)) for k in range(4)]
    docs += [(400 + k, prose(rng, 20, 4000) + " " + text) for k, text in items]
    docs += [(500, prose(rng, 50, 4000) + " password=hunter22 " + prose(rng, 9, 4000))]
    df = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(d, int("!!" not in t), 0) for d, t in docs if d < 300], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def test_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns, ids = docs.columns, lambda df: {r[0] for r in df.select("doc_id").collect()}
    left = ids(docs)
    gone = [set(range(200, 260)), set(range(300, 305)), set(range(400, 404)), set()]
    for (_, stage), lost in zip(corpus_pipeline.STAGES[:4], gone):
        docs = stage(spark, docs, tables)
        assert docs.columns == columns
        left -= lost
        assert ids(docs) == left, stage
    row = docs.where("doc_id = 500").first()
    assert "[secret]" in row.text and "hunter22" not in row.text and row.n_chars == len(row.text)
    packed = corpus_pipeline.STAGES[4][1](spark, docs, tables)
    assert ids(packed) == left
    same_rows = {tuple(r)[:5] for r in packed.collect()}
    assert {tuple(r)[:5] for r in corpus_pipeline.run(spark, tables).collect()} == same_rows


def test_entries():
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    names = entry.queries()
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 11))
    assert "pipeline" in names and set(queries.ORACLE_SQL) <= set(queries.QUERIES)


def test_empty_documents(spark, tables, tmp_path):
    docs = spark.read.parquet(f"{tables}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tables)
        assert docs.collect() == []
    assert simhash.keep_first(spark.read.parquet(f"{tables}/documents.parquet").limit(0)).count() == 0
