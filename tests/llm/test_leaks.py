"""The pipeline's decontamination, row by row."""

import random

import corpus_pipeline
from tests.llm.conftest import CLASHING, prose, same


def test_clean_rows_with_null_or_repeated_ids_stay(frame, spark, tmp_path):
    rng = random.Random(3)
    items = [(k, prose(rng, 30, 5000)) for k in range(3)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = [(None, prose(rng, 40)), (None, None), (7, prose(rng, 40)), (7, ""), (8, prose(rng, 3))]
    leaks = [(None, "see " + items[0][1]), (7, items[1][1].upper()), (9, items[2][1] + " end"), (9, items[2][1] + " end")]
    kept = corpus_pipeline.drop_benchmark_leaks(spark, frame(clean + leaks), str(tmp_path))
    assert kept.columns == ["doc_id", "text", *CLASHING]
    same([(r.doc_id, r.text) for r in kept.collect()], clean)
