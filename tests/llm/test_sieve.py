"""Bounded filters: the same rows with room, without room, and with one key that most rows have."""

import pytest

from tests.llm.conftest import CLASHING, documents, same
from tests.llm.test_secrets_quality_tiling import SECRETS, expected
from tilewright.llm import common, secrets, sieve


@pytest.fixture(params=[1 << 21, 1])
def room(request, monkeypatch):
    monkeypatch.setattr(sieve, "MOST_WORDS", request.param)


def test_what_passes(spark):
    keys = common.saved(spark.range(20_000).selectExpr("id", "concat('k', id) as name"))
    own = sieve.sieve(keys, "id", "name")
    asked = spark.range(40_000).selectExpr("id", "concat('k', id) as name")
    found = asked.withColumn("may", sieve.may_be(asked, own, "id", "name")).selectExpr("id < 20000 as listed", "may").groupBy("listed", "may").count().collect()
    n = {(r.listed, r.may): r["count"] for r in found}
    assert n[True, True] == 20_000 and n[False, True] <= 1_600


@pytest.mark.parametrize("gone", [[], [3, None, 1000], [None], list(range(300))])
def test_without_ids(frame, spark, room, gone):
    rows = documents()
    kept = common.without_ids(frame(rows), common.saved(spark.createDataFrame([(k,) for k in gone], "x int")))
    assert kept.columns == ["doc_id", "text", *CLASHING]
    same([(r.doc_id, r.text) for r in kept.collect()], [r for r in rows if r[0] not in gone])


def test_joined_splits_common_keys(spark, monkeypatch):
    monkeypatch.setattr(sieve, "PARTS", 10)
    rows = [("hot",)] * 300 + [(f"k{k % 40}",) for k in range(100)] + [(None,)] * 50
    facts = [("hot", 1, 300), ("k1", 2, 3), ("none", 3, 0)]
    df, own = spark.createDataFrame(rows, "key string").repartition(3), spark.createDataFrame(facts, "key string, v int, __n long")
    got = sieve.joined(df, own, "key", len(rows))
    values = {"hot": 1, "k1": 2}
    same(got.collect(), [(k, values.get(k)) for (k,) in rows])
    assert sieve.joined(df.limit(0), own, "key", 0).collect() == []


def test_secrets_without_room(frame, room, tmp_path):
    rows = documents(n=40) + [(500 + k, s) for k, s in enumerate(SECRETS)] + [(600 + k, SECRETS[0]) for k in range(50)] + [(None, SECRETS[0])] * 3
    ledger = str(tmp_path / "ledger")
    secrets.findings_by_blob(frame(rows[:40]), secrets.RULES[:1], ledger)
    same(secrets.find_secrets(frame(rows), ledger=ledger).collect(), [(d, *expected(t)) for d, t in rows])
    redacted = secrets.redact(frame(rows), ledger=ledger).collect()
    assert {r.doc_id: r.text for r in redacted}[620] == "[secret]" and len(redacted) == len(rows)
    assert sum(r.text == "[secret]" for r in redacted if r.doc_id is None) == 3


def test_of_two_runs_the_second_scans_only_what_the_first_did_not(frame, spark, tmp_path, monkeypatch):
    ledger, scanned = str(tmp_path / "ledger"), []
    plain = secrets.scan
    monkeypatch.setattr(secrets, "scan", lambda texts, rules: scanned.append(sorted((r.blob[:6], r.todo) for r in texts.collect())) or plain(texts, rules))
    first = frame([(1, "password=hunter22"), (2, "password=hunter22"), (3, "plain")])
    secrets.findings_by_blob(first, secrets.RULES[:2], ledger)
    secrets.findings_by_blob(first, secrets.RULES, ledger)
    secrets.findings_by_blob(first, secrets.RULES, ledger)
    assert [{todo for _, todo in own} for own in scanned] == [{3}, {4}, set()] and [len(own) for own in scanned] == [2, 2, 0]
