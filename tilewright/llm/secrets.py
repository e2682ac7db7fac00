"""Secret scans with an incremental blob ledger.

Every version of a text is a blob, addressed by its SHA-256. The ledger holds
which (blob, rule, rule version) has been scanned and the findings, so a run
scans unseen pairs only: new blobs by all rules, known blobs by new rule versions.
Findings are joined back to every path whose content is that blob.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.llm import common, sieve


@dataclass(frozen=True)
class Rule:
    """A kind of secret. Matches of `pattern` with fewer than `least` characters in `group` are dropped.

    `hints`: lower-case strings of which a text must hold one, else it is not searched.
    """

    kind: str
    version: int
    pattern: str
    group: int
    least: int
    hints: tuple[str, ...] = ()

    def spans(self, compiled: re.Pattern, text: str, lower: str) -> Iterator[tuple[int, int]]:
        if not self.hints or any(hint in lower for hint in self.hints):
            for m in compiled.finditer(text):
                if m.end(self.group) - m.start(self.group) >= self.least:
                    yield m.span()


#: The base kinds in the order in which they are listed.
RULES = (
    Rule("assign", 1, r"""(?a)((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, ("passw", "secret", "token", "apikey", "api_key")),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20, ("akia",)),
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24),
)

#: Blobs that a task remembers to have scanned; once full, a copy may be scanned again.
DONE = 100_000

FINDING = "blob string, kind string, version int, start int, end int"


def blob_id(text: str = "text") -> Column:
    """The content address of a text (null: of the empty one)."""
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)


def scan(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Findings of (blob, text, todo) rows by the rules whose numbers are the bits of todo; in a task, a blob's pairs once."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled, done = [re.compile(rule.pattern) for rule in rules], {}
        for batch in batches:
            rows = []
            for blob, text, todo in zip(batch["blob"].to_pylist(), batch["text"], batch["todo"].to_pylist(), strict=True):
                todo &= ~done.get(blob, 0)
                if not todo:
                    continue
                if len(done) < DONE:
                    done[blob] = done.get(blob, 0) | todo
                text = text.as_py()
                lower = text.lower()
                for k, rule in enumerate(rules):
                    if todo >> k & 1:
                        rows += [(blob, rule.kind, rule.version, a, b) for a, b in rule.spans(compiled[k], text, lower)]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["blob", "kind", "version", "start", "end"])

    return texts.mapInArrow(find, FINDING)


def findings_by_blob(docs: DataFrame, rules: tuple[Rule, ...] = RULES, ledger: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Scan what the ledger at path `ledger` lacks; return (paths, findings).

    paths: doc_id and blob of every row. findings: blob, spans (an array of
    (start, k, kind, end) sorted by start, then by the rule's place) and __n, the
    rows that hold the blob; blobs without findings are left out. Without `ledger` a
    new one is made in the shared folder. Findings are written before the ledger's
    rows, so that a run that broke off between is repeated, never lost; repeated
    findings count once.

    Unseen pairs are found on narrow tables. A bounded filter of them, each with one
    of the ids that hold the blob, tells in place which texts to scan: texts never
    move, and three in a hundred others (more where the filter is overfull) are
    scanned for nothing.
    """
    spark = docs.sparkSession
    ledger = ledger or common.new_path(spark, "blob-ledger")
    texts = common.doc_texts(docs)
    paths = common.saved_small(texts.select("doc_id", blob_id().alias("blob")))
    blobs = paths.groupBy("blob").agg(F.min("doc_id").alias("doc_id"), F.max(F.col("doc_id").isNull()).alias("__no_id"), F.count("*").alias("__n"))
    blobs = common.saved_small(blobs.select("blob", F.when(~F.col("__no_id"), F.col("doc_id")).alias("doc_id"), "__n"))  # a row with this id holds the blob

    number = F.when(F.lit(False), F.lit(None))
    for k, rule in enumerate(rules):
        number = number.when((F.col("kind") == rule.kind) & (F.col("version") == rule.version), F.lit(k))
    todo = blobs.withColumn("todo", F.lit((1 << len(rules)) - 1))
    if _exists(spark, f"{ledger}/scanned"):
        seen = spark.read.schema("blob string, kind string, version int").parquet(f"{ledger}/scanned").withColumn("k", number.cast("int")).where("k is not null")
        seen = seen.groupBy("blob").agg(F.bit_or(F.expr("shiftleft(1, k)")).alias("__seen"))
        todo = blobs.join(seen, "blob", "left").withColumn("todo", F.lit((1 << len(rules)) - 1).bitwiseAND(F.bitwise_not(F.coalesce("__seen", F.lit(0)))))
    todo = common.saved_small(todo.where("todo <> 0").select("blob", "doc_id", "todo"))
    wanted = F.lit(0)
    text_rows = texts.withColumn("blob", blob_id())
    for mask in sorted(row[0] for row in todo.select("todo").distinct().collect()):  # fewer than two to the number of rules
        own = sieve.sieve(common.saved_small(todo.where(F.col("todo") == mask)), "doc_id", "blob")
        wanted = wanted.bitwiseOR(F.when(sieve.may_be(docs, own, "doc_id", "blob"), F.lit(mask)).otherwise(F.lit(0)))
    unseen = text_rows.withColumn("todo", wanted.cast("int")).where("todo <> 0")
    scan(unseen.select("blob", "text", "todo"), rules).write.mode("append").parquet(f"{ledger}/findings")
    kinds = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for k, r in enumerate(rules)])
    (
        todo.select("blob", F.explode(F.filter(kinds, lambda r: F.get(F.array(*[F.col("todo").bitwiseAND(1 << k) != 0 for k in range(len(rules))]), r["k"]))).alias("rule"))
        .select("blob", "rule.kind", "rule.version").write.mode("append").parquet(f"{ledger}/scanned")
    )
    found = (
        spark.read.schema(FINDING).parquet(f"{ledger}/findings")
        .withColumn("k", number.cast("int") + 1).where("k is not null").distinct()
        .groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", "k", "kind", "end"))).alias("spans"))
    )
    return paths, common.saved_small(found.join(blobs.select("blob", "__n"), "blob"))


def _exists(spark, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def _count_of(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, ledger: str | None = None) -> DataFrame:
    """Secrets in every text of `docs` (doc_id, text): one row per row of `docs`.

    doc_id, a count n_<kind> per rule, base_sha256 (of the joined base spans) and
    spans: kind:start:end, comma-joined, by start, then by kind as listed; code
    points, end exclusive. This method adds no spans to the base ones.

    A null text is empty; a text without secrets has zero counts and empty spans.
    A text under many ids is scanned once; each id, null too, gets its findings.
    Repeated rows stay. An empty table has no rows. Other columns are ignored.
    """
    paths, found = findings_by_blob(docs, rules, ledger)
    joined = F.concat_ws(",", F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    digest = found.select("blob", "__n", joined.alias("spans"), *[_count_of(r.kind).alias(f"n_{r.kind}") for r in rules])
    spans = F.coalesce(F.col("spans"), F.lit(""))
    return sieve.joined(paths, digest, "blob", paths.count()).select(
        "doc_id", *[F.coalesce(F.col(f"n_{r.kind}"), F.lit(0)).alias(f"n_{r.kind}") for r in rules], F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans")
    )


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, ledger: str | None = None, mark: str = "[secret]") -> DataFrame:
    """`docs` with every span that a rule finds replaced by `mark`; overlapping spans become one.

    All rows and columns stay; n_chars, if there is one, is the new text's length
    where the text has changed. Null texts stay null, empty ones empty; texts of any
    length are taken whole; rows with a null or repeated id, and repeated rows, are
    judged by their text alone. An empty table has no rows.

    Only rows whose blob may have a finding, by a bounded filter, are joined with
    the findings; the others don't move.
    """
    paths, found = findings_by_blob(docs, rules, ledger)
    facts = found.select(F.col("blob").alias("__tw_blob"), F.transform("spans", lambda s: F.struct(s["start"], s["end"])).alias("__tw_spans"), "__n")

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, cuts in zip(texts, spans, strict=True):
            if text is not None and cuts is not None:
                parts, at = [], 0
                for a, b in ((s["start"], s["end"]) for s in cuts):
                    if a >= at:
                        parts += [text[at:a], mark]
                    at = max(at, b)
                text = "".join([*parts, text[at:]])
            out.append(text)
        return pd.Series(out, dtype=object)

    rows = docs.withColumn("__tw_blob", blob_id())
    rows = rows.withColumn("__tw_may", sieve.may_be(docs, sieve.sieve(found, "blob"), "__tw_blob"))
    own = sieve.joined(rows.where("__tw_may"), facts, "__tw_blob", paths.count())
    changed = F.col("__tw_spans").isNotNull() & F.col("text").isNotNull()
    own = own.withColumn("__tw_changed", changed).withColumn("text", cut("text", "__tw_spans"))
    if "n_chars" in docs.columns:
        own = own.withColumn("n_chars", F.when(F.col("__tw_changed"), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return rows.where("not __tw_may").select(*docs.columns).unionByName(own.select(*docs.columns))
