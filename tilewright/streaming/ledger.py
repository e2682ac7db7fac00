"""Incremental work as a stream: new files are taken up once, decisions go to the ledger."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tilewright.operators import resume
from tilewright.sources import files


def run_ledgered(
    assets: DataFrame,
    decide: Callable[[DataFrame], DataFrame],
    ledger: str,
    checkpoint: str,
    key: str = "path",
    retry_errors: bool = False,
) -> StreamingQuery:
    """Run `decide` over the rows of a stream that the ledger doesn't list, and append its records.

    Each micro-batch reads the ledger again, so a batch that is run twice after a
    failure finds its own records and adds none. `decide` returns ledger rows. The
    query ends when what is there has been taken up.
    """

    def batch(rows: DataFrame, _: int) -> None:
        spark = rows.sparkSession
        known = files.read_ledger(spark, ledger)
        retry = F.col("status") == "error" if retry_errors else None
        new = resume.remaining(rows.dropDuplicates([key]), known, key, retry)
        files.append_ledger(decide(new), ledger)

    return assets.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
