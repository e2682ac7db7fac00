"""Getting this package's code to the executors."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Send the package to the Python workers of this session's application, once.

    Executors then need no installed copy and no shared folder with the code.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent
        target = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
        with zipfile.ZipFile(target, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        context.addPyFile(str(target))
        _shipped.add(context.applicationId)
    return spark


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that `spark.checkpoint.dir` names; without it only a local session has a place of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is unset: a cluster needs a folder that all executors see")
        folder = "/tmp/checkpoints"
    return f"{folder}/{name}-{uuid.uuid4().hex}"
