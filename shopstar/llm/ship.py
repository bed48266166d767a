"""Make this package importable in Python workers that would not find it."""

from __future__ import annotations

import os
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from shopstar.sources.scratch import shared_folder

BATCH_ROWS = 1000
BATCH_BYTES = 4 << 20
_ROOT = Path(__file__).resolve().parents[2]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand the package to the workers, unless PYTHONPATH or a local session does.

    Texts then come in batches small enough for a worker's memory.

    The archive lies in the folder that the cluster shares, where that is a plain folder.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    on_path = {Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    if context.master.startswith("local["):
        on_path.add(Path.cwd())
    if _ROOT in on_path or context.applicationId in _shipped:
        return
    folder = shared_folder(spark).removeprefix("file://")
    if "://" in folder:
        raise RuntimeError("start Python workers with this package on PYTHONPATH, or ship it with --py-files")
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/shopstar-{uuid.uuid4().hex}.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for source in sorted((_ROOT / "shopstar").rglob("*.py")):
            archive.write(source, source.relative_to(_ROOT))
    context.addPyFile(path)
    _shipped.add(context.applicationId)
