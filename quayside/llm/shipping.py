"""Makes this package importable in the Python workers of a session."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

BATCH_BYTES = 8 << 20
_SETTING, _DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"

_done: set[str] = set()
_sizes: set[str] = set()


def ship(spark: SparkSession, batch_bytes: int = BATCH_BYTES) -> None:
    """Adds the package's modules to the session's Python files, once per application, for
    sessions that were not started with ``--py-files``. Rows here are whole texts, so batches
    for Python workers get ``batch_bytes``, unless the session has a size of the user's."""
    if spark.conf.get(_SETTING) in {_DEFAULT, *_sizes}:
        _sizes.add(str(batch_bytes))
        spark.conf.set(_SETTING, str(batch_bytes))
    app = spark.sparkContext.applicationId
    if app in _done:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    path = os.path.join(tempfile.mkdtemp(prefix="quayside-ship-"), "quayside_modules.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(path)
    _done.add(app)
