"""The shared scratch folder as files, and this package on the executors."""

from __future__ import annotations

import ctypes
import gc
import io
import zipfile
from collections.abc import Callable, Iterator
from functools import wraps
from pathlib import Path

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession

import lakelens
from lakelens.session import scratch_path

#: Rows that go to a Python task at once; whole texts are large.
BATCH_ROWS = 2_000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows that a scan decodes at once, whose texts lie in one array.
SCAN_ROWS = 512
SCAN_SETTING = "spark.sql.parquet.columnarReaderBatchSize"
_sent: set[str] = set()


def file_store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system that a path or URI names, and the path in it."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def shipped(spark: SparkSession) -> SparkSession:
    """Sends the package's modules to the executors, once per application, as their Python may not have them.

    Also lowers the session's Arrow batches to BATCH_ROWS and its Parquet scans to SCAN_ROWS, so that texts in flight stay small in every task.
    """
    for setting, rows in ((BATCH_SETTING, BATCH_ROWS), (SCAN_SETTING, SCAN_ROWS)):
        if int(spark.conf.get(setting)) not in range(1, rows + 1):
            spark.conf.set(setting, rows)
    context, package = spark.sparkContext, Path(lakelens.__file__).parent
    if context.applicationId not in _sent and package.is_dir():
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w") as archive:
            for module in sorted(package.rglob("*.py")):
                archive.write(module, module.relative_to(package.parent))
        folder = scratch_path(spark, "code")
        store, base = file_store(folder)
        store.create_dir(base, recursive=True)
        with store.open_output_stream(f"{base}/lakelens.zip", compression=None) as out:
            out.write(packed.getvalue())
        context.addPyFile(f"{folder}/lakelens.zip")
        _sent.add(context.applicationId)
    return spark


def give_back() -> None:
    """Gives memory that nothing uses back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(task: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The same task; at its end the worker, which lives on, gives the memory of its tables back to the system."""

    @wraps(task)
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            yield from task(batches)
        finally:
            gc.collect()
            give_back()

    return run
