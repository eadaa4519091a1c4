"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import shared_uri


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and return the written table.

    Cuts the lineage like ``checkpoint()`` (a lost executor costs only the
    tasks that were running) and keeps the rows columnar.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession, name: str) -> str:
    """URI of a fresh folder below ``spark.checkpoint.dir``, on that folder's own file system."""
    return shared_uri(spark, name)


#: Rows of an Arrow batch: texts and pages are long, and a batch is held several times over on its way to Python and back.
BATCH_ROWS = 1000


def bounded(df: DataFrame) -> DataFrame:
    """``df``, with the session's Arrow batches held to ``BATCH_ROWS`` rows (a smaller setting stays)."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df


def slices(texts: list, chars: int) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` with about ``chars`` characters each (a longer text stands alone)."""
    start, total = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and total + n > chars:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(texts):
        yield start, len(texts)


def pylist(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def open_fs(uri: str):
    """(file system, path) of a shared folder or file; any store pyarrow can address."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


def new_file(folder: str, name: str, suffix: str) -> str:
    """URI of a file no other attempt writes: a retried task leaves its first file unlisted."""
    system, path = open_fs(folder)
    system.create_dir(path, recursive=True)
    return f"{folder}/{name}-{uuid.uuid4().hex[:12]}{suffix}"


def spread(rows: DataFrame, n: int) -> DataFrame:
    """A small table of work items with about one item a task."""
    return rows.repartition(max(1, n))
