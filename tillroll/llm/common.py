"""What the corpus operators share: inputs, batches of bounded size, checkpoints, shipping the package."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that a task turns into arrays at a time; a single longer text is one batch of its own.
BATCH_BYTES = 2 << 20

#: Spark's setting that deletes the shuffle files of a query as it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_SHIPPED: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that they can import it."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if os.path.isdir(package):
        root = os.path.dirname(package)
        out = os.path.join(tempfile.mkdtemp(prefix="tillroll-"), f"{os.path.basename(package)}.zip")
        with zipfile.ZipFile(out, "w") as z:
            for folder, _, names in os.walk(package):
                for n in names:
                    if n.endswith(".py"):
                        path = os.path.join(folder, n)
                        z.write(path, os.path.relpath(path, root))
        sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut the lineage by a checkpoint in the folder that the session names, which all executors share.

    Only a session without ``spark.checkpoint.dir`` (a test) gets a folder of its own.
    """
    work_folder(df.sparkSession)
    if not eager:  # its shuffle files are read later
        return df.checkpoint(eager=False)
    with _tidy(df.sparkSession):
        return df.select("*").checkpoint()  # the setting holds for queries that are planned under it


@contextmanager
def _tidy(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs in here go as it ends, since what it stores takes their place. Otherwise they stay
    until the driver collects its garbage, and small rounds add up. The session's own setting is put back."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: the cut for what is large, compressed and read by column."""
    return kept(df)[0]


def kept(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` as a Parquet table in the shared folder, and its path, for :func:`emptied`."""
    path = f"{work_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    with _tidy(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def emptied(df: DataFrame, path: str) -> None:
    """Give back the disk of a table of :func:`kept` that nothing reads any more."""
    df.sparkSession.createDataFrame([], df.schema).write.mode("overwrite").parquet(path)


def work_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, set from ``spark.checkpoint.dir``; a new one only where that is unset."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="tillroll-checkpoint-"))
    return sc.getCheckpointDir()


def slices(batch: pa.RecordBatch, column: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with at most ``most`` bytes in ``column``, but one row at least."""
    if not batch.num_rows:
        return
    ends = np.cumsum(value_bytes(batch.column(column)))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def value_bytes(a: pa.Array) -> np.ndarray:
    """Bytes of each string of an array; null counts as empty."""
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(a), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def flat(a: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array without gaps; null is empty. offsets has a value more than rows."""
    import pyarrow.compute as pc

    a = pc.fill_null(a.cast(pa.large_string()) if a.type != pa.large_string() else a, "")
    offsets = np.frombuffer(a.buffers()[1], dtype=np.int64)[a.offset : a.offset + len(a) + 1]
    data = a.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (two multiply and shift rounds) over an unsigned array."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(32))
