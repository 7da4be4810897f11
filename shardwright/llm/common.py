"""Plumbing shared by the operators: tables, the shared folder, bounded Arrow batches, Arrow helpers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Arrow batches between the JVM and Python workers hold at most this many bytes.
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(key, str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir).

    Only a local session may go without the setting; it gets a folder that ends with the process.
    """
    found, context = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext
    if found:
        return found.rstrip("/")
    if not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.getCheckpointDir() is None:  # the setting itself can't be changed in a session
        own = tempfile.mkdtemp(prefix="shardwright-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        context.setCheckpointDir(f"file://{own}")
    return context.getCheckpointDir().rstrip("/")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared folder and read it back: lineage is cut and executors may be lost."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def discard(*frames: DataFrame) -> None:
    """Deletes what materialise wrote, when nothing reads it any more; what isn't discarded goes when the application ends."""
    for df in frames:
        spark = df.sparkSession
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.scratch)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def free_names(taken: list[str], *names: str) -> list[str]:
    """The names, each with as many underscores behind it as keep it clear (in any case of letters) of the taken ones."""
    used, out = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def as_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; a null is an empty text."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def held_out(doc_id, modulus: int):
    """True where crc32 of the id as text leaves 1; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus == 1, F.lit(False))


def sum_blobs(df: DataFrame, dtype: str = "float64", fan_in: int = 16) -> np.ndarray | None:
    """Element-wise sum of equally long vectors, one in each row's column `blob`.

    Tasks add up streams of rows, so the driver holds fan_in of them and a task one and a batch.
    """

    def add(batches):
        total = None
        for batch in batches:
            for raw in batch.column(0):
                x = np.frombuffer(raw.as_py(), dtype)
                total = x.copy() if total is None else total + x
        if total is not None:
            yield pa.RecordBatch.from_pydict({"blob": pa.array([total.tobytes()], pa.binary())})

    rows = df.select("blob").repartition(fan_in).mapInArrow(add, "blob binary").collect()
    parts = [np.frombuffer(r[0], dtype) for r in rows]
    return np.sum(parts, axis=0) if parts else None
