"""Parts of files, read where they lie: tasks open a file of the store themselves and read what they need.

Stores that pyarrow opens by scheme (local files, S3, HDFS, GCS) are read by ranges and streams; of any
other store that only Spark's readers reach, contents come through Spark's binary source, whole.
"""

from __future__ import annotations

import contextlib
import io

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Schemes that tasks open themselves, and what pyarrow calls them.
SCHEMES = {"": "", "file": "", "s3": "s3://", "s3a": "s3://", "hdfs": "hdfs://", "gs": "gs://"}
#: Bytes of a stream in memory at a time.
CHUNK = 8 << 20
#: Arrow batches between the JVM and Python workers hold at most this many bytes, or one row.
BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """From now on; batches of rows alone grow with the rows' length."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def split_scheme(uri: str) -> tuple[str, str]:
    scheme, colon, rest = uri.partition(":")
    return (scheme, rest) if colon and "/" not in scheme else ("", uri)


def direct(uri: str) -> bool:
    return split_scheme(uri)[0] in SCHEMES


def opened(uri: str, content: bytes | None = None) -> pa.NativeFile:
    """A file to read and seek in; of its content where that has been read."""
    if content is not None:
        return pa.BufferReader(content)
    system, path = located(uri)
    return system.open_input_file(path)


def located(uri: str):
    """The file system of a uri and the path there."""
    from pyarrow import fs

    scheme, rest = split_scheme(uri)
    if SCHEMES[scheme] == "":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(SCHEMES[scheme] + rest.lstrip("/"))


def chunks(file: pa.NativeFile):
    while part := file.read(CHUNK):
        yield part


#: Tasks a core, at most, that list folders or read files: each of them takes many where there are many.
TASKS = 8


@contextlib.contextmanager
def few_listers(spark: SparkSession):
    """Within, Spark lists folders in TASKS tasks a core; else each folder has a task of its own, up to 10,000."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), TASKS * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored(spark: SparkSession, root: str) -> DataFrame:
    """Spark's binary source of every file below root."""
    bound_batches(spark)
    with few_listers(spark):
        found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return found.coalesce(TASKS * spark.sparkContext.defaultParallelism)  # Spark has a task for each 32 files


def listed(spark: SparkSession, root: str) -> DataFrame:
    """uri, length and content of every file below root; content is null where tasks open files themselves."""
    found = stored(spark, root)
    return found.select(F.col("path").alias("uri"), "length", F.lit(None).cast("binary").alias("content") if direct(root) else F.col("content"))


def copy(spark: SparkSession, pairs: list[tuple[str, str]], tasks: int) -> None:
    """Copies files from uri to uri in tasks, as streams (uploads in parts where the store has them).  A copy gets its name when it is whole, so a task may be run again."""

    def run(batches):
        import uuid

        for batch in batches:
            for source, target in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                system, path = located(target)
                folder, _, name = path.rpartition("/")
                system.create_dir(folder, recursive=True)
                part = f"{folder}/.{name}.{uuid.uuid4().hex}"
                with opened(source) as file, system.open_output_stream(part) as out:
                    for chunk in chunks(file):
                        out.write(chunk)
                system.move(part, path)
                stale = f"{folder}/.{name}.crc"  # Hadoop's checksum of what was there
                if system.get_file_info(stale).is_file:
                    system.delete_file(stale)
            yield pa.RecordBatch.from_arrays([batch.column(1)], names=["target"])

    if pairs:
        listed = spark.createDataFrame(pairs, "source string, target string").repartition(max(1, min(tasks, len(pairs))))
        listed.mapInArrow(run, "target string").write.format("noop").mode("overwrite").save()


def numbered_lines(spark: SparkSession, root: str, most: int) -> DataFrame:
    """uri, number (from 1), line (without its end) of files below root, gunzipped where named .gz; lines end with \\n alone, the last one maybe with nothing.

    A line of more than `most` bytes has a null line and ends its file: no more than that is held.
    """

    def parts(file, zipped):
        import gzip

        stream = gzip.GzipFile(fileobj=file) if zipped else file
        number = 0
        while line := stream.readline(most + 1):
            number += 1
            if len(line) > most and not (len(line) == most + 1 and line.endswith(b"\n")):
                yield number, None
                return
            yield number, line.removesuffix(b"\n")

    def run(batches):
        for batch in batches:
            for uri, content in zip(batch.column("uri").to_pylist(), batch.column("content").to_pylist(), strict=True):
                with opened(uri, content) as file:
                    held, size = [], 0
                    for number, line in parts(io.BufferedReader(file, CHUNK), uri.lower().endswith(".gz")):
                        held.append((number, line))
                        size += len(line or b"")
                        if size > CHUNK or len(held) >= 10_000:
                            yield rows(uri, held)
                            held, size = [], 0
                    if held:
                        yield rows(uri, held)

    def rows(uri, held):
        return pa.RecordBatch.from_arrays([pa.array([uri] * len(held), pa.string()), pa.array([n for n, _ in held], pa.int64()), pa.array([x for _, x in held], pa.binary())], names=["uri", "number", "line"])

    return listed(spark, root).select("uri", "content").mapInArrow(run, "uri string, number long, line binary")
