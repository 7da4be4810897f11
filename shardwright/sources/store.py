"""Control documents: small files that the driver reads and writes, through Hadoop's file systems."""

from __future__ import annotations

import atexit
import hashlib
import json
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

from . import ranges


class StoreError(RuntimeError):
    """The store refused or failed."""


class Missing(StoreError):
    """There is no such file."""


class Exists(StoreError):
    """There is such a file already."""


def canonical(document) -> bytes:
    """JSON with sorted keys, no spaces, UTF-8; NaN is refused."""
    return json.dumps(document, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False).encode()


def sha256(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


class Store:
    """A folder of any file system that Spark knows."""

    def __init__(self, spark: SparkSession, root: str):
        if not isinstance(spark, SparkSession):
            raise TypeError("a SparkSession is wanted")
        self.spark, self.root = spark, root.rstrip("/")
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def uri(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def get(self, name: str) -> bytes:
        if not self.exists(name):
            raise Missing(name)
        stream = self.fs.open(self.path(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def load(self, name: str):
        return json.loads(self.get(name))

    def put(self, name: str, raw: bytes, replace: bool = False) -> None:
        if not replace and self.exists(name):
            raise Exists(name)
        stream = self.fs.create(self.path(name), replace)
        try:
            stream.write(bytearray(raw))
        finally:
            stream.close()

    def put_same(self, name: str, raw: bytes) -> bool:
        """Writes unless the same bytes are there; True if it wrote."""
        if self.exists(name):
            if self.get(name) != raw:
                raise Exists(f"{name} is there with other contents")
            return False
        self.put(name, raw)
        return True

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def names(self, prefix: str = "") -> list[str]:
        """Names of all files below a folder, sorted."""
        if not self.exists(prefix):
            return []
        found, out = self.fs.listFiles(self.path(prefix), True), []
        top = self.fs.makeQualified(self.path("")).toUri().getPath().rstrip("/") + "/"
        while found.hasNext():
            out.append(found.next().getPath().toUri().getPath()[len(top) :])
        return sorted(out)

    def copy(self, names: list[str], to: Store, workers: int = 16) -> None:
        """Copies files to the same names in another store; a file that is there is replaced.

        Tasks copy, `workers` at a time, where they open both stores themselves (see ranges); else threads of the driver do.
        """
        if ranges.direct(self.uri("")) and ranges.direct(to.uri("")):
            return ranges.copy(self.spark, [(self.uri(n), to.uri(n)) for n in names], workers)
        from concurrent.futures import ThreadPoolExecutor

        util = self.jvm.org.apache.hadoop.fs.FileUtil

        def one(name):
            if not util.copy(self.fs, self.path(name), to.fs, to.path(name), False, True, self.conf):
                raise StoreError(f"can't copy {name}")

        with ThreadPoolExecutor(workers) as pool:
            list(pool.map(one, names))


def scratch(spark: SparkSession, name: str) -> str:
    """The uri of a new folder below the one that driver and executors share (spark.checkpoint.dir); it goes when the application ends.

    Only a local session may go without the setting.
    """
    shared, context = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext
    if not shared:
        if not context.master.startswith("local["):
            raise StoreError("set spark.checkpoint.dir to a folder that all executors share")
        if context.getCheckpointDir() is None:  # the setting itself can't be changed in a session
            own = tempfile.mkdtemp(prefix="shardwright-")
            atexit.register(shutil.rmtree, own, ignore_errors=True)
            context.setCheckpointDir(f"file://{own}")
        shared = context.getCheckpointDir()
    found = Store(spark, f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    found.fs.mkdirs(found.path(""))
    found.fs.deleteOnExit(found.path(""))
    return found.root
