"""Datasets as files: listings, digests, strict JSON lines, evaluation tables and raw token shards.

Listings and lines come through Spark's file sources, so any store that Spark reaches will do; see `ranges`
for how parts and streams of files are read.
"""

from __future__ import annotations

import csv
import gzip
import hashlib
import io
import itertools
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths
from . import ranges

#: A JSON line longer than this is refused.
RECORD_BYTES = 16 << 20
_NUMPY = {"uint8": "u1", "uint16": "u2", "uint32": "u4", "int32": "i4", "int64": "i8", "float16": "f2", "float32": "f4", "float64": "f8"}


def relative(path: Column, root: str) -> Column:
    """path below root, whatever the scheme's spelling."""
    tail = root.split(":", 1)[-1].strip("/")
    return F.element_at(F.split(path, "/" + tail.replace(".", "\\.").replace("+", "\\+") + "/", 2), -1)


def _binary(spark: SparkSession, root: str) -> DataFrame:
    return ranges.stored(spark, root).withColumn("path", relative(F.col("path"), root))


def objects(spark: SparkSession, root: str) -> DataFrame:
    """path, length of every file below root; contents aren't read."""
    return _binary(spark, root).select("path", "length")


def digests(spark: SparkSession, root: str, wanted: DataFrame | None = None) -> DataFrame:
    """path, length, sha256 of files below root, of any size: they are hashed as streams."""

    def run(batches):
        for batch in batches:
            found = []
            for uri, content in zip(batch.column("uri").to_pylist(), batch.column("content").to_pylist(), strict=True):
                sha = hashlib.sha256()
                with ranges.opened(uri, content) as file:
                    for part in ranges.chunks(file):
                        sha.update(part)
                found.append(sha.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("length"), pa.array(found, pa.string())], names=["path", "length", "sha256"])

    found = ranges.listed(spark, root).withColumn("path", relative(F.col("uri"), root))
    found = found if wanted is None else found.join(wanted.select("path"), "path", "left_semi")
    return found.select("path", "length", "uri", "content").mapInArrow(run, "path string, length long, sha256 string")


def lines(spark: SparkSession, root: str, only_newlines: bool = True) -> DataFrame:
    """path, line: lines that end with \\n alone, or with any of \\r, \\n and \\r\\n."""
    ranges.bound_batches(spark)
    reader = spark.read.option("recursiveFileLookup", True)
    reader = reader.option("lineSep", "\n") if only_newlines else reader
    with ranges.few_listers(spark):
        found = reader.text(root)
    return found.select(relative(F.col("_metadata.file_path"), root).alias("path"), F.col("value").alias("line"), F.col("_metadata.file_block_start").alias("_at"))


#: What json_rows gives.
ROW_COLUMNS = {"path": "string", "row": "string", "text": "string", "has_text": "boolean", "is_text": "boolean", "error": "string"}


def json_rows(spark: SparkSession, root: str, field: str = "text", only_newlines: bool = True, strict: bool = True, columns: tuple[str, ...] = tuple(ROW_COLUMNS)) -> DataFrame:
    """path, row (as canonical JSON), text, has_text, is_text, error: those asked for, as what isn't read needn't be spelled and passed on.

    Blank lines are left out.  A line that isn't a JSON object is an error, or with strict off an object
    whose _value it is.  Duplicate keys keep their last value, NaN is allowed: Python's json decides.
    """

    def parse(batches):
        for batch in batches:
            out = {c: [] for c in columns}
            for path, line, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), pc.binary_length(batch.column(1)).to_pylist(), strict=True):
                if not line.strip():
                    continue
                row, error = None, None
                if size > RECORD_BYTES:
                    error = "record too long"
                else:
                    try:
                        row = json.loads(line)
                    except ValueError as e:
                        error = f"not JSON: {e}"
                if error is None and not isinstance(row, dict):
                    row, error = ({"_value": row}, None) if not strict else (None, "not an object")
                value = row.get(field) if row else None
                for column, put in out.items():
                    if column == "path":
                        put.append(path)
                    elif column == "row":
                        put.append(None if row is None else json.dumps(row, sort_keys=True, separators=(",", ":"), ensure_ascii=False))
                    elif column == "text":
                        put.append(value if isinstance(value, str) else None)
                    elif column == "has_text":
                        put.append(value is not None)
                    elif column == "is_text":
                        put.append(isinstance(value, str))
                    else:
                        put.append(error)
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)

    schema = pa.schema([(c, pa.bool_() if ROW_COLUMNS[c] == "boolean" else pa.string()) for c in columns])
    return lines(spark, root, only_newlines).select("path", "line").mapInArrow(parse, ", ".join(f"{c} {ROW_COLUMNS[c]}" for c in columns))


def csv_rows(spark: SparkSession, root: str, status: str, metric: str) -> DataFrame:
    """path, status, metric of CSV files, each by its own header."""
    columns = ["path", "status", "metric"]

    def run(batches):
        for batch in batches:
            for path, uri, content in zip(batch.column("path").to_pylist(), batch.column("uri").to_pylist(), batch.column("content").to_pylist(), strict=True):
                with ranges.opened(uri, content) as file:
                    raw = gzip.GzipFile(fileobj=file) if path.lower().endswith(".gz") else file
                    rows = csv.DictReader(io.TextIOWrapper(raw, encoding="utf-8-sig", errors="replace", newline=""))
                    while part := list(itertools.islice(rows, 10_000)):
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in ([path] * len(part), [r.get(status) for r in part], [r.get(metric) for r in part])], names=columns)

    found = ranges.listed(spark, root).withColumn("path", relative(F.col("uri"), root)).filter(F.lower("path").rlike(r"\.csv(\.gz)?$"))
    return found.select("path", "uri", "content").mapInArrow(run, "path string, status string, metric string")


def eval_rows(spark: SparkSession, root: str, status: str = "status", metric: str = "score") -> DataFrame:
    """shard, status, metric (as written) from JSON lines and CSV files with headers."""
    listing = objects(spark, root)
    low = F.lower("path")
    kinds = listing.agg(F.max(low.rlike(r"\.jsonl(\.gz)?$")), F.max(low.rlike(r"\.csv(\.gz)?$"))).first()
    parts = []
    if kinds[0]:
        spelled = F.to_json(F.variant_get(F.try_parse_json("row"), f"$.{metric}", "variant"))  # 1 and "1" differ
        metric_as_written = F.nullif(F.coalesce(spelled, F.get_json_object("row", f"$.{metric}")), F.lit("null"))
        rows = json_rows(spark, root, only_newlines=False, strict=False).filter(F.lower("path").rlike(r"\.jsonl(\.gz)?$"))
        parts.append(rows.select(F.col("path").alias("shard"), F.get_json_object("row", f"$.{status}").alias("status"), metric_as_written.alias("metric")))
    if kinds[1]:
        parts.append(csv_rows(spark, root, status, metric).withColumnRenamed("path", "shard"))
    if not parts:
        raise ValueError(f"no evaluation rows below {root}: JSON lines or CSV are wanted")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _decoder(dtype: str, order: str, chunk: int):
    """From (path, first position, bytes) to batches of about chunk ids; those of small shards go together."""
    kind = {"little": "<", "big": ">"}.get(order, "=") + _NUMPY[dtype]
    width = paths.WIDTHS[dtype]

    def joined(held):
        sizes = [len(part) for _, _, part in held]
        owner = np.repeat(np.arange(len(held)), sizes)
        pos = np.concatenate([np.arange(first, first + len(part)) for _, first, part in held])
        return pa.RecordBatch.from_arrays([pa.array([path for path, _, _ in held], pa.string()).take(pa.array(owner)), pa.array(pos, pa.int64()), pa.array(np.concatenate([part for _, _, part in held]), pa.int64())], names=["path", "pos", "id"])

    def decode(shards):
        held, size = [], 0
        for path, base, raw in shards:
            ids = np.frombuffer(raw[: len(raw) // width * width], kind)
            for at in range(0, len(ids), chunk):
                part = ids[at : at + chunk].astype(np.int64 if ids.dtype.kind in "iu" else np.float64).astype(np.int64)
                held.append((path, base + at, part))
                size += len(part)
                if size >= chunk:
                    yield joined(held)
                    held, size = [], 0
        if held:
            yield joined(held)

    return decode


def _rows(batches):
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def token_ids(spark: SparkSession, root: str, dtype: str = "uint32", order: str = "little", header: int = 0, most_bytes: int | None = None) -> DataFrame:
    """path, pos, id of raw integer shards; files above most_bytes are left out before they are read."""
    found = ranges.stored(spark, root)
    if most_bytes is not None:
        found = found.filter(F.col("length") <= most_bytes)
    decode = _decoder(dtype, order, 65_536)
    content = F.expr(f"substring(content, {header + 1}, 2147483647)") if header else F.col("content")
    return found.select(relative(F.col("path"), root).alias("path"), F.lit(0).cast("long").alias("base"), content.alias("raw")).mapInArrow(lambda batches: decode(_rows(batches)), "path string, pos long, id long")


def sampled_ids(spark: SparkSession, root: str, seed: Column, window: int = 16_384, n: int = 4, dtype: str = "uint32", order: str = "little") -> DataFrame:
    """As token_ids, of n seeded windows a file."""
    from ..functions.keys import sample_offsets, shard_seed

    width = paths.WIDTHS[dtype]
    found = ranges.listed(spark, root).withColumn("path", relative(F.col("uri"), root))
    offsets = sample_offsets(F.col("length"), window, n, shard_seed(seed, F.col("path")), align=width)

    def read(batches):
        for path, uri, content, places in _rows(batches):
            with ranges.opened(uri, content) as file:
                for at in places:
                    yield path, at // width, file.read_at(window, at)

    decode = _decoder(dtype, order, 65_536)
    return found.select("path", "uri", "content", offsets.alias("places")).mapInArrow(lambda batches: decode(read(batches)), "path string, pos long, id long")


def npy_files(spark: SparkSession, root: str) -> DataFrame:
    """Paths whose first bytes are a NumPy header; no more than those are read."""

    def run(batches):
        for batch in batches:
            flags = []
            for uri, content in zip(batch.column("uri").to_pylist(), batch.column("content").to_pylist(), strict=True):
                with ranges.opened(uri, content) as file:
                    flags.append(file.read(6) == b"\x93NUMPY")
            yield pa.RecordBatch.from_arrays([batch.column("path").filter(pa.array(flags, pa.bool_()))], names=["path"])

    found = ranges.listed(spark, root).withColumn("path", relative(F.col("uri"), root))
    return found.select("path", "uri", "content").mapInArrow(run, "path string")
