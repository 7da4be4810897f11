"""Files written from relations: token shards and JSON lines, each path's parts in order."""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ranges


def little_endian(number: Column) -> Column:
    """The four bytes of a number from 0 to 2**32 - 1."""
    n = number.cast("long")
    byte = lambda at: F.shiftright(n, at).bitwiseAND(255)
    turned = F.shiftleft(byte(0), 24).bitwiseOR(F.shiftleft(byte(8), 16)).bitwiseOR(F.shiftleft(byte(16), 8)).bitwiseOR(byte(24))
    return F.unhex(F.lpad(F.hex(turned), 8, "0"))


def line(text: Column) -> Column:
    return F.encode(F.concat(text, F.lit("\n")), "UTF-8")


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Buffer]]:
    """path and the bytes of its parts, for each run of rows with a path; the bytes stay where Arrow has them, end to end."""
    paths, parts = batch.column(0), batch.column(1).cast(pa.large_binary())
    if parts.null_count:
        raise ValueError("a part is null")
    if not len(parts):
        return
    _, offsets, data = parts.buffers()
    at = np.frombuffer(offsets, np.int64)[parts.offset : parts.offset + len(parts) + 1]
    changes = pc.not_equal(paths.slice(1), paths.slice(0, len(paths) - 1)).fill_null(True)
    starts = [0, *(np.flatnonzero(changes.to_numpy(zero_copy_only=False)) + 1).tolist()]
    for first, end in itertools.pairwise([*starts, len(parts)]):
        yield paths[first].as_py(), data.slice(at[first], at[end] - at[first]) if data is not None else pa.py_buffer(b"")


def write(parts: DataFrame, root: str) -> None:
    """Writes one file a path below root.  parts: path, pos (of any type that sorts), part (binary), appended by pos.

    A task sorts its paths' parts (on disk where they are many) and streams them out; a file gets its
    name when it is whole, so a task may be run again.  root is of a store that `ranges` opens.
    """
    if not ranges.direct(root):
        raise ValueError(f"{root} can't be written by tasks")

    def run(batches):
        for path, own in itertools.groupby(itertools.chain.from_iterable(map(_runs, batches)), key=lambda r: r[0]):
            system, at = ranges.located(f"{root}/{path}")
            folder = at.rpartition("/")[0]
            system.create_dir(folder, recursive=True)
            hidden = f"{folder}/.{uuid.uuid4().hex}"
            with system.open_output_stream(hidden, buffer_size=1 << 20) as out:
                for _, part in own:
                    out.write(part)
            system.move(hidden, at)
        yield pa.RecordBatch.from_pydict({"path": pa.array([], pa.string())})

    ranges.bound_batches(parts.sparkSession)
    ordered = parts.select("path", "pos", "part").repartition("path").sortWithinPartitions(F.xxhash64("path"), "path", "pos")  # paths that begin alike are told apart by their hash, at less cost
    ordered.select("path", "part").mapInArrow(run, "path string").write.format("noop").mode("overwrite").save()
