"""New versions in the landing store: a worklist by listing, and the same as a stream of arrivals."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.store import Store

VERDICTS = ("_VALIDATED.json", "_SUCCESS", "_REJECTED.json")


def pending(landing: Store) -> list[str]:
    """Prefixes that have dataset.json and all their manifests, and no verdict."""
    names = set(landing.names())
    out = []
    for name in sorted(n for n in names if n.endswith("/dataset.json")):
        prefix = name.removesuffix("/dataset.json")
        if any(f"{prefix}/{v}" in names for v in VERDICTS):
            continue
        if all(f"{prefix}/{g['manifest']}" in names for g in landing.load(name).get("groups", [])):
            out.append(prefix)
    return out


def watch(landing: Store, checkpoint: str, handle: Callable[[str], None]) -> StreamingQuery:
    """Calls handle for each pending prefix whose dataset.json has arrived since the last run, then ends."""
    spark = landing.spark
    schema = "path string, modificationTime timestamp, length long, content binary"
    arrived = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", "dataset.json").option("recursiveFileLookup", True).load(landing.root)

    def each(batch, _):
        new = {r["path"] for r in batch.select(F.regexp_extract("path", r"([^/]+/[^/]+/[^/]+)/dataset\.json$", 1).alias("path")).collect()}
        for prefix in pending(landing):
            if prefix in new:
                handle(prefix)

    return arrived.select("path").writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
