"""Entries between their documents (manifest.json) and their relation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths
from ..sources.store import canonical, sha256

COLUMNS = "path string, grp string, sha256 string, bytes long, count_unit string, count_value long, container string, dtype string, byte_order string, header_bytes int, codec string, split string, source string, domain string"
# What a document calls itself.
MANIFEST_SCHEMA, DATASET_SCHEMA, SEAL_SCHEMA = "shardwright-manifest/1", "shardwright-dataset/1", "shardwright-seal/1"
COUNT_UNITS = ("rows", "tokens", "items", "indices", "bytes")


class BadEntry(ValueError):
    """An entry breaks its schema."""


def to_document(row: dict) -> dict:
    """An entry as it stands in a manifest; what is unknown is left out."""
    out = {"path": row["path"], "sha256": row["sha256"], "bytes": row["bytes"], "format": {k: row[k] for k in ("container", "dtype", "byte_order", "header_bytes", "codec")}}
    if row["count_unit"]:
        out["count"] = {"unit": row["count_unit"], "value": row["count_value"]}
    if row["split"]:
        out["split"] = row["split"]
    if labels := {k: row[k] for k in paths.LABEL_KEYS if row[k] is not None}:
        out["labels"] = labels
    return out


def from_document(entry: dict, group: str) -> tuple:
    """The row of an entry; BadEntry tells what is wrong with it."""
    whole = lambda v: isinstance(v, int) and not isinstance(v, bool) and v >= 0
    if not isinstance(entry, dict) or entry.keys() - {"path", "sha256", "bytes", "format", "count", "split", "labels"}:
        raise BadEntry("unknown keys")
    path, digest, form, count, labels = entry.get("path"), entry.get("sha256"), entry.get("format"), entry.get("count"), entry.get("labels") or {}
    if not isinstance(path, str) or not path or path.startswith("/") or ".." in path.split("/"):
        raise BadEntry("path")
    if not isinstance(digest, str) or len(digest) != 64 or set(digest) - set("0123456789abcdef"):
        raise BadEntry(f"{path}: sha256")
    if not whole(entry.get("bytes")):
        raise BadEntry(f"{path}: bytes")
    if not isinstance(form, dict) or form.keys() - {"container", "dtype", "byte_order", "header_bytes", "codec"} or not isinstance(form.get("container"), str) or not whole(form.get("header_bytes", 0)):
        raise BadEntry(f"{path}: format")
    if count is not None and (not isinstance(count, dict) or count.get("unit") not in COUNT_UNITS or not whole(count.get("value"))):
        raise BadEntry(f"{path}: count")
    if entry.get("split") is not None and entry["split"] not in paths.SPLITS:
        raise BadEntry(f"{path}: split")
    if not isinstance(labels, dict) or "split" in labels or not all(isinstance(v, str) for v in labels.values()):
        raise BadEntry(f"{path}: labels")
    count = count or {}
    return (path, group, digest, entry["bytes"], count.get("unit"), count.get("value"), form["container"], form.get("dtype"), form.get("byte_order"), form.get("header_bytes", 0), form.get("codec", "none"), entry.get("split"), labels.get("source"), labels.get("domain"))


def manifest_bytes(entries: DataFrame, group: str) -> bytes:
    """A group's manifest: entries by path, totals counted anew.  Raises on a path that repeats."""
    found = [r.asDict() for r in entries.filter(F.col("grp") == group).orderBy("path").collect()]
    names = [r["path"] for r in found]
    if len(set(names)) != len(names):
        raise BadEntry("a path repeats")
    return canonical({"schema_version": MANIFEST_SCHEMA, "group": group, "entries": [to_document(r) for r in found], "objects": len(found), "bytes": sum(r["bytes"] for r in found)})


def read_manifest(spark: SparkSession, document: dict, group: str) -> tuple[DataFrame, list[str]]:
    """The entries, and what is wrong with those left out."""
    good, bad = [], []
    for e in document.get("entries", []):
        try:
            good.append(from_document(e, group))
        except BadEntry as problem:
            bad.append(str(problem))
    return spark.createDataFrame(good, COLUMNS), bad


__all__ = ["canonical", "sha256"]
