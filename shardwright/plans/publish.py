"""Publishing: from a folder of files to a described version in the landing store, then to the data store.

What costs (digests, counts) is one Spark job over the payload; the driver writes a few small
documents in the order that makes them safe: dataset.json first and only if absent, payload, manifests
last; at promotion the seal last of all.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names, paths
from ..operators import manifest
from ..operators.splits import partition_rows
from ..sources import files
from ..sources.store import Exists, Store, canonical, sha256
from . import documents, families


class PublishError(RuntimeError):
    """The dataset can't be published as it is."""


@dataclass
class Plan:
    dataset_id: str
    entries: DataFrame
    document: dict
    manifests: dict[str, bytes] = field(default_factory=dict)


def problem(spark: SparkSession, value: str | None, rule) -> str | None:
    return spark.createDataFrame([(value,)], "v string").select(rule(F.col("v"))).first()[0]


def describe(spark: SparkSession, root: str, defaults: dict | None = None) -> DataFrame:
    """Entries (documents.COLUMNS) of every payload file below root; the first folder is the group."""
    defaults = defaults or {}
    found = files.digests(spark, root).filter(~paths.base_name(F.col("path")).isin(*paths.ROOT_CONTROLS) & (paths.depth(F.col("path")) > 0))
    path = F.col("path")
    own = lambda k: F.coalesce(paths.claimed(path, k).cast("string"), F.lit(defaults.get(k)).cast("string"))
    found = found.withColumns({
        "grp": paths.group_of(path), "container": own("container"), "dtype": own("dtype"), "byte_order": own("byte_order"), "header_bytes": F.coalesce(own("header_bytes").cast("int"), F.lit(0)), "codec": F.coalesce(own("codec"), F.lit("none")),
        "split": F.when(paths.shard_split(path).isin(*paths.SPLITS), paths.shard_split(path)), "source": paths.labels(path)["source"], "domain": paths.labels(path)["domain"],
    })
    listing = files.objects(spark, root).filter(F.lower("path").rlike(r"\.jsonl(\.gz)?$"))
    counted = None
    if not listing.isEmpty():
        good = files.json_rows(spark, root, columns=("path", "error")).filter(F.lower("path").rlike(r"\.jsonl(\.gz)?$"))
        counted = good.groupBy("path").agg(F.count_if(F.col("error").isNotNull()).alias("bad"), F.count("*").alias("n")).select("path", F.when(F.col("bad") == 0, F.col("n")).alias("rows"))
    found = found.join(counted, "path", "left") if counted is not None else found.withColumn("rows", F.lit(None).cast("long"))
    raw = (F.col("container") == "raw") & paths.width(F.col("dtype")).isNotNull()
    unit = F.lit(defaults.get("raw_unit", "tokens"))
    return found.select(
        "path", "grp", "sha256", F.col("length").alias("bytes"), F.when(raw, unit).when(F.col("rows").isNotNull(), "rows").alias("count_unit"),
        F.when(raw, F.floor((F.col("length") - F.col("header_bytes")) / paths.width(F.col("dtype")))).otherwise(F.col("rows")).alias("count_value"),
        "container", "dtype", "byte_order", "header_bytes", "codec", "split", "source", "domain",
    )


def build(spark: SparkSession, root: str, dataset_id: str, purpose: str, profiles: dict[str, str], defaults: dict | None = None, partitions: dict[str, list[tuple[str, str]]] | None = None, tokenizer: dict | None = None, **extra) -> Plan:
    """profiles: the profile of each group.  partitions: (name, glob) of each group; else one for each split that its files name.

    defaults: the format of files whose extension doesn't tell; else the family's.  tokenizer: what pin() gives, for groups of tokens.
    """
    defaults = families.defaults(dataset_id) if defaults is None else defaults
    if bad := problem(spark, dataset_id, names.id_problem):
        raise PublishError(f"dataset id: {bad}")
    if bad := problem(spark, purpose, names.purpose_problem):
        raise PublishError(f"purpose: {bad}")
    entries = describe(spark, root, defaults).cache()
    if not entries.filter(F.size(paths.label_segments(F.col("path"))) > len(paths.LABEL_KEYS)).isEmpty():
        raise PublishError("a file is nested deeper than there are labels")
    if not entries.filter("container is null").isEmpty():
        raise PublishError("a file's format is unknown: name it by its extension or give defaults")
    sums = {r["grp"]: r for r in manifest.totals(entries).collect()}
    groups, manifests = [], {}
    for name in sorted(k for k in sums if k != manifest.WHOLE):
        if name not in profiles:
            raise PublishError(f"group {name} has no profile")
        own = entries.filter(F.col("grp") == name)
        splits = sorted(r["split"] for r in own.select("split").distinct().collect() if r["split"])
        globs = (partitions or {}).get(name) or [(s, f"{s}-*") for s in splits]
        counted = {r["name"]: r["rows"] for r in partition_rows(own, globs).collect()} if globs else {}
        manifests[name] = documents.manifest_bytes(own, name)
        groups.append({"name": name, "profile": profiles[name], "prefix": name, "manifest": f"{name}/manifest.json", "manifest_sha256": sha256(manifests[name]), "coverage": defaults.get("coverage", "partition"), "partitions": [{"name": n, "by": "path", "glob": g, "rows": counted[n]} for n, g in globs if counted.get(n) is not None], "depends_on": [tokenizer] if tokenizer and profiles[name] == "pretrain-tokens/v1" else [], **extra.pop(f"{name}_fields", {})})
    if not groups:
        raise PublishError("there is nothing to publish")
    whole = sums[manifest.WHOLE]
    run = {"application": spark.sparkContext.applicationId, "master": spark.sparkContext.master.split("[")[0], "job": os.environ.get("USER", "")}
    document = {"schema_version": documents.DATASET_SCHEMA, "dataset_id": dataset_id, "purpose": purpose, "mutability": "frozen", "inventory": {"objects": whole["objects"], "bytes": whole["bytes"]}, "build": run, "groups": groups, **extra}
    return Plan(dataset_id, entries, document, manifests)


def pin(data: Store, name: str) -> dict:
    """The dependency on a published tokenizer, tokenizer/<name> (its latest version) or tokenizer/<name>/<version>."""
    from .read import latest

    parts = name.split("/")
    if parts[0] != "tokenizer" or len(parts) not in (2, 3):
        raise PublishError(f"{name} names no tokenizer")
    dataset_id = "/".join(parts[:2])
    version = parts[2] if len(parts) == 3 else latest(data, dataset_id)
    if version is None or not data.exists(f"{dataset_id}/{version}/_VALIDATED.json"):
        raise PublishError(f"{name} isn't published")
    first = data.load(f"{dataset_id}/{version}/dataset.json")["groups"][0]
    return {"role": "tokenizer", "dataset_id": dataset_id, "version": version, "manifest_sha256": first["manifest_sha256"]}


def next_version(landing: Store, data: Store, dataset_id: str) -> str:
    """One more than the greatest version in either store."""
    taken = [n[len(dataset_id) + 1 :].split("/")[0] for s in (landing, data) for n in s.names(dataset_id) if n.startswith(dataset_id + "/")]
    taken += [n.rpartition("/")[2].removesuffix(".json") for n in data.names(f"_catalog/{dataset_id}")]
    numbers = [int(v[1:]) for v in taken if v[:1] == "v" and v[1:].isdigit()]
    return f"v{max(numbers, default=0) + 1}"


def publish(plan: Plan, source: Store, landing: Store, data: Store, attempts: int = 8) -> str:
    """Writes the plan as a new version and returns it.  Payload is described once, however often a version turns out to be taken."""
    for _ in range(attempts):
        version = next_version(landing, data, plan.dataset_id)
        at = f"{plan.dataset_id}/{version}"
        number = int(version[1:])
        block = {"id": version, "relation": "supersedes", "of": f"v{number - 1}" if number > 1 else None}
        try:
            landing.put(f"{at}/dataset.json", canonical(plan.document | {"version": block}))
        except Exists:
            continue
        source.copy([r["path"] for r in plan.entries.select("path").collect()], Store(landing.spark, landing.uri(at)))
        for name, raw in plan.manifests.items():
            landing.put(f"{at}/{name}/manifest.json", raw)
        return version
    raise PublishError("no version was free")


def promote(result, landing: Store, data: Store, now: str, workers: int = 16) -> dict:
    """Copies a version that passed to the data store, enters it in the catalog and seals it, in this order.  The seal holds the digests of what was copied."""
    at = f"{result.dataset_id}/{result.version}"
    if not result.ok:
        raise PublishError("the version didn't pass")
    if data.exists(f"{at}/_VALIDATED.json"):
        raise PublishError("the version is sealed already")
    raw = landing.get(f"{at}/dataset.json")
    document = landing.load(f"{at}/dataset.json")
    manifests = {g["name"]: landing.load(f"{at}/{g['manifest']}") for g in document["groups"]}
    listed = [e["path"] for m in manifests.values() for e in m["entries"]]
    control = ["dataset.json", *(g["manifest"] for g in document["groups"])]
    Store(landing.spark, landing.uri(at)).copy([*listed, *control], Store(data.spark, data.uri(at)), workers)
    sums = {r["path"]: r["sha256"] for r in files.digests(data.spark, data.uri(at)).filter(~F.col("path").isin(control)).collect()}
    root = sha256(raw)
    entry = {"dataset_id": result.dataset_id, "version": result.version, "uri": data.uri(at), "dataset_sha256": root, **document["inventory"]}
    data.put_same(f"_catalog/{at}.json", canonical(entry))
    from .readme import render

    data.put_same(f"{at}/README.md", render(document).encode())
    seal = {"schema_version": documents.SEAL_SCHEMA, "dataset_sha256": root, "manifest_sha256": {n: sha256(landing.get(f"{at}/{n}/manifest.json")) for n in manifests}, "digests": sums, "sealed_at": now}
    data.put(f"{at}/_VALIDATED.json", canonical(seal))
    return seal
