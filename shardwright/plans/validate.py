"""Gate A: every claim of a landed version held against its files.

Control documents are judged on the driver; everything over entries, objects and payload is a
DataFrame of violations, and all of them run as one union, so a check that finds something never
keeps another from running.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import names, paths
from ..operators import lineage, manifest, splits
from ..sources import files
from ..sources.store import Missing, Store, sha256
from . import documents, profiles
from .families import families as known_families
from .publish import problem

CORE = ("schema_version", "dataset_id", "version", "purpose", "mutability", "inventory", "groups")


@dataclass
class Result:
    dataset_id: str
    version: str
    violations: list[tuple[str, str | None, str | None]] = field(default_factory=list)  # code, path, detail

    @property
    def status(self) -> str:
        codes = {c for c, *_ in self.violations}
        return "ok" if not codes else "incomplete" if codes == {"incomplete-group"} else "rejected"

    @property
    def ok(self) -> bool:
        return self.status == "ok"

    def codes(self) -> set[str]:
        return {c for c, *_ in self.violations}

    def document(self) -> dict:
        return {"dataset_id": self.dataset_id, "version": self.version, "status": self.status, "violations": [{"code": c, "path": p, "detail": d} for c, p, d in self.violations]}


#: Findings of one check that a report lists; the rest is counted.
LISTED = 10_000


def reported(found: DataFrame, detail: str | None = None) -> list[tuple]:
    """(code, path, detail) of found (code, path): the first LISTED, and how many each code has if there are more."""
    some = found.limit(LISTED + 1).collect()
    out = [(r["code"], r["path"], detail) for r in some[:LISTED]]
    if len(some) > LISTED:
        out += [("violations-truncated", None, f"{r['code']}: {r['count']} in all") for r in found.groupBy("code").count().orderBy("code").collect()]
    return out


def _safely(check, group: profiles.Group) -> list[tuple]:
    """A check that fails is a violation of its own; others go on."""
    try:
        return reported(check(group).select("code", "path"), group.name)
    except (PySparkException, ArithmeticError, KeyError, TypeError, ValueError, OSError) as e:
        return [("profile-check-error", None, f"{group.name}: {check.__name__}: {str(e)[:200]}")]
    finally:
        group.release()


# What a problem with a parent is called besides where the parent is the tokenizer.
OF_TOKENIZER = {"dangling-parent": "tokenizer-parent-missing", "parent-manifest-pin-missing": "tokenizer-manifest-pin-missing", "parent-manifest-pin-mismatch": "tokenizer-manifest-pin-mismatch", "parent-manifest-hash-mismatch": "tokenizer-manifest-hash-mismatch"}


def _parents(landing: Store, data: Store | None, document: dict, entries: DataFrame) -> tuple[list[tuple], dict]:
    """Problems with a group's parents, shared digests among them; and what its tokenizer says."""
    out, tokenizer = [], {}
    deps = document.get("depends_on") or []
    spark = landing.spark
    for dep in deps if data is not None else []:
        where = f"{dep.get('dataset_id')}/{dep.get('version')}"
        parent = data.load(f"{where}/dataset.json") if dep.get("dataset_id") and dep.get("version") and data.exists(f"{where}/dataset.json") else None
        hashes = {g.get("manifest_sha256"): g for g in (parent or {}).get("groups", [])}
        row = spark.createDataFrame([(document["name"], dep.get("dataset_id"), dep.get("version"), dep.get("manifest_sha256"))], "child string, parent_id string, parent_version string, pin string")
        known = spark.createDataFrame([(dep.get("dataset_id"), dep.get("version"), list(hashes))] if parent else [], "parent_id string, parent_version string, hashes array<string>")
        status = lineage.pin_status(row, known).first()["status"]
        if status != "ok":
            out.append((status, None, where))
            if names_tokenizer(dep):
                out.append((OF_TOKENIZER.get(status, status), None, where))
            continue
        own = hashes[dep["manifest_sha256"]]
        try:
            raw = data.get(f"{where}/{own['manifest']}")
        except Missing:
            out.append(("parent-manifest-missing", None, where))
            continue
        if sha256(raw) != dep["manifest_sha256"]:
            out.append(("parent-manifest-hash-mismatch", None, where))
            if names_tokenizer(dep):
                out.append((OF_TOKENIZER["parent-manifest-hash-mismatch"], None, where))
            continue
        theirs, _ = documents.read_manifest(spark, data.load(f"{where}/{own['manifest']}"), own["name"])
        out += reported(lineage.shared_digests(entries, theirs).select(F.lit("shared-sha-with-parent").alias("code"), "path"), where)
        if names_tokenizer(dep):
            try:
                tokenizer = profiles.derive_vocabulary(data.get(f"{where}/{own['name']}/tokenizer.json"))
            except Missing:
                out.append(("tokenizer-json-not-in-parent", None, where))
            except (KeyError, TypeError, ValueError):
                out.append(("tokenizer-parent-unreadable", None, where))
    if deps and data is None:
        out.append(("depends-on-no-data-store", None, document["name"]))
        out += [("tokenizer-no-data-bucket", None, document["name"])] if any(map(names_tokenizer, deps)) else []
    if document.get("profile") == "pretrain-tokens/v1" and (n := sum(map(names_tokenizer, deps))) != 1 and "vocab_size" not in document:
        out.append(("tokenizer-dependency-count", None, f"{document['name']}: {n}"))
    if "vocab_size" in document:
        tokenizer = {"vocab_size": document["vocab_size"], "eos_id": document.get("eos_id")} | tokenizer
    return out, tokenizer


def names_tokenizer(dep: dict) -> bool:
    parent = dep.get("dataset_id") or ""
    return dep.get("role") == "tokenizer" or parent.startswith("tokenizer/") or (parent.startswith("vendor/") and "tokenizer" in parent)


def _partitions(document: dict, entries: DataFrame) -> tuple[list[tuple], list[DataFrame]]:
    out, frames, name = [], [], document["name"]
    given = document.get("partitions", [])
    coverage = document.get("coverage", "partition")
    if coverage not in ("partition", "overlapping", "incomplete"):
        out.append(("bad-coverage", None, name))
    if not isinstance(given, list) or not all(isinstance(p, dict) for p in given):
        return [*out, ("bad-partitions", None, name)], frames
    for p in given:
        if p.get("by") not in ("path", "field", "range", "indices"):
            out.append(("bad-partition-form", None, str(p.get("name"))))
        n = p.get("rows")
        if n is None:
            out.append(("partition-no-rows", None, str(p.get("name"))))
        elif not isinstance(n, int) or isinstance(n, bool) or n < 0:
            out.append(("partition-bad-rows", None, str(p.get("name"))))
    own = [(p["name"], p["glob"]) for p in given if p.get("by") == "path" and p.get("name") and p.get("glob")]
    if own:
        spark = entries.sparkSession
        said = spark.createDataFrame([(p["name"], p.get("rows") if isinstance(p.get("rows"), int) else None) for p in given if p.get("name")], "name string, said long")
        found = splits.partition_rows(entries, own).join(said, "name").withColumn("path", F.col("name"))
        frames += [manifest.violation("partition-glob-empty", found, F.col("objects") == 0), manifest.violation("partition-rows-mismatch", found, (F.col("objects") > 0) & (F.col("rows") != F.col("said")))]
        frames.append(splits.leaks(entries, own).select(F.lit("train-heldout-leakage").alias("code"), F.concat_ws("/", "trainable", "held_out").alias("path")))
        if coverage == "partition":
            frames.append(splits.overlaps(entries, own).select(F.lit("coverage-not-disjoint").alias("code"), F.concat_ws("/", "left", "right").alias("path")))
            frames.append(manifest.violation("coverage-incomplete", splits.uncovered(entries, own), F.lit(True)))
    return out, frames


def validate(landing: Store, prefix: str, data: Store | None = None, families: dict[str, dict] | None = None) -> Result:
    """prefix: <family>/<name>/<version> in the landing store."""
    spark = landing.spark
    dataset_id, _, version = prefix.rpartition("/")
    result = Result(dataset_id, version)
    add = lambda code, path=None, detail=None: result.violations.append((code, path, detail))
    try:
        document = landing.load(f"{prefix}/dataset.json")
    except Missing:
        add("no-dataset-json")
        return result
    except ValueError:
        add("dataset-json-unparseable")
        return result
    for key in CORE:
        if key not in document:
            add("missing-core-field", None, key)
    if document.get("schema_version") != documents.DATASET_SCHEMA:
        add("schema-version")
    if problem(spark, document.get("dataset_id"), names.id_problem):
        add("bad-dataset-id")
    block = document.get("version") if isinstance(document.get("version"), dict) else {}
    row = spark.createDataFrame([(block.get("id"), block.get("relation"), block.get("of"))], "v string, r string, o string")
    if block.keys() - {"id", "relation", "of"} or row.select(names.version_problem(F.col("v"), F.col("r"), F.col("o"))).first()[0]:
        add("bad-version")
    if problem(spark, document.get("purpose"), names.purpose_problem):
        add("bad-purpose")
    if f"{document.get('dataset_id')}/{block.get('id')}" != prefix:
        add("prefix-mismatch")
    if document.get("mutability") not in ("frozen", "append-only", "mutable"):
        add("bad-mutability")
    if not document.get("groups"):
        add("no-groups")
        return result

    family = dataset_id.split("/")[0]
    defaults = (known_families() if families is None else families).get(family, {})
    listing = files.objects(spark, landing.uri(prefix)).cache()
    frames: list[DataFrame] = []
    every, unread, declared = None, False, set()
    for g in document["groups"]:
        where = f"{prefix}/{g.get('manifest') or g['name'] + '/manifest.json'}"
        declared |= {p.get("name") for p in g.get("partitions", []) if isinstance(p, dict) and p.get("by") == "path"}
        if not landing.exists(where):
            add("incomplete-group", None, g["name"])
            unread = True
            continue
        raw = landing.get(where)
        try:
            listed = landing.load(where)
        except ValueError:
            add("manifest-unparseable", where)
            unread = True
            continue
        if g.get("manifest_sha256") != sha256(raw):
            add("manifest-sha256-mismatch", where)
        entries, bad = documents.read_manifest(spark, listed, g["name"])
        entries = entries.cache()
        for b in bad:
            add("bad-manifest-entry", None, b)
        totals = spark.createDataFrame([(g["name"], listed.get("objects"), listed.get("bytes"))], "grp string, objects long, bytes long")
        own = listing.filter(paths.group_of(F.col("path")) == g["name"]).filter(~F.col("path").isin(f"{g['name']}/manifest.json"))
        missing = manifest.diff(entries, own)
        typed = entries.withColumn("profile", F.lit(g.get("profile")))
        frames += [
            manifest.totals_mismatch(entries, totals), missing.select(F.when(F.col("side") == "missing", "missing-object").otherwise("unlisted-object").alias("code"), "path"), manifest.size_mismatch(entries, own).select(F.lit("size-mismatch").alias("code"), "path"),
            manifest.count_arithmetic(entries).select(F.lit("count-arithmetic").alias("code"), "path"), manifest.extension_contradictions(entries).select(F.lit("extension-format-mismatch").alias("code"), "path"), manifest.naming(typed),
            manifest.duplicate_digests(entries).select(F.lit("duplicate-shard-digest").alias("code"), "path"), manifest.duplicate_paths(entries), manifest.split_contradictions(entries), manifest.label_contradictions(entries),
        ]
        problems, parts = _partitions(g, entries)
        result.violations += problems
        frames += parts
        problems, tokenizer = _parents(landing, data, g, entries)
        result.violations += problems
        if tokenizer.get("vocab_size"):
            frames.append(manifest.dtype_width(entries, tokenizer["vocab_size"]))
        if not g.get("profile"):
            add("no-profile", None, g["name"])
        elif g["profile"] not in profiles.PROFILES:
            add("unknown-profile", None, g["profile"])
        else:
            group = profiles.Group(spark, landing, dataset_id, version, g, entries, defaults, tokenizer)
            for check in profiles.PROFILES[g["profile"]]:
                result.violations += _safely(check, group)
        every = entries if every is None else every.unionByName(entries)
    if every is not None:
        if not unread:
            stored = listing.filter(~paths.is_control(F.col("path")))
            orphans = manifest.diff(every, stored).filter("side = 'extra'").filter(~paths.group_of(F.col("path")).isin([g["name"] for g in document["groups"]]))
            frames.append(orphans.select(F.lit("unlisted-object-dataset-level").alias("code"), "path"))
            inventory = document.get("inventory") or {}
            whole = spark.createDataFrame([(manifest.WHOLE, inventory.get("objects"), inventory.get("bytes"))], "grp string, objects long, bytes long")
            frames.append(manifest.totals_mismatch(every, whole).select(F.concat(F.lit("inventory-"), "code").alias("code"), "path"))
        shards = every.filter(F.col("container").isNotNull())
        frames.append(splits.split_differences(shards, sorted(x for x in declared if x)).select("code", F.col("split").alias("path")))
    if defaults.get("validation_required") and not any(d in paths.SPLITS and d not in paths.TRAINABLE for d in declared) and not document.get("validation_optional"):
        add("missing-required-split")
    result.violations += reported(manifest.union(frames)) if frames else []
    return result
