"""Gate B: the published catalog held against what is stored now, by listings only unless digests are asked for."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import functions as F

from ..operators import lineage
from ..sources import files
from ..sources.store import Store
from . import documents


@dataclass
class Report:
    findings: list[tuple[str, str, str, str | None]] = field(default_factory=list)  # code, severity, dataset, detail

    @property
    def ok(self) -> bool:
        return not any(s == "error" for _, s, *_ in self.findings)

    def codes(self) -> set[str]:
        return {c for c, *_ in self.findings}

    def document(self) -> dict:
        return {"ok": self.ok, "findings": [dict(zip(("code", "severity", "dataset", "detail"), f, strict=True)) for f in self.findings]}


def catalog(data: Store) -> list[tuple[str, str]]:
    """(dataset id, version); an id may have slashes."""
    found = [n[len("_catalog/") : -len(".json")].rpartition("/") for n in data.names("_catalog") if n.endswith(".json")]
    return [(a, b) for a, _, b in found]


def sweep(data: Store, contents: bool = False, image_alive=None) -> Report:
    """image_alive: a function from a build's image to True, False or None (unknown), if images are to be checked."""
    report, spark = Report(), data.spark
    for dataset_id, version in catalog(data):
        at = f"{dataset_id}/{version}"
        add = lambda code, detail=None, severity="error", at=at: report.findings.append((code, severity, at, detail))
        if not data.exists(f"{at}/dataset.json"):
            add("dataset-json-gone")
            continue
        document = data.load(f"{at}/dataset.json")
        stored = files.objects(spark, data.uri(at))
        for g in document["groups"]:
            if not data.exists(f"{at}/{g['manifest']}"):
                add("manifest-gone", g["name"])
                continue
            entries, _ = documents.read_manifest(spark, data.load(f"{at}/{g['manifest']}"), g["name"])
            for r in lineage.presence(entries, stored).collect():
                add(r["code"], r["path"])
            for dep in g.get("depends_on") or []:
                parent = f"{dep.get('dataset_id')}/{dep.get('version')}"
                if not data.exists(f"{parent}/dataset.json"):
                    add("dangling-parent", parent)
                elif dep.get("manifest_sha256") not in [x.get("manifest_sha256") for x in data.load(f"{parent}/dataset.json")["groups"]]:
                    add("parent-changed", parent)
        if contents and data.exists(f"{at}/_VALIDATED.json"):
            sealed = spark.createDataFrame(list(data.load(f"{at}/_VALIDATED.json").get("digests", {}).items()), "path string, crc string")
            for r in lineage.checksum_differences(sealed, files.digests(spark, data.uri(at)).select("path", F.col("sha256").alias("crc"))).collect():
                add("object-content-changed", r["path"])
        image = (document.get("build") or {}).get("image")
        if image_alive and image:
            alive = image_alive(image)
            if alive is None:
                add("image-repo-unknown", image, "warn")
            elif not alive:
                add("image-digest-gone", image)
    return report
