"""Reading: which files of a sealed version may be used, at what width."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keys, paths
from ..operators import mixture, splits
from ..operators.manifest import format_agreement
from ..sources.store import Missing, Store, sha256
from . import documents


class ReadError(RuntimeError):
    """The dataset can't be read as asked."""


class NotValidated(ReadError):
    """The version has no seal."""


class SealMismatch(ReadError):
    """The version isn't what was sealed."""


class MixedFormat(ReadError):
    """A group's files have several formats."""


@dataclass
class Resolved:
    paths: list[str]
    entries: DataFrame
    format: str | None
    rows: int | None
    splits: dict[str, list[str]] = field(default_factory=dict)
    split_rows: dict[str, int | None] = field(default_factory=dict)
    row_predicate: dict | None = None

    @property
    def train(self):
        return self.splits.get("train")

    @property
    def val(self):
        return self.splits.get("val")

    def has_split(self, name: str) -> bool:
        return name in self.splits

    @property
    def numpy_dtype(self) -> str | None:
        if not self.format:
            return None
        dtype, order, _ = self.format.split("/")
        return {"little": "<", "big": ">"}.get(order, "") + {"uint": "u", "int": "i", "float": "f"}[dtype.rstrip("0123456789")] + str(paths.WIDTHS[dtype]) if order != "-" else dtype


@dataclass
class Mixture:
    paths: list[str]
    total: int
    counts: dict[str, int]
    actual_ratios: dict[str, float]
    shortfall: dict[str, int]


def verify_seal(data: Store, at: str, rooted: bool = True) -> list[str]:
    """What differs from the seal.  A seal from before there were root digests is accepted with rooted off."""
    try:
        seal = data.load(f"{at}/_VALIDATED.json")
    except Missing:
        return ["no seal"]
    out = []
    if "dataset_sha256" not in seal:
        out += ["the seal has no root digest"] if rooted else []
    elif sha256(data.get(f"{at}/dataset.json")) != seal["dataset_sha256"]:
        out.append("dataset.json changed")
    for g in data.load(f"{at}/dataset.json")["groups"]:
        where = f"{at}/{g['manifest']}"
        found = sha256(data.get(where)) if data.exists(where) else None
        if found != g["manifest_sha256"] or found != seal.get("manifest_sha256", {}).get(g["name"], found):
            out.append(f"the manifest of {g['name']} changed or is gone")
    return out


def latest(data: Store, dataset_id: str) -> str | None:
    found = [n.rpartition("/")[2].removesuffix(".json") for n in data.names(f"_catalog/{dataset_id}")]
    numbers = [int(v[1:]) for v in found if v[:1] == "v" and v[1:].isdigit()]
    return f"v{max(numbers)}" if numbers else None


def _open(data: Store, dataset_id: str, version: str, group: str | None, require_validated: bool) -> tuple[dict, DataFrame, str]:
    at = f"{dataset_id}/{version}"
    if require_validated:
        sealed = data.exists(f"{at}/_VALIDATED.json")
        if not sealed and not data.exists(f"{at}/_SUCCESS"):  # the older mark, which seals nothing
            raise NotValidated(at)
        if problems := verify_seal(data, at) if sealed else []:
            raise SealMismatch("; ".join(problems))
    document = data.load(f"{at}/dataset.json")
    groups = {g["name"]: g for g in document["groups"]}
    if group is None and len(groups) > 1:
        raise ReadError(f"name one of the groups {sorted(groups)}")
    chosen = groups.get(group) if group else next(iter(groups.values()))
    if chosen is None:
        raise ReadError(f"there is no group {group}")
    entries, bad = documents.read_manifest(data.spark, data.load(f"{at}/{chosen['manifest']}"), chosen["name"])
    if bad:
        raise ReadError(bad[0])
    return chosen, entries.cache(), at


def resolve(data: Store, dataset_id: str, version: str | None = None, split: str | None = None, group: str | None = None, labels: dict[str, str] | None = None, include_held_out: bool = False, require_validated: bool = True) -> Resolved:
    """The files to use.  Without a split: the trainable ones, and never one whose own name says it is held out."""
    version = version or latest(data, dataset_id)
    if version is None:
        raise ReadError(f"{dataset_id} has no version")
    chosen, entries, at = _open(data, dataset_id, version, group, require_validated)
    if split is not None and split not in paths.SPLITS:
        raise ReadError(f"unknown split {split!r}")
    form = format_agreement(entries).first()
    if form and form["formats"] > 1:
        raise MixedFormat(at)
    if labels and entries.filter("source is not null or domain is not null").isEmpty():
        raise ReadError("the group has no labels")
    parts = [p for p in chosen.get("partitions", []) if p.get("name")]
    globs = {p["name"]: p.get("glob") for p in parts if p.get("by") == "path"}

    def pick(df, wanted):
        for key, value in (labels or {}).items():
            df = df.filter(F.coalesce(F.col(key) == value, F.lit(False)) if key in paths.LABEL_KEYS else F.lit(False))
        return df if wanted is None else df.filter(wanted)

    named = paths.shard_split(F.col("path"))
    hardened = named.isNull() | ~named.isin(*paths.SPLITS) | paths.is_trainable(named)
    condition = lambda p: paths.matches_glob(F.col("path"), globs[p["name"]]) if globs.get(p["name"]) else F.lit(True)
    safe = lambda p: condition(p) & (hardened if p["name"] in paths.TRAINABLE else F.lit(True))
    names = lambda df: [f"{data.uri(at)}/{r['path']}" for r in df.orderBy("path").select("path").collect()]
    total = lambda df: (df.agg(F.sum("count_value")).first()[0])
    by_split = {p["name"]: names(pick(entries, safe(p))) for p in parts}
    split_rows = {p["name"]: total(pick(entries, safe(p))) if labels else p.get("rows") for p in parts}
    predicate = None
    if split is not None:
        own = [p for p in parts if p["name"] == split]
        found = pick(entries, safe(own[0])) if own else entries.limit(0)
        predicate = {k: v for k, v in own[0].items() if k not in ("name", "rows")} if own and own[0].get("by") != "path" else None
    elif include_held_out:
        found = pick(entries, None)
    else:
        trainable = [p for p in parts if p["name"] in paths.TRAINABLE]
        any_of = F.greatest(F.lit(False), *[condition(p) for p in trainable]) if trainable else F.lit(True)
        found = pick(entries, any_of & hardened)
    return Resolved(names(found), found, form["format"] if form else None, total(found) if labels or split is None else split_rows.get(split), by_split, split_rows, predicate)


def build_mixture(data: Store, dataset_id: str, version: str, sources: list[dict], total: int, seed: int, group: str | None = None, split: str | None = "train", require_validated: bool = True) -> Mixture:
    """sources: dicts of labels, ratio and optionally fraction and repetition."""
    try:
        mixture.check_request(sources, total)
    except ValueError as e:
        raise ReadError(str(e)) from e
    _, entries, at = _open(data, dataset_id, version, group, require_validated)
    pool = splits.resolve(entries, split) if split else splits.resolve(entries)
    name = lambda s: ",".join(f"{k}={v}" for k, v in sorted(s["labels"].items()))
    tagged = None
    for s in sources:
        own = pool
        for key, value in s["labels"].items():
            own = own.filter(F.coalesce(F.col(key) == value, F.lit(False)))
        own = own.select(F.lit(name(s)).alias("source"), "path", F.col("count_value").alias("n"), "count_unit")
        tagged = own if tagged is None else tagged.unionByName(own)
    tagged = tagged.cache()
    seen = {r["source"]: r for r in tagged.groupBy("source").agg(F.count_distinct("count_unit").alias("units"), F.min("count_unit").alias("unit"), F.count_if(F.col("n").isNull()).alias("uncounted")).collect()}
    for s in sources:
        if name(s) not in seen:
            raise ReadError(f"{name(s)} matches no file")
    if any(r["units"] != 1 or r["uncounted"] for r in seen.values()) or len({r["unit"] for r in seen.values()}) != 1:
        raise ReadError("counts are missing or of several units")
    keyed = tagged.withColumn("key", keys.shuffle_key(F.lit(seed), F.lit(dataset_id), F.lit(version), F.col("path")))
    wanted = data.spark.createDataFrame([(name(s), float(s["ratio"]), float(s.get("fraction", 1.0)), float(s.get("repetition", 1.0))) for s in sources], "source string, ratio double, fraction double, repetition double")
    goals = mixture.targets(keyed, wanted, total)
    picked = mixture.fill_capped(keyed, goals).join(keyed.select("source", "path", "key"), ["source", "path"]).orderBy("source", "pass", "key").collect()
    rows = {r["source"]: r for r in mixture.summary(data.spark.createDataFrame([(r["source"], r["n"]) for r in picked], "source string, n long"), goals).collect()}
    order = {name(s): i for i, s in enumerate(sources)}
    chosen = sorted(picked, key=lambda r: (order[r["source"]], r["pass"], r["key"]))
    return Mixture([f"{data.uri(at)}/{r['path']}" for r in chosen], sum(r["got"] for r in rows.values()), {k: r["got"] for k, r in rows.items()}, {k: r["actual_ratio"] for k, r in rows.items()}, {k: r["shortfall"] for k, r in rows.items() if r["shortfall"]})
