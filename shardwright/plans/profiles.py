"""Checks on payloads, by profile.  A check takes a Group and returns rows (code, path)."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys, paths
from ..operators import manifest, rows, tokens
from ..sources import files
from ..sources.store import Store

CODES = "code string, path string"


@dataclass
class Group:
    """A payload group under check: its document, its entries (with payload paths below root) and what its family says."""

    spark: SparkSession
    store: Store
    dataset_id: str
    version: str
    document: dict
    entries: DataFrame
    defaults: dict = field(default_factory=dict)
    tokenizer: dict = field(default_factory=dict)
    held: list[DataFrame] = field(default_factory=list)

    @property
    def name(self) -> str:
        return self.document["name"]

    @property
    def root(self) -> str:
        return self.store.uri(f"{self.dataset_id}/{self.version}/{self.name}")

    def config(self, key: str, default=None):
        """The group's value, else its family's, else the default."""
        return self.document.get(key, self.defaults.get(key, default))

    def payload(self, df: DataFrame) -> DataFrame:
        """df, whose paths are below the group, with paths below the dataset; the manifest is no payload."""
        return df.filter("path <> 'manifest.json'").withColumn("path", F.concat(F.lit(f"{self.name}/"), "path"))

    def hold(self, df: DataFrame) -> DataFrame:
        """df, computed once for all its readers, until release()."""
        self.held.append(df.cache())
        df.count()  # readers that begin together would each compute what isn't there yet
        return df

    def release(self) -> None:
        while self.held:
            self.held.pop().unpersist()

    def none(self) -> DataFrame:
        return self.spark.createDataFrame([], CODES)

    def one(self, code: str, path: str | None = None) -> DataFrame:
        return self.spark.createDataFrame([(code, path)], CODES)


def bound(group: Group, key: str, default: float, tighter: Callable = min) -> tuple[float, bool]:
    """A bound that the group may only tighten: (value, whether every given value is a number above 0)."""
    own, family = group.document.get(key), group.defaults.get(key, default)
    good = lambda v: isinstance(v, int | float) and not isinstance(v, bool) and v > 0
    base = family if good(family) else default
    return (tighter(own, base) if good(own) else base), good(family) and (own is None or good(own))


def unit_is(unit: str, code: str):
    return lambda g: manifest.violation(code, g.entries, ~F.coalesce(F.col("count_unit") == unit, F.lit(False)))


def row_count_value(g: Group) -> DataFrame:
    return manifest.violation("row-count-value", g.entries, (F.col("count_unit") == "rows") & ~F.coalesce(F.col("count_value") >= 0, F.lit(False)))


def decoded_tokens(g: Group) -> DataFrame:
    """Four seeded windows of every shard: enough to tell a broken one, at a cost that doesn't grow with it."""
    dtype, order = g.config("dtype", "uint32"), g.config("byte_order", "little")
    vocab, eos = g.tokenizer.get("vocab_size"), g.tokenizer.get("eos_id")
    settings = {k: bound(g, k, d, t) for k, d, t in (("distinct_ids_min", 256, max), ("eos_fraction_max", 0.05, min), ("zero_run_max", 256, min), ("window_bytes", 65_536, max))}
    out = [g.one("invalid-decode-bound", k) for k, (_, good) in settings.items() if not good]
    if vocab is None:
        return manifest.union([*out, g.one("missing-tokenizer-field")])
    ids = g.payload(files.sampled_ids(g.spark, g.root, keys.group_seed(F.lit(g.dataset_id), F.lit(g.version), F.lit(g.name)), window=int(settings["window_bytes"][0]) // 4, dtype=dtype, order=order))
    ids = ids.join(g.entries.select("path"), "path", "left_semi")
    found = g.entries.select("path").join(tokens.id_statistics(ids, int(vocab), -1 if eos is None else int(eos), int(settings["distinct_ids_min"][0])), "path", "left")
    runs = tokens.longest_run(ids).filter(F.col("longest") >= int(settings["zero_run_max"][0]))
    n = F.col("ids")
    return manifest.union([
        *out, manifest.violation("empty-shard", found, n.isNull()), manifest.violation("vocab-out-of-range", found, F.col("out_of_range") > 0), manifest.violation("distinct-too-few", found, F.col("distinct_ids") < F.col("distinct_floor")),
        manifest.violation("eos-fraction-out-of-bounds", found, F.col("eos") / n > settings["eos_fraction_max"][0]), manifest.violation("zero-run-in-shard", runs, F.lit(True)),
    ])


def npy_magic(g: Group) -> DataFrame:
    return manifest.violation("npy-magic-bytes", g.payload(files.npy_files(g.spark, g.root)), F.lit(True))


def alignment(g: Group) -> DataFrame:
    seq_len = g.config("seq_len")
    return manifest.sequence_alignment(g.entries, int(seq_len)) if seq_len else g.none()


def text_rows(g: Group) -> DataFrame:
    name, least = g.config("text_field", "text"), g.config("min_text_chars", 1)
    limit = g.config("max_identical_fraction", 0.5)
    number = lambda v: isinstance(v, int | float) and not isinstance(v, bool)
    wrong = [c for c, bad in (("invalid-text-field", not isinstance(name, str) or not name), ("invalid-min-text-chars", not isinstance(least, int) or isinstance(least, bool) or least < 1), ("invalid-max-identical-fraction", not number(limit) or not 0 < limit <= 1)) if bad]
    schema = g.document.get("record_schema")
    wrong += ["missing-record-schema"] if not schema else ["record-schema-missing-text"] if name not in json.dumps(schema) else []
    out = [g.one(c) for c in wrong]
    if any(c.startswith("invalid") for c in wrong):
        return manifest.union(out)
    found = g.payload(files.json_rows(g.spark, g.root, name, columns=("path", "text", "has_text", "is_text", "error")))
    # Lines are read and parsed once; every finding comes from these few bytes a row.
    code = F.when(F.col("has_text") & ~F.col("is_text"), "text-field-type").otherwise(rows.text_code(int(least)))
    found = g.hold(found.select("path", F.monotonically_increasing_id().alias("row_idx"), F.col("error").isNotNull().alias("failed"), F.when(F.col("error").isNull(), code).alias("code"), F.unhex(keys.text_fingerprint(F.col("text"))).alias("k")))
    read = found.filter("not failed")
    typed = F.coalesce(F.col("code") == "text-field-type", F.lit(False))
    types = rows.coded_problems(read.filter(typed))
    top = rows.keyed_fraction(read, float(limit))
    counts = rows.row_counts(read, g.entries)
    out += [
        manifest.violation("row-read-failed", found.filter("failed").select("path").distinct(), F.lit(True)), rows.coded_problems(read.filter(~typed)).select("code", "path"), types.select("code", "path"),
        manifest.violation("text-all-identical", top, F.lit(True)), counts.select("code", "path"), read.agg(F.count("*").alias("n")).filter("n = 0").select(F.lit("empty-group").alias("code"), F.lit(None).cast("string").alias("path")),
    ]
    return manifest.union(out)


def _messages(g: Group) -> DataFrame:
    """path, key, problem of each conversation row."""
    chosen = g.config("dedup_key")

    def judge(batches):
        import hashlib

        for batch in batches:
            out = []
            for path, raw, error in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                row = json.loads(raw) if raw else {}
                found, problem = row.get("messages"), None
                if error:
                    problem = "unreadable"
                elif not isinstance(found, list) or not found:
                    problem = "not-a-list"
                elif any(not isinstance(m, dict) or not isinstance(m.get("role"), str) or not m["role"] or "content" not in m for m in found):
                    problem = "message"
                if chosen:
                    key = "\x1e".join(str(row.get(k)) for k in chosen)
                elif isinstance(found, list):
                    key = "\x1e".join(f"{m.get('role', '')}\x1f{m.get('content', '')}" if isinstance(m, dict) else str(m) for m in found)
                else:
                    key = raw or ""
                out.append({"path": path, "key": hashlib.sha256(key.encode("utf-8", "replace")).hexdigest(), "problem": problem})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([(c, pa.string()) for c in ("path", "key", "problem")]))

    found = g.payload(files.json_rows(g.spark, g.root, only_newlines=False, strict=False))
    return found.select("path", "row", "error").mapInArrow(judge, "path string, key string, problem string")


def conversations(g: Group) -> DataFrame:
    found = _messages(g)
    bad = manifest.violation("row-read-failed", found, F.col("problem") == "unreadable").unionByName(manifest.violation("malformed-messages", found, F.col("problem").isin("not-a-list", "message"))).distinct()
    sides = [(p["name"], p["glob"]) for p in g.document.get("partitions", []) if p.get("by", "path") == "path" and p.get("glob")]
    train = [x for n, x in sides if n in paths.TRAINABLE] + list(g.config("train_globs", []))
    held = [x for n, x in sides if n not in paths.TRAINABLE] + list(g.config("held_out_globs", []))
    if not train or not held:
        return bad.unionByName(g.one("missing-partitions"))
    any_of = lambda globs: F.greatest(F.lit(False), *[paths.matches_glob(F.col("path"), x) for x in globs])
    sided = found.select("key", F.when(any_of(train), "train").when(any_of(held), "held").alias("side")).filter("side is not null")
    shared = rows.leakage(sided, int(g.config("max_leakage", 0)))
    return bad.unionByName(shared.limit(1).select(F.lit("train-heldout-leakage").alias("code"), F.lit(None).cast("string").alias("path")))


def evaluations(g: Group) -> DataFrame:
    ok = g.config("ok_value", "ok")
    counts = g.document.get("status_counts")
    metric = g.config("metric_field")
    found = g.payload(files.eval_rows(g.spark, g.root, g.config("status_field", "status"), metric or "score").withColumnRenamed("shard", "path")).withColumn("shard", F.lit("*"))
    out = [g.one("missing-status-counts")] if not isinstance(counts, dict) else []
    if not out:
        known = [counts.get(k, 0) for k in (ok, g.config("error_value", "error"), g.config("filtered_value", "filtered"))]
        said = g.spark.createDataFrame([("*", *known)], "shard string, ok long, error long, filtered long")
        out.append(rows.eval_accounting(found, said).select(F.lit("row-count-mismatch").alias("code"), F.lit(None).cast("string").alias("path")))
    out.append(rows.no_success(found, ok).select(F.lit("all-error-no-success").alias("code"), F.lit(None).cast("string").alias("path")))
    if metric:
        out.append(rows.constant_metric(found).select(F.lit("metric-all-identical").alias("code"), F.lit(None).cast("string").alias("path")))
    return manifest.union(out)


def orders(g: Group) -> DataFrame:
    cap = int(g.config("max_order_bytes", 512 << 20))
    blocks = next((v for v in (g.document.get("block_count"), *(d.get("block_count") for d in g.document.get("depends_on", []))) if isinstance(v, int) and not isinstance(v, bool) and v >= 0), 0)
    sizes = g.payload(files.objects(g.spark, g.root)).join(g.entries.select("path", F.when(F.col("count_unit") == "indices", F.col("count_value")).alias("declared")), "path")
    out = [tokens.order_length(sizes), manifest.violation("order-too-large", sizes, F.col("length") > cap)]
    ids = g.payload(files.token_ids(g.spark, g.root, most_bytes=cap))
    whole = sizes.filter((F.col("length") <= cap) & (F.col("length") % 4 == 0)).select("path")
    found = tokens.order_domains(ids, blocks, g.config("ordering", "permutation"))
    verdict = whole.join(found, "path", "left").select("path", F.coalesce("verdict", F.lit("order-empty")).alias("code"))
    out.append(verdict.filter("code <> 'ok'").select("code", "path"))
    return manifest.union(out)


def derive_vocabulary(raw: bytes) -> dict:
    """vocab_size and eos_id of a tokenizer.json."""
    document = json.loads(raw)
    vocab = document["model"]["vocab"]
    added = document.get("added_tokens") or []
    ends = [a["id"] for a in added if a.get("content") in ("</s>", "<eos>", "<|endoftext|>", "<|end_of_text|>", "<|im_end|>") or "endoftext" in a.get("content", "")]
    size = max([len(vocab) - 1, *(a["id"] for a in added)]) + 1
    if size <= 0:
        raise ValueError("the tokenizer has no ids")
    return {"vocab_size": size, "eos_id": ends[-1] if ends else None}


def tokenizer_document(g: Group) -> DataFrame:
    name = f"{g.dataset_id}/{g.version}/{g.name}/tokenizer.json"
    if not g.store.exists(name):
        return g.one("tokenizer-json-missing")
    raw = g.store.get(name)
    try:
        json.loads(raw)
    except ValueError:
        return g.one("tokenizer-json-invalid")
    try:
        derive_vocabulary(raw)
    except (KeyError, TypeError, ValueError):
        return g.one("tokenizer-vocab-underivable")
    return g.none()


PROFILES: dict[str, list[Callable[[Group], DataFrame]]] = {
    "pretrain-tokens/v1": [unit_is("tokens", "token-count-unit"), decoded_tokens, npy_magic, alignment],
    "text-corpus/v1": [unit_is("rows", "row-count-unit"), row_count_value, text_rows],
    "sft-conversations/v1": [conversations],
    "eval-results/v1": [evaluations],
    "token-order/v1": [orders],
    "tokenizer/v1": [tokenizer_document],
}


def register(name: str, checks: list[Callable[[Group], DataFrame]]) -> None:
    PROFILES[name] = checks
