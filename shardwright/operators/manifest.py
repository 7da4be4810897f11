"""Operators over manifest entries and observed objects.

entries: path, grp, sha256, bytes, and optionally count_unit, count_value, container, dtype,
byte_order, header_bytes, codec, split, source, domain.  objects: path, length.
Checks return rows (code, path) of what is wrong, so that they union.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import paths

# Units of counts.
FIXED_WIDTH_UNITS = ("tokens", "indices")
SUMMABLE_UNITS = ("tokens", "indices", "rows", "items")
#: Totals over all groups carry this name.
WHOLE = "*"


def violation(code: str, df: DataFrame, where: Column) -> DataFrame:
    return df.filter(where).select(F.lit(code).alias("code"), "path")


def union(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def totals(entries: DataFrame) -> DataFrame:
    """objects, bytes and counted values of every group and of the whole, in one aggregation; no entries, no rows."""
    found = entries.groupingSets([["grp"], []], "grp").agg(F.count("*").alias("objects"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.sum("count_value").alias("count_value"), F.grouping("grp").alias("g"))
    return found.select(F.when(F.col("g") == 1, WHOLE).otherwise(F.col("grp")).alias("grp"), "objects", "bytes", "count_value")


def totals_mismatch(entries: DataFrame, declared: DataFrame) -> DataFrame:
    """declared: grp, objects, bytes.  code, path (the group)."""
    both = totals(entries).alias("t").join(declared.alias("d"), "grp", "right")
    wrong = lambda c: ~F.coalesce(F.col(f"t.{c}"), F.lit(0)).eqNullSafe(F.col(f"d.{c}"))
    both = both.withColumn("path", F.col("grp"))
    return union([violation(f"{c}-total", both, wrong(c)) for c in ("objects", "bytes")])


def diff(entries: DataFrame, objects: DataFrame) -> DataFrame:
    """Paths on one side only: side is missing (listed, not stored) or extra (stored, not listed)."""
    listed, stored = entries.select("path").distinct().withColumn("l", F.lit(1)), objects.select("path").distinct().withColumn("s", F.lit(1))
    both = listed.join(stored, "path", "full")
    return both.filter("l is null or s is null").select(F.when(F.col("s").isNull(), "missing").otherwise("extra").alias("side"), "path")


def size_mismatch(entries: DataFrame, objects: DataFrame) -> DataFrame:
    """path, declared and observed bytes, of stored objects of another size."""
    return entries.join(objects, "path").filter(F.col("bytes") != F.col("length")).select("path", F.col("bytes").alias("declared"), F.col("length").alias("observed"))


def duplicate_digests(entries: DataFrame) -> DataFrame:
    """Entries whose digest an entry before them in their group has.

    The first of each digest is found by a combined minimum, so a digest that repeats without end is never gathered.
    """
    first = entries.groupBy("grp", "sha256").agg(F.min("path").alias("first"), F.count("*").alias("n")).filter("n > 1")
    return entries.join(first, ["grp", "sha256"]).filter(F.col("path") != F.col("first")).select("grp", "path", "first")


def duplicate_paths(entries: DataFrame) -> DataFrame:
    return entries.groupBy("path").agg(F.count("*").alias("n")).filter("n > 1").select(F.lit("duplicate-path").alias("code"), "path")


def count_arithmetic(entries: DataFrame) -> DataFrame:
    """path, expected and declared bytes, where a fixed-width count doesn't make up the size."""
    checkable = F.col("count_unit").isin(*FIXED_WIDTH_UNITS) & paths.width(F.col("dtype")).isNotNull() & (F.col("codec") == "none") & (F.col("container") == "raw")
    expected = F.col("count_value") * paths.width(F.col("dtype")) + F.coalesce("header_bytes", F.lit(0))
    return entries.filter(checkable).withColumn("expected", expected.cast("long")).filter("expected <> bytes").select("path", "expected", F.col("bytes").alias("declared"))


def extension_contradictions(entries: DataFrame) -> DataFrame:
    """path and field, for every field that contradicts the extension's claim."""
    fields = ("container", "dtype", "byte_order", "codec", "header_bytes")
    claims = [(e, *(c.get(f) for f in fields), c.get("min_header_bytes")) for e, c in paths.CLAIMS.items()]
    claims = entries.sparkSession.createDataFrame(claims, "ext string, c_container string, c_dtype string, c_byte_order string, c_codec string, c_header_bytes int, least int")
    both = entries.select("path", *fields, paths.extension(F.col("path")).alias("ext")).join(F.broadcast(claims), "ext")  # one row an extension
    differs = lambda f: F.when(F.col(f"c_{f}").isNotNull() & ~F.col(f).eqNullSafe(F.col(f"c_{f}")), F.lit(f))
    short = F.when(F.coalesce(F.col("header_bytes") < F.col("least"), F.lit(False)), F.lit("min_header_bytes"))
    found = F.array_compact(F.array(*map(differs, fields), short))
    return both.select("path", F.explode(found).alias("field"))


def naming(entries: DataFrame) -> DataFrame:
    """Names that are neither shard names nor content addresses; vendored trees and tokenizers are exempt."""
    own = entries if "profile" not in entries.columns else entries.filter(~F.coalesce(F.col("profile").rlike("^(vendor|vendored|tokenizer)/"), F.lit(False)))
    return violation("shard-naming", own, ~paths.is_cas(F.col("path")) & paths.shard_split(F.col("path")).isNull())


def split_contradictions(entries: DataFrame) -> DataFrame:
    """Declared splits that the file name contradicts."""
    named = paths.shard_split(F.col("path"))
    return violation("split-contradicts-filename", entries, F.col("split").isNotNull() & named.isin(*paths.SPLITS) & (named != F.col("split")))


def label_contradictions(entries: DataFrame) -> DataFrame:
    """Labels other than the path's; paths too deep to name.  entries has source and domain."""
    found = paths.label_segments(F.col("path"))
    deep = violation("labels-unnameable-path", entries, F.size(found) > len(paths.LABEL_KEYS))
    wrong = reduce(lambda a, b: a | b, [~F.col(k).eqNullSafe(F.get(found, i)) for i, k in enumerate(paths.LABEL_KEYS)])
    return union([deep, violation("labels-contradict-path", entries, (F.size(found) <= len(paths.LABEL_KEYS)) & wrong)])


def dtype_width(entries: DataFrame, vocab: int) -> DataFrame:
    """Token entries whose type is unknown, out of place or too narrow for the vocabulary, the first that holds."""
    dtype = F.col("dtype")
    raw = F.col("container") == "raw"
    known = paths.width(dtype)
    code = (
        F.when(raw & known.isNull() & dtype.isNotNull(), "dtype-not-checkable").when(~raw & known.isNotNull(), "fixed-width-dtype-in-nonraw-container")
        .when(raw & (known < paths.least_width(F.lit(vocab))), "dtype-too-narrow-for-vocab")
    )
    return entries.filter(F.col("count_unit") == "tokens").select(code.alias("code"), "path").filter("code is not null")


def sequence_alignment(entries: DataFrame, seq_len: int) -> DataFrame:
    per = paths.width(F.col("dtype")) * seq_len
    return violation("seq-len-misalignment", entries.filter(per.isNotNull()), F.col("bytes") % per != 0)


def format_agreement(entries: DataFrame) -> DataFrame:
    """Per group: how many formats its typed entries have, the format if it is one, and the counted total if all units agree."""
    typed = F.when(F.col("dtype").isNotNull(), F.concat_ws("/", "dtype", F.coalesce("byte_order", F.lit("-")), F.coalesce("header_bytes", F.lit(0)).cast("string")))
    units = F.count_distinct(F.when(F.col("count_unit").isin(*SUMMABLE_UNITS), F.col("count_unit")))
    found = entries.groupBy("grp").agg(F.count_distinct(typed).alias("formats"), F.min(typed).alias("one"), units.alias("units"), F.sum(F.when(F.col("count_unit").isin(*SUMMABLE_UNITS), F.col("count_value"))).alias("all"))
    return found.select("grp", "formats", F.when(F.col("formats") == 1, F.col("one")).alias("format"), F.when(F.col("units") == 1, F.col("all")).alias("total"))


def latest_versions(catalog: DataFrame) -> DataFrame:
    """catalog: dataset_id, version.  The greatest version by number."""
    from ..functions.names import version_number

    n = version_number(F.col("version"))
    return catalog.groupBy("dataset_id").agg(F.max(n).alias("n")).select("dataset_id", F.concat(F.lit("v"), F.coalesce("n", F.lit(1)).cast("string")).alias("latest"))


def pending(objects: DataFrame) -> DataFrame:
    """Prefixes <dataset>/<version> that have a dataset.json and the manifests it needs, but no verdict.  objects: prefix, name, grp (null for control documents), needs (groups)."""
    flags = objects.groupBy("prefix").agg(
        F.max(F.when(F.col("name") == "dataset.json", F.col("needs"))).alias("needs"),
        F.count_distinct(F.when(F.col("name") == "manifest.json", F.col("grp"))).alias("manifests"),
        F.max(F.col("name").isin("_VALIDATED.json", "_SUCCESS", "_REJECTED.json").cast("int")).alias("judged"),
    )
    return flags.filter("needs is not null and manifests >= needs and judged = 0").select("prefix", "needs")


def first_rows(df: DataFrame, by: str, order: str, cap: int, code: str) -> DataFrame:
    """At most cap rows a path, and a row of the code for each path that has more.  Ranked in a window that Spark cuts off early."""
    rank = F.row_number().over(W.partitionBy(by).orderBy(order))
    kept = df.withColumn("_r", rank).filter(F.col("_r") <= cap).drop("_r")
    more = df.groupBy(by).agg(F.count("*").alias("n")).filter(F.col("n") > cap)
    note = more.select(*[F.col(by) if c == by else F.lit(code).alias(c) if c == "code" else F.lit(None).cast(t).alias(c) for c, t in df.dtypes])
    return kept.unionByName(note)
