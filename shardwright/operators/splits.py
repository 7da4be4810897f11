"""Operators over partitions (splits declared by glob) and entries.

partitions: name, glob, rows (declared).  They are few by nature, so they are read on the driver and
each becomes one pattern; entries are scanned once, whatever their number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import paths


def assigned(entries: DataFrame, partitions: list[tuple[str, str]]) -> DataFrame:
    """entries with names: an array of the partitions whose glob matches."""
    own = F.array_compact(F.array(*[F.when(paths.matches_glob(F.col("path"), g), F.lit(n)) for n, g in partitions])) if partitions else F.array().cast("array<string>")
    return entries.withColumn("names", own)


def partition_rows(entries: DataFrame, partitions: list[tuple[str, str]], declared: DataFrame | None = None) -> DataFrame:
    """name, objects, rows (null where nothing matches)."""
    spark = entries.sparkSession
    named = spark.createDataFrame([(n,) for n, _ in partitions], "name string")
    found = assigned(entries, partitions).select(F.explode("names").alias("name"), "count_value").groupBy("name").agg(F.count("*").alias("objects"), F.sum("count_value").alias("rows"))
    return named.join(found, "name", "left").select("name", F.coalesce("objects", F.lit(0)).alias("objects"), "rows")


def overlaps(entries: DataFrame, partitions: list[tuple[str, str]]) -> DataFrame:
    """left, right, objects: pairs of partitions that share entries."""
    names = F.sort_array("names")
    pairs = F.flatten(F.transform(names, lambda a: F.transform(F.filter(names, lambda b: b > a), lambda b: F.struct(a.alias("left"), b.alias("right")))))
    found = assigned(entries, partitions).filter(F.size("names") > 1).select(F.explode(pairs).alias("p"))
    return found.groupBy("p.left", "p.right").agg(F.count("*").alias("objects"))


def uncovered(entries: DataFrame, partitions: list[tuple[str, str]]) -> DataFrame:
    return assigned(entries, partitions).filter(F.size("names") == 0).select("path")


def leaks(entries: DataFrame, partitions: list[tuple[str, str]]) -> DataFrame:
    """trainable, held_out, objects: shared entries of a trainable and a held-out partition of the vocabulary."""
    train, held = ([n for n in paths.SPLITS if (n in paths.TRAINABLE) == k] for k in (True, False))
    own = overlaps(entries, partitions)
    either = lambda a, b: own.filter(F.col(a).isin(train) & F.col(b).isin(held)).select(F.col(a).alias("trainable"), F.col(b).alias("held_out"), "objects")
    return either("left", "right").unionByName(either("right", "left"))


def split_differences(entries: DataFrame, declared: list[str]) -> DataFrame:
    """code, split: vocabulary words that file names have and no partition declares, and the reverse."""
    seen = entries.select(paths.shard_split(F.col("path")).alias("split")).filter(F.col("split").isin(*paths.SPLITS)).distinct()
    said = entries.sparkSession.createDataFrame([(d,) for d in declared if d in paths.SPLITS], "split string")
    return seen.join(said, "split", "left_anti").select(F.lit("undeclared-split").alias("code"), "split").unionByName(said.join(seen, "split", "left_anti").select(F.lit("empty-split").alias("code"), "split"))


def resolve(entries: DataFrame, split: str | None = None, declared: list[str] = list(paths.SPLITS), labels: dict[str, str] | None = None, include_held_out: bool = False) -> DataFrame:
    """The entries that a reader may use.

    Without a split: those of trainable partitions, or all if none is declared, less files whose own
    name says they are held out.  With one: its entries, none if the dataset lacks it.
    """
    if split is not None and split not in paths.SPLITS:
        raise ValueError(f"unknown split {split!r}")
    named = paths.shard_split(F.col("path"))
    out = entries
    if split is not None:
        out = out.filter((F.coalesce("split", named) == split) & F.lit(split in declared))
    elif not include_held_out:
        if any(d in paths.TRAINABLE for d in declared):
            out = out.filter(paths.is_trainable(F.coalesce("split", named)))
        out = out.filter(named.isNull() | ~named.isin(*paths.SPLITS) | paths.is_trainable(named))
    for key, value in (labels or {}).items():
        out = out.filter(F.coalesce(F.col(key) == value, F.lit(False)))
    return out
