"""Weighted, seeded selection of whole shards under budgets.

pool: source, path, n (count), key (seeded order).  wanted: source, ratio, fraction, repetition.
A source is filled in the order of key until its target is reached; a source with fraction below 1,
or with a cap below what is wanted, never goes beyond its cap: a shard that would is passed over and a later, smaller one may be taken.
Passes repeat the pool in the same order only if repetition is above 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def check_request(sources: list[dict], total: int) -> None:
    """Refuses what can't be meant."""
    if not sources:
        raise ValueError("no sources")
    if isinstance(total, bool) or not isinstance(total, int) or total <= 0:
        raise ValueError("total must be a positive integer")
    if len({tuple(sorted(s["labels"].items())) for s in sources}) != len(sources):
        raise ValueError("two sources have the same labels")
    for s in sources:
        if not s["labels"]:
            raise ValueError("a source without labels")
        if not 0 < s["ratio"] <= 1 or not 0 < s.get("fraction", 1.0) <= 1 or not s.get("repetition", 1.0) >= 1:
            raise ValueError("a ratio, fraction or repetition out of range")
    if abs(sum(s["ratio"] for s in sources) - 1) > 1e-6:
        raise ValueError("ratios must sum to 1")


def targets(pool: DataFrame, wanted: DataFrame, total: int) -> DataFrame:
    """source, want, cap, target, fraction, repetition."""
    available = pool.groupBy("source").agg(F.sum("n").alias("available"))
    cap = (F.col("available") * F.col("fraction") * F.col("repetition")).cast("long")
    both = wanted.join(available, "source").withColumns({"want": (F.lit(float(total)) * F.col("ratio")).cast("long"), "cap": cap})
    return both.withColumn("target", F.least("want", "cap"))


def fill(pool: DataFrame, goals: DataFrame) -> DataFrame:
    """Uncapped sources, one pass: a shard is taken while the sum before it is short of the target.  source, path, n."""
    before = F.coalesce(F.sum("n").over(W.partitionBy("source").orderBy("key").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return pool.join(goals.select("source", "target"), "source").withColumn("before", before).filter("before < target").select("source", "path", "n")


def fill_capped(pool: DataFrame, goals: DataFrame) -> DataFrame:
    """Any source.  source, path, n, pass: a fold over the source's shards, which are files of a manifest and so few enough for one row."""
    spec = goals.select("source", "cap", "target", ((F.col("fraction") < 1) | (F.col("cap") < F.col("want"))).alias("strict"), F.when(F.col("repetition") > 1, F.ceil("repetition")).otherwise(1).cast("int").alias("passes"))
    shards = pool.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("key", "path", "n"))).alias("shards"))
    both = shards.join(spec, "source")
    order = F.flatten(F.transform(F.sequence(F.lit(1), F.col("passes")), lambda p: F.transform("shards", lambda s: F.struct(p.alias("pass"), s["path"].alias("path"), s["n"].cast("long").alias("n")))))
    start = F.struct(F.lit(0).cast("long").alias("got"), F.array().cast("array<struct<pass:int,path:string,n:bigint>>").alias("picked"))

    def step(a, s):
        fits = (a["got"] < F.col("target")) & (~F.col("strict") | (a["got"] + s["n"] <= F.col("cap")))
        return F.struct((a["got"] + F.when(fits, s["n"]).otherwise(0)).alias("got"), F.when(fits, F.array_append(a["picked"], s)).otherwise(a["picked"]).alias("picked"))

    return both.select("source", F.explode(F.aggregate(order, start, step)["picked"]).alias("p")).select("source", "p.path", "p.n", "p.pass")


def summary(picked: DataFrame, goals: DataFrame) -> DataFrame:
    """source, want, got, shortfall, actual_ratio."""
    got = goals.join(picked.groupBy("source").agg(F.sum("n").alias("got")), "source", "left").withColumn("got", F.coalesce("got", F.lit(0)))
    whole = got.agg(F.sum("got").alias("whole"))
    return got.join(F.broadcast(whole)).select("source", "want", "got", F.greatest(F.col("want") - F.col("got"), F.lit(0)).alias("shortfall"), F.when(F.col("whole") > 0, F.col("got") / F.col("whole")).otherwise(0.0).alias("actual_ratio"))
