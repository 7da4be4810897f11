"""Operators over the rows of text, conversation and evaluation shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import keys, names
from .manifest import first_rows

REPORTED = 100


def text_problems(rows: DataFrame, least: int = 1, cap: int = REPORTED) -> DataFrame:
    """rows: path, row_idx, text (null: missing).  path, row_idx, code: at most cap a path, then one row text-row-violations-truncated."""
    return coded_problems(rows.select("path", "row_idx", text_code(least).alias("code")), cap)


def text_code(least: int = 1) -> Column:
    text = F.col("text")
    short = ~text.rlike(names.NOT_SPACE) if least == 1 else F.char_length(names.strip(text)) < least  # the first is found without reading on
    return F.when(text.isNull(), "missing-text-field").when(short, "text-field-empty")


def coded_problems(rows: DataFrame, cap: int = REPORTED) -> DataFrame:
    """As text_problems, of rows judged by text_code: path, row_idx, code (null: no problem)."""
    found = rows.select("path", "row_idx", "code").filter("code is not null")
    return first_rows(found, "path", "row_idx", cap, "text-row-violations-truncated")


def top_fraction(rows: DataFrame, limit: float) -> DataFrame:
    """path, rows, top: shards of several rows where one text makes up more than limit of them.  Exact, by two combined aggregations."""
    return keyed_fraction(rows.select("path", keys.text_fingerprint(F.col("text")).alias("k")), limit)


def keyed_fraction(rows: DataFrame, limit: float) -> DataFrame:
    """As top_fraction, of rows with fingerprints: path, k."""
    per = rows.groupBy("path", "k").agg(F.count("*").alias("n"))
    found = per.groupBy("path").agg(F.sum("n").alias("rows"), F.max(F.when(F.col("k").isNotNull(), F.col("n"))).alias("top"))
    return found.filter((F.col("rows") > 1) & (F.col("top") / F.col("rows") > limit)).select("path", "rows", "top")


def row_counts(rows: DataFrame, entries: DataFrame) -> DataFrame:
    """path, declared, counted, code for shards that are empty or don't hold the declared rows.  entries: path, count_value."""
    counted = rows.groupBy("path").agg(F.count("*").alias("counted"))
    both = entries.select("path", F.col("count_value").alias("declared")).join(counted, "path", "left").withColumn("counted", F.coalesce("counted", F.lit(0)))
    code = F.when(F.col("counted") == 0, "empty-shard").when(~F.col("declared").eqNullSafe(F.col("counted")), "row-count-mismatch")
    return both.withColumn("code", code).filter("code is not null")


def message_problem(messages: Column) -> Column:
    """The first thing wrong with an array of (role, content)."""
    return F.when(messages.isNull(), "not-a-list").when(F.size(messages) == 0, "empty").when(F.exists(messages, lambda m: F.coalesce(m["role"], F.lit("")) == ""), "role")


def leakage(conversations: DataFrame, allowed: int = 0) -> DataFrame:
    """Keys on both sides of train and held out, if they are more than allowed.  conversations: key, side."""
    sides = conversations.groupBy("key").agg(F.max((F.col("side") == "train").cast("int")).alias("t"), F.max((F.col("side") == "held").cast("int")).alias("h"))
    both = sides.filter("t = 1 and h = 1").select("key")
    n = both.agg(F.count("*").alias("shared"))
    return both.join(F.broadcast(n), how="inner").filter(F.col("shared") > allowed).select("key") if allowed else both


def eval_accounting(rows: DataFrame, declared: DataFrame) -> DataFrame:
    """shard, declared, counted where they differ.  rows: shard.  declared: shard, ok, error, filtered."""
    counted = rows.groupBy("shard").agg(F.count("*").alias("counted"))
    both = declared.withColumn("declared", F.coalesce("ok", F.lit(0)) + F.coalesce("error", F.lit(0)) + F.coalesce("filtered", F.lit(0))).join(counted, "shard", "left")
    return both.withColumn("counted", F.coalesce("counted", F.lit(0))).filter("declared <> counted").select("shard", "declared", "counted")


def no_success(rows: DataFrame, ok: str = "ok") -> DataFrame:
    """Shards with rows but none of the status ok."""
    return rows.groupBy("shard").agg(F.count("*").alias("rows"), F.count_if(F.col("status") == ok).alias("good")).filter("rows > 0 and good = 0").select("shard", "rows")


def constant_metric(rows: DataFrame) -> DataFrame:
    """Shards with several metric values, all of one spelling.  rows: shard, metric (as written)."""
    own = F.col("metric").cast("string")
    return rows.groupBy("shard").agg(F.count(own).alias("n"), F.min(own).alias("a"), F.max(own).alias("b")).filter("n >= 2 and a = b").select("shard", "n", F.col("a").alias("value"))
