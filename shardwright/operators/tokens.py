"""Operators over token ids and order vectors.  tokens: path, pos, id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def distinct_floor(n: Column, bound: int) -> Column:
    return F.least(F.lit(bound).cast("long"), F.greatest(F.floor(n / 4), F.when(n > 1, 2).otherwise(1).cast("long")))


def id_statistics(tokens: DataFrame, vocab: int, eos: int, least_distinct: int = 256) -> DataFrame:
    """Per path: ids, out of vocabulary, greatest, distinct, the least distinct wanted, and ends of sequence."""
    ids = tokens.groupBy("path", "id").agg(F.count("*").alias("n"))  # combined before the shuffle; a hot id is one row
    out = ids.groupBy("path").agg(
        F.sum("n").alias("ids"), F.coalesce(F.sum(F.when((F.col("id") < 0) | (F.col("id") >= vocab), F.col("n"))), F.lit(0)).alias("out_of_range"),
        F.max("id").alias("greatest"), F.count("*").alias("distinct_ids"), F.coalesce(F.sum(F.when(F.col("id") == eos, F.col("n"))), F.lit(0)).alias("eos"),
    )
    return out.withColumn("distinct_floor", distinct_floor(F.col("ids"), least_distinct))


#: Positions of a shard that one task orders.
PIECE = 1 << 16


def longest_run(tokens: DataFrame, value: int = 0, piece: int = PIECE) -> DataFrame:
    """path, longest: the longest run of value by position; 0 where there is none.

    Shards are ordered in pieces, so a long one is spread over tasks; of a piece only the runs at its ends, its longest and its size go on, and a shard's pieces are folded in order.
    """
    place = W.partitionBy("path", "piece").orderBy("pos")
    pieces = tokens.select("path", "pos", "id", F.floor(F.col("pos") / piece).alias("piece"))
    hits = pieces.withColumns({"r": F.row_number().over(place), "size": F.count("*").over(W.partitionBy("path", "piece"))})
    hits = hits.withColumn("hit", F.col("id").eqNullSafe(F.lit(value)))
    island = F.col("r") - F.sum(F.col("hit").cast("long")).over(place.rowsBetween(W.unboundedPreceding, 0))
    runs = hits.withColumn("i", F.when(F.col("hit"), island).otherwise(-1)).groupBy("path", "piece", "i").agg(F.count("*").alias("n"), F.min("r").alias("first"), F.max("r").alias("last"), F.max("size").alias("size"))
    n = F.when(F.col("i") >= 0, F.col("n")).otherwise(0)
    ends = runs.groupBy("path", "piece").agg(F.max(n).alias("longest"), F.max(F.when(F.col("first") == 1, n).otherwise(0)).alias("head"), F.max(F.when(F.col("last") == F.col("size"), n).otherwise(0)).alias("tail"), F.max("size").alias("size"))
    start = F.struct(F.lit(0).cast("long").alias("best"), F.lit(0).cast("long").alias("open"))

    def step(a, p):
        open_ = F.when(p["head"] == p["size"], a["open"] + p["size"]).otherwise(p["tail"])
        return F.struct(F.greatest(a["best"], p["longest"], a["open"] + p["head"]).alias("best"), open_.alias("open"))

    ordered = F.sort_array(F.collect_list(F.struct("piece", "size", "head", "longest", "tail")))
    return ends.groupBy("path").agg(ordered.alias("pieces")).select("path", F.aggregate("pieces", start, step)["best"].alias("longest"))


def order_domain(order: DataFrame, blocks: int, ordering: str = "permutation") -> DataFrame:
    """One row: indices, out_of_range, distinct_ids, repeated (ids), worst, missing, and the verdict."""
    return _domains(order, [], blocks, ordering)


def order_domains(order: DataFrame, blocks: int, ordering: str = "permutation") -> DataFrame:
    """As order_domain, a row for each path."""
    return _domains(order, ["path"], blocks, ordering)


def _domains(order: DataFrame, by: list[str], blocks: int, ordering: str) -> DataFrame:
    per = order.groupBy(*by, "id").agg(F.count("*").alias("n"))
    inside = (F.col("id") >= 0) & (F.col("id") < blocks)
    found = per.groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("indices"), F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("out_of_range"), F.count("*").alias("distinct_ids"),
        F.count_if(F.col("n") > 1).alias("repeated"), F.coalesce(F.max("n"), F.lit(0)).alias("worst"), (F.lit(blocks) - F.count_if(inside)).alias("missing"),
    )
    kind = F.lit(ordering)
    verdict = (
        F.when(~kind.isin("permutation", "subset", "repeating"), "bad-ordering-kind").when(F.col("indices") == 0, "order-empty").when(F.col("out_of_range") > 0, "order-index-out-of-range")
        .when((kind == "permutation") & (F.col("indices") != blocks), "permutation-wrong-length").when((kind == "permutation") & ((F.col("missing") > 0) | (F.col("repeated") > 0)), "permutation-not-bijective")
        .when((kind == "subset") & (F.col("repeated") > 0), "subset-not-unique").otherwise("ok")
    )
    return found.withColumn("verdict", verdict)


def order_length(objects: DataFrame) -> DataFrame:
    """code, path.  objects: path, length, declared (indices, or null)."""
    code = F.when(F.col("length") % 4 != 0, "order-bytes-not-multiple").when(F.col("declared") != F.col("length") / 4, "order-length-mismatch")
    return objects.select(code.alias("code"), "path").filter("code is not null")


def vocabulary(tokenizers: DataFrame, ends: tuple[str, ...] = ("</s>", "<eos>", "<|endoftext|>", "<|end_of_text|>", "<|im_end|>")) -> DataFrame:
    """name, vocab_size, eos_id.  tokenizers: name, vocab (map of string to int), added (array of id, content)."""
    added = F.coalesce("added", F.array().cast("array<struct<id:int,content:string>>"))
    highest = F.coalesce(F.array_max(F.transform(added, lambda a: a["id"])), F.lit(-1))
    is_end = lambda a: a["content"].isin(*ends) | a["content"].contains("endoftext")
    last = F.transform(F.filter(added, is_end), lambda a: a["id"])
    return tokenizers.select("name", (F.greatest(F.size(F.map_keys("vocab")) - 1, highest) + 1).cast("long").alias("vocab_size"), F.when(F.size(last) > 0, F.element_at(last, -1)).cast("long").alias("eos_id"))
