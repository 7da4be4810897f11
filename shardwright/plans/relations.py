"""Dataset relations derived from tables, in Spark and as SQL of the same meaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def document_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as rows of shards: path, row_idx, text, grp, source, domain, split."""
    docs = table(spark, sf_dir, "documents")
    split = F.when(F.col("doc_id") % 20 == 0, "val").otherwise("train")
    domain = F.when(F.col("n_chars") >= 1000, "long").otherwise("short")
    grp = F.concat(F.lit("text-"), F.col("lang"))
    name = F.concat(split, F.lit("-"), F.lpad((F.col("doc_id") % 4).cast("string"), 5, "0"), F.lit(".jsonl"))
    return docs.select(F.concat_ws("/", grp, "source", domain, name).alias("path"), F.col("doc_id").alias("row_idx"), "text", grp.alias("grp"), "source", domain.alias("domain"), split.alias("split"), "n_chars")


DOCUMENT_ROWS = """
rows_ AS (
  SELECT 'text-' || lang || '/' || source || '/' || CASE WHEN n_chars >= 1000 THEN 'long' ELSE 'short' END || '/' ||
         CASE WHEN doc_id % 20 = 0 THEN 'val' ELSE 'train' END || '-' || lpad(CAST(doc_id % 4 AS VARCHAR), 5, '0') || '.jsonl' AS path,
         doc_id AS row_idx, text, 'text-' || lang AS grp, source, CASE WHEN n_chars >= 1000 THEN 'long' ELSE 'short' END AS domain,
         CASE WHEN doc_id % 20 = 0 THEN 'val' ELSE 'train' END AS split, n_chars
  FROM documents)"""


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One manifest entry a shard."""
    found = document_rows(spark, sf_dir).groupBy("path", "grp", "source", "domain", "split").agg(
        keys.content_sum(keys.text_fingerprint(F.col("text"))).alias("sha256"), F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("count_value")
    )
    return found.withColumns({"count_unit": F.lit("rows"), "container": F.lit("jsonl"), "codec": F.lit("none"), "dtype": F.lit(None).cast("string"), "byte_order": F.lit(None).cast("string"), "header_bytes": F.lit(0)})


ENTRIES = (
    DOCUMENT_ROWS
    + """,
entries AS (
  SELECT path, grp, source, domain, split,
         sha256(CAST(sum(CAST('0x' || substr(sha256(text), 1, 15) AS BIGINT)) AS VARCHAR) || ':' || CAST(count(*) AS VARCHAR)) AS sha256,
         CAST(sum(strlen(text)) AS BIGINT) AS bytes, count(*) AS count_value
  FROM rows_ GROUP BY ALL)"""
)


#: What a supplier's tokens are in order of.
TOKEN_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")


def token_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as token shards by supplier, unnumbered: path, place (sorts as the tokens do), id; returned items are the id 0."""
    items = table(spark, sf_dir, "lineitem")
    return items.select(F.concat(F.lit("tokens/"), F.col("l_suppkey").cast("string")).alias("path"), F.struct(*TOKEN_ORDER).alias("place"), F.when(F.col("l_returnflag") == "N", 0).otherwise(F.col("l_partkey")).cast("long").alias("id"))


def token_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as token shards by supplier: returned items are the id 0."""
    from pyspark.sql import Window as W

    items = table(spark, sf_dir, "lineitem")
    pos = F.row_number().over(W.partitionBy("l_suppkey").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"))
    return items.select(F.concat(F.lit("tokens/"), F.col("l_suppkey").cast("string")).alias("path"), pos.alias("pos"), F.when(F.col("l_returnflag") == "N", 0).otherwise(F.col("l_partkey")).cast("long").alias("id"))


TOKEN_ROWS = """
tokens AS (
  SELECT 'tokens/' || CAST(l_suppkey AS VARCHAR) AS path,
         row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice) AS pos,
         CASE WHEN l_returnflag = 'N' THEN 0 ELSE l_partkey END AS id
  FROM lineitem)"""


def evaluations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as evaluation rows: shard, status, metric."""
    kind = F.col("event_type")
    status = F.when(kind == "purchase", "ok").when(kind == "error", "error").when(kind == "signup", "filtered").otherwise(kind)
    return table(spark, sf_dir, "events").select(F.concat(F.lit("eval-"), F.col("user_id").cast("string")).alias("shard"), status.alias("status"), F.col("event_type").alias("metric"), "value")


EVALUATIONS = """
evals AS (
  SELECT 'eval-' || CAST(user_id AS VARCHAR) AS shard,
         CASE event_type WHEN 'purchase' THEN 'ok' WHEN 'error' THEN 'error' WHEN 'signup' THEN 'filtered' ELSE event_type END AS status, event_type AS metric, value
  FROM events)"""


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as rows: conv_id, messages, side."""
    rows = table(spark, sf_dir, "conversations")
    ordered = F.sort_array(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    found = rows.groupBy("conv_id").agg(ordered.alias("m"))
    messages = F.transform("m", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))
    return found.select("conv_id", messages.alias("messages"), F.when(F.col("conv_id") % 5 == 0, "held").otherwise("train").alias("side"))


CHATS = """
chats AS (
  SELECT conv_id, CASE WHEN conv_id % 5 = 0 THEN 'held' ELSE 'train' END AS side, count(*) AS turns,
         count(*) FILTER (WHERE coalesce(role, '') = '') AS roleless,
         sha256(string_agg(coalesce(role, '') || chr(31) || coalesce(text, 'None'), chr(30) ORDER BY turn, role, text)) AS key
  FROM conversations GROUP BY conv_id)"""
