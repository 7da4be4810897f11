"""The registered queries of the dataset operators, each with SQL of the same meaning where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys, names, paths
from ..operators import lineage, manifest, mixture, rows, splits, tokens
from . import relations as R

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


def sql_values(name: str, columns: str, values: list[tuple]) -> str:
    def one(v):
        return "NULL" if v is None else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)

    return f"{name}({columns}) AS (VALUES " + ", ".join("(" + ", ".join(map(one, r)) + ")" for r in values) + ")"


# --- manifests ---


@query(f"WITH {R.ENTRIES} SELECT CASE WHEN grouping(grp) = 1 THEN '*' ELSE grp END AS grp, count(*) AS objects, CAST(sum(bytes) AS BIGINT) AS bytes, CAST(sum(count_value) AS BIGINT) AS count_value FROM entries GROUP BY GROUPING SETS ((grp), ())")
def manifest_totals(spark, sf_dir):
    return manifest.totals(R.entries(spark, sf_dir))


@query(f"WITH {R.ENTRIES} SELECT path, grp, source, domain, split, sha256, bytes, count_value, 'rows' AS count_unit, 'jsonl' AS container FROM entries")
def manifest_entries(spark, sf_dir):
    e = R.entries(spark, sf_dir)
    label = paths.labels(F.col("path"))
    return e.select("path", paths.group_of(F.col("path")).alias("grp"), label["source"].alias("source"), label["domain"].alias("domain"), paths.shard_split(F.col("path")).alias("split"), "sha256", "bytes", "count_value", "count_unit", paths.claimed(F.col("path"), "container").alias("container"))


NAMES = ["tokens/train-00007.u32le.bin", "tokens/train-00000-of-00042.u32le.bin", "held-out-00003.jsonl", "a/b/Train-00001.bin", "val-0001.bin", "x/test-12345.jsonl.gz", "f" * 64 + ".bin", "2x-00001.bin", "22-00001.bin", "train-00001.", "train-000011.bin"]
_SHARD_SQL = "'^([a-z0-9]*[a-z][a-z0-9]*(?:-[a-z0-9]*[a-z][a-z0-9]*)*)-(\\d{5})\\.([A-Za-z0-9.]+)$'"


@query(f"WITH {R.ENTRIES}, n(path) AS (SELECT path FROM entries UNION ALL SELECT * FROM (VALUES " + ", ".join(f"('{n}')" for n in NAMES) + f")), b AS (SELECT path, list_last(string_split(path, '/')) AS name FROM n) SELECT path, nullif(regexp_extract(name, {_SHARD_SQL}, 1), '') AS split, CAST(nullif(regexp_extract(name, {_SHARD_SQL}, 2), '') AS INTEGER) AS ordinal, regexp_matches(name, '^[0-9a-f]{{64}}\\.[A-Za-z0-9.]+$') AS cas FROM b")
def shard_name_parse(spark, sf_dir):
    both = R.entries(spark, sf_dir).select("path").unionByName(spark.createDataFrame([(n,) for n in NAMES], "path string"))
    p = F.col("path")
    return both.select("path", paths.shard_split(p).alias("split"), paths.shard_ordinal(p).alias("ordinal"), paths.is_cas(p).alias("cas"))


NESTED = ["tokens/train-00000.bin", "tokens/src/train-00000.bin", "tokens/a/b/c/train-00000.bin", "flat.bin"]


@query(f"WITH {R.ENTRIES}, n(path) AS (SELECT path FROM entries UNION ALL SELECT * FROM (VALUES " + ", ".join(f"('{n}')" for n in NESTED) + ")), b AS (SELECT path, string_split(path, '/') AS p FROM n) SELECT path, CASE WHEN len(p) > 1 THEN p[1] ELSE '' END AS grp, CASE WHEN len(p) BETWEEN 3 AND 4 THEN p[2] END AS source, CASE WHEN len(p) = 4 THEN p[3] END AS domain, len(p) > 4 AS unnameable FROM b")
def path_labels(spark, sf_dir):
    both = R.entries(spark, sf_dir).select("path").unionByName(spark.createDataFrame([(n,) for n in NESTED], "path string"))
    p = F.col("path")
    return both.select("path", paths.group_of(p).alias("grp"), paths.labels(p)["source"].alias("source"), paths.labels(p)["domain"].alias("domain"), (F.size(paths.label_segments(p)) > 2).alias("unnameable"))


FORMATS = [
    ("a/train-00000.u32le.bin", "raw", "uint32", "little", 0, "none"), ("a/train-00001.u32le.bin", "raw", "uint16", "little", 128, "none"), ("a/train-00002.npy", "npy", "uint32", None, 0, "none"),
    ("a/train-00003.npy", "raw", "uint32", "little", 0, "none"), ("a/train-00004.JSONL.GZ", "jsonl", None, None, 0, "none"), ("a/train-00005.parquet", "parquet", "int64", None, 0, "snappy"), ("a/train-00006.xyz", "raw", "uint8", "big", 3, "zip"),
    ("a/train-00007.f16be.bin", "raw", "float16", "little", 0, "none"), ("a/train-00008.u8.bin", "raw", "uint8", None, 0, "none"),
]
_FORMAT_COLUMNS = "path, container, dtype, byte_order, header_bytes, codec"


def _extension_sql() -> str:
    claims = ", ".join("(" + ", ".join("NULL" if c.get(k) is None else repr(c[k]) if isinstance(c.get(k), str) else str(c[k]) for k in ("container", "dtype", "byte_order", "header_bytes", "codec", "min_header_bytes")) + f", '{e}')" for e, c in paths.CLAIMS.items())
    fields = " UNION ALL ".join(f"SELECT path, '{k}' AS field FROM m WHERE c_{k} IS NOT NULL AND {k} IS DISTINCT FROM c_{k}" for k in ("container", "dtype", "byte_order", "header_bytes", "codec"))
    return f"""WITH {R.ENTRIES}, {sql_values('v', _FORMAT_COLUMNS, FORMATS)}, f AS (SELECT * FROM v UNION ALL SELECT path, 'jsonl', NULL, NULL, 0, 'none' FROM entries),
      c(c_container, c_dtype, c_byte_order, c_header_bytes, c_codec, least, ext) AS (VALUES {claims}),
      m AS (SELECT * FROM f JOIN c ON ends_with(lower(path), ext) QUALIFY row_number() OVER (PARTITION BY path ORDER BY length(ext) DESC) = 1)
      {fields} UNION ALL SELECT path, 'min_header_bytes' FROM m WHERE header_bytes < least"""


@query(_extension_sql())
def extension_format_check(spark, sf_dir):
    own = spark.createDataFrame(FORMATS, "path string, container string, dtype string, byte_order string, header_bytes int, codec string")
    return manifest.extension_contradictions(R.entries(spark, sf_dir).select(*own.columns).unionByName(own))


COUNTS = [("a/train-00000.u32le.bin", "tokens", 10, 40, "raw", "uint32", 0, "none"), ("a/train-00001.u32le.bin", "tokens", 10, 38, "raw", "uint32", 0, "none"), ("a/train-00002.u16le.bin", "indices", 5, 18, "raw", "uint16", 8, "none"), ("a/b.jsonl", "rows", 5, 18, "jsonl", None, 0, "none"), ("a/c.bin", "tokens", 5, 1, "raw", "uint32", 0, "gzip")]


_TOKEN_FILES = "SELECT path, 'tokens' AS count_unit, count(*) AS count_value, count(*) * 4 + CASE WHEN max(id) % 2 = 0 THEN 2 ELSE 0 END AS bytes, 'raw' AS container, CASE WHEN max(id) % 3 = 0 THEN 'uint16' ELSE 'uint32' END AS dtype, 0 AS header_bytes, 'none' AS codec FROM tokens GROUP BY path"


@query(f"WITH {R.TOKEN_ROWS}, {sql_values('own', 'path, count_unit, count_value, bytes, container, dtype, header_bytes, codec', COUNTS)}, v AS (SELECT * FROM own UNION ALL {_TOKEN_FILES}), w(dtype, width) AS (VALUES " + ", ".join(f"('{k}', {v})" for k, v in paths.WIDTHS.items()) + ") SELECT path, CAST(count_value * width + header_bytes AS BIGINT) AS expected, CAST(bytes AS BIGINT) AS declared FROM v JOIN w USING (dtype) WHERE count_unit IN ('tokens', 'indices') AND codec = 'none' AND container = 'raw' AND count_value * width + header_bytes <> bytes")
def count_arithmetic(spark, sf_dir):
    """Token shards by supplier, some with stray bytes or a narrower type, and every kind of entry."""
    own = spark.createDataFrame(COUNTS, "path string, count_unit string, count_value long, bytes long, container string, dtype string, header_bytes int, codec string")
    found = R.token_rows(spark, sf_dir).groupBy("path").agg(F.count("*").alias("count_value"), F.max("id").alias("top"))
    found = found.select(
        "path", F.lit("tokens").alias("count_unit"), "count_value", (F.col("count_value") * 4 + F.when(F.col("top") % 2 == 0, 2).otherwise(0)).alias("bytes"), F.lit("raw").alias("container"),
        F.when(F.col("top") % 3 == 0, "uint16").otherwise("uint32").alias("dtype"), F.lit(0).alias("header_bytes"), F.lit("none").alias("codec"),
    )
    return manifest.count_arithmetic(own.unionByName(found))


_SHARDS = "SELECT path || '/train-00000.bin' AS path, count(*) AS n, max(id) AS top FROM tokens GROUP BY path"


def _shards(spark, sf_dir):
    """path, n (ids) and top (the greatest) of the token shards by supplier."""
    return R.token_rows(spark, sf_dir).groupBy("path").agg(F.count("*").alias("n"), F.max("id").alias("top")).select(F.concat("path", F.lit("/train-00000.bin")).alias("path"), "n", "top")


@query(f"""WITH {R.TOKEN_ROWS}, s AS ({_SHARDS}), e AS (SELECT path, CASE WHEN n % 7 = 0 THEN 'jsonl' ELSE 'raw' END AS container, CASE top % 4 WHEN 0 THEN 'uint8' WHEN 1 THEN 'uint16' WHEN 2 THEN 'uint24' ELSE NULL END AS dtype FROM s),
c AS (SELECT path, CASE WHEN container = 'raw' AND dtype = 'uint24' THEN 'dtype-not-checkable' WHEN container <> 'raw' AND dtype IN ('uint8', 'uint16') THEN 'fixed-width-dtype-in-nonraw-container' WHEN container = 'raw' AND dtype = 'uint8' THEN 'dtype-too-narrow-for-vocab' END AS code FROM e) SELECT code, path FROM c WHERE code IS NOT NULL""")
def token_dtype_width(spark, sf_dir):
    """Token shards of every kind of type, for a vocabulary that needs two bytes."""
    kind = F.col("top") % 4
    dtype = F.when(kind == 0, "uint8").when(kind == 1, "uint16").when(kind == 2, "uint24")
    e = _shards(spark, sf_dir).select("path", F.when(F.col("n") % 7 == 0, "jsonl").otherwise("raw").alias("container"), dtype.alias("dtype"), F.lit("tokens").alias("count_unit"))
    return manifest.dtype_width(e, 50_000)


@query(f"WITH {R.TOKEN_ROWS}, s AS ({_SHARDS}) SELECT 'seq-len-misalignment' AS code, path FROM s WHERE top % 3 > 0 AND n * 4 % (CASE WHEN top % 3 = 1 THEN 4 ELSE 2 END * 16) <> 0")
def sequence_alignment(spark, sf_dir):
    """Shards that aren't whole sequences of 16; those without a type aren't judged."""
    kind = F.col("top") % 3
    e = _shards(spark, sf_dir).select("path", (F.col("n") * 4).alias("bytes"), F.when(kind == 1, "uint32").when(kind == 2, "uint16").alias("dtype"))
    return manifest.sequence_alignment(e, 16)


@query(f"WITH {R.TOKEN_ROWS}, s AS ({_SHARDS}), l AS (SELECT path, n * 4 + CASE WHEN top % 5 = 0 THEN 1 ELSE 0 END AS length, CASE top % 3 WHEN 0 THEN n WHEN 1 THEN n + 1 END AS declared FROM s), c AS (SELECT path, CASE WHEN length % 4 <> 0 THEN 'order-bytes-not-multiple' WHEN declared * 4 <> length THEN 'order-length-mismatch' END AS code FROM l) SELECT code, path FROM c WHERE code IS NOT NULL")
def order_length(spark, sf_dir):
    """Order vectors with stray bytes, with another count than declared, and with none declared."""
    kind = F.col("top") % 3
    return tokens.order_length(_shards(spark, sf_dir).select("path", (F.col("n") * 4 + (F.col("top") % 5 == 0).cast("int")).alias("length"), F.when(kind == 0, F.col("n")).when(kind == 1, F.col("n") + 1).alias("declared")))


_PROFILED = f"{R.ENTRIES}, n(path, profile) AS (SELECT path, 'text-corpus/v1' FROM entries UNION ALL SELECT * FROM (VALUES " + ", ".join(f"('{n}', '{p}')" for n in NAMES for p in ("pretrain-tokens/v1", "vendored/v1")) + "))"


@query(f"WITH {_PROFILED}, b AS (SELECT path, profile, list_last(string_split(path, '/')) AS name FROM n) SELECT 'shard-naming' AS code, path FROM b WHERE NOT starts_with(profile, 'vendored/') AND NOT regexp_matches(name, {_SHARD_SQL}) AND NOT regexp_matches(name, '^[0-9a-f]{{64}}\\.[A-Za-z0-9.]+$')")
def shard_naming(spark, sf_dir):
    """Names of no accepted form, where the profile isn't exempt."""
    own = spark.createDataFrame([(n, p) for n in NAMES for p in ("pretrain-tokens/v1", "vendored/v1")], "path string, profile string")
    return manifest.naming(R.entries(spark, sf_dir).select("path", F.lit("text-corpus/v1").alias("profile")).unionByName(own))


@query(f"WITH {R.DOCUMENT_ROWS}, c AS (SELECT path, count(*) AS n FROM rows_ GROUP BY path) SELECT 'duplicate-path' AS code, path FROM c WHERE n > 1")
def duplicate_paths(spark, sf_dir):
    """Every document listed as an entry of its shard."""
    return manifest.duplicate_paths(R.document_rows(spark, sf_dir))


@query(f"WITH {R.ENTRIES}, t AS (SELECT CASE WHEN grouping(grp) = 1 THEN '*' ELSE grp END AS grp, count(*) AS objects, CAST(sum(bytes) AS BIGINT) AS bytes FROM entries GROUP BY GROUPING SETS ((grp), ())) SELECT 'objects-total' AS code, grp AS path FROM t WHERE grp = '*' UNION ALL SELECT 'bytes-total', grp FROM t WHERE grp <> '*' AND bytes % 2 = 1 UNION ALL SELECT code, 'absent' FROM (VALUES ('objects-total'), ('bytes-total')) v(code)")
def declared_totals(spark, sf_dir):
    """Totals declared one object short on the whole, in even bytes by group, and for a group that isn't there."""
    e = R.entries(spark, sf_dir)
    whole = F.col("grp") == manifest.WHOLE
    said = manifest.totals(e).select("grp", F.when(whole, F.col("objects") - 1).otherwise(F.col("objects")).alias("objects"), F.when(whole, F.col("bytes")).otherwise(F.col("bytes") - F.col("bytes") % 2).alias("bytes"))
    return manifest.totals_mismatch(e, said.unionByName(spark.createDataFrame([("absent", 1, 1)], "grp string, objects long, bytes long")))


CONTROLS = ["dataset.json", "_SUCCESS", "_VALIDATED.json", "_REJECTED.json", "README.md", "manifest.json", "text/manifest.json", "text/a/manifest.json", "text/dataset.json", "_catalog/a/b/v1.json", "dependents/x", "catalog/x.json", "text/README.md"]


@query(f"WITH {R.ENTRIES}, {sql_values('v', 'path', [(c,) for c in CONTROLS])}, n AS (SELECT path FROM entries UNION ALL SELECT path FROM v) SELECT path, path IN ('dataset.json', '_SUCCESS', '_VALIDATED.json', '_REJECTED.json', 'README.md', 'manifest.json') OR regexp_matches(path, '^[^/]*/manifest\\.json$') OR starts_with(path, '_catalog/') OR starts_with(path, 'dependents/') AS control FROM n")
def control_keys(spark, sf_dir):
    both = R.entries(spark, sf_dir).select("path").unionByName(spark.createDataFrame([(c,) for c in CONTROLS], "path string"))
    return both.select("path", paths.is_control(F.col("path")).alias("control"))


@query("SELECT 'missing' AS side, CAST(doc_id AS VARCHAR) AS path FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT DISTINCT 'extra', CAST(doc_id AS VARCHAR) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)")
def exhaustive_diff(spark, sf_dir):
    """Documents as listed, labelled ones as stored."""
    own = lambda n: R.table(spark, sf_dir, n).select(F.col("doc_id").cast("string").alias("path"))
    return manifest.diff(own("documents"), own("labels"))


@query("SELECT CAST(doc_id AS VARCHAR) AS path, n_chars AS declared, CAST(strlen(text) AS BIGINT) AS observed FROM documents WHERE n_chars <> strlen(text)")
def size_mismatch(spark, sf_dir):
    """Declared characters against stored bytes: they differ where a text isn't ASCII."""
    docs = R.table(spark, sf_dir, "documents").withColumn("path", F.col("doc_id").cast("string"))
    return manifest.size_mismatch(docs.select("path", F.col("n_chars").alias("bytes")), docs.select("path", F.octet_length("text").cast("long").alias("length")))


@query(f"WITH {R.ENTRIES}, g(split) AS (SELECT DISTINCT split FROM entries), p(split) AS (VALUES ('train'), ('test')) SELECT 'undeclared-split' AS code, split FROM g WHERE split NOT IN (SELECT split FROM p) UNION ALL SELECT 'empty-split', split FROM p WHERE split NOT IN (SELECT split FROM g)")
def split_differences(spark, sf_dir):
    return splits.split_differences(R.entries(spark, sf_dir), ["train", "test"])


@query(f"WITH {R.ENTRIES} SELECT path FROM entries WHERE grp NOT IN ('text-en', 'text-de', 'text-fr')")
def dataset_orphans(spark, sf_dir):
    """Stored objects that no group's manifest lists, where the dataset declares three groups."""
    e = R.entries(spark, sf_dir)
    claimed = e.filter(F.col("grp").isin("text-en", "text-de", "text-fr"))
    return manifest.diff(claimed, e).filter("side = 'extra'").select("path")


_AS_ENTRIES = "e AS (SELECT lpad(CAST(doc_id AS VARCHAR), 12, '0') AS path, source AS grp, sha256(text) AS sha256 FROM documents)"


def _document_entries(spark, sf_dir):
    return R.table(spark, sf_dir, "documents").select(F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("path"), F.col("source").alias("grp"), keys.text_fingerprint(F.col("text")).alias("sha256"))


@query(f"WITH {_AS_ENTRIES} SELECT grp, path, first FROM (SELECT *, min(path) OVER (PARTITION BY grp, sha256) AS first FROM e) WHERE path <> first")
def duplicate_digest(spark, sf_dir):
    return manifest.duplicate_digests(_document_entries(spark, sf_dir))


@query(f"WITH {_AS_ENTRIES} SELECT path FROM e WHERE grp <> 'src1' AND sha256 IN (SELECT sha256 FROM e WHERE grp = 'src1')")
def parent_digest_overlap(spark, sf_dir):
    """Every other source against src1 as the pinned parent."""
    e = _document_entries(spark, sf_dir)
    return lineage.shared_digests(e.filter("grp <> 'src1'"), e.filter("grp = 'src1'"))


# --- partitions ---

PARTITIONS = [("train", "train-*.jsonl"), ("val", "val-*.jsonl"), ("test", "*-0000[02].jsonl"), ("short", "*/short/*"), ("none", "absent-*")]
_NAMED = "named AS (" + " UNION ALL ".join(
    f"SELECT '{n}' AS name, path, count_value FROM entries WHERE {w}"
    for n, w in (("train", "regexp_matches(path, '/train-[^/]*\\.jsonl$')"), ("val", "regexp_matches(path, '/val-[^/]*\\.jsonl$')"), ("test", "regexp_matches(path, '-0000[02]\\.jsonl$')"), ("short", "path LIKE '%/short/%'"))
) + ")"


@query(f"WITH {R.ENTRIES}, {_NAMED}, p(name) AS (VALUES ('train'), ('val'), ('test'), ('short'), ('none')) SELECT p.name, count(path) AS objects, CAST(sum(count_value) AS BIGINT) AS rows FROM p LEFT JOIN named USING (name) GROUP BY p.name")
def partition_rows(spark, sf_dir):
    return splits.partition_rows(R.entries(spark, sf_dir), PARTITIONS)


@query(f'WITH {R.ENTRIES}, {_NAMED} SELECT a.name AS "left", b.name AS "right", count(*) AS objects FROM named a JOIN named b ON a.path = b.path AND a.name < b.name GROUP BY ALL')
def partition_disjoint(spark, sf_dir):
    return splits.overlaps(R.entries(spark, sf_dir), PARTITIONS)


@query(f"WITH {R.ENTRIES} SELECT path FROM entries WHERE NOT (path LIKE '%/val-%' OR path LIKE '%/short/%')")
def partition_uncovered(spark, sf_dir):
    return splits.uncovered(R.entries(spark, sf_dir), [PARTITIONS[1], PARTITIONS[3]])


@query(f"WITH {R.ENTRIES}, {_NAMED} SELECT a.name AS trainable, b.name AS held_out, count(*) AS objects FROM named a JOIN named b ON a.path = b.path WHERE a.name = 'train' AND b.name IN ('val', 'test') GROUP BY ALL")
def split_leak(spark, sf_dir):
    return splits.leaks(R.entries(spark, sf_dir), PARTITIONS)


@query(f"WITH {R.ENTRIES} SELECT grp, CAST(0 AS BIGINT) AS formats, CAST(NULL AS VARCHAR) AS format, CAST(sum(count_value) AS BIGINT) AS total FROM entries GROUP BY grp UNION ALL SELECT 'tokens', 1, 'uint32/little/0', count(*) FROM lineitem UNION ALL SELECT 'mixed', 2, NULL, NULL")
def format_agreement(spark, sf_dir):
    e = R.entries(spark, sf_dir).select("grp", "count_unit", "count_value", "dtype", "byte_order", "header_bytes")
    raw = R.token_rows(spark, sf_dir).groupBy("path").agg(F.count("*").alias("count_value")).select(F.lit("tokens").alias("grp"), F.lit("tokens").alias("count_unit"), "count_value", F.lit("uint32").alias("dtype"), F.lit("little").alias("byte_order"), F.lit(0).alias("header_bytes"))
    mixed = spark.createDataFrame([("mixed", "tokens", 1, "uint16", "little", 0), ("mixed", "rows", 2, "uint32", "little", 0)], "grp string, count_unit string, count_value long, dtype string, byte_order string, header_bytes int")
    return manifest.format_agreement(e.unionByName(raw).unionByName(mixed))


@query(f"WITH {R.ENTRIES} SELECT path, count_value FROM entries WHERE split = 'train'")
def resolve_split(spark, sf_dir):
    return splits.resolve(R.entries(spark, sf_dir)).select("path", "count_value")


@query(f"WITH {R.ENTRIES} SELECT path, count_value FROM entries WHERE split = 'train' AND source = 'src2' AND domain = 'long'")
def resolve_labels(spark, sf_dir):
    return splits.resolve(R.entries(spark, sf_dir), split="train", labels={"source": "src2", "domain": "long"}).select("path", "count_value")


@query(f"WITH {R.ENTRIES}, x AS (SELECT path, CASE WHEN domain = 'long' THEN 'train' ELSE split END AS split, source, domain FROM entries UNION ALL SELECT 'g/a/b/c/train-00000.bin', 'train', 'a', 'b') SELECT 'split-contradicts-filename' AS code, path FROM x WHERE domain = 'long' AND path LIKE '%/val-%' UNION ALL SELECT 'labels-unnameable-path', 'g/a/b/c/train-00000.bin'")
def entry_contradictions(spark, sf_dir):
    """Entries of long texts declared as train whatever their name, and one nested too deep."""
    e = R.entries(spark, sf_dir).select("path", F.when(F.col("domain") == "long", "train").otherwise(F.col("split")).alias("split"), "source", "domain")
    e = e.unionByName(spark.createDataFrame([("g/a/b/c/train-00000.bin", "train", "a", "b")], e.schema))
    return manifest.union([manifest.split_contradictions(e), manifest.label_contradictions(e), manifest.naming(e)])


# --- mixtures ---

_WANTED = "w AS (SELECT source, 1.0 / CAST(count(*) OVER () AS DOUBLE) AS ratio FROM (SELECT DISTINCT source FROM entries WHERE split = 'train')), t AS (SELECT CAST(sum(count_value) // 2 AS BIGINT) AS total FROM entries WHERE split = 'train')"
_POOL = "pool AS (SELECT source, path, count_value AS n, sha256('42|text/corpus|v1|' || path) AS key FROM entries WHERE split = 'train')"


def _pool(spark, sf_dir, fraction=1.0, repetition=1.0):
    e = R.entries(spark, sf_dir).filter("split = 'train'")
    pool = e.select("source", "path", F.col("count_value").alias("n"), keys.shuffle_key(F.lit(42), F.lit("text/corpus"), F.lit("v1"), F.col("path")).alias("key"))
    total, sources = e.agg(F.floor(F.sum("count_value") / 2), F.count_distinct("source")).first()
    wanted = e.select("source").distinct().select("source", F.lit(1.0 / max(sources, 1)).alias("ratio"), F.lit(fraction).alias("fraction"), F.lit(repetition).alias("repetition"))
    return pool, mixture.targets(pool, wanted, total or 0)


@query(f"WITH {R.ENTRIES}, {_WANTED}, {_POOL}, g AS (SELECT source, least(CAST(trunc(CAST(total AS DOUBLE) * ratio) AS BIGINT), (SELECT sum(n) FROM pool WHERE pool.source = w.source)) AS target FROM w, t), r AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM pool) SELECT source, path, n FROM r JOIN g USING (source) WHERE before < target")
def mixture_uncapped(spark, sf_dir):
    return mixture.fill(*_pool(spark, sf_dir))


_CAPPED = f"""WITH RECURSIVE {R.ENTRIES}, {_WANTED}, {_POOL},
g AS (SELECT source, trunc(CAST(total AS DOUBLE) * ratio) AS want, trunc(CAST((SELECT sum(n) FROM pool WHERE pool.source = w.source) AS DOUBLE) * 0.4) AS cap FROM w, t),
o AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY key) AS k FROM pool),
f AS (
  SELECT source, CAST(0 AS BIGINT) AS k, CAST(0 AS DOUBLE) AS got, CAST(NULL AS VARCHAR) AS path, CAST(0 AS BIGINT) AS n, false AS took FROM g
  UNION ALL
  SELECT f.source, o.k, f.got + CASE WHEN f.got < least(want, cap) AND f.got + o.n <= cap THEN o.n ELSE 0 END, o.path, o.n, f.got < least(want, cap) AND f.got + o.n <= cap
  FROM f JOIN g USING (source) JOIN o ON o.source = f.source AND o.k = f.k + 1)"""


@query(_CAPPED + " SELECT source, path, n, 1 AS pass FROM f WHERE took")
def mixture_capped(spark, sf_dir):
    pool, goals = _pool(spark, sf_dir, fraction=0.4)
    return mixture.fill_capped(pool, goals).withColumn("n", F.col("n").cast("long"))


@query(_CAPPED + " , s AS (SELECT source, CAST(any_value(want) AS BIGINT) AS want, CAST(coalesce(sum(n) FILTER (WHERE took), 0) AS BIGINT) AS got FROM f JOIN g USING (source) GROUP BY source) SELECT source, want, got, greatest(want - got, 0) AS shortfall, CAST(got AS DOUBLE) / sum(got) OVER () AS actual_ratio FROM s")
def mixture_summary(spark, sf_dir):
    pool, goals = _pool(spark, sf_dir, fraction=0.4)
    return mixture.summary(mixture.fill_capped(pool, goals), goals)


# --- rows ---


@query(f"WITH {R.DOCUMENT_ROWS}, b AS (SELECT path, row_idx, 'text-field-empty' AS code, row_number() OVER (PARTITION BY path ORDER BY row_idx) AS k FROM rows_ WHERE length(text) < 600) SELECT path, row_idx, code FROM b WHERE k <= 3 UNION ALL SELECT DISTINCT path, NULL, 'text-row-violations-truncated' FROM b WHERE k = 4")
def text_row_violations(spark, sf_dir):
    """Texts of fewer than 600 characters, three a shard at most before truncation."""
    return rows.text_problems(R.document_rows(spark, sf_dir), least=600, cap=3)


@query(f"WITH {R.DOCUMENT_ROWS}, c AS (SELECT path, text, count(*) AS n FROM rows_ GROUP BY ALL) SELECT path, CAST(sum(n) AS BIGINT) AS rows, max(n) AS top FROM c GROUP BY path HAVING sum(n) > 1 AND max(n) / sum(n) > 0.3")
def text_top_fraction(spark, sf_dir):
    return rows.top_fraction(R.document_rows(spark, sf_dir), 0.3)


@query(f"WITH {R.DOCUMENT_ROWS} SELECT path, count(*) AS counted, CAST(count(*) FILTER (WHERE n_chars >= 300) AS BIGINT) AS declared, 'row-count-mismatch' AS code FROM rows_ GROUP BY path HAVING count(*) <> count(*) FILTER (WHERE n_chars >= 300) UNION ALL SELECT 'text-en/none/long/train-00000.jsonl', 0, 7, 'empty-shard'")
def row_count_mismatch(spark, sf_dir):
    """Declared: texts of 300 characters and more; one shard has no rows."""
    r = R.document_rows(spark, sf_dir)
    said = r.groupBy("path").agg(F.count_if(F.col("n_chars") >= 300).alias("count_value"))
    return rows.row_counts(r, said.unionByName(spark.createDataFrame([("text-en/none/long/train-00000.jsonl", 7)], "path string, count_value long")))


@query(f"WITH {R.CHATS} SELECT conv_id, key FROM chats")
def conversation_keys(spark, sf_dir):
    return R.chats(spark, sf_dir).select("conv_id", keys.conversation_key(F.col("messages")).alias("key"))


@query(f"WITH {R.CHATS} SELECT conv_id, CASE WHEN roleless > 0 THEN 'role' END AS problem FROM chats")
def conversation_wellformed(spark, sf_dir):
    return R.chats(spark, sf_dir).select("conv_id", rows.message_problem(F.col("messages")).alias("problem"))


@query(f"""WITH {R.CHATS}, more AS (SELECT key, side FROM chats UNION ALL SELECT key, 'held' FROM chats WHERE side = 'train' AND conv_id % 7 = 0),
c AS (SELECT key, max(CASE WHEN side = 'held' THEN 1 ELSE 0 END) AS h, max(CASE WHEN side = 'held' THEN 0 ELSE 1 END) AS t FROM more GROUP BY 1) SELECT key FROM c WHERE h = 1 AND t = 1""")
def train_heldout_leakage(spark, sf_dir):
    """Whole conversations on both sides; a seventh of those for training leak."""
    chats = R.chats(spark, sf_dir).select("conv_id", keys.conversation_key(F.col("messages")).alias("key"), "side")
    leaked = chats.filter("side = 'train' AND conv_id % 7 = 0").withColumn("side", F.lit("held"))
    return rows.leakage(chats.unionByName(leaked).select("key", "side"))


@query(f"WITH {R.EVALUATIONS} SELECT shard, count(*) FILTER (WHERE status IN ('ok', 'error', 'filtered')) AS declared, count(*) AS counted FROM evals GROUP BY shard HAVING count(*) <> count(*) FILTER (WHERE status IN ('ok', 'error', 'filtered'))")
def eval_accounting(spark, sf_dir):
    e = R.evaluations(spark, sf_dir)
    said = e.groupBy("shard").agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("ok", "error", "filtered")])
    return rows.eval_accounting(e, said)


@query(f"WITH {R.EVALUATIONS} SELECT shard || ':' || status AS shard, count(*) AS rows FROM evals WHERE status <> 'ok' GROUP BY 1")
def eval_no_success(spark, sf_dir):
    e = R.evaluations(spark, sf_dir)
    return rows.no_success(e.withColumn("shard", F.concat_ws(":", "shard", "status")))


@query(f"WITH {R.EVALUATIONS} SELECT shard || ':' || status AS shard, count(*) AS n, min(metric) AS value FROM evals GROUP BY 1 HAVING count(metric) >= 2 AND min(metric) = max(metric)")
def eval_constant_metric(spark, sf_dir):
    e = R.evaluations(spark, sf_dir)
    return rows.constant_metric(e.withColumn("shard", F.concat_ws(":", "shard", "status")))


# --- tokens and orders ---


@query(f"WITH {R.TOKEN_ROWS}, s AS (SELECT path, count(*) AS ids, count(*) FILTER (WHERE id < 0 OR id >= 1500) AS out_of_range, max(id) AS greatest, count(DISTINCT id) AS distinct_ids, count(*) FILTER (WHERE id = 1) AS eos FROM tokens GROUP BY path) SELECT *, CAST(least(256, greatest(ids // 4, CASE WHEN ids > 1 THEN 2 ELSE 1 END)) AS BIGINT) AS distinct_floor FROM s")
def token_vocab_eos(spark, sf_dir):
    return tokens.id_statistics(R.token_rows(spark, sf_dir), vocab=1500, eos=1)


@query(f"WITH {R.TOKEN_ROWS}, i AS (SELECT path, pos - row_number() OVER (PARTITION BY path ORDER BY pos) AS island FROM tokens WHERE id = 0), r AS (SELECT path, island, count(*) AS n FROM i GROUP BY ALL), m AS (SELECT path, max(n) AS longest FROM r GROUP BY path) SELECT p.path, CAST(coalesce(longest, 0) AS BIGINT) AS longest FROM (SELECT DISTINCT path FROM tokens) p LEFT JOIN m USING (path)")
def token_longest_run(spark, sf_dir):
    return tokens.longest_run(R.token_rows(spark, sf_dir))


@query("WITH c AS (SELECT p_partkey AS id, count(*) AS n FROM part GROUP BY 1), b AS (SELECT count(*) AS blocks FROM part) SELECT CAST(sum(n) AS BIGINT) AS indices, CAST(coalesce(sum(n) FILTER (WHERE id < 0 OR id >= blocks), 0) AS BIGINT) AS out_of_range, count(*) AS distinct_ids, count(*) FILTER (WHERE n > 1) AS repeated, max(n) AS worst, any_value(blocks) - count(*) FILTER (WHERE id >= 0 AND id < blocks) AS missing, 'ok' AS verdict FROM c, b")
def order_permutation(spark, sf_dir):
    part = R.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"))
    return tokens.order_domain(part, part.count())


@query("WITH c AS (SELECT l_partkey AS id, count(*) AS n FROM lineitem GROUP BY 1), b AS (SELECT count(*) AS blocks FROM part) SELECT CAST(sum(n) AS BIGINT) AS indices, CAST(coalesce(sum(n) FILTER (WHERE id < 0 OR id >= blocks), 0) AS BIGINT) AS out_of_range, count(*) AS distinct_ids, count(*) FILTER (WHERE n > 1) AS repeated, max(n) AS worst, any_value(blocks) - count(*) FILTER (WHERE id >= 0 AND id < blocks) AS missing, 'subset-not-unique' AS verdict FROM c, b")
def order_subset(spark, sf_dir):
    items = R.table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("id"))
    return tokens.order_domain(items, R.table(spark, sf_dir, "part").count(), "subset")


@query("SELECT p_partkey, CAST(CASE WHEN p_partkey * 40 <= 255 THEN 1 WHEN p_partkey * 40 <= 65535 THEN 2 ELSE 4 END AS INTEGER) AS width FROM part")
def min_dtype_width(spark, sf_dir):
    return R.table(spark, sf_dir, "part").select("p_partkey", paths.least_width(F.col("p_partkey") * 40 + 1).alias("width"))


TOKENIZERS = [("plain", {"a": 0, "b": 1, "c": 2}, None), ("ended", {"a": 0}, [(7, "</s>"), (9, "<|endoftext|>"), (8, "<pad>")]), ("odd", {}, [(3, "x<endoftext>y")])]


@query("SELECT * FROM (VALUES ('plain', CAST(3 AS BIGINT), CAST(NULL AS BIGINT)), ('ended', 10, 9), ('odd', 4, 3)) t(name, vocab_size, eos_id)")
def tokenizer_vocab(spark, sf_dir):
    return tokens.vocabulary(spark.createDataFrame(TOKENIZERS, "name string, vocab map<string,int>, added array<struct<id:int,content:string>>"))


_DRAW = "CAST('0x' || substr(sha256(seed || ':' || CAST(i AS VARCHAR)), 1, 16) AS UBIGINT) % CAST(bytes - 1024 + 1 AS UBIGINT)"


@query(f"""WITH {R.ENTRIES}, s AS (SELECT path, bytes, substr(sha256(sha256('text/corpus|v1|' || grp) || ':' || path), 1, 16) AS seed FROM entries), d AS (SELECT path, bytes, {_DRAW} AS place FROM s, range(4) t(i) WHERE bytes > 1024),
p AS (SELECT DISTINCT path, CAST(place - place % 4 AS BIGINT) AS first FROM d) SELECT path, string_agg(CAST(first AS VARCHAR), ',' ORDER BY first) AS offsets FROM p GROUP BY path UNION ALL SELECT path, '0' FROM s WHERE bytes <= 1024""")
def sample_offsets(spark, sf_dir):
    """Four windows of 1 KiB over each shard, seeded by its path."""
    e = R.entries(spark, sf_dir)
    found = keys.sample_offsets(F.col("bytes"), 1024, 4, keys.shard_seed(keys.group_seed(F.lit("text/corpus"), F.lit("v1"), F.col("grp")), F.col("path")), align=4)
    return e.select("path", F.array_join(found.cast("array<string>"), ",").alias("offsets"))


# --- names, versions, lineage ---

IDS = ["pretrain/corpus2-150b", "pretrain/mix-1124-30b", "eval/gsm-4hop", "pretrain/mix-jul22", "pretrain/mix-2026", "pretrain/a-20260728", "sft/final-v2", "sft/chat-v2", "eval/results-set", "probe/big-probe", "curriculum/experiment-3", "vendor/corpus2_150B", "pretrain/one", "pretrain/a-b-c-d-e-f", "other/x-y", "noslash", "a/b/c", "", "tokenizer/mix-october", "sft/decoder-5b5"]
PURPOSES = ["TODO", "To-Do!", "see README", "short one", "Held-out passages for the reader to compare splits", "x" * 40, "word " * 80, "  training   data ", None, "The dataset"]


def _verdict_sql(word: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({word}, '{p}') THEN '{k}'" for k, p in _RE2_RULES) + " END"


_RE2_RULES = [(k, p.replace("(?<![0-9])", "(^|[^0-9])").replace("(?![0-9])", "($|[^0-9])")) for k, p in names.WORD_RULES]
_KINDS = ", ".join(f"'{f}'" for f in names.FAMILIES)


@query(f"""WITH {sql_values('v', 'dataset_id', [(i,) for i in IDS])}, n AS (SELECT DISTINCT 'vendor/' || lower(replace(p_name, ' ', '-')) AS dataset_id FROM part), a AS (SELECT * FROM v UNION ALL SELECT * FROM n),
b AS (SELECT dataset_id, string_split(dataset_id, '/') AS p, string_split(string_split(dataset_id, '/')[2], '-') AS w FROM a)
SELECT dataset_id, CASE WHEN dataset_id = '' THEN 'empty' WHEN len(p) <> 2 THEN 'shape' WHEN p[1] NOT IN ({_KINDS}) THEN 'family' WHEN NOT regexp_matches(p[2], '^[a-z0-9]+(-[a-z0-9]+)*$') THEN 'not-kebab-case' WHEN len(w) NOT BETWEEN 2 AND 5 THEN 'word-count'
ELSE list_filter(list_transform(w, lambda x: {_verdict_sql('x')}), lambda v: v IS NOT NULL)[1] END AS problem FROM b""")
def name_rules(spark, sf_dir):
    """Ids that keep or break each rule, and the parts' names as ids."""
    own = R.table(spark, sf_dir, "part").select(F.concat(F.lit("vendor/"), F.lower(F.replace("p_name", F.lit(" "), F.lit("-")))).alias("dataset_id")).distinct()
    both = spark.createDataFrame([(i,) for i in IDS], "dataset_id string").unionByName(own)
    return both.select("dataset_id", names.id_problem(F.col("dataset_id")).alias("problem"))


_BANNED = "'', 'todo', 'tbd', 'data', 'trainingdata', 'thedataset', 'dataset', 'experiments', 'seereadme', 'datafromtherun', 'corpusfortheproject'"


@query(f"""WITH {sql_values('v', 'purpose', [(p,) for p in PURPOSES])}, a AS (SELECT * FROM v UNION ALL SELECT text FROM benchmark), s AS (SELECT purpose, regexp_replace(regexp_replace(purpose, '^{names.SPACE}+', ''), '{names.SPACE}+$', '') AS t FROM a)
SELECT purpose, CASE WHEN purpose IS NULL THEN 'not-text' WHEN regexp_replace(lower(t), '[^a-z0-9]+', '', 'g') IN ({_BANNED}) THEN 'placeholder' WHEN length(t) < 20 THEN 'short' WHEN length(t) > 300 THEN 'long' WHEN NOT contains(t, ' ') THEN 'one-word' END AS problem FROM s""")
def purpose_rules(spark, sf_dir):
    both = spark.createDataFrame([(p,) for p in PURPOSES], "purpose string").unionByName(R.table(spark, sf_dir, "benchmark").select(F.col("text").alias("purpose")))
    return both.select("purpose", names.purpose_problem(F.col("purpose")).alias("problem"))


@query("SELECT 'supplier/' || CAST(s_nationkey AS VARCHAR) AS dataset_id, 'v' || CAST(max(s_suppkey + 1) AS VARCHAR) AS latest FROM supplier GROUP BY s_nationkey")
def latest_version(spark, sf_dir):
    """Suppliers as versions of their nation's dataset: by number, so v10 is after v9."""
    catalog = R.table(spark, sf_dir, "supplier").select(F.concat(F.lit("supplier/"), F.col("s_nationkey").cast("string")).alias("dataset_id"), F.concat(F.lit("v"), (F.col("s_suppkey") + 1).cast("string")).alias("version"))
    return manifest.latest_versions(catalog)


@query("WITH p AS (SELECT o_custkey, count(*) AS orders, count(DISTINCT o_orderpriority) AS priorities, max(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS judged FROM orders GROUP BY 1) SELECT 'c/' || CAST(o_custkey AS VARCHAR) AS prefix, CAST(2 AS INTEGER) AS needs FROM p WHERE judged = 0 AND priorities >= 2")
def pending_worklist(spark, sf_dir):
    """Customers as prefixes; each order is a group's manifest (by priority), a finished one a verdict."""
    o = R.table(spark, sf_dir, "orders").select(F.concat(F.lit("c/"), F.col("o_custkey").cast("string")).alias("prefix"), "o_orderstatus", F.col("o_orderpriority").alias("grp"))
    none = F.lit(None)
    objects = o.select("prefix", F.lit("manifest.json").alias("name"), "grp", none.cast("int").alias("needs"))
    objects = objects.unionByName(o.select("prefix", F.lit("dataset.json").alias("name"), none.cast("string").alias("grp"), F.lit(2).alias("needs")))
    objects = objects.unionByName(o.filter("o_orderstatus = 'F'").select("prefix", F.lit("_VALIDATED.json").alias("name"), none.cast("string").alias("grp"), none.cast("int").alias("needs")))
    return manifest.pending(objects)


@query("SELECT CAST(o_orderkey AS VARCHAR) AS child, 'c/' || CAST(o_custkey AS VARCHAR) AS parent_id, 'v' || CAST(o_custkey % 3 + 1 AS VARCHAR) AS parent_version, CASE WHEN c_custkey IS NULL OR o_custkey % 3 > 0 THEN 'dangling-parent' WHEN o_orderpriority = '5-LOW' THEN 'parent-manifest-pin-missing' WHEN o_orderpriority <> c_mktsegment THEN 'parent-manifest-pin-mismatch' ELSE 'ok' END AS status FROM orders LEFT JOIN customer ON c_custkey = o_custkey")
def parent_pin_status(spark, sf_dir):
    """Orders depend on versions of their customers, of which only v1 was published, and pin their priority."""
    o = R.table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("child"), F.concat(F.lit("c/"), F.col("o_custkey").cast("string")).alias("parent_id"), F.concat(F.lit("v"), (F.col("o_custkey") % 3 + 1).cast("string")).alias("parent_version"), F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("pin"))
    c = R.table(spark, sf_dir, "customer").select(F.concat(F.lit("c/"), F.col("c_custkey").cast("string")).alias("parent_id"), F.lit("v1").alias("parent_version"), F.array("c_mktsegment").alias("hashes"))
    return lineage.pin_status(o, c)


@query("WITH o AS (SELECT CAST(doc_id AS VARCHAR) AS path, sha256(text) AS observed FROM documents), s AS (SELECT CAST(doc_id AS VARCHAR) AS path, sha256(replace(text, chr(10), ' ')) AS sealed FROM documents) SELECT path, sealed, observed FROM s JOIN o USING (path) WHERE sealed <> observed")
def seal_checksum_compare(spark, sf_dir):
    """Sealed before the texts were broken into lines."""
    docs = R.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), "text")
    return lineage.checksum_differences(docs.select("path", F.sha2(F.replace("text", F.lit("\n"), F.lit(" ")), 256).alias("crc")), docs.select("path", F.sha2("text", 256).alias("crc")))


@query("WITH listed AS (SELECT DISTINCT l_orderkey AS k, 1 AS bytes FROM lineitem), stored AS (SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'O' THEN 2 ELSE 1 END AS length FROM orders WHERE o_orderpriority <> '1-URGENT') SELECT CASE WHEN length IS NULL THEN 'object-gone' ELSE 'object-resized' END AS code, CAST(k AS VARCHAR) AS path FROM listed LEFT JOIN stored USING (k) WHERE length IS NULL OR length <> bytes")
def published_presence(spark, sf_dir):
    """Orders with items are published; urgent ones are gone, open ones grew."""
    listed = R.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("path")).distinct().withColumn("bytes", F.lit(1))
    stored = R.table(spark, sf_dir, "orders").filter("o_orderpriority <> '1-URGENT'").select(F.col("o_orderkey").cast("string").alias("path"), F.when(F.col("o_orderstatus") == "O", 2).otherwise(1).alias("length"))
    return lineage.presence(listed, stored)


DEPENDENCIES = [("tokenizer", None), (None, "tokenizer/bpe-32k"), (None, "vendor/open-tokenizer"), (None, "vendor/open-corpus"), ("parent", "pretrain/tokenizer-mix"), (None, None), ("", "tokenizers/x")]


@query(f"WITH {sql_values('v', 'role, parent', DEPENDENCIES)}, a AS (SELECT role, parent FROM v UNION ALL SELECT DISTINCT CASE WHEN c_mktsegment = 'BUILDING' THEN 'tokenizer' END, 'vendor/' || lower(c_mktsegment) || CASE WHEN c_nationkey % 2 = 0 THEN '-tokenizer' ELSE '' END FROM customer) SELECT role, parent, coalesce(role = 'tokenizer', false) OR coalesce(starts_with(parent, 'tokenizer/'), false) OR coalesce(starts_with(parent, 'vendor/') AND contains(parent, 'tokenizer'), false) AS tokenizer FROM a")
def tokenizer_dependency(spark, sf_dir):
    """Dependencies by role or parent, the customers' segments among them."""
    own = R.table(spark, sf_dir, "customer").select(F.when(F.col("c_mktsegment") == "BUILDING", "tokenizer").alias("role"), F.concat(F.lit("vendor/"), F.lower("c_mktsegment"), F.when(F.col("c_nationkey") % 2 == 0, "-tokenizer").otherwise("")).alias("parent")).distinct()
    both = spark.createDataFrame(DEPENDENCIES, "role string, parent string").unionByName(own)
    return both.select("role", "parent", names.is_tokenizer_dependency(F.col("role"), F.col("parent")).alias("tokenizer"))


VERSIONS = [("v1", "supersedes", None), ("v1", "supersedes", "v0"), ("v2", "extends", "v1"), ("v2", "sibling", "v2"), ("v2", "forks", "v1"), ("v3", None, "v2"), ("v02", "extends", "v1"), ("2", "extends", "v1"), (None, "extends", "v1"), ("v2", "extends", None), ("v2", "extends", "1"), ("v10", "supersedes", "v9"), ("v2\n", "extends", "v1")]


@query(f"""WITH {sql_values('v', 'version, relation, parent', VERSIONS)}, a AS (SELECT version, relation, parent FROM v UNION ALL SELECT 'v' || CAST(o_orderkey AS VARCHAR), CASE WHEN o_orderstatus = 'F' THEN 'supersedes' WHEN o_orderstatus = 'O' THEN 'extends' ELSE 'other' END, 'v' || CAST(o_custkey AS VARCHAR) FROM orders)
SELECT version, relation, parent, CASE WHEN version IS NULL OR NOT regexp_matches(version, '^v[1-9][0-9]*$') THEN 'version' WHEN relation IS NULL OR relation NOT IN ('supersedes', 'extends', 'sibling') THEN 'relation' WHEN version = 'v1' AND parent IS NOT NULL THEN 'first-with-parent' WHEN version <> 'v1' AND (parent IS NULL OR NOT regexp_matches(parent, '^v[1-9][0-9]*$')) THEN 'parent' WHEN version = parent THEN 'own-parent' END AS problem,
CASE WHEN regexp_matches(version, '^v[1-9][0-9]*$') AND version <> 'v1' THEN 'v' || CAST(CAST(substr(version, 2) AS BIGINT) - 1 AS VARCHAR) END AS previous FROM a""")
def version_rules(spark, sf_dir):
    """Version blocks that keep or break each rule, the orders as versions of their customers, and the version before."""
    status = F.col("o_orderstatus")
    own = R.table(spark, sf_dir, "orders").select(F.concat(F.lit("v"), F.col("o_orderkey").cast("string")).alias("version"), F.when(status == "F", "supersedes").when(status == "O", "extends").otherwise("other").alias("relation"), F.concat(F.lit("v"), F.col("o_custkey").cast("string")).alias("parent"))
    both = spark.createDataFrame(VERSIONS, "version string, relation string, parent string").unionByName(own)
    return both.select("version", "relation", "parent", names.version_problem(F.col("version"), F.col("relation"), F.col("parent")).alias("problem"), names.previous_version(F.col("version")).alias("previous"))
