"""Registered queries over files: tables are written as shards to a scratch folder, then read, described, published and checked there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys
from ..operators import tokens
from ..sources import files, ranges, shards
from ..sources.store import Store, scratch
from . import publish, read, sweep, validate
from . import relations as R
from .catalogue import query

# --- token shards ---

SHARD = "/train-00000.u32le.bin"
_FILES = f"{R.TOKEN_ROWS}, f AS (SELECT path || '{SHARD}' AS path, pos - 1 AS pos, id FROM tokens)"
_LITTLE_ENDIAN = "string_agg(printf('%02x%02x%02x%02x', id & 255, (id >> 8) & 255, (id >> 16) & 255, id >> 24), '' ORDER BY pos)"


def token_files(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The uri of a folder with a shard for each supplier."""
    root = scratch(spark, name)
    shards.write(R.token_items(spark, sf_dir).select(F.concat("path", F.lit(SHARD)).alias("path"), F.col("place").alias("pos"), shards.little_endian(F.col("id")).alias("part")), root)
    return root


@query(f"WITH {_FILES} SELECT path, count(*) * 4 AS length FROM f GROUP BY path")
def stored_objects(spark, sf_dir):
    return files.objects(spark, token_files(spark, sf_dir, "objects"))


@query(f"WITH {_FILES} SELECT path, count(*) * 4 AS length, sha256(unhex({_LITTLE_ENDIAN})) AS sha256 FROM f GROUP BY path")
def stored_digests(spark, sf_dir):
    return files.digests(spark, token_files(spark, sf_dir, "digests"))


@query(f"WITH {_FILES} SELECT path, pos, id FROM f")
def stored_tokens(spark, sf_dir):
    """Every shard decoded."""
    return files.token_ids(spark, token_files(spark, sf_dir, "tokens"))


_DRAW = "CAST('0x' || substr(sha256(seed || ':' || CAST(i AS VARCHAR)), 1, 16) AS UBIGINT) % CAST(bytes - 256 + 1 AS UBIGINT)"


@query(f"""WITH {_FILES}, s AS (SELECT path, count(*) * 4 AS bytes, substr(sha256(sha256('pretrain/items|v1|tokens') || ':' || path), 1, 16) AS seed FROM f GROUP BY path),
d AS (SELECT path, {_DRAW} AS place FROM s, range(4) t(i) WHERE bytes > 256), w AS (SELECT DISTINCT path, CAST((place - place % 4) // 4 AS BIGINT) AS first FROM d UNION ALL SELECT path, 0 FROM s WHERE bytes <= 256)
SELECT path, pos, id FROM f JOIN w USING (path) WHERE pos >= first AND pos < first + 64""")
def token_sample(spark, sf_dir):
    """Four seeded windows of 256 bytes of each shard, read by range; windows may overlap."""
    root = token_files(spark, sf_dir, "sample")
    return files.sampled_ids(spark, root, keys.group_seed(F.lit("pretrain/items"), F.lit("v1"), F.lit("tokens")), window=256)


@query("SELECT 'size/' || CAST(p_size AS VARCHAR) || '/train-00000.u32le.bin' AS path, count(*) AS indices, CAST(0 AS BIGINT) AS out_of_range, count(DISTINCT p_partkey // 2) AS distinct_ids, count(*) - count(DISTINCT p_partkey // 2) AS repeated, CASE WHEN count(*) > count(DISTINCT p_partkey // 2) THEN 2 ELSE 1 END AS worst, (SELECT count(*) FROM part) - count(DISTINCT p_partkey // 2) AS missing, CASE WHEN count(*) > count(DISTINCT p_partkey // 2) THEN 'subset-not-unique' ELSE 'ok' END AS verdict FROM part GROUP BY p_size HAVING count(*) <= 40")
def order_vectors(spark, sf_dir):
    """Order vectors of the parts of a size, halved; vectors above 160 bytes are left out unread."""
    part, root = R.table(spark, sf_dir, "part"), scratch(spark, "orders")
    path = F.concat(F.lit("size/"), F.col("p_size").cast("string"), F.lit("/train-00000.u32le.bin"))
    shards.write(part.select(path.alias("path"), F.col("p_partkey").alias("pos"), shards.little_endian(F.floor(F.col("p_partkey") / 2)).alias("part")), root)
    return tokens.order_domains(files.token_ids(spark, root, most_bytes=160), part.count(), "subset")


@query("SELECT DISTINCT 'tokens/' || CAST(l_suppkey AS VARCHAR) || '/train-00000.u32le.bin' AS path FROM lineitem WHERE l_suppkey % 5 = 0")
def numpy_headers(spark, sf_dir):
    """Every fifth shard starts as a NumPy file does."""
    items, root = R.token_rows(spark, sf_dir), scratch(spark, "numpy")
    path = F.concat("path", F.lit(SHARD)).alias("path")
    fifth = items.select("path").distinct().filter(F.element_at(F.split("path", "/"), -1).cast("long") % 5 == 0)
    parts = items.select(path, "pos", shards.little_endian(F.col("id")).alias("part")).unionByName(fifth.select(path, F.lit(0).alias("pos"), F.unhex(F.lit("934E554D5059")).alias("part")))
    shards.write(parts, root)
    return files.npy_files(spark, root)


# --- lines ---

#: What stands in place of a row, by the last digit of its id.
BROKEN, LIST, NO_TEXT, NUMBER, BLANK = '{"text": ', '["a"]', '{"text":null}', '{"text":7}', "   "


def line_files(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The uri of a folder with the documents as shards of JSON lines, some of them faulty."""
    root, digit = scratch(spark, name), F.col("row_idx") % 10
    good = F.to_json(F.struct("text"))
    text = F.when(digit == 3, BROKEN).when(digit == 4, LIST).when(digit == 5, NO_TEXT).when(digit == 6, NUMBER).when(digit == 7, BLANK).otherwise(good)
    shards.write(R.document_rows(spark, sf_dir).select("path", F.col("row_idx").alias("pos"), shards.line(text).alias("part")), root)
    return root


@query(f"WITH {R.DOCUMENT_ROWS}, k AS (SELECT path, text, row_idx % 10 AS d FROM rows_) SELECT path, count(*) FILTER (WHERE d NOT IN (3, 4, 7)) AS good, count(*) FILTER (WHERE d IN (3, 4)) AS bad, count(text) FILTER (WHERE d NOT IN (3, 4, 5, 7)) AS with_text, CAST(coalesce(sum(length(text)) FILTER (WHERE d NOT BETWEEN 3 AND 7), 0) AS BIGINT) AS chars, count(DISTINCT text) FILTER (WHERE d NOT BETWEEN 3 AND 7) AS texts FROM k GROUP BY path HAVING count(*) FILTER (WHERE d <> 7) > 0")
def json_lines(spark, sf_dir):
    """Rows by shard: readable, faulty, with a text; blank lines are no rows."""
    found = files.json_rows(spark, line_files(spark, sf_dir, "lines"), columns=("path", "text", "has_text", "error"))
    out = found.groupBy("path").agg(
        F.count_if(F.col("error").isNull()).alias("good"), F.count_if(F.col("error").isNotNull()).alias("bad"), F.count_if("has_text").alias("with_text"),
        F.coalesce(F.sum(F.char_length("text")), F.lit(0)).alias("chars"), F.count_distinct("text").alias("texts"),
    )
    return out


@query(f"WITH {R.DOCUMENT_ROWS}, n AS (SELECT path, row_idx, row_number() OVER (PARTITION BY path ORDER BY row_idx) AS number FROM rows_) SELECT path, number FROM n WHERE row_idx % 10 = 3")
def faulty_line_numbers(spark, sf_dir):
    """Where the lines that aren't JSON stand, from 1."""
    root = line_files(spark, sf_dir, "numbers")
    found = ranges.numbered_lines(spark, root, files.RECORD_BYTES)
    return found.filter(F.col("line") == F.lit(BROKEN.encode())).select(files.relative(F.col("uri"), root).alias("path"), "number")


@query(f"WITH {R.EVALUATIONS}, e AS (SELECT CAST(substr(shard, 6) AS BIGINT) AS u, status, metric FROM evals) SELECT 'eval-' || CAST(u AS VARCHAR) || CASE WHEN u % 3 = 0 THEN '.jsonl' ELSE '.csv' END AS shard, status, CASE WHEN u % 3 = 0 THEN '\"' || metric || '\"' ELSE metric END AS metric, count(*) AS n FROM e GROUP BY ALL")
def eval_files(spark, sf_dir):
    """Evaluation rows of a user as JSON lines or as CSV, whose columns come in either order."""
    root = scratch(spark, "evals")
    user = F.substring_index("shard", "-", -1).cast("long")
    e = R.evaluations(spark, sf_dir).select("shard", "status", F.col("metric").alias("score"), user.alias("u"))
    rows = e.filter("u % 3 = 0").select(F.concat("shard", F.lit(".jsonl")).alias("path"), F.lit(1).alias("pos"), shards.line(F.to_json(F.struct("status", "score"))).alias("part"))
    tables = e.filter("u % 3 <> 0").select(F.concat("shard", F.lit(".csv")).alias("path"), "status", "score", (F.col("u") % 2 == 0).alias("even"))
    either = lambda a, b: F.when(F.col("even"), F.concat_ws(",", a, b)).otherwise(F.concat_ws(",", b, a))
    heads = tables.select("path", "even").distinct().select("path", F.lit(0).alias("pos"), shards.line(either(F.lit("status"), F.lit("score"))).alias("part"))
    shards.write(rows.unionByName(heads).unionByName(tables.select("path", F.lit(1).alias("pos"), shards.line(either(F.col("status"), F.col("score"))).alias("part"))), root)
    return files.eval_rows(spark, root).groupBy("shard", "status", "metric").agg(F.count("*").alias("n"))


# --- a dataset's life ---

DATASET, PURPOSE = "probe/document-texts", "Texts of the documents table as shards by source and length"
_CORPUS = f"{R.DOCUMENT_ROWS}, c AS (SELECT 'corpus/' || source || '/' || domain || '/' || list_last(string_split(path, '/')) AS path, source, domain, split, row_idx FROM rows_), e AS (SELECT path, source, domain, split, count(*) AS count_value FROM c GROUP BY ALL)"


def landed(spark: SparkSession, sf_dir: str) -> tuple[Store, Store, str]:
    """Landing and data store, and the version landed: every document with its id, so that no text repeats."""
    source, landing, data = (Store(spark, scratch(spark, n)) for n in ("source", "landing", "data"))
    rows = R.document_rows(spark, sf_dir)
    path = F.concat_ws("/", F.lit("corpus"), "source", "domain", F.element_at(F.split("path", "/"), -1))
    text = F.to_json(F.struct(F.concat(F.col("row_idx").cast("string"), F.lit(" "), F.coalesce("text", F.lit(""))).alias("text")))
    shards.write(rows.select(path.alias("path"), F.col("row_idx").alias("pos"), shards.line(text).alias("part")), source.root)
    plan = publish.build(spark, source.root, DATASET, PURPOSE, {"corpus": "text-corpus/v1"}, corpus_fields={"record_schema": {"text": "string"}})
    return landing, data, publish.publish(plan, source, landing, data)


def promoted(spark: SparkSession, sf_dir: str) -> tuple[Store, str]:
    """Data store with a validated, sealed version."""
    landing, data, version = landed(spark, sf_dir)
    publish.promote(validate.validate(landing, f"{DATASET}/{version}", data), landing, data, "now")
    return data, version


@query(f"WITH {_CORPUS} SELECT path, count_value, source, domain FROM e WHERE split = 'train'")
def published_training_files(spark, sf_dir):
    """Described, published, validated, promoted, sealed; then what a reader may train on."""
    data, _ = promoted(spark, sf_dir)
    return read.resolve(data, DATASET).entries.select("path", "count_value", "source", "domain")


@query(f"""WITH RECURSIVE {_CORPUS}, o AS (SELECT source, path, count_value AS n, row_number() OVER (PARTITION BY source ORDER BY sha256('7|{DATASET}|v1|' || path)) AS k FROM e WHERE split = 'train' AND source IN ('src1', 'src2')),
g AS (SELECT source, least(trunc(CAST((SELECT sum(n) // 2 FROM o) AS DOUBLE) * 0.5), sum(n)) AS target FROM o GROUP BY source),
f AS (SELECT source, CAST(0 AS BIGINT) AS k, CAST(0 AS DOUBLE) AS got, CAST(NULL AS VARCHAR) AS path, false AS took FROM g UNION ALL
  SELECT f.source, o.k, f.got + CASE WHEN f.got < target THEN o.n ELSE 0 END, o.path, f.got < target FROM f JOIN g USING (source) JOIN o ON o.source = f.source AND o.k = f.k + 1) SELECT path FROM f WHERE took""")
def published_mixture(spark, sf_dir):
    """Half of what two sources hold, in equal parts, from the published version."""
    data, version = promoted(spark, sf_dir)
    two = read.resolve(data, DATASET).entries.filter(F.col("source").isin("src1", "src2")).agg(F.sum("count_value")).first()[0]
    ask = [{"labels": {"source": s}, "ratio": 0.5} for s in ("src1", "src2")]
    found = read.build_mixture(data, DATASET, version, ask, two // 2, 7)
    at = f"{data.uri(f'{DATASET}/{version}')}/"
    return spark.createDataFrame([(p.removeprefix(at),) for p in found.paths], "path string")


def findings(spark: SparkSession, found: list[tuple]) -> DataFrame:
    return spark.createDataFrame(found, "code string, path string")


@query(f"""WITH {_CORPUS}, gone AS (SELECT path FROM e WHERE path LIKE '%/short/train-00001.jsonl')
SELECT code, path FROM gone, (VALUES ('missing-object'), ('empty-shard')) t(code) UNION ALL SELECT 'unlisted-object', 'corpus/extra/train-00000.jsonl' UNION ALL SELECT 'unlisted-object-dataset-level', 'stray/train-00000.jsonl'""")
def validation_findings(spark, sf_dir):
    """A landed version from which shards were taken, and to which two were added."""
    landing, data, version = landed(spark, sf_dir)
    at = f"{DATASET}/{version}"
    for name in landing.names(at):
        if name.endswith("/short/train-00001.jsonl"):
            landing.delete(name)
    for extra in ("corpus/extra/train-00000.jsonl", "stray/train-00000.jsonl"):
        landing.put(f"{at}/{extra}", b'{"text":"more"}\n')
    return findings(spark, [(c, p) for c, p, _ in validate.validate(landing, at, data).violations])


@query(f"""WITH {_CORPUS} SELECT 'object-gone' AS code, path FROM e WHERE path LIKE '%/short/train-00001.jsonl' UNION ALL
SELECT code, path FROM e, (VALUES ('object-resized'), ('object-content-changed')) t(code) WHERE path LIKE '%/short/val-%'""")
def sweep_findings(spark, sf_dir):
    """A published version from which shards are gone or replaced by others, by size and by digest."""
    data, version = promoted(spark, sf_dir)
    for name in data.names(f"{DATASET}/{version}"):
        if name.endswith("/short/train-00001.jsonl"):
            data.delete(name)
        elif "/short/val-" in name:
            data.put(name, b"{}\n", replace=True)
    return findings(spark, [(c, p) for c, _, _, p in sweep.sweep(data, contents=True).findings])
