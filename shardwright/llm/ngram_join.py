"""Similarity join of texts on the Jaccard similarity of their word n-gram sets, by MinHash banding.

Band and row counts are chosen for a target recall at the threshold (`choose_bands`).  The steps:

1. Every text gets a key (digest of its lower-cased words), a MinHash signature and its band hashes.
   Texts of the same key are copies: one class, which goes on as one node.
2. Nodes are shuffled on band hashes; each node of a shared bucket is tied to the bucket's least node,
   and the components of these ties hold every candidate pair.
3. Each component's texts go to one task, or, if they are many, in blocks whose pairs go to tasks of
   their own.  There every pair is verified on its full n-gram sets, by products of incidence matrices;
   only counts of links and a spanning star of each linked set leave the task, never the pairs.
4. Components of the verified links are the groups of near duplicates.

Cases: words are runs of anything but ASCII white space, A-Z lower-cased.  A text of fewer than n
words has one n-gram, all of its words; one without words (or null) has none and is linked to nothing,
its class its own id.  Repeated rows are copies of each other.  A null id is carried along; a class is
named by its least id.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, discard, free_names, materialise
from .components import components

#: Most n-grams, and most texts, of a block in verification.
BLOCK_GRAMS, BLOCK_TEXTS = 1_500_000, 1024
#: Most rows of a table that may be broadcast (about 64 bytes a row).
BROADCAST_ROWS = 250_000
COLUMNS = 4096


def choose_bands(threshold: float, recall: float, most: int = 256) -> tuple[int, int]:
    """(bands, rows): the most rows a band, for fewest chance candidates, that reach the recall at the threshold within `most` hashes."""
    for rows in range(most, 0, -1):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows))) if threshold < 1 else 1
        if bands * rows <= most:
            return bands, rows
    raise ValueError("no bands within this many hashes reach the recall")


class WordHashes(dict):
    """Hashes of words, as many as a small share of a worker's memory holds."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 250_000:
            self.clear()
        self[word] = out = xxhash.xxh3_64_intdigest(word)
        return out


def gram_set(words: list[bytes], n: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams of words."""
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = min(n, len(w))
    h = np.zeros(len(w) - n + 1, np.uint64)
    for k in range(n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + w[k : len(w) - n + 1 + k]
        h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return np.unique(h)


def hash_family(k: int, seed: int = 13) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 32, k, np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, k, np.uint32)


def signature(grams: np.ndarray, family, chunk: int = 2048) -> np.ndarray:
    a, b = family
    x = grams.astype(np.uint32)
    least = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), chunk):
        h = np.multiply.outer(a, x[at : at + chunk])
        h += b[:, None]
        np.minimum(least, h.min(axis=1), out=least)
    return least


def band_hashes(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    s = sig.reshape(bands, rows).astype(np.uint64)
    h = np.arange(1, bands + 1, dtype=np.uint64)
    for r in range(rows):
        h = (h ^ s[:, r]) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return h.view(np.int64)


def sketch(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """doc_id, xh (hash of the exact text), tkey, grams (their number), bands."""

    def run(batches):
        hashes, family = WordHashes(), hash_family(bands * rows)
        for batch in batches:
            keys, sizes, found = [], [], []
            for text in as_bytes(batch.column("text")):
                words = text.lower().split()
                grams = gram_set(words, n, hashes)
                keys.append(hashlib.md5(b" ".join(words)).digest())
                sizes.append(len(grams))
                found.append(band_hashes(signature(grams, family), bands, rows) if len(grams) else np.zeros(0, np.int64))
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("xh"), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.zeros(0, np.int64), *found]))),
            ], names=["doc_id", "xh", "tkey", "grams", "bands"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("xh"), "text")
    return source.mapInArrow(run, "doc_id long, xh long, tkey binary, grams long, bands array<long>")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set on the left with every set on the right."""
    same = left is right
    out = np.zeros((len(left), len(right)), np.float32)
    stacked = np.concatenate([*left, *([] if same else right)])
    _, number, times = np.unique(stacked, return_inverse=True, return_counts=True)
    shared = times > 1
    column = np.cumsum(shared) - 1
    number, keep = column[number], shared[number]
    row = np.repeat(np.arange(len(left) + (0 if same else len(right))), [len(s) for s in [*left, *([] if same else right)]])
    number, row = number[keep], row[keep]
    order = np.argsort(number, kind="stable")
    number, row = number[order], row[order]
    width = int(shared.sum())
    for at in range(0, width, COLUMNS):
        lo, hi = np.searchsorted(number, [at, at + COLUMNS])
        x = np.zeros((len(left) + (0 if same else len(right)), min(COLUMNS, width - at)), np.float32)
        x[row[lo:hi], number[lo:hi] - at] = 1
        out += x @ x.T if same else x[: len(left)] @ x[len(left) :].T
    return out


def linked(left: list[np.ndarray], right: list[np.ndarray], threshold: float) -> np.ndarray:
    common = overlaps(left, right).astype(np.float64)
    size = lambda s: np.array([len(x) for x in s], np.float64)
    return common >= threshold * (size(left)[:, None] + size(right)[None, :] - common) - 1e-9


def local_roots(links: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """links: symmetric.  The least node of each node's component."""
    roots = np.full(len(nodes), -1, np.int64)
    for i in np.argsort(nodes):
        if roots[i] < 0:
            reached = np.zeros(len(nodes), bool)
            front = reached.copy()
            front[i] = True
            while front.any():
                reached |= front
                front = links[front].any(axis=0) & ~reached
            roots[reached] = nodes[i]
    return roots


def verify(table: pa.Table, n: int, threshold: float) -> pa.Table:
    """One block, or pair of blocks, of a component, or several whole small components."""
    hashes, by_root = WordHashes(), {}
    within = table.num_rows == 0 or table.column("low")[0].as_py() == table.column("high")[0].as_py()
    for row in zip(*(table.column(c).to_pylist() for c in ("root", "node", "block", "copies")), as_bytes(table.column("text").combine_chunks()), strict=True):
        root, node, block, copies, text = row
        by_root.setdefault(root, {}).setdefault(node, (block, copies, text))
    out: list[tuple] = []
    for members in by_root.values():
        nodes = np.array(list(members), np.int64)
        blocks = np.array([b for b, *_ in members.values()])
        copies = np.array([c for _, c, _ in members.values()], np.int64)
        sets = [gram_set(t.lower().split(), n, hashes) for *_, t in members.values()]
        if within:
            links = linked(sets, sets, threshold)
            np.fill_diagonal(links, False)
        else:  # links across two blocks; those within are counted where a block meets itself
            first = blocks.min()
            a, b = np.flatnonzero(blocks == first), np.flatnonzero(blocks != first)
            links = np.zeros((len(nodes), len(nodes)), bool)
            if len(a) and len(b):
                links[np.ix_(a, b)] = linked([sets[i] for i in a], [sets[i] for i in b], threshold)
                links |= links.T
        degree = links @ copies
        out += zip(nodes.tolist(), degree.tolist(), local_roots(links, nodes).tolist(), strict=True)
    columns = zip(*out, strict=True) if out else ((), (), ())
    return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("node", "links", "top"), columns, strict=True)})


def classes(docs: DataFrame, n: int, threshold: float, recall: float) -> tuple[DataFrame, DataFrame]:
    """(sketches, named): what `sketch` gives, and by tkey copy_id, class_id, n_links and root, the number of the class.  Texts without words have no row in named."""
    spark = docs.sparkSession
    bands, rows = choose_bands(threshold, recall)
    sketches = materialise(sketch(docs, n, bands, rows), "sketches")
    nodes = sketches.filter("grams > 0").groupBy("tkey").agg(
        F.min(F.struct("doc_id", "xh")).alias("first"), F.min("doc_id").alias("copy_id"), F.count("*").alias("copies"), F.first("grams").alias("grams"), F.first("bands").alias("bands")
    )
    nodes = materialise(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    rows_ = nodes.select("node", F.explode("bands").alias("h"))
    # Minima are written before they are joined: Spark can then split the rows of a bucket or group that holds very many.
    buckets = materialise(rows_.groupBy("h").agg(F.min("node").alias("m"), F.max("node").alias("x")).filter("m < x").select("h", "m"), "buckets")
    ties = rows_.join(buckets, "h").filter("node <> m").select(F.col("node").alias("u"), F.col("m").alias("v"))
    found = components(ties)
    discard(buckets)

    members = found.join(nodes.select("node", "first", "copies", "grams"), "node")
    sizes = members.groupBy("root").agg(F.sum("grams").alias("g"), F.count("*").alias("m"))
    blocks = F.greatest(F.ceil(F.col("g") / BLOCK_GRAMS), F.ceil(F.col("m") / BLOCK_TEXTS)).cast("int")
    sizes = materialise(sizes.select("root", blocks.alias("blocks")), "sizes")
    members = materialise(members.join(sizes, "root").select("node", "root", "blocks", "copies", "grams", "first.doc_id", "first.xh"), "members")
    total, count = members.agg(F.coalesce(F.sum("grams"), F.lit(0)), F.count("*")).first()
    tasks = max(1, math.ceil(total / BLOCK_GRAMS), spark.sparkContext.defaultParallelism)
    small = members.select("node", "root", "blocks", "copies", F.col("doc_id").alias("own"), "xh")
    small = F.broadcast(small) if count <= BROADCAST_ROWS else small
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("xh"), "text")
    texts = texts.join(small, (texts.xh == small.xh) & texts.doc_id.eqNullSafe(small.own)).select("node", "root", "blocks", "copies", "text")
    # Rows that repeat an id and its text meet one node; it goes on once.
    texts = texts.groupBy("node").agg(*(F.first(c).alias(c) for c in ("root", "blocks", "copies", "text")))
    texts = texts.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    alone = F.col("blocks") == 1
    texts = texts.select(
        "node", "root", "copies", "block", "text", F.when(alone, F.pmod(F.xxhash64("root"), F.lit(tasks))).otherwise(F.col("root")).alias("task"), alone.alias("alone"),
        F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
    )
    checked = texts.groupBy("task", "alone", "low", "high").applyInArrow(lambda t: verify(t, n, threshold), "node long, links long, top long")
    checked = materialise(checked, "verified")
    discard(sizes, members)
    degrees = checked.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(checked.filter("node <> top").select(F.col("node").alias("u"), F.col("top").alias("v")))

    named = nodes.select("node", "tkey", "copy_id", "copies").join(degrees, "node", "left").join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = materialise(named.select("root", "tkey", "copy_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "classes")
    discard(nodes, checked)
    names = materialise(named.groupBy("root").agg(F.min("copy_id").alias("class_id")), "names")
    return sketches, named.join(names, "root").select("tkey", "root", "copy_id", "class_id", "n_links")


def ngram_join(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.999) -> DataFrame:
    """One row a document: doc_id, copy_id (least id of its exact copies), class_id (least id of its group) and n_links (documents at or above the threshold)."""
    sketches, named = classes(docs, n, threshold, recall)
    empty = F.col("grams") == 0
    out = sketches.select("doc_id", "tkey", "grams").join(named, "tkey", "left")
    return out.select("doc_id", F.when(empty, F.col("doc_id")).otherwise(F.col("copy_id")).alias("copy_id"), F.when(empty, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def keep_one(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.999) -> DataFrame:
    """One document of each group, that of the least id (of texts under one id, that of the least hash).  Rows without id stay.

    A row is known by its id and its text, so other texts under the same id are judged by themselves; of rows that repeat both one stays.  Rows without words are in no group, and all stay.
    """
    sketches, named = classes(docs, n, threshold, recall)
    known = sketches.filter("doc_id is not null")
    rows = known.filter("grams > 0").groupBy("tkey", "doc_id", "xh").agg(F.count("*").alias("times")).join(named.select("tkey", "root"), "tkey")
    kept = rows.groupBy("root").agg(F.min(F.struct("doc_id", "xh", "times")).alias("f")).select("f.doc_id", "f.xh", "f.times")
    wordless = known.filter("grams = 0").select("doc_id", "xh", F.lit(1).cast("long").alias("times")).distinct()
    own, key, times, hashed = free_names(docs.columns, "own_id", "own_hash", "times", "text_hash")
    kept = materialise(kept.unionByName(wordless).toDF(own, key, times), "kept")
    source = docs.withColumn(hashed, F.xxhash64("text"))
    of = lambda kept: source.join(kept, (source[hashed] == kept[key]) & (source["doc_id"].cast("long") == kept[own]))
    out = of(kept.filter(F.col(times) == 1)).select(docs.columns).unionByName(docs.filter("doc_id is null"))
    repeated = kept.filter(F.col(times) > 1)
    return out if repeated.isEmpty() else out.unionByName(of(repeated).dropDuplicates([own, key]).select(docs.columns))
