"""Exact top-k search by inner product over a bit-sliced index.

A block of rows holds each quantised attribute as bit slices: bitmap j of an attribute has bit r set
if row r's value has bit j set.  A query adds the slices with its own integer weights by carry-save
adders (bitmap AND, OR and XOR only), which gives the slices of the score.  The selection then walks
from the most significant slice downward, keeps the rows that are surely in and narrows the rows that
tie so far; rows that tie in every slice are the boundary, resolved exactly by id.

Cases: a vector that is null, or holds a null or non-finite component, takes no part, nor does a row
without id.  Vectors of different lengths aren't compared; empty ones score 0 with each other.
Repeated rows are candidates one by one, except that a query never meets rows of its own id; a query
id that repeats is asked once, with its smallest vector.  Sums are exact and so are ranks, however
large; a score beyond a long's range is shown as the nearest long.  Quantised components beyond 2**55
raise an error.  Other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise

LARGEST = float(1 << 55)
LONG = (1 << 63) - 1
#: Scores leave a task as two longs, high * 2**HALF + low.
HALF = 62


def quantise(x: np.ndarray, scale: float) -> np.ndarray:
    q = np.floor(scale * x)
    if q.size and np.abs(q).max() > LARGEST:
        raise OverflowError(f"a quantised component is beyond {LARGEST:.0f}")
    return q.astype(np.int64)


def pack_block(ids: np.ndarray, q: np.ndarray) -> dict:
    """Bit slices of the rows of q in order of ids.  Values count from each attribute's least."""
    order = np.argsort(ids, kind="stable")
    ids, q = ids[order], q[order]
    n, dim = q.shape
    least = q.min(axis=0) if dim else np.zeros(0, np.int64)
    u = q - least
    bits = np.array([int(x).bit_length() for x in (u.max(axis=0) if dim else ())], np.int64)
    words = -(-n // 64)
    out = np.zeros((int(bits.sum()), words * 8), np.uint8)
    at = 0
    for d in range(dim):
        for j in range(bits[d]):
            row = np.packbits(((u[:, d] >> j) & 1).astype(np.uint8), bitorder="little")
            out[at, : len(row)] = row
            at += 1
    return {"n": n, "ids": ids, "least": least, "bits": bits, "slices": out.view(np.uint64)}


def add_slices(both: np.ndarray, columns: list[list[int]]) -> list[np.ndarray]:
    """Sum of bitmaps, columns[c] listing those of weight 2**c: full adders, three rows to two at a time."""
    words = both.shape[1]
    sums, carried = [], []
    c = 0
    while c < len(columns) or carried:
        rows = both[columns[c]] if c < len(columns) else np.zeros((0, words), np.uint64)
        if carried:
            rows = np.concatenate([rows, *carried])
        carried = []
        while len(rows) > 2:
            t = len(rows) // 3
            a, b, third = rows[:t], rows[t : 2 * t], rows[2 * t : 3 * t]
            half = a ^ b
            carried.append((a & b) | (half & third))
            rows = np.concatenate([half ^ third, rows[3 * t :]])
        if len(rows) == 2:
            carried.append((rows[0] & rows[1])[None])
            sums.append(rows[0] ^ rows[1])
        else:
            sums.append(rows[0] if len(rows) else np.zeros(words, np.uint64))
        c += 1
    return sums


def select_top(sums: list[np.ndarray], valid: np.ndarray, k: int) -> np.ndarray:
    """Numbers of the k rows of valid with the largest sums; ties go to the smaller row number."""
    sure, tied, n = np.zeros_like(valid), valid.copy(), 0
    for bitmap in reversed(sums):
        high = tied & bitmap
        more = int(np.bitwise_count(high).sum())
        if n + more > k:
            tied = high
            continue
        sure |= high
        n += more
        tied = tied & ~bitmap
        if n == k:
            break
    rows = lambda m: np.flatnonzero(np.unpackbits(m.view(np.uint8), bitorder="little"))
    return np.concatenate([rows(sure), rows(tied)[: k - n]])


def search_block(block: dict, query_ids, queries: np.ndarray, k: int):
    """(query id, id, score) of the k best rows of the block for each query."""
    slices, bits, n = block["slices"], block["bits"], block["n"]
    both = np.concatenate([slices, ~slices])
    starts = np.concatenate([[0], np.cumsum(bits)])
    full = np.zeros(slices.shape[1] * 64, np.uint8)
    full[:n] = 1
    every = np.packbits(full, bitorder="little").view(np.uint64)
    ids = block["ids"]
    for query_id, q in zip(query_ids, queries, strict=True):
        columns: list[list[int]] = []
        base = 0
        for d, w in enumerate(q.tolist()):
            base += w * int(block["least"][d])
            first = int(starts[d])
            if w < 0:  # -w * u = w' * (top - u) - w' * top: the complement's slices
                w = -w
                base -= w * ((1 << int(bits[d])) - 1)
                first += len(slices)
            b = 0
            while w >> b:
                if w >> b & 1:
                    for j in range(int(bits[d])):
                        while len(columns) <= b + j:
                            columns.append([])
                        columns[b + j].append(first + j)
                b += 1
        sums = add_slices(both, columns)
        valid = every.copy()
        for r in range(*np.searchsorted(ids, [query_id, query_id + 1]).tolist()):
            valid[r >> 6] &= ~(np.uint64(1) << np.uint64(r & 63))
        for r in select_top(sums, valid, k).tolist():
            score = base + sum((int(s[r >> 6]) >> (r & 63) & 1) << c for c, s in enumerate(sums))
            yield query_id, int(ids[r]), score


def top_k(
    df: DataFrame,
    queries,
    k: int = 5,
    scale: float = 256.0,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    block_rows: int = 8192,
    query_rows: int = 16384,
) -> DataFrame:
    """The k rows of highest score for each row where the condition `queries` (on the id) holds.

    Columns query_id, rank, vec_id, score.  The index is written once, in blocks of at most block_rows
    rows.  About query_rows queries at a time are shipped to its tasks; a task takes one block after the
    other, merges their best rows and hands on k rows a query, so neither the index nor the queries are
    multiplied and memory doesn't grow with the input.
    """
    vec = F.col(vec_col).cast("array<double>")
    odd = F.exists(vec, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = df.filter(
        F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & ~F.coalesce(odd, F.lit(False))
    ).select(F.col(id_col).cast("long").alias("id"), vec.alias("x"))

    def by_length(batch):
        lengths = batch.column("x").value_lengths().to_numpy(zero_copy_only=False)
        values = batch.column("x").flatten().to_numpy(zero_copy_only=False)
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.cumsum(lengths)]).astype(int)
        for dim in np.unique(lengths):
            at = np.flatnonzero(lengths == dim)
            take = (starts[at][:, None] + np.arange(dim)).astype(int)
            yield int(dim), ids[at], quantise(values[take], scale)

    def index(batches):
        held: dict[int, list] = {}

        def packed(dim, ids, q):
            b = pack_block(ids, q)
            return pa.RecordBatch.from_pydict({
                "dim": pa.array([dim], pa.int32()), "n": pa.array([b["n"]], pa.int32()), **{c: pa.array([b[c].tobytes()], pa.binary()) for c in ("ids", "least", "bits", "slices")},
            })

        def full(dim, least):
            """The blocks that dim's rows fill, if they are `least` at least."""
            ids, q = (np.concatenate(x) for x in zip(*held[dim], strict=True))
            whole = len(ids) - len(ids) % block_rows if least == block_rows else len(ids)
            held[dim] = [(ids[whole:], q[whole:])]
            for at in range(0, whole, block_rows):
                yield packed(dim, ids[at : min(at + block_rows, whole)], q[at : min(at + block_rows, whole)])

        for batch in batches:
            for dim, ids, q in by_length(batch):
                held.setdefault(dim, []).append((ids, q))
                if sum(len(i) for i, _ in held[dim]) >= block_rows:
                    yield from full(dim, block_rows)
        for dim in held:
            if sum(len(i) for i, _ in held[dim]):
                yield from full(dim, 1)

    def best(asked):
        """Searches the blocks of a task for the queries asked: (ids, vectors) by dimension."""

        def run(batches):
            top: dict[int, list] = {}
            for batch in batches:
                for b in batch.to_pylist():
                    ids, q = asked.value.get(b["dim"], ((), ()))
                    if not len(ids):
                        continue
                    block = {c: np.frombuffer(b[c], np.int64) for c in ("ids", "least", "bits")} | {"n": b["n"]}
                    block["slices"] = np.frombuffer(b["slices"], np.uint64).reshape(-1, -(-b["n"] // 64))
                    for query_id, found in itertools.groupby(search_block(block, ids.tolist(), q, k), key=lambda f: f[0]):
                        ours = top.get(query_id, []) + [(-score, i) for _, i, score in found]
                        top[query_id] = sorted(ours)[:k]
            out = [(query_id, i, -less >> HALF, -less & ((1 << HALF) - 1)) for query_id, found in top.items() for less, i in found]
            columns = zip(*out, strict=True) if out else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "high", "low"])

        return run

    blocks = max(1, math.ceil(rows.count() / block_rows))
    stored = materialise(rows.repartition(blocks).mapInArrow(index, "dim int, n int, ids binary, least binary, bits binary, slices binary"), "topk-index")
    asked = materialise(rows.filter(queries(F.col("id"))).groupBy("id").agg(F.min("x").alias("x")), "topk-queries")
    groups = max(1, math.ceil(asked.count() / query_rows))
    parts = []
    for g in range(groups):
        own = asked.filter(F.pmod(F.xxhash64("id"), F.lit(groups)) == g).toArrow().combine_chunks()
        by_dim: dict[int, list] = {}
        for batch in own.to_batches():
            for dim, ids, q in by_length(batch):
                by_dim.setdefault(dim, []).append((ids, q))
        shipped = df.sparkSession.sparkContext.broadcast({dim: tuple(np.concatenate(x) for x in zip(*v, strict=True)) for dim, v in by_dim.items()})
        found = stored.mapInArrow(best(shipped), "query_id long, vec_id long, high long, low long")
        parts.append(materialise(found, "topk-found") if groups > 1 else found)
    order = W.partitionBy("query_id").orderBy(F.desc("high"), F.desc("low"), "vec_id")
    ranked = reduce(DataFrame.unionByName, parts).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    half = 1 << (63 - HALF)
    score = F.when(F.col("high") >= half, F.lit(LONG)).when(F.col("high") < -half, F.lit(-LONG - 1)).otherwise(F.shiftleft("high", HALF) + F.col("low"))
    return ranked.select("query_id", "rank", "vec_id", score.alias("score"))
