"""Top-k search and the n-gram join against brute force, and components."""

import itertools
import math

import numpy as np
import pytest

from shardwright.llm import components, ngram_join, topk


def brute_top(rows, k, chosen):
    """What op1 returns, row by row."""
    good = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asked = {}
    for i, q in good:
        if chosen(i):
            asked[i] = min(asked.get(i, q), q)
    out = []
    for i, q in asked.items():
        scored = sorted(((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in good if j != i and len(v) == len(q)))[:k]
        out += [(i, r, j, -s) for r, (s, j) in enumerate(scored, 1)]
    return sorted(out)


CASES = {
    "plain": [(i, np.random.default_rng(i).normal(0, 0.2, 6).astype(np.float32).tolist()) for i in range(60)],
    "ties and repeats": [(i, [0.25, -0.5, 0.0]) for i in range(12)] + [(3, [0.25, -0.5, 0.0]), (4, [1.0, 1.0, 1.0])],
    "nulls and odd values": [(0, None), (1, [None, 1.0]), (2, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [1.0, 2.0]), (6, [-3.0, 2.0]), (None, [1.0, 1.0]), (8, [1.0, 2.0, 3.0]), (10, [9.0, 9.0, 9.0]), (12, []), (14, []), (16, [100.0, -1e-9])],
    "few": [(0, [1.0])],
    "empty": [],
}


@pytest.mark.parametrize("case", CASES)
def test_top_k_is_exact(spark, case):
    df = spark.createDataFrame([(i, v, "x") for i, v in CASES[case]], "vec_id long, embedding array<float>, score string")
    got = topk.top_k(df, lambda i: i % 2 == 0, k=5, block_rows=16, query_rows=4)
    assert sorted(map(tuple, got.collect())) == brute_top(CASES[case], 5, lambda i: i % 2 == 0)


def test_large_components_rank_exactly(spark):
    rows = [(i, [x, 1.0]) for i, x in enumerate([5e9, 6e9, -6e9, 1e14, 0.0, -1e14, 5e9])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), lambda i: i % 2 == 0, k=4).collect()
    want = [(q, r, v, max(-(1 << 63), min((1 << 63) - 1, s))) for q, r, v, s in brute_top(rows, 4, lambda i: i % 2 == 0)]
    assert sorted(map(tuple, got)) == want and any(s == (1 << 63) - 1 for *_, s in want)
    with pytest.raises(Exception, match="beyond"):
        topk.top_k(spark.createDataFrame([(1, [1e200])], "vec_id long, embedding array<double>"), lambda i: i > 0).collect()


def test_slices_add_up():
    rng = np.random.default_rng(0)
    q = rng.integers(-300, 300, (70, 5))
    block = topk.pack_block(np.arange(70), q)
    found = list(topk.search_block(block, [1000], np.array([[3, -7, 0, 255, -256]]), 70))
    want = sorted(((-int(v @ [3, -7, 0, 255, -256]), i) for i, v in enumerate(q)))
    assert sorted((-s, i) for _, i, s in found) == want


def brute_join(rows, n=5, threshold=0.8):
    def words(t):
        return (t or "").encode().lower().split()

    def grams(w):
        return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()

    sets = [(i, grams(words(t)), b" ".join(words(t))) for i, t in rows]
    links = [[b for b in range(len(sets)) if a != b and sets[a][1] and sets[b][1] and len(sets[a][1] & sets[b][1]) >= threshold * len(sets[a][1] | sets[b][1]) - 1e-9] for a in range(len(sets))]
    out = []
    for a, (i, s, key) in enumerate(sets):
        seen, todo = {a}, [a]
        while todo:
            for b in links[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        least = lambda ks: min((sets[k][0] for k in ks if sets[k][0] is not None), default=None)
        out.append((i, least([k for k in range(len(sets)) if sets[k][2] == key]) if s else i, least(seen) if s else i, len(links[a])))
    return sorted(out, key=repr)


BASE = [f"word{i}" for i in range(60)]
NEAR = [" ".join(BASE[:k] + ["odd"] + BASE[k + 1 :]) for k in (0, 20, 40, 59)]


def corpus():
    texts = [" ".join(BASE), " ".join(BASE).upper(), *NEAR, " ".join(BASE[:40]), "a b c", "A  b\tc", "", None, " ", "one two three four five", "x" * 5000, " ".join(["again"] * 50), " ".join(["again"] * 30), " ".join(BASE[30:] + BASE[:30])]
    return list(enumerate(texts)) + [(2, NEAR[0]), (None, " ".join(BASE))]


def test_the_join_links_what_brute_force_links(spark):
    df = spark.createDataFrame([(i, t, 0, "c") for i, t in corpus()], "doc_id long, text string, node int, tkey string")
    got = sorted(map(tuple, ngram_join.ngram_join(df).collect()), key=repr)
    assert got == brute_join(corpus())


def test_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_TEXTS", 3)
    rows = [(i, " ".join(BASE[:i] + ["odd", f"n{i}"] + BASE[i + 2 :])) for i in range(14)]
    got = sorted(map(tuple, ngram_join.ngram_join(spark.createDataFrame(rows, "doc_id long, text string"), threshold=0.7).collect()), key=repr)
    assert got == brute_join(rows, threshold=0.7)


def test_no_texts(spark):
    assert ngram_join.ngram_join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_one_of_each_group_stays(spark):
    df = spark.createDataFrame([(i, t, 1) for i, t in corpus()], "doc_id long, text string, n_chars long")
    kept = sorted((r["doc_id"] for r in ngram_join.keep_one(df).collect()), key=repr)
    want = {c for i, _, c, _ in brute_join(corpus()) if i is not None}
    assert kept == sorted([*want, None], key=repr)


def test_only_copies_under_a_repeated_id_collapse(spark):
    other = " ".join(f"else{i}" for i in range(30))
    rows = [(1, " ".join(BASE), 1), (1, other, 2), (2, NEAR[1], 3), (3, other.upper(), 4), (4, "", 5), (4, "", 6), (5, "one text", 7), (5, "one text", 8)]
    for parts in (1, 5):
        df = spark.createDataFrame(rows, "doc_id long, text string, own_hash int").repartition(parts)
        kept = sorted((r["doc_id"], r["text"]) for r in ngram_join.keep_one(df).collect())
        assert kept == sorted([(1, " ".join(BASE)), (1, other), (4, ""), (4, ""), (5, "one text")])


def test_many_repeated_rows_meet_one_node(spark):
    rows = [(7, " ".join(BASE))] * 500 + [(None, NEAR[2])] * 300 + [(8, NEAR[3])]
    got = ngram_join.ngram_join(spark.createDataFrame(rows, "doc_id long, text string")).distinct().collect()
    assert {(r["doc_id"], r["class_id"], r["n_links"]) for r in got} == {(7, 7, 800), (None, 7, 800), (8, 7, 800)}


@pytest.mark.parametrize(("threshold", "recall"), [(0.8, 0.999), (0.8, 0.95), (0.5, 0.9), (0.9, 0.99), (1.0, 0.9)])
def test_bands_reach_their_recall(threshold, recall):
    bands, rows = ngram_join.choose_bands(threshold, recall)
    assert 1 - (1 - threshold**rows) ** bands >= recall - 1e-12 and bands * rows <= 256


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    family = ngram_join.hash_family(2000)
    common, a, b = (np.unique(rng.integers(0, 1 << 63, n, np.uint64)) for n in (800, 100, 100))
    s, t = (ngram_join.signature(np.concatenate([common, x]), family) for x in (a, b))
    assert abs((s == t).mean() - 0.8) < 0.04


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(1, 2), (2, 3), (4, 5), (3, 1)], [(i, i + 1) for i in range(30)], [(0, i) for i in range(1, 20)] + [(50, 51)]])
def test_components(spark, edges):
    roots = {n: n for e in edges for n in e}
    for _, (a, b) in itertools.product(range(40), edges):
        roots[a] = roots[b] = min(roots[a], roots[b])
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == roots


def test_scratch_tables_need_no_setting_in_a_local_session(tmp_path):
    """In a process of its own, without the machine's defaults."""
    import os
    import subprocess
    import sys

    code = """
from pyspark.sql import SparkSession
from shardwright.llm.common import discard, materialise
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
one, two = materialise(spark.range(3), "x"), materialise(spark.range(4), "x")
print(one.count() + two.count())
discard(one, two)
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    found = subprocess.run([sys.executable, "-c", code], cwd=root, env=os.environ | {"SPARK_CONF_DIR": str(tmp_path)}, capture_output=True, text=True, timeout=300)
    assert found.stdout.strip() == "7", found.stderr[-2000:]
