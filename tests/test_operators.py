import itertools
import math

import pytest
from pyspark.sql import functions as F

from shardwright.operators import lineage, manifest, mixture, rows, splits, tokens


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def entries(spark, items):
    return spark.createDataFrame(items, "path string, grp string, sha256 string, bytes long, count_value long")


def test_diff_and_sizes(spark):
    e = entries(spark, [("a", "g", "1", 3, 1), ("b", "g", "2", 4, 1)])
    o = spark.createDataFrame([("a", 5), ("c", 1)], "path string, length long")
    assert rows_of(manifest.diff(e, o)) == [("extra", "c"), ("missing", "b")]
    assert rows_of(manifest.size_mismatch(e, o)) == [("a", 3, 5)]
    assert rows_of(manifest.diff(e, e)) == []


def test_totals_of_nothing(spark):
    none = entries(spark, [])
    said = spark.createDataFrame([("g", 0, 0), ("*", 1, 0)], "grp string, objects long, bytes long")
    assert rows_of(manifest.totals(none)) == []
    assert rows_of(manifest.totals_mismatch(none, said)) == [("objects-total", "*")]


def test_duplicates_name_the_first(spark):
    e = entries(spark, [("b", "g", "1", 3, 1), ("a", "g", "1", 3, 1), ("c", "h", "1", 3, 1)])
    assert rows_of(manifest.duplicate_digests(e)) == [("g", "b", "a")]


def test_counts_must_make_up_the_size(spark):
    columns = "path string, count_unit string, count_value long, bytes long, container string, dtype string, header_bytes int, codec string"
    df = spark.createDataFrame([("a", "tokens", 10, 40, "raw", "uint32", 0, "none"), ("b", "tokens", 10, 41, "raw", "uint32", 0, "none"), ("c", "tokens", 1, 99, "raw", "uint32", 0, "gzip"), ("d", "rows", 1, 99, "raw", "uint32", 0, "none")], columns)
    assert rows_of(manifest.count_arithmetic(df)) == [("b", 40, 41)]


def test_splits(spark):
    e = entries(spark, [("g/train-00000.bin", "g", "1", 1, 5), ("g/val-00000.bin", "g", "2", 1, 7), ("g/x.bin", "g", "3", 1, 1)])
    parts = [("train", "train-*"), ("val", "*-00000.bin"), ("none", "zzz")]
    assert rows_of(splits.partition_rows(e, parts)) == [("none", 0, None), ("train", 1, 5), ("val", 2, 12)]
    assert rows_of(splits.overlaps(e, parts)) == [("train", "val", 1)]
    assert rows_of(splits.leaks(e, parts)) == [("train", "val", 1)]
    assert rows_of(splits.uncovered(e, parts)) == [("g/x.bin",)]
    assert rows_of(splits.split_differences(e, ["train", "test", "odd"])) == [("empty-split", "test"), ("undeclared-split", "val")]


def test_resolve_never_gives_held_out_files_unasked(spark):
    e = entries(spark, [("g/train-00000.bin", "g", "1", 1, 5), ("g/val-00000.bin", "g", "2", 1, 7), ("g/x.bin", "g", "3", 1, 1)]).withColumn("split", F.lit(None).cast("string"))
    names = lambda df: sorted(r["path"] for r in df.collect())
    assert names(splits.resolve(e)) == ["g/train-00000.bin"]
    assert names(splits.resolve(e, declared=["val"])) == ["g/train-00000.bin", "g/x.bin"]
    assert names(splits.resolve(e, "val")) == ["g/val-00000.bin"]
    assert names(splits.resolve(e, "test", declared=["train"])) == []
    with pytest.raises(ValueError, match="unknown"):
        splits.resolve(e, "dev")


def test_pins(spark):
    d = spark.createDataFrame([("a", "p", "v1", "h"), ("b", "p", "v1", None), ("c", "p", "v1", "x"), ("d", "q", "v1", "h"), ("e", None, "v1", "h")], "child string, parent_id string, parent_version string, pin string")
    p = spark.createDataFrame([("p", "v1", ["h"])], "parent_id string, parent_version string, hashes array<string>")
    got = {r["child"]: r["status"] for r in lineage.pin_status(d, p).collect()}
    assert got == {"a": "ok", "b": "parent-manifest-pin-missing", "c": "parent-manifest-pin-mismatch", "d": "dangling-parent", "e": "invalid-depends-on"}


def test_text_problems_are_cut_off_with_a_note(spark):
    df = spark.createDataFrame([("p", i, " ") for i in range(150)] + [("q", 0, None), ("q", 1, "fine")], "path string, row_idx long, text string")
    found = rows_of(rows.text_problems(df))
    assert sum(c == "text-field-empty" for *_, c in found) == 100
    assert ("p", None, "text-row-violations-truncated") in found and ("q", 0, "missing-text-field") in found


def test_only_the_stuck_shard_is_found(spark):
    df = spark.createDataFrame([("good", i, f"t{i}") for i in range(10)] + [("stuck", i, "same") for i in range(10)] + [("one", 0, "x")], "path string, row_idx long, text string")
    assert rows_of(rows.top_fraction(df, 0.5)) == [("stuck", 10, 10)]


def test_leakage_tolerates_what_is_allowed(spark):
    df = spark.createDataFrame([("a", "train"), ("a", "held"), ("b", "train"), ("c", "held")], "key string, side string")
    assert rows_of(rows.leakage(df)) == [("a",)] and rows_of(rows.leakage(df, 1)) == []


def test_evaluations(spark):
    df = spark.createDataFrame([("s", "ok", "1"), ("s", "error", "1.0"), ("t", "error", "2"), ("t", "error", "2"), ("u", "ok", None)], "shard string, status string, metric string")
    said = spark.createDataFrame([("s", 1, 1, 0), ("t", 1, 0, 0), ("v", 2, 0, 0)], "shard string, ok long, error long, filtered long")
    assert rows_of(rows.eval_accounting(df, said)) == [("t", 1, 2), ("v", 2, 0)]
    assert rows_of(rows.no_success(df)) == [("t", 2)]
    assert rows_of(rows.constant_metric(df)) == [("t", 2, "2")]


@pytest.mark.parametrize(("ids", "want"), [([1, 2, 3], 0), ([0], 1), ([0, 1, 0], 1), ([1, 0, 0, 0, 1], 3), ([0, 0, 1, 0, 0, 0], 3), ([0] * 5, 5), ([0, 0, 1], 2), ([1, 0, 0], 2)])
def test_longest_runs(spark, ids, want):
    df = spark.createDataFrame([("p", i, x) for i, x in enumerate(ids)], "path string, pos long, id long")
    assert rows_of(tokens.longest_run(df)) == [("p", want)]


def test_distinct_floor(spark):
    df = spark.createDataFrame([(n,) for n in (1, 2, 4, 5, 8, 16, 64, 1024, 16384)], "n long")
    assert [r[0] for r in df.select(tokens.distinct_floor(F.col("n"), 256)).collect()] == [1, 2, 2, 2, 2, 4, 16, 256, 256]


@pytest.mark.parametrize(("ids", "kind", "want"), [
    ([2, 0, 1], "permutation", "ok"), ([0, 0, 0], "permutation", "permutation-not-bijective"), ([0, 1], "permutation", "permutation-wrong-length"), ([0, 3, 1], "permutation", "order-index-out-of-range"),
    ([0, 2], "subset", "ok"), ([0, 0], "subset", "subset-not-unique"), ([0, 0, 2], "repeating", "ok"), ([], "permutation", "order-empty"), ([0], "odd", "bad-ordering-kind"),
])
def test_orders(spark, ids, kind, want):
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    assert tokens.order_domain(df, 3, kind).first()["verdict"] == want


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 1000])
def test_runs_are_found_across_pieces(spark, piece):
    import random

    rng = random.Random(piece)
    shards = {f"s{k}": [rng.choice([0, 0, 0, 1, None]) for _ in range(rng.randint(1, 40))] for k in range(12)} | {"zeros": [0] * 25, "none": [5] * 9}
    rows = [(p, 3 * i if p < "s5" else i, x) for p, ids in shards.items() for i, x in enumerate(ids)]
    rng.shuffle(rows)
    got = rows_of(tokens.longest_run(spark.createDataFrame(rows, "path string, pos long, id long"), piece=piece))
    assert got == rows_of_plain({p: max((len(list(g)) for x, g in itertools.groupby(ids) if x == 0), default=0) for p, ids in shards.items()})


def rows_of_plain(found):
    return sorted(found.items(), key=repr)


def fold(sizes, want, cap, strict, passes):
    got, out = 0, []
    for p, (i, n) in itertools.product(range(1, passes + 1), enumerate(sizes)):
        if got < min(want, cap) and (not strict or got + n <= cap):
            got += n
            out.append((i, p))
    return out


@pytest.mark.parametrize(("sizes", "total", "fraction", "repetition"), [([50, 50], 60, 0.6, 1.0), ([60, 10, 30], 1000, 0.85, 1.0), ([5, 5, 5], 40, 1.0, 3.0), ([7, 3, 9, 1], 10, 1.0, 1.0), ([10, 20], 100, 0.5, 2.0), ([20, 4], 60, 1.0, 1.5)])
def test_mixtures_follow_the_fold(spark, sizes, total, fraction, repetition):
    pool = spark.createDataFrame([("s", f"{i}", n, f"{i:03}") for i, n in enumerate(sizes)], "source string, path string, n long, key string")
    wanted = spark.createDataFrame([("s", 1.0, fraction, repetition)], "source string, ratio double, fraction double, repetition double")
    goals = mixture.targets(pool, wanted, total)
    got = sorted((int(r["path"]), r["pass"]) for r in mixture.fill_capped(pool, goals).collect())
    cap = int(sum(sizes) * fraction * repetition)
    assert got == sorted(fold(sizes, total, cap, fraction < 1 or cap < total, math.ceil(repetition)))
    if fraction == repetition == 1.0:
        assert sorted(int(r["path"]) for r in mixture.fill(pool, goals).collect()) == [i for i, _ in got]
    assert sum(sizes[i] for i, _ in got) <= cap or fraction == 1 and cap >= total


@pytest.mark.parametrize("bad", [[], [{"labels": {}, "ratio": 1.0}], [{"labels": {"a": "b"}, "ratio": 0.5}], [{"labels": {"a": "b"}, "ratio": 0.5}] * 2, [{"labels": {"a": "b"}, "ratio": 1.0, "fraction": 0}], [{"labels": {"a": "b"}, "ratio": 1.0, "repetition": 0.5}]])
def test_mixture_requests_that_are_refused(bad):
    with pytest.raises(ValueError):
        mixture.check_request(bad, 10)


def test_worklist(spark):
    df = spark.createDataFrame([("p", "dataset.json", None, 1), ("p", "manifest.json", "a", None), ("q", "dataset.json", None, 2), ("q", "manifest.json", "a", None), ("r", "dataset.json", None, 0), ("r", "_SUCCESS", None, None)], "prefix string, name string, grp string, needs int")
    assert rows_of(manifest.pending(df)) == [("p", 1)]


def test_latest_version_is_by_number(spark):
    df = spark.createDataFrame([("d", "v9"), ("d", "v10"), ("e", "odd")], "dataset_id string, version string")
    assert rows_of(manifest.latest_versions(df)) == [("d", "v10"), ("e", "v1")]


def test_vocabulary(spark):
    df = spark.createDataFrame([("a", {"x": 0, "y": 1}, None), ("b", {"x": 0}, [(7, "</s>"), (9, "<|endoftext|>"), (11, "<pad>")])], "name string, vocab map<string,int>, added array<struct<id:int,content:string>>")
    assert rows_of(tokens.vocabulary(df)) == [("a", 2, None), ("b", 12, 9)]
