import fnmatch
import hashlib

import pytest
from pyspark.sql import functions as F

from shardwright.functions import keys, names, paths


def values(spark, column, items, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("v"))).collect()]


def test_shard_names(spark):
    items = ["tokens/train-00007.u32le.bin", "train-00000-of-00042.bin", "held-out-00003.jsonl", "Train-00001.bin", "val-0001.bin", "train-00001.bin\n"]
    assert values(spark, paths.shard_split, items) == ["train", None, "held-out", None, None, None]
    assert values(spark, paths.shard_ordinal, items)[0] == 7


def test_labels(spark):
    found = values(spark, paths.labels, ["g/train-00000.bin", "g/a/x.bin", "g/a/b/x.bin", "g/a/b/c/x.bin"])
    assert found == [{}, {"source": "a"}, {"source": "a", "domain": "b"}, None]


@pytest.mark.parametrize("glob", ["train-*", "*/short/*", "a?c", "[!t]*", "x.[ab]in", "**", "a.b", "[z"])
def test_globs_are_the_shells(spark, glob):
    items = ["train-1", "g/short/x", "abc", "a/c", "x.bin", "x.ain", "axb", "a.b", "[z", "TRAIN-1", "t"]
    pattern = paths.glob_pattern(glob)
    assert values(spark, lambda v: v.rlike(pattern), items) == [fnmatch.fnmatchcase(i, glob) for i in items]


def test_extensions(spark):
    items = ["a.u32le.bin", "a.JSONL.GZ", "a.jsonl", "a.bin", "a.gz", "b.npy", "c.f16be.bin"]
    assert values(spark, paths.extension, items) == [".u32le.bin", ".jsonl.gz", ".jsonl", None, None, ".npy", ".f16be.bin"]
    assert values(spark, lambda p: paths.claimed(p, "dtype"), items)[0] == "uint32"


def test_least_width(spark):
    assert values(spark, paths.least_width, [1, 256, 257, 65536, 65537, 1 << 32, (1 << 32) + 1], "long") == [1, 1, 2, 2, 4, 4, 8]


def test_trainable_is_never_assumed(spark):
    assert values(spark, paths.is_trainable, ["train", "val", None, "trainval"]) == [True, False, False, False]


@pytest.mark.parametrize(("value", "want"), [
    ("pretrain/corpus2-150b", None), ("pretrain/web-mix-1124-30b", None), ("eval/gsm-4hop", None), ("sft/decoder-5b5", None), ("pretrain/mix-jul22", "month"), ("pretrain/mix-2026", "year"),
    ("pretrain/a-20260728", "date"), ("sft/final-v2", "version-word"), ("eval/results-set", "generic-word"), ("probe/big-probe", "relative-word"), ("curriculum/experiment-3", "ordinal"),
    ("vendor/corpus2_150B", "not-kebab-case"), ("pretrain/one", "word-count"), ("other/x-y", "family"), ("a/b/c", "shape"), ("", "empty"), (None, "empty"), ("sft/mix-may", "month"), ("sft/maybe-mix", None),
])
def test_ids(spark, value, want):
    assert values(spark, names.id_problem, [value]) == [want]


def test_purposes(spark):
    items = ["TODO", " To-Do! ", "short one", "Held-out passages to compare splits", "x" * 40, "word " * 80, None]
    assert values(spark, names.purpose_problem, items) == ["placeholder", "placeholder", "short", None, "one-word", "long", "not-text"]


def test_strip_is_pythons(spark):
    items = [f"{chr(c)}x{chr(c)}" for c in (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x2003, 0x3000, 0x200B)]
    assert values(spark, names.strip, items) == [i.strip() for i in items]


def test_versions(spark):
    rows = [("v1", "supersedes", None), ("v2", "extends", "v1"), ("v1", "supersedes", "v1"), ("v2", "extends", None), ("v0", "extends", "v1"), ("v2", "other", "v1"), ("v2", "sibling", "v2")]
    df = spark.createDataFrame(rows, "v string, r string, o string")
    assert [r[0] for r in df.select(names.version_problem(F.col("v"), F.col("r"), F.col("o"))).collect()] == [None, None, "first-with-parent", "parent", "version", "relation", "own-parent"]
    assert values(spark, names.previous_version, ["v10", "v1", "x"]) == ["v9", None, None]


def test_sample_offsets_are_seeded_places(spark):
    def brute(size, window, n, seed, align):
        if size <= window:
            return [0]
        draws = [int.from_bytes(hashlib.sha256(f"{seed}:{i}".encode()).digest()[:8], "big") % (size - window + 1) for i in range(n)]
        return sorted({d - d % align for d in draws})

    for size, align in ((10, 1), (100_000, 4), (1 << 40, 4), (17_000, 1)):
        df = spark.createDataFrame([(size, "s")], "v long, s string")
        assert df.select(keys.sample_offsets(F.col("v"), 16_384, 4, F.col("s"), align)).first()[0] == brute(size, 16_384, 4, "s", align)


def test_conversation_keys_tell_nulls_from_texts(spark):
    df = spark.createDataFrame([([("user", None)],), ([("user", "")],), ([(None, "a"), ("x", "b")],)], "m array<struct<role:string,content:string>>")
    want = [hashlib.sha256(s.encode()).hexdigest() for s in ("user\x1fNone", "user\x1f", "\x1fa\x1ex\x1fb")]
    assert [r[0] for r in df.select(keys.conversation_key(F.col("m"))).collect()] == want
