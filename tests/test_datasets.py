"""A dataset's life in a local folder: describe, publish, validate, promote, read, sweep."""

import hashlib
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardwright.plans import cli, documents, profiles, readme
from shardwright.plans.publish import PublishError, build, pin, promote, publish
from shardwright.plans.read import NotValidated, ReadError, SealMismatch, build_mixture, latest, resolve, verify_seal
from shardwright.plans.sweep import sweep
from shardwright.plans.validate import validate
from shardwright.sources import files, shards
from shardwright.sources.store import Exists, Missing, Store, canonical, scratch
from shardwright.streaming.arrivals import pending, watch

PURPOSE = "Small corpus for the tests to follow a dataset's life"
NAME = "pretrain/tiny-mix"


def write(path, raw):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(raw if isinstance(raw, bytes) else raw.encode())


def ids(n, vocab=50_000, shift=0):
    return ((np.arange(n) * 7 + shift) % (vocab - 2) + 2).astype("<u4").tobytes()


def jsonl(*rows):
    return "".join(json.dumps(r) + "\n" for r in rows)


@pytest.fixture
def stores(spark, tmp_path):
    for n in ("source", "landing", "data"):
        (tmp_path / n).mkdir()
    return tuple(Store(spark, f"file://{tmp_path}/{n}") for n in ("source", "landing", "data"))


def tokens_source(tmp_path):
    at = tmp_path / "source/tokens"
    for i, (s, n) in enumerate((("a/train-00000", 40_000), ("a/train-00001", 20_000), ("b/train-00000", 20_000), ("a/val-00000", 5_000), ("b/val-00000", 3_000))):
        write(at / f"{s}.u32le.bin", ids(n, shift=i))
    return at


def published(spark, stores, tmp_path, **fields):
    source, landing, data = stores
    tokens_source(tmp_path)
    plan = build(spark, source.root, NAME, PURPOSE, {"tokens": "pretrain-tokens/v1"}, tokens_fields={"vocab_size": 50_000, "eos_id": 1} | fields)
    return publish(plan, source, landing, data)


def test_a_good_version_passes_and_can_be_read(spark, stores, tmp_path):
    source, landing, data = stores
    version = published(spark, stores, tmp_path)
    assert version == "v1" and pending(landing) == [f"{NAME}/v1"]
    result = validate(landing, f"{NAME}/v1", data)
    assert result.violations == [] and result.status == "ok"
    promote(result, landing, data, "now")
    with pytest.raises(PublishError):
        promote(result, landing, data, "now")
    assert verify_seal(data, f"{NAME}/v1") == [] and latest(data, NAME) == "v1"
    found = resolve(data, NAME)
    assert [p.split("/tokens/")[1] for p in found.paths] == ["a/train-00000.u32le.bin", "a/train-00001.u32le.bin", "b/train-00000.u32le.bin"]
    assert found.numpy_dtype == "<u4" and found.rows == 80_000 and found.has_split("val") and len(found.val) == 2
    assert resolve(data, NAME, split="val").rows == 8_000 and resolve(data, NAME, split="test").paths == []
    labelled = resolve(data, NAME, labels={"source": "b"})
    assert labelled.rows == 20_000 and labelled.split_rows == {"train": 20_000, "val": 3_000}
    with pytest.raises(ReadError):
        resolve(data, NAME, split="dev")
    assert sweep(data, contents=True).findings == []
    assert "tiny-mix v1" in data.get(f"{NAME}/v1/README.md").decode()
    assert publish(build(spark, source.root, NAME, PURPOSE, {"tokens": "pretrain-tokens/v1"}), source, landing, data) == "v2"


def test_mixtures_never_draw_held_out_files(spark, stores, tmp_path):
    published(spark, stores, tmp_path)
    _, landing, data = stores
    promote(validate(landing, f"{NAME}/v1", data), landing, data, "now")
    ask = [{"labels": {"source": "a"}, "ratio": 0.5}, {"labels": {"source": "b"}, "ratio": 0.5}]
    one, two = (build_mixture(data, NAME, "v1", ask, 60_000, seed) for seed in (1, 1))
    assert one == two and not any("val" in p for p in one.paths)
    assert one.counts["source=b"] == 20_000 and one.shortfall == {"source=b": 10_000}
    capped = build_mixture(data, NAME, "v1", [{"labels": {"source": "a"}, "ratio": 1.0, "fraction": 0.4}], 60_000, 1)
    assert capped.total == 20_000
    with pytest.raises(ReadError):
        build_mixture(data, NAME, "v1", [{"labels": {"source": "z"}, "ratio": 1.0}], 10, 1)


def test_tokens_are_held_against_their_tokenizer(spark, stores, tmp_path):
    source, landing, data = stores
    words = Store(spark, f"file://{tmp_path}/words")
    write(tmp_path / "words/bpe/tokenizer.json", json.dumps({"model": {"vocab": {str(i): i for i in range(50_000)}}, "added_tokens": [{"id": 1, "content": "</s>"}]}))
    with pytest.raises(PublishError):
        pin(data, "tokenizer/tiny-bpe")
    version = publish(build(spark, words.root, "tokenizer/tiny-bpe", PURPOSE, {"bpe": "tokenizer/v1"}), words, landing, data)
    result = validate(landing, f"tokenizer/tiny-bpe/{version}", data)
    assert result.violations == []
    promote(result, landing, data, "now")
    tokens_source(tmp_path)
    plan = build(spark, source.root, NAME, PURPOSE, {"tokens": "pretrain-tokens/v1"}, tokenizer=pin(data, "tokenizer/tiny-bpe"))
    publish(plan, source, landing, data)
    assert validate(landing, f"{NAME}/v1", data).violations == []
    write(tmp_path / "data/tokenizer/tiny-bpe/v1/bpe/tokenizer.json", json.dumps({"model": {"vocab": {"a": 0}}}))
    for crc in (tmp_path / "data").rglob(".*.crc"):
        crc.unlink()
    assert "vocab-out-of-range" in validate(landing, f"{NAME}/v1", data).codes()


def test_tampering_is_seen(spark, stores, tmp_path):
    published(spark, stores, tmp_path)
    _, landing, data = stores
    with pytest.raises(NotValidated):
        resolve(landing, NAME, "v1")
    promote(validate(landing, f"{NAME}/v1", data), landing, data, "now")
    at = tmp_path / "data" / NAME / "v1"
    shard = at / "tokens/a/train-00001.u32le.bin"
    raw = shard.read_bytes()
    shard.write_bytes(raw[:-4] + b"\1\0\0\0")
    (at / "tokens/a/.train-00001.u32le.bin.crc").unlink(missing_ok=True)
    assert sweep(data).ok and sweep(data, contents=True).codes() == {"object-content-changed"}
    shard.write_bytes(raw + b"1234")
    assert sweep(data).codes() == {"object-resized"}
    shard.unlink()
    assert sweep(data).codes() == {"object-gone"} and not sweep(data).ok
    for crc in at.glob(".*.crc"):
        crc.unlink()
    document = json.loads((at / "dataset.json").read_bytes())
    (at / "dataset.json").write_bytes(canonical(document | {"notes": "changed"}))
    with pytest.raises(SealMismatch):
        resolve(data, NAME, "v1")


@pytest.mark.parametrize(("change", "code"), [
    (lambda at: (at / "tokens/a/train-00001.u32le.bin").unlink(), "missing-object"), (lambda at: write(at / "tokens/a/train-00007.u32le.bin", ids(9)), "unlisted-object"), (lambda at: write(at / "stray/x.bin", b"1"), "unlisted-object-dataset-level"),
    (lambda at: write(at / "tokens/a/train-00001.u32le.bin", ids(7)), "size-mismatch"), (lambda at: (at / "tokens/manifest.json").unlink(), "incomplete-group"), (lambda at: write(at / "dataset.json", "{"), "dataset-json-unparseable"), (lambda at: (at / "dataset.json").unlink(), "no-dataset-json"),
    (lambda at: write(at / "tokens/a/train-00000.u32le.bin", bytes(160_000)), "zero-run-in-shard"), (lambda at: write(at / "tokens/a/train-00000.u32le.bin", np.full(40_000, 1, "<u4").tobytes()), "eos-fraction-out-of-bounds"),
    (lambda at: write(at / "tokens/a/train-00000.u32le.bin", np.full(40_000, 99_999, "<u4").tobytes()), "vocab-out-of-range"), (lambda at: write(at / "tokens/a/train-00000.u32le.bin", b"\x93NUMPY" + bytes(159_994)), "npy-magic-bytes"),
])
def test_each_fault_is_found(spark, stores, tmp_path, change, code):
    published(spark, stores, tmp_path)
    at = tmp_path / "landing" / NAME / "v1"
    for crc in at.rglob(".*.crc"):
        crc.unlink()
    change(at)
    assert code in validate(stores[1], f"{NAME}/v1", stores[2]).codes()


@pytest.mark.parametrize(("change", "code"), [
    ({"purpose": "todo"}, "bad-purpose"), ({"mutability": "odd"}, "bad-mutability"), ({"inventory": {"objects": 1, "bytes": 2}}, "inventory-objects-total"), ({"version": {"id": "v1", "relation": "extends", "of": "v1"}}, "bad-version"), ({"dataset_id": "pretrain/other-mix"}, "prefix-mismatch"), ({"schema_version": "x"}, "schema-version"),
])
def test_each_false_claim_is_found(spark, stores, tmp_path, change, code):
    published(spark, stores, tmp_path)
    landing = stores[1]
    landing.put(f"{NAME}/v1/dataset.json", canonical(landing.load(f"{NAME}/v1/dataset.json") | change), replace=True)
    assert code in validate(landing, f"{NAME}/v1", stores[2]).codes()


@pytest.mark.parametrize(("change", "code"), [
    ({"partitions": [{"name": "train", "by": "path", "glob": "*.bin", "rows": 88_000}, {"name": "val", "by": "path", "glob": "val-*", "rows": 8_000}]}, "train-heldout-leakage"), ({"partitions": [{"name": "train", "by": "path", "glob": "train-*", "rows": 1}]}, "partition-rows-mismatch"),
    ({"partitions": [{"name": "train", "by": "path", "glob": "train-*", "rows": 80_000}]}, "coverage-incomplete"), ({"partitions": [{"name": "val", "by": "path", "glob": "zzz", "rows": 0}]}, "partition-glob-empty"), ({"partitions": [{"name": "test", "by": "odd", "rows": True}]}, "partition-bad-rows"), ({"coverage": "odd"}, "bad-coverage"),
    ({"profile": "odd/v1"}, "unknown-profile"), ({"profile": None}, "no-profile"), ({"vocab_size": 70_000_000_000}, "dtype-too-narrow-for-vocab"), ({"seq_len": 4096}, "seq-len-misalignment"), ({"eos_fraction_max": False}, "invalid-decode-bound"), ({"depends_on": [{"dataset_id": "tokenizer/none-here", "version": "v1", "manifest_sha256": "0"}]}, "dangling-parent"),
])
def test_each_false_group_is_found(spark, stores, tmp_path, change, code):
    published(spark, stores, tmp_path)
    landing = stores[1]
    document = landing.load(f"{NAME}/v1/dataset.json")
    document["groups"][0] |= change
    landing.put(f"{NAME}/v1/dataset.json", canonical(document), replace=True)
    assert code in validate(landing, f"{NAME}/v1", stores[2]).codes()


def check(spark, store, name, profile, parts, root_files, **fields):
    """Codes that a group of the profile gives."""
    root = store.root.removeprefix("file://")
    from pathlib import Path

    for path, raw in root_files.items():
        write(Path(root) / f"x/y-z/v1/{name}/{path}", raw)
    from shardwright.plans.publish import describe

    entries = describe(spark, f"{store.root}/x/y-z/v1")
    group = profiles.Group(spark, store, "x/y-z", "v1", {"name": name, "partitions": parts} | fields, entries)
    return {r["code"] for c in profiles.PROFILES[profile] for r in c(group).collect()}


SCHEMA = {"record_schema": {"text": "string"}}


@pytest.mark.parametrize(("raw", "fields", "codes"), [
    (jsonl(*[{"text": f"t{i}"} for i in range(5)]), SCHEMA, set()), (jsonl({"id": 1}, {"text": "b"}, {"text": "c"}), SCHEMA, {"missing-text-field"}), (jsonl({"text": " "}, {"text": "b"}, {"text": "c"}), SCHEMA, {"text-field-empty"}), (jsonl({"text": 3}, {"text": "b"}, {"text": "c"}), SCHEMA, {"text-field-type"}),
    (jsonl(*[{"text": "same"}] * 4), SCHEMA, {"text-all-identical"}), (jsonl({"text": "a"}, {"text": "b"}), {}, {"missing-record-schema"}), (jsonl({"text": "a"}, {"text": "b"}), {"record_schema": {"body": "string"}}, {"record-schema-missing-text"}),
    (jsonl({"body": "a"}, {"body": "b"}), {"record_schema": {"body": "string"}, "text_field": "body"}, set()), (jsonl({"text": "a"}, {"text": "b"}), SCHEMA | {"max_identical_fraction": "0.5"}, {"invalid-max-identical-fraction"}), (jsonl({"text": "a"}, {"text": "b"}), SCHEMA | {"min_text_chars": True}, {"invalid-min-text-chars"}),
])
def test_text_profile(spark, stores, raw, fields, codes):
    assert check(spark, stores[1], "text", "text-corpus/v1", [], {"train-00000.jsonl": raw}, **fields) == codes


def talk(*texts):
    return {"messages": [{"role": "user", "content": t} for t in texts]}


SIDES = [{"name": "train", "by": "path", "glob": "train-*"}, {"name": "test", "by": "path", "glob": "test-*"}]


@pytest.mark.parametrize(("train", "held", "fields", "codes"), [
    ([talk("a"), talk("b")], [talk("c")], {}, set()), ([talk("a"), talk("b")], [talk("b")], {}, {"train-heldout-leakage"}), ([talk("a"), talk("b")], [talk("b")], {"max_leakage": 1}, set()), ([talk("a"), {"messages": "x"}], [talk("b")], {}, {"malformed-messages"}),
    ([{"messages": [{"content": "x"}]}], [talk("b")], {}, {"malformed-messages"}), ([talk("a") | {"id": 1}], [talk("b") | {"id": 1}], {"dedup_key": ["id"]}, {"train-heldout-leakage"}),
])
def test_conversation_profile(spark, stores, train, held, fields, codes):
    raw = {"train-00000.jsonl": jsonl(*train), "test-00000.jsonl": jsonl(*held)}
    assert check(spark, stores[1], "chat", "sft-conversations/v1", SIDES, raw, **fields) == codes


def test_eval_profile(spark, stores):
    good = jsonl(*[{"status": "ok", "score": i % 2} for i in range(10)], {"status": "error"})
    assert check(spark, stores[1], "a", "eval-results/v1", [], {"r.jsonl": good}, status_counts={"ok": 10, "error": 1}) == set()
    assert check(spark, stores[1], "b", "eval-results/v1", [], {"r.csv": "id,status,score\n"}, status_counts={"ok": 12}) == {"row-count-mismatch"}
    assert check(spark, stores[1], "c", "eval-results/v1", [], {"r.jsonl": jsonl(*[{"status": "error"}] * 5)}, status_counts={"error": 5}) == {"all-error-no-success"}
    assert check(spark, stores[1], "d", "eval-results/v1", [], {"r.jsonl": jsonl(*[{"status": "ok", "score": 1.0}] * 5)}, status_counts={"ok": 5}, metric_field="score") == {"metric-all-identical"}
    assert check(spark, stores[1], "f", "eval-results/v1", [], {"r.jsonl": jsonl(*[{"status": "ok", "score": 1.0}] * 5)}, status_counts={"ok": 5}) == set()
    assert check(spark, stores[1], "g", "eval-results/v1", [], {"r.jsonl": jsonl({"status": "ok", "score": 1}, {"status": "ok", "score": "1"})}, status_counts={"ok": 2}, metric_field="score") == set()
    assert check(spark, stores[1], "e", "eval-results/v1", [], {"r.jsonl": good}) == {"missing-status-counts"}


def test_csv_files_have_headers_of_their_own(spark, tmp_path):
    import gzip

    write(tmp_path / "e/a.csv", b"status,score\nok,3\n")
    write(tmp_path / "e/b.csv", "score,id,status\r\n5,x,error\r\n\"6\n7\",\"y,z\",ok\r\n".encode())
    write(tmp_path / "e/c.csv.gz", gzip.compress(b"status\nok\n"))
    write(tmp_path / "e/d.csv", b"")
    got = sorted(map(tuple, files.eval_rows(spark, f"file://{tmp_path}/e").collect()))
    assert got == [("a.csv", "ok", "3"), ("b.csv", "error", "5"), ("b.csv", "ok", "6\n7"), ("c.csv.gz", "ok", None)]


@pytest.mark.parametrize("whole", [False, True])
def test_parts_of_files_are_read_where_they_lie(spark, tmp_path, monkeypatch, whole):
    from shardwright.functions import keys
    from shardwright.sources import ranges

    if whole:  # a store that tasks can't open
        monkeypatch.setattr(ranges, "direct", lambda uri: False)
    raw = np.arange(50_000, dtype="<u4").tobytes()
    write(tmp_path / "r/a b/train-00000.bin", raw)
    write(tmp_path / "r/small.bin", raw[:40])
    write(tmp_path / "r/x.bin", b"\x93NUMPY" + raw[:100])
    root = f"file://{tmp_path}/r"
    assert {r["path"]: (r["length"], r["sha256"]) for r in files.digests(spark, root).collect()} == {"a b/train-00000.bin": (len(raw), hashlib.sha256(raw).hexdigest()), "small.bin": (40, hashlib.sha256(raw[:40]).hexdigest()), "x.bin": (106, hashlib.sha256(b"\x93NUMPY" + raw[:100]).hexdigest())}
    assert [r["path"] for r in files.npy_files(spark, root).collect()] == ["x.bin"]
    seed = F.lit("s")
    got = {(r["path"], r["pos"], r["id"]) for r in files.sampled_ids(spark, root, seed, window=400, n=3).collect()}
    sizes = spark.createDataFrame([("a b/train-00000.bin", len(raw)), ("small.bin", 40)], "path string, size long")
    places = sizes.select("path", keys.sample_offsets(F.col("size"), 400, 3, keys.shard_seed(seed, F.col("path")), align=4).alias("at")).collect()
    want = {(r["path"], at // 4 + k, at // 4 + k) for r in places for at in r["at"] for k in range(100 if r["path"][0] == "a" else 10)}
    assert {g for g in got if g[0] != "x.bin"} == want


def test_lines_are_numbered_and_bounded(spark, tmp_path):
    import gzip

    from shardwright.sources import ranges

    write(tmp_path / "n/a.jsonl", b"one\n\r\nthree \xff\rstill\n\nlast")
    write(tmp_path / "n/b.jsonl.gz", gzip.compress(b"1234567890123456\n12345678901234567\nmore\n"))
    got = sorted((r["uri"][-1], r["number"], r["line"] and bytes(r["line"])) for r in ranges.numbered_lines(spark, f"file://{tmp_path}/n", 16).collect())
    assert got == [("l", 1, b"one"), ("l", 2, b"\r"), ("l", 3, b"three \xff\rstill"), ("l", 4, b""), ("l", 5, b"last"), ("z", 1, b"1234567890123456"), ("z", 2, None)]


@pytest.mark.parametrize("tasks", [True, False])
def test_stores_copy_in_tasks_or_threads(spark, tmp_path, monkeypatch, tasks):
    from shardwright.sources import ranges

    if not tasks:
        monkeypatch.setattr(ranges, "direct", lambda uri: False)
    one, two = Store(spark, f"file://{tmp_path}/one"), Store(spark, f"file://{tmp_path}/two")
    for i in range(5):
        one.put(f"a b/{i}.bin", bytes([i]) * i * 1000)
    two.put("a b/3.bin", b"older, with a checksum beside it")
    one.copy([f"a b/{i}.bin" for i in range(5)], two, workers=3)
    one.copy([], two)
    assert [two.get(f"a b/{i}.bin") for i in range(5)] == [bytes([i]) * i * 1000 for i in range(5)]
    assert [n for n in two.names() if not n.endswith(".crc")] == [f"a b/{i}.bin" for i in range(5)]


def test_families_come_from_a_folder_too(tmp_path, monkeypatch):
    from shardwright.plans import families

    write(tmp_path / "sft.json", json.dumps({"coverage": "overlapping"}))
    write(tmp_path / "custom.json", json.dumps({"profile": "own/v1"}))
    monkeypatch.setenv(families.FOLDER, str(tmp_path))
    assert families.defaults("sft/x") == {"coverage": "overlapping"} and families.defaults("custom/x") == {"profile": "own/v1"} and families.defaults("eval/x")["profile"] == "eval-results/v1"


def test_findings_are_listed_up_to_a_bound(spark, monkeypatch):
    from shardwright.plans import validate as v

    monkeypatch.setattr(v, "LISTED", 3)
    found = spark.createDataFrame([("a", str(i)) for i in range(5)] + [("b", "x")], "code string, path string")
    got = v.reported(found, "d")
    assert len(got) == 5 and got[3:] == [("violations-truncated", None, "a: 5 in all"), ("violations-truncated", None, "b: 1 in all")]
    assert v.reported(found.limit(3)) == [("a", str(i), None) for i in range(3)]


def test_order_profile(spark, stores):
    raw = lambda xs: np.array(xs, "<u4").tobytes()
    run = lambda name, xs, **f: check(spark, stores[1], name, "token-order/v1", [], {"train-00000.u32le.bin": xs if isinstance(xs, bytes) else raw(xs)}, block_count=4, **f)
    assert run("a", [3, 1, 0, 2]) == set()
    assert run("b", [0, 0, 0, 0]) == {"permutation-not-bijective"}
    assert run("c", [3, 1, 0, 9]) == {"order-index-out-of-range"}
    assert run("d", b"12345") == {"order-bytes-not-multiple"}
    assert run("e", [0, 0], ordering="repeating") == set()
    assert run("f", [0, 1, 2, 3], max_order_bytes=8) == {"order-too-large"}


def test_tokenizer_profile(spark, stores):
    good = json.dumps({"model": {"vocab": {"a": 0, "b": 1}}, "added_tokens": [{"id": 7, "content": "</s>"}]})
    assert check(spark, stores[1], "a", "tokenizer/v1", [], {"tokenizer.json": good}) == set()
    assert check(spark, stores[1], "b", "tokenizer/v1", [], {"other.json": good}) == {"tokenizer-json-missing"}
    assert check(spark, stores[1], "c", "tokenizer/v1", [], {"tokenizer.json": "{"}) == {"tokenizer-json-invalid"}
    assert check(spark, stores[1], "d", "tokenizer/v1", [], {"tokenizer.json": "{}"}) == {"tokenizer-vocab-underivable"}
    assert profiles.derive_vocabulary(good.encode()) == {"vocab_size": 8, "eos_id": 7}


def test_a_check_that_fails_is_a_violation(spark, stores, tmp_path):
    def broken(group):
        raise ValueError("no")

    profiles.register("broken/v1", [broken])
    published(spark, stores, tmp_path)
    landing = stores[1]
    document = landing.load(f"{NAME}/v1/dataset.json")
    document["groups"][0]["profile"] = "broken/v1"
    landing.put(f"{NAME}/v1/dataset.json", canonical(document), replace=True)
    assert "profile-check-error" in validate(landing, f"{NAME}/v1", stores[2]).codes()


def test_lines_end_with_newlines_only(spark, tmp_path):
    write(tmp_path / "a/x.jsonl", '{"text":"a\\r"}\r\n\n  \n{"text":"b"}')
    write(tmp_path / "b/x.jsonl", '{"a":1} x\n[1]\n{"text":"k","text":"l"}\n{"text":NaN}\n')
    assert files.json_rows(spark, f"file://{tmp_path}/a").count() == 2
    found = files.json_rows(spark, f"file://{tmp_path}/b").collect()
    assert [r["error"] is not None for r in found] == [True, True, False, False] and found[2]["text"] == "l"


@pytest.mark.parametrize(("dtype", "order"), [("uint32", "little"), ("uint16", "big"), ("int64", "little"), ("uint8", "little")])
def test_tokens_decode_exactly(spark, tmp_path, dtype, order):
    import shardwright.sources.files as f

    kind = {"little": "<", "big": ">"}[order] + f._NUMPY[dtype]
    want = np.array([0, 1, 200, 255] + ([3_000_000_000] if dtype == "uint32" else []), kind)
    write(tmp_path / "t/train-00000.bin", want.tobytes())
    got = files.token_ids(spark, f"file://{tmp_path}/t", dtype, order).orderBy("pos").collect()
    assert [r["id"] for r in got] == want.tolist()


def test_store(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    store.put("a/b", b"1")
    with pytest.raises(Exists):
        store.put("a/b", b"2")
    assert not store.put_same("a/b", b"1") and store.get("a/b") == b"1" and store.names() == ["a/b"]
    with pytest.raises(Exists):
        store.put_same("a/b", b"2")
    with pytest.raises(Missing):
        store.get("a/c")
    with pytest.raises(TypeError):
        Store(object(), "x")
    assert canonical({"b": 1, "a": "é"}) == '{"a":"é","b":1}'.encode()
    with pytest.raises(ValueError):
        canonical(float("nan"))


def test_entries_that_break_their_schema():
    good = {"path": "g/a.bin", "sha256": "0" * 64, "bytes": 1, "format": {"container": "raw"}}
    assert documents.from_document(good, "g")[0] == "g/a.bin"
    for bad in ({"path": "/a"}, {"path": "g/../a"}, {"sha256": "0"}, {"bytes": True}, {"bytes": -1}, {"count": {"unit": "odd", "value": 1}}, {"count": {"unit": "rows", "value": True}}, {"split": "dev"}, {"labels": {"a": 1}}, {"labels": {"split": "a"}}, {"odd": 1}, {"format": {}}):
        with pytest.raises(documents.BadEntry):
            documents.from_document(good | bad, "g")


def test_arrivals_are_handled_once(spark, stores, tmp_path):
    published(spark, stores, tmp_path)
    seen = []
    for _ in range(2):
        watch(stores[1], f"file://{tmp_path}/checkpoint", seen.append).awaitTermination()
    assert seen == [f"{NAME}/v1"]


def test_the_command_line(spark, stores, tmp_path, capsys):
    published(spark, stores, tmp_path)
    assert cli.main(["validate", "--landing", stores[1].root, "--data", stores[2].root, "--promote"]) == 0
    assert cli.main(["sweep", "--data", stores[2].root, "--json"]) == 0
    assert '"ok": true' in capsys.readouterr().out


def test_readme_leaves_out_empty_columns():
    text = readme.render({"dataset_id": "a/b", "version": {"id": "v1"}, "purpose": "p", "inventory": {"objects": 1234, "bytes": 2048}, "groups": [], "sources": [{"name": "x|y", "url": ""}]})
    assert "1,234 files, 2.0 KiB" in text and "x\\|y" in text and "url" not in text


def test_parts_become_files_in_order(spark, tmp_path):
    rows = [("a/x.bin", 2, b"c"), ("a/x.bin", 1, b"ab"), ("b.bin", 5, b""), ("a/x.bin", 3, None)]
    shards.write(spark.createDataFrame([r for r in rows if r[2] is not None], "path string, pos long, part binary"), f"file://{tmp_path}")
    assert (tmp_path / "a/x.bin").read_bytes() == b"abc" and (tmp_path / "b.bin").read_bytes() == b""
    shards.write(spark.createDataFrame([("b.bin", 1, b"new")], "path string, pos long, part binary"), f"file://{tmp_path}")
    assert (tmp_path / "b.bin").read_bytes() == b"new" and sorted(p.name for p in tmp_path.rglob("*") if p.is_file()) == ["b.bin", "x.bin"]
    shards.write(spark.createDataFrame([], "path string, pos long, part binary"), f"file://{tmp_path}/none")
    with pytest.raises(ValueError):
        shards.write(spark.createDataFrame(rows[:1], "path string, pos long, part binary"), "odd://x/y")


def test_little_endian_numbers_and_lines(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, 258, 0xFFFFFFFF, 0x80000000)], "n long")
    assert [bytes(r[0]) for r in df.select(shards.little_endian(F.col("n"))).collect()] == [n.to_bytes(4, "little") for n in (0, 1, 258, 0xFFFFFFFF, 0x80000000)]
    assert bytes(df.limit(1).select(shards.line(F.lit("é"))).first()[0]) == "é\n".encode()


def test_scratch_folders_need_no_setting_in_a_local_session(tmp_path):
    """In a process of its own, without the machine's defaults."""
    import os
    import subprocess
    import sys

    code = """
from pyspark.sql import SparkSession
from shardwright.sources.store import scratch
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
one, two = scratch(spark, "x"), scratch(spark, "x")
assert one != two and one.rpartition("/")[0] == two.rpartition("/")[0] and "/x-" in one
spark.range(3).write.parquet(one + "/t")
print(spark.read.parquet(one + "/t").count())
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    found = subprocess.run([sys.executable, "-c", code], cwd=root, env=os.environ | {"SPARK_CONF_DIR": str(tmp_path)}, capture_output=True, text=True, timeout=300)
    assert found.stdout.strip() == "3", found.stderr[-2000:]


def test_texts_are_parsed_once_for_all_their_checks(spark, stores, tmp_path, monkeypatch):
    import uuid

    lines, seen = files.lines, tmp_path / "seen"
    seen.mkdir()

    def watched(*given, **named):
        found = lines(*given, **named)

        def pass_on(batches):
            (seen / uuid.uuid4().hex).touch()
            yield from batches

        return found.mapInArrow(pass_on, found.schema)

    write(tmp_path / "parsed/text/train-00000.jsonl", jsonl({"text": "a"}, {"text": 7}, {"text": ""}, {}, {"text": "b"}))
    store = Store(spark, f"file://{tmp_path}/parsed")
    entries = spark.createDataFrame([("text/train-00000.jsonl", 5)], "path string, count_value long")
    group = profiles.Group(spark, store, "x", "y", {"name": "text", "record_schema": {"text": "string"}}, entries)
    monkeypatch.setattr(profiles.Group, "root", property(lambda self: f"file://{tmp_path}/parsed/text"))
    monkeypatch.setattr(files, "lines", watched)
    found = sorted(r["code"] for r in profiles.text_rows(group).collect())
    assert found == ["missing-text-field", "text-field-empty", "text-field-type"]
    assert len(list(seen.iterdir())) == 1
    group.release()
    assert not group.held


def test_batches_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    import pyarrow as pa
    from shardwright.sources import ranges

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.nbytes]})

    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    frame = type(spark.range(1))
    measured, original = [], frame.mapInArrow
    monkeypatch.setattr(frame, "mapInArrow", lambda self, *a, **k: (measured.append(original(self, sizes, "n long")), original(self, *a, **k))[1])
    rows = spark.range(0, 3000, 1, 1).select(F.lit("x.jsonl").alias("path"), F.col("id").alias("pos"), shards.line(F.concat(F.lit('{"text":"'), F.repeat(F.lit("a"), 10_000), F.lit('"}'))).alias("part"))
    shards.write(rows, f"file://{tmp_path}/s")
    assert files.json_rows(spark, f"file://{tmp_path}/s").filter("char_length(text) = 10000").count() == 3000
    assert len(measured) == 2
    for frame_ in measured:
        assert max(r["n"] for r in frame_.collect()) < 1.2 * ranges.BATCH_BYTES


def test_runs_of_parts_are_written_as_they_lie():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"path": ["z", "a", "a", "b", "b", "c"], "part": [b"zz", b"", b"x" * 3, b"yy", b"y", b""]})
    assert [(p, bytes(x)) for p, x in shards._runs(batch.slice(1))] == [("a", b"xxx"), ("b", b"yyy"), ("c", b"")]
    assert list(shards._runs(batch.slice(0, 0))) == []
    with pytest.raises(ValueError):
        list(shards._runs(pa.RecordBatch.from_pydict({"path": ["a"], "part": pa.array([None], pa.binary())})))


def test_many_small_shards_take_few_tasks_and_batches(spark, tmp_path):
    from shardwright.sources import ranges

    for i in range(70):
        (tmp_path / f"t/{i}").mkdir(parents=True)
        (tmp_path / f"t/{i}/a.bin").write_bytes(np.arange(i, dtype="<u4").tobytes())
    context, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    context.setJobGroup("many", "many")
    try:
        found = files.token_ids(spark, f"file://{tmp_path}/t")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tasks = sum(tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup("many") for s in tracker.getJobInfo(j).stageIds)
    assert 0 < tasks <= ranges.TASKS * context.defaultParallelism
    assert sorted((r["path"], r["id"]) for r in found.collect()) == sorted((f"{i}/a.bin", n) for i in range(70) for n in range(i))

    small = [(f"p{i}", 5, np.arange(10, dtype="<u4").tobytes()) for i in range(100)]
    large = [("large", 0, np.arange(150_000, dtype="<u4").tobytes())]
    batches = list(files._decoder("uint32", "little", 65_536)(iter(small + large)))
    assert len(batches) == 3 and max(b.num_rows for b in batches) <= 2 * 65_536
    rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    assert rows == [(f"p{i}", 5 + n, n) for i in range(100) for n in range(10)] + [("large", n, n) for n in range(150_000)]


def test_contents_that_spark_reads_come_in_bounded_batches(spark, tmp_path, monkeypatch):
    import pyarrow as pa
    from shardwright.sources import ranges

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.nbytes]})

    for i in range(24):
        (tmp_path / f"{i}.bin").write_bytes(bytes([i]) * (1 << 20))
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    monkeypatch.setattr(ranges, "direct", lambda uri: False)
    frame = type(spark.range(1))
    measured, original = [], frame.mapInArrow
    monkeypatch.setattr(frame, "mapInArrow", lambda self, *a, **k: (measured.append(original(self.coalesce(1), sizes, "n long")), original(self, *a, **k))[1])
    found = {r["path"]: r["sha256"] for r in files.digests(spark, f"file://{tmp_path}").collect()}
    assert found == {f"{i}.bin": hashlib.sha256(bytes([i]) * (1 << 20)).hexdigest() for i in range(24)}
    assert max(r["n"] for r in measured[0].collect()) < 1.2 * ranges.BATCH_BYTES
