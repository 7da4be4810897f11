"""Keys from SHA-256: seeded order, fingerprints, sample offsets, content sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def shuffle_key(seed: Column, dataset_id: Column, version: Column, path: Column) -> Column:
    return F.sha2(F.concat_ws("|", seed.cast("string"), dataset_id, version, path), 256)


def group_seed(dataset_id: Column, version: Column, group: Column) -> Column:
    return F.sha2(F.concat_ws("|", dataset_id, version, group), 256)


def shard_seed(seed: Column, path: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws(":", seed, path), 256), 1, 16)


def text_fingerprint(text: Column) -> Column:
    return F.sha2(text, 256)


def conversation_key(messages: Column) -> Column:
    """Of an array of (role, content); a null content reads None, a null role is empty."""
    one = lambda m: F.concat(F.coalesce(m["role"], F.lit("")), F.lit("\x1f"), F.coalesce(m["content"], F.lit("None")))
    return F.sha2(F.array_join(F.transform(messages, one), "\x1e"), 256)


def sample_offsets(size: Column, window: int, n: int, seed: Column, align: int = 1) -> Column:
    """Sorted distinct offsets of up to n windows: draws of 64 digest bits over the places left, aligned down; [0] where one window covers all."""
    draw = lambda i: F.conv(F.substring(F.sha2(F.concat_ws(":", seed, i.cast("string")), 256), 1, 16), 16, 10).cast("decimal(20,0)")
    place = lambda i: F.pmod(draw(i), (size - window + 1).cast("decimal(20,0)")).cast("long")
    found = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: place(i) - place(i) % align)
    return F.when(size <= window, F.array(F.lit(0).cast("long"))).otherwise(F.array_sort(F.array_distinct(found)))


def content_sum(digest: Column) -> Column:
    """An aggregate over hex digests that doesn't depend on their order and adds up before the shuffle."""
    part = F.conv(F.substring(digest, 1, 15), 16, 10).cast("decimal(38,0)")
    return F.sha2(F.concat_ws(":", F.sum(part).cast("string"), F.count("*").cast("string")), 256)
