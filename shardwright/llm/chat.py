"""Chat formatting into packed prefix trees.

A turn becomes a node <|turn|> role <|text|> text <|end|> of token ids; the markers have ids of their
own after the tokenizer's, and control strings inside roles and texts get a backslash after their
first character (one more, if there are some), which is undone when read.  Conversations that share
their initial turns share the nodes of those turns: sorted by the digests of their turns, they come in
depth-first order, so each task packs a stream of them and emits a node once, before its descendants.
A pack holds trees up to `most_tokens` tokens (a longer conversation has a pack of its own); where a
pack ends inside a tree, the next one repeats the path to go on from, and so is whole by itself.

A token's position id is its place in its conversation.  A node attends to itself causally and to its
ancestors, given as intervals of the pack's tokens (adjacent ones are joined).  The loss mask covers the assistant's texts.

Cases: turns of a conversation are sorted by turn, then role, then text; nulls of these are first, and
null roles and texts are empty.  Repeated rows are turns of their own.  Rows without conv_id make one
conversation, whose id is null.  Conversations alike in all turns share one leaf and are listed by
`members`.  A conversation is one row, so it must fit in memory.  Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import materialise

TOKENIZER = os.environ.get("SHARDWRIGHT_RANKS", "/opt/tokenizers/byte_bpe_50k.tiktoken")
# Fixed value: how text is cut before byte-pair merges.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
# Control strings of this and other chat templates, as what follows their first character.
_REST = r"(\|[^|<>\[\]\s]{1,32}\|>|/?s>|/?INST\]|</?SYS>>)"
ESCAPE, UNESCAPE = re.compile(r"([<\[])(\\*)" + _REST), re.compile(r"([<\[])\\(\\*)" + _REST)
MARKS = ("<|turn|>", "<|text|>", "<|end|>")
PACK = (
    "pack string, token_ids array<int>, position_ids array<int>, loss_mask array<boolean>, node_start array<int>, node_end array<int>, parent array<int>, "
    "attention array<array<struct<first: int, last: int>>>, leaf_key array<string>, leaf_node array<int>"
)


def escape(text: str) -> str:
    return ESCAPE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return UNESCAPE.sub(r"\1\2\3", text)


def formatted(turns: list[tuple[str, str]]) -> str:
    """A conversation as one string."""
    return "".join(f"{MARKS[0]}{escape(r)}{MARKS[1]}{escape(t)}{MARKS[2]}" for r, t in turns)


class Codec:
    """Token ids of turns, and back.  ranks: the tokenizer's file."""

    def __init__(self, ranks: bytes):
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self.marks = [max(table.values()) + 1 + k for k in range(3)]

    def encode(self, role: str, text: str) -> tuple[list[int], int]:
        """Ids of the turn, and how many of them are before its text."""
        own = self.encoding.encode_ordinary(escape(role))
        head = [self.marks[0], *own, self.marks[1]]
        return [*head, *self.encoding.encode_ordinary(escape(text)), self.marks[2]], len(head)

    def decode(self, ids: list[int]) -> tuple[str, str]:
        """The escaped role and text of a turn."""
        middle = ids.index(self.marks[1])
        if ids[0] != self.marks[0] or ids[-1] != self.marks[2]:
            raise ValueError("not one turn")
        return tuple(self.encoding.decode_bytes(x).decode("utf-8") for x in (ids[1:middle], ids[middle + 1 : -1]))


def conversations(rows: DataFrame) -> DataFrame:
    """conv_id, key (digest of all turns), path (the turns' digests, whose order has those that share initial turns together), turns."""
    own = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    whole = own.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    digests = F.transform("turns", lambda t: F.md5(F.concat_ws("\x1f", F.length(t["role"]).cast("string"), t["role"], t["text"])))
    whole = whole.withColumn("digests", digests)
    return whole.select(
        "conv_id", F.md5(F.array_join("digests", "")).alias("key"), F.col("digests").alias("path"),
        F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"),
    )


class Packer:
    """Builds packs from conversations in depth-first order."""

    def __init__(self, codec: Codec, name: str, most_tokens: int):
        self.codec, self.name, self.most, self.count = codec, name, most_tokens, 0
        self.clear()

    def clear(self):
        self.ids, self.places, self.spoken, self.starts, self.ends, self.parents, self.leaf_keys, self.leaf_nodes = ([] for _ in range(8))
        self.path: list[tuple[tuple[str, str], int]] = []  # the turns of the last conversation, and their nodes

    def pack(self) -> dict:
        seen, positions, loss = [], np.zeros(len(self.ids), np.int32), np.zeros(len(self.ids), bool)
        for n, parent in enumerate(self.parents):
            start, end = self.starts[n], self.ends[n]
            positions[start:end] = np.arange(self.places[n], self.places[n] + end - start)
            if self.spoken[n]:
                loss[start + self.spoken[n] : end - 1] = True
            above = seen[parent] if parent >= 0 else []
            if above and above[-1]["last"] == start:  # goes on where its parent ends
                seen.append([*above[:-1], {"first": above[-1]["first"], "last": end}])
            else:
                seen.append([*above, {"first": start, "last": end}])
        out = {
            "pack": f"{self.name}-{self.count}", "token_ids": np.array(self.ids, np.int32), "position_ids": positions, "loss_mask": loss, "node_start": self.starts,
            "node_end": self.ends, "parent": self.parents, "attention": seen, "leaf_key": self.leaf_keys, "leaf_node": self.leaf_nodes,
        }
        self.count += 1
        self.clear()
        return out

    def add(self, key: str, turns: list[tuple[str, str]]):
        """Yields the pack that had to end before this conversation."""
        shared = 0
        while shared < min(len(turns), len(self.path)) and self.path[shared][0] == turns[shared]:
            shared += 1
        new = [self.codec.encode(*t) for t in turns[shared:]]
        if self.ids and len(self.ids) + sum(len(i) for i, _ in new) > self.most:
            yield self.pack()
            new, shared = [self.codec.encode(*t) for t in turns[:shared]] + new, 0
        del self.path[shared:]
        for turn, (ids, head) in zip(turns[shared:], new, strict=True):
            above = self.path[-1][1] if self.path else -1
            self.places.append(self.places[above] + self.ends[above] - self.starts[above] if above >= 0 else 0)
            self.parents.append(above)
            self.starts.append(len(self.ids))
            self.ids += ids
            self.spoken.append(head if turn[0] == "assistant" else 0)
            self.ends.append(len(self.ids))
            self.path.append((turn, len(self.starts) - 1))
        self.leaf_keys.append(key)
        self.leaf_nodes.append(self.path[-1][1])


def packs(convs: DataFrame, tokenizer: str = TOKENIZER, most_tokens: int = 8192) -> DataFrame:
    """Rows of PACK, from the table that `conversations` makes."""
    shipped = convs.sparkSession.sparkContext.broadcast(open(tokenizer, "rb").read())
    pair = pa.struct([("first", pa.int32()), ("last", pa.int32())])
    ints, words = pa.list_(pa.int32()), pa.list_(pa.string())
    types = [pa.string(), ints, ints, pa.list_(pa.bool_()), ints, ints, ints, pa.list_(pa.list_(pair)), words, ints]
    arrow = pa.schema(list(zip(StructType.fromDDL(PACK).names, types, strict=True)))

    def run(batches):
        from pyspark import TaskContext

        packer = Packer(Codec(shipped.value), str(TaskContext.get().partitionId()), most_tokens)
        as_row = lambda p: pa.RecordBatch.from_arrays([pa.array([p[f.name]], f.type) for f in arrow], schema=arrow)
        for batch in batches:
            for key, turns in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for done in packer.add(key, [(t["role"], t["text"]) for t in turns]):
                    yield as_row(done)
        if packer.ids:
            yield as_row(packer.pack())

    distinct = convs.groupBy("key").agg(F.first("path").alias("path"), F.first("turns").alias("turns"))
    ordered = distinct.repartitionByRange("path", "key").sortWithinPartitions("path", "key")
    return ordered.select("key", "turns").mapInArrow(run, PACK)


def read_back(packed: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """What the packs say of each leaf: leaf_key, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    shipped = packed.sparkSession.sparkContext.broadcast(open(tokenizer, "rb").read())
    names = ["leaf_key", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def leaves(codec: Codec, row: dict):
        spans = list(zip(row["node_start"], row["node_end"], strict=True))
        nodes = [codec.decode(row["token_ids"][a:b].tolist()) for a, b in spans]
        spoken = [bool(row["loss_mask"][a:b].any()) for a, b in spans]
        for key, node in zip(row["leaf_key"], row["leaf_node"], strict=True):
            path, place = [], 0
            while node >= 0:
                path.append(node)
                node = row["parent"][node]
            all_turns, loss, size, said = hashlib.sha256(), hashlib.sha256(), 0, 0
            for n in reversed(path):
                if row["position_ids"][row["node_start"][n]] != place:
                    raise ValueError("positions don't follow the path")
                place += row["node_end"][n] - row["node_start"][n]
                role, text = nodes[n]
                size += sum(map(len, MARKS)) + len(role) + len(text)
                role, text = unescape(role), unescape(text)
                all_turns.update(f"{role}\n{text}\n".encode())
                if spoken[n]:
                    loss.update(text.encode())
                    said += len(text)
            yield key, len(path), all_turns.hexdigest(), said, loss.hexdigest(), size

    def run(batches):
        codec = Codec(shipped.value)
        large = ("token_ids", "position_ids", "loss_mask")
        for batch in batches:
            small = {c: batch.column(c).to_pylist() for c in ("node_start", "node_end", "parent", "leaf_key", "leaf_node")}
            for i in range(batch.num_rows):
                row = {c: v[i] for c, v in small.items()} | {c: batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in large}
                columns = zip(*leaves(codec, row), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return packed.mapInArrow(run, "leaf_key string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def format_conversations(rows: DataFrame, tokenizer: str = TOKENIZER) -> tuple[DataFrame, DataFrame]:
    """(packs, members): the packed trees, and each conversation's leaf (conv_id, key)."""
    convs = materialise(conversations(rows), "conversations")
    return packs(convs, tokenizer), convs.select("conv_id", "key")


def digests(rows: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    packed, members = format_conversations(rows, tokenizer)
    found = materialise(read_back(packed, tokenizer), "read-back")
    return members.join(found, members.key == found.leaf_key).select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
