"""Benchmark decontamination by template canonicalisation.

Words become template tokens: numbers (in digits or words), units (after a number) and names turn into typed placeholders,
the rest stays as lower-case words without outer punctuation.  Windows of `n` template tokens of each
benchmark item are hashed and joined with the windows of every document.  Hits of one item at one
alignment form a passage; its slots must be filled consistently (each value of the item always stands
for the same value of the document; two values may be redrawn alike).  Of an alignment that isn't
consistent as a whole, the larger of two parts is the passage: the windows whose slots are all equal, or
the longest consistent stretch of windows, each with the other windows that agree with it.  A passage whose
slots are all equal is `exact`, another `reparameterised`.

A name is a word of NAMES, or a capitalised word (one capital, then lower case) that doesn't start a
sentence.  The benchmark's windows go to the tasks in blocks of at most `block_windows`, one pass over
the documents a block, so what is shipped is bounded however large the benchmark is.

Cases: null or empty texts have no windows.  An item of fewer than n tokens is matched whole, if it
has `least` literal tokens at least; windows with fewer literal tokens aren't evidence.  Repeated
documents are reported one by one, repeated items each under its own id; rows of an item without id
take no part.  Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, materialise

# Units of measure and common given names.
UNITS = "kg g mg lb lbs oz km m cm mm mi mile miles ft feet inch inches yard yards s sec second seconds min minute minutes h hour hours day days week weeks month months year years l ml litre litres liter liters gallon gallons cup cups dollar dollars cent cents euro euros pound pounds percent degree degrees mph kmh kw kwh w v a hz gb mb kb tb".split()
NAMES = "james john robert michael william david richard joseph thomas charles mary patricia jennifer linda elizabeth barbara susan jessica sarah karen alice bob carol dave emma olivia noah liam sophia lucas mia ethan ava maria jose carlos juan ana luis pedro marta pierre marie jean claire louis hans anna peter julia klaus tom tim ben sam max alex kate lucy emily daniel matthew mark paul steven andrew kevin brian george edward laura rachel natalia".split()
# Numbers in words.
NUMERALS = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion dozen half twice".split()
NUMBER = re.compile(r"[+-]?\d[\d.,]*(?:%|st|nd|rd|th)?")
WORD, NUM, UNIT, NAME = 0, 1, 2, 3


class Vocabulary(dict):
    """word -> number; arrays tell each number's literal hash, kind, whether it is capitalised (1) or a unit (2), and whether it ends a sentence.

    The arrays double in size when full, so a new word costs no copy of them.
    """

    def __init__(self, size: int = 1 << 12):
        super().__init__()
        self.units, self.names, self.numerals = frozenset(UNITS), frozenset(NAMES), frozenset(NUMERALS)
        self.literal, self.kind, self.marks, self.ends = np.zeros(size, np.uint64), np.zeros(size, np.int8), np.zeros(size, np.int8), np.zeros(size, bool)

    def __missing__(self, raw: bytes) -> int:
        n = len(self)
        if n == len(self.kind):
            self.literal, self.kind, self.marks, self.ends = (np.concatenate([a, np.zeros_like(a)]) for a in (self.literal, self.kind, self.marks, self.ends))
        word = raw.decode("utf-8", "replace")
        core = word.strip("\"'()[]{}<>.,;:!?*#$%&_|=+-/\\`~“”‘’«»…")
        low = core.lower()
        kind = -1 if not core else NUM if (core[0] in "+-" or core[0].isdigit()) and NUMBER.fullmatch(core) or low in self.numerals or "-" in low and self.numerals.issuperset(low.split("-")) else NAME if core.istitle() and low in self.names else WORD
        self.literal[n] = xxhash.xxh3_64_intdigest(low)
        self.kind[n] = kind
        self.marks[n] = (kind == WORD and core.istitle()) | 2 * (low in self.units)
        self.ends[n] = word.rstrip("\"')]”’»")[-1:] in ".!?:"
        self[raw] = n
        return n

    def bound(self, most: int = 500_000) -> None:
        if len(self) > most:
            self.clear()


_PLACE = np.array([0, 0x1111111111111111, 0x2222222222222222, 0x3333333333333333], np.uint64)


def template(text: bytes, words: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Template token hashes, literal hashes, kinds and word numbers of a text; words of punctuation only are left out."""
    split = text.split()
    words.bound()
    number = np.fromiter(map(words.__getitem__, split), np.int64, len(split))
    literal, kind, marks, ends = words.literal[number], words.kind[number], words.marks[number], words.ends[number]
    start = np.concatenate([[True], ends[:-1]]) if len(split) else ends
    at = np.flatnonzero(kind >= 0)
    kind = np.where((kind == WORD) & (marks & 1 > 0) & ~start, NAME, kind)[at]
    literal, marks = literal[at], marks[at]
    after_number = np.concatenate([[False], kind[:-1] == NUM]) if len(at) else np.zeros(0, bool)
    kind = np.where(after_number & (marks & 2 > 0), UNIT, kind)
    return np.where(kind == WORD, literal, _PLACE[kind]), literal, kind, at


def windows(tokens: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the windows of n tokens."""
    count = len(tokens) - n + 1
    h = np.full(max(count, 0), n, np.uint64)
    for k in range(n if count > 0 else 0):
        h = (h ^ tokens[k : k + count]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return h


class Index:
    """Windows of some benchmark items."""

    def __init__(self, n: int, least: int):
        self.n, self.least, self.items, self.at, self.words = n, least, [], defaultdict(list), Vocabulary()

    def add(self, item_id: int, text: bytes) -> None:
        tokens, literal, kind, _ = template(text, self.words)
        size = min(self.n, len(tokens))
        self.items.append((item_id, literal, kind))
        plain = np.concatenate([[0], np.cumsum(kind == WORD)])
        for i, h in enumerate(windows(tokens, size).tolist() if size else ()):
            if plain[i + size] - plain[i] >= self.least:
                self.at[size, h].append((len(self.items) - 1, i))

    def sealed(self):
        """(window length, its sorted hashes, a table of 2**20 flags for a quick no) for each length, and the places of each."""
        out = []
        for size in sorted({s for s, _ in self.at}):
            hashes = np.array(sorted(h for s, h in self.at if s == size), np.uint64)
            flags = np.zeros(1 << 20, bool)
            flags[hashes & np.uint64((1 << 20) - 1)] = True
            out.append((size, hashes, flags))
        return out, dict(self.at), self.items


def consistent(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether values of a and b stand for each other one to one."""
    pairs = set(zip(a.tolist(), b.tolist(), strict=True))
    return len(pairs) == len({x for x, _ in pairs}) == len({y for _, y in pairs})


class Fillings(dict):
    """What the item's values stand for in the document, of the slots at the counted places: value -> {value: count}."""

    def __init__(self, a: np.ndarray, b: np.ndarray, slot: np.ndarray):
        super().__init__()
        self.a, self.b, self.slot, self.places, self.clashes = a.tolist(), b.tolist(), slot.tolist(), Counter(), 0

    def put(self, first: int, size: int, by: int) -> None:
        """Adds (by 1) or takes back (by -1) the window at `first`."""
        for i in range(first, first + size):
            before = self.places[i]
            self.places[i] += by
            if self.slot[i] and (before == 0 or before + by == 0):
                of = self.setdefault(self.a[i], Counter())
                self.clashes -= len(of) > 1
                of[self.b[i]] += by
                if not of[self.b[i]]:
                    del of[self.b[i]]
                self.clashes += len(of) > 1


def largest_part(a: np.ndarray, b: np.ndarray, slot: np.ndarray, hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The windows (place, size) of `hits`, sorted, that make the passage: all of them if their slots agree.  a, b: literals of item and document, by place."""

    def agreeing(part):
        """part, and the other windows that agree with it, from left to right."""
        seen, taken = Fillings(a, b, slot), set(part)
        for w in part:
            seen.put(*w, 1)
        for w in hits:
            if w not in taken:
                seen.put(*w, 1)
                if seen.clashes:
                    seen.put(*w, -1)
                else:
                    taken.add(w)
        return sorted(taken)

    seen, first, best = Fillings(a, b, slot), 0, (0, 0)
    for last, w in enumerate(hits):
        seen.put(*w, 1)
        while seen.clashes:
            seen.put(*hits[first], -1)
            first += 1
        best = max(best, (last + 1 - first, -first))
    n, first = best[0], -best[1]
    if n in (0, len(hits)):
        return hits[:n]
    equal = [(p, s) for p, s in hits if not (slot[p : p + s] & (a[p : p + s] != b[p : p + s])).any()]
    covered = lambda part: len({i for p, s in part for i in range(p, p + s)})
    return max((agreeing(equal), agreeing(hits[first : first + n])), key=covered)


def passages(text: bytes, sealed, words: Vocabulary):
    """(item id, kind, first word, words, windows) of each item found in the text, at its longest alignment."""
    lengths, places, items = sealed
    tokens, literal, kind, word = template(text, words)
    found = defaultdict(set)
    for size, hashes, flags in lengths:
        h = windows(tokens, size)
        maybe = np.flatnonzero(flags[h & np.uint64((1 << 20) - 1)])
        if len(maybe):
            at = np.minimum(np.searchsorted(hashes, h[maybe]), len(hashes) - 1)
            for p in maybe[hashes[at] == h[maybe]].tolist():
                for item, q in places[size, int(h[p])]:
                    found[item, p - q].add((p, size))
    best: dict = {}
    for (item, shift), hits in found.items():
        item_id, own_literal, own_kind = items[item]
        low, high = min(p for p, _ in hits), max(p + s for p, s in hits)
        own, slots = own_literal[low - shift : high - shift], kind[low:high] != WORD
        hits = largest_part(own, literal[low:high], slots, sorted((p - low, s) for p, s in hits))
        if not hits:
            continue
        covered = np.unique(np.concatenate([np.arange(low + p, low + p + s) for p, s in hits]))
        slot = covered[kind[covered] != WORD]
        a, b = own_literal[slot - shift], literal[slot]
        row = (len(covered), -int(word[covered[0]]), item_id, "exact" if (a == b).all() else "reparameterised", len(hits))
        best[item] = max(best.get(item, row), row)
    return [(i, k, -w, c, n) for c, w, i, k, n in best.values()]


def contaminated(docs: DataFrame, benchmark: DataFrame, n: int = 8, least: int = 5, block_windows: int = 1_000_000) -> DataFrame:
    """doc_id, item_id, kind, first_word, n_words, n_windows: one row for each document and item found in it."""
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, kind string, first_word long, n_words long, n_windows long"
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("text is not null")

    def scan(index: Index) -> DataFrame:
        shipped = spark.sparkContext.broadcast(index.sealed())

        def run(batches):
            words, sealed = Vocabulary(), shipped.value
            for batch in batches:
                rows = [(d, *p) for d, t in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), strict=True) for p in passages(t, sealed, words)]
                columns = list(zip(*rows, strict=True)) or [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i == 2 else pa.int64()) for i, c in enumerate(columns)], names=["doc_id", "item_id", "kind", "first_word", "n_words", "n_windows"])

        return texts.mapInArrow(run, schema)

    parts, index = [], Index(n, least)
    for row in benchmark.select("item_id", "text").filter("item_id is not null and text is not null").orderBy("item_id").toLocalIterator():
        index.add(row["item_id"], row["text"].encode("utf-8", "replace"))
        if len(index.at) >= block_windows:
            parts.append(scan(index))
            index = Index(n, least)
    if index.at or not parts:
        parts.append(scan(index))
    return reduce(DataFrame.unionByName, parts)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The documents without a passage of the benchmark; rows without id can't be named, and stay."""
    found = materialise(contaminated(docs, benchmark, **settings).select("doc_id").distinct(), "contaminated")
    return docs.join(found, "doc_id", "left_anti").select(docs.columns)
