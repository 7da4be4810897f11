"""Language-model scoring: causal self-attention in numpy over subword ids, beside a unigram base.

Texts are lower-cased (A-Z only) and split at ASCII white space; every word is cut into subword ids by
a public tokenizer (its file is a parameter, read on the driver and shipped).  The model predicts the
class of each next id from at most `WINDOW` earlier ones: one causal self-attention layer over learned
embeddings, added to a prior of log bigram probabilities (trigram, after the PAIRS most frequent pairs
of classes inside words); an id's probability within its class is its
relative frequency there after the last id's class.  Frequent ids are classes of their own, the rest
share bins of like frequency.  Classes come in GROUPS: the softmax is over the groups, then over the
members of the target's group, which costs an eighth of one over all classes.
Windows overlap: each starts STRIDE positions after the last, and scores only the positions that no
earlier window scored, so each token counts once and (but for the first) has WINDOW - STRIDE ids of
context at least.

What comes from the corpus covers all of it: word counts, id and bigram frequencies come from every
training text.  Attention is trained on windows that lie end to end over every training text, so each of
its ids (but START) is predicted once a round: tasks train on their own windows from common parameters,
which are then averaged, `rounds` times.

Cases: a null text is empty and holds only its end.  Any id may repeat or be null (null: a training
text).  Without training texts the counts are 0 and the base's probabilities 1/(V+1) with V = 0.
Texts of any length are scored window by window; copies of a text have the same scores.
"""

from __future__ import annotations

import hashlib
import itertools
import os
from array import array
from collections import Counter
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, discard, held_out, materialise, sum_blobs

TOKENIZER = os.environ.get("SHARDWRIGHT_PIECES", "/opt/tokenizers/piece_bpe_32k.model")
WINDOW, STRIDE, WIDTH = 32, 24, 16
START, END, SINGLES, BINS = 0, 1, 180, 30
#: TEXTS texts are scored at a time.
TEXTS = 128
CLASSES = 2 + SINGLES + 2 * BINS
PAIRS = 2000
#: Class k is member k % MEMBERS of group k // MEMBERS.
GROUPS = MEMBERS = 16
#: Words at least this frequent, so at most 1 / HOT_SHARE of them, and at most HOT_BYTES long are shipped to every task; the rest meet their counts in a join.
HOT_SHARE, HOT_BYTES = 2e-6, 64
LOG10 = float(np.log(10))


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def pieces(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


# --- statistics of all training texts ---


def count_words(texts: DataFrame, most: int = 200_000) -> DataFrame:
    """word (binary) and c.  Tasks add up their own words first, at most `most` at a time."""

    def count(batches):
        own: Counter = Counter()

        def out():
            return pa.RecordBatch.from_pydict({"word": pa.array(list(own), pa.binary()), "c": pa.array(own.values(), pa.int64())})

        for batch in batches:
            for text in as_bytes(batch.column(0)):
                own.update(words_of(text))
                if len(own) > most:
                    yield out()
                    own.clear()
        yield out()

    return texts.select("text").mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def spelled(words: DataFrame, model: bytes) -> DataFrame:
    """word, c and ids (bytes of 16-bit numbers) of words that count_words gives."""
    shipped = words.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        sp = pieces(shipped.value)
        for batch in batches:
            found = sp.encode([w.decode("utf-8", "replace") for w in batch.column("word").to_pylist()], num_threads=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([array("H", ids).tobytes() for ids in found], pa.binary())], names=["word", "c", "ids"])

    return words.mapInArrow(run, "word binary, c long, ids binary")


def tokenised(batches, most: int = 1 << 20):
    """The ids of words end to end, how many each word has, and the words' counts: about `most` ids at a time."""
    raw, counts, size = [], [], 0

    def out():
        return np.frombuffer(b"".join(raw), np.uint16).astype(int), np.array([len(ids) // 2 for ids in raw], int), np.concatenate(counts)

    for batch in batches:
        new = batch.column("ids").to_pylist()
        raw += new
        counts.append(batch.column("c").to_numpy())
        size += sum(map(len, new))
        if size >= 2 * most:
            yield out()
            raw, counts, size = [], [], 0
    if raw:
        yield out()


def added(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """k and c: each key once, with the sum of its counts."""
    k, place = np.unique(keys, return_inverse=True)
    return pa.RecordBatch.from_pydict({"k": pa.array(k.astype(np.int64)), "c": pa.array(np.bincount(place, counts).astype(np.int64))})


def id_counts(words: DataFrame, n_ids: int) -> np.ndarray:
    def count(batches):
        total = np.zeros(n_ids)
        for ids, n, c in tokenised(batches):
            total += np.bincount(ids, np.repeat(c, n), n_ids)
        yield pa.RecordBatch.from_pydict({"blob": pa.array([total.tobytes()], pa.binary())})

    found = sum_blobs(words.mapInArrow(count, "blob binary"))
    return found if found is not None else np.zeros(n_ids)


def classes(counts: np.ndarray, initial: np.ndarray) -> np.ndarray:
    """Each id's class; START and END follow the ids."""
    order = np.argsort(-counts, kind="stable")
    of = np.zeros(len(counts) + 2, np.uint8)
    of[order[:SINGLES]] = 2 + np.arange(len(order[:SINGLES]))
    for k in (0, 1):
        rest = order[SINGLES:][initial[order[SINGLES:]] == k]
        mass = np.cumsum(counts[rest] + 0.5)
        of[rest] = 2 + SINGLES + k * BINS + np.minimum(BINS - 1, (BINS * mass / max(mass[-1] if len(mass) else 1, 1)).astype(int))
    of[-2:] = START, END
    return of


def id_bigrams(words: DataFrame, of: np.ndarray) -> dict[int, float]:
    """class * number of ids + id -> how often the id follows the class within a word; after CLASSES stands a word's first id, after CLASSES + 1 its last.

    At most (CLASSES + 2) times the tokenizer's ids, whatever the corpus.
    """
    n = len(of)

    def count(batches):
        for ids, lengths, c in tokenised(batches):
            ends, some = np.cumsum(lengths), lengths > 0
            last = np.full(len(ids), CLASSES)
            last[1:] = of[ids[:-1]]
            last[(ends - lengths)[some]] = CLASSES
            yield added(np.concatenate([last * n + ids, (CLASSES + 1) * n + ids[ends[some] - 1]]), np.concatenate([np.repeat(c, lengths), c[some]]))

    return collected(words.mapInArrow(count, "k long, c long"))


def collected(counts: DataFrame) -> dict[int, float]:
    """Sums of c by k, on the driver; k is bounded by the caller."""
    found = counts.groupBy("k").agg(F.sum("c").alias("c")).toArrow()
    return dict(zip(found["k"].to_pylist(), map(float, found["c"].to_pylist()), strict=True))


def class_trigrams(words: DataFrame, of: np.ndarray, pairs: np.ndarray) -> dict[int, float]:
    """(pair - CLASSES) * (CLASSES + 1) + next class, or CLASSES where the word ends, for the pairs that are numbered."""

    def count(batches):
        for ids, lengths, c in tokenised(batches):
            k, word = of[ids].astype(int), np.repeat(np.arange(len(lengths)), lengths)
            then = np.full(len(k), CLASSES)
            then[:-2] = np.where(word[2:] == word[:-2], k[2:], CLASSES)
            row = pairs[k[:-1], k[1:]]
            at = np.flatnonzero((word[1:] == word[:-1]) & (row >= CLASSES))
            yield added((row[at].astype(int) - CLASSES) * (CLASSES + 1) + then[at], c[word[at]])

    return collected(words.mapInArrow(count, "k long, c long"))


@dataclass
class Prior:
    """log[row]: log probabilities of the next class.  A row is the last class, or the number of the last two where pairs has one."""

    log: np.ndarray
    pairs: np.ndarray

    def rows(self, x: np.ndarray) -> np.ndarray:
        out = x.astype(np.int32)
        out[:, 1:] = self.pairs.take(out[:, :-1] * CLASSES + out[:, 1:])
        return out

    def odds(self) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of the groups by row, and of the members by row * GROUPS + group."""
        p = np.zeros((len(self.log), GROUPS * MEMBERS), self.log.dtype)
        p[:, : self.log.shape[1]] = np.exp(self.log)
        p = p.reshape(-1, GROUPS, MEMBERS)
        groups = p.sum(axis=2)
        return groups, (p / np.maximum(groups, 1e-30)[:, :, None]).reshape(-1, MEMBERS)


def frequent_pairs(by_class: np.ndarray, most: int = PAIRS) -> np.ndarray:
    """Table of rows of Prior.log by the last two classes."""
    pairs = np.tile(np.arange(CLASSES, dtype=np.int32), (CLASSES, 1))
    flat = by_class[:CLASSES].ravel()
    top = np.argsort(-flat, kind="stable")[:most]
    top = top[flat[top] > 0]
    pairs.ravel()[top] = CLASSES + np.arange(len(top))
    return pairs


def filled(counts: dict[int, float], rows: int, columns: int) -> np.ndarray:
    out = np.zeros((rows, columns))
    if counts:
        out.ravel()[np.fromiter(counts, np.int64, len(counts))] = np.fromiter(counts.values(), float, len(counts))
    return out


def tables(counts: np.ndarray, bigrams: dict[int, float], of: np.ndarray, n_texts: int, trigrams=lambda pairs: {}, weight: float = 5.0, more: float = 20.0) -> tuple[Prior, np.ndarray]:
    """The prior (across words the next class doesn't depend on the last), and the log probability of an id within its class given the last class.

    trigrams: what class_trigrams gives for a table of pairs.
    """
    n = len(of)
    follow = filled(bigrams, CLASSES + 2, n)
    by_class = np.array([np.bincount(of, row, CLASSES) for row in follow])
    first = by_class[CLASSES] + 0.1
    first[START], first[END] = 0.01, n_texts + 0.1
    first /= first.sum()
    table = by_class[:CLASSES] + np.outer(by_class[CLASSES + 1], first) + 2 * first
    table[START] = first
    table /= table.sum(axis=1, keepdims=True)
    pairs = frequent_pairs(by_class)
    after = filled(trigrams(pairs), int(pairs.max()) + 1 - CLASSES, CLASSES + 1) if pairs.max() >= CLASSES else np.zeros((0, CLASSES + 1))
    second = np.zeros(len(after), int)
    where = np.argwhere(pairs >= CLASSES)
    second[pairs[pairs >= CLASSES] - CLASSES] = where[:, 1]
    deeper = after[:, :CLASSES] + after[:, CLASSES:] * first + more * table[second]
    deeper /= np.maximum(deeper.sum(axis=1, keepdims=True), 1e-30)
    prior = Prior(np.log(np.concatenate([table, deeper])).astype(np.float32), pairs)

    own = np.concatenate([counts + 0.5, [1.0, 1.0]])
    share = own / np.bincount(of, own, CLASSES)[of]
    within = (follow[:CLASSES] + weight * share) / (by_class[:CLASSES][:, of] + weight)
    return prior, np.log(within).astype(np.float32)


# --- the attention model ---

SHAPES = {"E": (CLASSES, WIDTH), "P": (WINDOW, WIDTH), "Q": (WIDTH, WIDTH), "K": (WIDTH, WIDTH), "V": (WIDTH, WIDTH), "O": (WIDTH, WIDTH), "W": (GROUPS, WIDTH, MEMBERS), "G": (WIDTH, GROUPS)}
SIZE = sum(int(np.prod(s)) for s in SHAPES.values())
CAUSAL = np.tril(np.ones((WINDOW, WINDOW), np.float32))


_ENDS = np.cumsum([int(np.prod(s)) for s in SHAPES.values()]).tolist()
_PLACES = [(name, slice(end - int(np.prod(shape)), end), shape) for (name, shape), end in zip(SHAPES.items(), _ENDS, strict=True)]


def views(flat: np.ndarray) -> dict[str, np.ndarray]:
    return {name: flat[at].reshape(shape) for name, at, shape in _PLACES}


def first_parameters(seed: int = 11) -> np.ndarray:
    p = np.random.default_rng(seed).normal(0, 0.3, SIZE).astype(np.float32)
    views(p)["W"][:] = views(p)["G"][:] = 0  # starts as the prior
    views(p)["P"][:] *= 0.1
    views(p)["Q"][:] *= 0.25
    return p


def bounded(logits: np.ndarray) -> np.ndarray:
    """In place: none above 60.  Looking for the greatest is faster than np.minimum, and there is seldom one to cut."""
    return logits if logits.max(initial=0) <= 60 else np.minimum(logits, 60, out=logits)


def forward(p: dict, x: np.ndarray, causal: np.ndarray, first: int = 0):
    """Hidden states of windows x (rows of classes) at the places from first on, and what the backward pass needs.

    A state is a sum of a class's and a place's row, so queries, keys and values are too: they are made by class and by place, then looked up.
    """
    t, qkv = x.shape[1], np.concatenate([p["Q"], p["K"], p["V"]], axis=1)
    rows = np.concatenate([p["E"], p["P"][:t]])
    rows = np.concatenate([rows, rows @ qkv], axis=1)
    all_four = rows.take(x, axis=0)
    all_four += rows[CLASSES:]
    h, q, k, v = (all_four[:, :, n * WIDTH : (n + 1) * WIDTH] for n in range(4))
    h, q = h[:, first:], q[:, first:]
    a = q @ k.transpose(0, 2, 1)
    np.exp(bounded(a), out=a)
    a *= causal[first:]
    share = 1 / (a @ np.ones(t, a.dtype))[:, :, None]
    z = a @ v
    z *= share
    y = z @ p["O"]
    y += h
    return y, (h, q, k, v, a, share, z, qkv)


def by_group(groups: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order in which positions of a group are together, and (group, first, last) of those that have any."""
    groups = groups.astype(np.uint8)
    order = np.argsort(groups, kind="stable")
    bounds = np.cumsum(np.bincount(groups, minlength=GROUPS)).tolist()
    return order, [(k, a, b) for k, (a, b) in enumerate(zip([0, *bounds], bounds, strict=False)) if b > a]


def softmaxes(p: dict, odds, y: np.ndarray, last: np.ndarray, to: np.ndarray, told: bool = True):
    """Unnormalised probabilities of the groups, and of the members of the targets' groups in the order that by_group gives; where the targets are in both, flat; if told, their logits' sums; sorted y."""
    groups, members = odds
    g, n = to >> 4, np.arange(0, len(to) * GROUPS, GROUPS)
    order, parts = by_group(g)
    coarse = bounded(y @ p["G"])
    fine, sorted_y = np.empty((len(to), MEMBERS), y.dtype), y.take(order, axis=0)
    for k, a, b in parts:
        np.matmul(sorted_y[a:b], p["W"][k], out=fine[a:b])
    bounded(fine)
    in_coarse, in_fine = n + g, n + (to & 15).take(order)
    own = None
    if told:
        own = coarse.take(in_coarse)
        own[order] += fine.take(in_fine)
    np.exp(coarse, out=coarse)
    coarse *= groups.take(last, axis=0)
    np.exp(fine, out=fine)
    fine *= members.take((last * GROUPS + g).take(order), axis=0)
    return coarse, fine, in_coarse, in_fine, own, sorted_y, order, parts


def log_probabilities(p: dict, odds, prior: Prior, x: np.ndarray, targets: np.ndarray, scored: np.ndarray, first: int = 0) -> np.ndarray:
    """Natural log of each scored position's probability, in row order.  odds: those of prior; first: no place before it is scored."""
    y, _ = forward(p, x, CAUSAL, first)
    at = np.flatnonzero(scored[:, first:])
    y, last = y.reshape(-1, WIDTH).take(at, axis=0), prior.rows(x)[:, first:].ravel().take(at)
    to = targets[:, first:].ravel().take(at).astype(np.int64)
    coarse, fine, _, _, own, _, order, _ = softmaxes(p, odds, y, last, to)
    own -= np.log(coarse @ np.ones(GROUPS, coarse.dtype))  # faster than sums of short rows
    own[order] -= np.log(fine @ np.ones(MEMBERS, fine.dtype))
    return own + prior.log.take(last * CLASSES + to)


def gradients(flat: np.ndarray, prior: Prior, odds, x: np.ndarray, targets: np.ndarray, real: np.ndarray, causal: np.ndarray, told: bool = True) -> tuple[np.ndarray, float]:
    """Of the mean loss over the real positions, and, if told, that loss."""
    p, g = views(flat), np.zeros_like(flat)
    d = views(g)
    y, (h, q, k, v, a, share, z, qkv) = forward(p, x, causal)
    side = lambda m: m.reshape(-1, m.shape[-1])
    last, to = prior.rows(x).ravel(), targets.ravel().astype(np.int64)
    weight = (real.ravel() / max(1, int(real.sum()))).astype(flat.dtype)
    coarse, fine, in_coarse, in_fine, _, sorted_y, order, parts = softmaxes(p, odds, side(y), last, to, told=False)
    sorted_weight = weight.take(order)
    of_coarse, of_fine = coarse @ np.ones(GROUPS, coarse.dtype), fine @ np.ones(MEMBERS, fine.dtype)
    loss = told and float(-(np.log(coarse.take(in_coarse) / of_coarse + 1e-30) * weight).sum() - (np.log(fine.take(in_fine) / of_fine + 1e-30) * sorted_weight).sum())
    coarse *= (weight / of_coarse)[:, None]
    fine *= (sorted_weight / of_fine)[:, None]
    coarse.ravel()[in_coarse] -= weight
    fine.ravel()[in_fine] -= sorted_weight
    np.matmul(side(y).T, coarse, out=d["G"])
    back, place = np.empty_like(sorted_y), np.empty_like(order)
    for n, lo, hi in parts:
        np.matmul(sorted_y[lo:hi].T, fine[lo:hi], out=d["W"][n])
        np.matmul(fine[lo:hi], p["W"][n].T, out=back[lo:hi])
    place[order] = np.arange(len(order))
    dy = coarse @ p["G"].T
    dy += back.take(place, axis=0)
    np.matmul(side(z).T, dy, out=d["O"])
    # a is not divided by its rows' sums, so dz is, and what is made of both is as if a were.
    dz = (dy @ p["O"].T).reshape(z.shape)
    dz *= share
    ds = dz @ v.transpose(0, 2, 1)
    ds -= np.einsum("bij,bij->bi", dz, z)[:, :, None]
    ds *= a
    of_qkv = np.empty((*x.shape, 3 * WIDTH), flat.dtype)
    np.matmul(ds, k, out=of_qkv[:, :, :WIDTH])
    np.matmul(ds.transpose(0, 2, 1), q, out=of_qkv[:, :, WIDTH : 2 * WIDTH])
    np.matmul(a.transpose(0, 2, 1), dz, out=of_qkv[:, :, 2 * WIDTH :])
    d["Q"][:], d["K"][:], d["V"][:] = np.split(side(h).T @ side(of_qkv), 3, axis=1)
    dh = side(of_qkv) @ qkv.T
    dh += dy
    d["P"][: x.shape[1]] = dh.reshape(z.shape).sum(axis=0)
    flat_x = x.ravel()
    together = np.argsort(flat_x, kind="stable")
    sorted_x = flat_x[together]
    first = np.flatnonzero(np.concatenate([[True], sorted_x[1:] != sorted_x[:-1]]))
    two = np.result_type(flat.dtype, np.complex64)  # adds two columns at a time
    d["E"][sorted_x[first]] = np.add.reduceat(dh.take(together, axis=0).view(two), first, axis=0).view(flat.dtype)
    return g, loss


def train_locally(flat: np.ndarray, prior: Prior, windows: np.ndarray, rate: float, batch: int = 32, seed: int = 5) -> np.ndarray:
    """Adam over the windows (rows of WINDOW + 1 classes; END repeats after the end) once."""
    flat = flat.copy()
    m, v, odds = np.zeros_like(flat), np.zeros_like(flat), prior.odds()
    order = np.random.default_rng(seed).permutation(len(windows))
    for t, at in enumerate(range(0, len(order), batch), 1):
        w = windows[order[at : at + batch]]
        x, y = w[:, :-1], w[:, 1:]
        g, _ = gradients(flat, prior, odds, x, y, x != END, CAUSAL, told=False)
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        step = np.sqrt(v / (1 - 0.99**t))
        step += 1e-8
        np.divide(m, step, out=step)
        step *= rate / (1 - 0.9**t)
        flat -= step
    return flat


def average(windows: DataFrame, flat: np.ndarray, prior: Prior, rate: float) -> np.ndarray:
    """One round: every task trains from flat on its own windows; the mean counts windows."""
    shipped = windows.sparkSession.sparkContext.broadcast((flat, prior))

    def run(batches, most=20_000):
        start, table = shipped.value
        total, own, held = np.zeros(SIZE + 1), start, []

        def learn(own):
            w = np.concatenate(held)
            total[-1] += len(w)
            return train_locally(own, table, w, rate)

        for batch in batches:
            column = batch.column(0)
            first = np.frombuffer(column.buffers()[1], np.int32)[column.offset] if len(column) else 0
            held.append(np.frombuffer(column.buffers()[2], np.uint8)[first : first + len(column) * (WINDOW + 1)].reshape(-1, WINDOW + 1) if len(column) else np.zeros((0, WINDOW + 1), np.uint8))
            if sum(map(len, held)) >= most:
                own = learn(own)
                held.clear()
        if any(map(len, held)):
            own = learn(own)
        total[:-1] = total[-1] * own
        yield pa.RecordBatch.from_pydict({"blob": pa.array([total.tobytes()], pa.binary())})

    total = sum_blobs(windows.mapInArrow(run, "blob binary"))
    return (total[:-1] / total[-1]).astype(np.float32) if total is not None and total[-1] else flat


# --- the model as a whole ---


class Spelling(dict):
    """word -> its number, from 2 on; START and END are 0 and 1.  The numbered words' ids lie end to end, so a text is spelled by look-ups in arrays."""

    def __init__(self, model: bytes, n: int, most: int = 500_000, hot: dict[bytes, int] | None = None):
        super().__init__()
        self.sp, self.n, self.most, self.hot = pieces(model), n, most, hot or {}
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.words: list[bytes] = [b"", b""]
        self.pool, self.starts = np.array([self.n - 2, self.n - 1], np.uint16), np.arange(3)
        self.counts = np.zeros(2, np.int64)

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.words)
        self.words.append(word)
        return number

    def learn(self, words) -> np.ndarray:
        """The words' numbers.  New ones are spelled in one call of the tokenizer, which a call a text would slow down; counts gets what hot has for them, or 0."""
        if len(self) > self.most:
            self.forget()
        numbers = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if new := self.words[len(self.counts) :]:
            found = self.sp.encode([w.decode("utf-8", "replace") for w in new], num_threads=1)
            ends = self.starts[-1] + np.cumsum([len(ids) for ids in found])
            self.pool = np.concatenate([self.pool, np.fromiter(itertools.chain.from_iterable(found), np.uint16)])
            self.starts = np.concatenate([self.starts, ends])
            self.counts = np.concatenate([self.counts, np.fromiter((self.hot.get(w, 0) for w in new), np.int64, len(new))])
        return numbers

    def ids(self, numbers: np.ndarray, most: int = 1 << 16) -> np.ndarray:
        """The ids of START, the numbered words and END; looked up for `most` words at a time."""
        whole, out = np.concatenate([[0], numbers, [1]]), []
        for at in range(0, len(whole), most):
            k = whole[at : at + most]
            first = self.starts.take(k)
            length = self.starts.take(k + 1) - first
            ends = np.cumsum(length)
            places = np.repeat(first - ends + length, length)
            places += np.arange(len(places))
            out.append(self.pool.take(places))
        return out[0] if len(out) == 1 else np.concatenate(out)

    def text(self, words: list[bytes]) -> np.ndarray:
        """The ids of START, the words (all learned) and END."""
        return self.ids(np.fromiter(map(self.__getitem__, words), np.int64, len(words)))

    def texts(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        """The numbers of each text's words."""
        ends = np.cumsum([len(words) for words in texts])
        return np.split(self.learn(list(itertools.chain.from_iterable(texts))), ends[:-1])


def cut(seq: np.ndarray) -> np.ndarray:
    """Overlapping windows of WINDOW + 1 classes (a view); END fills the last."""
    n = 1 + max(0, -(-(len(seq) - 1 - WINDOW) // STRIDE))
    padded = np.full((n - 1) * STRIDE + WINDOW + 1, END, np.uint8)
    padded[: len(seq)] = seq
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW + 1)[::STRIDE]


def training_windows(seq: np.ndarray) -> np.ndarray:
    """Windows of WINDOW + 1 classes end to end (the last of one is the first of the next); END fills the last."""
    n = max(1, -(-(len(seq) - 1) // WINDOW))
    padded = np.full(n * WINDOW + 1, END, np.uint8)
    padded[: len(seq)] = seq
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW + 1)[::WINDOW]


def scored_positions(n: int, length: int) -> np.ndarray:
    """Which of n windows' positions count, for a sequence of the given length."""
    at = np.arange(n)[:, None] * STRIDE + np.arange(WINDOW)
    own = at < length - 1
    own[1:, : WINDOW - STRIDE] = False
    return own


def score_sequences(flat: np.ndarray, prior: Prior, sequences, chunk: int = 128, odds=None) -> np.ndarray:
    """Natural log probability of each sequence of classes.  odds: those of prior, if they are at hand.

    A sequence's first window is scored whole; the others only from where the one before ends, so only there do they ask.
    """
    p, odds = views(flat), odds or prior.odds()
    totals = np.zeros(len(sequences))
    held = {first: ([], [], []) for first in (0, WINDOW - STRIDE)}

    def run(first):
        w, mask, own = map(np.concatenate, held[first])
        lp = log_probabilities(p, odds, prior, w[:, :-1], w[:, 1:], mask, first)
        totals[:] += np.bincount(np.repeat(own, mask.sum(axis=1)), lp, len(totals))
        for part in held[first]:
            part.clear()

    waiting = dict.fromkeys(held, 0)
    for i, seq in enumerate(sequences):
        windows = cut(seq)
        mask = scored_positions(len(windows), len(seq))
        ends = [0, *range(1, len(windows), chunk), len(windows)]
        for at, end in zip(ends, ends[1:], strict=False):
            first = WINDOW - STRIDE if at else 0
            for part, new in zip(held[first], (windows[at:end], mask[at:end], np.full(end - at, i)), strict=True):
                part.append(new)
            waiting[first] += end - at
            if waiting[first] >= chunk:
                run(first)
                waiting[first] = 0
    for first, n in waiting.items():
        if n:
            run(first)
    return totals


@dataclass
class Model:
    tokenizer: bytes
    of: np.ndarray
    within: np.ndarray
    prior: Prior
    flat: np.ndarray
    hot: dict[bytes, int]
    n: int
    distinct: int
    n_texts: int


def count_corpus(texts: DataFrame, tokenizer: str = TOKENIZER) -> tuple[Model, DataFrame]:
    """The model before attention is trained (it starts as the prior), and the table of training words with their counts."""
    raw = open(tokenizer, "rb").read()
    sp = pieces(raw)
    n_ids = sp.get_piece_size()
    initial = np.array([sp.id_to_piece(i).startswith("▁") for i in range(n_ids)])
    words = materialise(spelled(count_words(texts), raw), "lm-words")
    n_texts = texts.count()
    n, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    n, distinct = n + n_texts, distinct + (n_texts > 0)
    counts = id_counts(words, n_ids)
    of = classes(counts, initial)
    prior, within = tables(counts, id_bigrams(words, of), of, n_texts, lambda pairs: class_trigrams(words, of, pairs))
    hot = {bytes(w): c for w, c in words.filter((F.col("c") >= HOT_SHARE * n) & (F.length("word") <= HOT_BYTES)).select("word", "c").collect()}
    return Model(raw, of, within, prior, first_parameters(), hot, n, distinct, n_texts), words.select("word", "c")


READ = "uid long, doc_id long, held_out boolean, tkey binary, n_tokens long, known long, base double, ids binary, cold array<binary>, times array<int>"


def read_texts(docs: DataFrame, model: Model) -> DataFrame:
    """docs: doc_id, text, held_out.  Each text is split and spelled once, for training and for scoring: its ids (16-bit numbers, with START and END), and its base score but for the words that aren't hot (cold, with their times)."""
    shipped = docs.sparkSession.sparkContext.broadcast((model.tokenizer, len(model.of), model.hot, model.n + 0.5 * (model.distinct + 1), model.n_texts))

    def run(batches):
        from pyspark import TaskContext

        raw, n_ids, hot, whole, n_texts = shipped.value
        spell = Spelling(raw, n_ids, hot=hot)
        end = float(np.log10((n_texts + 0.5) / whole))
        uid = TaskContext.get().partitionId() << 33
        for batch in slices(batches):
            raw_texts, n = as_bytes(batch.column(2)), batch.num_rows
            numbers = spell.texts([words_of(t) for t in raw_texts])
            lengths = np.array([len(own) for own in numbers])
            text, every = np.repeat(np.arange(n), lengths), np.concatenate(numbers)
            c = spell.counts.take(every)
            base = end + np.bincount(text, np.log10((c + 0.5) / whole), n)
            known = np.bincount(text[c > 0], minlength=n) + (n_texts > 0)
            cold, times = np.unique(text[c == 0] * len(spell.words) + every[c == 0], return_counts=True)
            offsets = np.searchsorted(cold, np.arange(n + 1) * len(spell.words))
            cold = [spell.words[k] for k in (cold % len(spell.words)).tolist()]
            uids, tokens = np.arange(uid, uid + n), lengths + 1
            uid += n
            at = pa.array(offsets, pa.int32())
            yield pa.RecordBatch.from_arrays([
                pa.array(uids, pa.int64()), batch.column(0), batch.column(1), pa.array([hashlib.md5(t).digest() for t in raw_texts], pa.binary()), pa.array(tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()),
                pa.array([spell.ids(own).tobytes() for own in numbers], pa.binary()), pa.ListArray.from_arrays(at, pa.array(cold, pa.binary())), pa.ListArray.from_arrays(at, pa.array(times, pa.int32())),
            ], names=[x.split()[0] for x in READ.split(", ")])

    return materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", "text").mapInArrow(run, READ), "lm-read")


def slices(batches):
    """TEXTS rows at a time."""
    return itertools.chain.from_iterable((b.slice(at, TEXTS) for at in range(0, b.num_rows, TEXTS)) for b in batches)


def spelled_texts(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(ids, np.uint16) for ids in column.to_pylist()]


def attend(model: Model, read: DataFrame, rounds: int = 3) -> Model:
    """The model with attention trained on every text of read (as read_texts gives them)."""
    shipped = read.sparkSession.sparkContext.broadcast(model.of)

    def pick(batches):
        of = shipped.value
        for batch in slices(batches):
            out = np.concatenate([training_windows(of.take(ids)) for ids in spelled_texts(batch.column(0))])
            offsets = np.arange(0, out.size + 1, WINDOW + 1, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), len(out), [None, pa.py_buffer(offsets), pa.py_buffer(out)])], names=["w"])

    windows = materialise(read.select("ids").mapInArrow(pick, "w binary"), "lm-windows")
    flat = model.flat
    for r in range(rounds):
        flat = average(windows, flat, model.prior, 0.02 / (1 + r))
    discard(windows)
    return replace(model, flat=flat)


def score_read(read: DataFrame, model: Model, words: DataFrame) -> DataFrame:
    """Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of what read_texts read, and discards that."""
    shipped = read.sparkSession.sparkContext.broadcast(replace(model, tokenizer=b"", hot={}))
    kept = ["uid", "doc_id", "held_out", "tkey", "n_tokens", "known", "base"]
    schema = ", ".join([x for x in READ.split(", ") if x.split()[0] in kept] + ["score double"])

    def run(batches):
        m = shipped.value
        odds = m.prior.odds()
        for batch in slices(batches):
            within, sequences = [], []
            for ids in spelled_texts(batch.column(len(kept))):
                sequences.append(m.of.take(ids))
                within.append(float(m.within.take(sequences[-1][:-1].astype(np.int32) * len(m.of) + ids[1:]).sum(dtype=float)))
            lp = score_sequences(m.flat, m.prior, sequences, odds=odds)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array((lp + np.array(within)) / LOG10, pa.float64())], names=[*kept, "score"])

    rows = materialise(read.select(*kept, "ids").mapInArrow(run, schema), "lm-scores")
    pairs = read.select("uid", F.inline(F.arrays_zip(F.col("cold").alias("word"), F.col("times").alias("tf"))).alias("word", "tf"))
    more = pairs.join(words, "word").select("uid", "tf", (F.col("tf") * F.log10((F.col("c") + 0.5) / 0.5)).alias("gain"))
    more = more.groupBy("uid").agg(F.sum("tf").alias("more"), F.sum("gain").alias("gain"))
    found = rows.join(more, "uid", "left").select(
        "doc_id", "held_out", "tkey", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"), (F.col("base") + F.coalesce("gain", F.lit(0.0))).alias("base"), "score",
    )
    found = materialise(found, "lm-found")
    discard(read, rows)
    # Sums of floats depend a little on what else is in a batch or a shuffle: copies of a text get the least of theirs.
    least = materialise(found.groupBy("tkey").agg(F.min("base").alias("base_score"), F.min("score").alias("score")), "lm-least")
    return found.drop("base", "score").join(least, "tkey").select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.n).cast("long").alias("train_tokens"), "base_score", "score")


def train(texts: DataFrame, tokenizer: str = TOKENIZER, rounds: int = 3) -> tuple[Model, DataFrame]:
    """The model, and the table of training words with their counts.  texts: a column text."""
    model, words = count_corpus(texts, tokenizer)
    read = read_texts(texts.select(F.lit(None).alias("doc_id"), F.lit(False).alias("held_out"), "text"), model)
    model = attend(model, read, rounds)
    discard(read)
    return model, words


def score(docs: DataFrame, model: Model, words: DataFrame) -> DataFrame:
    """docs: doc_id, text, held_out.  Returns what score_read does."""
    return score_read(read_texts(docs, model), model, words)


def score_documents(docs: DataFrame, tokenizer: str = TOKENIZER, modulus: int = 5) -> DataFrame:
    """Trains on the documents that aren't held out and scores all; both from one reading of the texts, after that which counts."""
    docs = docs.select("doc_id", "text", held_out(F.col("doc_id"), modulus).alias("held_out"))
    model, words = count_corpus(docs.filter("not held_out"), tokenizer)
    read = read_texts(docs, model)
    return score_read(read, attend(model, read.filter("not held_out")), words)
