"""Secret scans: fixed rules, and a character convolutional network over every other candidate.

The rules find assignments, access keys and long hexadecimal runs; their spans always stand.  Every
other candidate (a long token with a digit and a letter, or of a known shape) is read by the network
together with its context; it adds a span of kind `net` where the calibrated probability reaches the
threshold.  The network is trained in numpy on labelled findings that `labelled` generates (secrets
and look-alikes in prose, configuration and code); Platt scaling calibrates it on findings it hasn't
seen, and the threshold is the highest whose recall on them is at least `recall`.

Cases: a null text is empty and has no spans.  Whole texts are read, however long; a candidate longer
than LENGTH characters is read by overlapping windows, and as what stands between its separators, the
highest probability counts and the span covers all.  Repeated rows are scanned one by one.  Other columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "net")
# The rules.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the runs of [0-9a-f]+ that are long enough
SHAPE = r"(?<![A-Za-z0-9])(?:ghp_|gho_|glpat-|sk-|sk_live_|xoxb-|SG\.|AIza|npm_|eyJ)[A-Za-z0-9_-]{12}"
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=.-])(?:(?=[A-Za-z+/_=.-]*[0-9])(?=[0-9+/_=.-]*[A-Za-z])|(?=[A-Za-z+/_=.-]*" + SHAPE + r"))[A-Za-z0-9+/_=.-]{16,}")
PART = re.compile(r"[A-Za-z0-9+_-]{16,}")
#: Texts without this have no span (RE2, so in time linear in the text).
QUICK = r"(?i:password|passwd|secret|token|api_?key)|AKIA|[A-Za-z0-9+/_=.-]{16}"

SIDE, LENGTH, FILTERS, SPAN, EMBED = 20, 64, 24, 5, 8
#: Windows of a long candidate start so many characters apart, so any secret of up to LENGTH - STEP is whole in one.
STEP = 16
TOTAL = 2 * SIDE + LENGTH


def rule_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end), sorted."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def encode(text: str, start: int, end: int) -> np.ndarray:
    """Character codes of the left context, the candidate and the right context, each padded to its width with 0; codes of the candidate's characters are over 97."""
    code = lambda s: [ord(c) - 30 if 32 <= ord(c) < 127 else 1 for c in s]
    left, own, right = code(text[max(0, start - SIDE) : start]), code(text[start : min(end, start + LENGTH)]), code(text[end : end + SIDE])
    return np.array([0] * (SIDE - len(left)) + left + [c + 97 for c in own] + [0] * (LENGTH - len(own)) + right + [0] * (SIDE - len(right)), np.int64)


@dataclass
class Network:
    embed: np.ndarray
    conv: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    scale: tuple[float, float] = (1.0, 0.0)
    threshold: float = 0.5

    def hidden(self, x: np.ndarray):
        e = self.embed[x]
        patches = np.lib.stride_tricks.sliding_window_view(e, SPAN, axis=1).transpose(0, 1, 3, 2).reshape(len(x), TOTAL - SPAN + 1, SPAN * EMBED)
        z = np.maximum(patches @ self.conv + self.bias, 0)
        pooled = np.concatenate([z.max(axis=1), z.mean(axis=1), np.ones((len(x), 1), np.float32)], axis=1)
        return patches, z, pooled

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.hidden(x)[2] @ self.out

    def probability(self, x: np.ndarray, chunk: int = 512) -> np.ndarray:
        parts = [1 / (1 + np.exp(-(self.scale[0] * self.logit(x[at : at + chunk]) + self.scale[1]))) for at in range(0, len(x), chunk)]
        return np.concatenate(parts) if parts else np.zeros(0)


def labelled(n: int, seed: int) -> tuple[list[tuple[str, int, int]], np.ndarray]:
    """n labelled findings: (text, start, end) and 1 for a secret, 0 for a look-alike."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    draw = lambda chars, k: "".join(chars[i] for i in rng.integers(0, len(chars), k))
    lower, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    alnum = lower + lower.upper() + digits
    syllables = "an be ch de en er es for ge ha in ing ion ite ko la le lich ment mo nd on ou pre que re ro st ter tion th ti un ver wh za".split()
    word = lambda k=3: "".join(pick(syllables) for _ in range(int(rng.integers(1, k + 1))))
    prose = lambda k: " ".join(word() for _ in range(k))
    secrets = [
        lambda: draw(alnum, int(rng.integers(20, 65))), lambda: draw(alnum + "+/", int(rng.integers(5, 16)) * 4 - 1) + "=", lambda: draw("0123456789abcdef", int(rng.integers(16, 65))),
        lambda: draw("0123456789ABCDEF", pick([32, 40, 64])), lambda: pick(["ghp_", "gho_", "glpat-", "sk-", "sk_live_", "xoxb-", "SG.", "AIza", "npm_"]) + draw(alnum + "_-", int(rng.integers(20, 41))),
        lambda: "eyJ" + draw(alnum, 17) + "." + draw(alnum + "_-", 30) + "." + draw(alnum + "_-", 20), lambda: "AKIA" + draw(lower.upper() + digits, 16), lambda: draw(alnum + "_-", int(rng.integers(24, 50))),
    ]
    plain = [
        lambda: "-".join(word() for _ in range(4)) + "-" + draw(digits, 2), lambda: "_".join(word() for _ in range(4)) + draw(digits, 1), lambda: f"{word()}.{word()}{draw(digits, 1)}.example.{pick(['com', 'org', 'net'])}",
        lambda: f"/{word()}/{word()}/{word()}{draw(digits, 2)}.{pick(['html', 'png', 'txt', 'py'])}", lambda: f"20{draw(digits, 2)}-{draw(digits, 2)}-{draw(digits, 2)}T{draw(digits, 2)}", lambda: word(6) + word(6) + draw(digits, int(rng.integers(1, 3))),
        lambda: f"{word()}-{draw(digits, 1)}.{draw(digits, 1)}.{draw(digits, 2)}-{word()}.{pick(['tar', 'whl', 'jar', 'zip'])}", lambda: draw("=-._", 1) * 17 + draw(digits, 1) + word(), lambda: draw(digits, 16) + word(1), lambda: f"{word()}={draw(digits, 3)}/{word()}={draw(digits, 2)}/{word()}",
        lambda: word().title() + word().title() + word().title() + word().title() + draw(digits, 1), lambda: f"{word()}...{word()}...{word()}{draw(digits, 1)}",
    ]
    before = [lambda: prose(4) + " ", lambda: pick(["key: ", "auth=", "Bearer ", "credential = '", '"private": "', "pwd ", "export KEY=", "x-auth: "]), lambda: prose(2) + "\n", lambda: ""]
    around = [lambda: prose(4) + " ", lambda: prose(3) + "\n", lambda: pick(["see ", "in ", "file ", "http://", "mail a@", "from "]), lambda: ""]
    out, y = [], rng.integers(0, 2, n)
    for label in y:
        head = (pick(before) if label else pick(around))()
        own = (pick(secrets) if label else pick(plain))()
        own += draw(lower, max(0, 16 - len(own)))
        out.append((head + own + pick([" ", "\n", '"', "'", ". ", ""]) + prose(3), len(head), len(head) + len(own)))
    return out, y


def fit(n: int = 4000, epochs: int = 6, recall: float = 0.99, seed: int = 3, batch: int = 64) -> Network:
    found, y = labelled(n + n // 2, seed)
    x = np.array([encode(*f) for f in found])
    rng = np.random.default_rng(seed)
    shape = lambda *s: rng.normal(0, (2 / s[0]) ** 0.5, s).astype(np.float32)
    net = Network(rng.normal(0, 0.5, (200, EMBED)).astype(np.float32), shape(SPAN * EMBED, FILTERS), np.zeros(FILTERS, np.float32), (rng.normal(0, 0.1, 2 * FILTERS + 1)).astype(np.float32))
    weights = [net.embed, net.conv, net.bias, net.out]
    m, v = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    t = 0
    for _ in range(epochs):
        order = rng.permutation(n)
        for at in range(0, n, batch):
            t += 1
            i = order[at : at + batch]
            patches, z, pooled = net.hidden(x[i])
            g = ((1 / (1 + np.exp(-pooled @ net.out)) - y[i]) / len(i)).astype(np.float32)
            d_pool = g[:, None] * net.out[None]
            dz = np.repeat(d_pool[:, None, FILTERS : 2 * FILTERS] / z.shape[1], z.shape[1], axis=1)
            rows, cols = np.ogrid[: len(i), :FILTERS]
            dz[rows, z.argmax(axis=1), cols] += d_pool[:, :FILTERS]
            dz *= z > 0
            d_patch = (dz @ net.conv.T).reshape(len(i), -1, SPAN, EMBED)
            d_embed = np.zeros_like(net.embed)
            for k in range(SPAN):
                np.add.at(d_embed, x[i][:, k : k + d_patch.shape[1]], d_patch[:, :, k])
            grads = [d_embed, patches.reshape(-1, SPAN * EMBED).T @ dz.reshape(-1, FILTERS), dz.sum(axis=(0, 1)), pooled.T @ g]
            for w, gr, a, b in zip(weights, grads, m, v, strict=True):
                a += 0.1 * (gr - a)
                b += 0.01 * (gr * gr - b)
                w -= 0.005 * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.99**t)) + 1e-8)
    logit, seen = np.concatenate([net.logit(x[at : at + 512]) for at in range(n, len(x), 512)]), y[n:]
    a, b = 1.0, 0.0
    for _ in range(300):  # Platt scaling
        p = 1 / (1 + np.exp(-(a * logit + b)))
        a -= 0.05 * float(((p - seen) * logit).mean())
        b -= 0.05 * float((p - seen).mean())
    net.scale = (a, b)
    positive = np.sort(1 / (1 + np.exp(-(a * logit[seen == 1] + b))))
    net.threshold = float(positive[int(np.floor((1 - recall) * len(positive)))]) if len(positive) else 0.5
    return net


def candidates(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Candidates that overlap no rule's span."""
    ends = sorted((s, e) for s, _, e in spans)
    starts = [s for s, _ in ends]
    out = []
    for m in CANDIDATE.finditer(text):
        i = bisect.bisect_left(starts, m.end())
        if not any(e > m.start() for _, e in ends[:i]):
            out.append((m.start(), m.end()))
    return out


def views(text: str, start: int, end: int):
    """(start, end) of all that the network reads of a candidate: the whole, or windows and the parts between separators."""
    if end - start <= LENGTH:
        yield start, end
        return
    for at in range(start, end - LENGTH + STEP, STEP):
        yield min(at, end - LENGTH), min(at, end - LENGTH) + LENGTH
    for m in PART.finditer(text, start, end):
        if len(m[0]) <= LENGTH and CANDIDATE.match(m[0]):
            yield m.span()


def find(texts: list[str], net: Network) -> list[list[tuple[int, int, int]]]:
    """Each text's spans (start, kind number, end), sorted: the rules' and the network's."""
    found = [rule_spans(t) for t in texts]
    asked = ((i, c, v) for i, t in enumerate(texts) for c in candidates(t, found[i]) for v in views(t, *c))
    secret = set()
    while part := list(itertools.islice(asked, 2048)):
        for (i, c, _), p in zip(part, net.probability(np.array([encode(texts[i], *v) for i, _, v in part])), strict=True):
            if p >= net.threshold:
                secret.add((i, *c))
    for i, s, e in secret:
        found[i].append((s, 3, e))
    return [sorted(f) for f in found]


def scan_batch(column: pa.Array, net: Network) -> tuple[list[str], list[list[tuple[int, int, int]]]]:
    """The texts that may hold a span, at their places (others: empty), and all spans."""
    column = pc.fill_null(column, "")
    maybe = pc.match_substring_regex(column, QUICK).to_pylist()
    texts = column.filter(pa.array(maybe)).to_pylist()
    spans = iter(find(texts, net))
    kept = iter(texts)
    return [next(kept) if x else "" for x in maybe], [next(spans) if x else [] for x in maybe]


def shown(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame, net: Network | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_net, base_sha256, spans."""
    shipped = docs.sparkSession.sparkContext.broadcast(net or fit())

    def run(batches):
        for batch in batches:
            _, found = scan_batch(batch.column(1), shipped.value)
            count = lambda k: pa.array([sum(x[1] == k for x in f) for f in found], pa.int64())  # noqa: E731, B023
            base = [hashlib.sha256(shown([x for x in f if x[1] < 3]).encode()).hexdigest() for f in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(count, range(4)), pa.array(base, pa.string()), pa.array([shown(f) for f in found], pa.string())], names=["doc_id", "n_assign", "n_access", "n_hex", "n_net", "base_sha256", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, n_net long, base_sha256 string, spans string")


def mask(text: str, spans, by: str = "[SECRET]") -> str:
    """The text with every span replaced; spans that overlap are replaced as one."""
    out, at, last = [], 0, -1
    for s, _, e in spans:
        if s >= at:
            out += [text[at:s], by]
            at = e
        else:
            at = max(at, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, net: Network | None = None) -> DataFrame:
    """docs with the secrets in text masked, and n_chars, if there, counted anew; rows without secrets are as they were."""
    shipped = docs.sparkSession.sparkContext.broadcast(net or fit())
    names = docs.columns

    def run(batches):
        for batch in batches:
            texts = batch.column(names.index("text"))
            kept, found = scan_batch(texts, shipped.value)
            columns = {c: batch.column(i) for i, c in enumerate(names)}
            if any(found):
                old = texts.to_pylist()
                new = [mask(t, f) if f else o for o, t, f in zip(old, kept, found, strict=True)]
                columns["text"] = pa.array(new, pa.string())
                if "n_chars" in columns:
                    counts = columns["n_chars"].to_pylist()
                    columns["n_chars"] = pa.array([len(t) if f else c for t, f, c in zip(new, found, counts, strict=True)], columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays([columns[c].cast(texts.type) if c == "text" else columns[c] for c in names], names=names)

    return docs.mapInArrow(run, docs.schema)
