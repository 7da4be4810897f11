"""Mixing sources to target weights: iterative proportional fitting, then calibrated sampling.

Tokens (runs of anything but ASCII white space) are counted by cell of source, language and topic.
Raking scales the cells' weights to each marginal's targets in turn until all agree.  A document is
then kept with its cell's probability, scaled so that the expected tokens are `fraction` of the
corpus; no cell can give more than it has, so raking holds every cell at its own tokens and lets the
others make up for it; where targets and budget can't both be met, the budget is, and the gaps that
remain are logged.  Raking that doesn't settle raises.  Keeping depends on a keyed hash of the document only, so it is repeatable.

Given targets are a mapping from value to share for each marginal; what they don't name goes into one
class, OTHER.  Without them, targets are `tempered` from the corpus: each value's share to a power, for
every value, OTHER being the nulls.  The cells that occur are raked as arrays on the driver, which must
hold them.

Topics, unless docs has a column `topic`, are the kind of writing by its form: table, list, loud
(mostly capitals), brief or prose.

Cases: null source, language or topic is the class OTHER.  A null or empty text has no tokens and is
never kept.  Repeated rows share their fate.  An empty table gives an empty result.  Columns
of docs that are named like the results (keep_probability, mix_weight, n_tokens) give way to them.  A target for a
value that no document has goes to the others in proportion.
"""

from __future__ import annotations

import itertools
import logging

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, free_names, materialise

LOG = logging.getLogger(__name__)
OTHER = "~other"
DIMENSIONS = ("source", "lang", "topic")
#: Powers of the corpus's shares that the production targets take.
POWERS = {"source": 0.5, "lang": 0.7, "topic": 1.0}
#: Probabilities of the cells go to every task up to this size; beyond, Spark joins by shuffle.
BROADCAST_BYTES = 64 << 20


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True


def count_tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, capitals (A-Z) and bytes of each text, from the batch's buffers at once."""
    own = pc.fill_null(column, "").cast(pa.binary())
    offsets = np.frombuffer(own.buffers()[1], np.int32)[own.offset : own.offset + len(own) + 1].astype(np.int64)
    data = np.frombuffer(own.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    at, sizes = offsets[:-1] - offsets[0], np.diff(offsets)
    space = _SPACE[data]
    starts = ~space
    starts[1:] &= space[:-1]
    full = sizes > 0
    starts[at[full]] = ~space[at[full]]
    out = np.zeros((2, len(own)), np.int64)
    for row, flags in enumerate((starts, _CAPITAL[data])):
        if full.any():
            out[row, full] = np.add.reduceat(flags, at[full], dtype=np.int64)
    return out[0], out[1], sizes


def forms(column: pa.Array, capitals: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    has = lambda s: pc.fill_null(pc.match_substring(column, s), False).to_numpy(zero_copy_only=False)
    return np.select([has("\n| "), has("\n- ") | has("\n* "), capitals * 2 > sizes, sizes < 500], ["table", "list", "loud", "brief"], "prose")


@F.arrow_udf(T.StructType([T.StructField("tokens", T.LongType()), T.StructField("form", T.StringType())]))
def measured(column: pa.Array) -> pa.Array:
    """Tokens and form of each text; only texts go to Python and back come numbers."""
    tokens, capitals, sizes = count_tokens(column)
    return pa.StructArray.from_arrays([pa.array(tokens), pa.array(forms(column, capitals, sizes), pa.string())], names=["tokens", "form"])


def prepared(docs: DataFrame, names: list[str]) -> DataFrame:
    """docs with the tokens and the three classes, as columns of the given names."""
    found = names[0]
    topic = F.col("topic").cast("string") if "topic" in docs.columns else F.col(found)["form"]
    classes = [F.coalesce(c, F.lit(OTHER)) for c in (F.col("source").cast("string"), F.col("lang").cast("string"), topic)]
    once = measured.asNondeterministic()  # else filters on its results move below it, and it runs for each
    return docs.withColumn(found, once("text")).withColumns(dict(zip(names[1:], classes, strict=True))).withColumn(found, F.col(found)["tokens"])


def tempered(sides: list[tuple[np.ndarray, list[str]]], have: np.ndarray, powers: dict[str, float] = POWERS) -> dict[str, dict[str, float]]:
    """Targets from the corpus for every value of each dimension.  sides: each dimension's value number by cell, and values."""
    targets = {}
    for name, (of, values) in zip(DIMENSIONS, sides, strict=True):
        shares = (np.bincount(of, have, len(values)) / have.sum()) ** powers.get(name, 1.0)
        targets[name] = dict(zip(values, (shares / shares.sum()).tolist(), strict=True))
    return targets


def rake(cells: dict[tuple, float], targets: dict[str, dict[str, float]], fraction: float, sweeps: int = 500, tolerance: float = 1e-9) -> dict[tuple, float]:
    """Each cell's share of its tokens to keep, in [0, 1]."""
    keys = sorted(cells)
    if not keys:
        return {}
    coded = [np.unique([k[d] for k in keys], return_inverse=True) for d in range(len(DIMENSIONS))]
    w = raked([(of, values.tolist()) for values, of in coded], np.array([cells[k] for k in keys], float), targets, fraction, sweeps, tolerance)
    return dict(zip(keys, w.tolist(), strict=True))


def raked(coded: list[tuple[np.ndarray, list[str]]], have: np.ndarray, targets: dict[str, dict[str, float]], fraction: float, sweeps: int = 500, tolerance: float = 1e-9, unsettled: float = 1e-3) -> np.ndarray:
    """As rake, of cells given by their tokens and, as for tempered, by their values.

    Logs how far the result is from the targets.  Raises if a cell still moved by more than `unsettled` of the budget in the last sweep.
    """
    want = have.sum() * fraction
    sides = []
    for name, (of, values) in zip(DIMENSIONS, coded, strict=True):
        goal = np.array([targets[name].get(v, 0.0) for v in values])
        sides.append((of, goal / goal.sum() * want if goal.sum() else np.bincount(of, have) * fraction, len(values)))

    def filled(w):
        """What is missing to the budget comes from the cells that have more, in proportion."""
        for _ in range(len(w) + 1):
            missing, free = want - w.sum(), w < have
            if missing <= tolerance * want or not w[free].sum() > 0:
                break
            w = np.where(free, np.minimum(have, w * (1 + missing / w[free].sum())), w)
        return w

    w = have * fraction
    for _ in range(sweeps):
        before = w
        for of, goal, n in sides:
            got = np.bincount(of, w, n)
            w = np.minimum(have, w * (goal / np.where(got > 0, got, 1))[of])
        w = filled(w)
        if np.abs(w - before).max() <= tolerance * want:
            break
    moved = np.abs(w - before).max() / max(want, 1e-300) if sweeps else np.inf
    if moved > unsettled:
        raise RuntimeError(f"raking did not settle: {sweeps} sweeps, and cells still move by {moved:.2g} of the budget")
    gaps = {name: float(np.abs(np.bincount(of, w, n) - goal).max() / max(want, 1e-300)) for name, (of, goal, n) in zip(DIMENSIONS, sides, strict=True)}
    LOG.info("raked %d cells; largest gaps to the targets, as shares of the budget: %s", len(have), gaps)
    return np.divide(w, have, out=np.zeros_like(w), where=have > 0)


def mix(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, fraction: float = 0.5, seed: int = 42) -> DataFrame:
    """The sampled documents: the columns of docs, and keep_probability, mix_weight (1 / probability) and n_tokens."""
    spark = docs.sparkSession
    own = [c for c in docs.columns if c not in ("keep_probability", "mix_weight", "n_tokens")]
    names = tokens, *classes = free_names(docs.columns, "tokens", "class_source", "class_lang", "class_topic")
    *keys, p_keep = free_names([*docs.columns, *names], "key_source", "key_lang", "key_topic", "p_keep")
    read = [c for c in ("text", "source", "lang", "topic") if c in docs.columns]
    narrow = materialise(prepared(docs.select(read), names).groupBy(*classes).agg(F.sum(tokens).alias(tokens)), "mix-cells")
    as_key = lambda name, c: F.col(c) if targets is None else F.when(F.col(c).isin(list(targets[name])), F.col(c)).otherwise(F.lit(OTHER))
    of = [as_key(d, c).alias(k) for d, c, k in zip(DIMENSIONS, classes, keys, strict=True)]
    cells = narrow.groupBy(*of).agg(F.sum(tokens).alias("n")).filter("n > 0").toArrow().sort_by([(k, "ascending") for k in keys])
    discard(narrow)
    columns, have = [cells.column(k).combine_chunks() for k in keys], cells.column("n").to_numpy().astype(float)
    coded = [(c.indices.to_numpy(), c.dictionary.to_pylist()) for c in map(pc.dictionary_encode, columns)]
    p = raked(coded, have, targets or tempered(coded, have), fraction) if len(have) else have
    table = spark.createDataFrame(pa.table({**dict(zip(keys, columns, strict=True)), p_keep: pa.array(p, pa.float64())}))
    table = F.broadcast(table) if cells.nbytes <= BROADCAST_BYTES else table
    unit = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")), F.lit(seed)), F.lit(1 << 52)) / float(1 << 52)
    named = prepared(docs, names).filter(F.col(tokens) > 0).withColumns({k: as_key(d, c) for d, c, k in zip(DIMENSIONS, classes, keys, strict=True)})
    kept = named.join(table, keys).filter(unit < F.col(p_keep))
    return kept.select(*own, F.col(p_keep).alias("keep_probability"), (1 / F.col(p_keep)).alias("mix_weight"), F.col(tokens).alias("n_tokens"))


def expected(cells: dict[tuple, float], shares: dict[tuple, float], dimension: int) -> dict[str, float]:
    """Expected share of the kept tokens by value of one dimension."""
    kept = {k: cells[k] * shares[k] for k in cells}
    whole = sum(kept.values())
    return {v: sum(x for _, x in g) / whole for v, g in itertools.groupby(sorted(((k[dimension], n) for k, n in kept.items())), key=lambda x: x[0])}
