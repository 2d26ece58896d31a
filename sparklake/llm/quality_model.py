"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature has a lookup table over its bins, learnt by cyclic boosting: in every round
each feature in turn gets a shallow tree of the current residuals, scaled by a small
rate.  Then the pairs of features that explain most of what is left get tables of their
own in the same way.  A score is the logistic of a sum of table entries, looked up for a whole batch at once.

Features are statistics of the text alone; one pass over the texts gives them, and all
later work is on that narrow table.  The model is fitted in the driver on at most ``MOST_ROWS``
labelled rows, those with the smallest hash of their id: a stated bound, so the fit does not grow with
the input.  Scoring covers every row.

Defined results: null text counts as empty; empty texts have all-zero features and a
score as any other; null labels are not learnt from, several labels of one id count
each; repeated rows score alike; without labels every score is 0.5; an empty
table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field as attribute
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparklake.llm.common import field, save, ship
from sparklake.llm.pieces import sliced

FEATURES = ["log_words", "word_length", "symbols", "capitals", "exclaims", "digits", "stops", "other_marks", "non_ascii",
            "lone_symbols", "equal_neighbours", "distinct_words", "line_words", "repeated_lines", "short_words"]
MOST_ROWS = 20_000
#: Standard deviations by which the share of hashes is wider than needed.
SLACK = 6
BINS = 32
PAIR_BINS = 8
ROUNDS, PAIR_ROUNDS, PAIRS = 250, 60, 8
RATE = 0.1
LEAVES = 4
LEAST_WEIGHT = 2.0  # of a leaf, in units of the second derivative
SMOOTH = 1.0

_CLASS = np.zeros(256, np.int64)
for _i, _chars in enumerate((b"#*$%&|<>", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"!", b"0123456789", b".,;:?", b"\"'()[]{}=/\\-_+~^@`"), 1):
    _CLASS[list(_chars)] = _i
_CLASS[128:] = 7
_CLASS[[9, 10, 11, 12, 13, 32]] = 8


def features(text: str | None) -> list[float]:
    """The FEATURES of a text."""
    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    by_class = np.bincount(_CLASS, np.bincount(np.frombuffer(raw, np.uint8), minlength=256), 9)
    visible = len(raw) - by_class[8]
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    alone = sum(1 for w in words if len(w) < 3 and not w.isalnum() and w[0] < 128)
    return [float(np.log1p(n)), visible / n, *(by_class[1:8] / visible), alone / n,
            sum(map(bytes.__eq__, words, words[1:])) / n, len(set(words)) / n ** 0.8, float(np.log1p(n / len(lines))),
            1 - len(set(lines)) / len(lines), float((lengths <= 3).mean())]


def with_features(docs: DataFrame) -> DataFrame:
    """(doc_id, x) of every row: x is the array of FEATURES."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            x = np.array([features(t) for t in b.column("text").to_pylist()], np.float64).reshape(-1, len(FEATURES))
            ends = pa.array(np.arange(0, x.size + 1, len(FEATURES), dtype=np.int32))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.ListArray.from_arrays(ends, pa.array(x.ravel()))],
                                             names=["doc_id", "x"])

    rows = docs.select("doc_id", field(docs, "text").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, x array<double>")


@dataclass
class Model:
    """Bin edges by feature, tables by feature and by pair of features."""

    base: float
    edges: list[np.ndarray] = attribute(default_factory=list)
    tables: list[np.ndarray] = attribute(default_factory=list)
    pair_edges: list[np.ndarray] = attribute(default_factory=list)
    pairs: list[tuple[int, int]] = attribute(default_factory=list)
    pair_tables: list[np.ndarray] = attribute(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for j, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[j], x[:, j], "right")]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[np.searchsorted(self.pair_edges[a], x[:, a], "right"),
                           np.searchsorted(self.pair_edges[b], x[:, b], "right")]
        return 1 / (1 + np.exp(-total))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    """Cuts at quantiles; a value with many rows gets a bin of its own."""
    q = np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], method="lower")
    return np.unique(np.concatenate([q, np.nextafter(q, np.inf)]))


def _gain(g, h):
    return g * g / (h + SMOOTH)


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Step values by bin of a tree of up to LEAVES leaves over one feature's bins."""
    cuts, leaves = [], [(0, len(g))]
    while len(leaves) < LEAVES:
        best = (1e-9, None, None)
        for lo, hi in leaves:
            gl, hl = np.cumsum(g[lo:hi])[:-1], np.cumsum(h[lo:hi])[:-1]
            gt, ht = g[lo:hi].sum(), h[lo:hi].sum()
            gain = np.where((hl >= LEAST_WEIGHT) & (ht - hl >= LEAST_WEIGHT), _gain(gl, hl) + _gain(gt - gl, ht - hl) - _gain(gt, ht), 0)
            if len(gain) and gain.max() > best[0]:
                best = (gain.max(), (lo, hi), lo + int(gain.argmax()) + 1)
        if best[1] is None:
            break
        leaves.remove(best[1])
        leaves += [(best[1][0], best[2]), (best[2], best[1][1])]
        cuts.append(best[2])
    out = np.zeros(len(g))
    for lo, hi in leaves:
        out[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + SMOOTH)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and step values of the best cut of one feature with a cut of the other on either side."""
    whole = _gain(g.sum(), h.sum())
    best = (0.0, np.zeros_like(g))
    for turned in (False, True):
        gg, hh = (g.T, h.T) if turned else (g, h)
        for cut in range(1, len(gg)):
            value, gain, fits = np.zeros_like(gg), -whole, True
            for rows in (slice(0, cut), slice(cut, None)):
                gs, hs = gg[rows].sum(0), hh[rows].sum(0)
                gl, hl = np.cumsum(gs)[:-1], np.cumsum(hs)[:-1]
                if hs.sum() < LEAST_WEIGHT:
                    fits = False
                    break
                part = _gain(gl, hl) + _gain(gs.sum() - gl, hs.sum() - hl)
                at = int(part.argmax()) + 1 if len(part) else 0
                gain += max(part.max(initial=-1.0), _gain(gs.sum(), hs.sum()))
                value[rows, :at] = gs[:at].sum() / (hs[:at].sum() + SMOOTH)
                value[rows, at:] = gs[at:].sum() / (hs[at:].sum() + SMOOTH)
            if fits and gain > best[0]:
                best = (gain, value.T if turned else value)
    return best


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting on rows x with labels y (0 or 1)."""
    if not len(y):
        return Model(0.0)
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = Model(float(np.log(share / (1 - share))))
    model.edges = [_edges(x[:, j], BINS) for j in range(x.shape[1])]
    model.pair_edges = [_edges(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    bins = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.edges)]
    total = np.full(len(y), model.base)

    def residuals() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j, b in enumerate(bins):
            g, h = residuals()
            step = RATE * _tree(*(np.bincount(b, v, len(model.tables[j])) for v in (g, h)))
            model.tables[j] += step
            total += step[b]
    coarse = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.pair_edges)]
    sizes = [len(e) + 1 for e in model.pair_edges]

    def cells(a: int, b: int) -> list[np.ndarray]:
        flat = coarse[a] * sizes[b] + coarse[b]
        return [np.bincount(flat, v, sizes[a] * sizes[b]).reshape(sizes[a], sizes[b]) for v in residuals()]

    ranked = sorted(combinations(range(x.shape[1]), 2), key=lambda p: -_pair_tree(*cells(*p))[0])
    model.pairs = ranked[:PAIRS]
    model.pair_tables = [np.zeros((sizes[a], sizes[b])) for a, b in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (a, b) in enumerate(model.pairs):
            step = RATE * _pair_tree(*cells(a, b))[1]
            model.pair_tables[k] += step
            total += step[coarse[a], coarse[b]]
    return model


def held_out():
    """Whether a document is kept from learning: crc32 of its id as text leaves 1 by 3."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def training_sample(rows: DataFrame, labels: DataFrame, most: int = MOST_ROWS) -> DataFrame:
    """(x, quality): at most ``most`` different labelled rows that are not held out, by a hash of id and statistics.

    Rows whose hash lies above the share that is needed (and SLACK more) go before anything is ordered, so that about
    ``most`` rows are gathered, however many there are and however they are partitioned.
    """
    known = labels.where("quality IS NOT NULL").select("doc_id", "quality").where(~held_out()).distinct()
    found = rows.select("doc_id", "x").where(~held_out()).join(known, "doc_id").distinct()
    found = save(found.withColumn("hash", F.xxhash64("doc_id", "x", "quality")), "quality_labelled")
    share = min(1.0, (most + SLACK * most ** 0.5) / max(found.count(), 1))
    near = found.where(F.col("hash").bitwiseAND(F.lit(2**53 - 1)) < int(share * 2**53))
    return near.orderBy(F.col("hash").bitwiseAND(F.lit(2**53 - 1)), "hash", "doc_id", "quality", "x").limit(most).select("x", "quality")


def training_rows(rows: DataFrame, labels: DataFrame, most: int = MOST_ROWS) -> tuple[np.ndarray, np.ndarray]:
    picked = training_sample(rows, labels, most).toPandas()
    x = np.array(picked["x"].tolist(), np.float64).reshape(-1, len(FEATURES))
    return x, picked["quality"].to_numpy(np.float64)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    rows = save(with_features(docs), "quality_features")
    model = docs.sparkSession.sparkContext.broadcast(fit(*training_rows(rows, labels)))  # some KB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(model.value.score(x))],
                                             names=["doc_id", "held_out", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.select("doc_id", held_out().alias("held_out"), "x").mapInArrow(run, f"doc_id {kind}, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
