"""Toxicity: a sparse linear classifier on words, regularised by counterfactual swaps of identity terms.

A text's features are the distinct words it holds, hashed. Training minimises
the log loss with an L1 penalty (most words weigh nothing) and a counterfactual
penalty: each labelled text that names a group is compared with its twins, in
which the name is another group's or a neutral one, and the squared change of
the score's logit is added to the loss. A group's name then cannot carry the
verdict by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.bytewise import LOWER, text_slices, word_hashes
from loanloom.llm.tables import crc_mod, texts

BITS = 20
GAP = np.ones(256, bool)
GAP[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False

# Words that name groups, by kind, each kind with neutral words at its end.
IDENTITY = [
    "women men girls boys people persons".split(),
    "woman man girl boy person human".split(),
    "muslims christians jews hindus buddhists atheists believers people".split(),
    "muslim christian jewish hindu buddhist atheist religious".split(),
    "gay lesbian bisexual straight queer transgender human".split(),
    "black white asian african european latino hispanic local".split(),
    "immigrants refugees migrants foreigners citizens residents people".split(),
    "immigrant refugee migrant foreigner citizen resident person".split(),
    "disabled blind deaf elderly old young human".split(),
    "americans germans mexicans chinese indians turks arabs people".split(),
    "frauen männer leute menschen".split(),
    "muslime christen juden ausländer flüchtlinge leute menschen".split(),
    "femmes hommes gens personnes".split(),
    "musulmans chrétiens juifs étrangers immigrés gens".split(),
    "mujeres hombres gente personas".split(),
    "musulmanes cristianos judíos extranjeros inmigrantes gente".split(),
]


@dataclass
class Params:
    """Settings; at most about ``rows`` labelled documents are learned from."""

    rows: int = 20_000
    least_docs: int = 4
    least_gap: float = 4.0
    l1: float = 4e-5
    swap: float = 1.0
    steps: int = 200
    seed: int = 11


@dataclass
class Model:
    words: np.ndarray    # cells with a weight
    weight: np.ndarray
    bias: float


def _cells(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(64 - BITS)).astype(np.int64)


def _cell_of(word: str) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    return int(_cells(word_hashes(data, np.array([0, len(data)]), GAP[LOWER[data]])[0])[0])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, y) -> (doc_id, y, distinct word cells)."""
    for batch in batches:
        for lo, hi, offs, data in text_slices(batch.column(1)):
            words, of_text = word_hashes(data, offs, GAP[data])
            cells = _cells(words).astype(np.uint32)
            yield pa.RecordBatch.from_arrays([
                batch.column(0)[lo:hi], batch.column(2)[lo:hi],
                pa.array([np.unique(cells[a:b]).tobytes() for a, b in zip(of_text[:-1], of_text[1:], strict=True)],
                         pa.binary())], ["doc_id", "y", "x"])


def fit(rows: list[np.ndarray], y: np.ndarray, p: Params) -> Model:
    """Accelerated proximal descent on log loss + L1 + counterfactual penalty; rows hold distinct cells."""
    if not len(y):
        return Model(np.zeros(0, np.int64), np.zeros(0), 0.0)
    flat = np.concatenate(rows).astype(np.int64)
    seen = np.bincount(flat, minlength=1 << BITS)
    # words that are about as frequent in either class are left out; names of groups stay in
    toxic = np.bincount(np.concatenate([r for r, t in zip(rows, y, strict=True) if t] or [flat[:0]]).astype(np.int64),
                        minlength=1 << BITS)
    n1 = max(y.sum(), 1.0)
    n0 = max(len(y) - y.sum(), 1.0)
    mean = (seen + 1) / (len(y) + 2)
    apart = np.abs(toxic / n1 - (seen - toxic) / n0) / np.sqrt(mean * (1 - mean) * (1 / n1 + 1 / n0))
    apart[[_cell_of(w) for kind in IDENTITY for w in kind]] = np.inf
    used = np.flatnonzero((seen >= min(p.least_docs, max(1, len(y) // 4))) & (apart >= p.least_gap))
    index = np.full(1 << BITS, -1)
    index[used] = np.arange(len(used))
    row = np.repeat(np.arange(len(y)), [len(r) for r in rows])
    ok = index[flat] >= 0
    col, row, m, n = index[flat[ok]], row[ok], len(used), len(y)
    # twins: one name out, another of its kind in
    swaps: dict[tuple[int, int], int] = {}
    for kind in IDENTITY:
        cells = [_cell_of(w) for w in kind]
        for a in cells[:-1]:
            if seen[a] and index[a] >= 0:
                for b in cells:
                    if b != a:
                        swaps[a, b] = swaps.get((a, b), 0) + int(seen[a])
    out = np.array([index[a] for a, _ in swaps], np.int64)
    into = np.array([index[b] for _, b in swaps], np.int64)
    share = np.array(list(swaps.values()), float) / max(1, sum(swaps.values()))
    w, b = np.zeros(m), float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    v, vb, t = w.copy(), b, 1.0

    def objective(w, b):
        z = np.bincount(row, w[col], n) + b
        gap = w[out] - np.where(into >= 0, w[into], 0.0) if len(out) else np.zeros(0)
        return z, gap, float(np.logaddexp(0, z).mean() - (y * z).mean() + p.swap * (share * gap * gap).sum())

    rate = 4.0
    for _ in range(p.steps):
        z, gap, now = objective(v, vb)
        err = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) / n
        g, gb = np.bincount(col, err[row], m), err.sum()
        if len(out):
            np.add.at(g, out, 2 * p.swap * share * gap)
            np.add.at(g, into[into >= 0], -2 * p.swap * (share * gap)[into >= 0])
        while True:
            step = v - rate * g
            new = np.sign(step) * np.maximum(np.abs(step) - rate * p.l1, 0)
            nb = vb - rate * gb
            d, db = new - v, nb - vb
            if objective(new, nb)[2] <= now + g @ d + gb * db + (d @ d + db * db) / (2 * rate) + 1e-12 or rate < 1e-6:
                break
            rate /= 2
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = new + (t - 1) / t2 * (new - w), nb + (t - 1) / t2 * (nb - b)
        w, b, t = new, nb, t2
        rate *= 1.2
    keep = np.flatnonzero(w)
    return Model(used[keep], w[keep], b)


def train(docs: DataFrame, labels: DataFrame, params: Params | None = None) -> Model:
    """Learn ``labels.toxic`` from the labelled rows of ``docs`` (both may be narrowed beforehand).

    Labels are drawn by a hash of the id to at most about ``params.rows``; of
    repeated labels of a document the highest counts.
    """
    p = params or Params()
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("y"))
    scale = 1 << 30
    limit = int(scale * min(1.0, p.rows / max(1, known.count())))
    drawn = known.where(F.pmod(F.xxhash64("doc_id", F.lit(p.seed)), F.lit(scale)) < limit)
    rows = texts(docs).join(F.broadcast(drawn), "doc_id").select("doc_id", "text", "y")
    got = sorted(tuple(r) for r in rows.mapInArrow(_features, "doc_id long, y int, x binary").collect())
    return fit([np.frombuffer(bytes(r[2]), np.uint32) for r in got], np.array([float(r[1] > 0) for r in got]), p)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1) of every row; a text without words has the score of the bias."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << BITS)
        table[model.words] = model.weight
        for batch in batches:
            for lo, hi, offs, data in text_slices(batch.column(1)):
                words, of_text = word_hashes(data, offs, GAP[data])
                cells = _cells(words)
                hit = np.flatnonzero(table[cells])
                text = np.searchsorted(of_text, hit, "right") - 1
                own = np.unique(text << BITS | cells[hit])
                z = np.bincount(own >> BITS, table[own & ((1 << BITS) - 1)], hi - lo) + model.bias
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))))], ["doc_id", "score"])

    return texts(docs).mapInArrow(run, "doc_id long, score double")


def held_out():
    """Rows whose labels are never learned from."""
    return crc_mod("doc_id", 3) == 1


def classify(docs: DataFrame, labels: DataFrame, params: Params | None = None, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``; null texts are empty."""
    learn = ~F.coalesce(held_out(), F.lit(True))
    model = train(docs.where(learn), labels.where(learn), params)
    return score(docs, model).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
