"""LM scoring by logistic context mixing of bit predictors, beside a word-count baseline.

Bytes are coded bit by bit. For each of the contexts of 1 to 5 bytes a hashed
table holds how often the next bit was 0 or 1, counted over the whole training
corpus. The predictors' log odds are combined by weights that a gate picks by
how much the two longest contexts have seen; an adaptive map then refines the
result by the bits of the current byte. Weights and map are learned from every
bit of the training corpus, where each position's own count is taken out of the
tables. What is predicted depends on the last bytes alone, so each distinct
string of them is mixed once, with its count as its weight. A pass adds up, for
each gate, gradient and curvature of the coding cost; a few Newton steps find
the weights, and the last pass counts the map. A score depends neither on the
order of rows nor on partitions. A text ends with a coded end mark, which makes
the scores probabilities of whole texts.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.bytewise import U, mix, text_slices
from loanloom.llm.tables import crc_mod, materialize, partitions, texts

#: log2 of the cells of the contexts of 1, 2 ... bytes.
BITS = (16, 18, 20, 22, 22)
ORDER = len(BITS)
RUN = 1 << 14
#: Bytes of text in a slice here: what a task has learned is merged once a slice.
MERGE_BYTES = 2 << 20
#: Distinct words, or byte strings, that a task gathers before it hands them on.
HELD = 400_000
#: Words that are looked up without a shuffle: at most so many, of at most so many bytes each.
FREQUENT = 100_000
FREQUENT_BYTES = 64
#: Counts of a cell while the mixing is learned go up to this; pairs beyond it are halved until they fit.
MOST = (1 << 16) - 1
#: The map starts as if each of its cells had seen so many bits.
PRIOR = 16
_LIMIT = 6.0
GATES = 64


@dataclass
class Params:
    """``lanes``: strings that are mixed side by side; ``passes``: Newton steps at most."""

    lanes: int = 1 << 15
    passes: int = 3


# --- byte strings -----------------------------------------------------------

def coded(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Strings of ORDER bytes of context and the coded byte, as numbers, of all texts, and the text of each.

    A text begins after ORDER zero bytes and ends with two; a zero byte inside is followed by a one.
    """
    n = len(offs) - 1
    if (data == 0).any():
        parts = [data[a:b].tobytes().replace(b"\0", b"\0\1") for a, b in zip(offs[:-1], offs[1:], strict=True)]
        offs = np.r_[0, np.cumsum([len(p) for p in parts])]
        data = np.frombuffer(b"".join(parts), np.uint8)
    begin = offs + (ORDER + 2) * np.arange(n + 1)
    stream = np.zeros(begin[-1], np.uint8)
    stream[np.arange(len(data)) + np.repeat((ORDER + 2) * np.arange(n) + ORDER, np.diff(offs))] = data
    wide = stream.astype(np.int64)
    gram = wide[ORDER:].copy()
    for k in range(1, ORDER + 1):
        gram += wide[ORDER - k:len(wide) - k] << (8 * k)
    text = np.repeat(np.arange(n), np.diff(begin))[ORDER:]
    ok = np.ones(len(gram), bool)
    # a text's first ORDER positions are context only
    for k in range(ORDER):
        ok[begin[1:-1] + k - ORDER] = False
    return gram[ok], text[ok]


def _slots(gram: np.ndarray) -> list[np.ndarray]:
    """Hashes of the contexts of 1 to ORDER bytes."""
    return [mix(((gram >> 8) & ((1 << (8 * k)) - 1)).astype(U) * U(8) + U(k)) for k in range(1, ORDER + 1)]


def _cell(h: np.ndarray, node: np.ndarray, bits: int) -> np.ndarray:
    return (((h ^ (node.astype(U) * U(0xC2B2AE3D27D4EB4F))) * U(0x9E3779B97F4A7C15)) >> U(64 - bits)).astype(np.int64)


def _distinct(grams: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The strings in order, each once, with the sum of its counts."""
    both, n = np.concatenate(grams), np.concatenate(counts)
    order = np.argsort(both, kind="stable")
    both, n = both[order], n[order]
    first = np.flatnonzero(np.r_[True, both[1:] != both[:-1]])
    return both[first], np.add.reduceat(n, first)


def _gram_rows(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["gram", "n"])


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training texts -> (gram, n), each distinct string once a run of the task."""
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        for _, _, offs, data in text_slices(batch.column(1), MERGE_BYTES):
            new, n = np.unique(coded(data, offs)[0], return_counts=True)
            keys, counts = _distinct([keys, new], [counts, n])
            if len(keys) > 4 * HELD:
                yield _gram_rows(keys, counts)
                keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(keys):
        yield _gram_rows(keys, counts)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, n) of many tasks -> (gram, n), each distinct string once a run of the task."""
    keys, counts, size = [], [], 0
    for batch in batches:
        keys.append(batch.column(0).to_numpy().astype(np.int64))
        counts.append(batch.column(1).to_numpy().astype(np.int64))
        size += batch.num_rows
        if size > 4 * HELD:
            one, n = _distinct(keys, counts)
            keys, counts, size = [one], [n], len(one)
            if size > 2 * HELD:
                yield _gram_rows(one, n)
                keys, counts, size = [], [], 0
    if size:
        yield _gram_rows(*_distinct(keys, counts))


def _narrow(counts: np.ndarray) -> bytes:
    """Whole counts in as few bytes each as the largest one needs."""
    return counts.astype(np.min_scalar_type(counts.max(initial=0))).tobytes()


def _wide(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"u{max(1, len(raw) // max(1, n))}").astype(np.int64)


def _count_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, n) -> runs of table cells (table, run, places, zeros, ones); table 0 has no context."""
    tables = [np.zeros((2, 1 << b), np.int64) for b in (8, *BITS)]
    for batch in batches:
        gram, n = (batch.column(i).to_numpy().astype(np.int64) for i in range(2))
        contexts = _slots(gram)
        for bit in range(8):
            node = (1 << bit) | ((gram & 255) >> (8 - bit))
            value = (gram >> (7 - bit)) & 1
            np.add.at(tables[0], (value, node), n)
            for k, h in enumerate(contexts):
                np.add.at(tables[k + 1], (value, _cell(h, node, BITS[k])), n)
    rows = []
    for k, t in enumerate(tables):
        some = np.flatnonzero(t.any(axis=0))
        cut = np.searchsorted(some, np.arange(0, t.shape[1] + RUN, RUN))
        for r, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
            if a < b:
                at = some[a:b]
                rows.append((k, r, (at - r * RUN).astype(np.uint16).tobytes(), _narrow(t[0, at]), _narrow(t[1, at])))
    if rows:
        yield _run_rows(rows)


def _run_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                      ["tab", "run", "places", "zeros", "ones"])


CELLS = "tab int, run int, places binary, zeros binary, ones binary"


def _sum_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for tab, run, places, zeros, ones in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            t = sums.setdefault((tab, run), np.zeros((2, RUN), np.int64))
            at = np.frombuffer(places, np.uint16)
            t[0, at] += _wide(zeros, len(at))
            t[1, at] += _wide(ones, len(at))
    rows = []
    for (tab, run), t in sums.items():
        at = np.flatnonzero(t.any(axis=0))
        rows.append((tab, run, at.astype(np.uint16).tobytes(), _narrow(t[0, at]), _narrow(t[1, at])))
    if rows:
        yield _run_rows(rows)


# --- the mixer --------------------------------------------------------------

def _odds(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return np.clip(np.log((ones + 0.4) / (zeros + 0.4)), -_LIMIT, _LIMIT)


def _level(n: np.ndarray) -> np.ndarray:
    return np.minimum(7, np.log2(n + 1)).astype(np.int64)


def _bucket(z: np.ndarray) -> np.ndarray:
    return np.clip(np.rint((z + 8) * 2), 0, 32).astype(np.int64)


@dataclass
class Mixer:
    odds: list[np.ndarray]     # log odds of all tables
    level: list[np.ndarray]    # how much the two longest contexts have seen
    weights: np.ndarray        # (gate, input)
    refine: np.ndarray         # (bits so far, bucket of the mixed log odds) -> probability of a one

    def log2(self, gram: np.ndarray) -> np.ndarray:
        """log2 of the probabilities of the last bytes of strings, given the bytes before."""
        out = np.zeros(len(gram))
        for lo in range(0, len(gram), 1 << 15):
            g = gram[lo:lo + (1 << 15)]
            contexts = _slots(g)
            total = np.zeros(len(g))
            for bit in range(8):
                node = (1 << bit) | ((g & 255) >> (8 - bit))
                one = (g >> (7 - bit)) & 1
                cells = [_cell(h, node, b) for h, b in zip(contexts, BITS, strict=True)]
                gate = self.level[1][cells[-1]].astype(np.int64) * 8 + self.level[0][cells[-2]]
                w = self.weights[gate]
                z = w[:, ORDER + 1] + w[:, 0] * self.odds[0][node]
                for k, c in enumerate(cells):
                    z += w[:, k + 1] * self.odds[k + 1][c]
                p = (1 / (1 + np.exp(-z)) + self.refine[node, _bucket(z)]) / 2
                p = np.clip(p, 1e-5, 1 - 1e-5)
                total += np.log2(np.where(one == 1, p, 1 - p))
            out[lo:lo + len(g)] = total
        return out


def _packed_counts(table: np.ndarray) -> np.ndarray:
    """Zeros and ones of each cell in one number of 32 bits."""
    most = np.maximum(table.max(axis=0).astype(np.int64), 1)
    halvings = np.maximum(0, np.ceil(np.log2((most + 1) / (MOST + 1)))).astype(np.int64)
    zeros, ones = table.astype(np.int64) >> halvings
    return (zeros | ones << 16).astype(np.uint32)


def _first_weights() -> np.ndarray:
    """Longer contexts weigh more; the last input is always one."""
    return np.tile(np.r_[np.arange(ORDER + 1) * 2 / (ORDER * (ORDER + 1)), 0.0], (GATES, 1))


@dataclass
class Sums:
    """What a pass over weighted strings adds up."""

    cost: np.ndarray        # (gate): nats
    slope: np.ndarray       # (gate, input): how the cost falls
    curve: np.ndarray       # (gate, input, input)
    seen: np.ndarray        # (zeros and ones, bits so far x bucket)

    @classmethod
    def none(cls) -> Sums:
        return cls(np.zeros(GATES), np.zeros((GATES, ORDER + 2)), np.zeros((GATES, ORDER + 2, ORDER + 2)), np.zeros((2, 256 * 33)))

    def raw(self) -> bytes:
        return b"".join(a.tobytes() for a in (self.cost, self.slope, self.curve, self.seen))

    def add_raw(self, raw: bytes) -> None:
        at, flat = 0, np.frombuffer(raw)
        for a in (self.cost, self.slope, self.curve, self.seen):
            a += flat[at:at + a.size].reshape(a.shape)
            at += a.size


def mixing_sums(packed: list[np.ndarray], weights: np.ndarray, gram: np.ndarray, n: np.ndarray, lanes: int, sums: Sums) -> None:
    """Add what the bits of strings, each seen ``n`` times, say about the weights."""
    logs = np.log(np.arange(MOST + 1) + 0.4)
    levels = _level(np.arange(128))
    for lo in range(0, len(gram), lanes):
        g, times = gram[lo:lo + lanes], n[lo:lo + lanes].astype(float)
        contexts = _slots(g)
        x = np.ones((ORDER + 2, len(g)))
        for bit in range(8):
            node = (1 << bit) | ((g & 255) >> (8 - bit))
            one = (g >> (7 - bit)) & 1
            level = [np.zeros(0)] * (ORDER + 1)
            for k in range(ORDER + 1):
                both = packed[k].take(node if k == 0 else _cell(contexts[k - 1], node, BITS[k - 1])).astype(np.int64)
                # the position's own count is not evidence for itself
                n0, n1 = np.maximum((both & MOST) - 1 + one, 0), np.maximum((both >> 16) - one, 0)
                x[k] = np.clip(logs.take(n1) - logs.take(n0), -_LIMIT, _LIMIT)
                if k >= ORDER - 1:
                    level[k] = levels.take(np.minimum(n0 + n1, 127))
            gate = level[ORDER] * 8 + level[ORDER - 1]
            order = np.argsort(gate.astype(np.uint8), kind="stable")
            gate, y, t, xs = gate[order], one[order], times[order], x[:, order]
            z = np.einsum("ki,ki->i", weights.T[:, gate], xs)
            p = 1 / (1 + np.exp(-z))
            first = np.flatnonzero(np.r_[True, gate[1:] != gate[:-1]])
            miss, bend = t * (y - p), xs * (t * p * (1 - p))
            for a, b in zip(first, np.r_[first[1:], len(gate)], strict=True):
                sums.slope[gate[a]] += xs[:, a:b] @ miss[a:b]
                sums.curve[gate[a]] += bend[:, a:b] @ xs[:, a:b].T
            sums.cost += np.bincount(gate, t * np.logaddexp(0, np.where(y == 1, -z, z)), GATES)
            cell = node[order] * 33 + _bucket(z)
            for value in range(2):
                sums.seen[value] += np.bincount(cell, t * (y == value), 256 * 33)


def fit_mixing(run, passes: int) -> tuple[np.ndarray, np.ndarray]:
    """(weights, refinement) by up to ``passes`` Newton steps; ``run`` adds up one pass with given weights.

    A gate whose cost has grown goes halfway back. The last pass only counts.
    """
    weights = best = _first_weights()
    least = np.full(GATES, np.inf)
    step = np.zeros_like(best)
    for turn in range(passes + 1):
        sums = run(weights)
        better = sums.cost <= least
        step = np.where(better[:, None], np.linalg.solve(sums.curve + np.eye(ORDER + 2), sums.slope[..., None])[..., 0], step / 2)
        best, least = np.where(better[:, None], weights, best), np.where(better, sums.cost, least)
        # what another step may gain
        gain = 0.5 * (step * sums.slope)[better].sum()
        if turn == passes or (better.all() and gain <= 1e-3 * least.sum()):
            break
        # sums of doubles depend on their order in the last digits only
        weights = np.round(best + step, 6)
    center = 1 / (1 + np.exp(-(np.arange(33) / 2 - 8)))
    start = np.tile(center, 256)
    refine = (sums.seen[1] + PRIOR * start) / (sums.seen.sum(axis=0) + PRIOR)
    return best, refine.reshape(256, 33)


def _mixer(tables: list[np.ndarray], weights: np.ndarray, refine: np.ndarray) -> Mixer:
    odds = [_odds(t[0], t[1]).astype(np.float16) for t in tables]
    level = [_level(tables[k][0] + tables[k][1]).astype(np.uint8) for k in (ORDER - 1, ORDER)]
    return Mixer(odds, level, weights, refine)


def learn_mixer(tables: list[np.ndarray], texts_: list[bytes], p: Params) -> Mixer:
    """Weights and refinement for some texts in memory."""
    parts = [np.unique(coded(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0], return_counts=True) for t in texts_]
    gram, n = _distinct(*zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    packed = [_packed_counts(t) for t in tables]

    def run(weights: np.ndarray) -> Sums:
        sums = Sums.none()
        mixing_sums(packed, weights, gram, n, p.lanes, sums)
        return sums

    return _mixer(tables, *fit_mixing(run, p.passes))


def train_mixer(docs: DataFrame, params: Params | None = None) -> Mixer:
    """Count all of ``docs`` (doc_id, text) and learn the mixing from all of them."""
    p = params or Params()
    spark = docs.sparkSession
    n = partitions(spark)
    grams = materialize(docs.mapInArrow(_grams, "gram long, n long").repartition(n, F.expr("gram >> 8 & 16777215")).mapInArrow(
        _merged, "gram long, n long"))
    cells = grams.mapInArrow(_count_bits, CELLS)
    tables = [np.zeros((2, 1 << b), np.int64) for b in (8, *BITS)]
    for r in cells.repartition(n, "tab", "run").mapInArrow(_sum_cells, CELLS).toLocalIterator():
        at = r.run * RUN + np.frombuffer(bytes(r.places), np.uint16).astype(np.int64)
        tables[r.tab][0, at] = _wide(bytes(r.zeros), len(at))
        tables[r.tab][1, at] = _wide(bytes(r.ones), len(at))
    sent = spark.sparkContext.broadcast([_packed_counts(t) for t in tables])

    def run(weights: np.ndarray) -> Sums:
        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = Sums.none()
            for batch in batches:
                mixing_sums(sent.value, weights, batch.column(0).to_numpy(), batch.column(1).to_numpy(), p.lanes, own)
            yield pa.RecordBatch.from_arrays([pa.array([own.raw()], pa.binary())], ["sums"])

        total = Sums.none()
        # a row of fixed size for each task
        for r in grams.mapInArrow(learn, "sums binary").collect():
            total.add_raw(bytes(r.sums))
        return total

    return _mixer(tables, *fit_mixing(run, p.passes))


def model_scores(docs: DataFrame, mixer: Mixer) -> DataFrame:
    """doc_id, score: log10 of the model's probability of each text (null: empty)."""
    sent = docs.sparkSession.sparkContext.broadcast((mixer.odds, mixer.level, mixer.weights, mixer.refine))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Mixer(*sent.value)
        known, value = np.zeros(0, np.int64), np.zeros(0)
        for batch in batches:
            for lo, hi, offs, data in text_slices(batch.column(1), MERGE_BYTES):
                gram, text = coded(data, offs)
                # strings and texts sort as one number: 48 bits and 14 bits
                both = np.sort(gram << 14 | text)
                gram, text = both >> 14, both & 16383
                new = np.r_[True, gram[1:] != gram[:-1]]
                own = gram[new]
                at = np.minimum(np.searchsorted(known, own), max(len(known) - 1, 0))
                had = known[at] == own if len(known) else np.zeros(len(own), bool)
                log = np.zeros(len(own))
                log[had] = value[at[had]]
                log[~had] = model.log2(own[~had])
                if len(known) > 2_000_000:
                    known, value = own, log
                else:
                    order = np.argsort(np.r_[known, own[~had]], kind="stable")
                    known, value = np.r_[known, own[~had]][order], np.r_[value, log[~had]][order]
                total = np.bincount(text, log[np.cumsum(new) - 1], hi - lo)
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], pa.array(total * math.log10(2))],
                                                 ["doc_id", "score"])

    return texts(docs).mapInArrow(run, "doc_id long, score double")


# --- the word counts --------------------------------------------------------

def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training texts -> (word, n), each distinct word once a run of the task."""
    held: Counter[bytes] = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for text in batch.column(1):
            held.update(text.as_buffer().to_pybytes().lower().split())
            if len(held) > HELD:
                yield out()
                held.clear()
    if held:
        yield out()


def _look_up(sent, unit: float, end: int):
    """Texts -> what frequent words and the end add (a row a document under a key no word has), and the other words.

    ``unit``: log10 of the denominator; ``end``: how often the end was seen. Rows: word, documents, counts, base.
    """
    kinds = [pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log = {w: math.log10(c + 0.1) - unit for w, c in sent.value.items()}
        rare: dict[bytes, list[int]] = {}
        size = 0

        def out() -> pa.RecordBatch:
            docs = [np.array(v[::2], np.int64).tobytes() for v in rare.values()]
            times = [np.array(v[1::2], np.int32).tobytes() for v in rare.values()]
            none = len(rare)
            return pa.RecordBatch.from_arrays([
                pa.array(list(rare), pa.binary()), pa.array(docs, pa.binary()), pa.array(times, pa.binary()),
                pa.nulls(none, pa.float64()), pa.nulls(none, pa.int64()), pa.nulls(none, pa.int64())], NAMES)

        for batch in batches:
            own = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                counts = Counter(text.as_buffer().to_pybytes().lower().split())
                base, n, known = math.log10(end + 0.1) - unit, 1, int(end > 0)
                for w, c in counts.items():
                    if (v := log.get(w)) is not None:
                        base += c * v
                        n += c
                        known += c
                    else:
                        rare.setdefault(w, []).extend((doc, c))
                        size += 1
                one = np.array([doc], np.int64).tobytes()
                own.append((b" " + one, one, b"", base, n, known))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*own, strict=True) if own else [[]] * 6, kinds, strict=True)], NAMES)
            if size > 2 * HELD:
                yield out()
                rare.clear()
                size = 0
        if rare:
            yield out()

    return run


NAMES = ["word", "docs", "times", "base", "n", "known"]


PACKED = "bucket int, docs binary, base binary, n binary, known binary"


def _packed(doc: np.ndarray, base: np.ndarray, n: np.ndarray, known: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Sums per document, a row for each bucket of documents."""
    ids, at = np.unique(doc, return_inverse=True)
    sums = [ids, *(np.bincount(at, x, len(ids)) for x in (base, n, known))]
    bucket = (mix(ids.view(U)) % U(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    sums = [x[order] for x in sums]
    cut = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    ends = np.r_[cut[1:], len(bucket)]
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[cut], pa.int32()),
         *(pa.array([x[a:b].tobytes() for a, b in zip(cut, ends, strict=True)], pa.binary()) for x in sums)],
        ["bucket", "docs", "base", "n", "known"])


def _by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed rows sorted by bucket -> (doc_id, base, n, known)."""
    def out(held: list[tuple]) -> pa.RecordBatch:
        doc = np.frombuffer(b"".join(h[0] for h in held), np.int64)
        ids, at = np.unique(doc, return_inverse=True)
        base, n, known = (np.bincount(at, np.frombuffer(b"".join(h[k] for h in held), float), len(ids)) for k in (1, 2, 3))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids), pa.array(base), pa.array(n.astype(np.int64)), pa.array(known.astype(np.int64))],
            ["doc_id", "base", "n", "known"])

    now, held = None, []
    for batch in batches:
        for bucket, *row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if bucket != now and held:
                yield out(held)
                held = []
            now = bucket
            held.append(row)
    if held:
        yield out(held)


def _add_up(unit: float, buckets: int):
    """Looked-up rows with their corpus count -> sums per document, packed by bucket."""
    def flat(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
        offs = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
        data = column.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[offs[0]:offs[-1]] if data is not None else np.zeros(0, np.uint8)
        return np.frombuffer(raw.tobytes(), kind), np.diff(offs) // np.dtype(kind).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def out() -> pa.RecordBatch:
            return _packed(*(np.concatenate(c) for c in zip(*held, strict=True)), buckets)

        for batch in batches:
            if not batch.num_rows:
                continue
            whole = pa.compute.is_valid(batch.column(3))
            own, words = batch.filter(whole), batch.filter(pa.compute.invert(whole))
            if own.num_rows:
                held.append((flat(own.column(1), np.int64)[0], *(own.column(i).to_numpy() for i in (3, 4, 5))))
                size += own.num_rows
            if words.num_rows:
                doc, length = flat(words.column(1), np.int64)
                times, _ = flat(words.column(2), np.int32)
                c = np.repeat(words.column(6).fill_null(0).to_numpy(zero_copy_only=False), length)
                held.append((doc, times * (np.log10(c + 0.1) - unit), times, times * (c > 0)))
                size += len(doc)
            if size > 1_000_000:
                yield out()
                held, size = [], 0
        if held:
            yield out()

    return run


def word_scores(docs: DataFrame, learn: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score of ``docs`` by word counts of ``learn``."""
    spark = docs.sparkSession
    counts = materialize(learn.mapInArrow(_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c")))
    ends = learn.count()
    stat = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    total, distinct = (stat.n or 0) + ends, stat.v + (ends > 0)
    unit = math.log10(total + 0.1 * (distinct + 1))
    # how many words have at least 2^k occurrences decides from which k on they are looked up without a shuffle
    short = counts.where(F.octet_length("word") <= FREQUENT_BYTES)
    sizes = {r.k: r.n for r in short.groupBy(F.floor(F.log2("c")).alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()}
    least, many = 64, 0
    while least > 0 and many + sizes.get(least - 1, 0) <= FREQUENT:
        least -= 1
        many += sizes.get(least, 0)
    often = {bytes(r.word): r.c for r in short.where(F.floor(F.log2("c")) >= least).collect()}
    sent = spark.sparkContext.broadcast(often)
    n = partitions(spark)
    rows = docs.mapInArrow(_look_up(sent, unit, ends), "word binary, docs binary, times binary, base double, n long, known long")
    rest = counts.where((F.floor(F.log2("c")) < least) | (F.octet_length("word") > FREQUENT_BYTES))
    found = rows.repartition(n, "word").join(rest.repartition(n, "word").hint("merge"), "word", "left").select(
        *NAMES, "c")
    # documents are many, tasks few: what a task has for a bucket of documents travels as one row
    buckets = partitions(spark, docs.count(), 50_000)
    sums = found.mapInArrow(_add_up(unit, buckets), PACKED).repartition(buckets, "bucket").sortWithinPartitions(
        "bucket").mapInArrow(_by_document, "doc_id long, base double, n long, known long")
    return sums.select("doc_id", F.col("n").alias("n_tokens"), F.col("known").alias("n_known"),
                       F.lit(total).cast("long").alias("train_tokens"), F.col("base").alias("base_score"))


def score_documents(docs: DataFrame, params: Params | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte of every document.

    Learned from the documents whose crc32(doc_id) modulo 10 is not 0. Null
    texts are empty: one token, the end. Rows with a null doc_id are left out;
    doc_id is taken to be unique.
    """
    held_out = crc_mod("doc_id", 10) == 0
    base = texts(docs.where(F.col("doc_id").isNotNull()))
    learn = base.where(~held_out)
    scores = model_scores(base, train_mixer(learn, params))
    sizes = base.select("doc_id", F.octet_length("text").alias("_b"))
    found = word_scores(base, learn).join(scores, "doc_id").join(sizes, "doc_id")
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score",
                        (F.col("score") / F.lit(-math.log10(2)) / F.greatest("_b", F.lit(1))).alias("bits_per_byte"))
