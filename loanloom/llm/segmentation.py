"""SentencePiece encoding and decoding: distinct sampled segmentations by Gumbel top-k over the piece lattice.

A text is a chain of small lattices (no piece crosses the start of a space
run), one for each distinct unit. Piece weights follow Zipf's rule on the
vocabulary's ranks; characters without a piece fall back to byte pieces. Sums
over all paths give at every lattice node the probabilities of its incoming
pieces, so a segmentation is a sequence of choices and the set of all of them a
tree with known subtree masses.

Sampling without replacement is an A* search on perturbed masses: the best leaf
below a node carries the node's Gumbel value; at each choice on its way the
branches not taken get the maximum of their leaves, a Gumbel variable of their
mass truncated at that value. The next sample is below the branch set with the
largest value, and so on. The value that would come next after the last sample
gives each sample's inclusion probability (its log). Random numbers depend on the row
key, the place in the text and the round only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.bytewise import _BASE, _BYTE, _INVERSE, U, mix, powers, text_slices
from loanloom.llm.tables import texts

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
_SLOTS = 19
_GOLDEN = U(0x9E3779B97F4A7C15)


@dataclass
class Pieces:
    """The vocabulary as arrays: a byte trie in a hash table, log weights, byte pieces, piece bytes."""

    keys: np.ndarray       # node << 8 | byte, -1 where a slot is free
    node: np.ndarray
    piece: np.ndarray      # of a trie node, -1: none
    weight: np.ndarray     # of a piece
    of_byte: np.ndarray    # piece of a fallback byte
    lone: np.ndarray       # bytes that no piece has: they stand alone
    data: np.ndarray
    offs: np.ndarray

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Child nodes, -1 where there is none."""
        key = (node << 8) | byte
        slot = ((key.astype(U) * _GOLDEN) >> U(64 - _SLOTS)).astype(np.int64)
        out = np.full(len(key), -1)
        open_ = np.arange(len(key))
        while len(open_):
            held = self.keys[slot[open_]]
            hit = held == key[open_]
            out[open_[hit]] = self.node[slot[open_[hit]]]
            open_ = open_[~hit & (held != -1)]
            slot[open_] = (slot[open_] + 1) & ((1 << _SLOTS) - 1)
        return out


def load_pieces(path: str = MODEL) -> Pieces:
    """Read a SentencePiece model with byte fallback; read on the driver only."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    of_byte, own = np.full(256, -1), {}
    for i in range(n):
        if sp.is_byte(i):
            of_byte[int(sp.id_to_piece(i)[1:-1], 16)] = i
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            own[i] = sp.id_to_piece(i).replace("▁", " ").encode()
    if (of_byte < 0).any():
        raise ValueError("the vocabulary has no piece for some byte")
    for b in own.values():
        if b" " in b.lstrip(b" "):
            raise ValueError("a piece goes on after a space that follows other text")
    rank = np.full(n, n, float)
    order = sorted(own, key=lambda i: (-sp.get_score(i), i))
    rank[order] = np.arange(len(order))
    weight = -np.log(rank + 2)
    weight -= np.log(np.exp(weight).sum())
    bytes_of = [own.get(i, b"") for i in range(n)]
    for b, i in enumerate(of_byte):
        bytes_of[i] = bytes([b])
    keys, node = np.full(1 << _SLOTS, -1), np.full(1 << _SLOTS, -1)
    child: dict[tuple[int, int], int] = {}
    piece = [-1]
    for i, b in own.items():
        at = 0
        for x in b:
            if (at, x) not in child:
                child[at, x] = len(piece)
                piece.append(-1)
            at = child[at, x]
        piece[at] = i
    for (at, x), to in child.items():
        key = (at << 8) | x
        slot = ((key * int(_GOLDEN)) & ((1 << 64) - 1)) >> (64 - _SLOTS)
        while keys[slot] != -1:
            slot = (slot + 1) & ((1 << _SLOTS) - 1)
        keys[slot], node[slot] = key, to
    used = np.zeros(256, bool)
    used[list(set(b"".join(own.values())))] = True
    used[128:] = True
    return Pieces(keys, node, np.array(piece), weight, of_byte, ~used, np.frombuffer(b"".join(bytes_of), np.uint8),
                  np.r_[0, np.cumsum([len(b) for b in bytes_of])])


class _Lattice:
    """All pieces of the distinct units of a slice, grouped by the byte they end at."""

    def __init__(self, p: Pieces, data: np.ndarray, unit_start: np.ndarray, unit_end: np.ndarray):
        n = len(data)
        start_of = np.repeat(unit_start, unit_end - unit_start)
        end_of = np.repeat(unit_end, unit_end - unit_start)
        lead = (data & 0xC0) != 0x80
        arcs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        at = np.flatnonzero(lead)
        node = np.zeros(len(at), np.int64)
        single = np.zeros(n, bool)
        width = np.ones(n, np.int64)
        width[data >= 0xC0], width[data >= 0xE0], width[data >= 0xF0] = 2, 3, 4
        begin, depth = at, 0
        while len(begin):
            node = p.step(node, data[begin + depth].astype(np.int64))
            depth += 1
            ok = node >= 0
            begin, node = begin[ok], node[ok]
            found = p.piece[node]
            has = found >= 0
            arcs.append((begin[has], begin[has] + depth, found[has]))
            single[begin[has][width[begin[has]] == depth]] = True
            more = begin + depth < end_of[begin]
            begin, node = begin[more], node[more]
        bare = at[~single[at]]
        arcs.append((bare, np.minimum(bare + width[bare], end_of[bare]), np.full(len(bare), -1)))
        self.start, self.end, self.piece = (np.concatenate(x) for x in zip(*arcs, strict=True))
        byte_weight = p.weight[p.of_byte[0]]
        score = np.where(self.piece >= 0, p.weight[self.piece], (self.end - self.start) * byte_weight)
        # ends are counted within the unit, so that all units advance together
        rel = self.end - start_of[self.end - 1]
        order = np.lexsort((self.start, self.end, rel))
        self.start, self.end, self.piece = self.start[order], self.end[order], self.piece[order]
        score, rel = score[order], rel[order]
        first = np.flatnonzero(np.r_[True, self.end[1:] != self.end[:-1]]) if len(rel) else np.zeros(0, int)
        group_end = np.r_[first[1:], len(rel)].astype(np.int64)
        # mass of all paths from the unit's start, kept in units of the start (node 0 of each unit is separate)
        alpha = np.zeros(n + 1)
        q = np.zeros(len(rel))
        cut = np.flatnonzero(np.r_[True, rel[first][1:] != rel[first][:-1]]) if len(first) else np.zeros(0, int)
        for a, b in zip(cut, np.r_[cut[1:], len(first)], strict=False):
            lo, hi = first[a], group_end[b - 1]
            s = self.start[lo:hi]
            inside = np.where(s == start_of[s], 0.0, alpha[s])
            value = inside + score[lo:hi]
            g = first[a:b] - lo
            size = group_end[a:b] - first[a:b]
            top = np.maximum.reduceat(value, g)
            e = np.exp(value - np.repeat(top, size))
            total = np.add.reduceat(e, g)
            alpha[self.end[first[a:b]]] = top + np.log(total)
            q[lo:hi] = e / np.repeat(total, size)
        # a node that ends one unit is the first node of the next; its own paths end there
        self.q, self.score = q, score
        size = group_end - first
        run = np.cumsum(q)
        cum = run - np.repeat(run[first] - q[first], size) if len(q) else q
        if len(first):
            cum[group_end - 1] = np.inf
        self.cum = cum
        self.lo = np.zeros(n + 1, np.int64)
        self.hi = np.zeros(n + 1, np.int64)
        self.lo[self.end[first]], self.hi[self.end[first]] = first, group_end

    def choose(self, at: np.ndarray, u: np.ndarray) -> np.ndarray:
        """The arc into each node ``at`` that uniform numbers u pick."""
        arc = self.lo[at]
        open_ = np.flatnonzero(u > self.cum[arc])
        while len(open_):
            arc[open_] += 1
            open_ = open_[u[open_] > self.cum[arc[open_]]]
        return arc


def _uniform(key: np.ndarray, place: np.ndarray, stream: int) -> np.ndarray:
    """Numbers in (0, 1) that depend on the row key, the place in the text and the stream."""
    h = mix(key + mix(place.astype(U) * U(64) + U(stream)))
    return ((h >> U(12)).astype(float) + 0.5) / (1 << 52)


class _Slice:
    """The texts of a slice with their lattice; draws segmentations for all of them round by round."""

    def __init__(self, p: Pieces, data: np.ndarray, offs: np.ndarray, keys: np.ndarray):
        self.p, n = p, len(offs) - 1
        # each text gets the space that marks its beginning
        self.offs = offs + np.arange(n + 1)
        own = np.ones(self.offs[-1], bool)
        own[self.offs[:-1]] = False
        self.data = np.full(self.offs[-1], 0x20, np.uint8)
        self.data[own] = data
        self.keys = keys
        d = self.data
        space = d == 0x20
        cut = np.zeros(len(d) + 1, bool)
        cut[self.offs] = True
        cut[1:-1] |= (space[1:] & ~space[:-1]) | p.lone[d[1:]] | p.lone[d[:-1]]
        bounds = np.flatnonzero(cut)
        self.begin, self.stop = bounds[:-1], bounds[1:]
        value = _BYTE[d] * powers(_BASE, len(d))
        h = np.add.reduceat(value, self.begin) * powers(_INVERSE, len(d))[self.begin]
        h = mix(h + (self.stop - self.begin).astype(U))
        _, one, unit = np.unique(h, return_index=True, return_inverse=True)
        length = (self.stop - self.begin)[one]
        ends = np.cumsum(length)
        at = np.repeat(self.begin[one] - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)
        self.lattice = _Lattice(p, d[at], ends - length, ends)
        self.unit_begin, self.unit_end = (ends - length)[unit], ends[unit]
        self.text = np.repeat(np.arange(n), np.diff(np.searchsorted(self.begin, self.offs)))

    def draw(self, units: np.ndarray, at: np.ndarray, stream: int) -> tuple[np.ndarray, np.ndarray]:
        """Choices from lattice nodes ``at`` back to the start of ``units``: (unit, arc), in order of the units."""
        found_unit, found_arc = [], []
        base = self.begin - self.unit_begin - self.offs[self.text]
        while len(units):
            place = at + base[units]
            arc = self.lattice.choose(at, _uniform(self.keys[self.text[units]], place, stream))
            found_unit.append(units)
            found_arc.append(arc)
            at = self.lattice.start[arc]
            on = at > self.unit_begin[units]
            units, at = units[on], at[on]
        if not found_unit:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        unit, arc = np.concatenate(found_unit), np.concatenate(found_arc)
        order = np.argsort(unit, kind="stable")
        return unit[order], arc[order]


class _Drawn:
    """One segmentation of each of some texts: choices in order, log masses, values of the branches not taken."""

    def __init__(self, s: _Slice, texts_: np.ndarray, unit: np.ndarray, arc: np.ndarray, top: np.ndarray,
                 stream: int):
        self.unit, self.arc, self.texts, self.top = unit, arc, texts_, top
        self.bounds = np.searchsorted(s.text[unit], np.r_[texts_, len(s.offs)]) if len(texts_) else np.zeros(1, int)
        text = np.repeat(np.arange(len(texts_)), np.diff(self.bounds))
        q = s.lattice.q[arc]
        log_q = np.log(q)
        run = np.cumsum(log_q)
        base = np.r_[0.0, run][self.bounds[:-1]]
        self.before = run - log_q - base[text]
        self.log_p = np.r_[0.0, run][self.bounds[1:]] - base
        node = s.lattice.end[arc]
        alone = s.lattice.hi[node] - s.lattice.lo[node] == 1
        rest = np.where(alone, 0.0, 1.0 - q)
        with np.errstate(divide="ignore"):
            mass = self.before + np.log(np.maximum(rest, 0.0))
        place = node + (s.begin - s.unit_begin - s.offs[s.text])[unit]
        self.values = _truncated(mass, top[text], -np.log(_uniform(s.keys[texts_][text], place, stream)))
        self.used: dict[int, list[int]] = {}


def _truncated(mass: np.ndarray, top: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Gumbel of log mass, truncated at ``top``; e: exponential numbers."""
    with np.errstate(divide="ignore", over="ignore", invalid="ignore"):
        out = mass - np.log(np.exp(mass - top) + e)
    return np.where(np.isneginf(mass), -np.inf, out)


def sample_slice(p: Pieces, data: np.ndarray, offs: np.ndarray, keys: np.ndarray, k: int) -> list[dict]:
    """Up to k distinct segmentations of each text, as flat arrays a round."""
    s = _Slice(p, data, offs, mix(keys.astype(np.int64).view(U) * _GOLDEN + U(1)))
    n = len(offs) - 1
    every = np.arange(n)
    u = _uniform(s.keys, np.zeros(n, np.int64), 0)
    unit, arc = s.draw(np.arange(len(s.begin)), s.unit_end.copy(), 1)
    rounds = [_Drawn(s, every, unit, arc, -np.log(-np.log(u)), 2)]
    best = np.full((k, n), -np.inf)       # largest open value of each round's segmentation of a text
    where = np.zeros((k, n), np.int64)

    def refresh(r: int, texts_: np.ndarray | None = None) -> None:
        d = rounds[r]
        rows = np.arange(len(d.texts)) if texts_ is None else np.searchsorted(d.texts, texts_)
        if texts_ is None and len(d.values):
            full = np.flatnonzero(np.diff(d.bounds) > 0)
            top = np.maximum.reduceat(d.values, d.bounds[:-1][full])
            size = np.diff(d.bounds)[full]
            hit = np.flatnonzero(d.values[d.bounds[full[0]]:] == np.repeat(top, size)) + d.bounds[full[0]]
            row = np.searchsorted(d.bounds, hit, "right") - 1
            where[r, d.texts[row[::-1]]] = hit[::-1]
            best[r, d.texts[full]] = top
        else:
            for i in rows:
                lo, hi = d.bounds[i], d.bounds[i + 1]
                j = lo + int(np.argmax(d.values[lo:hi]))
                where[r, d.texts[i]], best[r, d.texts[i]] = j, d.values[j]

    refresh(0)
    for r in range(1, k):
        source = best.argmax(axis=0)
        top = best[source, every]
        live = np.flatnonzero(top > -np.inf)
        if not len(live):
            break
        head_unit, head_arc, first_unit, first_at, branch = [], [], [], [], []
        for t in live:
            d, j = rounds[source[t]], where[source[t], t]
            lo = d.bounds[np.searchsorted(d.texts, t)]
            node = s.lattice.end[d.arc[j]]
            gone = d.used.setdefault(int(j), [int(d.arc[j])])
            arcs = [a for a in range(s.lattice.lo[node], s.lattice.hi[node]) if a not in gone]
            q = s.lattice.q[arcs]
            place = int(node + s.begin[d.unit[j]] - s.unit_begin[d.unit[j]] - s.offs[t])
            u1 = _uniform(s.keys[t:t + 1], np.array([place]), 3 * r)[0] * q.sum()
            a = arcs[min(int(np.searchsorted(np.cumsum(q), u1)), len(arcs) - 1)]
            gone.append(a)
            left = q.sum() - s.lattice.q[a] if len(arcs) > 1 else 0.0
            mass = d.before[j] + (np.log(left) if left > 0 else -np.inf)
            e = -np.log(_uniform(s.keys[t:t + 1], np.array([place]), 3 * r + 1))
            # the branches that are still open below this choice, truncated at the value just used
            d.values[j] = _truncated(np.array([mass]), np.array([top[t]]), e)[0]
            head_unit.append(d.unit[lo:j])
            head_arc.append(d.arc[lo:j])
            first_unit.append(d.unit[j])
            first_at.append(s.lattice.start[a])
            branch.append(a)
        first_unit, first_at, branch = np.array(first_unit), np.array(first_at), np.array(branch)
        last = np.searchsorted(s.text, live, "right")
        count = last - first_unit - 1
        more = np.repeat(first_unit + 1 - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
        on = first_at > s.unit_begin[first_unit]
        units = np.concatenate([first_unit[on], more])
        at = np.concatenate([first_at[on], s.unit_end[more]])
        order = np.argsort(units, kind="stable")
        tail_unit, tail_arc = s.draw(units[order], at[order], 3 * r + 2)
        # head, branch, tail of each text, in the order of units
        unit = np.concatenate([*head_unit, first_unit, tail_unit])
        arc = np.concatenate([*head_arc, branch, tail_arc])
        order = np.argsort(unit, kind="stable")
        for q_ in {int(x) for x in source[live]}:
            refresh(q_, live[source[live] == q_])
        drawn = _Drawn(s, live, unit[order], arc[order], top[live], 3 * k + r)
        # what is open up to the branch is kept with the segmentation it was taken from
        shared = np.array([len(x) for x in head_unit]) + 1
        drawn.values[np.repeat(drawn.bounds[:-1] - (np.cumsum(shared) - shared), shared)
                     + np.arange(shared.sum())] = -np.inf
        rounds.append(drawn)
        refresh(r)
    kappa = best.max(axis=0)
    return [_result(s, d, kappa) for d in rounds]


def _result(s: _Slice, d: _Drawn, kappa: np.ndarray) -> dict:
    """Ids in reading order, log probability, perturbed score, inclusion probability, round trip of one round."""
    p, lat = s.p, s.lattice
    # choices go backwards within a unit
    change = np.flatnonzero(np.r_[True, d.unit[1:] != d.unit[:-1]]) if len(d.unit) else np.zeros(0, int)
    size = np.diff(np.r_[change, len(d.unit)])
    back = np.repeat(2 * change + size - 1, size) - np.arange(len(d.unit))
    arc, unit = d.arc[back], d.unit
    bare = lat.piece[arc] < 0
    wide = np.where(bare, lat.end[arc] - lat.start[arc], 1)
    ends = np.cumsum(wide)
    ids = np.repeat(lat.piece[arc], wide)
    slot = np.flatnonzero(np.repeat(bare, wide))
    if len(slot):
        k = slot - np.repeat(ends - wide, wide)[slot]
        here = np.repeat(lat.start[arc] + (s.begin - s.unit_begin)[unit], wide)[slot] + k
        ids[slot] = p.of_byte[s.data[here]]
    bounds = np.r_[0, ends][d.bounds]
    decoded, own = decode_flat(p, ids, bounds)
    want = np.diff(s.offs)[d.texts]
    same = np.diff(own) == want
    for i in np.flatnonzero(same):
        lo = s.offs[d.texts[i]]
        same[i] = np.array_equal(decoded[own[i]:own[i + 1]], s.data[lo:lo + want[i]])
    # log of 1 - exp(-exp(x)); it is x where that is far below zero, as it is for long texts
    x = np.minimum(d.log_p - kappa[d.texts], 30.0)
    inclusion = np.where(x < -30, x, np.log(-np.expm1(-np.exp(np.maximum(x, -30)))))
    return {"text": d.texts, "ids": ids, "bounds": bounds, "log_p": d.log_p, "score": d.top,
            "log_inclusion": inclusion, "lossless": same}


def decode_flat(p: Pieces, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of flat ids, with the leading space of each text, and the bounds of the texts."""
    length = (p.offs[1:] - p.offs[:-1])[ids]
    ends = np.cumsum(length)
    at = np.repeat(p.offs[ids] - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)
    return p.data[at], np.r_[0, ends][bounds]


def _encode(p: Pieces, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False)
            for lo, hi, offs, data in text_slices(batch.column(1)):
                for r, x in enumerate(sample_slice(p, data, offs, keys[lo:hi], k)):
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0)[lo:hi].take(pa.array(x["text"])), pa.array(np.full(len(x["text"]), r + 1, np.int32)),
                        pa.ListArray.from_arrays(pa.array(x["bounds"].astype(np.int32)), pa.array(x["ids"].astype(np.int32))),
                        pa.array(x["log_p"]), pa.array(x["score"]), pa.array(x["log_inclusion"]), pa.array(x["lossless"])],
                        ["doc_id", "sample", "ids", "log_prob", "perturbed", "log_inclusion", "lossless"])

    return run


ENCODED = ("doc_id long, sample int, ids array<int>, log_prob double, perturbed double, log_inclusion double, "
           "lossless boolean")


def encode(docs: DataFrame, k: int = 2, path: str = MODEL) -> DataFrame:
    """Up to ``k`` distinct segmentations of every text: piece ids, log probability, scores, round-trip check.

    Fewer rows where a text has fewer segmentations. A null text is empty; the
    empty text is the space piece alone. ``lossless`` says whether the decoded
    ids are the text, byte for byte.
    """
    pieces = load_pieces(path)
    return texts(docs).mapInArrow(_encode(pieces, k), ENCODED)


def decode(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """``encoded`` (with ``ids``) with the decoded ``text``; bytes that are no UTF-8 become U+FFFD."""
    p = load_pieces(path)
    table = [p.data[a:b].tobytes() for a, b in zip(p.offs[:-1], p.offs[1:], strict=True)]
    at = encoded.columns.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [b"".join([table[i] for i in ids or []]).removeprefix(b" ").decode("utf-8", "replace")
                   for ids in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())],
                                             [*batch.schema.names, "text"])

    schema = ", ".join(f"`{n}` {t}" for n, t in encoded.dtypes)
    return encoded.mapInArrow(run, f"{schema}, text string")


def digest(encoded: DataFrame) -> DataFrame:
    """What a query returns of each sample: sizes, scores and a hash of the ids."""
    return encoded.select("doc_id", "sample", F.size("ids").alias("n_pieces"), "log_prob", "perturbed", "log_inclusion",
                          F.xxhash64("ids").alias("ids_hash"), "lossless")
