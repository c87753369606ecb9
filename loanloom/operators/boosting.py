"""Gradient boosting with second-order gains and leaf-wise trees; all folds grow in the same passes.

Features are cut into at most 256 bins once. A pass over the rows adds up
gradients, hessians and counts per (model, leaf, feature, bin) inside each task;
Spark sums these cells over tasks, and only the sums, whose number does not
depend on the rows, reach the driver. They are whole numbers (gradients are
scaled and rounded), so a fit does not depend on row order or partitions.

Trees grow best leaf first. The gain of a leaf does not depend on which other
leaves are split, so a pass fetches the histograms of all leaves that the best
order may reach next, and that order is then replayed on what is known. Of two
siblings only the smaller one is counted, the other is its parent less that one.
Leaves of at most ``SMALL`` rows are not worth a pass for each level: their rows
(bins, gradients, hessians) are sent to one task for each leaf, which splits on
by the same rule; the result is the same tree.

A model whose rows fit into ``ALONE`` bytes is grown by one task from first to last,
by the same rule and to the same trees: there a job for each pass would cost more
than the sums. Such a task counts several features at once, by the place of their
bins in a joint grid.

The written table holds the rows in blocks, column by column. A fit keeps them as
an RDD of arrays, in memory or on local disk, since a tree takes several passes
and a pass over kept blocks costs a fraction of a query's planning. Margins are
kept anew every few rounds; in between, tasks add the last trees. Now and then
the kept blocks go to the checkpoint folder, so a lost executor costs its tasks
and the trees since then only.
"""

from __future__ import annotations

import heapq
import json
import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field, fields, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from loanloom.session import ensure_checkpoint_dir, materialize, write_table

#: Rounds between two times that margins are kept, and that they go to the checkpoint folder.
KEEP_EVERY = 4
WRITE_EVERY = 32
#: Rows of a leaf that one task may finish: some bytes for each feature and row.
SMALL = 1 << 18
#: Bytes of rows that one task may hold to grow a model alone; half of them where several tasks do so.
ALONE = 1 << 29
#: Cells of the joint grid of some features, and rows that are counted and that are routed at once by such a task.
GRID = 4096
COUNTED = 1 << 14
ROUTED = 1 << 16
#: Rows whose values serve as cut points of ranges, and about so many ranges of a feature.
CUT_ROWS = 20_000
RANGES = 1024
#: Bytes of cells that tasks may send to the driver as they are; more are summed by a shuffle first.
DIRECT = 1 << 25
#: Cells that are summed: gradient, hessian, count.
GRADIENT, HESSIAN, COUNT = range(3)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


@dataclass(frozen=True)
class BoostSettings:
    """How trees are grown. ``num_leaves`` 0 and ``max_depth`` 0 mean no limit of that kind; one of them is needed."""

    n_estimators: int = 100
    learning_rate: float = 0.1
    num_leaves: int = 31
    max_depth: int = 0
    min_child_samples: int = 20
    min_child_weight: float = 1e-3
    reg_alpha: float = 0.0
    reg_lambda: float = 0.0
    min_split_gain: float = 0.0
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    max_bins: int = 64
    seed: int = 42
    patience: int = 0

    def __post_init__(self) -> None:
        if not self.num_leaves and not self.max_depth:
            raise ValueError("num_leaves or max_depth is needed")
        if not 2 <= self.max_bins <= 256:
            raise ValueError("max_bins is 2 to 256")

    @property
    def leaves(self) -> int:
        return self.num_leaves or 1 << self.max_depth


@dataclass
class Tree:
    """Nodes as lists; a leaf points to itself. ``bin`` is the last bin that goes left, ``at`` its upper edge."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    at: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    cover: list[float] = field(default_factory=list)
    depth: int = 0

    def inner(self) -> list[int]:
        return [i for i, left in enumerate(self.left) if left != i]

    def n_leaves(self) -> int:
        return sum(left == i for i, left in enumerate(self.left))


class Routes:
    """A tree as arrays, for many rows at once.

    A tree of up to 64 leaves also has a table for each of its features: what
    leaves, as bits from left to right, the splits on the feature leave open for a
    bin. The leaf of a row is the lowest bit that all its tables leave open.
    """

    def __init__(self, tree: Tree) -> None:
        self.depth = tree.depth
        # numbers of nodes and features as numpy looks them up, so that no step makes them anew
        self.feature, self.bin = np.array(tree.feature, np.intp), np.array(tree.bin, np.int32)
        self.at, self.value = np.array(tree.at, np.float64), np.array(tree.value, np.float64)
        #: of node i, the right child is at 2i, the left one at 2i + 1
        self.children = np.array([tree.right, tree.left], np.intp).T.ravel()
        self.leaves: np.ndarray | None = None
        self.tables: dict[int, np.ndarray] = {}
        if tree.n_leaves() <= 64:
            self._open_leaves(tree)

    def _open_leaves(self, tree: Tree) -> None:
        leaves: list[int] = []
        # node, and the inner nodes in whose left part it is
        todo: list[tuple[int, tuple[int, ...]]] = [(0, ())]
        below: dict[int, int] = {}
        while todo:
            i, over = todo.pop()
            if tree.left[i] == i:
                for j in over:
                    below[j] = below.get(j, 0) | 1 << len(leaves)
                leaves.append(i)
            else:
                todo += [(tree.right[i], over), (tree.left[i], (*over, i))]
        kind, every = (np.uint32, (1 << 32) - 1) if len(leaves) <= 32 else (np.uint64, (1 << 64) - 1)
        for i, bits in below.items():
            table = self.tables.setdefault(tree.feature[i], np.full(256, every, kind))
            table[tree.bin[i] + 1:] &= kind(every ^ bits)
        self.leaves = np.array(leaves, np.int32)

    def values_of(self, x: Columns) -> np.ndarray:
        """Value of the leaf of each row."""
        if self.leaves is None:
            return self.value.take(self.of_bins(x.rows))
        if not self.tables:
            return np.full(x.n, self.value[self.leaves[0]])
        fits = [table.take(x.column(f)) for f, table in self.tables.items()]
        bits = fits[0]
        for more in fits[1:]:
            bits &= more
        # a power of two as a double has its exponent in the upper bits
        lowest = (bits & (~bits + bits.dtype.type(1))).astype(np.float64).view(np.int64) >> 52
        return self.value[self.leaves].take(lowest - 1023)

    def of_bins(self, bins: np.ndarray) -> np.ndarray:
        """Leaf of each row of bins."""
        return self._go(bins, self.bin)

    def of_values(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row of feature values."""
        return self._go(x, self.at)

    def _go(self, x: np.ndarray, bound: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.intp)
        flat, starts = np.ascontiguousarray(x).reshape(-1), np.arange(len(x)) * x.shape[1]
        for _ in range(self.depth):
            inside = flat.take(starts + self.feature.take(node)) <= bound.take(node)
            node = self.children.take(2 * node + inside)
        return node


class Columns:
    """Bins of some rows, features x rows; columns are made ready to be looked up once they are asked for."""

    def __init__(self, bins: np.ndarray) -> None:
        self.bins, self.n = bins, bins.shape[1]
        self.ready: dict[int, np.ndarray] = {}

    @property
    def rows(self) -> np.ndarray:
        return self.bins.T

    def column(self, f: int) -> np.ndarray:
        if f not in self.ready:
            self.ready[f] = self.bins[f].astype(np.intp)
        return self.ready[f]


def bin_edges(rows: DataFrame, n_features: int, max_bins: int, features: str = "features") -> list[list[float]]:
    """Upper edges of the bins of each feature, from exact ranks: bins of about equal size that end at a value. The last has none.

    ``features`` is a vector or an array. The values of a feature are dealt into
    ranges at cut points from some rows, which only steer the balance. One pass
    counts the ranges; the values of those in which a bin ends are then counted one by one.
    """
    kind = dict(rows.dtypes)[features]
    x = rows.select((F.col(features) if kind.startswith("array") else vector_to_array(features)).alias("x"))
    n_rows = rows.count()
    drawn = x if n_rows <= CUT_ROWS else x.where(F.rand(1) < CUT_ROWS / n_rows)
    some = [c.column(0) for c in drawn.toArrow().to_batches()]
    some = np.concatenate([_matrix(c, len(c)) for c in some]) if some else np.zeros((0, n_features))
    every = max(1, len(some) // RANGES)
    cuts = [np.unique(v[~np.isnan(v)]) for v in np.sort(some, axis=0)[::every].T] or [np.zeros(0)] * n_features

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(len(c) + 1, np.int64) for c in cuts]
        for batch in batches:
            if batch.num_rows:
                own = _matrix(batch.column(0), batch.num_rows)
                for f, c in enumerate(cuts):
                    sums[f] += np.bincount(np.searchsorted(c, own[:, f], "left"), minlength=len(c) + 1)
        hit = [np.flatnonzero(s) for s in sums]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(cuts)), [len(h) for h in hit]), pa.int32()), pa.array(np.concatenate(hit), pa.int32()),
             pa.array(np.concatenate([s[h] for s, h in zip(sums, hit, strict=True)]))], ["f", "r", "n"])

    counts = [np.zeros(len(c) + 1, np.int64) for c in cuts]
    for r in x.mapInArrow(ranges, "f int, r int, n long").groupBy("f", "r").agg(F.sum("n").alias("n")).toArrow().to_pylist():
        counts[r["f"]][r["r"]] = r["n"]
    wanted = []
    for c in counts:
        # the part of the first and the last row of each range; a bin ends where the part grows
        full = np.flatnonzero(c)
        upto = np.cumsum(c[full])
        first, last = (np.ceil(at * max_bins / n_rows) for at in (upto - c[full] + 1, upto))
        w = np.full(len(c), -1, np.int64)
        here = full[(first != last) | np.r_[last[1:] != last[:-1], False]]
        w[here] = (np.cumsum(c) - c)[here]
        wanted.append(w)

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own, out = _matrix(batch.column(0), batch.num_rows), []
            for f, c in enumerate(cuts):
                r = np.searchsorted(c, own[:, f], "left")
                inside = wanted[f][r] >= 0
                v, first, n = np.unique(own[inside, f], return_index=True, return_counts=True)
                r = r[inside][first]
                out.append((np.full(len(v), f), r, wanted[f][r], v, n))
            columns = [np.concatenate(part) for part in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.int64()), strict=True)],
                ["f", "r", "before", "x", "n"])

    found = x.mapInArrow(values, "f int, r int, before long, x double, n long").groupBy("f", "r", "before", "x").agg(F.sum("n").alias("n"))
    upto = F.col("before") + F.sum("n").over(Window.partitionBy("f", "r").orderBy("x").rowsBetween(Window.unboundedPreceding, 0))
    part = F.ceil(upto * F.lit(max_bins) / F.lit(n_rows))
    edges: list[list[float]] = [[] for _ in range(n_features)]
    for r in found.select("f", "x", part.alias("part")).where(F.col("part") < max_bins).groupBy("f", "part").agg(F.max("x").alias("x")).collect():
        edges[r["f"]].append(r["x"])
    return [sorted(e) for e in edges]


def _split_scores(g, h, s: BoostSettings):
    """Part of the gain that sums G, H give."""
    t = np.sign(g) * np.maximum(np.abs(g) - s.reg_alpha, 0.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(h + s.reg_lambda > 0, t * t / (h + s.reg_lambda), 0.0)


def leaf_value(g: float, h: float, s: BoostSettings) -> float:
    t = math.copysign(max(abs(g) - s.reg_alpha, 0.0), g)
    return -s.learning_rate * t / (h + s.reg_lambda) if h + s.reg_lambda > 0 else 0.0


def best_split(cells: np.ndarray, allowed: np.ndarray, s: BoostSettings, scale: float):
    """(gain, feature, bin, left sums) of the best split of features x bins x (G, H, n), or None.

    Of equal gains the first feature and bin are taken.
    """
    below = np.cumsum(cells, axis=1)
    total = below[0, -1]
    above = total - below
    low, high = below / scale, above / scale
    gain = (_split_scores(low[..., 0], low[..., 1], s) + _split_scores(high[..., 0], high[..., 1], s)
            - _split_scores(total[0] / scale, total[1] / scale, s))
    fits = ((below[..., 2] >= max(s.min_child_samples, 1)) & (above[..., 2] >= max(s.min_child_samples, 1))
            & (low[..., 1] >= s.min_child_weight) & (high[..., 1] >= s.min_child_weight) & allowed[:, None])
    gain = np.where(fits, gain, -np.inf)
    at = int(np.argmax(gain))
    feature, place = divmod(at, cells.shape[1])
    best = float(gain[feature, place])
    if not best > max(s.min_split_gain, 1e-12):
        return None
    return best, feature, place, below[feature, place]


@dataclass
class _Node:
    """A leaf or former leaf: path (root 1, children 2p and 2p + 1), sums, and its best split once its cells are known."""

    path: int
    sums: np.ndarray
    cells: np.ndarray | None = None
    split: tuple | None = None


class Growing:
    """One tree while it grows."""

    def __init__(self, settings: BoostSettings, allowed: np.ndarray, scale: float) -> None:
        self.s, self.allowed, self.scale = settings, allowed, scale
        self.nodes: dict[int, _Node] = {}
        self.expanded: set[int] = set()

    def put(self, path: int, cells: np.ndarray) -> None:
        node = _Node(path, cells[0].sum(axis=0), cells)
        deep = path.bit_length() - 1
        if not self.s.max_depth or deep < self.s.max_depth:
            node.split = best_split(cells, self.allowed, self.s, self.scale)
        self.nodes[path] = node

    def order(self) -> tuple[list[int], list[int]]:
        """Splits in best-first order as far as known, and those of them whose children's cells are missing and may matter."""
        if 1 not in self.nodes:
            return [], []
        heap = [(-n.split[0], 1) for n in [self.nodes[1]] if n.split]
        leaves, done, missing = 1, [], []
        while heap and leaves < self.s.leaves:
            _, path = heapq.heappop(heap)
            done.append(path)
            leaves += 1
            last = self.s.max_depth and path.bit_length() >= self.s.max_depth
            if 2 * path in self.nodes:
                for child in (2 * path, 2 * path + 1):
                    if self.nodes[child].split:
                        heapq.heappush(heap, (-self.nodes[child].split[0], child))
            elif not last and leaves < self.s.leaves:
                missing.append(path)
        return done, missing

    def child_sums(self, path: int) -> np.ndarray:
        """Sums of a node, from its parent's split if its own cells were never needed."""
        if path in self.nodes:
            return self.nodes[path].sums
        left = self.nodes[path // 2].split[3]
        return self.nodes[path // 2].sums - left if path % 2 else left

    def smaller(self, path: int) -> int:
        left = self.nodes[path].split[3]
        return 2 * path if 2 * left[COUNT] <= self.nodes[path].sums[COUNT] else 2 * path + 1

    def fill(self, path: int, cells: np.ndarray) -> None:
        """Cells of the smaller child of ``path``; the other child has the rest."""
        small = self.smaller(path)
        self.put(small, cells)
        self.put(small ^ 1, self.nodes[path].cells - cells)

    def tree(self, splits: Sequence[int], edges: Sequence[Sequence[float]], wanted: dict[int, int] | None = None) -> Tree:
        """The tree of some splits; with ``wanted``, leaf values are the places of the wanted paths, else -1."""
        inner = set(splits)
        t = Tree()
        todo = [(1, -1, False)]
        while todo:
            path, parent, right = todo.pop()
            i = len(t.feature)
            if parent >= 0:
                (t.right if right else t.left)[parent] = i
            sums = self.child_sums(path)
            t.cover.append(float(sums[COUNT]))
            if path in inner:
                gain, feature, place, _ = self.nodes[path].split
                t.feature.append(feature)
                t.bin.append(place)
                t.at.append(edges[feature][place])
                t.gain.append(gain)
                t.value.append(0.0)
                t.left.append(-1)
                t.right.append(-1)
                t.depth = max(t.depth, path.bit_length())
                todo += [(2 * path + 1, i, True), (2 * path, i, False)]
            else:
                value = (leaf_value(sums[0] / self.scale, sums[1] / self.scale, self.s) if wanted is None
                         else float(wanted.get(path, -1)))
                t.feature.append(0)
                t.bin.append(0)
                t.at.append(0.0)
                t.gain.append(0.0)
                t.value.append(value)
                t.left.append(i)
                t.right.append(i)
        return t


def _adder(g: np.ndarray, h: np.ndarray, size: int):
    """Cell of each row -> sums of (G, H, n) per cell. H and n are whole numbers, added up as one where a double holds both."""
    one = float(1 << len(g).bit_length())
    if h.sum() * one >= 1 << 52:
        return lambda c, size=size: np.stack([np.bincount(c, g, size), np.bincount(c, h, size), np.bincount(c, minlength=size)])
    both = h * one + 1

    def add(c: np.ndarray, size: int = size) -> np.ndarray:
        sums = np.bincount(c, both, size)
        high = np.floor(sums / one)
        return np.stack([np.bincount(c, g, size), high, sums - high * one])

    return add


def row_cells(bins: np.ndarray, g: np.ndarray, h: np.ndarray, allowed: np.ndarray, n_bins: int) -> np.ndarray:
    """Features x bins x (G, H, n) of some rows; features that are left out carry the sums in their first bin."""
    out = np.zeros((bins.shape[1], n_bins, 3))
    add = _adder(g, h, n_bins)
    for f in np.flatnonzero(allowed):
        out[f] = add(bins[:, f].astype(np.intp)).T
    out[~allowed, 0] = g.sum(), h.sum(), len(g)
    return out


def grow_rows(path: int, bins: np.ndarray, g: np.ndarray, h: np.ndarray, s: BoostSettings, allowed: np.ndarray, scale: float,
              n_bins: int) -> Growing:
    """All that the best order can ever take below one leaf, from its rows."""
    out = Growing(s, allowed, scale)
    columns = np.ascontiguousarray(bins.T)
    out.put(path, row_cells(columns.T, g, h, allowed, n_bins))
    rows = {path: np.arange(len(g))}
    heap = [(-out.nodes[path].split[0], path)] if out.nodes[path].split else []
    for _ in range(s.leaves - 1):
        if not heap:
            break
        _, at = heapq.heappop(heap)
        _, feature, place, _ = out.nodes[at].split
        mine = rows.pop(at)
        left = columns[feature].take(mine) <= place
        rows[2 * at], rows[2 * at + 1] = mine[left], mine[~left]
        small = rows[out.smaller(at)]
        out.fill(at, row_cells(columns.take(small, axis=1).T, g[small], h[small], allowed, n_bins))
        out.nodes[at].cells = None
        for child in (2 * at, 2 * at + 1):
            if out.nodes[child].split:
                heapq.heappush(heap, (-out.nodes[child].split[0], child))
    return out


class Grids:
    """Bins of some rows, features x rows, and their places in joint grids of features, which are counted in one go."""

    def __init__(self, bins: np.ndarray, sizes: Sequence[int]) -> None:
        """``sizes``: number of bins of each feature."""
        self.bins = bins
        self.groups: list[list[int]] = []
        cells: list[int] = []
        for f in sorted(range(len(sizes)), key=lambda f: (-sizes[f], f)):
            i = next((i for i, n in enumerate(cells) if n * sizes[f] <= GRID), len(cells))
            if i == len(cells):
                self.groups.append([])
                cells.append(1)
            self.groups[i].append(f)
            cells[i] *= sizes[f]
        self.sizes = sizes
        # rows x grids, so that a row is fetched in one go
        self.places = np.zeros((bins.shape[1], len(self.groups)), np.uint16)
        for place, group in zip(self.places.T, self.groups, strict=True):
            for f in group:
                place *= np.uint16(sizes[f])
                place += bins[f]

    def cells(self, rows: np.ndarray, gh: np.ndarray, allowed: np.ndarray, n_bins: int) -> np.ndarray:
        """What ``row_cells`` gives for some of the rows; ``gh`` has gradient and hessian of all rows, rows x 2."""
        out = np.zeros((len(self.bins), n_bins, 3))
        asked = [i for i, group in enumerate(self.groups) if allowed[group].any()]
        found = [np.zeros((3, math.prod(self.sizes[f] for f in self.groups[i]))) for i in asked]
        whole = np.zeros(3)
        for lo in range(0, len(rows), COUNTED):
            some = rows[lo:lo + COUNTED]
            g, h = np.ascontiguousarray(gh.take(some, axis=0).T)
            whole += g.sum(), h.sum(), len(some)
            places, add = self.places.take(some, axis=0), _adder(g, h, 0)
            for i, sums in zip(asked, found, strict=True):
                sums += add(places[:, i].astype(np.intp), sums.shape[1])
        for i, sums in zip(asked, found, strict=True):
            for f in self.groups[i]:
                sums = sums.reshape(3, self.sizes[f], -1)
                if allowed[f]:
                    out[f, :self.sizes[f]] = sums.sum(axis=2).T
                sums = sums.sum(axis=1)
        out[~allowed, 0] = whole
        return out


def grow_alone(grids: Grids, rows: np.ndarray, gh: np.ndarray, s: BoostSettings, allowed: np.ndarray, scale: float,
               n_bins: int) -> tuple[Growing, list[int]]:
    """One whole tree from its rows, and its splits in best-first order; ``gh`` has gradient and hessian of all rows."""
    out = Growing(s, allowed, scale)
    out.put(1, grids.cells(rows, gh, allowed, n_bins))
    held = {1: rows}
    heap = [(-out.nodes[1].split[0], 1)] if out.nodes[1].split else []
    done: list[int] = []
    while heap and len(done) + 1 < s.leaves:
        _, at = heapq.heappop(heap)
        done.append(at)
        mine = held.pop(at)
        if len(done) + 1 == s.leaves or s.max_depth and at.bit_length() >= s.max_depth:
            # its children are not split any more
            continue
        _, feature, place, _ = out.nodes[at].split
        left = grids.bins[feature].take(mine) <= place
        held[2 * at], held[2 * at + 1] = mine[left], mine[~left]
        out.fill(at, grids.cells(held[out.smaller(at)], gh, allowed, n_bins))
        out.nodes[at].cells = None
        for child in (2 * at, 2 * at + 1):
            if out.nodes[child].split:
                heapq.heappush(heap, (-out.nodes[child].split[0], child))
    return out, done


def best_prefix(losses: Sequence[float], patience: int) -> int:
    """Number of trees with the least loss before ``patience`` trees in a row have brought no gain."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def sampled(row_hash: np.ndarray, seed: int, turn: int, share: float) -> np.ndarray:
    """Rows of one round's sample, by their hash."""
    if share >= 1:
        return np.ones(len(row_hash), bool)
    h = row_hash.view(np.uint64) ^ np.uint64((seed * 0x9E3779B97F4A7C15 + turn * 0xC2B2AE3D27D4EB4F) % (1 << 64))
    for factor in _MIX:
        h = (h ^ (h >> np.uint64(31))) * factor
    h ^= h >> np.uint64(31)
    return h < np.uint64(int(share * (1 << 63)) * 2)


def allowed_features(n: int, seed: int, turn: int, share: float) -> np.ndarray:
    out = np.ones(n, bool)
    if share < 1:
        out[:] = False
        out[np.random.default_rng([seed, turn]).permutation(n)[:max(1, round(share * n))]] = True
    return out


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


#: A block of rows: distinct weights x rows, features x rows of bins.
BLOCK = "n int, row_hash binary, y binary, fit binary, watch binary, bins binary"
BLOCK_SCHEMA = pa.schema([("n", pa.int32()), *((c, pa.binary()) for c in ("row_hash", "y", "fit", "watch", "bins"))])


#: row_hash, y, fit, watch, bins and margins of a block as arrays; margins are None before the first tree is in them.
Block = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]


def _arrays(row: Row) -> Block:
    """A block of the written table as arrays."""
    n = row[0]
    return (np.frombuffer(row[1], np.int64), np.frombuffer(row[2]), np.frombuffer(row[3]).reshape(-1, n),
            np.frombuffer(row[4]).reshape(-1, n), np.frombuffer(row[5], np.uint8).reshape(-1, n), None)


def _blocks(blocks: Iterator[Block], base: Sequence[float]) -> Iterator[Block]:
    """The blocks with their margins."""
    for row_hash, y, fit, watch, bins, margin in blocks:
        yield row_hash, y, fit, watch, bins, np.repeat(np.array(base)[:, None], len(y), axis=1) if margin is None else margin


def _block(n: int, *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), *(pa.array([c.tobytes()], pa.binary()) for c in columns)], schema=BLOCK_SCHEMA)


def _margin(margins: np.ndarray, m: int, since: Sequence[Routes], x: Columns) -> np.ndarray:
    out = margins[m].copy()
    for tree in since:
        out += tree.values_of(x)
    return out


@dataclass
class _Job:
    """What a pass counts for one model: rows are routed through ``route``, whose values are places of wanted leaves."""

    model: int
    since: list[Routes]
    route: Routes
    places: int
    features: np.ndarray
    turn: int
    losses: bool
    seed: int
    #: places of its weights
    fit: int
    watch: int


def _gradients(jobs: Sequence[_Job], scale: float, s: BoostSettings, base: Sequence[float], blocks: Iterator[Block],
               losses: np.ndarray):
    """(number of the job, bins, place, g, h) of the wanted rows of each block; adds to ``losses`` of the jobs."""
    for row_hash, y, fit, watch, bins, margins in _blocks(blocks, base):
        columns = Columns(bins)
        for j, job in enumerate(jobs):
            margin = _margin(margins, job.model, job.since, columns)
            if job.losses and (seen := watch[job.watch] > 0).any():
                f = margin[seen]
                w = watch[job.watch, seen]
                losses[j] += (np.rint(w * np.logaddexp(0, np.where(y[seen] > 0, -f, f)) * scale).sum(), np.rint(w * scale).sum(), len(w))
            place = job.route.values_of(columns).astype(np.int64)
            at = np.flatnonzero((fit[job.fit] > 0) & sampled(row_hash, job.seed, job.turn, s.subsample) & (place >= 0))
            if not len(at):
                continue
            p = 1 / (1 + np.exp(-margin.take(at)))
            w = fit[job.fit].take(at)
            yield j, bins.take(at, axis=1), place.take(at), np.rint(w * (p - (y.take(at) > 0)) * scale), np.rint(w * p * (1 - p) * scale)


def _count(jobs: Sequence[_Job], n_features: int, n_bins: int, scale: float, s: BoostSettings, base: Sequence[float]):
    """Blocks -> ((job, place), sums of features x bins x (G, H, n)), one of each per task; losses have place -1."""
    def run(blocks: Iterator[Block]) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
        cells = [np.zeros((3, n_features, job.places * n_bins)) for job in jobs]
        losses = np.zeros((len(jobs), 3))
        for j, x, place, g, h in _gradients(jobs, scale, s, base, blocks, losses):
            start = place * n_bins
            add = _adder(g, h, jobs[j].places * n_bins)
            for f in np.flatnonzero(jobs[j].features):
                cells[j][:, f] += add(start + x[f])
        for j, sums in enumerate(cells):
            grid = sums.reshape(3, n_features, jobs[j].places, n_bins).transpose(2, 1, 3, 0)
            yield from (((j, i), c.copy()) for i, c in enumerate(grid) if c[..., COUNT].any())
            if losses[j, 2]:
                yield (j, -1), losses[j]

    return run


def _ship(jobs: Sequence[_Job], scale: float, s: BoostSettings, base: Sequence[float]):
    """Blocks -> ((job, place), (bins, g, h)) of the wanted leaves of each block; losses have place -1."""
    def run(blocks: Iterator[Block]) -> Iterator[tuple[tuple[int, int], tuple]]:
        losses = np.zeros((len(jobs), 3))
        for j, x, place, g, h in _gradients(jobs, scale, s, base, blocks, losses):
            order = np.argsort(place, kind="stable")
            starts = np.searchsorted(place[order], np.arange(jobs[j].places + 1))
            for i, (lo, hi) in enumerate(zip(starts[:-1], starts[1:], strict=True)):
                if hi > lo:
                    at = order[lo:hi]
                    yield (j, i), (x.take(at, axis=1), g.take(at), h.take(at))
        yield from (((j, -1), (loss,)) for j, loss in enumerate(losses) if loss[2])

    return run


def _finish(jobs: Sequence[_Job], paths: Sequence[Sequence[int]], n_bins: int, scale: float, s: BoostSettings):
    """Rows of whole leaves -> (job, path, sums, split) of their nodes; of place -1 -> the sum of losses with path 0."""
    def run(parts: Iterator[tuple[tuple[int, int], tuple]]) -> Iterator[tuple]:
        leaves: dict[tuple[int, int], list[tuple]] = {}
        for key, part in parts:
            leaves.setdefault(key, []).append(part)
        while leaves:
            (j, place), found = leaves.popitem()
            if place < 0:
                yield j, 0, np.sum([loss for loss, in found], axis=0), None
                continue
            bins, g, h = (np.concatenate(c, axis=-1) for c in zip(*found, strict=True))
            del found
            for n in grow_rows(paths[j][place], bins.T, g, h, s, jobs[j].features, scale, n_bins).nodes.values():
                yield j, n.path, n.sums, n.split

    return run


def _alone(models: Sequence[tuple[float, int, int, int, bool]], edges: list[list[float]], n_bins: int, scale: float, s: BoostSettings):
    """Number of a task, all blocks -> (model, trees, losses); ``models`` has base, places of both weights, seed, whether to stop."""
    def run(model: int, blocks: Iterator[Block]) -> Iterator[tuple[int, list[tuple], list[float]]]:
        base, fit_at, watch_at, seed, stopping = models[model]
        parts = []
        for row_hash, y, fit, watch, bins, _ in blocks:
            own = np.flatnonzero((fit[fit_at] > 0) | (watch[watch_at] > 0))
            parts.append((row_hash.take(own), y.take(own) > 0, fit[fit_at].take(own), watch[watch_at].take(own), bins.take(own, axis=1)))
        if not parts:
            yield model, [], []
            return
        row_hash, y, w, seen_w = (np.concatenate([p[i] for p in parts]) for i in range(4))
        bins = np.empty((len(edges), len(y)), np.uint8)
        start = 0
        for i, part in enumerate(parts):
            bins[:, start:start + len(part[1])] = part[4]
            start += len(part[1])
            parts[i] = None
        grids = Grids(bins, [len(e) + 1 for e in edges])
        margin, fitted, gh = np.full(len(y), base), w > 0, np.empty((len(y), 2))
        seen = np.flatnonzero(seen_w > 0)
        seen_w, seen_y = seen_w.take(seen), y.take(seen)
        weight = np.rint(seen_w * scale).sum()
        trees: list[tuple] = []
        losses: list[float] = []
        for turn in range(s.n_estimators + 1):
            if turn and stopping:
                f = margin.take(seen)
                losses.append(float(np.rint(seen_w * np.logaddexp(0, np.where(seen_y, -f, f)) * scale).sum() / weight))
                if len(losses) - best_prefix(losses, s.patience) >= s.patience:
                    break
            if turn == s.n_estimators:
                break
            for lo in range(0, len(y), ROUTED):
                some = slice(lo, lo + ROUTED)
                p = 1 / (1 + np.exp(-margin[some]))
                gh[some, 0], gh[some, 1] = np.rint(w[some] * (p - y[some]) * scale), np.rint(w[some] * p * (1 - p) * scale)
            rows = np.flatnonzero(fitted & sampled(row_hash, seed, turn, s.subsample))
            grown, splits = grow_alone(grids, rows, gh, s, allowed_features(len(edges), seed, turn, s.colsample_bytree), scale, n_bins)
            if not splits:
                break
            tree = grown.tree(splits, edges)
            trees.append(tuple(getattr(tree, f.name) for f in fields(Tree)))
            route = Routes(tree)
            for lo in range(0, len(y), ROUTED):
                margin[lo:lo + ROUTED] += route.values_of(Columns(bins[:, lo:lo + ROUTED]))
        yield model, trees, losses

    return run


class _Boost:
    """A fit of several models on one table."""

    def __init__(self, path: str, rows: DataFrame, fit: Sequence[int], watch: Sequence[int], n_features: int, settings: BoostSettings,
                 seeds: Sequence[int]) -> None:
        """``fit`` and ``watch``: place of each model's weights in the arrays of ``rows``."""
        self.s, self.n_models, self.n_features, self.seeds = settings, len(fit), n_features, list(seeds)
        self.fits, self.watches = list(fit), list(watch)
        self.sc = rows.sparkSession.sparkContext
        self.path, self.spark = path, _plain(rows.sparkSession)
        models, kinds, held = range(self.n_models), range(max(fit) + 1), range(max(watch) + 1)
        found = [r or 0.0 for r in rows.select(
            *[F.sum(F.col("fit")[i]) for i in kinds], *[F.sum(F.when(F.col("y") > 0, F.col("fit")[i])) for i in kinds],
            *[F.count_if(F.col("fit")[i] > 0) for i in kinds], *[F.sum(F.col("watch")[i]) for i in held], F.count(F.lit(1))).first()]
        n = len(kinds)
        weights, positive, self.counts = ([found[k * n + fit[m]] for m in models] for k in range(3))
        watched = [found[3 * n + watch[m]] for m in models]
        most = max(1.0, *weights, *watched)
        # log losses of a row may be some times its weight; all sums stay below 2^53
        self.scale = float(2 ** min(30, 46 - math.ceil(math.log2(most))))
        self.base = []
        for m in models:
            share = min(max(positive[m] / weights[m] if weights[m] else 0.5, 1e-12), 1 - 1e-12)
            self.base.append(math.log(share / (1 - share)))
        self.watched = [bool(w) for w in watched]
        # bins, places in grids, weights, margin, label and hash, and what a tree needs
        self.alone = found[-1] * (2 * n_features + 64) <= ALONE // min(2, self.n_models)
        #: blocks as of the last checkpoint, the trees since then, and those with later margins if there are any
        self.saved, self.added, self.kept = self._keep(self._read()), [[] for _ in models], None

    def _read(self) -> RDD:
        """The written blocks, dealt evenly to tasks."""
        blocks = self.spark.read.schema(BLOCK).parquet(self.path).rdd.map(_arrays).zipWithIndex()
        parts = max(self.sc.defaultParallelism, blocks.getNumPartitions())
        return blocks.map(lambda b: (b[1], b[0])).partitionBy(parts, lambda i: i).values()

    def _keep(self, blocks: RDD) -> RDD:
        return blocks.persist(StorageLevel.MEMORY_AND_DISK)

    def fit(self, edges: list[list[float]]) -> list[tuple[float, list[Tree], list[float]]]:
        """(start margin, trees, watched loss after each tree) of each model."""
        try:
            return self._fit_alone(edges) if self.alone else self._fit(edges)
        finally:
            for blocks in (self.saved, self.kept):
                if blocks is not None:
                    blocks.unpersist()

    def _fit_alone(self, edges: list[list[float]]) -> list[tuple[float, list[Tree], list[float]]]:
        """Every model by a task of its own, which reads all blocks."""
        s, edges = self.s, [e or [0.0] for e in edges]
        models = [(self.base[m], self.fits[m], self.watches[m], self.seeds[m], s.patience > 0 and self.watched[m])
                  for m in range(self.n_models)]
        blocks = self._rows()
        # all tasks keep them first
        blocks.count()
        run = _alone(models, edges, max(len(e) for e in edges) + 1, self.scale, s)
        found = self.sc.union([blocks.coalesce(1)] * self.n_models).mapPartitionsWithIndex(run).collect()
        out = []
        for m, trees, losses in sorted(found, key=lambda f: f[0]):
            trees = [Tree(*t) for t in trees]
            out.append((self.base[m], trees[:best_prefix(losses, s.patience)] if losses else trees, losses))
        return out

    def _fit(self, edges: list[list[float]]) -> list[tuple[float, list[Tree], list[float]]]:
        s = self.s
        self.edges = [e or [0.0] for e in edges]
        self.n_bins = max(len(e) for e in self.edges) + 1
        trees: list[list[Tree]] = [[] for _ in range(self.n_models)]
        self.since: list[list[Routes]] = [[] for _ in range(self.n_models)]
        losses: list[list[float]] = [[] for _ in range(self.n_models)]
        active = [m for m in range(self.n_models)]
        stopping = s.patience > 0
        for turn in range(s.n_estimators + 1):
            if turn and turn < s.n_estimators and (turn % KEEP_EVERY == 0 or turn % WRITE_EVERY == 0):
                self._keep_margins(turn % WRITE_EVERY == 0)
            growing = {m: Growing(s, allowed_features(self.n_features, self.seeds[m], turn, s.colsample_bytree), self.scale)
                       for m in active}
            last = turn == s.n_estimators
            if last and not (stopping and any(self.watched[m] for m in active)):
                break
            root = Routes(Tree([0], [0], [0.0], [0], [0], [0.0], [0.0], [0.0]))
            jobs = [self._job(m, root, 1, growing[m], turn, stopping and self.watched[m]) for m in active]
            small = [j for j in jobs if self.counts[j.model] <= SMALL and not last]
            large = [j for j in jobs if j not in small]
            found = self._finish_leaves(small, [[1] for _ in small], growing) if small else {}
            if large:
                cells, more = self._pass(large)
                for job, c in zip(large, cells, strict=True):
                    growing[job.model].put(1, c[0])
                found |= more
            for m, loss in found.items():
                if turn:
                    losses[m].append(loss)
            if last:
                break
            for m in list(active):
                if losses[m] and len(losses[m]) - best_prefix(losses[m], s.patience) >= s.patience:
                    active.remove(m)
                    del growing[m]
            self._grow(growing, turn)
            for m, g in growing.items():
                splits, _ = g.order()
                if not splits:
                    active.remove(m)
                    continue
                trees[m].append(g.tree(splits, self.edges))
                self.since[m].append(Routes(trees[m][-1]))
            if not active:
                break
        for m in range(self.n_models):
            if losses[m]:
                trees[m] = trees[m][:best_prefix(losses[m], s.patience)]
        return list(zip(self.base, trees, losses, strict=True))

    def _grow(self, growing: dict[int, Growing], turn: int) -> None:
        """Fetch what the best order of each model needs until it is known."""
        while True:
            needs = {m: g.order()[1] for m, g in growing.items()}
            if not any(needs.values()):
                return
            counted, shipped, counted_paths, shipped_paths = [], [], [], []
            for m, paths in needs.items():
                g = growing[m]
                g.expanded |= set(paths)
                few = [p for p in paths if max(g.child_sums(2 * p)[COUNT], g.child_sums(2 * p + 1)[COUNT]) <= SMALL]
                many = [p for p in paths if p not in few]
                if many:
                    route = Routes(g.tree(g.expanded, self.edges, {g.smaller(p): i for i, p in enumerate(many)}))
                    counted.append(self._job(m, route, len(many), g, turn))
                    counted_paths.append(many)
                if few:
                    children = [c for p in few for c in (2 * p, 2 * p + 1)]
                    route = Routes(g.tree(g.expanded, self.edges, {c: i for i, c in enumerate(children)}))
                    shipped.append(self._job(m, route, len(children), g, turn))
                    shipped_paths.append(children)
            if counted:
                cells, _ = self._pass(counted)
                for job, paths, c in zip(counted, counted_paths, cells, strict=True):
                    for i, path in enumerate(paths):
                        growing[job.model].fill(path, c[i])
            if shipped:
                self._finish_leaves(shipped, shipped_paths, growing)

    def _job(self, m: int, route: Routes, places: int, g: Growing, turn: int, losses: bool = False) -> _Job:
        return _Job(m, self.since[m], route, places, g.allowed, turn, losses, self.seeds[m], self.fits[m], self.watches[m])

    def _finish_leaves(self, jobs: list[_Job], paths: list[list[int]], growing: dict[int, Growing]) -> dict[int, float]:
        """Let one task for each leaf of ``paths`` find all nodes below; the watched losses by model."""
        sizes = {(j, i): growing[job.model].child_sums(p)[COUNT] if p > 1 else self.counts[job.model]
                 for j, job in enumerate(jobs) for i, p in enumerate(paths[j])}
        # no task gets many more rows than a leaf may have; large leaves first, each to the task with the fewest rows
        parts = min(len(sizes), max(2 * self.sc.defaultParallelism, math.ceil(sum(sizes.values()) / SMALL)))
        loads = [(0, i) for i in range(parts)]
        place = {(j, -1): j % parts for j in range(len(jobs))}
        for key in sorted(sizes, key=lambda k: (-sizes[k], k)):
            rows, i = heapq.heappop(loads)
            place[key] = i
            heapq.heappush(loads, (rows + sizes[key], i))
        found = self._rows().mapPartitions(_ship(jobs, self.scale, self.s, self.base)).partitionBy(parts, place.__getitem__).mapPartitions(
            _finish(jobs, paths, self.n_bins, self.scale, self.s)).collect()
        losses = {}
        for j, path, sums, split in found:
            if path:
                growing[jobs[j].model].nodes[path] = _Node(path, sums, None, split)
            else:
                losses[jobs[j].model] = float(sums[0] / sums[1])
        return losses

    def _rows(self) -> RDD:
        return self.saved if self.kept is None else self.kept

    def _pass(self, jobs: list[_Job]) -> tuple[list[np.ndarray], dict[int, float]]:
        """Cells (places x features x bins x 3) of each job, and the watched losses by model."""
        found = self._rows().mapPartitions(_count(jobs, self.n_features, self.n_bins, self.scale, self.s, self.base))
        size = 24 * self.n_features * self.n_bins * sum(job.places for job in jobs)
        if size * found.getNumPartitions() > DIRECT:
            found = found.reduceByKey(np.add, min(found.getNumPartitions(), self.sc.defaultParallelism))
        out = [np.zeros((job.places, self.n_features, self.n_bins, 3)) for job in jobs]
        losses: dict[int, np.ndarray] = {}
        for (j, place), sums in found.collect():
            if place < 0:
                losses[j] = losses.get(j, 0) + sums
            else:
                out[j][place] += sums
        for job, grid in zip(jobs, out, strict=True):
            off = np.flatnonzero(job.features)[0]
            # features that are left out this time still carry the sums of the leaf
            lone = ~job.features
            grid[:, lone] = 0
            grid[:, lone, 0] = grid[:, off].sum(axis=1)[:, None]
        return out, {jobs[j].model: float(sums[0] / sums[1]) for j, sums in losses.items()}

    def _keep_margins(self, save: bool) -> None:
        """Keep blocks with the margins of all trees so far, made from the last saved ones; ``save``: to the checkpoint folder as well."""
        self.added = [a + s for a, s in zip(self.added, self.since, strict=True)]
        self.since = [[] for _ in self.since]
        added, base = self.added, self.base

        def run(blocks: Iterator[Block]) -> Iterator[Block]:
            for row_hash, y, fit, watch, bins, margins in _blocks(blocks, base):
                x = Columns(bins)
                yield row_hash, y, fit, watch, bins, np.stack([_margin(margins, m, added[m], x) for m in range(len(margins))])

        new = self._keep(self.saved.mapPartitions(run, preservesPartitioning=True))
        if self.kept is not None:
            self.kept.unpersist()
        self.kept = new
        if save:
            ensure_checkpoint_dir(self.spark)
            new.checkpoint()
            # writes it at once, so that what it was made from can go
            new.count()
            self.saved.unpersist()
            self.saved, self.kept, self.added = new, None, [[] for _ in added]


def _plain(spark: SparkSession) -> SparkSession:
    """A session of the same application for the passes: their few cells need no adaptive planning and few partitions."""
    own = spark.newSession()
    own.conf.set("spark.sql.adaptive.enabled", "false")
    # a row of the table is a block of rows
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    own.conf.set("spark.sql.shuffle.partitions", str(min(8, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return own


def boost(rows: DataFrame, fit: Sequence[Column], watch: Sequence[Column], settings: BoostSettings, label: str = "Target",
          features: str = "features", id_col: str = "ID", seeds: Sequence[int] | None = None) -> list[BoostedModel]:
    """One model for each pair of ``fit`` and ``watch``: row weights that learn and row weights that decide when to stop.

    A weight of 0 or null leaves a row out. All models grow in the same passes. ``seeds`` gives each model its own.
    With ``patience``, a model stops once the watched log loss has not
    fallen for so many trees, and keeps the trees up to the least loss.
    """
    def weights(columns: Sequence[Column]) -> Column:
        return F.array(*[F.coalesce(c.cast("double"), F.lit(0.0)) for c in columns])

    # models that share their weights share the column
    fits, watches = ({id(c): c for c in columns} for columns in (fit, watch))
    used = materialize(rows.select(
        F.xxhash64(F.col(id_col).cast("string")).alias("row_hash"), F.col(label).cast("double").alias("y"),
        weights([*fits.values()]).alias("fit"), weights([*watches.values()]).alias("watch"), vector_to_array(features).alias("bins")))
    size = used.select(F.size("bins").alias("n")).first()
    if size is None:
        raise ValueError("no rows to learn from")
    edges = bin_edges(used, size.n, settings.max_bins, "bins")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = _matrix(batch.column(4), n)
            bins = np.empty(x.shape[::-1], np.uint8)
            for f, e in enumerate(edges):
                bins[f] = np.searchsorted(np.array(e), x[:, f], "left")
            yield _block(n, batch.column(0).to_numpy(), batch.column(1).to_numpy(), _matrix(batch.column(2), n).T,
                         _matrix(batch.column(3), n).T, bins)

    path = write_table(used.where(F.exists("fit", lambda w: w > 0) | F.exists("watch", lambda w: w > 0)).mapInArrow(cut, BLOCK))
    at = ([[*kinds].index(id(c)) for c in columns] for kinds, columns in ((fits, fit), (watches, watch)))
    found = _Boost(path, used, *at, size.n, settings, seeds or [settings.seed] * len(fit)).fit(edges)
    return [BoostedModel.of(base, trees, losses, size.n, settings, features) for base, trees, losses in found]


class _Columns(Params):
    featuresCol = Param(Params._dummy(), "featuresCol", "vector of features", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label, 1 is positive", TypeConverters.toString)
    weightCol = Param(Params._dummy(), "weightCol", "row weight", TypeConverters.toString)
    idCol = Param(Params._dummy(), "idCol", "row ID, for samples", TypeConverters.toString)
    settings = Param(Params._dummy(), "settings", "settings as JSON", TypeConverters.toString)


class Booster(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Estimator of one model; ``watch`` names a column that is true for rows that only decide when to stop."""

    watchCol = Param(Params._dummy(), "watchCol", "rows that decide when to stop; empty: none", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="Target", weightCol="weight", idCol="ID", watchCol="", settings="{}"):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="Target", weightCol="weight", idCol="ID", watchCol="", settings="{}")
        self._set(**self._input_kwargs)

    def boost_settings(self) -> BoostSettings:
        return BoostSettings(**json.loads(self.getOrDefault(self.settings)))

    def getMaxIter(self) -> int:
        return self.boost_settings().n_estimators

    def getMaxDepth(self) -> int:
        return self.boost_settings().max_depth

    def setFeaturesCol(self, name: str) -> Booster:
        return self._set(featuresCol=name)

    def _fit(self, dataset: DataFrame) -> BoostedModel:
        get = self.getOrDefault
        w = F.col(get(self.weightCol)) if get(self.weightCol) in dataset.columns else F.lit(1.0)
        held = F.col(get(self.watchCol)) if get(self.watchCol) else F.lit(False)
        return boost(dataset, [F.when(~held, w)], [F.when(held, w)], self.boost_settings(), get(self.labelCol), get(self.featuresCol),
                     get(self.idCol))[0]


class BoostedModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted trees; adds ``margin`` and ``probability`` to rows with a feature vector."""

    trees = Param(Params._dummy(), "trees", "base margin, trees and losses as JSON", TypeConverters.toString)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(featuresCol="features", settings="{}", trees="{}")

    @classmethod
    def of(cls, base: float, trees: list[Tree], losses: list[float], n_features: int, settings: BoostSettings, features: str):
        state = {"base": base, "trees": [asdict(t) for t in trees], "losses": losses, "n_features": n_features}
        return cls()._set(trees=json.dumps(state), settings=json.dumps(asdict(settings)), featuresCol=features)

    def _state(self) -> dict:
        return json.loads(self.getOrDefault(self.trees))

    @property
    def base(self) -> float:
        return self._state()["base"]

    @property
    def losses(self) -> list[float]:
        return self._state()["losses"]

    def tree_list(self) -> list[Tree]:
        return [Tree(**t) for t in self._state()["trees"]]

    @property
    def getNumTrees(self) -> int:
        return len(self._state()["trees"])

    @property
    def featureImportances(self):
        """Share of the total gain of each feature."""
        state = self._state()
        sums = np.zeros(state["n_features"])
        for t in state["trees"]:
            np.add.at(sums, t["feature"], t["gain"])
        return Vectors.dense(sums / sums.sum() if sums.sum() > 0 else sums)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        base, trees = self.base, self.tree_list()
        n_features = self._state()["n_features"]
        # a value is at most a threshold if its place among the thresholds of the feature is at most that one's
        ends: list[set[float]] = [set() for _ in range(n_features)]
        for t in trees:
            for i in t.inner():
                ends[t.feature[i]].add(t.at[i])
        cuts = [sorted(e) for e in ends]
        places = [{at: i for i, at in enumerate(c)} for c in cuts]
        routes = [Routes(replace(t, bin=[places[f].get(at, 0) if left != i else 0
                                         for i, (f, at, left) in enumerate(zip(t.feature, t.at, t.left, strict=True))])) for t in trees]
        few = max(map(len, cuts), default=0) < 256

        @F.pandas_udf("double")
        def margin(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=float)
            rows = np.stack(x.to_numpy())
            out = np.full(len(rows), base)
            if not few:
                for r in routes:
                    out += r.value[r.of_values(rows)]
                return pd.Series(out)
            columns = Columns(np.stack([np.searchsorted(np.array(c), v, "left") for c, v in zip(cuts, rows.T, strict=True)]).astype(np.uint8))
            for r in routes:
                out += r.values_of(columns)
            return pd.Series(out)

        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("margin")))
        scored = dataset.withColumn("margin", margin(vector_to_array(self.getOrDefault(self.featuresCol))))
        return scored.withColumn("probability", array_to_vector(F.array(F.lit(1.0) - p, p)))


SETTING_NAMES = frozenset(f.name for f in fields(BoostSettings))

# task functions travel with the job, so executors need no copy of the library
cloudpickle.register_pickle_by_value(sys.modules[__name__])
