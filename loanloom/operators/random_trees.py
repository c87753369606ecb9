"""Extremely randomised trees: one seeded random threshold per node and feature, all trees level by level.

A level takes two passes over the rows. The first one finds the least and
largest value of every feature in every open node; features that are constant
in a node drop out, some of the others are drawn, and each gets a threshold
drawn between its two ends. The second pass sums the label weights left of each
threshold, and the drawn split with the least Gini impurity is taken. Draws are
hashes of seed, tree, node and feature; sums are of whole numbers: a fit does not
depend on row order or partitions.

Only sums per node reach the driver, for at most ``NODES`` nodes at a time. Rows
that fit into a task are not passed over level by level: there every task holds
them all and grows some of the trees, with rows dealt to nodes, by the same draws
and sums.
Every tree learns from all rows; nodes are split until they are pure, too small
or at the depth limit.
"""

from __future__ import annotations

import json
import math
import sys
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.operators.boosting import ALONE, Routes, Tree, _Columns, _matrix, _plain
from loanloom.session import write_table

#: Open nodes whose sums are held at once.
NODES = 16_384
_ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class RandomTreeSettings:
    n_estimators: int = 300
    max_depth: int = 30
    min_child_samples: int = 1
    max_features: int = 0
    seed: int = 43


def draws(seed: int, kind: int, tree: np.ndarray, path: np.ndarray, n_features: int) -> np.ndarray:
    """Numbers in [0, 1) for each (tree, path) and feature."""
    with np.errstate(over="ignore"):
        h = (tree.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + path.astype(np.uint64)) * _ODD + np.uint64(
            (seed * 0x165667B19E3779F9 + kind) % (1 << 64))
        h = h[:, None] + np.arange(1, n_features + 1, dtype=np.uint64) * np.uint64(0x27D4EB2F165667C5)
        for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
            h = (h ^ (h >> np.uint64(30))) * np.uint64(factor)
        h ^= h >> np.uint64(31)
    return (h >> np.uint64(11)) / float(1 << 53)


def choose(low: np.ndarray, high: np.ndarray, tree: np.ndarray, path: np.ndarray, seed: int, k: int):
    """(features, thresholds), nodes x k: the first k features that vary, in drawn order; feature -1 where there are fewer."""
    order = np.where(high > low, draws(seed, 1, tree, path, low.shape[1]), np.inf)
    picked = np.argsort(order, axis=1, kind="stable")[:, :k]
    rows = np.arange(len(low))[:, None]
    lo, hi = low[rows, picked], high[rows, picked]
    at = lo + draws(seed, 2, tree, path, low.shape[1])[rows, picked] * (hi - lo)
    # rounding must not put the largest value on the left
    at = np.where(at < hi, at, lo)
    return np.where(np.isfinite(order[rows, picked]), picked, -1), at


def purity(pos: np.ndarray, neg: np.ndarray) -> np.ndarray:
    """Higher is better: the part of Gini's index that a split changes."""
    total = pos + neg
    return np.divide(pos * pos + neg * neg, total, out=np.zeros_like(total), where=total > 0)


@dataclass
class _Open:
    """Open nodes of one turn, in order of tree; each has a place in the arrays."""

    tree: np.ndarray
    path: np.ndarray
    routes: dict[int, Routes]


def _routed(batches: Iterator[pa.RecordBatch], open_: _Open):
    """(columns, labels, weights, rows, places): rows of each batch that are in open nodes of one tree, features x rows of values."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        y, w, x = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _matrix(batch.column(2), n)
        columns = np.ascontiguousarray(x.T)
        for route in open_.routes.values():
            place = route.value[route.of_values(x)].astype(np.int64)
            rows = np.flatnonzero(place >= 0)
            if len(rows):
                yield columns, y, w, rows, place[rows]


def _ranges(open_: _Open, n_features: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = np.full((len(open_.tree), n_features), np.inf)
        high = np.full((len(open_.tree), n_features), -np.inf)
        for x, _, _, rows, place in _routed(batches, open_):
            # places are below NODES; numbers of 16 bits are sorted by their digits
            short = place.astype(np.uint16)
            order = np.argsort(short, kind="stable")
            short, rows = short.take(order), rows.take(order)
            first = np.flatnonzero(np.r_[True, short[1:] != short[:-1]])
            at = short[first]
            for f in range(n_features):
                values = x[f].take(rows)
                low[at, f] = np.minimum(low[at, f], np.minimum.reduceat(values, first))
                high[at, f] = np.maximum(high[at, f], np.maximum.reduceat(values, first))
        cell = np.flatnonzero(np.isfinite(low.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(low.ravel()[cell]), pa.array(high.ravel()[cell])], ["cell", "low", "high"])

    return run


def _sides(open_: _Open, feature: np.ndarray, at: np.ndarray, scale: float):
    """Sums of positive and negative weight and of rows left of each drawn threshold."""
    n, k = feature.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, k, n))
        for x, y, w, rows, place in _routed(batches, open_):
            weight, positive = np.rint(w[rows] * scale), y[rows] > 0
            # the nodes of a tree lie side by side
            start = int(place.min())
            size = int(place.max()) - start + 1
            own = place - start
            here, width = slice(start, start + size), x.shape[1]
            for j in range(k):
                f = feature[here, j].take(own)
                left = np.flatnonzero((x.ravel().take(np.maximum(f, 0) * width + rows) <= at[here, j].take(own)) & (f >= 0))
                own_left = own.take(left)
                both = np.bincount(2 * own_left + positive.take(left), weight.take(left), 2 * size)
                sums[0, j, here] += both[1::2]
                sums[1, j, here] += both[::2]
                sums[2, j, here] += np.bincount(own_left, minlength=size)
        flat = sums.reshape(3, -1)
        cell = np.flatnonzero(flat[2])
        yield pa.RecordBatch.from_arrays([pa.array(cell), *[pa.array(c.astype(np.int64)) for c in flat[:, cell]]],
                                         ["cell", "pos", "neg", "n"])

    return run


class _Forest:
    def __init__(self, s: RandomTreeSettings) -> None:
        self.s = s
        # per tree: path -> (feature, threshold), and path -> (positive weight, negative weight, rows)
        self.splits: list[dict[int, tuple[int, float]]] = [{} for _ in range(s.n_estimators)]
        self.sums: list[dict[int, np.ndarray]] = [{} for _ in range(s.n_estimators)]

    def tree(self, t: int, places: dict[int, int] | None = None) -> Tree:
        """One tree; with ``places`` its leaf values are the places of open paths, else -1."""
        out, todo = Tree(), [(1, -1, False)]
        while todo:
            path, parent, right = todo.pop()
            i = len(out.feature)
            if parent >= 0:
                (out.right if right else out.left)[parent] = i
            pos, neg, n = self.sums[t].get(path, np.zeros(3))
            out.bin.append(0)
            out.cover.append(float(n))
            feature, at = self.splits[t].get(path, (0, 0.0))
            out.feature.append(int(feature))
            out.at.append(float(at))
            if path in self.splits[t]:
                left, right_ = self.sums[t][2 * path], self.sums[t][2 * path + 1]
                gain = purity(left[0], left[1]) + purity(right_[0], right_[1]) - purity(pos, neg)
                out.gain.append(float(gain))
                out.value.append(0.0)
                out.left.append(-1)
                out.right.append(-1)
                out.depth = max(out.depth, path.bit_length())
                todo += [(2 * path + 1, i, True), (2 * path, i, False)]
            else:
                share = pos / (pos + neg) if pos + neg else 0.5
                out.gain.append(0.0)
                out.value.append(float(share) if places is None else float(places.get(path, -1)))
                out.left.append(i)
                out.right.append(i)
        return out


def grow_forest(rows: DataFrame, weight: Column, s: RandomTreeSettings, label: str = "Target", features: str = "features"
                ) -> tuple[list[Tree], int]:
    """Trees and number of features. Leaf values are shares of positive weight."""
    used = rows.select(F.col(label).cast("double").alias("y"), weight.cast("double").alias("w"), vector_to_array(features).alias("x"))
    schema = "y double, w double, x array<double>"
    path_ = write_table(used.where("w > 0"))
    own = _plain(rows.sparkSession)
    # rows come one by one here, not in blocks
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows.sparkSession.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    table = own.read.schema(schema).parquet(path_)
    whole = table.agg(F.sum(F.when(F.col("y") > 0, F.col("w"))), F.sum("w"), F.count(F.lit(1)), F.max(F.size("x"))).first()
    if not whole[2]:
        raise ValueError("no rows to learn from")
    n_features = whole[3]
    k = s.max_features or max(1, math.isqrt(n_features))
    scale = float(2 ** min(30, 51 - math.ceil(math.log2(max(whole[1], 1.0)))))
    forest = _Forest(s)
    # the sums of the roots by the same rounding as all others
    root = table.agg(F.sum(F.when(F.col("y") > 0, F.rint(F.col("w") * scale)).otherwise(0.0)),
                     F.sum(F.when(F.col("y") > 0, 0.0).otherwise(F.rint(F.col("w") * scale))), F.count(F.lit(1))).first()
    if whole[2] * (16 * n_features + 64) <= ALONE // 2:
        _grow_alone(table, forest, np.array(root, float), k, scale)
        return [forest.tree(t) for t in range(s.n_estimators)], n_features
    todo = []
    for t in range(s.n_estimators):
        forest.sums[t][1] = np.array(root, float)
        todo.append((t, 1))
    while todo:
        todo = [(t, p) for t, p in todo if _splits_on(forest.sums[t][p], p, s)]
        following = []
        for lo in range(0, len(todo), NODES):
            following += _level(table, forest, todo[lo:lo + NODES], n_features, k, scale)
        todo = following
    return [forest.tree(t) for t in range(s.n_estimators)], n_features


def _grow_alone(table: DataFrame, forest: _Forest, root: np.ndarray, k: int, scale: float) -> None:
    """Let tasks that each read all rows grow the trees."""
    n = forest.s.n_estimators
    sc = table.sparkSession.sparkContext
    tasks = min(n, max(2, sc.defaultParallelism))
    blocks = table.mapInArrow(_packed, "y binary, w binary, x binary").rdd.map(tuple).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # all tasks keep them first
        blocks.count()
        found = sc.union([blocks.coalesce(1)] * tasks).mapPartitionsWithIndex(_whole_trees(forest.s, tasks, root, k, scale)).collect()
    finally:
        blocks.unpersist()
    for t, split, feature, at, path, sums in found:
        forest.splits[t] = dict(zip(split.tolist(), zip(feature.tolist(), at.tolist(), strict=True), strict=True))
        forest.sums[t] = dict(zip(path.tolist(), sums, strict=True))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labels, weights and features x rows of each batch."""
    for batch in batches:
        if batch.num_rows:
            columns = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _matrix(batch.column(2), batch.num_rows).T
            yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in columns], ["y", "w", "x"])


def _whole_trees(s: RandomTreeSettings, tasks: int, root: np.ndarray, k: int, scale: float):
    """Number of a task, all blocks -> its trees."""
    def run(task: int, blocks: Iterator[tuple[bytes, bytes, bytes]]) -> Iterator[tuple]:
        parts = []
        for y, w, x in blocks:
            y = np.frombuffer(y)
            parts.append((y > 0, np.rint(np.frombuffer(w) * scale), np.frombuffer(x).reshape(-1, len(y))))
        positive, weight, x = (np.concatenate(c, axis=-1) for c in zip(*parts, strict=True))
        parts.clear()
        for t in range(task, s.n_estimators, tasks):
            yield t, *_one_tree(t, positive, weight, x, s, root, k)

    return run


def _one_tree(t: int, positive: np.ndarray, weight: np.ndarray, x: np.ndarray, s: RandomTreeSettings, root: np.ndarray, k: int):
    """Paths, features and thresholds of the splits of a tree, and paths and sums of its nodes; ``x`` is features x rows."""
    n_features, width = x.shape
    split, picked, cuts, paths, sums = [], [], [], [np.array([1])], [root[None]]
    # rows in order of their open nodes, and where the rows of each begin
    rows, path, total = np.arange(width), np.array([1]), root[None]
    starts = np.array([0, width])
    while True:
        open_ = np.array([_splits_on(c, int(p), s) for c, p in zip(total, path, strict=True)], bool)
        if not open_.any():
            break
        size = np.diff(starts)
        rows = rows[np.repeat(open_, size)]
        path, total, size = path[open_], total[open_], size[open_]
        starts = np.r_[0, np.cumsum(size)]
        first, place = starts[:-1], np.repeat(np.arange(len(path)), size)
        low, high = np.empty((len(path), n_features)), np.empty((len(path), n_features))
        for f in range(n_features):
            values = x[f].take(rows)
            low[:, f], high[:, f] = np.minimum.reduceat(values, first), np.maximum.reduceat(values, first)
        feature, at = choose(low, high, np.full(len(path), t), path, s.seed, k)
        own, own_positive = weight.take(rows), positive.take(rows)
        on_left, left = [], np.zeros((len(path), feature.shape[1], 3))
        for j in range(feature.shape[1]):
            f = feature[:, j].take(place)
            on_left.append((x.ravel().take(np.maximum(f, 0) * width + rows) <= at[:, j].take(place)) & (f >= 0))
            here = place[on_left[j]]
            both = np.bincount(2 * here + own_positive[on_left[j]], own[on_left[j]], 2 * len(path))
            left[:, j, 0], left[:, j, 1], left[:, j, 2] = both[1::2], both[::2], np.bincount(here, minlength=len(path))
        right, best, fits = _best(left, total, feature, s)
        # the rows of a split node go to its left child, then to its right one
        i, j = np.flatnonzero(fits), best[fits]
        goes = np.stack(on_left)[best.take(place), np.arange(len(place))]
        stay = fits.take(place)
        rows, child = rows[stay], (2 * np.cumsum(fits) - 2).take(place)[stay] + ~goes[stay]
        kind = np.uint16 if 2 * len(i) <= 1 << 16 else np.int64
        rows = rows.take(np.argsort(child.astype(kind), kind="stable"))
        starts = np.r_[0, np.cumsum(np.bincount(child, minlength=2 * len(i)))]
        split.append(path[i])
        picked.append(feature[i, j])
        cuts.append(at[i, j])
        path = np.stack([2 * path[i], 2 * path[i] + 1], axis=1).ravel()
        total = np.stack([left[i, j], right[i, j]], axis=1).reshape(-1, 3)
        paths.append(path)
        sums.append(total)
    none = [np.zeros(0)]
    return (np.concatenate(split or none).astype(np.int64), np.concatenate(picked or none).astype(np.int64), np.concatenate(cuts or none),
            np.concatenate(paths).astype(np.int64), np.concatenate(sums))


def _best(left: np.ndarray, total: np.ndarray, feature: np.ndarray, s: RandomTreeSettings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums on the right, the best drawn split of each node, and whether there is one."""
    right = total[:, None] - left
    fits = (feature >= 0) & (left[..., 2] >= s.min_child_samples) & (right[..., 2] >= s.min_child_samples)
    score = np.where(fits, purity(left[..., 0], left[..., 1]) + purity(right[..., 0], right[..., 1]), -np.inf)
    best = np.argmax(score, axis=1)
    return right, best, np.isfinite(score[np.arange(len(best)), best])


def _splits_on(sums: np.ndarray, path: int, s: RandomTreeSettings) -> bool:
    pos, neg, n = sums
    return path.bit_length() <= s.max_depth and pos > 0 and neg > 0 and n >= 2 * s.min_child_samples


def _level(table: DataFrame, forest: _Forest, nodes: list[tuple[int, int]], n_features: int, k: int, scale: float) -> list[tuple[int, int]]:
    """Split some open nodes; gives their children."""
    s = forest.s
    tree, path = (np.array(v, np.int64) for v in zip(*nodes, strict=True))
    places: dict[int, dict[int, int]] = {}
    for i, (t, p) in enumerate(nodes):
        places.setdefault(t, {})[p] = i
    open_ = _Open(tree, path, {t: Routes(forest.tree(t, at)) for t, at in places.items()})
    found = table.mapInArrow(_ranges(open_, n_features), "cell long, low double, high double").groupBy("cell").agg(
        F.min("low").alias("low"), F.max("high").alias("high")).toArrow()
    low, high = (np.zeros(len(nodes) * n_features) for _ in range(2))
    cell = found.column(0).to_numpy()
    low[cell], high[cell] = found.column(1).to_numpy(), found.column(2).to_numpy()
    feature, at = choose(low.reshape(-1, n_features), high.reshape(-1, n_features), tree, path, s.seed, k)
    found = table.mapInArrow(_sides(open_, feature, at, scale), "cell long, pos long, neg long, n long").groupBy("cell").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("n").alias("n")).toArrow()
    sums = np.zeros((feature.shape[1] * len(nodes), 3))
    sums[found.column(0).to_numpy()] = np.stack([found.column(i).to_numpy() for i in (1, 2, 3)], axis=1)
    left = sums.reshape(feature.shape[1], len(nodes), 3).transpose(1, 0, 2)
    right, best, fits = _best(left, np.stack([forest.sums[t][p] for t, p in nodes]), feature, s)
    out = []
    for i, (t, p) in enumerate(nodes):
        j = best[i]
        if fits[i]:
            forest.splits[t][p] = (int(feature[i, j]), float(at[i, j]))
            forest.sums[t][2 * p], forest.sums[t][2 * p + 1] = left[i, j], right[i, j]
            out += [(t, 2 * p), (t, 2 * p + 1)]
    return out


class RandomTrees(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Estimator of a forest of extremely randomised trees."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="Target", weightCol="weight", settings="{}"):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="Target", weightCol="weight", settings="{}")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> ForestModel:
        get = self.getOrDefault
        weight = F.col(get(self.weightCol)) if get(self.weightCol) in dataset.columns else F.lit(1.0)
        trees, n = grow_forest(dataset, weight, RandomTreeSettings(**json.loads(get(self.settings))), get(self.labelCol),
                               get(self.featuresCol))
        state = {"trees": [asdict(t) for t in trees], "n_features": n}
        return ForestModel()._set(trees=json.dumps(state), settings=get(self.settings), featuresCol=get(self.featuresCol))


class ForestModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted forest; adds ``probability``, the mean of the leaf shares."""

    trees = Param(Params._dummy(), "trees", "trees as JSON", TypeConverters.toString)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(featuresCol="features", settings="{}", trees="{}")

    def tree_list(self) -> list[Tree]:
        return [Tree(**t) for t in json.loads(self.getOrDefault(self.trees))["trees"]]

    @property
    def getNumTrees(self) -> int:
        return len(self.tree_list())

    @property
    def featureImportances(self):
        """Share of the total fall of impurity of each feature, each tree with the same say."""
        state = json.loads(self.getOrDefault(self.trees))
        sums = np.zeros(state["n_features"])
        for t in state["trees"]:
            own = np.zeros(state["n_features"])
            np.add.at(own, t["feature"], t["gain"])
            sums += own / own.sum() if own.sum() > 0 else 0.0
        return Vectors.dense(sums / sums.sum() if sums.sum() > 0 else sums)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        routes = [Routes(t) for t in self.tree_list()]

        @F.pandas_udf("double")
        def share(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=float)
            rows = np.stack(x.to_numpy())
            out = np.zeros(len(rows))
            for r in routes:
                out += r.value[r.of_values(rows)]
            return pd.Series(out / len(routes))

        p = share(vector_to_array(self.getOrDefault(self.featuresCol)))
        scored = dataset.withColumn("_share", p)
        return scored.withColumn("probability", array_to_vector(F.array(1.0 - F.col("_share"), F.col("_share")))).drop("_share")


# task functions travel with the job, so executors need no copy of the library
cloudpickle.register_pickle_by_value(sys.modules[__name__])
