"""Distributed training: estimators by name, K-fold scores, search, checks.

Everything that grows with the data stays in DataFrames: rows are assembled
once, each fit is a distributed ``pyspark.ml`` job, held-out and test scores are
tables keyed by ID. Only fitted constants and per-fold metrics reach the driver.
"""

from __future__ import annotations

import hashlib
import json
import time
import warnings
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field, replace
from multiprocessing.pool import ThreadPool
from threading import Lock
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.feature import (OneHotEncoder, StandardScaler, StringIndexer,
                                VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.functions.text import seeded_md5
from loanloom.operators import metrics
from loanloom.operators.boosting import Booster, BoostSettings, best_prefix, boost  # noqa: F401
from loanloom.operators.encoders import FoldEncoder
from loanloom.operators.features import numeric_columns
from loanloom.operators.folds import make_folds
from loanloom.operators.linear import LinearModel, logistic_fits
from loanloom.operators.ordered import hash_row_numbers
from loanloom.operators.random_trees import RandomTrees, RandomTreeSettings
from loanloom.operators.search import SEARCH_SPACES, learned_suggestion, suggest
from loanloom.schema import ID_COL, TARGET_COL
from loanloom.session import materialize
from loanloom.sources.readers import path_exists

FEATURES = "features"
WEIGHT = "weight"
STOP = "is_stop_row"
#: Up to so many columns logistic regressions of all folds are fitted by Newton steps in common passes.
NEWTON_COLUMNS = 512

# Default settings of the named models.
MODEL_DEFAULTS: dict[str, dict[str, Any]] = {
    "lr": {"C": 1.0, "max_iter": 1000},
    "rf": {"n_estimators": 300, "max_depth": 30, "seed": 42},
    "extra_trees": {"n_estimators": 300, "max_depth": 30, "seed": 43},
    "lgbm": {"n_estimators": 3000, "learning_rate": 0.01, "num_leaves": 31,
             "min_child_samples": 30, "subsample": 0.8, "colsample_bytree": 0.8, "reg_alpha": 0.1, "reg_lambda": 1.0, "seed": 42},
    "xgb": {"n_estimators": 1000, "learning_rate": 0.05, "max_depth": 7, "subsample": 0.8,
            "colsample_bytree": 0.8, "reg_alpha": 0.1, "reg_lambda": 1.0, "seed": 42},
    "catboost": {"n_estimators": 1000, "learning_rate": 0.05, "max_depth": 7, "reg_lambda": 3.0, "seed": 42},
    "lgbm_diverse": {"n_estimators": 3000, "learning_rate": 0.01, "num_leaves": 15,
                     "min_child_samples": 60, "subsample": 0.6, "colsample_bytree": 0.5, "seed": 123},
    "mlp": {"hidden_dims": [256, 128, 64], "max_iter": 100, "seed": 42},
}
# End of fixed values.

# Settings each kind of model reads, and settings of other libraries that Spark's learners have no counterpart for.
_TREE = {"n_estimators", "max_depth", "num_leaves", "max_leaves", "min_child_samples", "max_bins", "seed"}
_READ = {"lr": {"C", "max_iter"}, "rf": _TREE, "extra_trees": _TREE - {"max_bins"}, "mlp": {"hidden_dims", "max_iter", "seed"}}
_BOOST = _TREE | {"learning_rate", "subsample", "colsample_bytree", "gamma", "border_count", "patience", "min_child_weight",
                  "min_split_gain", "reg_alpha", "reg_lambda", "grow_policy"}
NO_COUNTERPART = {"random_strength", "bagging_temperature", "one_hot_max_size"}
# Models that stop early when asked, and after how many trees without gain.
EARLY = {"lgbm": 200, "lgbm_diverse": 200, "catboost": 50}

_ALIASES = {"iterations": "n_estimators", "depth": "max_depth", "lr": "learning_rate",
            "min_data_in_leaf": "min_child_samples", "min_samples_leaf": "min_child_samples", "l2_leaf_reg": "reg_lambda",
            "random_state": "seed"}


@dataclass
class ModelSpec:
    """A named estimator and how its rows are weighted and prepared."""

    name: str
    estimator: Any
    balanced: bool = True
    scaled: bool = False
    stops_early: bool = False
    params: dict[str, Any] = field(default_factory=dict)
    ignored: list[str] = field(default_factory=list)


def _depth(p: dict[str, Any]) -> int:
    """Tree depth that allows the asked number of leaves, if no depth is given."""
    if p.get("max_depth") and p["max_depth"] > 0:
        return min(30, int(p["max_depth"]))
    leaves = int(p.get("num_leaves", p.get("max_leaves", 31)))
    return max(1, min(30, leaves.bit_length()))


def build_model(name: str, params: dict[str, Any] | None = None, n_features: int | None = None) -> ModelSpec:
    """Estimator for a model name; unknown names and settings are a ``ValueError``.

    Settings without a counterpart in Spark are reported by a warning and listed in ``ignored``.
    """
    if name not in MODEL_DEFAULTS:
        raise ValueError(f"Unknown model '{name}'. Available: {sorted(MODEL_DEFAULTS)}")
    p = {**MODEL_DEFAULTS[name],
         **{_ALIASES.get(k, k): v for k, v in (params or {}).items()}}
    ignored = sorted(NO_COUNTERPART & set(p))
    unknown = set(p) - _READ.get(name, _BOOST) - NO_COUNTERPART
    if unknown:
        raise ValueError(f"'{name}' has no settings {sorted(unknown)}")
    if ignored:
        warnings.warn(f"'{name}' has no counterpart for {ignored}; they are ignored", stacklevel=2)
    common = dict(featuresCol=FEATURES, labelCol=TARGET_COL)
    if name == "lr":
        # regParam is set from the weight sum when the rows are known
        est = LogisticRegression(maxIter=int(p["max_iter"]), elasticNetParam=0.0, tol=1e-7,
                                 standardization=False, weightCol=WEIGHT, **common)
        return ModelSpec(name, est, params=p, ignored=ignored)
    if name == "rf":
        est = RandomForestClassifier(
            numTrees=int(p["n_estimators"]), maxDepth=_depth(p), seed=int(p["seed"]),
            minInstancesPerNode=int(p.get("min_child_samples", 1)), weightCol=WEIGHT,
            featureSubsetStrategy="sqrt", bootstrap=True, maxBins=int(p.get("max_bins", 64)), **common)
        return ModelSpec(name, est, params=p, ignored=ignored)
    if name == "extra_trees":
        settings = RandomTreeSettings(int(p["n_estimators"]), _depth(p), int(p.get("min_child_samples", 1)), seed=int(p["seed"]))
        return ModelSpec(name, RandomTrees(settings=json.dumps(asdict(settings)), weightCol=WEIGHT, **common), params=p, ignored=ignored)
    if name == "mlp":
        layers = [n_features or 1, *[int(h) for h in p["hidden_dims"]], 2]
        est = MultilayerPerceptronClassifier(layers=layers, maxIter=int(p["max_iter"]),
                                             seed=int(p["seed"]), **common)
        return ModelSpec(name, est, balanced=False, scaled=True, params=p, ignored=ignored)
    est = Booster(settings=json.dumps(asdict(boost_settings(name, p))), labelCol=TARGET_COL, featuresCol=FEATURES,
                  weightCol=WEIGHT, idCol=ID_COL)
    return ModelSpec(name, est, stops_early=name in EARLY, params=p, ignored=ignored)


def boost_settings(name: str, p: dict[str, Any]) -> BoostSettings:
    """Growth of a boosted model: by leaves where the model counts leaves or asks for it, else by depth.

    ``gamma`` is counted on half the gain, as models of that name do.
    """
    by_leaves = name.startswith("lgbm") or p.get("grow_policy") == "Lossguide"
    depth = max(0, int(p.get("max_depth") or 0))
    return BoostSettings(
        n_estimators=int(p["n_estimators"]), learning_rate=float(p["learning_rate"]),
        num_leaves=int(p.get("num_leaves", p.get("max_leaves", 31))) if by_leaves else int(p.get("max_leaves", 0)),
        max_depth=depth if depth or by_leaves or p.get("max_leaves") else 6,
        min_child_samples=max(1, int(p.get("min_child_samples", 20 if by_leaves else 1))),
        min_child_weight=float(p.get("min_child_weight", 1e-3 if by_leaves else 1.0)),
        reg_alpha=float(p.get("reg_alpha", 0.0)), reg_lambda=float(p.get("reg_lambda", 0.0 if by_leaves else 1.0)),
        min_split_gain=float(p["min_split_gain"]) if "min_split_gain" in p else 2.0 * float(p.get("gamma", 0.0)),
        subsample=float(p.get("subsample", 1.0)), colsample_bytree=float(p.get("colsample_bytree", 1.0)),
        max_bins=min(256, int(p.get("border_count", p.get("max_bins", 64)))), seed=int(p["seed"]))


def class_weights(df: DataFrame, label: str = TARGET_COL, kind: str = "balanced") -> Column:
    """Row weight from two counts: ``balanced`` n / (2 n_c), or ``ratio`` neg / pos for positives."""
    c = df.agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")).first()
    pos, neg = max(c["pos"], 1), max(c["neg"], 1)
    if kind == "ratio":
        w1, w0 = neg / pos, 1.0
    else:
        w1, w0 = (pos + neg) / (2.0 * pos), (pos + neg) / (2.0 * neg)
    return F.when(F.col(label) == 1, F.lit(w1)).otherwise(F.lit(w0))


def feature_frame(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Asked columns as doubles, null and NaN as 0; absent columns are 0."""
    have = set(df.columns)
    value = {c: F.coalesce(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(0.0)), F.lit(0.0))
             if c in have else F.lit(0.0) for c in cols}
    return df.withColumns({f"_x{i}": value[c] for i, c in enumerate(cols)})


def assemble(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (ID_COL, TARGET_COL, "fold_id")) -> DataFrame:
    """Key columns and one feature vector."""
    kept = [c for c in keep if c in df.columns]
    xs = [f"_x{i}" for i in range(len(cols))]
    out = VectorAssembler(inputCols=xs, outputCol=FEATURES).transform(feature_frame(df, cols))
    return out.select(*kept, FEATURES)


def training_table(df: DataFrame) -> DataFrame:
    """``df`` as a written table with at least one partition per core.

    Tables that are already split well are written once and left alone.
    """
    table = materialize(df)
    cores = df.sparkSession.sparkContext.defaultParallelism
    if table.rdd.getNumPartitions() >= cores:
        return table
    return materialize(table.repartition(cores))


@dataclass
class Assembled:
    """A written training table and the columns its vectors are made of; shared by seeds, models and trials."""

    rows: DataFrame
    cols: list[str]


def assemble_once(train: DataFrame, features: Sequence[str] | None = None, id_col: str = ID_COL,
                  label: str = TARGET_COL) -> Assembled:
    cols = list(features or numeric_columns(train, id_col, label))
    return Assembled(training_table(assemble(train, cols, (id_col, label, "fold_id"))), cols)


def sparse_one_hot(cat_cols: Sequence[str], output: str = FEATURES) -> Pipeline:
    """Indexed and one-hot encoded categories as one sparse vector; unseen is its own slot."""
    idx = [f"_{c}_index" for c in cat_cols]
    hot = [f"_{c}_hot" for c in cat_cols]
    return Pipeline(stages=[
        StringIndexer(inputCols=list(cat_cols), outputCols=idx, handleInvalid="keep",
                      stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=idx, outputCols=hot, handleInvalid="keep"),
        VectorAssembler(inputCols=hot, outputCol=output)])


def positive_score(col: str = "probability") -> Column:
    return vector_to_array(F.col(col))[1]


def _stop_flag(id_col: str = ID_COL, share: int = 10) -> Column:
    """A tenth of the training rows, picked by hash, that only decides when to stop."""
    return F.conv(F.substring(seeded_md5(id_col, "stop"), 1, 6), 16, 10).cast("long") % share == 0


def _stopping(spec: ModelSpec) -> BoostSettings:
    """The settings of a spec with its patience."""
    return replace(spec.estimator.boost_settings(), patience=int(spec.params.get("patience", EARLY[spec.name])))


def fit_model(spec: ModelSpec, rows: DataFrame, early_stop: bool = False, id_col: str = ID_COL,
              weight_kind: str = "balanced") -> PipelineModel:
    """Fit on assembled rows; one pass for the class counts, then the learner's own passes."""
    weighted = rows
    est = spec.estimator
    if spec.balanced:
        weighted = rows.withColumn(WEIGHT, class_weights(rows, kind=weight_kind))
    if spec.name == "lr":
        total = weighted.agg(F.sum(WEIGHT)).first()[0]
        est = est.copy().setRegParam(1.0 / (float(spec.params["C"]) * total))
    if isinstance(est, Booster):
        est = est.copy()._set(idCol=id_col)
        if spec.stops_early and early_stop:
            weighted = weighted.withColumn(STOP, _stop_flag(id_col))
            est._set(watchCol=STOP, settings=json.dumps(asdict(_stopping(spec))))
    stages = [est]
    if spec.scaled:
        scaler = StandardScaler(inputCol=FEATURES, outputCol="_scaled", withMean=True)
        stages = [scaler, est.copy().setFeaturesCol("_scaled")]
    return Pipeline(stages=stages).fit(weighted)


def fit_folds(spec: ModelSpec, rows: DataFrame, ks: Sequence[int], early_stop: bool = False, id_col: str = ID_COL,
              label: str = TARGET_COL, seeds: Sequence[int] = ()) -> list[PipelineModel]:
    """One boosted or logistic model per fold, each on the other folds; all of them learn in the same passes over the rows.

    Row weights are those of ``class_weights`` on the other folds, from one count of (fold, label). With ``seeds`` there is
    a boosted model for each seed and fold, the folds of the first seed first.
    """
    cells = {(r["fold_id"], r[label]): r["n"] for r in rows.groupBy("fold_id", label).agg(F.count(F.lit(1)).alias("n")).collect()}
    stops = spec.stops_early and early_stop
    held = _stop_flag(id_col) if stops else F.lit(False)
    fit, watch = [], []
    for k in ks:
        pos = max(sum(n for (f, y), n in cells.items() if f != k and y == 1), 1)
        neg = max(sum(n for (f, y), n in cells.items() if f != k and y == 0), 1)
        weight = F.when(F.col(label) == 1, F.lit((pos + neg) / (2.0 * pos))).otherwise(F.lit((pos + neg) / (2.0 * neg)))
        inside = F.col("fold_id") != k
        fit.append(F.when(inside & ~held, weight))
        watch.append(F.when(inside & held, weight))
    if spec.name == "lr":
        # a penalty of 1 / C on the sum of weighted losses
        found = logistic_fits(rows, vector_to_array(F.col(FEATURES)), fit, 1.0 / float(spec.params["C"]), label)
        return [PipelineModel(stages=[LinearModel.of(*f, FEATURES)]) for f in found]
    settings = _stopping(spec) if stops else spec.estimator.boost_settings()
    times = max(1, len(seeds))
    models = boost(rows, fit * times, watch * times, settings, label, FEATURES, id_col, [s for s in seeds for _ in ks] or None)
    return [PipelineModel(stages=[m]) for m in models]


def score(model: PipelineModel, rows: DataFrame, keep: Sequence[str], output: str = "score") -> DataFrame:
    return model.transform(rows).select(*keep, positive_score().alias(output))


@dataclass
class CvResult:
    """Out-of-fold and test scores of one model on one variant."""

    model: str
    variant: str
    oof: DataFrame
    test: DataFrame | None
    fold_aucs: list[float]
    train_time_sec: float
    models: list[PipelineModel] = field(default_factory=list)
    features: list[str] = field(default_factory=list)

    @property
    def mean_auc(self) -> float:
        return sum(self.fold_aucs) / len(self.fold_aucs)

    @property
    def std_auc(self) -> float:
        m = self.mean_auc
        return (sum((a - m) ** 2 for a in self.fold_aucs) / len(self.fold_aucs)) ** 0.5

    def metrics_row(self) -> DataFrame:
        schema = ("model string, variant string, fold_aucs array<double>, mean_auc double,"
                  " std_auc double, train_time_sec double")
        row = (self.model, self.variant, self.fold_aucs, self.mean_auc, self.std_auc, self.train_time_sec)
        return self.oof.sparkSession.createDataFrame([row], schema)


def _mean_scores(models: Sequence[PipelineModel], rows: DataFrame, id_col: str) -> DataFrame:
    """Mean score of all fold models: every model adds a column, the rows are read once."""
    out = rows
    for i, m in enumerate(models):
        scored = m.transform(out)
        drop = [c for c in scored.columns if c not in out.columns]
        out = scored.withColumn(f"_p{i}", positive_score()).drop(*drop)
    mean = sum((F.col(f"_p{i}") for i in range(len(models))), F.lit(0.0)) / F.lit(float(len(models)))
    return out.select(id_col, mean.alias("score"))


def _tagged(df: DataFrame, model: str, variant: str) -> DataFrame:
    return df.withColumns({"model": F.lit(model), "variant": F.lit(variant)})


def cv_train(
    name: str,
    params: dict[str, Any] | None,
    train: DataFrame | Assembled,
    test: DataFrame | None = None,
    variant: str = "v2_ordinal",
    features: Sequence[str] | None = None,
    early_stop: bool = False,
    id_col: str = ID_COL,
    label: str = TARGET_COL,
    encode: Callable[[DataFrame, int], DataFrame] | None = None,
    encode_test: Callable[[DataFrame], DataFrame] | None = None,
    parallelism: int = 5,
    fitted: dict[int, PipelineModel] | None = None,
) -> CvResult:
    """Fit once per fold on the other folds, score the fold; test = mean over folds.

    ``train`` carries ID, target and ``fold_id``, or is assembled already. With ``encode`` the training
    and held-out rows of fold k are encoded as ``encode(train, k)``, which may
    only use other folds; ``encode_test`` encodes the test rows once. Up to
    ``parallelism`` folds are fitted at the same time; ``fitted`` has models
    of folds that are fitted already.
    """
    start = time.perf_counter()
    ready = train if isinstance(train, Assembled) else None
    rows_in = ready.rows if ready else train
    ks = [r[0] for r in rows_in.select("fold_id").distinct().orderBy("fold_id").collect()]
    keep = (id_col, label, "fold_id")
    if encode:
        cols = list(features or numeric_columns(encode(train, ks[0]), id_col, label))
        fixed = None
    else:
        ready = ready or assemble_once(train, features, id_col, label)
        cols, fixed = ready.cols, ready.rows
    test_rows = None
    if test is not None:
        test_rows = assemble(encode_test(test) if encode_test else test, cols, (id_col,))

    fitted = dict(fitted or {})
    if fixed is not None and not fitted:
        spec = build_model(name, params, len(cols))
        if isinstance(spec.estimator, Booster) or (spec.name == "lr" and len(cols) <= NEWTON_COLUMNS):
            fitted = dict(zip(ks, fit_folds(spec, fixed, ks, early_stop, id_col, label), strict=True))

    def one_fold(k: int) -> tuple[PipelineModel, DataFrame]:
        if k in fitted:
            return fitted[k], score(fitted[k], fixed.where(F.col("fold_id") == k), [id_col, label, "fold_id"])
        rows = fixed if fixed is not None else training_table(assemble(encode(train, k), cols, keep))
        spec = build_model(name, params, len(cols))
        model = fit_model(spec, rows.where(F.col("fold_id") != k), early_stop, id_col)
        return model, score(model, rows.where(F.col("fold_id") == k), [id_col, label, "fold_id"])

    # the fits are independent Spark jobs; the threads only submit them
    task = inheritable_thread_target(rows_in.sparkSession)(one_fold)
    with ThreadPool(max(1, min(parallelism, len(ks)))) as pool:
        done = pool.map(task, ks)
    models, parts = [m for m, _ in done], [p for _, p in done]
    oof = parts[0]
    for p in parts[1:]:
        oof = oof.unionByName(p)
    oof = materialize(_tagged(oof, name, variant))
    aucs = metrics.roc_auc(oof, label, "score", ["fold_id"]).orderBy("fold_id").collect()
    scored = None if test_rows is None else _tagged(_mean_scores(models, test_rows, id_col), name, variant)
    return CvResult(name, variant, oof, scored, [r["roc_auc"] for r in aucs],
                    time.perf_counter() - start, models, cols)


def cv_train_encoded(name: str, params: dict[str, Any] | None, train: DataFrame, test: DataFrame | None,
                     cat_cols: Sequence[str], variant: str = "v3_target_woe", **options) -> CvResult:
    """K-fold training with target encodings fitted inside every training part."""
    enc = FoldEncoder(cat_cols).fit(train)
    return cv_train(name, params, train, test, variant, encode=enc.transform_for_fold,
                    encode_test=enc.transform, **options)


def train_models(entries: Sequence[tuple[str, str, dict[str, Any]]],
                 variants: dict[str, tuple[DataFrame, DataFrame]], **options) -> list[CvResult]:
    """Every (model, variant, params) whose variant exists, best mean AUC first; a variant is assembled once."""
    used = dict.fromkeys(v for _, v, _ in entries if v in variants)
    ready = {v: assemble_once(variants[v][0]) for v in used}
    done = [cv_train(name, params, ready[v], variants[v][1], variant=v, **options)
            for name, v, params in entries if v in variants]
    return sorted(done, key=lambda r: (-r.mean_auc, r.model))


def multi_seed(name: str, params: dict[str, Any], train: DataFrame, test: DataFrame,
               seeds: Sequence[int], **options) -> tuple[DataFrame, DataFrame, list[CvResult]]:
    """Mean out-of-fold and test scores over seeds, and the single-seed results, best first."""
    ready = train if options.get("encode") or isinstance(train, Assembled) else assemble_once(
        train, options.pop("features", None))
    made: dict[int, dict[int, PipelineModel]] = {}
    spec = build_model(name, params)
    if isinstance(ready, Assembled) and isinstance(spec.estimator, Booster):
        # the models of all seeds and folds grow in the same passes
        ks = [r[0] for r in ready.rows.select("fold_id").distinct().orderBy("fold_id").collect()]
        models = fit_folds(spec, ready.rows, ks, options.get("early_stop", False), seeds=seeds)
        made = {s: dict(zip(ks, models[i * len(ks):(i + 1) * len(ks)], strict=True)) for i, s in enumerate(seeds)}
    runs = [cv_train(name, {**params, "seed": s}, ready, test, variant=f"seed{s}", fitted=made.get(s), **options)
            for s in seeds]
    oof, scored = runs[0].oof, runs[0].test
    for r in runs[1:]:
        oof, scored = oof.unionByName(r.oof), scored.unionByName(r.test)
    mean_oof = oof.groupBy(ID_COL, TARGET_COL).agg(F.avg("score").alias("score"))
    mean_test = scored.groupBy(ID_COL).agg(F.avg("score").alias("score"))
    return mean_oof, mean_test, sorted(runs, key=lambda r: -r.mean_auc)


def feature_importances(model: PipelineModel, cols: Sequence[str], top: int | None = None) -> DataFrame:
    """(feature, importance), highest first; for tree models."""
    from pyspark.sql import SparkSession

    values = model.stages[-1].featureImportances.toArray().tolist()
    df = SparkSession.active().createDataFrame(
        list(zip(cols, values)), "feature string, importance double").orderBy(
        F.desc("importance"), "feature")
    return df.limit(top) if top else df


def permutation_importance(model: PipelineModel, df: DataFrame, cols: Sequence[str],
                           features: Sequence[str] | None = None, seed: int = 42,
                           id_col: str = ID_COL, label: str = TARGET_COL) -> DataFrame:
    """(feature, auc_drop): loss of AUC when one column is dealt out anew by hash order.

    The shuffle is a join of two hash orders, and all features are scored as one
    long table.
    """
    cols = list(cols)
    features = list(features or cols)
    base = materialize(feature_frame(df, cols).select(
        id_col, label, *[f"_x{i}" for i in range(len(cols))]))
    here = hash_row_numbers(base, seeded_md5(id_col, f"{seed}:a"), id_col, output="_at")
    there = hash_row_numbers(
        base.select(id_col, *[F.col(f"_x{i}").alias(f"_y{i}") for i in range(len(cols))]),
        seeded_md5(id_col, f"{seed}:b"), id_col, output="_at").drop(id_col)
    paired = here.join(there, "_at")
    variants = F.explode(F.array(*[F.lit(i) for i in range(-1, len(features))])).alias("_f")
    place = {c: i for i, c in enumerate(cols)}
    long = paired.select("*", variants)
    xs = []
    for c, i in place.items():
        swapped = F.col("_f") == F.lit(features.index(c)) if c in features else F.lit(False)
        xs.append(F.when(swapped, F.col(f"_y{i}")).otherwise(F.col(f"_x{i}")).alias(f"_z{i}"))
    rows = VectorAssembler(inputCols=[f"_z{i}" for i in range(len(cols))], outputCol=FEATURES).transform(
        long.select(id_col, label, "_f", *xs))
    scored = materialize(score(model, rows, [label, "_f"]))
    aucs = metrics.roc_auc(scored, label, "score", ["_f"]).select("_f", "roc_auc")
    plain = aucs.where("_f = -1").select("roc_auc").scalar()
    names = F.element_at(F.array(*[F.lit(c) for c in features]), F.col("_f") + 1)
    return aucs.where("_f >= 0").select(names.alias("feature"), (plain - F.col("roc_auc")).alias("auc_drop"))


def origin_frame(train: DataFrame, test: DataFrame, id_col: str = ID_COL,
                 label: str = TARGET_COL) -> DataFrame:
    """Common numeric columns of both tables, null as 0, with the origin flag ``_is_test``."""
    cols = [c for c in numeric_columns(train, id_col, label) if c in numeric_columns(test, id_col, label)]

    def part(df: DataFrame, flag: int) -> DataFrame:
        filled = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in cols]
        return df.select(id_col, *filled, F.lit(flag).alias("_is_test"))

    return part(train, 0).unionByName(part(test, 1))


def adversarial_validation(train: DataFrame, test: DataFrame, n_cv: int = 5, limit: float = 0.7,
                           params: dict[str, Any] | None = None, id_col: str = ID_COL) -> DataFrame:
    """(mean_auc, std_auc, shifted): can a model tell train rows from test rows?"""
    both = origin_frame(train, test, id_col).withColumnRenamed("_is_test", TARGET_COL)
    # an ID may stand in both tables
    both = materialize(both.withColumn(id_col, F.concat_ws(":", TARGET_COL, id_col)))
    rows = both.join(make_folds(both, n_cv, id_col=id_col), id_col)
    settings = {"n_estimators": 100, "learning_rate": 0.1, "num_leaves": 31, **(params or {})}
    result = cv_train("lgbm", settings, rows, variant="origin", id_col=id_col)
    return result.metrics_row().select(
        "mean_auc", "std_auc", (F.col("mean_auc") > F.lit(limit)).alias("shifted"))


_TRIALS = T.StructType([
    T.StructField("trial", T.IntegerType()), T.StructField("params", T.StringType()),
    T.StructField("mean_auc", T.DoubleType()), T.StructField("fold_aucs", T.ArrayType(T.DoubleType())),
    T.StructField("key", T.StringType())])


def _fingerprint(rows: DataFrame) -> str:
    """Row count and an order-free hash of all columns."""
    h = F.xxhash64(*[F.col(f"`{c}`").cast("string") if k.startswith("map") else F.col(f"`{c}`") for c, k in rows.dtypes])
    got = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.pmod(h, F.lit(1 << 40))).alias("h")).first()
    return f"{got.n}:{got.h}"


def tune_model(name: str, train: DataFrame, n_trials: int = 50, seed: int = 42,
               trials_path: str | None = None, space: str | dict | None = None,
               fixed: dict[str, Any] | None = None, variant: str = "tuning") -> tuple[dict[str, Any], DataFrame]:
    """Best parameters of a seeded random search and its trial table.

    Finished trials in ``trials_path`` are not run again, so a search resumes. A
    trial is known by a key of model, variant, parameters and the training
    rows with their folds; other searches may use the same path.
    """
    spark = train.sparkSession
    candidates = [{**p, **(fixed or {})} for p in suggest(space or name, n_trials, seed)]
    picked = suggest(space or name, n_trials, seed)
    data = _fingerprint(train) if trials_path else ""
    keys = [hashlib.sha256(json.dumps([name, variant, p, data], sort_keys=True).encode()).hexdigest() for p in candidates]
    done: set[str] = set()
    if trials_path and path_exists(spark, trials_path):
        done = {r["key"] for r in spark.read.schema(_TRIALS).parquet(trials_path).where(
            F.col("key").isin(keys)).select("key").collect()}
    ready, rows = None, []
    for i, params in enumerate(candidates):
        if keys[i] in done:
            continue
        done.add(keys[i])
        ready = ready or assemble_once(train)
        result = cv_train(name, params, ready, variant=variant)
        row = (i, json.dumps(picked[i], sort_keys=True), result.mean_auc, result.fold_aucs, keys[i])
        if trials_path:
            spark.createDataFrame([row], _TRIALS).write.mode("append").parquet(trials_path)
        rows.append(row)
    table = (spark.read.schema(_TRIALS).parquet(trials_path) if trials_path
             else spark.createDataFrame(rows, _TRIALS)).where(F.col("key").isin(keys))
    best = table.orderBy(F.desc("mean_auc"), "trial").first()
    return json.loads(best["params"]), table


_RUNGS = T.StructType([
    T.StructField("trial", T.IntegerType()), T.StructField("rung", T.IntegerType()), T.StructField("share", T.DoubleType()),
    T.StructField("params", T.StringType()), T.StructField("mean_auc", T.DoubleType()),
    T.StructField("fold_aucs", T.ArrayType(T.DoubleType())), T.StructField("key", T.StringType())])


def adaptive_search(name: str, train: DataFrame, n_trials: int = 50, seed: int = 42, trials_path: str | None = None,
                    space: str | dict | None = None, fixed: dict[str, Any] | None = None, variant: str = "tuning",
                    batch: int = 4, rungs: Sequence[float] = (0.25, 1.0), parallelism: int = 2) -> tuple[dict[str, Any], DataFrame]:
    """Best parameters of a search that learns from its own trials, and the table of its fits.

    Trials come in batches. Each batch is drawn from densities of the trials of
    earlier batches; its fits run side by side. Every rung gives a share of the
    trees (or iterations); the better half of a batch goes on to the next one.
    What a trial is worth is its rung first, then its mean AUC.

    Fits are written to ``trials_path`` as they end and known by model, variant,
    parameters, share, rung and the training rows, so a search that is stopped
    and begun again does no fit twice and draws the same trials.
    """
    spark = train.sparkSession
    rules = SEARCH_SPACES[space or name] if not isinstance(space, dict) else space
    data = _fingerprint(train)
    known: dict[str, Any] = {}
    if trials_path and path_exists(spark, trials_path):
        known = {r["key"]: r for r in spark.read.schema(_RUNGS).parquet(trials_path).collect()}
    ready: Assembled | None = None
    writing = Lock()
    table: list[tuple] = []
    done: list[tuple[dict[str, Any], tuple[int, float]]] = []

    def fit(job: tuple[int, int, float, dict[str, Any]]) -> tuple:
        trial, rung, share, params = job
        key = hashlib.sha256(json.dumps([name, variant, params, fixed or {}, rung, share, data], sort_keys=True).encode()).hexdigest()
        if key in known:
            r = known[key]
            return trial, rung, share, json.dumps(params, sort_keys=True), r["mean_auc"], list(r["fold_aucs"]), key
        result = cv_train(name, _shortened(name, {**params, **(fixed or {})}, share), ready, variant=variant)
        row = (trial, rung, share, json.dumps(params, sort_keys=True), result.mean_auc, result.fold_aucs, key)
        if trials_path:
            # two appends to one folder at the same time would clear each other's temporary files
            with writing:
                spark.createDataFrame([row], _RUNGS).write.mode("append").parquet(trials_path)
        return row

    ready = assemble_once(train)
    task = inheritable_thread_target(spark)(fit)
    for first in range(0, n_trials, batch):
        drawn = [(t, learned_suggestion(rules, done, t, seed)) for t in range(first, min(first + batch, n_trials))]
        reached: dict[int, tuple[int, float]] = {}
        going = drawn
        for rung, share in enumerate(rungs):
            with ThreadPool(max(1, min(parallelism, len(going)))) as pool:
                rows = pool.map(task, [(t, rung, share, p) for t, p in going])
            table += rows
            for row in rows:
                reached[row[0]] = (rung, row[4])
            ranked = sorted(going, key=lambda tp: (-reached[tp[0]][1], tp[0]))
            going = sorted(ranked[:max(1, len(ranked) // 2)], key=lambda tp: tp[0])
        done += [(p, reached[t]) for t, p in drawn]
    best = max(range(len(done)), key=lambda i: (done[i][1], -i))
    return done[best][0], spark.createDataFrame(table, _RUNGS)


def _shortened(name: str, params: dict[str, Any], share: float) -> dict[str, Any]:
    """Parameters with a share of the trees or iterations."""
    spelled = next((k for k in ("n_estimators", "iterations", "max_iter") if k in params), None)
    spelled = spelled or ("max_iter" if "max_iter" in MODEL_DEFAULTS[name] else "n_estimators")
    full = params.get(spelled, MODEL_DEFAULTS[name].get(_ALIASES.get(spelled, spelled)))
    return {**params, spelled: max(1, round(share * full))}


def baseline(train: DataFrame, test: DataFrame, cols: Sequence[str], medians: dict[str, float],
             holdout: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Balanced logistic regression on imputed numbers: hold-out metrics and test scores."""
    filled = {c: v for c, v in medians.items() if c in cols}

    def prepared(df: DataFrame) -> DataFrame:
        return assemble(df.fillna(filled), cols, (ID_COL, TARGET_COL, "is_holdout"))

    rows = materialize(prepared(train.join(holdout, ID_COL)))
    first = fit_model(build_model("lr"), rows.where("is_holdout = 0"))
    held = materialize(score(first, rows.where("is_holdout = 1"), [ID_COL, TARGET_COL]))
    report = metrics.evaluate(held.withColumn("model", F.lit("baseline")))
    final = fit_model(build_model("lr"), rows)
    return report, score(final, prepared(test), [ID_COL])


