import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from loanloom.operators import metrics, profile


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(5)
    rows = []
    for m, digits in (("a", 2), ("b", 6)):
        for i in range(600):
            y = int(rng.random() < 0.3)
            rows.append((f"{i}", m, y, float(round(min(max(0.3 + 0.2 * y + 0.25 * rng.standard_normal(), 0), 1), digits))))
    return spark.createDataFrame(rows, "ID string, model string, Target int, score double").persist()


def _arrays(scored, m):
    p = scored.where(F.col("model") == m).toPandas()
    return p["Target"].to_numpy(), p["score"].to_numpy()


def _auc(y, s):
    d = s[y == 1][:, None] - s[y == 0][None, :]
    return ((d > 0).sum() + 0.5 * (d == 0).sum()) / d.size


@pytest.mark.parametrize("buckets", [None, 16])
def test_auc_is_exact(scored, buckets):
    got = {r["model"]: r["roc_auc"] for r in metrics.roc_auc(scored, keys=["model"], buckets=buckets).collect()}
    for m in "ab":
        assert got[m] == pytest.approx(_auc(*_arrays(scored, m)), rel=1e-12)
    one = scored.where("model = 'a'")
    spark_auc = BinaryClassificationEvaluator(
        rawPredictionCol="score", labelCol="Target", numBins=0).evaluate(one.withColumn("Target", F.col("Target").cast("double")))
    assert got["a"] == pytest.approx(spark_auc, rel=1e-9)


def test_auc_without_a_class_is_null(scored):
    assert metrics.roc_auc(scored.where("Target = 1"), keys=["model"]).first()["roc_auc"] is None


def test_average_precision_and_threshold(scored):
    ap = {r["model"]: r["pr_auc"] for r in metrics.average_precision(scored, keys=["model"], buckets=8).collect()}
    best = {r["model"]: r for r in metrics.best_threshold(scored, keys=["model"], buckets=8).collect()}
    for m in "ab":
        y, s = _arrays(scored, m)
        want, last = 0.0, 0.0
        f1s = {}
        for t in sorted(set(s), reverse=True):
            tp = ((s >= t) & (y == 1)).sum()
            p, r = tp / (s >= t).sum(), tp / y.sum()
            want += (r - last) * p
            last = r
            f1s[t] = 2 * p * r / (p + r + 1e-8)
        assert ap[m] == pytest.approx(want, rel=1e-10)
        top = max(f1s.values())
        assert best[m]["f1"] == pytest.approx(top, rel=1e-12)
        assert best[m]["threshold"] == min(t for t, f in f1s.items() if f == top)


def test_evaluate_row(scored):
    rows = {r["model"]: r for r in metrics.evaluate(scored, threshold=0.5).collect()}
    y, s = _arrays(scored, "a")
    hit = s >= 0.5
    tp, fp, fn = (hit & (y == 1)).sum(), (hit & (y == 0)).sum(), (~hit & (y == 1)).sum()
    assert rows["a"]["accuracy"] == pytest.approx((hit == (y == 1)).mean())
    assert rows["a"]["precision"] == pytest.approx(tp / (tp + fp))
    assert rows["a"]["recall"] == pytest.approx(tp / (tp + fn))
    assert rows["a"]["f1"] == pytest.approx(2 * tp / (2 * tp + fp + fn))


def test_undefined_metrics_are_zero(scored):
    row = metrics.threshold_metrics(scored, keys=["model"], threshold=2.0).first()
    assert (row["f1"], row["precision"], row["recall"]) == (0.0, 0.0, 0.0)


def test_confusion_matrix_has_all_cells(scored):
    cells = metrics.confusion_matrix(scored.where("Target = 1"), threshold=-1.0).collect()
    assert len(cells) == 4 and sum(r["n"] for r in cells) == scored.where("Target = 1").count()


def test_report_rows(scored):
    rows = {r["row"]: r for r in metrics.classification_report(scored).collect()}
    assert set(rows) == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    assert rows["macro avg"]["f1"] == pytest.approx((rows["0"]["f1"] + rows["1"]["f1"]) / 2)


@pytest.mark.parametrize("buckets", [None, 8])
def test_calibration_bins(scored, buckets):
    y, s = _arrays(scored, "b")
    edges = np.quantile(s, np.arange(1, 15) / 15)
    ids = np.searchsorted(edges, s)
    got = {r["bin"]: r for r in metrics.calibration_curve(scored.where("model = 'b'"), buckets=buckets).collect()}
    assert set(got) == set(ids)
    for b in got:
        assert got[b]["n"] == (ids == b).sum()
        assert got[b]["positive_rate"] == pytest.approx(y[ids == b].mean())


def test_segments_need_both_classes(scored):
    rows = scored.withColumn("seg", F.when(F.col("ID").cast("int") < 3, "tiny").otherwise("big"))
    assert [r["seg"] for r in metrics.segment_auc(rows.where("model = 'a'"), "seg").collect()] == ["big"]


def test_fold_aucs(scored):
    rows = scored.withColumn("fold_id", F.col("ID").cast("int") % 3)
    row = metrics.fold_aucs(rows).where("model = 'a'").first()
    p = rows.where("model = 'a'").toPandas()
    want = [_auc(g["Target"].to_numpy(), g["score"].to_numpy()) for _, g in sorted(p.groupby("fold_id"))]
    assert row["fold_aucs"] == pytest.approx(want)
    assert row["std_auc"] == pytest.approx(np.std(want))


def test_profile_tables(train, loan_pdfs):
    pdf = loan_pdfs[0]
    rates = {r["column_name"]: r["missing_rate"] for r in profile.missing_rates(train).collect()}
    want = pdf.isna().mean()
    assert rates == pytest.approx(want[want > 0].to_dict())
    audit = profile.schema_audit(train, ["ID", "nope"])
    assert audit["missing"] == ["nope"] and "province" in audit["unexpected"]
    with pytest.raises(ValueError):
        profile.require_columns(train, ["nope"])
    n = profile.histogram(train, ["amount_usd"], 40).agg(F.sum("n"), F.sum(F.col("density") * F.col("bin_width"))).first()
    assert n[0] == 200 and n[1] == pytest.approx(1.0)
    counts, edges = np.histogram(pdf["amount_usd"], 40)
    got = {r["bin"]: r["n"] for r in profile.histogram(train, ["amount_usd"], 40).collect()}
    assert got == {i: c for i, c in enumerate(counts) if c}
    one = profile.histogram(train.withColumn("k", F.lit(3.0)), ["k"], 5).collect()
    assert len(one) == 1 and one[0]["n"] == 200
    assert profile.low_cardinality(train, ["ID", "province"]) == ["province"]
    rough = {r["column_name"]: r["n_distinct"] for r in profile.cardinalities(train, ["province"], True).collect()}
    assert rough == {"province": 6}
