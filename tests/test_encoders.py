import math

import pytest
from pyspark.sql import functions as F

from loanloom.functions.text import category_text
from loanloom.operators import encoders as enc
from loanloom.operators.catstats import CategoryStats, detect_categories
from loanloom.operators.variants import build_all_variants, target_woe_variant

COLS = ["province", "employment_sector"]


@pytest.fixture(scope="module")
def folded(train, folds):
    return train.join(folds, "ID").select("ID", "Target", "fold_id", "loan_purpose", *COLS).persist()


@pytest.fixture(scope="module")
def unseen(spark):
    return spark.createDataFrame([("x", "Atlantis", None)], "ID string, province string, employment_sector string")


def _rows(df):
    return {r["ID"]: r for r in df.collect()}


def test_missing_is_a_category(spark):
    df = spark.createDataFrame([("a",), (None,)], "c string")
    assert [r[0] for r in df.select(category_text("c")).collect()] == ["a", "nan"]


def test_detect_categories(train):
    cats = detect_categories(train, exclude=("ID",))
    assert "product_code" in cats and "province" in cats and "term_months" not in cats and "ID" not in cats


def test_frequency(folded, unseen):
    e = enc.FrequencyEncoder(COLS).fit(folded, label=None)
    got = e.transform(folded).toPandas()
    assert ((got[COLS] > 0) & (got[COLS] <= 1)).all().all()
    assert e.transform(unseen).first()["province"] == 0.0


def test_ordinal(folded, unseen):
    e = enc.OrdinalEncoder(COLS).fit(folded, label=None)
    got = e.transform(folded)
    assert got.count() == 200
    codes = {r["category"]: r["value"] for r in e.codes(buckets=3).where("column_name = 'province'").collect()}
    assert codes == {p: float(i) for i, p in enumerate(sorted(codes))}
    assert e.transform(unseen).first()["province"] == -1.0


def test_one_hot(folded, unseen):
    e = enc.OneHotEncoder(["province"]).fit(folded, label=None)
    got = e.transform(folded)
    hot = [c for c in got.columns if c.startswith("province_")]
    assert hot == sorted(hot) and len(hot) == 6 and "province" not in got.columns
    assert got.select(sum(F.col(c) for c in hot).alias("s")).distinct().collect()[0]["s"] == 1.0
    assert sum(e.transform(unseen).first()[c] for c in hot) == 0.0
    with pytest.raises(ValueError):
        enc.OneHotEncoder(["province"], max_columns=2).fit(folded, label=None).transform(folded)


@pytest.mark.parametrize("limit", [None, 0])
def test_target_mean_formula(folded, unseen, limit):
    """Both ways of looking up, broadcast and hot-key shuffle, give the formula."""
    e = enc.KFoldTargetEncoder(COLS, broadcast_limit=limit).fit(folded, fold="fold_id")
    pdf = folded.toPandas()
    g = pdf["Target"].mean()
    stats = pdf.groupby("province")["Target"].agg(["sum", "count"])
    want = (stats["sum"] + 10 * g) / (stats["count"] + 10)
    got = _rows(e.transform(folded))
    for r in pdf.itertuples():
        assert got[r.ID]["province"] == pytest.approx(want[r.province])
    assert e.transform(unseen).first()["province"] == pytest.approx(g)


@pytest.mark.parametrize("limit", [None, 0])
def test_out_of_fold_formula(folded, limit):
    pdf = folded.toPandas()
    got = _rows(enc.KFoldTargetEncoder(COLS, broadcast_limit=limit).fit(
        folded, fold="fold_id").transform_train(folded))
    for r in pdf.itertuples():
        rest = pdf[pdf.fold_id != r.fold_id]
        same = rest[rest.province == r.province]["Target"]
        prior = rest["Target"].mean()
        want = (same.sum() + 10 * prior) / (len(same) + 10) if len(same) else pdf["Target"].mean()
        assert got[r.ID]["province"] == pytest.approx(want)


def test_category_of_one_fold_gets_the_overall_mean(folded):
    one = folded.withColumn("province", F.when(F.col("fold_id") == 0, F.lit("only0")).otherwise(F.col("province")))
    got = enc.KFoldTargetEncoder(["province"]).fit(one, fold="fold_id").transform_train(one)
    mean = one.agg(F.avg("Target")).first()[0]
    assert {round(r["province"], 12) for r in got.where("fold_id = 0").collect()} == {round(mean, 12)}


def _flipped(df, who):
    return df.withColumn("Target", F.when(F.col("ID") == who, 1 - F.col("Target")).otherwise(F.col("Target")))


@pytest.mark.parametrize("make", [
    lambda: enc.KFoldTargetEncoder(COLS), lambda: enc.WOEEncoder(COLS), lambda: enc.GroupStatsEncoder(COLS),
    lambda: enc.FoldEncoder(COLS)])
def test_own_label_does_not_reach_own_encoding(folded, make):
    who = "TR00017"
    before = make().fit(folded, fold="fold_id").transform_train(folded).where(F.col("ID") == who).first()
    other = _flipped(folded, who)
    after = make().fit(other, fold="fold_id").transform_train(other).where(F.col("ID") == who).first()
    a, b = before.asDict(), after.asDict()
    a.pop("Target"), b.pop("Target")
    assert a == b


def test_woe_formula(folded, unseen):
    got = _rows(enc.WOEEncoder(COLS).fit(folded).transform(folded))
    pdf = folded.toPandas()
    p, n = pdf["Target"].sum(), (1 - pdf["Target"]).sum()
    for r in pdf.head(20).itertuples():
        same = pdf[pdf.province == r.province]["Target"]
        want = math.log(((len(same) - same.sum() + 0.5) / (n + 1)) / ((same.sum() + 0.5) / (p + 1)))
        assert got[r.ID]["province"] == pytest.approx(want)
    assert enc.WOEEncoder(COLS).fit(folded).transform(unseen).first()["province"] == 0.0


def test_group_stats(folded, unseen):
    e = enc.GroupStatsEncoder().fit(folded)
    got = e.transform(folded).toPandas()
    assert got["province_default_rate"].between(0, 1).all() and (got["province_loan_count"] > 0).all()
    assert e.transform(unseen).first()["province_default_rate"] is None


def test_within_fold_parts_share_one_table(folded):
    e = enc.FoldEncoder(COLS).fit(folded)
    k2 = _rows(e.transform_for_fold(folded, 2))
    by_train = _rows(e.transform_train(folded))
    for r in folded.where("fold_id = 2").collect():
        assert k2[r["ID"]]["province"] == pytest.approx(by_train[r["ID"]]["province"])
        assert k2[r["ID"]]["province_woe"] == pytest.approx(by_train[r["ID"]]["province_woe"])


def test_transform_before_fit_fails(folded):
    for e in (enc.FrequencyEncoder(COLS), enc.KFoldTargetEncoder(COLS), enc.WOEEncoder(COLS)):
        with pytest.raises(RuntimeError):
            e.transform(folded)


def test_full_fit_option_sees_own_label_and_default_does_not(folded, test_set):
    fe = folded.select("ID", "Target", "fold_id", *COLS)
    te = test_set.select("ID", *COLS)
    leaky, _ = target_woe_variant(fe, te, COLS, leak_safe=False)
    safe, _ = target_woe_variant(fe, te, COLS)
    assert set(leaky.columns) == set(safe.columns)
    per_category = safe.groupBy("fold_id", "province_loan_count").count()
    assert leaky.select("province_woe").distinct().count() <= 6
    assert safe.select("province_woe").distinct().count() > 6 and per_category.count() > 5


def test_stats_sizes_and_totals(folded):
    s = CategoryStats.fit(folded, COLS, "Target", "fold_id")
    assert s.sizes == {"province": 6, "employment_sector": 8} and s.n == 200
    assert s.folds == [0, 1, 2, 3, 4] and s.low_cardinality(6) == ["province"]


def test_all_variants(train, test_set, folds):
    out = build_all_variants(train, test_set, folds)
    assert set(out) == {"v1_ohe", "v2_ordinal", "v3_target_woe"}
    for tr, te in out.values():
        assert tr.count() == 200 and te.count() == 50
        assert {"ID", "Target"} <= set(tr.columns) and "ID" in te.columns and "Target" not in te.columns
    with pytest.raises(ValueError):
        build_all_variants(train, test_set, folds, ["v9"])


def test_unseen_outside_a_fold_gets_the_other_folds_rate(spark):
    """Rows of a category that no other fold has: the prior leaves out the fold's own labels, either way of encoding."""
    from loanloom.operators.encoders import FoldEncoder

    rows = [(f"r{i}", "only" if i == 0 else "xy"[i % 2], i % 3, int(i in (0, 3, 6, 4))) for i in range(12)]
    df = spark.createDataFrame(rows, "ID string, c string, fold_id int, Target int")
    enc = FoldEncoder(["c"], group_cols=["c"]).fit(df)
    got = {r["ID"]: r["c"] for r in enc.transform_train(df).select("ID", "c").collect()}
    own = [r for r in rows if r[2] != 0]
    assert got["r0"] == pytest.approx(sum(r[3] for r in own) / len(own))
    for k in range(3):
        part = df.where(f"fold_id = {k}")
        for r in enc.transform_for_fold(part, k).select("ID", "c").collect():
            assert got[r["ID"]] == pytest.approx(r["c"])
