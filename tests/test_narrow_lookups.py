"""Ranks and folds are looked up for raw rows; features come after."""

from copy import copy

import pytest
from pyspark.sql import functions as F

from loanloom.operators import variants
from loanloom.operators.features import BaseFeatureEngineer, with_folds
from loanloom.operators.folds import make_folds
from loanloom.operators.variants import build_all_variants
from loanloom.schema import ID_COL


def _rows(df):
    return sorted(map(repr, df.collect()))


def _after(engineer, df):
    """Features first, ranks among the finished rows."""
    plain = copy(engineer)
    plain.ranks = False
    return engineer.rank_features(plain.transform(df))


def test_lookups_carry_no_features(spark, train):
    engineer = BaseFeatureEngineer().fit(train)
    out = engineer.transform(train)
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    text = out._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    last = min(i for i, line in enumerate(text.split("\n")) if "Join" in line)
    assert "debt_to_income" in text and not any("debt_to_income" in line for line in text.split("\n")[last:])
    assert out.columns == _after(engineer, train).columns and _rows(out) == _rows(_after(engineer, train))


def test_folds_of_repeated_and_missing_ids(spark, train):
    odd = train.unionByName(train.limit(7)).withColumn(ID_COL, F.expr(f"nullif({ID_COL}, 'TR00011')"))
    engineer = BaseFeatureEngineer().fit(odd)
    folds = make_folds(odd)
    joined = odd.join(folds, ID_COL)
    got, plain = with_folds(engineer, odd, joined, folds), with_folds(engineer, odd, joined, folds, ranks=False)
    want = _after(engineer, odd).join(folds, ID_COL)
    assert got.columns == want.columns and _rows(got) == _rows(want)
    assert _rows(plain) == _rows(want.select(*plain.columns))


@pytest.mark.parametrize("name", ["v1_ohe", "v2_ordinal", "v3_target_woe"])
def test_variants_are_fitted_on_all_training_rows(spark, train, test_set, folds, name):
    engineer = BaseFeatureEngineer()
    train_out, test_out = build_all_variants(train, test_set, folds, [name], engineer=engineer)[name]
    fe, te = _after(engineer.fit(train), train).join(folds, ID_COL), _after(engineer, test_set)
    cats = variants.detect_categories(fe, exclude=(ID_COL,))
    make = {"v1_ohe": variants.one_hot_variant, "v2_ordinal": variants.ordinal_variant, "v3_target_woe": variants.target_woe_variant}
    want = make[name](fe, te, cats)
    for got, other in zip((train_out, test_out), want, strict=True):
        assert got.columns == other.columns and _rows(got) == _rows(other)
