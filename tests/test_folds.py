import pytest
from pyspark.sql import functions as F

from loanloom.operators import folds as fd
from loanloom.sources import sinks


def test_every_row_once_and_rates_kept(train, folds):
    assert folds.count() == 200 and folds.select("ID").distinct().count() == 200
    summary = fd.fold_summary(train, folds).collect()
    assert len(summary) == 5 and {r["n"] for r in summary} == {40}
    assert not any(r["off"] for r in summary)
    fd.check_folds(train, folds, 5)


def test_parts_are_disjoint(train, folds):
    a, b = fd.fold_parts(train, folds, 1)
    assert a.select("ID").intersect(b.select("ID")).count() == 0 and a.count() + b.count() == 200


def test_repeatable_and_independent_of_partitions(train, folds):
    want = {r["ID"]: r["fold_id"] for r in folds.collect()}
    for parts in (1, 17):
        assert {r["ID"]: r["fold_id"] for r in fd.make_folds(train.repartition(parts)).collect()} == want
    assert {r["ID"]: r["fold_id"] for r in fd.make_folds(train, seed=7).collect()} != want


def test_wrong_fold_table_is_refused(train, folds):
    with pytest.raises(ValueError):
        fd.check_folds(train, folds.where("fold_id <> 1"), 5)
    with pytest.raises(ValueError):
        fd.check_folds(train, folds, 6)


def test_holdout_sizes_are_exact(train):
    rows = train.join(fd.holdout_split(train), "ID").groupBy("Target").agg(
        F.count(F.lit(1)).alias("n"), F.sum("is_holdout").alias("h")).collect()
    for r in rows:
        assert r["h"] == int(0.3 * r["n"] + 0.5)


def test_written_folds_are_reused(train, tmp_path):
    path = str(tmp_path / "folds")
    first = {r["ID"]: r["fold_id"] for r in sinks.folds_table(train, path).collect()}
    again = {r["ID"]: r["fold_id"] for r in sinks.folds_table(train, path).collect()}
    forced = {r["ID"]: r["fold_id"] for r in sinks.folds_table(train, path, seed=99, force=True).collect()}
    assert first == again and first != forced


def test_hash_sample(train):
    a = {r["ID"] for r in fd.hash_sample(train, 20).collect()}
    assert len(a) == 20 and a == {r["ID"] for r in fd.hash_sample(train.repartition(9), 20).collect()}
