import csv
import glob
import json

import pytest
from conftest import loan_row
from pyspark.sql import functions as F

from loanloom.schema import ID_COL, TARGET_COL
from loanloom.sources import readers, sinks, submission


def _write_csv(path, rows, drop=()):
    names = [c for c in rows[0] if c not in drop]
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(names)
        for r in rows:
            w.writerow(["" if r[c] is None else r[c].strftime("%-d/%-m/%Y") if hasattr(r[c], "strftime") else r[c]
                        for c in names])


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    _write_csv(folder / "Train.csv", [loan_row(i) for i in range(200)])
    _write_csv(folder / "Test.csv", [{**loan_row(i, True), "Target": 0} for i in range(50)])
    with open(folder / "SampleSubmission.csv", "w") as f:
        f.write("ID,Target\n" + "".join(f"TT{i:05d},0\n" for i in reversed(range(50))))
    return str(folder)


def test_train_csv(spark, raw, train):
    got = readers.load_train(spark, f"{raw}/Train.csv")
    assert dict(got.dtypes)["date_approved"] == "date" and dict(got.dtypes)["amount_usd"] == "double"
    assert dict(got.dtypes)["Target"] == "int" and dict(got.dtypes)["product_code"] == "int"
    want = {r["ID"]: r for r in train.collect()}
    for r in got.collect():
        w = want[r["ID"]]
        for c in ("client_dob", "amount_usd", "monthly_income_usd", "province", "collateral_type", "Target"):
            assert r[c] == w[c], c
    none_as_null = readers.load_train(spark, f"{raw}/Train.csv", na_values=["", "None"])
    assert got.where("collateral_type = 'None'").count() > 0
    assert none_as_null.where("collateral_type = 'None'").count() == 0


def test_columns_are_matched_by_name(spark, tmp_path):
    """Files of one folder may name their columns in different order, not different columns."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("ID,amount_usd,term_months,Target\nA1,900,24,0\n")
    (tmp_path / "in" / "b.csv").write_text("Target,ID,term_months,amount_usd\n1,B1,12,450.5\n0,B2,6,75\n")
    got = {r["ID"]: (r["amount_usd"], r["term_months"], r["Target"]) for r in
           readers.load_train(spark, str(tmp_path / "in")).collect()}
    assert got == {"A1": (900.0, 24, 0), "B1": (450.5, 12, 1), "B2": (75.0, 6, 0)}
    order = readers.load_template(spark, str(tmp_path / "in")).orderBy("template_pos").collect()
    assert [r["ID"] for r in order] == ["A1", "B1", "B2"]
    summary = readers.submission_summaries(spark, str(tmp_path / "in")).first()
    assert (summary["rows"], summary["max"]) == (3, 1.0)
    (tmp_path / "in" / "c.csv").write_text("ID,amount_usd,Target\nC1,1,0\n")
    with pytest.raises(ValueError, match="term_months"):
        readers.load_train(spark, str(tmp_path / "in"))


def test_stored_folds_must_fit(spark, train, tmp_path):
    path = str(tmp_path / "folds")
    first = sinks.folds_table(train, path, 5, 42)
    again = sinks.folds_table(train, path, 5, 42)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect())) and again.columns == first.columns
    for n_folds, seed in ((10, 42), (5, 7)):
        with pytest.raises(ValueError, match="force"):
            sinks.folds_table(train, path, n_folds, seed)
    grown = train.unionByName(train.withColumn("ID", F.concat(F.lit("X"), "ID")))
    with pytest.raises(ValueError, match="force"):
        sinks.folds_table(grown, path, 5, 42)
    assert sinks.folds_table(grown, path, 5, 42, force=True).count() == 400


def test_csv_errors(spark, raw):
    with pytest.raises(FileNotFoundError):
        readers.load_train(spark, f"{raw}/absent.csv")
    with pytest.raises(ValueError):
        readers.load_train(spark, f"{raw}/Train.csv", target_col="defaulted")
    with pytest.raises(FileNotFoundError):
        readers.read_parquet(spark, f"{raw}/absent.parquet")


def test_test_csv_loses_its_target(spark, raw):
    assert "Target" not in readers.load_test(spark, f"{raw}/Test.csv").columns


def test_template_keeps_file_order(spark, raw):
    ids = [r["ID"] for r in readers.load_template(spark, f"{raw}/SampleSubmission.csv").orderBy("template_pos").collect()]
    assert ids == [f"TT{i:05d}" for i in reversed(range(50))]


def test_unique_ids(spark, train):
    readers.assert_unique(train)
    with pytest.raises(ValueError):
        readers.assert_unique(train.unionByName(train.limit(1)))


def test_variants_metrics_and_runs(spark, train, test_set, tmp_path):
    sinks.write_variant(str(tmp_path), "v2_ordinal", train, test_set)
    tr, te = sinks.read_variant(spark, str(tmp_path), "v2_ordinal")
    assert tr.count() == 200 and te.count() == 50
    row = spark.createDataFrame([("lr", "v1", [0.6, 0.7], 0.65)], "model string, variant string, fold_aucs array<double>, mean_auc double")
    for _ in range(2):
        sinks.append_metrics(row, str(tmp_path / "log"))
    lines = [json.loads(x) for f in glob.glob(str(tmp_path / "log" / "*.json")) for x in open(f)]
    assert len(lines) == 2 and lines[0]["fold_aucs"] == [0.6, 0.7]


@pytest.fixture(scope="module")
def scores(test_set):
    return test_set.select(ID_COL, (F.col("amount_usd") / 50000).alias(TARGET_COL))


def test_submission_is_in_template_order(spark, raw, scores, tmp_path):
    template = readers.load_template(spark, f"{raw}/SampleSubmission.csv")
    path = submission.write_submission(scores, template, str(tmp_path), "a", 50, str(tmp_path / "runs"))
    rows = []
    for f in sorted(glob.glob(f"{path}/part-*.csv")):
        rows += list(csv.DictReader(open(f)))
    assert [r["ID"] for r in rows] == [f"TT{i:05d}" for i in reversed(range(50))]
    assert list(rows[0]) == ["ID", "Target"]
    run = spark.read.json(str(tmp_path / "runs")).first()
    assert (run["tag"], run["file"], run["rows"]) == ("a", "sub_a", 50)
    many = submission.write_submissions({"b": scores, "c": scores}, template, str(tmp_path))
    assert len(many) == 2
    summary = {r["file"]: r for r in readers.submission_summaries(spark, f"{tmp_path}/sub_*").collect()}
    assert set(summary) == {"sub_a", "sub_b", "sub_c"} and summary["sub_a"]["rows"] == 50


@pytest.mark.parametrize("spoil,rule", [
    (lambda s: s.withColumnRenamed("Target", "score"), "columns"),
    (lambda s: s.where("ID <> 'TT00003'"), "row_count"),
    (lambda s: s.where("ID <> 'TT00003'"), "missing_id"),
    (lambda s: s.withColumn("Target", F.when(F.col("ID") != "TT00003", F.col("Target"))), "null_score"),
    (lambda s: s.withColumn("ID", F.when(F.col("ID") != "TT00003", F.col("ID"))), "null_id"),
    (lambda s: s.unionByName(s.where("ID = 'TT00003'")), "duplicate_id"),
    (lambda s: s.withColumn("ID", F.regexp_replace("ID", "TT00003", "XX")), "unknown_id"),
])
def test_each_rule_is_named(spark, raw, scores, spoil, rule):
    template = readers.load_template(spark, f"{raw}/SampleSubmission.csv")
    with pytest.raises(ValueError, match=rule):
        submission.validate(spoil(scores), template)
    submission.validate(scores, template, 50)


def test_expected_count_is_checked(spark, raw, scores):
    template = readers.load_template(spark, f"{raw}/SampleSubmission.csv")
    with pytest.raises(ValueError, match="row_count"):
        submission.validate(scores, template, 51)
