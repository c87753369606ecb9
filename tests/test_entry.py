import duckdb
import pytest
from conftest import SF

import __spark_entry__ as entry

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
          " labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def test_flagship(spark):
    assert entry.entry(spark).count() == 4


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["a05_date_parse", "c02_medians", "d05_oof_target", "f01_stratified_folds",
                                  "g02_global_rank", "h01_roc_auc", "h09_best_threshold", "j01_rank_average"])
def test_against_sql(spark, con, name):
    got = entry.queries()[name](spark, SF)
    rel = con.sql(entry.oracle_sql()[name])
    assert sorted(got.columns) == sorted(rel.columns)
    cols = sorted(got.columns)
    key = lambda rows: sorted(tuple(str(v) for v in r) for r in rows)
    assert key(got.select(cols).collect()) == key(rel.select(*cols).fetchall())
