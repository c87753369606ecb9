"""The search query tries all candidates of its space, with the numbers of trees that the space gives."""

import json
from types import SimpleNamespace

from loanloom.operators import search, training
from loanloom.plans import queries_train

from conftest import SF


def test_random_search_is_whole(spark, monkeypatch):
    fitted = []
    monkeypatch.setattr(training, "cv_train", lambda name, params, *a, **k: fitted.append((name, params)) or SimpleNamespace(
        mean_auc=0.5, fold_aucs=[0.5]))
    table = queries_train.random_search(spark, SF).collect()
    want = search.suggest("xgb", 50)
    assert fitted == [("xgb", p) for p in want]
    assert [json.loads(r.params) for r in sorted(table, key=lambda r: r.trial)] == want
    assert max(p["n_estimators"] for _, p in fitted) > 1900
