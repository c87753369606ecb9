"""The copies of the anchors, one for each candidate block, are shuffled between tasks and never sent through the driver."""

import re

import numpy as np

from loanloom.llm import hard_negatives


def test_copies_of_anchors_are_not_broadcast(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, [float(e) for e in np.float32(rng.normal(0, 0.3, 12))], int(rng.integers(3))) for i in range(400)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    plans = []
    real = hard_negatives.materialize

    def watched(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df)

    monkeypatch.setattr(hard_negatives, "materialize", watched)
    monkeypatch.setattr(hard_negatives, "CANDIDATES", (16, 64))
    found = hard_negatives.hard_negatives(docs)
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    # a join of blocks has the number of a candidate block among its keys
    joins = [j for p in plans for j in re.findall(r"\w+Join \[dim#\d+, block#\d+", p)]
    assert len(joins) == 2 and all(j.startswith("SortMergeJoin") for j in joins), joins
