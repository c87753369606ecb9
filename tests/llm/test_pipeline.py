import json
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import SF, edge_docs, edge_rows, no_docs, words
from pyspark.sql import functions as F

import corpus_pipeline
from loanloom.llm import mixing, segmentation
from loanloom.llm.queries import ORACLE, QUERIES

# --- mixing -----------------------------------------------------------------


def _brute_budgets(tree, plan):
    """Hand out shares; children that are full give the rest to their siblings, until nothing changes."""
    cap = {k: t * plan.epochs for k, t in tree.items()}
    out = {}

    def size(path):
        return sum(v for k, v in cap.items() if k[:len(path)] == path)

    def fill(path, budget):
        if len(path) == 3:
            out[path] = budget
            return
        kids = sorted({k[:len(path) + 1] for k in cap if k[:len(path)] == path})
        weight = {k: plan.weights.get(k, plan.default_weight) for k in kids}
        full, left = {k: 0.0 for k in kids if weight[k] == 0}, budget
        while True:
            free = [k for k in kids if k not in full]
            share = {k: left * weight[k] / sum(weight[j] for j in free) for k in free}
            over = [k for k in free if share[k] >= size(k)]
            if not over:
                full.update(share)
                break
            for k in over:
                full[k] = size(k)
                left -= size(k)
        for k in kids:
            fill(k, full[k])

    fill((), float(int(sum(tree.values()) * plan.fraction)))
    return out


@pytest.mark.parametrize("plan", [
    mixing.MixPlan(), mixing.MixPlan(fraction=0.3, epochs=1), mixing.MixPlan(fraction=1.9),
    mixing.MixPlan(weights={("d0",): 5.0, ("d1", "en"): 0.0, ("d2", "de", "s1"): 0.1}, seed=9)])
def test_budgets_and_prefixes(spark, plan):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    drawn, tree = mixing.mix(docs, plan)
    drawn, tree = drawn.collect(), {(r._k0, r._k1, r._k2): r for r in tree.collect()}
    want = _brute_budgets({k: r.tokens for k, r in tree.items()}, plan)
    assert all(abs(want[k] - r.budget) <= 1.001 for k, r in tree.items())
    by_leaf = defaultdict(list)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in drawn:
        assert r._tok == len(words(texts[r.doc_id]))
        by_leaf[r._k0, r._k1, r._k2].append(r)
    for k, rows in by_leaf.items():
        leaf = tree[k]
        used = sum(r._tok * r.copies for r in rows)
        assert used <= leaf.budget and {r.copies for r in rows} <= {leaf.epochs, leaf.epochs + 1}
        # the next document in the order would not fit, so at most the largest is missing
        if any(r.copies == leaf.epochs for r in rows) and leaf.budget < leaf.cap:
            assert leaf.budget - used <= max(r._tok for r in rows if r.copies == leaf.epochs)
    assert len(drawn) == len(texts)


def test_slices_do_not_change_the_draw(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = {r.doc_id: r.copies for r in mixing.report(docs).collect()}
    monkeypatch.setattr(mixing, "SLICE_DOCS", 3)
    assert {r.doc_id: r.copies for r in mixing.report(docs.repartition(7)).collect()} == whole


def test_mixing_edges(spark):
    docs = edge_docs(spark)
    got = mixing.mixed_documents(docs, mixing.MixPlan(fraction=1.0))
    assert got.columns == docs.columns
    ids = Counter(r.doc_id for r in got.collect())
    assert set(ids) <= {r[0] for r in edge_rows()} and max(ids.values()) <= 2
    assert mixing.mixed_documents(no_docs(spark)).count() == mixing.report(no_docs(spark)).count() == 0


# --- segmentation -----------------------------------------------------------

@pytest.fixture(scope="module")
def pieces():
    return segmentation.load_pieces()


def _draw(pieces, text, n, k):
    raw = np.frombuffer(text.encode(), np.uint8)
    res = segmentation.sample_slice(pieces, np.tile(raw, n), np.arange(n + 1) * len(raw), np.arange(n), k)
    out = defaultdict(list)
    for r in res:
        for i, t in enumerate(r["text"]):
            ids = tuple(r["ids"][r["bounds"][i]:r["bounds"][i + 1]].tolist())
            out[int(t)].append((ids, r["log_p"][i], r["score"][i], np.exp(r["log_inclusion"][i]), bool(r["lossless"][i])))
    return out


def _all_segmentations(pieces, raw):
    """Every segmentation of a space-led text with its weight."""
    table = defaultdict(list)
    for i in range(len(pieces.weight)):
        b = pieces.data[pieces.offs[i]:pieces.offs[i + 1]].tobytes()
        if b and i not in pieces.of_byte.tolist():
            table[b].append(i)
    out = {}

    def walk(at, ids, log):
        if at == len(raw):
            out[ids] = log
            return
        for end in range(at + 1, len(raw) + 1):
            for i in table.get(raw[at:end], ()):
                walk(end, (*ids, i), log + pieces.weight[i])

    walk(0, (), 0.0)
    top = np.logaddexp.reduce(list(out.values()))
    return {k: v - top for k, v in out.items()}


def test_samples_follow_the_lattice(pieces):
    exact = _all_segmentations(pieces, b" thenand")
    n, k = 6000, 3
    got = _draw(pieces, "thenand", n, k)
    first = Counter(v[0][0] for v in got.values())
    for ids, log in exact.items():
        p = np.exp(log)
        assert abs(first[ids] / n - p) < 5 * np.sqrt(p * (1 - p) / n) + 1e-3
    for v in got.values():
        assert len({x[0] for x in v}) == len(v) == k and all(x[4] for x in v)
        assert all(abs(exact[x[0]] - x[1]) < 1e-6 for x in v)
        assert [x[2] for x in v] == sorted((x[2] for x in v), reverse=True)
    # inclusion probabilities weigh the samples without bias
    total = np.mean([sum(np.exp(x[1]) / x[3] for x in v) for v in got.values()])
    assert total == pytest.approx(1, abs=0.05)
    # the second sample follows the lattice without the first
    ids = first.most_common(1)[0][0]
    second = Counter(v[1][0] for v in got.values() if v[0][0] == ids)
    for other, log in exact.items():
        if other != ids:
            p = np.exp(log) / (1 - np.exp(exact[ids]))
            assert abs(second[other] / sum(second.values()) - p) < 5 * np.sqrt(p / sum(second.values())) + 5e-3


def test_exhausted_lattices_give_fewer(pieces):
    got = _draw(pieces, "\n", 4, 5)
    assert all(len(v) < 5 and v[-1][3] == pytest.approx(1) for v in got.values())


def test_segmentation_edges(spark):
    docs = edge_docs(spark)
    encoded = segmentation.encode(docs, 3)
    rows = encoded.collect()
    assert all(r.lossless and -1e9 < r.log_inclusion <= 0 and r.log_prob <= 1e-9 for r in rows)
    assert {r.doc_id for r in rows} == {r[0] for r in edge_rows()}
    for i in {r.doc_id for r in rows}:
        own = [tuple(r.ids) for r in rows if r.doc_id == i]
        assert len(set(own)) == len(own) <= 3
    back = {(r.doc_id, r.sample): r.text for r in segmentation.decode(encoded).collect()}
    texts = {r[0]: r[1] or "" for r in edge_rows()}
    assert all(t == texts[i] for (i, _), t in back.items())
    # numbers hang on the row key: another partitioning gives the same, but for the last digits of sums
    again = {(r.doc_id, r.sample): r for r in segmentation.encode(docs.repartition(1), 3).collect()}
    assert all(again[r.doc_id, r.sample].ids == r.ids for r in rows)
    assert all(again[r.doc_id, r.sample].perturbed == pytest.approx(r.perturbed, abs=1e-6) for r in rows)
    assert segmentation.encode(no_docs(spark)).count() == 0


# --- pipeline ---------------------------------------------------------------

def test_stages_keep_columns_and_shrink(spark):
    docs = edge_docs(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
    empty = no_docs(spark)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_pipeline_against_brute_force(spark):
    """Deduplication stages by brute force on what language ID keeps, mixing by its own report, whole encoding."""
    from loanloom.llm import language_id

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [r for r in language_id.keep_identified(docs).collect()]
    best = {}
    for r in kept:
        best[r.text] = max(best.get(r.text, -1), r.doc_id)
    rows = sorted((i, t) for t, i in best.items())
    sets = {}
    for i, t in rows:
        w = words(t)
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    left = {i for i in sets if find(i) == i}
    mixed = {r.doc_id: r.copies for r in mixing.report(docs.where(F.col("doc_id").isin(list(left)))).collect()}
    got = corpus_pipeline.run(spark, SF)
    per = Counter(r.doc_id for r in got.where("sample = 1").collect())
    assert dict(per) == {i: c for i, c in mixed.items() if c}
    assert got.where("not lossless").count() == 0
    assert json.dumps(sorted(got.columns))


def test_every_operator_is_registered():
    assert {int(q[2:].split("_")[0]) for q in QUERIES} == set(range(1, 11)) and set(ORACLE) <= set(QUERIES)


def test_sql(spark):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    for name, sql in ORACLE.items():
        rel, got = con.sql(sql), QUERIES[name](spark, SF)
        cols = sorted(got.columns)
        assert cols == sorted(rel.columns)
        assert sorted(map(tuple, got.select(cols).collect())) == sorted(rel.select(*cols).fetchall())
