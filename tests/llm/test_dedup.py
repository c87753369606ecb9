import hashlib
from collections import defaultdict

import pytest
from helpers import SF, edge_docs, edge_rows, no_docs, words

from loanloom.llm import exact_dedup, graph, jaccard_join, line_dedup, suffix_dedup
from loanloom.llm.graph import components
from loanloom.llm.queries import QUERIES


def _sets(rows, width):
    out = {}
    for i, t in rows:
        w = words(t)
        out[i] = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
    return out


def _components(sets, num, den):
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_exact_edges(spark):
    got = {(r.doc_id, r.text_sha256): r for r in exact_dedup.exact_dedup(edge_docs(spark)).collect()}
    groups = defaultdict(list)
    for i, t, *_ in edge_rows():
        groups[(t or "").encode()].append(i)
    assert len(got) == len(edge_rows())
    for text, ids in groups.items():
        sha = hashlib.sha256(text).hexdigest()
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            r = got[i, sha]
            assert (r.keep_id, r.group_size, r.kept) == (keep, len(ids), i == keep)
    kept = exact_dedup.keep_one(edge_docs(spark))
    assert kept.columns == edge_docs(spark).columns and kept.count() == len(groups)
    assert exact_dedup.exact_dedup(no_docs(spark)).count() == exact_dedup.keep_one(no_docs(spark)).count() == 0


def test_filters_merge_like_one(spark):
    values = [(i * i % 97,) for i in range(400)]
    rows = spark.createDataFrame(values, "fp long").repartition(7)
    want = {v: sum(x == (v,) for x in values) for v, in set(values)}
    got = {r.fp: r.n for r in exact_dedup.repeated_fingerprints(rows, 400).collect()}
    assert got == {v: n for v, n in want.items() if n > 1}


def test_equal_fingerprints_do_not_make_equal_texts(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "texts", lambda docs: docs.select("doc_id", "text"))
    from pyspark.sql import functions as F

    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda c: F.lit(5).cast("long"))
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.exact_dedup(docs).collect()}
    assert got == {1: (3, False), 2: (2, True), 3: (3, True)}


def test_jaccard_edges(spark):
    got = {r.doc_id: r for r in jaccard_join.jaccard_components(edge_docs(spark)).collect()}
    rows = [(i, t) for i, t, *_ in edge_rows()]
    sets = _sets([r for r in rows if r[0] is not None], 3)
    want = _components(sets, 90, 100)
    assert {i: r.component_id for i, r in got.items()} == {**want, None: None}
    assert all(got[i].n_shingles == len(s) for i, s in sets.items())
    assert jaccard_join.jaccard_components(no_docs(spark)).count() == 0


def test_jaccard_chains_and_long_lists(spark, monkeypatch):
    """A family in which each differs a little from the next: links chain, and lists are longer than the short limit."""
    base = [f"w{k}" for k in range(60)]
    rows = []
    for i in range(40):
        w = list(base)
        for k in range(i):
            w[(k * 7) % 60] = f"v{k}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, rows[i][1]) for i in range(0, 40, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for num, rows_ in ((70, 1000), (80, 1000), (90, 1000), (80, 3)):
        monkeypatch.setattr(jaccard_join, "LIST_ROWS", rows_)  # at 3, lists are dealt into blocks
        got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(docs, 3, num, 100).collect()}
        assert got == _components(_sets(rows, 3), num, 100)


def test_jaccard_query(spark):
    got = {r.doc_id: r.component_id for r in QUERIES["op10_jaccard_join"](spark, SF).collect()}
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert got == _components(_sets(rows, 3), 90, 100)


@pytest.mark.parametrize("last", [0, 20, 100_000])
def test_components_of_a_long_chain(spark, monkeypatch, last):
    monkeypatch.setattr(graph, "LAST_EDGES", last)
    monkeypatch.setattr(graph, "LOCAL_NODES", max(3, 2 * last))  # tasks cannot contract much by themselves
    edges = [(k, k + 1) for k in range(300)] + [(1000, 2000), (2000, 1500), (5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long").repartition(8)).collect()}
    assert got == {**dict.fromkeys(range(301), 0), **dict.fromkeys((1000, 1500, 2000), 1000)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _suffix_brute(rows):
    seen, out = set(), {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        b = (t or "").encode()
        covered = bytearray(len(b))
        own = [b[k:k + 50] for k in range(len(b) - 49)]
        for k, s in enumerate(own):
            if s in seen:
                covered[k:k + 50] = b"\1" * 50
        seen.update(own)
        kept = bytes(x for x, c in zip(b, covered, strict=True) if not c)
        runs = sum(1 for k, c in enumerate(covered) if c and (k == 0 or not covered[k - 1]))
        out[i] = (len(b), sum(covered), runs, hashlib.sha256(kept).hexdigest())
    return out


def test_suffix_edges(spark):
    got = {r.doc_id: r for r in suffix_dedup.suffix_dedup(edge_docs(spark)).collect()}
    want = _suffix_brute([(r[0], r[1]) for r in edge_rows()])
    assert {i: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for i, r in got.items() if i is not None} == want
    assert got[None].n_removed == 0
    assert all(r.n_removed == sum(r.ends) - sum(r.begins) for r in got.values())
    assert suffix_dedup.suffix_dedup(no_docs(spark)).count() == 0


def test_suffix_hot_anchors(spark, monkeypatch):
    """With every shared anchor hot, windows travel one by one; the result is the same."""
    monkeypatch.setattr(suffix_dedup, "HOT_DOCS", 1)
    got = {r.doc_id: r for r in suffix_dedup.suffix_dedup(edge_docs(spark)).collect() if r.doc_id is not None}
    want = _suffix_brute([(r[0], r[1]) for r in edge_rows()])
    assert {i: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for i, r in got.items()} == want


def test_suffix_query(spark):
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op1_suffix_dedup"](spark, SF).collect()}
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert got == _suffix_brute(rows)


def test_equal_windows():
    import numpy as np

    data = np.frombuffer(b"ab" * 60 + b"c" + b"ab" * 40, np.uint8)
    places = np.arange(len(data) - suffix_dedup.LENGTH + 1)
    group = suffix_dedup.equal_windows(data, places)
    text = data.tobytes()
    names = {}
    for p, g in zip(places, group, strict=True):
        assert names.setdefault(text[p:p + suffix_dedup.LENGTH], g) == g
    assert len(set(names.values())) == len(names)


def test_lines_edges(spark):
    got = {r.doc_id: r for r in line_dedup.line_dedup(edge_docs(spark)).collect()}
    assert got[1].n_lines == got[0].n_lines == 0 and got[10].n_removed_chunks == got[10].n_chunks
    assert got[10].kept_text == "" and got[17].kept_text == "tail line here"
    assert line_dedup.line_dedup(no_docs(spark)).count() == 0


def test_line_chunks_resist_shifts():
    lines = [f"line {k * k % 31}" for k in range(60)]
    a = {tuple(c) for _, c in line_dedup.chunk_lines("\n".join(lines).encode())}
    b = {tuple(c) for _, c in line_dedup.chunk_lines("\n".join([*lines[:3], "new", *lines[3:]]).encode())}
    assert len(a & b) >= len(a) - 3
