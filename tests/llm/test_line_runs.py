import hashlib
from functools import partial

import pytest
from helpers import SF, edge_docs, edge_rows

from loanloom.llm import line_dedup
from loanloom.llm.queries import QUERIES


def _pairs_brute(rows):
    """Every line from a line that is not blank to the next such line goes if those bytes occurred before."""
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: -1 if r[0] is None else r[0]):
        lines, lost = (t or "").encode().split(b"\n"), set()
        for k in range(len(lines)):
            end = next((e for e in range(k + 1, len(lines)) if lines[e].strip(b" \t\n\v\f\r")), None)
            if end is None or not lines[k].strip(b" \t\n\v\f\r"):
                continue
            unit = b"\n".join(lines[k:end + 1])
            if unit in seen and i is not None:
                lost |= set(range(k, end + 1))
            seen.add(unit)
        out[i] = ("\n".join(x.decode() for k, x in enumerate(lines) if k not in lost), len(lost))
    return out


def _texts(found):
    return {r.doc_id: (r.kept_text, r.n_removed_lines) for r in found.collect()}


def test_short_runs_go_whole_amid_other_lines(spark):
    """Shared runs of 2 to 9 lines, each amid lines that no other text has."""
    rows, i = [], 0
    for length in range(2, 10):
        run = [f"shared {length} line {k}" for k in range(length)]
        for _ in range(3):
            rows.append((i, "\n".join([f"a{i}", f"b{i}", *run, f"c{i}", f"d{i}"])))
            i += 1
    rows += [(None, "shared 2 line 0\nshared 2 line 1"), (i, "x\nx\nx\ny\nx\nx"), (i + 1, "alone\nshared 2 line 0\nelse")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = _texts(line_dedup.line_dedup(docs))
    assert got == _pairs_brute(rows)
    assert got[1] == ("a1\nb1\nc1\nd1", 2) and got[0] == ("a0\nb0\nc0\nd0", 2) and got[3][1] == 0
    assert got[i + 1][1] == 0  # one shared line is no run


def test_blank_lines_are_no_runs(spark):
    rows = [(1, "p1\n\n\np2"), (2, "q1\n\n\nq2"), (3, "\n\n\n"), (4, "z\np1\n\n\np2\n\ny"), (5, "p1\n\np2"),
            (6, "p1\n \n\np2"), (7, "\n\n\n"), (8, "p1\n\n\np2\n\ny")]
    got = _texts(line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == _pairs_brute(rows)
    assert got[2] == ("q1\n\n\nq2", 0) and got[7] == ("\n\n\n", 0) and got[5][1] == got[6][1] == 0
    assert got[4] == ("z\n\ny", 4) and got[8] == ("", 6)


@pytest.mark.parametrize("limit", [200_000, 0])
def test_runs_of_edge_rows(spark, monkeypatch, limit):
    monkeypatch.setattr(line_dedup, "attach", partial(line_dedup.attach, limit=limit))  # at 0, lookups are shuffled
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", limit)
    assert _texts(line_dedup.line_dedup(edge_docs(spark))) == _pairs_brute([(r[0], r[1]) for r in edge_rows()])


def test_equal_hashes_do_not_make_equal_lines(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "_FACTOR", 0)
    monkeypatch.setattr(line_dedup, "_MASK", 0)  # all pairs have one hash
    rows = [(1, "a\nb\nc"), (2, "z\na\nb"), (3, "b\na")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert _texts(line_dedup.line_dedup(docs)) == _pairs_brute(rows)


def test_runs_of_the_query(spark):
    got = {r.doc_id: (r.kept_sha256, r.n_removed_lines) for r in QUERIES["op6_line_dedup"](spark, SF).collect()}
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert got == {i: (hashlib.sha256(t.encode()).hexdigest(), n) for i, (t, n) in _pairs_brute(rows).items()}
