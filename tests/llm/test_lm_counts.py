import numpy as np
import pyarrow as pa

from loanloom.llm import lm_score


def _rows(grams, counts):
    return pa.RecordBatch.from_arrays([pa.array(grams, pa.int64()), pa.array(counts, pa.int64())], ["gram", "n"])


def _cells(batches):
    out = {}
    for b in batches:
        for r in b.to_pylist():
            at = np.frombuffer(r["places"], np.uint16).astype(np.int64)
            for k, z, o in zip(at, lm_score._wide(r["zeros"], len(at)), lm_score._wide(r["ones"], len(at)), strict=True):
                out[r["tab"], r["run"] * lm_score.RUN + int(k)] = (int(z), int(o))
    return out


def test_counts_grow_beyond_24_bits():
    """One string 2^24 times and 1,000 times more, one by one: no count is lost, in a task or in the sum of tasks."""
    gram, other = int.from_bytes(b"abcdez", "big"), int.from_bytes(b"abcdey", "big")
    task = [_rows([gram], [1 << 24]), _rows([gram] * 1000 + [other], [1] * 1001)]
    own = _cells(lm_score._count_bits(iter(task)))
    total = (1 << 24) + 1001
    assert own[0, 1] == (total, 0)  # both begin with a zero bit
    assert own[0, (1 << 7) | (ord("z") >> 1)] == ((1 << 24) + 1000, 0)
    sent = [b for _ in range(3) for b in lm_score._count_bits(iter(task[1:]))]
    summed = _cells(lm_score._sum_cells(iter([*lm_score._count_bits(iter(task)), *sent])))
    assert summed[0, 1] == (total + 3 * 1001, 0)


def test_sums_do_not_depend_on_partitions():
    rng = np.random.default_rng(4)
    grams, counts = rng.integers(0, 1 << 48, 200), rng.integers(1, 1 << 33, 200)
    one = _cells(lm_score._sum_cells(lm_score._count_bits(iter([_rows(grams, counts)]))))
    parts = [b for k in range(5) for b in lm_score._count_bits(iter([_rows(grams[k::5], counts[k::5])]))]
    assert _cells(lm_score._sum_cells(iter(parts[::-1]))) == one
    assert one[0, 1] == tuple(int(counts[(grams >> 7 & 1) == v].sum()) for v in (0, 1))
