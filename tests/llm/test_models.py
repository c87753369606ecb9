import math
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import SF, edge_docs, edge_rows, no_docs
from pyspark.sql import functions as F

from loanloom.llm import ann, language_id, lm_score, toxicity
from loanloom.llm.bytewise import mix, shingle_sets, text_slices, word_hashes
from loanloom.llm.queries import QUERIES


def _crc(i, n):
    return zlib.crc32(str(i).encode()) % n


# --- bytes ------------------------------------------------------------------

def test_words_and_shingles_match_python():
    texts = [r[1] or "" for r in edge_rows()]
    raw = [t.encode() for t in texts]
    data, offs = np.frombuffer(b"".join(raw), np.uint8), np.r_[0, np.cumsum([len(b) for b in raw])]
    hashes, of_text = word_hashes(data, offs)
    names = {}
    for k, b in enumerate(raw):
        words = b.lower().split()
        assert of_text[k + 1] - of_text[k] == len(words)
        for w, h in zip(words, hashes[of_text[k]:of_text[k + 1]], strict=True):
            assert names.setdefault(w, h) == h
    assert len(set(names.values())) == len(names)
    for b, s in zip(raw, shingle_sets(data, offs), strict=True):
        w = b.lower().split()
        assert len(s) == len({tuple(w[k:k + 3]) for k in range(len(w) - 2)} or ({tuple(w)} if w else ()))


def test_slices_cover_all_rows():
    import pyarrow as pa

    column = pa.array(["", "ab", "", "x" * 50, "é", ""])
    got = [(lo, hi, data.tobytes().decode()) for lo, hi, _, data in text_slices(column.slice(1), 10)]
    assert [g[:2] for g in got] == [(0, 2), (2, 3), (3, 5)] and "".join(g[2] for g in got) == "ab" + "x" * 50 + "é"
    assert len(np.unique(mix(np.arange(1000).astype(np.uint64)))) == 1000


# --- language ID ------------------------------------------------------------

def test_gradients_are_those_of_the_loss():
    net = language_id.ByteGRU(3, 2, 1)
    net.w = {n: w.astype(np.float64) for n, w in net.w.items()}
    rng = np.random.default_rng(0)
    x, y = rng.integers(97, 110, (9, 5)).astype(np.uint8), np.array([0, 1, 0, 1, 1])
    _, grad = net.gradients(x, y)
    for n, w in net.w.items():
        at = (1, int(x[3, 2])) if n.startswith("in") else tuple(rng.integers(0, s) for s in w.shape)
        old, e, loss = w[at], 1e-4, []
        for d in (e, -e):
            w[at] = old + d
            loss.append(net.gradients(x, y)[0])
        w[at] = old
        assert (loss[0] - loss[1]) / 2 / e == pytest.approx(grad[n][at], rel=0.05, abs=1e-6)


def test_language_edges(spark):
    docs = edge_docs(spark)
    few = language_id.Params(passes=2, least_steps=4)
    got = {r.doc_id: r for r in language_id.identify(docs, few).collect()}
    assert len(got) == len(edge_rows())
    for i, t, *_ in edge_rows():
        r = got[i]
        letters = any(c.isalpha() for c in t or "")
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1
        assert r.held_out == (i is not None and _crc(i, 4) == 2)
    kept = language_id.keep_identified(docs, 0.0, few)
    assert kept.columns == docs.columns and kept.count() == sum(r.lang_pred != "und" for r in got.values())
    assert language_id.identify(no_docs(spark)).count() == language_id.keep_identified(no_docs(spark)).count() == 0
    nothing = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.identify(nothing).collect()} == {"und"}


def test_languages_are_found(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.train(docs.where(~language_id.held_out()))
    got = language_id.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if _crc(r.doc_id, 4) == 2]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.85
    text = docs.where("lang = 'en' and n_chars > 300").first().text
    labels = language_id.position_labels(model, text)
    assert len(labels) == len(text.encode())
    # pooling: runs of any cut give the mean of the position probabilities
    assert model.langs[Counter(labels.tolist()).most_common(1)[0][0]] == "en"


# --- nearest neighbours -----------------------------------------------------

def _nearest_brute(rows, k, queries):
    use = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, q in use:
        if queries(i):
            found = []
            for j, c in use:
                if j != i and len(c) == len(q):
                    s = 0.0
                    for a, b in zip(q, c, strict=True):
                        s += a * b
                    found.append((-s, j))
            out[i] = [(j, -s) for s, j in sorted(found)[:k]]
    return out


@pytest.mark.parametrize("block", [(7, 7), (4096, 32768)])
def test_nearest_edges(spark, monkeypatch, block):
    monkeypatch.setattr(ann, "CANDIDATES", block)
    monkeypatch.setattr(ann, "QUERIES", block[0])
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in rng.standard_normal(8)]) for i in range(60)]
    rows += [(100 + i, rows[4][1]) for i in range(30)]  # ties
    rows += [(200, None), (201, []), (202, [0.0] * 8), (203, [float("nan")] + [1.0] * 7), (204, [None] + [1.0] * 7),
             (205, [float("inf")] * 8), (None, [1.0] * 8), (206, [1.0, 2.0]), (210, [3.0, 1.0]), (212, [1e30] * 8)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, block string, dim int")
    got = {}
    for r in ann.nearest(df, 5, "vec_id % 2 = 0").orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    rows = [(i, None if v is None else [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert got == {i: v for i, v in _nearest_brute(rows, 5, lambda i: i % 2 == 0).items() if v}
    assert ann.nearest(df.limit(0), 5).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((50, 16)) * 10.0 ** rng.integers(-8, 8, (50, 1))
    q, s, norm, rest = ann.quantise(x)
    assert (np.linalg.norm(x - q * s[:, None], axis=1) <= rest).all() and (np.abs(q) <= 127).all()


# --- language model ---------------------------------------------------------

def test_lm_edges(spark):
    rows = [(r[0], r[1] or "") for r in edge_rows() if r[0] is not None]
    got = {r.doc_id: r for r in lm_score.score_documents(edge_docs(spark)).collect()}
    learn = [t for i, t in rows if _crc(i, 10)]
    counts = Counter(w for t in learn for w in t.encode().lower().split())
    n, v = sum(counts.values()) + len(learn), len(counts) + 1
    assert set(got) == {i for i, _ in rows}
    for i, t in rows:
        words, r = t.encode().lower().split(), got[i]
        want = sum(math.log10((c + 0.1) / (n + 0.1 * (v + 1))) for c in [*(counts[w] for w in words), len(learn)])
        assert r.base_score == pytest.approx(want) and r.n_tokens == len(words) + 1
        assert (r.n_known, r.train_tokens) == (sum(w in counts for w in words) + 1, n)
        assert r.held_out == (_crc(i, 10) == 0) and r.score < 0
    assert got[0].score == got[1].score and got[9].score == got[10].score
    assert lm_score.score_documents(no_docs(spark)).count() == 0


def test_rare_words_take_the_shuffle(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "FREQUENT", 5)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    base = docs.select("doc_id", "text")
    few = {r.doc_id: (r.n_tokens, r.n_known, r.base_score) for r in lm_score.word_scores(base, base).collect()}
    monkeypatch.setattr(lm_score, "FREQUENT", 100_000)
    for r in lm_score.word_scores(base, base).collect():
        assert few[r.doc_id][:2] == (r.n_tokens, r.n_known) and few[r.doc_id][2] == pytest.approx(r.base_score)


def test_lm_is_a_distribution_and_learns():
    """The next byte's probabilities add up to one; text like the training text costs less."""
    rng = np.random.default_rng(4)
    words = [b"alpha", b"beta", b"gamma", b"delta"]
    sample = [b" ".join(words[k] for k in rng.integers(0, 4, 60)) for _ in range(30)]
    tables = [np.zeros((2, 1 << b), np.float32) for b in (8, *lm_score.BITS)]
    for s in sample:
        g = lm_score.coded(np.frombuffer(s, np.uint8), np.array([0, len(s)]))[0]
        for bit in range(8):
            node, one = (1 << bit) | ((g & 255) >> (8 - bit)), (g >> (7 - bit)) & 1
            np.add.at(tables[0], (one, node), 1)
            for k, h in enumerate(lm_score._slots(g)):
                np.add.at(tables[k + 1], (one, lm_score._cell(h, node, lm_score.BITS[k])), 1)
    mixer = lm_score.learn_mixer(tables, sample, lm_score.Params(lanes=8, passes=1))
    context = int.from_bytes(b"alpha", "big") << 8
    assert np.exp2(mixer.log2(context + np.arange(256))).sum() == pytest.approx(1)
    cost = lambda s: -mixer.log2(lm_score.coded(np.frombuffer(s, np.uint8), np.array([0, len(s)]))[0]).sum() / len(s)
    assert cost(b"gamma delta alpha beta beta alpha") < 2 < 6 < cost(b"QXZ#73 ~~|vw@@")


def test_coded_texts_end_and_escape():
    raw = [b"ab", b"", b"x\0y"]
    gram, text = lm_score.coded(np.frombuffer(b"".join(raw), np.uint8), np.array([0, 2, 2, 5]))
    coded = [bytes((gram[text == k] & 255).astype(np.uint8)) for k in range(3)]
    assert coded == [b"ab\0\0", b"\0\0", b"x\0\1y\0\0"]
    assert gram[0] >> 8 == 0 and gram[1] >> 8 == ord("a")


def test_lm_query_prefers_the_mixture_to_nothing(spark):
    got = QUERIES["op4_lm_score"](spark, SF).collect()
    assert len(got) == 200 and all(0 < r.bits_per_byte < 9 for r in got if r.n_tokens > 20)


# --- toxicity ---------------------------------------------------------------

def test_counterfactual_penalty_lets_names_go():
    """A group that is only named in toxic texts: with the penalty its name weighs little, the insult keeps its weight."""
    word = toxicity._cell_of
    rows, y = [], []
    for i in range(300):
        toxic = i % 3 == 0
        text = [word(f"filler{i % 7}")]
        if toxic:
            text.append(word("muslims" if i % 2 else "idiot"))
        rows.append(np.unique(np.array(text, np.uint32)))
        y.append(float(toxic))
    weight = {}
    for swap in (0.0, 5.0):
        m = toxicity.fit(rows, np.array(y), toxicity.Params(swap=swap, least_gap=0.0))
        weight[swap] = dict(zip(m.words.tolist(), m.weight, strict=True))
    assert abs(weight[5.0].get(word("muslims"), 0)) < 0.5 * weight[0.0][word("muslims")]
    assert weight[5.0][word("idiot")] > 2


def test_toxicity_edges(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(15)] + [(3, 0, 1), (None, 1, 1), (4, 1, None)],
                                   "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.classify(docs, labels).collect()}
    assert len(got) == len(edge_rows())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    assert got[0].score == got[1].score == got[2].score
    none = toxicity.classify(docs, labels.limit(0)).collect()
    assert len(none) == len(edge_rows()) and toxicity.classify(no_docs(spark), labels).count() == 0


def test_toxic_documents_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = toxicity.classify(docs, labels).join(labels, "doc_id").collect()
    clean = [r for r in got if r.held_out and not r.toxic]
    assert sum(r.predicted for r in clean) <= 0.03 * len(clean)
    learned = [r for r in got if not r.held_out and r.toxic]
    assert sum(r.predicted for r in learned) > 0.6 * len(learned)
