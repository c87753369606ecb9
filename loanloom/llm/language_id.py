"""Language ID: a bidirectional gated recurrent network over bytes, trained by backpropagation through time.

Texts are cut into runs of ``STEPS`` bytes that are read side by side, forwards
and backwards. Every byte position gets a distribution over languages from the
two states that meet there; a document's probabilities are the means over all
its positions. The last run of a text reaches back into its predecessor so
that it is full; those positions count once.

Gates use the quotient x / (1 + |x|) in place of the logistic curve and the
hyperbolic tangent; it is several times cheaper per byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.bytewise import text_slices
from loanloom.llm.tables import crc_mod, fresh, texts

#: Bytes in a run.
STEPS = 64
#: Runs that are scored side by side.
WIDTH = 2048
#: Bound of the training sample: documents of a language, and runs of a document.
DOCS_PER_LANG = 1200
RUNS_PER_DOC = 2


@dataclass
class Params:
    """Training settings; the sample is at most ``docs_per_lang`` documents of each language."""

    hidden: int = 8
    passes: int = 16
    least_steps: int = 600
    batch: int = 256
    rate: float = 0.02
    seed: int = 7
    docs_per_lang: int = DOCS_PER_LANG


def _soft(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """x / (1 + |x|) and 1 + |x|."""
    d = np.abs(x)
    d += 1
    return x / d, d


class ByteGRU:
    """One hidden layer per direction; arrays are (features, runs), time is the first axis of inputs."""

    def __init__(self, hidden: int, classes: int, seed: int):
        rng = np.random.default_rng(seed)
        draw = lambda *s: (rng.standard_normal(s) * 0.3).astype(np.float32)
        self.hidden = hidden
        self.w = {}
        for d in "fb":
            self.w[f"in_{d}"] = draw(3 * hidden, 256)
            self.w[f"rec_{d}"] = draw(3 * hidden, hidden)
        self.w["out"] = draw(classes, 2 * hidden)
        self.w["bias"] = np.zeros((classes, 1), np.float32)

    def _states(self, x: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """States after each byte, (steps, hidden, runs); ``keep`` gets what the backward pass needs."""
        k, (steps, runs) = self.hidden, x.shape
        w_in, w_rec = self.w[f"in_{d}"], self.w[f"rec_{d}"]
        out = np.empty((steps, k, runs), np.float32)
        h = np.zeros((k, runs), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            g = np.take(w_in, x[t], axis=1)
            r = w_rec @ h
            gates = g[:2 * k]
            gates += r[:2 * k]
            s, ds = _soft(gates)
            s *= 0.5
            s += 0.5                                  # update gate, reset gate
            cand = g[2 * k:]
            cand += s[k:] * r[2 * k:]
            c, dc = _soft(cand)
            new = h + s[:k] * (c - h)
            if keep is not None:
                keep.append((t, h, s, ds, c, dc, r[2 * k:]))
            h = out[t] = new
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """(steps, classes, runs) of bytes x (steps, runs)."""
        hf, hb = self._states(x, "f"), self._states(x, "b")
        k = self.hidden
        logits = self.w["out"][:, :k] @ hf
        logits += self.w["out"][:, k:] @ hb
        logits += self.w["bias"]
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean log loss over all positions of runs with classes y, and its gradients through time."""
        k, (steps, runs) = self.hidden, x.shape
        kept = {"f": [], "b": []}
        states = {d: self._states(x, d, kept[d]) for d in "fb"}
        both = np.concatenate([states["f"], states["b"]], axis=1)
        logits = self.w["out"] @ both + self.w["bias"]
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=1, keepdims=True)
        loss = float(-np.log(p[:, y, np.arange(runs)] + 1e-9).mean())
        p[:, y, np.arange(runs)] -= 1
        p /= steps * runs
        grad = {"out": np.einsum("tcn,tkn->ck", p, both, optimize=True),
                "bias": p.sum(axis=(0, 2))[:, None]}
        into = np.einsum("ck,tcn->tkn", self.w["out"], p, optimize=True)
        for d, part in (("f", into[:, :k]), ("b", into[:, k:])):
            w_rec = self.w[f"rec_{d}"]
            d_in = np.zeros((256, 3 * k), np.float32)
            d_rec = np.zeros_like(w_rec)
            dh = np.zeros((k, runs), np.float32)
            for t, h, s, ds, c, dc, rc in reversed(kept[d]):
                dh = dh + part[t]
                d_cand = dh * s[:k] / (dc * dc)
                d_gate = np.concatenate([dh * (c - h), d_cand * rc]) * 0.5 / (ds * ds)
                d_pre = np.concatenate([d_gate, d_cand])
                d_r = np.concatenate([d_gate, d_cand * s[k:]])
                np.add.at(d_in, x[t], d_pre.T)
                d_rec += d_r @ h.T
                dh = dh * (1 - s[:k]) + w_rec.T @ d_r
            grad[f"in_{d}"], grad[f"rec_{d}"] = d_in.T, d_rec
        return loss, grad

    def fit(self, x: np.ndarray, y: np.ndarray, p: Params) -> ByteGRU:
        """Adam over shuffled batches of runs x (runs, steps) with classes y; small samples take smaller batches, more passes."""
        rng = np.random.default_rng(p.seed)
        first = {n: np.zeros_like(w) for n, w in self.w.items()}
        second = {n: np.zeros_like(w) for n, w in self.w.items()}
        batch = min(p.batch, max(32, len(x) // 16))
        each = -(-len(x) // batch)
        passes = max(p.passes, -(-p.least_steps // each)) if each else 0
        total, step = passes * each, 0
        for _ in range(passes):
            order = rng.permutation(len(x))
            for at in range(0, len(x), batch):
                rows = order[at:at + batch]
                _, grad = self.gradients(np.ascontiguousarray(x[rows].T), y[rows])
                step += 1
                rate = p.rate * (1 - (step - 1) / total)
                for n, g in grad.items():
                    first[n] += 0.1 * (g - first[n])
                    second[n] += 0.01 * (g * g - second[n])
                    self.w[n] -= (rate * (first[n] / (1 - 0.9 ** step))
                                  / (np.sqrt(second[n] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
        return self


def _runs(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs (n, STEPS) of all texts, the text of each, and at which step its own positions begin."""
    length = np.diff(offs)
    count = -(-length // STEPS)
    text = np.repeat(np.arange(len(length)), count)
    k = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    start = np.minimum(k * STEPS, np.maximum(length[text] - STEPS, 0))
    at = (offs[:-1][text] + start)[:, None] + np.arange(STEPS)
    inside = at < offs[1:][text][:, None]
    x = np.where(inside, data[np.minimum(at, max(len(data) - 1, 0))], 0x20).astype(np.uint8) if len(text) else \
        np.zeros((0, STEPS), np.uint8)
    return x, text, k * STEPS - start


def _sample(langs: list[str], seed: int):
    """Texts of the training rows -> up to RUNS_PER_DOC runs of each, picked by the row's id."""
    index = {v: i for i, v in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lang = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for lo, hi, offs, data in text_slices(batch.column(1)):
                x, text, _ = _runs(data, offs)
                ends = np.searchsorted(text, np.arange(hi - lo + 1))
                rows = []
                for i in range(hi - lo):
                    rng = np.random.default_rng([seed, abs(ids[lo + i] or 0)])
                    n = ends[i + 1] - ends[i]
                    rows += [(i, ends[i] + j) for j in rng.permutation(n)[:RUNS_PER_DOC]]
                yield pa.RecordBatch.from_arrays([
                    pa.array([ids[lo + i] for i, _ in rows], pa.int64()),
                    pa.array([index[lang[lo + i]] for i, _ in rows], pa.int32()),
                    pa.array([x[j].tobytes() for _, j in rows], pa.binary())], ["doc_id", "y", "x"])

    return run


@dataclass
class Model:
    langs: list[str]
    net: ByteGRU | None


def train(docs: DataFrame, params: Params | None = None) -> Model:
    """Learn from the rows of ``docs`` (doc_id, text, lang) with a language and a letter.

    Languages are counted over all rows; of each, documents are drawn by a hash
    of the id, at most about ``docs_per_lang``, and a few runs of each document.
    """
    p = params or Params()
    rows = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(counts)
    if not langs:
        return Model([], None)
    scale = 1 << 30
    share = F.create_map(*[F.lit(v) for k in langs for v in (k, int(scale * min(1, p.docs_per_lang / counts[k])))])
    drawn = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(p.seed)), F.lit(scale)) < share[F.col("lang")])
    found = sorted(tuple(r) for r in drawn.mapInArrow(_sample(langs, p.seed), "doc_id long, y int, x binary").collect())
    x = np.frombuffer(b"".join(bytes(r[2]) for r in found), np.uint8).reshape(-1, STEPS)
    y = np.array([r[1] for r in found])
    return Model(langs, ByteGRU(p.hidden, len(langs), p.seed).fit(x, y, p))


def position_labels(model: Model, text: str) -> np.ndarray:
    """The language index at every byte of one text."""
    data = np.frombuffer(text.encode(), np.uint8)
    x, _, own = _runs(data, np.array([0, len(data)]))
    if not len(x):
        return np.zeros(0, int)
    best = model.net.probabilities(np.ascontiguousarray(x.T)).argmax(axis=1).T
    return np.concatenate([row[o:] for row, o in zip(best, own, strict=True)])[:len(data)]


def _score(m: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, offs, data in text_slices(batch.column(1)):
                x, text, own = _runs(data, offs)
                pooled = np.zeros((hi - lo, len(m.langs)))
                length = np.diff(offs)
                steps = np.arange(STEPS)[:, None]
                for at in range(0, len(x), WIDTH):
                    part = slice(at, at + WIDTH)
                    p = m.net.probabilities(np.ascontiguousarray(x[part].T))
                    if own[part].any() or (length[text[part]] < STEPS).any():
                        p *= ((steps >= own[part]) & (steps < length[text[part]]))[:, None, :] | (
                            (steps >= own[part]) & (length[text[part]] >= STEPS))[:, None, :]
                    sums = p.sum(axis=0, dtype=np.float64)
                    for c in range(len(m.langs)):
                        pooled[:, c] += np.bincount(text[part], sums[c], hi - lo)
                pooled /= np.maximum(length, 1)[:, None]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[lo:hi], batch.column(2)[lo:hi],
                    pa.array([m.langs[k] for k in pooled.argmax(axis=1)]), pa.array(np.clip(pooled.max(axis=1), 0, 1))],
                    ["doc_id", "letters", "lang_pred", "score"])

    return run


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score for every row; ``und`` with score 0 where the text is null or has no letter.

    Ties go to the language that sorts first. Without any training row all is ``und``.
    """
    rows = texts(docs)
    if model.net is None:
        return rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    scored = rows.select("doc_id", "text", F.col("text").rlike(r"\p{L}").alias("letters")).mapInArrow(
        _score(model), "doc_id long, letters boolean, lang_pred string, score double")
    return scored.select("doc_id", F.when(F.col("letters"), F.col("lang_pred")).otherwise("und").alias("lang_pred"),
                         F.when(F.col("letters"), F.col("score")).otherwise(0.0).alias("score"))


def held_out():
    """Rows that are never learned from."""
    return crc_mod("doc_id", 4) == 2


def identify(docs: DataFrame, params: Params | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learned from the rows that are not held out, given to all."""
    learn = docs.where(~F.coalesce(held_out(), F.lit(True)))
    found = predict(docs, train(learn, params))
    return found.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float = 0.3, params: Params | None = None) -> DataFrame:
    """The rows of ``docs`` whose language is found with a score of ``least`` or more.

    Where no row to learn from has a language there is no model, and only texts
    without letters go.
    """
    model = train(docs.where(~F.coalesce(held_out(), F.lit(True))), params)
    names = docs.columns
    text_, letters_ = fresh(docs, "_text"), fresh(docs, "_letters")
    if model.net is None:
        return docs.where(F.coalesce(F.col("text").cast("string"), F.lit("")).rlike(r"\p{L}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _score(model)
        for batch in batches:
            text = batch.column(batch.schema.names.index(text_))
            slim = pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(text))), text, batch.column(batch.schema.names.index(letters_))],
                ["doc_id", "text", "letters"])
            best = [b.column(3).to_numpy(zero_copy_only=False) for b in score([slim])]
            ok = (np.concatenate(best) >= least) if best else np.zeros(0, bool)
            kept = batch.filter(pa.array(ok)).filter(batch.filter(pa.array(ok)).column(
                batch.schema.names.index(letters_)))
            yield kept.select(names)

    plain = F.coalesce(F.col("text").cast("string"), F.lit(""))
    ready = docs.withColumns({text_: plain, letters_: plain.rlike(r"\p{L}")})
    return ready.mapInArrow(run, docs.schema)
