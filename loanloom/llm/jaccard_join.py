"""Exact n-gram Jaccard join for high thresholds: prefix lists, block skipping, answers taken from similar sets.

Sets of shingle hashes are ordered by a global order that puts rare shingles
first. Two sets that reach the threshold share a shingle among their first
``n - ceil(t n) + 1``, so only those enter the inverted lists.

* Index level. A list is sorted by set size; entries whose size or position
  cannot reach the threshold any more are skipped as a block. A parity sketch
  of 128 bits in each entry bounds the symmetric difference from below and
  skips what is left of unrelated partners. Both bounds are safe.
  Lists of very frequent shingles are dealt into blocks by a hash of the
  document; each pair of blocks is a list of its own, so no task gets them whole.
* Answer level. A set takes over the component of the set it is similar to:
  all partners inside that component count as answered, and only partners
  outside of it are looked at later. A pass over the long lists takes a bounded
  number of plausible partners of each entry; of many pairs the closest of each
  set are verified first. Lists in which an entry had more partners go through
  another pass that knows the components so far and takes ``MORE_PARTNERS``
  times as many, until no entry has any left: a group of m similar sets costs
  pairs in proportion to m where its sets do link, and no pair is left out.

The order of shingles comes from a sketch of counts of fixed size. It decides
how long lists are, never what is found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.bytewise import mix, shingle_sets, text_slices
from loanloom.llm.graph import components
from loanloom.llm.tables import attach, drop_ids, materialize, partitions, texts

#: log2 of the cells that count shingles; the table of their classes is broadcast (one byte a cell).
CELL_BITS = 20
#: Cells in a row of partial counts.
CELL_RUN = 4096
#: Lists of up to this many entries are joined at once; longer ones may take several passes.
SHORT_LIST = 8
#: Partners of an entry of a long list that a pass takes, as a multiple of those of the pass before (1 at first).
MORE_PARTNERS = 8
#: Rounds of a pass that verify only the closest partner of each set, while there are many pairs.
CLOSEST_ROUNDS = 2
#: Entries a list is meant to hold; longer ones are dealt into blocks, and every two blocks meet in a list of their own.
LIST_ROWS = 1000
_POP = np.array([bin(i).count("1") for i in range(1 << 16)], np.uint8)


def _required(num: int, den: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least intersection size for den * |a & b| >= num * |a | b|."""
    return -((-(a + b) * num) // (num + den))


def _sketch(s: np.ndarray) -> np.ndarray:
    """128 parity bits of a set, as eight 16-bit words."""
    bits = np.bincount((s >> np.uint64(20)).astype(np.int64) & 127, minlength=128) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.uint16)


def _profile(width: int):
    """Texts -> one row per document (kind 0: size, set key) and the partial counts of cells (kind 1)."""
    schema = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("n", pa.int64()), ("key", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << CELL_BITS, np.uint32)
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, offs, data in text_slices(batch.column(1)):
                sets = shingle_sets(data, offs, width)
                for s in sets:
                    np.add.at(cells, (s >> np.uint64(64 - CELL_BITS)).astype(np.int64), 1)
                keys = [np.array([s.sum(dtype=np.uint64), np.bitwise_xor.reduce(s * s) if len(s) else 0], np.uint64)
                        .tobytes() for s in sets]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.zeros(hi - lo, np.int32)), ids[lo:hi], pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(keys, pa.binary())], schema=schema)
        if cells.any():
            runs = cells.reshape(-1, CELL_RUN)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.ones(len(runs), np.int32)), pa.nulls(len(runs), pa.int64()),
                pa.array(np.arange(len(runs)), pa.int64()), pa.array([r.tobytes() for r in runs], pa.binary())],
                schema=schema)

    return run


def _sum_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts -> per run of cells the counts."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for r, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            c = np.frombuffer(b, np.uint32).astype(np.int64)
            sums[r] = sums[r] + c if r in sums else c
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int64()), pa.array([c.tobytes() for c in sums.values()], pa.binary())], ["run", "counts"])


def _dealt(tok: np.ndarray, m: np.ndarray, doc: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """List keys, positions and sides of one document's entries, those of long lists once for each pair of blocks.

    In the list of one block all pairs count (side -1), in that of two only pairs from different sides.
    """
    place = np.repeat(np.arange(len(tok)), m)
    own = (mix(np.full(1, doc, np.int64).view(np.uint64))[0] % m.astype(np.uint64)).astype(np.int64)[place]
    other = np.arange(len(place)) - np.repeat(np.cumsum(m) - m, m)
    pair = np.minimum(own, other) * (1 << 20) + np.maximum(own, other)
    split = m[place] > 1
    key = np.where(split, tok[place] ^ mix(pair.astype(np.uint64) + np.uint64(1)), tok[place])
    return key, place.astype(np.int32), np.where(split & (own != other), own, -1).astype(np.int32)


def _postings(width: int, num: int, den: int, classes):
    """Texts -> the prefix entries (tok, doc_id, size, pos, sketch, side) of one document per set and task."""
    schema = pa.schema([("tok", pa.int64()), ("doc_id", pa.int64()), ("size", pa.int32()), ("pos", pa.int32()),
                        ("sketch", pa.binary()), ("side", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, blocks = (np.frombuffer(x, t) for x, t in zip(classes.value, (np.uint8, np.int32), strict=True))
        seen: set[tuple[int, int, int]] = set()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for lo, _, offs, data in text_slices(batch.column(1)):
                cols: list[list] = [[], [], [], [], [], []]
                for i, s in enumerate(shingle_sets(data, offs, width)):
                    key = (len(s), int(s.sum(dtype=np.uint64)), int(np.bitwise_xor.reduce(s * s)) if len(s) else 0)
                    if not len(s) or ids[lo + i] is None or key in seen:
                        continue
                    seen.add(key)
                    n = len(s)
                    keep = n - (-(-num * n // den)) + 1
                    rank = (table[(s >> np.uint64(64 - CELL_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(56))
                    head = np.argsort(rank | (s >> np.uint64(8)), kind="stable")[:keep]
                    tok, pos, side = s[head], np.arange(keep, dtype=np.int32), np.full(keep, -1, np.int32)
                    m = blocks[(tok >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
                    if (m > 1).any():
                        tok, pos, side = _dealt(tok, m, ids[lo + i])
                    cols[0].append(tok.view(np.int64))
                    cols[1].append(np.full(len(tok), ids[lo + i], np.int64))
                    cols[2].append(np.full(len(tok), n, np.int32))
                    cols[3].append(pos)
                    cols[4].extend([_sketch(s).tobytes()] * len(tok))
                    cols[5].append(side)
                if cols[0]:
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(np.concatenate(c)) for c in cols[:4]), pa.array(cols[4], pa.binary()),
                         pa.array(np.concatenate(cols[5]))], schema=schema)

    return run


PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("tok", pa.int64()), ("size", pa.int32()),
                   ("pos", pa.int32()), ("sketch", pa.binary()), ("side", pa.int32())])
PAIR_ROWS = "a long, b long, tok long, size int, pos int, sketch binary, side int"


class _Lists:
    """Streams entries sorted by (tok, size, doc_id) and joins each list with itself.

    An entry of a long list takes up to ``limit`` later partners; lists in which
    that cut one short come out again, whole, as rows without b.
    """

    def __init__(self, num: int, den: int, labelled: bool, limit: int = 1):
        self.num, self.den, self.labelled, self.limit = num, den, labelled, limit

    def _join(self, tok, doc, size, pos, sketch, side, label, cut) -> Iterator[tuple[np.ndarray, ...]]:
        """Index pairs (i, j), i before j, that no bound rules out, and their sketch distances; sets ``cut``."""
        n = len(tok)
        last = np.searchsorted(tok, tok, "right")            # end of the own list
        begin = np.searchsorted(tok, tok, "left")
        length = last - begin
        open_list = length > 1
        if self.labelled:  # lists inside one component are answered
            heads = np.flatnonzero(begin == np.arange(n))
            mixed = np.minimum.reduceat(label, heads) != np.maximum.reduceat(label, heads)
            open_list &= np.repeat(mixed, np.diff(np.append(heads, n)))
        at = np.flatnonzero(open_list)
        long_, taken = length > SHORT_LIST, np.zeros(n, np.int64)
        step = 0
        while len(at):
            step += 1
            at = at[at + step < last[at]]
            j = at + step
            # sizes grow along a list: once a partner is too large, the rest of the list is skipped
            open_ = self.den * size[at] >= self.num * size[j]
            at, j = at[open_], j[open_]
            need = _required(self.num, self.den, size[at], size[j])
            ok = np.minimum(size[at] - pos[at], size[j] - pos[j]) >= need
            ok &= (side[at] != side[j]) | (side[at] < 0)
            if self.labelled:
                ok &= label[at] != label[j]
            i2, j2, need = at[ok], j[ok], need[ok]
            apart = _POP[sketch[i2] ^ sketch[j2]].sum(axis=1, dtype=np.int64)
            fit = apart <= size[i2] + size[j2] - 2 * need
            yield i2[fit], j2[fit], apart[fit]
            # an entry has one partner a step, so no index is twice in i2
            taken[i2[fit]] += 1
            stop = long_[at] & (taken[at] >= self.limit)
            cut[at[stop & (at + step + 1 < last[at])]] = True
            at = at[~stop]

    def _rows(self, tok, doc, size, pos, sketch, side, label) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        cut = np.zeros(len(tok), bool)
        for i, j, apart in self._join(tok, doc, size, pos, sketch, side, label, cut):
            new = {(min(x, y), max(x, y), d) for x, y, d in zip(doc[i].tolist(), doc[j].tolist(), apart.tolist(),
                                                                strict=True) if x != y} - seen
            if not new:
                continue
            if len(seen) < 200_000:  # the same pair meets in many lists; a later grouping takes the rest
                seen |= new
            a, b, d = zip(*new, strict=True)
            none = len(a)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.nulls(none, pa.int64()),
                 pa.array(d, pa.int32()), pa.nulls(none, pa.int32()), pa.nulls(none, pa.binary()),
                 pa.nulls(none, pa.int32())], schema=PAIRS)
        k = np.flatnonzero(np.isin(tok, tok[cut]))
        if len(k):
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[k]), pa.nulls(len(k), pa.int64()), pa.array(tok[k]), pa.array(size[k], pa.int32()),
                 pa.array(pos[k], pa.int32()), pa.array([x.tobytes() for x in sketch[k]], pa.binary()),
                 pa.array(side[k], pa.int32())], schema=PAIRS)

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            raw = b"".join(batch.column(4).to_pylist())
            part = (cols[0], cols[1], cols[2].astype(np.int64), cols[3].astype(np.int64),
                    np.frombuffer(raw, np.uint16).reshape(-1, 8), batch.column(5).to_numpy(),
                    batch.column(6).to_numpy() if self.labelled else cols[1])
            held.append(part)
            tok = part[0]
            if tok[0] == tok[-1] and len(held) > 1 and held[0][0][0] == tok[0]:
                continue  # one list goes on
            whole = tuple(np.concatenate(x) for x in zip(*held, strict=True))
            cut = int(np.searchsorted(whole[0], whole[0][-1], "left"))
            if cut:
                yield from self._rows(*(x[:cut] for x in whole))
            held = [tuple(x[cut:] for x in whole)]
        if held:
            yield from self._rows(*(np.concatenate(x) for x in zip(*held, strict=True)))


def _verify(width: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                both = b"".join((x.as_buffer(), y.as_buffer()))
                one, two = shingle_sets(np.frombuffer(both, np.uint8),
                                        np.array([0, len(x.as_buffer()), len(both)]), width)
                shared = len(one) + len(two) - len(np.union1d(one, two))
                ok.append(den * shared >= num * (len(one) + len(two) - shared))
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    return run


def _links(docs: DataFrame, pairs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that reach the threshold on the whole sets, which are made from the texts again.

    Texts travel instead of sets: they take less than half the room.
    """
    wanted = materialize(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
                         .withColumn("_in", F.lit(True)))
    rows = attach(docs, wanted, "doc_id").where("_in")
    side = lambda c: rows.select(F.col("doc_id").alias(c), F.col("text").alias(f"t{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ta", "tb")
    return materialize(both.mapInArrow(_verify(width, num, den), "a long, b long"))


def _nearest(pairs: DataFrame) -> DataFrame:
    """Of the pairs (a, b, apart) those that are some node's closest."""
    ends = pairs.select(F.col("a").alias("x"), F.col("b").alias("y"), "apart").unionByName(
        pairs.select(F.col("b").alias("x"), F.col("a").alias("y"), "apart"))
    best = ends.groupBy("x").agg(F.min(F.struct("apart", "y")).alias("m"))
    return best.select(F.least("x", "m.y").alias("a"), F.greatest("x", "m.y").alias("b")).distinct()


def jaccard_components(docs: DataFrame, width: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Two documents link when ``den * |A & B| >= num * |A | B|`` on their sets of
    distinct ``width``-word shingles (words lower-cased in A-Z, split at ASCII
    white space); a component is what links reach, named by its least doc_id.
    A text with fewer words has one shingle, its whole sequence; texts without
    words and null texts have none and stay alone. Rows with a null doc_id stay
    alone, too (component null). doc_id is taken to be unique.
    """
    spark = docs.sparkSession
    base = texts(docs)
    profile = materialize(base.mapInArrow(_profile(width), "kind int, doc_id long, n long, key binary"))
    ids = profile.where("kind = 0")
    runs = profile.where("kind = 1").select(F.col("n").alias("run"), "key")
    counts = np.zeros(1 << CELL_BITS, np.int64)
    for r in runs.repartition(partitions(spark), "run").mapInArrow(_sum_runs, "run long, counts binary").collect():
        counts[r.run * CELL_RUN:(r.run + 1) * CELL_RUN] = np.frombuffer(bytes(r.counts), np.int64)
    # what a cell has beyond the mean is taken for the length of one list
    mean = counts.mean()
    extra = counts - mean
    blocks = np.where(extra > max(LIST_ROWS, mean / 8), np.ceil(extra / LIST_ROWS), 1).astype(np.int32)
    classes = spark.sparkContext.broadcast(
        ((4 * np.log2(np.maximum(counts, 1))).astype(np.uint8).tobytes(), blocks.tobytes()))

    entries = base.mapInArrow(_postings(width, num, den, classes),
                              "tok long, doc_id long, size int, pos int, sketch binary, side int")
    n = partitions(spark, ids.count(), 20_000)
    first = materialize(
        entries.repartition(n, "tok").sortWithinPartitions("tok", "size", "doc_id").mapInArrow(
            _Lists(num, den, False), PAIR_ROWS))
    pairs = first.where("b is not null").select("a", "b", F.col("size").alias("apart"))

    # sets that are equal are one node, the least doc_id
    same = ids.where("n > 0 and doc_id is not null").groupBy("n", "key").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("_c")).where("_c > 1")
    same = materialize(same.select(F.concat(F.col("key"), F.col("n").cast("string").cast("binary")).alias("k"), "rep"))
    keyed = ids.withColumn("k", F.concat(F.col("key"), F.col("n").cast("string").cast("binary")))
    rep = materialize(attach(keyed, same, "k").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("rep")))
    of = rep.where("doc_id is not null and rep <> doc_id").select("doc_id", "rep")
    of = materialize(of)

    def by_rep(rows: DataFrame) -> DataFrame:
        for c in ("a", "b"):
            names = of.select(F.col("doc_id").alias(c), F.col("rep").alias("_r"))
            rows = attach(rows, names, c).withColumn(c, F.coalesce("_r", c)).drop("_r")
        return rows.where("a <> b").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(
            F.min("apart").alias("apart"))

    def outside(rows: DataFrame, comp: DataFrame) -> DataFrame:
        """The pairs whose ends are in different components."""
        for c in ("a", "b"):
            names = comp.select(F.col("node").alias(c), F.col("component").alias(f"l{c}"))
            rows = attach(rows, names, c).withColumn(f"l{c}", F.coalesce(f"l{c}", c))
        return rows.where("la <> lb").drop("la", "lb")

    # answers of a set are those of the component it has joined: only pairs that lead out of it are verified
    many = ids.count() // 4
    lists, limit = first.where("b is null"), 1
    open_ = by_rep(pairs)
    links = tried = spark.createDataFrame([], "a long, b long")
    comp = spark.createDataFrame([], "node long, component long")
    while True:
        for closest in range(CLOSEST_ROUNDS, -1, -1):
            open_ = materialize(outside(open_, comp).join(tried, ["a", "b"], "left_anti"))
            left = open_.count()
            if not left:
                break
            all_ = not closest or left <= many
            picked = materialize((open_ if all_ else _nearest(open_)).select("a", "b"))
            links = links.unionByName(_links(base, picked, width, num, den))
            tried = tried.unionByName(picked)
            comp = materialize(components(links))
            if all_:
                break
        if lists.isEmpty():
            break
        # the lists that are not done once more, with the components known
        limit *= MORE_PARTNERS
        labels = attach(rep.where("doc_id is not null").select("doc_id", F.col("rep").alias("node")), comp, "node")
        labels = materialize(labels.where("component is not null or node <> doc_id").select(
            "doc_id", F.coalesce("component", "node").alias("label")))
        entry = lists.select(F.col("a").alias("doc_id"), "tok", "size", "pos", "sketch", "side")
        marked = attach(entry, labels, "doc_id").select(
            "tok", "doc_id", "size", "pos", "sketch", "side", F.coalesce("label", "doc_id").alias("label"))
        found = materialize(marked.repartition(n, "tok").sortWithinPartitions("tok", "size", "doc_id").mapInArrow(
            _Lists(num, den, True, limit), PAIR_ROWS))
        lists = found.where("b is null")
        open_ = by_rep(found.where("b is not null").select("a", "b", F.col("size").alias("apart")))
    found = attach(rep.withColumnRenamed("rep", "node"), comp, "node")
    return found.select("doc_id", "n_shingles", F.coalesce("component", "node").alias("component_id"))


def keep_one_of_component(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` whose doc_id names its component: one document of each group."""
    found = jaccard_components(docs, width, num, den)
    return drop_ids(docs, found.where("component_id <> doc_id").select("doc_id").distinct())
