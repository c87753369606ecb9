"""Line dedup: repeated runs of two lines or more are removed after their bytes have been compared.

A unit is two lines that are not blank and the blank ones between them, and
begins at every line that is not blank. Units whose hash occurs again anywhere,
in the same or another document, are compared by their bytes. The lines of a
unit go if it occurred before (at a lesser doc_id, then place). Since a
repeated run is made of repeated units, the whole run goes whatever lies around
it, and every line that goes has an equal one that stays. Blank lines alone are
no run: they go only between two lines that do.

Content-defined chunks (a second hash rolls over the last ``WINDOW`` line
hashes, and where it is divisible by ``DIVISOR`` a chunk ends) only count what
a text consists of and how many of its parts have gone altogether.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.tables import attach, materialize, texts
from loanloom.operators.joins import BROADCAST_ROWS

#: Lines that the rolling hash sees, and one cut in how many lines.
WINDOW = 2
DIVISOR = 3
#: A chunk has at least this many lines where the text has them.
LEAST = 2
_MASK = (1 << 64) - 1
_FACTOR = 0x9E3779B97F4A7C15


def chunk_lines(data: bytes) -> list[tuple[int, list[bytes]]]:
    """(first line, lines) of the chunks of a text; joined by newlines they are the text."""
    lines = data.split(b"\n")
    out, begin, rolled = [], 0, []
    for i, line in enumerate(lines):
        rolled = [*rolled, xxhash.xxh3_64_intdigest(line)][-WINDOW:]
        h = 0
        for v in rolled:
            h = (h * _FACTOR + v) & _MASK
        if i + 1 - begin >= LEAST and (h >> 20) % DIVISOR == 0:
            out.append((begin, lines[begin:i + 1]))
            begin = i + 1
    if begin < len(lines):
        out.append((begin, lines[begin:]))
    return out


def units(lines: list[bytes]) -> list[tuple[int, int]]:
    """(first, last) line of every unit; blank lines hold nothing but ASCII white space."""
    solid = [k for k, line in enumerate(lines) if line.strip()]
    return list(zip(solid, solid[1:], strict=False))


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) -> place and hash of each unit."""
    for batch in batches:
        docs, idx, fps = [], [], []

        def emit() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(idx, pa.int32()), pa.array(fps, pa.int64())], ["doc_id", "idx", "fp"])

        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            lines = text.as_buffer().to_pybytes().split(b"\n")
            h = [xxhash.xxh3_64_intdigest(line) for line in lines]
            for k, end in units(lines):
                docs.append(doc)
                idx.append(k)
                fps.append(((h[k] * _FACTOR + h[end] + (end - k)) & _MASK) - (1 << 63))
                if len(fps) >= EMIT_ROWS:
                    yield emit()
                    docs, idx, fps = [], [], []
        if fps:
            yield emit()


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, at) -> place and bytes of the units that begin at the lines ``at`` (null: of all units)."""
    for batch in batches:
        rows: list[tuple] = []
        size = 0

        def emit() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int32(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "idx", "pair"])

        for doc, text, at in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
            lines = text.as_buffer().to_pybytes().split(b"\n")
            ends = dict(units(lines))
            for k in ends if at is None else at:
                if k in ends:
                    rows.append((doc, k, b"\n".join(lines[k:ends[k] + 1])))
                    size += len(rows[-1][2])
                if size > 4 << 20 or len(rows) >= EMIT_ROWS:
                    yield emit()
                    rows, size = [], 0
        if rows:
            yield emit()


MARK = "doc_id long, idx int, fp long"
PAIR = "doc_id long, idx int, pair binary"
#: Line numbers in a table that is broadcast.
BROADCAST_PLACES = 1_000_000
#: Rows that a task hands on at a time.
EMIT_ROWS = 100_000


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, gone) -> counts and the text without the lines of the units that begin at the lines ``gone``."""
    for batch in batches:
        out = []
        for text, gone in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
            data = text.as_buffer().to_pybytes()
            chunks, lines = chunk_lines(data), data.split(b"\n")
            ends = dict(units(lines))
            lost = {k for g in gone or () for k in range(g, ends.get(g, g - 1) + 1)}
            left = b"\n".join(line for k, line in enumerate(lines) if k not in lost)
            whole = sum(all(k in lost for k in range(begin, begin + len(part))) for begin, part in chunks)
            out.append((len(lines) if data else 0, len(chunks) if data else 0, whole, len(lost), left.decode()))
        kinds = [pa.int64()] * 4 + [pa.string()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else [[]] * 5, kinds,
                                                               strict=True))],
            ["doc_id", "n_lines", "n_chunks", "n_removed_chunks", "n_removed_lines", "kept_text"])


def line_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_lines, n_chunks, n_removed_chunks, n_removed_lines, kept_text.

    Null and empty texts have no lines. Lines end at newlines only. Rows with a
    null doc_id come before all others in the choice of what stays, and stay
    whole. Rows that share doc_id and text are told apart by nothing: all of
    them keep or lose the same lines. ``n_chunks`` counts content-defined
    chunks, ``n_removed_chunks`` those that lost all of their lines. Blank lines
    at a text's ends, beside lines that stay, or of a text without others stay.
    """
    base = texts(docs)
    marks = materialize(base.mapInArrow(_marks, MARK))
    again = materialize(marks.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    suspects = attach(marks.where("doc_id is not null"), again, "fp").where("n is not null")
    at = materialize(suspects.groupBy("doc_id").agg(F.collect_set("idx").alias("at")))
    # the bytes of repeated hashes only; rows without a doc_id cannot be looked up and send all of theirs
    sent = _beside(base, at, "at").where("at is not null or doc_id is null")
    pairs = materialize(sent.mapInArrow(_pairs, PAIR).select(
        "doc_id", "idx", F.unhex(F.sha2("pair", 256)).alias("sha"), "pair"))
    place = F.struct("doc_id", "idx")
    # equal bytes meet before the shuffle
    first = materialize(pairs.groupBy("pair").agg(
        F.min(place).alias("first"), F.count(F.lit(1)).alias("n"), F.first("sha").alias("sha"))
        .where("n > 1").select("sha", "first"))
    lost = attach(pairs.select("doc_id", "idx", "sha").where("doc_id is not null"), first, "sha").where(
        F.col("first").isNotNull() & ~F.col("first").eqNullSafe(place))
    gone = materialize(lost.groupBy("doc_id").agg(F.collect_set("idx").alias("gone")))
    shape = "doc_id long, n_lines long, n_chunks long, n_removed_chunks long, n_removed_lines long, kept_text string"
    return _beside(base, gone, "gone").mapInArrow(_without, shape)


def _beside(base: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """doc_id, text and the array ``column`` of the written ``table`` (doc_id unique), null where it has none.

    A small table is broadcast; beside a large one the texts are shuffled once,
    but for those without a doc_id.
    """
    size = table.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size(column)).alias("m")).first()
    if size.n <= BROADCAST_ROWS and (size.m or 0) <= BROADCAST_PLACES:
        found = base.join(F.broadcast(table), "doc_id", "left")
    else:
        nameless = base.where("doc_id is null").withColumn(column, F.lit(None).cast("array<int>"))
        found = base.where("doc_id is not null").join(table.hint("merge"), "doc_id", "left").unionByName(nameless)
    return found.select("doc_id", "text", column)
