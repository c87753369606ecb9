"""Repair of the structure of conversations by one shortest path per conversation, with whole numbers as weights.

The roles of a repaired conversation read ``(s?(ua)+)?``, an automaton of four
states. The paths go from row to row and state to state; an edge keeps, re-roles
or deletes a row, after some insertions. Each edge has one whole number as
weight: its high digits are the cost, its low digits (base 5, one place per
letter of the audit, first letter highest, unused places zero at the end) are
the letters. The least sum therefore is the cheapest path, and among equally
cheap ones that with the least audit, by plain comparison of integers.

Insertions come before the row they precede, so that each row ends with a
letter of its own and no audit up to a row is the beginning of another one: a
comparison of two paths up to a row cannot be reversed later. Rows are read in
order. As soon as the best paths of all states agree on their first letters,
these are final: their rows go into the hash and leave memory. What a task holds
is the window that is still open and the audit itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.tables import materialize, partitions
from loanloom.operators.joins import lookup

#: Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Letters of the audit in ASCII order; their digits are 1 to 4, 0 is padding.
LETTERS = "DIKR"
BASE = len(LETTERS) + 1
#: State -> initial -> state. 0: nothing yet, 1: after the system turn, 2: after a user turn, 3: after an assistant turn.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ACCEPT = (0, 3)
FULL = {"u": "user", "a": "assistant"}
#: Rows between two looks for letters that are final.
LOOK = 32
GAPLESS = frozenset(("su", "ua", "au"))
SCHEMA = pa.schema([
    ("conv_id", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
    ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])


def _insertions(state: int) -> list[tuple[int, int]]:
    """(insertions, state after them), the least number for each state that can be reached."""
    out, seen = [(0, state)], {state}
    while True:
        role = "a" if out[-1][1] == 2 else "u"
        after = NEXT[out[-1][1]][role]
        if after in seen:
            return out
        seen.add(after)
        out.append((out[-1][0] + 1, after))


INSERTIONS = [_insertions(s) for s in range(4)]
#: (state, other, most): whatever a path from ``other`` goes on to do, one from ``state`` can do for ``most`` more, by deleting
#: what does not fit or adding what lacks at the end.
BETTER = ((3, 1, 0), (3, 0, 2), (3, 2, 2), (0, 1, 0), (0, 3, 0), (0, 2, 2), (2, 3, 5), (2, 1, 5), (2, 0, 5))
_POWERS = [1]


def _power(n: int) -> int:
    """BASE ** n, kept."""
    while len(_POWERS) <= n:
        _POWERS.append(_POWERS[-1] * BASE)
    return _POWERS[n]


class _Path:
    """The open window of one conversation: best weight and number of letters of each state."""

    def __init__(self) -> None:
        self.width = 4 * LOOK
        self.best: dict[int, tuple[int, int]] = {0: (0, 0)}
        self.start = 0
        self.audit: list[str] = []
        self.digest = hashlib.sha256()
        self.n_out = 0
        self.rows: list[tuple[str, str]] = []

    def _widen(self) -> None:
        """More places at the end: all weights are multiplied alike."""
        more = self.width
        self.best = {s: (w * _power(more), n) for s, (w, n) in self.best.items()}
        self.width += more

    def _insert_weight(self, place: int, n: int) -> int:
        weight = 0
        for i in range(n):
            weight += INSERT * _power(self.width) + 2 * _power(self.width - 1 - place - i)
        return weight

    def step(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        """One more row."""
        if max(n for _, n in self.best.values()) + 4 > self.width:
            self._widen()
        unit = _power(self.width)
        dear = TRUNCATED if truncated and not must_go else 0
        new: dict[int, tuple[int, int]] = {}
        for state, (weight, place) in self.best.items():
            for n, after in INSERTIONS[state]:
                base = weight + (self._insert_weight(place, n) if n else 0)
                at = place + n
                digit = _power(self.width - 1 - at)
                edges = [(after, DELETE * unit + digit)]
                if not must_go:
                    if role[:1] in NEXT[after]:
                        edges.append((NEXT[after][role[:1]], dear * unit + 3 * digit))
                    for initial in ("u", "a"):
                        if initial in NEXT[after]:
                            edges.append((NEXT[after][initial], (REROLE + dear) * unit + 4 * digit))
                for to, more in edges:
                    if to not in new or base + more < new[to][0]:
                        new[to] = (base + more, at + 1)
        for state, other, most in BETTER:
            if state in new and other in new and new[other][0] >= new[state][0] + (most + 1) * unit:
                del new[other]
        self.best = new
        self.rows.append((role, text))
        if len(self.rows) % LOOK == 0:
            self._settle()

    def _letters(self, weight: int, n: int) -> str:
        low = weight % _power(self.width) // _power(self.width - n)
        out = []
        for _ in range(n):
            low, digit = divmod(low, BASE)
            out.append(LETTERS[digit - 1])
        return "".join(reversed(out))

    def _emit(self, letters: str) -> None:
        """Letters that are final, up to a row: their rows are repaired and hashed."""
        used = 0
        for letter in letters:
            if letter == "I":
                initial = "a" if self.start == 2 else "u"
                line = FULL[initial] + ":"
            else:
                role, text = self.rows[used]
                used += 1
                if letter == "D":
                    continue
                initial = role[:1] if letter == "K" else "a" if self.start == 2 else "u"
                line = f"{role if letter == 'K' else FULL[initial]}:{text}"
            self.start = NEXT[self.start][initial]
            self.digest.update(("\n" if self.n_out else "").encode() + line.encode("utf-8", "surrogatepass"))
            self.n_out += 1
        self.audit.append(letters)
        del self.rows[:used]

    def _settle(self) -> None:
        """Take the letters on which the best paths of all states agree out of the window."""
        paths = {s: self._letters(w, n) for s, (w, n) in self.best.items()}
        one, two = min(paths.values()), max(paths.values())
        same = 0
        while same < min(len(one), len(two)) and one[same] == two[same]:
            same += 1
        while same and one[same - 1] == "I":
            same -= 1
        if not same:
            return
        self._emit(one[:same])
        shift = _power(same)
        unit = _power(self.width)
        self.best = {s: (w // unit * unit + w % unit * shift % unit, n - same) for s, (w, n) in self.best.items()}

    def finish(self) -> tuple[int, str, str]:
        """(cost, audit, hash): the least whole path to a state where a conversation may end."""
        if max(n for _, n in self.best.values()) + 4 > self.width:
            self._widen()
        ends = [(weight + self._insert_weight(place, n), place + n) for state, (weight, place) in self.best.items()
                for n, after in INSERTIONS[state] if after in ACCEPT]
        weight, n = min(ends)
        self._emit(self._letters(weight, n))
        return weight // _power(self.width), "".join(self.audit), self.digest.hexdigest()


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and turn -> one row per conversation."""
    out: list[tuple] = []
    conv, state = None, None
    for batch in batches:
        for row in batch.to_pylist():
            if state is None or row["conv_id"] != conv:
                if state is not None:
                    out.append((conv, *state.result()))
                conv, state = row["conv_id"], _Conversation()
                if len(out) >= 4096:
                    yield _rows(out)
                    out = []
            state.add(row)
    if state is not None:
        out.append((conv, *state.result()))
    yield _rows(out)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(SCHEMA)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SCHEMA, strict=True)], schema=SCHEMA)


class _Conversation:
    """Counts and path of one conversation, row by row."""

    def __init__(self) -> None:
        self.path = _Path()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turns = 0
        self.least = self.most = None
        self.last: tuple | None = None

    def add(self, row: dict) -> None:
        if row["fate"] == 0:
            return
        turn, role, text, mark = row["turn"], row["role"], row["text"], row["mark"]
        if turn is not None:
            if self.least is None:
                self.least = turn
            if self.most is None or turn != self.most:
                self.turns += 1
            self.most = turn
        if self.last is not None and self.last[2][:1] + role[:1] not in GAPLESS:
            self.illegal += 1
        again = row["seen"] and (turn != row["first_turn"] or (self.last is not None and self.last[:2] == (turn, mark)))
        blank, cut = row["blank"], row["cut"]
        self.blank += blank
        self.duplicate += again and not blank
        self.truncated += cut and not blank and not again
        self.path.step(role, text, blank or again, cut)
        self.last = (turn, mark, role)

    def result(self) -> tuple:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal, *self.path.finish())


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, fate of rows after damage; dropped rows stay, with fate 0, so that no conversation is lost.

    The remainder by 20 of crc32 of ``conv_id:turn`` decides: 0 drops a row, 1
    empties its text, 2 takes ``.``, ``!`` and ``?`` out of it, 3 repeats it, 4
    makes its role ``user``. Nulls in ``conv_id:turn``, role and text count as
    one space.
    """
    def shown(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fate = F.pmod(F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")), F.lit(20))
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))
    shaped = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), shown("role").alias("role"),
        shown("text").alias("text"), fate.cast("int").alias("fate"))
    times = F.explode(F.sequence(F.lit(1), F.when(F.col("fate") == 3, 2).otherwise(1)))
    return shaped.select("conv_id", "turn", role.alias("role"), text.alias("text"), "fate", times.alias("_time")).drop("_time")


def repair(rows: DataFrame) -> DataFrame:
    """One row per conv_id of ``rows`` (already damaged, with ``fate``): faults, cost, audit and hash of the repaired text.

    Rows of a conversation are taken by turn (nulls first), equal turns by role
    and text. blank: no character but white space; duplicate: role and text
    seen earlier; truncated: the last character that is not white space is
    none of ``.!?``; the first fault of a row counts. Kept rows with another
    initial than s, u, a must be re-roled or deleted. Rows of a null conv_id
    are one conversation. A conversation whose rows are all dropped gets zeros,
    an empty audit and the hash of the empty string; an empty table gives no row.

    Memory of a task: the open window of a conversation, and its audit, which
    is one value of the result. Its rows are sorted by Spark, outside memory if
    need be; one conversation is read by one task, since its hash is one chain.
    """
    spark = rows.sparkSession
    n = partitions(spark)
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    mark = F.md5(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("-")), F.length("role").cast("string"), "role",
                             "text"))
    flagged = rows.select("conv_id", "turn", "role", "text", "fate", mark.alias("mark"), (last == "").alias("blank"),
                          ((last != "") & ~last.isin(".", "!", "?")).alias("cut"))
    # the first turn of what a conversation holds more than once; nulls are first
    order = F.when(F.col("turn").isNull(), F.struct(F.lit(0).alias("known"), F.lit(0).cast("long").alias("turn"))).otherwise(
        F.struct(F.lit(1).alias("known"), F.col("turn").alias("turn")))
    repeated = materialize(
        flagged.where("fate <> 0").groupBy("mark").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
        .where("n > 1").select("mark", "n", F.lit(True).alias("seen"),
                               F.when(F.col("first.known") == 1, F.col("first.turn")).alias("first_turn")))
    known = lookup(flagged, repeated, ["mark"], repeated.count(), "n", total=None)
    ready = known.select("conv_id", "turn", "role", "text", "fate", "mark", "blank", "cut",
                         F.coalesce("seen", F.lit(False)).alias("seen"), "first_turn")
    return (ready.repartition(n, "conv_id")
            .sortWithinPartitions(F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text")
            .mapInArrow(_repair, "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
                                 "audit string, repaired_sha256 string"))
