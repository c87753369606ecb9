"""Mixing sources to target weights: budgets flow down a domain-language-source tree, documents fill the leaves.

A parent's budget is shared by its children's weights. A child that cannot use
its share (its whole subtree has fewer tokens) gets what it has, and the rest
goes to its siblings by their weights; only what all siblings together cannot
take stays with the parent, whose own siblings have then been given more to
begin with. This is the fixed point of handing shortages to siblings first and
to ancestors after them, and is reached in one pass downwards, since the
capacity of every subtree is known beforehand.

A leaf's documents are walked in epochs, each in an order of its own that
depends on the seed, and taken while their tokens fit the leaf's budget.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanloom.llm.tables import fresh, materialize
from loanloom.operators.joins import lookup

#: Documents that a slice of a leaf's order is sized for.
SLICE_DOCS = 2000


@dataclass
class MixPlan:
    """What to draw: ``fraction`` of all tokens, each document at most ``epochs`` times.

    ``weights`` maps a tree path ``(domain,)``, ``(domain, lang)`` or
    ``(domain, lang, source)`` to its weight among its siblings; a path that is
    not named weighs ``default_weight``. ``domain`` is an SQL expression.
    """

    fraction: float = 0.8
    epochs: int = 2
    seed: int = 42
    domain: str = "concat('d', cast(crc32(cast(coalesce(source, '') as binary)) % 3 as string))"
    default_weight: float = 1.0
    weights: dict[tuple[str, ...], float] = field(default_factory=dict)


LEVELS = ["domain", "lang", "source"]
_KEYS = [f"_k{i}" for i in range(3)]


def _leveled(docs: DataFrame, plan: MixPlan) -> DataFrame:
    """``docs`` with its three tree keys (null: empty) and its number of words, ``_tok``."""
    plain = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # the words of a text are the places where a word begins
    words = F.regexp_count(plain, F.lit(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]"))
    own = {"_k0": F.coalesce(F.expr(plan.domain), F.lit("")), "_k1": F.coalesce(F.col("lang").cast("string"), F.lit("")),
           "_k2": F.coalesce(F.col("source").cast("string"), F.lit(""))}
    return docs.withColumns(own | {"_tok": words.cast("long")})


def _weight(plan: MixPlan, depth: int):
    named = [(k, v) for k, v in sorted(plan.weights.items()) if len(k) == depth + 1]
    out = F.lit(float(plan.default_weight))
    for path, value in named:
        same = F.lit(True)
        for key, part in zip(_KEYS, path, strict=False):
            same = same & (F.col(key) == F.lit(part))
        out = F.when(same, F.lit(float(value))).otherwise(out)
    return out


def _share(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """``budget`` of siblings from ``above`` (their parent's), ``w`` and ``cap``: filled up in the order of cap / w.

    With siblings sorted by how early their share outgrows their capacity, the
    first ones get all they can take and the others the rest by weight. A
    sibling of weight 0 gets nothing.
    """
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = by.orderBy(F.when(F.col("w") > 0, F.col("cap") / F.col("w")), *[k for k in _KEYS if k in nodes.columns])
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    rows = nodes.where("w > 0").withColumns({
        "_taken": F.coalesce(F.sum("cap").over(before), F.lit(0)), "_rest": F.sum("w").over(after)})
    rows = rows.withColumn("_fair", (F.col("above") - F.col("_taken")) * F.col("w") / F.col("_rest"))
    # once one sibling is not filled, none after it is: all of them share what was left then
    short = F.col("cap") > F.col("_fair")
    level = F.first(F.when(short, F.col("_fair") / F.col("w")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = rows.withColumn("_level", level)
    budget = F.when(F.col("_level").isNull(), F.col("cap").cast("double")).otherwise(
        F.least(F.col("cap").cast("double"), F.col("_level") * F.col("w")))
    return rows.withColumn("budget", F.greatest(budget, F.lit(0.0))).drop("_taken", "_rest", "_fair", "_level")


def budgets(leaves: DataFrame, plan: MixPlan) -> DataFrame:
    """(keys, docs, tokens, cap, weight, budget long) of every leaf from (keys, docs, tokens)."""
    leaves = leaves.withColumn("cap", F.col("tokens") * F.lit(plan.epochs))
    total = leaves.agg(F.sum("tokens").alias("t")).withColumn("above", F.floor(F.col("t") * F.lit(plan.fraction))
                                                              .cast("double")).select("above")
    above, parent = total, []
    for depth in range(3):
        keys = _KEYS[:depth + 1]
        nodes = leaves.groupBy(*keys).agg(F.sum("cap").alias("cap")).withColumn("w", _weight(plan, depth))
        # one row at the root; below it, equal keys
        nodes = nodes.join(above, parent) if parent else nodes.join(F.broadcast(above), F.lit(True))
        shared = _share(nodes, parent)
        above, parent = shared.select(*keys, F.col("budget").alias("above")), keys
    own = shared.select(*_KEYS, F.col("w").alias("weight"), F.floor("budget").cast("long").alias("budget"))
    return leaves.join(own, _KEYS, "left").fillna({"weight": 0.0, "budget": 0})


def mix(docs: DataFrame, plan: MixPlan | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents with ``_copies``, leaves): how often each row is drawn, and every leaf's budget and yield.

    A leaf with a budget of at least its tokens gives every document once for
    each whole epoch; of the epoch that follows, the documents in seeded order
    are taken as long as their running total of tokens does not exceed what is
    left. Texts without words cost nothing and go with the place they stand at.
    """
    plan = plan or MixPlan()
    rows = materialize(_leveled(docs, plan).select("doc_id", "_tok", *_KEYS))
    leaves = materialize(rows.groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("docs"), F.sum("_tok").alias("tokens")))
    tree = budgets(leaves, plan)
    whole = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).cast("int")
    tree = materialize(tree.withColumn("epochs", whole).withColumn(
        "left", F.col("budget") - F.col("epochs") * F.col("tokens"))
        .withColumn("slices", F.ceil(F.col("docs") / F.lit(SLICE_DOCS)).cast("int")))
    slim = tree.select(*_KEYS, "epochs", "left", "slices", F.lit(1).alias("_w"))
    n = slim.count()
    # leaves are as many as sources; docs per leaf are skewed, so a large tree is joined with hot keys spread
    if n > 50_000:
        slim = slim.drop("_w").join(leaves.select(*_KEYS, F.col("docs").alias("_w")), _KEYS)
    at = lookup(rows, slim, _KEYS, n, "_w", limit=50_000)
    seeded = F.xxhash64(F.lit(plan.seed), F.col("epochs"), F.col("doc_id"), F.col("_tok"))
    share = (F.shiftrightunsigned(seeded, 11).cast("double") / F.lit(float(1 << 53)))
    at = at.withColumns({"_h": seeded, "_u": share}).withColumn(
        "_slice", F.least(F.floor(F.col("_u") * F.col("slices")), F.col("slices") - 1).cast("int"))
    # running totals: sums of earlier slices, and a window inside a slice
    sums = materialize(at.groupBy(*_KEYS, "_slice").agg(F.sum("_tok").alias("t")))
    ordered = Window.partitionBy(*_KEYS).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("_before", F.coalesce(F.sum("t").over(ordered), F.lit(0))).drop("t")
    inside = Window.partitionBy(*_KEYS, "_slice").orderBy("_u", "_h", "doc_id").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    key = [*_KEYS, "_slice"]
    slim_rows = at.select("doc_id", "_tok", "_u", "_h", "left", "epochs", *key)
    run = slim_rows.withColumn("_run", F.sum("_tok").over(inside)).join(starts, key)
    copies = F.col("epochs") + (F.col("_before") + F.col("_run") <= F.col("left")).cast("int")
    drawn = run.select("doc_id", *_KEYS, "_tok", copies.alias("copies"))
    return drawn, tree


def mixed_documents(docs: DataFrame, plan: MixPlan | None = None) -> DataFrame:
    """The columns of ``docs``, a row as often as it is drawn. Rows that share a doc_id are drawn alike."""
    drawn, _ = mix(docs, plan)
    times, again, key = fresh(docs, "_times"), fresh(docs, "_again"), fresh(docs, "_id")
    kept = drawn.groupBy(F.col("doc_id").alias(key)).agg(F.max("copies").alias(times)).where(F.col(times) > 0)
    back = docs.join(kept, F.col("doc_id").eqNullSafe(F.col(key)))
    return back.withColumn(again, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns)


def report(docs: DataFrame, plan: MixPlan | None = None) -> DataFrame:
    """One row per document: doc_id, domain, lang, source, n_tokens, copies."""
    drawn, _ = mix(docs, plan)
    return drawn.select("doc_id", *[F.col(k).alias(n) for k, n in zip(_KEYS, LEVELS, strict=True)],
                        F.col("_tok").alias("n_tokens"), "copies")
