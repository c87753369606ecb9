"""Connected components by rounds of contraction; no task or driver holds the whole graph."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.tables import attach, materialize, partitions

#: Nodes that a task keeps while it contracts its own edges; it then starts anew.
LOCAL_NODES = 300_000
#: Rounds go on while there are more edges than this; one task contracts the last ones.
LAST_EDGES = 100_000


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the edges of a task by stars that connect the same nodes."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (p := parent.setdefault(root, root)) != root:
            root = p
        while (p := parent[x]) != root:
            parent[x] = root
            x = p
        return root

    def stars() -> pa.RecordBatch:
        out = [(x, r) for x in list(parent) if (r := find(x)) != x]
        return pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in out], pa.int64()), pa.array([r for _, r in out], pa.int64())], ["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ra, rb = find(a), find(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
        if len(parent) > LOCAL_NODES:
            yield stars()
            parent.clear()
    yield stars()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): smallest node reachable, for every node of ``edges`` (a long, b long).

    Each round hooks every node to the neighbour of least hash if that is below
    its own, names the groups by it, and keeps the edges between groups; hashes
    make the number of groups fall geometrically on chains, too. Once no more
    than ``LAST_EDGES`` edges are left, a task contracts them.
    """
    n = partitions(edges.sparkSession)

    def contracted(rows: DataFrame) -> DataFrame:
        """Stars within tasks, then once more with all edges of a node in one task; stars name a node once a task."""
        stars = rows.mapInArrow(_contract, "a long, b long")
        return materialize(stars.repartition(n, "a").mapInArrow(_contract, "a long, b long"))

    e = contracted(edges.select("a", "b"))
    maps: list[DataFrame] = []
    while e.count() > LAST_EDGES:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = lambda c: F.struct(F.xxhash64(c), F.col(c))
        best = both.groupBy("a").agg(F.min(order("b")).alias("m")).select(
            F.col("a").alias("node"), F.when(F.col("m") < order("a"), F.col("m.b")).otherwise(F.col("a")).alias("label"))
        best = materialize(best)
        maps.append(best)
        named = lambda rows, c: attach(
            rows, best.select(F.col("node").alias(c), F.col("label").alias(f"l{c}")), c)
        groups = named(named(e, "a"), "b").select(F.col("la").alias("a"), F.col("lb").alias("b"))
        e = contracted(groups.where("a <> b"))
    stars = materialize(e.coalesce(1).mapInArrow(_contract, "node long, label long"))
    roots = stars.select(F.col("label").alias("node"), "label").distinct()
    maps.append(materialize(stars.unionByName(roots)))
    if len(maps) == 1:  # a star's centre is its least node
        return maps[0].withColumnRenamed("label", "component")
    found = maps[0]
    for m in maps[1:]:
        step = m.select(F.col("node").alias("label"), F.col("label").alias("next"))
        found = attach(found, step, "label").select("node", F.coalesce("next", "label").alias("label"))
    found = materialize(found)
    least = materialize(found.groupBy("label").agg(F.min("node").alias("component")))
    return attach(found, least, "label").select("node", "component")
