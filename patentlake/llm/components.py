"""Connected components of a link table, by stars across tasks and forests inside them."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from patentlake.llm._io import discard, written

LINKS = 1 << 20  # links that a task turns into a forest at a time


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the links (u, v) that isn't the least of its component, and that least node."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while True:
        ra, rb = root[a], root[b]
        if (ra == rb).all():
            break
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while (root[root] != root).any():
            root = root[root]
    below = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[below], nodes[root[below]]


def _forests(links: DataFrame) -> DataFrame:
    """links (u, v) as forests of at most LINKS rows; every task makes its own."""

    def flat(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        u, v = (np.concatenate([b.column(k).to_numpy() for b in batches]) for k in "uv")
        return pa.RecordBatch.from_arrays([pa.array(x) for x in forest(u, v)], names=["u", "v"])

    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in it:
            held.append(batch)
            n += batch.num_rows
            if n >= LINKS:
                yield flat(held)
                held, n = [], 0
        if held:
            yield flat(held)

    return links.select("u", "v").mapInArrow(run, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with a link, the component being the least node it reaches.

    edges: u and v, integers. Direction, repeats and links of a node to itself don't
    matter; links with a null end are left out. In every round the neighbours of a node are
    linked with the least of them and the node, and each task keeps a spanning forest of
    what it has. (From any node, least neighbours lead to a node that is the least of its
    own; its neighbours are linked with it and the others two steps on, so nothing comes
    apart.) Rounds are written tables; only whether one had anything to do reaches the driver.
    """
    proper = edges.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v")).where("u <> v")
    now = written(_forests(proper), "links")
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written, so that Spark can split the many links of one node at run time
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        # in stars, a node with a larger neighbour is the least one, and others have one neighbour
        unsettled = ((F.col("v") > F.col("u")) & (F.col("m") < F.col("u"))) | ((F.col("v") < F.col("u")) & (F.col("m") != F.col("v")))
        seen = Observation()
        met = both.join(least, "u").observe(seen, F.coalesce(F.sum(unsettled.cast("long")), F.lit(0)).alias("unsettled"))
        then, now = now, written(_forests(met.where("v <> m").select("v", F.col("m").alias("u"))), "links")
        discard(then, least)
        if not seen.get["unsettled"]:
            break
    # each node has one star, though several tasks may have written links of it
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
