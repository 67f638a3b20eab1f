"""Connected components of a link table by alternating star contraction.

Every round replaces links by links to smaller neighbours (first among larger neighbours, then
among smaller ones), so components become stars after a number of rounds that grows with the
logarithm of their size, also for long chains. Before a round every task joins the links that it reads, at most
``AT_ONCE`` of them together, into stars of their own, so links that one task holds need no round. The rounds themselves use
grouped minima and joins on one key; no component is gathered in a task, and every round is written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from hourpanel.llm.text import map_batches
from hourpanel.session import materialise

AT_ONCE = 1 << 20  # links that a task joins together


def _stars_of(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    """(u, v) links from every node of the given links to the smallest node it reaches by them."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    parent = np.arange(len(nodes))
    while True:
        low, high = np.minimum(parent[a], parent[b]), np.maximum(parent[a], parent[b])
        apart = low < high
        if not apart.any():
            break
        np.minimum.at(parent, high[apart], low[apart])
        while (parent[parent] != parent).any():
            parent = parent[parent]
    inner = np.flatnonzero(parent != np.arange(len(nodes)))
    return pa.RecordBatch.from_arrays([pa.array(nodes[inner]), pa.array(nodes[parent[inner]])], ["u", "v"])


def _fold(at_once: int):
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append([batch.column(c).to_numpy() for c in ("u", "v")])
            size += batch.num_rows
            if size >= at_once:
                yield _stars_of(*(np.concatenate(x) for x in zip(*held, strict=True)))
                held, size = [], 0
        if size:
            yield _stars_of(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return work


def _written(links: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """The written links with their number and a sum over them, both taken while they are written."""
    seen = Observation()
    state = F.sum((F.xxhash64("u", "v") % 1_000_003).cast("long")).alias("s")
    stars = materialise(links.observe(seen, F.count(F.lit(1)).alias("n"), state), "stars")
    return stars, (seen.get["n"], seen.get["s"] or 0)


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    others = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(u, v) links of long node numbers -> (node, root) for every node that has a link; root is the smallest reachable node."""
    stars, before = _written(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    while before[0]:
        tasks = -(-before[0] // AT_ONCE)
        folded = map_batches(stars.coalesce(tasks), _fold(2 * AT_ONCE), "u long, v long")
        if tasks == 1:
            stars = materialise(folded, "stars")  # one task saw every link
            break
        folded = materialise(folded, "folded")
        larger = materialise(_large_star(folded), "larger")  # the small star reads it three times
        stars, after = _written(_small_star(larger))
        if after == before:
            break
        before = after
    roots = stars.select(F.col("v").alias("node")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))
