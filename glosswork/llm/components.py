"""Distributed connected components: alternating large-star and small-star rounds.

Each round is two joins on grouped minima; labels and links never leave the
executors. Partial aggregation and adaptive skew joins carry nodes with very many
links. A round is written to the shared folder, so a lost executor costs one
round. Rounds needed grow with the logarithm of the longest path.

Every round is a score of small stages, whose plans, tasks and broadcasts take the
driver's memory. So ``joined_components`` first lets each task contract the links it
holds to stars; only if stars of several tasks touch do rounds follow.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glosswork.llm.store import Scratch, ship_package

MAX_ROUNDS = 60
#: Links that a task contracts at once, which bounds its memory; so many go to each task.
CHUNK = 250_000


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m"))
    return both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("_m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("_m"))
    moved = down.join(least, "a").where(F.col("b") != F.col("_m")).select(F.col("b").alias("a"), F.col("_m").alias("b"))
    return moved.unionByName(least.select("a", F.col("_m").alias("b"))).distinct()


def connected_components(edges: DataFrame, scratch: Scratch, name: str = "cc", rows: int | None = None) -> DataFrame:
    """(node, component) of every node that occurs in ``edges`` (a long, b long); component is the smallest node reached.

    Loops, repeated links and nulls are allowed and link nothing. Without links the result is empty.
    ``rows``: the number of ``edges`` or a bound, if they are stored and free of loops and nulls; they are then read as they lie.
    """
    last = None
    if rows is None:
        last = f"{name}0"
        edges = scratch.write(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").distinct(), last)
        rows = edges.count()
    now, before = edges, None
    for k in range(1, MAX_ROUNDS):
        # A round turns a link into two at most.
        now = scratch.write(_small(_large(now)), f"{name}{k}", 2 * rows)
        if last:
            scratch.drop(last)
        last = f"{name}{k}"
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head()
        rows = state.n
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return _labels(now)


def _labels(stars: DataFrame) -> DataFrame:
    nodes = stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.unionByName(roots)


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node it reaches over the links) of each node that reaches a smaller one."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        x, y = root[x], root[y]
        apart = x != y
        if not apart.any():
            break
        x, y = x[apart], y[apart]
        # Each root with a smaller neighbour goes below the smallest: at most half of the roots stay.
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := root[root], root):
            root = up
    below = root != np.arange(len(nodes))
    return nodes[below], nodes[root[below]]


def _contract(chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for k in range(0, batch.num_rows, chunk):
                part = batch.slice(k, chunk)
                held.append((part.column(0).to_numpy(), part.column(1).to_numpy()))
                if sum(len(h[0]) for h in held) >= chunk:
                    held = [stars(*(np.concatenate(x) for x in zip(*held, strict=True)))]
                    if 2 * len(held[0][0]) > chunk:
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held.pop()], names=["a", "b"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in stars(*(np.concatenate(x) for x in zip(*held, strict=True)))], names=["a", "b"])

    return run


def joined_components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """As ``connected_components``, for stored ``edges``, which are read twice: once for their number."""
    ship_package(scratch.spark)
    links = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
    rows = links.count()
    forest = f"{name}_forest"
    found = scratch.write(links.coalesce(max(1, -(-rows // CHUNK))).mapInArrow(_contract(CHUNK), "a long, b long"), forest)
    # Each star's centre is its smallest node. Stars that do not touch are components.
    ends = found.select(F.col("a").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")).unionByName(found.select(F.col("b").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above")))
    if not ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above")).where("below + above > 1").limit(1).count():
        return _labels(found)
    out = connected_components(found, scratch, name, rows)
    scratch.drop(forest)
    return out
