"""Exact nearest neighbours by a block matrix join with int8 tiles.

Vectors are scaled to length 1 and rounded once to int8 with a scale of their own. Queries and
candidates are cut into blocks; every pair of blocks is one tile, which gets codes, scales and
rounding residuals, an eighth of the vectors' size. The tile's product of int8 codes (summed exactly:
integers below 2**24 in float32 matrix products over at most ``CHUNK_DIMS`` dimensions) gives each
cosine up to a bound from the two residuals. A pair survives if its upper bound reaches the k-th
best lower bound of its query, first in the tile, then over all tiles. Survivors meet their original
vectors, are recomputed in double precision, and pass through a heap for each query.

A query in a cluster of nearly equal vectors has many survivors, for the bounds cannot tell them apart. Those
beyond the ``HOT`` best of a tile are dealt over ``PARTS`` parts, each with copies of the tile's k best so that
bounds of other tiles still prune there. Each part meets its own copy of the query's vector and has its own heap,
and the heaps of a query are merged. The pairs that survive, without vectors, are written to the shared folder.

Defined results
* null vectors, vectors of length 0, of another dimension than the most frequent one (the smaller of
  equally frequent ones), or with null or non-finite components take no part;
* null ids take no part; a row is never its own neighbour: candidates that carry the query's
  id are left out;
* rows that repeat a query's id share one list, in which a candidate row has the larger of its scores;
  candidate rows that repeat an id, or are equal, are candidates each;
* ties go to the smaller id; fewer than k candidates give fewer rows; no rows give no rows;
* only the id and vector columns are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glosswork.llm.store import Scratch, ship_package

#: Rows in a block of queries and of candidates, on average.
QUERY_BLOCK, CANDIDATE_BLOCK = 2048, 16384
#: 127 * 127 * 1024 < 2**24
CHUNK_DIMS = 1024
#: Survivors of a query in a tile that stay together, and parts over which the others are dealt.
HOT, PARTS = 64, 16
#: Slack on the bounds for the rounding of the bounds themselves.
SLACK = 1e-6


def cosines(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Row by row, summed in the order of the dimensions, so that equal vectors get equal scores."""
    dot, qq, cc = np.zeros(len(q)), np.zeros(len(q)), np.zeros(len(q))
    for k in range(q.shape[1]):
        x, y = q[:, k], c[:, k]
        dot += x * y
        qq += x * x
        cc += y * y
    return dot / (np.sqrt(qq) * np.sqrt(cc))


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(int8 codes, scales, lengths of the residuals) of unit vectors."""
    unit = x / np.abs(x).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    scale = np.abs(unit).max(axis=1) / 127.0
    code = np.rint(unit / scale[:, None]).astype(np.int8)
    return code, scale, np.linalg.norm(unit - code * scale[:, None], axis=1)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = None
    for k in range(0, a.shape[1], CHUNK_DIMS):
        part = a[:, k : k + CHUNK_DIMS].astype(np.float32) @ b[:, k : k + CHUNK_DIMS].astype(np.float32).T
        out = part if out is None else out.astype(np.float64) + part
    return out


Side = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def tile(queries: Side, candidates: Side, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Positions of pairs (query, candidate) that can be among a query's k nearest in this tile, with the bounds of their cosines.

    A side is (ids, row hashes, codes, scales, residuals).
    """
    qid, _, qc, qs, qr = queries
    cid, _, cc, cs, cr = candidates
    near = _product(qc, cc) * qs[:, None] * cs[None, :]
    # x.y - x'.y' = x.(y - y') + (x - x').y', with |x| = 1 and |y'| <= 1 + its residual
    error = cr[None, :] + qr[:, None] * (1.0 + cr[None, :]) + SLACK
    low = near - error
    low[qid[:, None] == cid[None, :]] = -np.inf
    least = np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k] if low.shape[1] > k else np.full(len(low), -np.inf)
    i, j = np.nonzero((near + error >= least[:, None]) & (low > -np.inf))
    return i, j, low[i, j], (near + error)[i, j]


def _codes(dims: int):
    """(id, row, asked, v, hash of v) to (id, row, asked, code, scale, residual, hash of v)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                code, scale, residual = quantise(batch.column(3).flatten().to_numpy().reshape(-1, dims).astype(np.float64))
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([c.tobytes() for c in code], pa.binary()), pa.array(scale), pa.array(residual), batch.column(4)], names=["id", "row", "asked", "code", "scale", "residual", "vector"])

    return run


PAIRS = "query_id long, query_row long, vec_id long, vec_row long, low double, high double, part int"


def deal(i: np.ndarray, row: np.ndarray, low: np.ndarray, k: int, hot: int = HOT, parts: int = PARTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions of pairs, parts, whether it is a copy that only bounds others) of a tile's pairs, ``i`` being their queries.

    Part 0 has a query's ``hot`` pairs of the largest lower bounds; each other part that has pairs gets copies of the first k.
    """
    order = np.lexsort((-low, i))
    own = i[order]
    first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(first, len(own)))
    place = np.arange(len(own)) - np.repeat(first, sizes)
    part = np.where(place < hot, 0, 1 + row[order] % parts).astype(np.int32)
    at, dealt, copy = [order], [part], [np.zeros(len(order), bool)]
    for a, n in zip(first[sizes > hot], sizes[sizes > hot], strict=True):
        others = np.unique(part[a + hot : a + n])
        best = order[a : a + min(k, hot)]
        at.append(np.tile(best, len(others)))
        dealt.append(np.repeat(others, len(best)))
        copy.append(np.ones(len(best) * len(others), bool))
    return np.concatenate(at), np.concatenate(dealt), np.concatenate(copy)


def _tiles(k: int, dims: int, hot: int, parts_of: int):
    """Rows sorted by (qb, cb, side): the queries of a tile come first, then its candidates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts = None, ([], [])

        def close():
            if all(parts):
                sides = [tuple(np.concatenate(x) for x in zip(*p, strict=True)) for p in parts]
                # Equal rows lie in one block, so each comes once.
                q, c = (tuple(x[np.unique(side[1], return_index=True)[1]] for x in side) for side in sides)
                # Of candidates with one vector only the k + 1 smallest ids can be among a query's k nearest, its own left out.
                order = np.lexsort((c[0], c[5]))
                first = np.r_[True, c[5][order][1:] != c[5][order][:-1]]
                place = np.arange(len(order)) - np.flatnonzero(first)[np.cumsum(first) - 1]
                c = tuple(x[order[place <= k]] for x in c)
                for a in range(0, len(q[0]), 512):
                    some = tuple(x[a : a + 512] for x in q)
                    i, j, low, high = tile(some[:5], c[:5], k)
                    if len(i):
                        at, part, copy = deal(i, c[1][j], low, k, hot, parts_of)
                        i, j, low, high = i[at], j[at], low[at], np.where(copy, np.nan, high[at])
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (some[0][i], some[1][i], c[0][j], c[1][j], low, high, part)], names=["query_id", "query_row", "vec_id", "vec_row", "low", "high", "part"])

        for batch in batches:
            if not batch.num_rows:
                continue
            qb, cb, side, ids, rows = (batch.column(i).to_numpy() for i in range(5))
            codes = np.frombuffer(b"".join(batch.column(5).to_pylist()), np.int8).reshape(-1, dims)
            scale, residual, vectors = (batch.column(i).to_numpy() for i in (6, 7, 8))
            cut = np.flatnonzero((qb[1:] != qb[:-1]) | (cb[1:] != cb[:-1]) | (side[1:] != side[:-1])) + 1
            for a, b in zip([0, *cut], [*cut, len(qb)], strict=True):
                if key != (qb[a], cb[a]):
                    yield from close()
                    key, parts = (qb[a], cb[a]), ([], [])
                parts[side[a]].append(tuple(x[a:b].copy() for x in (ids, rows, codes, scale, residual, vectors)))
        yield from close()

    return run


def _prune(k: int):
    """Pairs sorted by (query_id, part, low descending): those that reach the k-th best lower bound of their query over all tiles. Copies have no upper bound and go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query, best, least = None, set(), -np.inf
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for n, (q, row, low, high, part) in enumerate(zip(*(batch.column(i).to_pylist() for i in (0, 3, 4, 5, 6)), strict=True)):
                if (q, part) != query:
                    query, best, least = (q, part), set(), -np.inf
                if len(best) < k:
                    best.add(row)
                    least = low if len(best) == k else least
                keep[n] = high >= least
            yield batch.filter(pa.array(keep))

    return run


def _scored(dims: int):
    """(query_id, part, vec_id, vec_row, times, query vector, candidate vector) with the cosine instead of the vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                q, c = (batch.column(i).flatten().to_numpy().reshape(-1, dims).astype(np.float64) for i in (5, 6))
                yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(cosines(q, c))], names=["query_id", "part", "vec_id", "vec_row", "times", "score"])

    return run


SCORED = "query_id long, part int, vec_id long, vec_row long, times long, score double"
NEAREST = "query_id long, rank int, vec_id long, score double"


def _heaps(k: int, last: bool):
    """Scored pairs sorted by (query_id, part, vec_row, score descending) to the k best of each part or, in the last step, which has one part, of each query in order."""
    types = (pa.int64(), pa.int32(), pa.int64(), pa.float64()) if last else (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
    names = [x.split()[0] for x in (NEAREST if last else SCORED).split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, met, heap = (None, None), None, []
        out: list[tuple] = []

        def close():
            if last:
                ranked = [(-c, s) for s, c, times, _ in sorted(heap, reverse=True) for _ in range(min(k, times))][:k]
                out.extend((key[0], rank, c, s) for rank, (c, s) in enumerate(ranked, 1))
            else:
                out.extend((*key, -c, row, times, s) for s, c, times, row in heap)

        def flush():
            made = pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
            out.clear()
            return made

        for batch in batches:
            for q, part, c, row, times, s in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if (q, part) != key:
                    close()
                    key, met, heap = (q, part), None, []
                if (c, row) == met:  # the same candidate by another row of the query's id, no nearer
                    continue
                met = (c, row)
                if len(heap) < k:
                    heapq.heappush(heap, (s, -c, times, row))
                elif (s, -c, times, row) > heap[0]:
                    heapq.heapreplace(heap, (s, -c, times, row))
            if len(out) > 10_000:
                yield flush()
        close()
        if out:
            yield flush()

    return run


def nearest(vectors: DataFrame, queries: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK, hot: int = HOT, parts: int = PARTS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of each row for which ``queries`` holds, by cosine."""
    spark = vectors.sparkSession
    ship_package(spark)
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0)
    rows = vectors.where(usable).select(F.col(id_col).cast("long").alias("id"), v.alias("v"), F.coalesce(queries, F.lit(False)).alias("asked"))
    shape = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.count_if("asked").alias("q")).orderBy(F.desc("n"), "d").head()
    if shape is None or not shape.q:
        return spark.createDataFrame([], NEAREST)
    # Equal rows give equal pairs, so a row is known by its id and a hash of its vector.
    rows = rows.where(F.size("v") == shape.d).withColumn("row", F.xxhash64("id", "v"))
    qn, cn = -(-shape.q // query_block), -(-shape.n // candidate_block)
    coded = rows.select("id", "row", "asked", "v", F.xxhash64("v").alias("vector")).mapInArrow(_codes(shape.d), "id long, row long, asked boolean, code binary, scale double, residual double, vector long")
    columns = ["qb", "cb", "side", "id", "row", "code", "scale", "residual", "vector"]
    q = coded.where("asked").withColumns({"side": F.lit(0), "qb": F.pmod("row", F.lit(qn)).cast("int")}).withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(cn - 1))))
    c = coded.withColumns({"side": F.lit(1), "cb": F.pmod("row", F.lit(cn)).cast("int")}).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(qn - 1))))
    tiles = q.select(*columns).unionByName(c.select(*columns)).repartition("qb", "cb").sortWithinPartitions("qb", "cb", "side")
    pairs = tiles.mapInArrow(_tiles(k, shape.d, hot, parts), PAIRS)
    pairs = pairs.repartition("query_id", "part").sortWithinPartitions("query_id", "part", F.desc("low")).mapInArrow(_prune(k), PAIRS)
    pairs = Scratch(spark, "ann").write(pairs, "pairs")
    whole = rows.groupBy("id", "row").agg(F.first("v").alias("v"), F.count("*").alias("times"))
    theirs = whole.select(F.col("id").alias("vec_id"), F.col("row").alias("vec_row"), "times", F.col("v").alias("cv"))
    own = rows.where("asked").groupBy("id", "row").agg(F.first("v").alias("qv")).withColumnsRenamed({"id": "query_id", "row": "query_row"})
    side = ["query_id", "query_row", "part"]
    mine = pairs.select(*side).distinct().join(own, side[:2])
    both = pairs.join(theirs, ["vec_id", "vec_row"]).join(mine, side).select("query_id", "part", "vec_id", "vec_row", "times", "qv", "cv")
    scored = both.mapInArrow(_scored(shape.d), SCORED)
    order = ["query_id", "part", "vec_id", "vec_row", F.desc("score")]
    best = scored.repartition("query_id", "part").sortWithinPartitions(*order).mapInArrow(_heaps(k, False), SCORED).withColumn("part", F.lit(0))
    return best.repartition("query_id").sortWithinPartitions(*order).mapInArrow(_heaps(k, True), NEAREST)
