"""Exact top-k by inner product through a pivot-distance index.

Integer vectors get one more coordinate, so that all have the same length and the largest inner product with a query is the smallest distance. Every
vector is keyed by its nearest pivot and its distance to it; pivot and ring of distances make a cell, cut into tasks of bounded size. A query
at distance d from a pivot can only find a vector closer than r in the annulus from d - r to d + r (triangle inequality). r comes from the k-th best score
known so far: first from a bounded sample of the table, then from the cells with the smallest bounds; the other cells, and within a cell the vectors sorted by
distance, are read only inside the annulus. Nothing is approximate: a bound only ever leaves out vectors that are worse.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from layerloom.llm import vectors as V
from layerloom.llm.common import written

SCALE = 256
PIVOTS = 32
RINGS = 32
SAMPLE = 2048
ROWS_PER_TASK = 4096
QUERIES_PER_BLOCK = 512
FIRST_CELLS = 8  # cells per query in the first wave
# Slack of float distances, at least; a wider annulus only reads more.
MARGIN = 1e-6
# Scores from here on do not fit their column.
TOO_LARGE = 2.0**63 * (1 - 1e-9)
CELL = ["pivot", "ring", "salt"]


def _distances(own: np.ndarray, height: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances in the raised space. ``own``: vectors, ``height``: their last coordinate; pivots carry it as last column."""
    square = (own**2).sum(1)[:, None] + (height**2)[:, None] + (pivots**2).sum(1)[None] - 2 * (own @ pivots[:, :-1].T + height[:, None] * pivots[:, -1][None])
    return np.sqrt(np.maximum(square, 0))


def _integers(arrays, size: int) -> np.ndarray:
    return np.floor(SCALE * V.matrix(arrays, size))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in doubles while every partial sum is below 2^53, else in integers."""
    if a.size and b.size and np.abs(a).max() * np.abs(b).max() * a.shape[1] < 2**53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def _margin(top: float, size: int) -> float:
    """Slack of distances between vectors of square length ``top``. A square is off by a few roundings of ``top`` for each component, a
    distance by the root of that at most; own distance, distance to the pivot and reach share two margins."""
    return max(MARGIN, 2 * float(np.sqrt(8 * np.finfo(float).eps * (size + 16) * top)))


def _choose_pivots(points: np.ndarray, n: int) -> np.ndarray:
    """Far-apart points: each next one is the farthest from those chosen."""
    chosen, far = [0], np.full(len(points), np.inf)
    while len(chosen) < min(n, len(points)):
        far = np.minimum(far, ((points - points[chosen[-1]]) ** 2).sum(1))
        if far.max() <= 0:
            break
        chosen.append(int(far.argmax()))
    return points[chosen]


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: highest score, then smallest id."""
    return np.lexsort((ids, -scores))[:k]


def top_k(table: DataFrame, is_query: Column, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each query row its k highest integer inner products floor(256 x) . floor(256 y) over all
    rows with another id, ties to the smaller id.

    Defined results: vectors that are null or hold null or non-finite components, and null ids, take no part. Shorter vectors count as padded with zeros. Rows
    that repeat an id are candidates each, and are one query (of the smallest vector) each id. With fewer than k candidates all are returned; an
    empty table gives no rows. A vector whose score with itself does not fit a long is an error: its scores would not be exact. Other columns are
    not read.
    """
    spark = table.sparkSession
    rows = table.where(V.usable(vector_column) & F.col(id_column).isNotNull()).withColumn("__query", F.coalesce(is_query, F.lit(False)))
    rows = rows.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v"), "__query")
    size = V.longest(rows, "v")
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + F.floor(x * SCALE).cast("double") * F.floor(x * SCALE).cast("double"))
    top = rows.agg(F.max(square)).first()[0]
    if top is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if top >= TOO_LARGE:
        raise ValueError(f"a vector has the square length {top:g}: integer scores of 2^63 or more do not fit a long")
    size = max(size, 1)
    margin = _margin(top, size)
    stored = np.dtype("<i4" if top < 2.0**61 else "<i8")  # no component is longer than its vector
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vec_id", "v").toPandas()
    points, sample_ids = _integers(sample.v, size), sample.vec_id.to_numpy()

    def height(x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(top - (x**2).sum(1), 0))

    pivots = _choose_pivots(np.c_[points, height(points)], PIVOTS)
    width = max(_distances(points, height(points), pivots).min(1).max() / RINGS, 1e-9)

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = _integers(batch.v, size)
            far = _distances(x, height(x), pivots)
            near = far.argmin(1)
            distance = far[np.arange(len(x)), near]
            packed = [r.tobytes() for r in x.astype(stored)]
            ring = np.minimum(distance // width, RINGS - 1).astype(np.int32)  # the last ring is open
            yield pd.DataFrame({"pivot": near.astype(np.int32), "ring": ring, "distance": distance, "vec_id": batch.vec_id, "x": packed})

    def unpacked(data) -> np.ndarray:
        return np.frombuffer(b"".join(data), stored).reshape(len(data), size).astype(float)

    indexed = rows.mapInPandas(index, "pivot int, ring int, distance double, vec_id long, x binary")
    indexed = written(indexed.withColumn("place", F.monotonically_increasing_id()), "topk-index")
    # At most PIVOTS x RINGS rows.
    cells = indexed.groupBy("pivot", "ring").agg(F.count(F.lit(1)).alias("n"), F.min("distance").alias("low"), F.max("distance").alias("high")).toPandas()
    cells["salts"] = -(-cells.n // ROWS_PER_TASK)
    salts = spark.createDataFrame(cells[["pivot", "ring", "salts"]], "pivot int, ring int, salts int")

    def pack_cell(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("distance", kind="stable")
        head = {c: [part[c].iloc[0]] for c in CELL}
        return pd.DataFrame(head | {"ids": [part.vec_id.to_numpy("<i8").tobytes()], "far": [part.distance.to_numpy("<f8").tobytes()], "xs": [b"".join(part.x)]})

    salted = indexed.join(F.broadcast(salts), ["pivot", "ring"]).withColumn("salt", F.pmod(F.xxhash64("place"), F.col("salts")).cast("int"))
    packed = salted.groupBy(*CELL).applyInPandas(pack_cell, "pivot int, ring int, salt int, ids binary, far binary, xs binary")
    packed = written(packed, "topk-cells")

    def pack_block(part: pd.DataFrame) -> pd.DataFrame:
        """Queries of a block, with the k-th best score among the sample as first bound."""
        x, own = _integers(part.v, size), part.vec_id.to_numpy()
        scores = _products(x, points).astype(float)
        scores[own[:, None] == sample_ids[None]] = -np.inf
        bound = np.sort(scores, axis=1)[:, -k] if len(points) >= k else np.full(len(x), -np.inf)
        return pd.DataFrame({"block": part.block.iloc[:1], "own": [own.tolist()], "bounds": [bound.astype("<f8").tobytes()], "qs": [x.astype(stored).tobytes()]})

    queries = rows.where("__query").groupBy("vec_id").agg(F.min("v").alias("v"))
    n_blocks = max(1, -(-queries.count() // QUERIES_PER_BLOCK))
    blocks = queries.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(n_blocks)).cast("int"))
    blocks = written(blocks.groupBy("block").applyInPandas(pack_block, "block int, own array<long>, bounds binary, qs binary"), "topk-queries")

    low, high = cells.low.to_numpy() - margin, cells.high.to_numpy() + margin
    which = cells["pivot"].to_numpy()

    def reach(x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Distance within which a vector of at least the bounding score lies."""
        return np.sqrt(np.maximum((x**2).sum(1) + top - 2 * bounds, 0)) + margin

    def gaps(x: np.ndarray) -> np.ndarray:
        """Least distance of any vector of a cell from a query (a query's last coordinate is 0)."""
        to = _distances(x, np.zeros(len(x)), pivots)[:, which]
        return np.maximum(np.maximum(low[None] - to, to - high[None]), 0)

    def wanted(block: pd.DataFrame, first: bool) -> Iterator[pd.DataFrame]:
        """(cell, block, query places): the nearest cells in the first wave, else the others that the bound does not rule out."""
        for row in block.itertuples():
            x, bounds = np.frombuffer(row.qs, stored).reshape(-1, size).astype(float), np.frombuffer(row.bounds, "<f8")
            gap = gaps(x)
            nearest = np.zeros(gap.shape, bool)
            order = np.argsort(gap, axis=1, kind="stable")[:, :FIRST_CELLS]
            np.put_along_axis(nearest, order, True, axis=1)
            ask = nearest if first else ~nearest
            ask &= gap <= reach(x, bounds)[:, None]
            found = [
                (which[c], cells.ring[c], salt, row.block, np.flatnonzero(ask[:, c]).astype("<i4").tobytes())
                for c in np.flatnonzero(ask.any(axis=0))
                for salt in range(cells.salts[c])
            ]
            yield pd.DataFrame(found, columns=[*CELL, "block", "places"])

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                places = np.frombuffer(row.places, "<i4")
                x = np.frombuffer(row.qs, stored).reshape(-1, size)[places].astype(float)
                own, bounds = np.asarray(row.own, np.int64)[places], np.frombuffer(row.bounds, "<f8")[places]
                ids, far = np.frombuffer(row.ids, "<i8"), np.frombuffer(row.far, "<f8")
                ys = np.frombuffer(row.xs, stored).reshape(-1, size).astype(float)
                to, radius = _distances(x, np.zeros(len(x)), pivots[[row.pivot]])[:, 0], reach(x, bounds)
                start, stop = np.searchsorted(far, to - radius - margin), np.searchsorted(far, to + radius + margin, "right")
                found = []
                for i in range(len(x)):
                    near = slice(start[i], stop[i])
                    scores, names = _products(x[i : i + 1], ys[near])[0], ids[near]
                    good = (names != own[i]) & (scores >= bounds[i])
                    scores, names = scores[good], names[good]
                    best = _best(names, scores, k)
                    found.append(pd.DataFrame({"query_id": own[i], "vec_id": names[best], "score": scores[best]}))
                yield pd.concat(found)

    def wave(blocks: DataFrame, first: bool) -> DataFrame:
        ask = blocks.mapInPandas(lambda it: (f for b in it for f in wanted(b, first)), "pivot int, ring int, salt int, block int, places binary")
        work = ask.join(packed, CELL).join(blocks, "block").repartition(*CELL, "block")
        return work.mapInPandas(search, "query_id long, vec_id long, score long")

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def ranked(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    begun = written(ranked(wave(blocks, True)), "topk-first")
    # the k-th score found so far is the bound of the second wave
    better = begun.where(F.col("rank") == k).select("query_id", F.col("score").cast("double").alias("at_least"))
    told = blocks.select("block", F.posexplode("own").alias("place", "query_id")).join(better, "query_id", "left")
    told = told.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("place", F.coalesce("at_least", F.lit(float("-inf"))).alias("b")))).alias("list"))
    told = blocks.join(told.select("block", F.col("list.b").alias("found")), "block")

    def raise_bounds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["bounds"] = [np.maximum(np.frombuffer(b, "<f8"), np.asarray(f, float)).astype("<f8").tobytes() for b, f in zip(batch.bounds, batch.found)]
            yield batch[["block", "own", "bounds", "qs"]]

    told = written(told.mapInPandas(raise_bounds, "block int, own array<long>, bounds binary, qs binary"), "topk-bounds")
    every = begun.select("query_id", "vec_id", "score").unionByName(wave(told, False))
    return ranked(every).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

