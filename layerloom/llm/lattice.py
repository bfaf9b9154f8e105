"""Near-duplicate vectors by lattice hashing.

Each table projects the unit vectors to eight random orthonormal directions and decodes the result to the nearest point of the lattice E8, the
densest packing in eight dimensions; the point is the vector's cell. A vector is stored in its own cell and looked for in the neighbouring cells whose centres lie
nearest to it. Pairs that meet are screened by a short sign sketch and verified by their cosine in double precision. Equal vectors stand behind one row.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from layerloom.llm import vectors as V
from layerloom.llm.common import parts_for, written
from layerloom.llm.graph import components
from layerloom.llm.shingles import mixed

COSINE = 0.9
# At cosine 0.9 one table with these settings finds 39 % of the pairs, twelve find 99.7 %; nearer pairs are found more surely.
TABLES, PROBES, SPREAD = 12, 8, 6.0
SKETCH = 128
# Signs that may differ: at cosine 0.9 18 do on average, with a deviation of 4; 64 do for unrelated vectors.
DIFFERING = 44
ROWS_PER_CELL = 1024
PAIRS_AT_ONCE = 1 << 20


@cache
def shortest() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    whole = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = [0.0] * 8
            v[i], v[j] = a, b
            whole.append(v)
    half = [s for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(whole + [list(h) for h in half])


def _even(x: np.ndarray) -> np.ndarray:
    """Nearest integer point with an even sum: round, and where the sum is odd round the worst coordinate the other way."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(1) % 2)
    rest = x[odd] - near[odd]
    worst = np.abs(rest).argmax(1)
    near[odd, worst] += np.where(rest[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
    return near


def decode(x: np.ndarray) -> np.ndarray:
    """Nearest lattice point: the better one of the two shifted copies of the even integer points."""
    whole, half = _even(x), _even(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1)
    return np.where(closer[:, None], whole, half)


def neighbours(x: np.ndarray, centre: np.ndarray, n: int) -> np.ndarray:
    """The n lattice points around ``centre`` that are nearest to x: (rows, n, 8)."""
    steps = shortest()
    toward = (x - centre) @ steps.T
    return centre[:, None] + steps[np.argsort(-toward, axis=1, kind="stable")[:, :n]]


def cell_number(points: np.ndarray, table: int) -> np.ndarray:
    key = np.full(points.shape[:-1], table + 1, np.uint64)
    for k in range(8):
        key = mixed(key ^ np.rint(2 * points[..., k]).astype(np.int64).view(np.uint64))
    return key.view(np.int64)


@cache
def projections(size: int, tables: int, sketch: int, seed: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Fixed random directions for a vector length: (tables, size, 8) and (size, sketch)."""
    rng = np.random.default_rng([seed, size])
    wide = max(size, 8)
    planes = np.stack([np.linalg.qr(rng.normal(size=(wide, 8)))[0][:size] for _ in range(tables)])
    return planes * np.sqrt(wide / 64), rng.normal(size=(size, sketch))


def _bits(words: np.ndarray) -> np.ndarray:
    return np.bitwise_count(words).sum(axis=-1)


def links(distinct: DataFrame, size: int, cosine: float = COSINE, tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """(a, b), a < b, each pair found once. ``distinct``: a stored table of node (long) and v (array of double), no zero vectors."""
    spark = distinct.sparkSession

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        planes, signs = projections(size, tables, SKETCH)
        for batch in batches:
            x = V.matrix(batch.v, size)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            sketch = [r.tobytes() for r in np.packbits(x @ signs > 0, axis=1)]
            for t in range(tables):
                at = x @ planes[t] * SPREAD
                centre = decode(at)
                own = cell_number(centre, t)
                near = cell_number(neighbours(at, centre, probes), t)
                yield pd.DataFrame({"cell": own, "node": batch.node, "stored": True, "sketch": sketch})
                flat = pd.DataFrame({"cell": near.reshape(-1), "node": np.repeat(batch.node.to_numpy(), probes), "stored": False})
                flat["sketch"] = np.repeat(np.array(sketch, dtype=object), probes)
                yield flat

    placed = written(distinct.mapInPandas(cells, "cell long, node long, stored boolean, sketch binary"), "lattice-cells")
    # Cells where nobody lives, or only one vector that nobody looks for, are dropped. Full cells are cut into blocks of rows, block against block.
    count = placed.groupBy("cell").agg(F.count_if("stored").alias("living"), F.count(F.lit(1)).alias("n")).where("living > 0 and n > 1")
    cut = count.withColumn("blocks", F.ceil(F.col("n") / ROWS_PER_CELL).cast("int")).select("cell", "blocks")
    rows = placed.join(cut, "cell").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    sent = rows.withColumn("other", F.explode(others))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    sent = sent.select("cell", "node", "stored", "sketch", low.alias("low"), high.alias("high"))
    parts = parts_for(distinct) * 4
    sent = sent.withColumn("part", F.pmod(F.xxhash64("cell", "low", "high"), F.lit(parts)).cast("int"))

    def meet(batch: pd.DataFrame) -> pd.DataFrame:
        """All cells of one part: vectors living in a cell with those living there or looking there."""
        batch = batch.sort_values(["cell", "low", "high", "stored", "node"], ascending=[True, True, True, False, True], ignore_index=True)
        node, stored = batch.node.to_numpy(), batch.stored.to_numpy()
        sketch = np.frombuffer(b"".join(batch.sketch), "<u8").reshape(len(batch), SKETCH // 64)
        new = (batch[["cell", "low", "high"]] != batch[["cell", "low", "high"]].shift()).any(axis=1).to_numpy()
        start = np.flatnonzero(new)
        stop = np.r_[start[1:], len(batch)]
        living = np.add.reduceat(stored.astype(np.int64), start)
        # each row meets the living rows in front of it
        group = np.repeat(np.arange(len(start)), stop - start)
        ahead = np.minimum(np.arange(len(batch)) - start[group], living[group])
        found, begin = [np.zeros(0, np.int64)], 0
        total = np.cumsum(ahead)
        while begin < len(batch):
            base = total[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(total, base + PAIRS_AT_ONCE, "right")))
            n = ahead[begin:end]
            right = np.repeat(np.arange(begin, end), n)
            left = np.repeat(start[group[begin:end]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            good = (_bits(sketch[left] ^ sketch[right]) <= DIFFERING) & (node[left] != node[right])
            left, right = node[left[good]], node[right[good]]
            found.append(np.unique(np.c_[np.minimum(left, right), np.maximum(left, right)], axis=0).reshape(-1))
            begin = end
        pairs = np.unique(np.concatenate(found).reshape(-1, 2), axis=0)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    met = sent.groupBy("part").applyInPandas(lambda f: meet(f.drop(columns="part")), "a long, b long").distinct()
    met = written(met, "lattice-pairs")
    first = distinct.select(F.col("node").alias("a"), F.col("v").alias("va"))
    second = distinct.select(F.col("node").alias("b"), F.col("v").alias("vb"))

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x, y = V.matrix(batch.va, size), V.matrix(batch.vb, size)
            value = (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))
            yield batch.loc[value >= cosine, ["a", "b"]]

    return met.join(first, "a").join(second, "b").mapInPandas(verify, "a long, b long")


def near_duplicate_vectors(
    table: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", cosine: float = COSINE, tables: int = TABLES, probes: int = PROBES
) -> DataFrame:
    """One row per row: vec_id, n_links (other rows with a vector of at least that cosine), component_id (smallest id reachable by links, its own
    included) and kept (vec_id = component_id).

    Defined results: vectors that are null, zero or hold null or non-finite components link with nothing. Shorter vectors count as padded with zeros. Rows with
    equal ids are rows of their own. Null ids are linked and counted; they are no component's name, so a component of null ids only has a null name. An empty
    table gives no rows. Other columns are not read.
    """
    rows = table.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v"))
    fit = V.usable("v") & F.exists("v", lambda x: x != 0.0)
    rows = written(rows.select("vec_id", F.when(fit, F.transform("v", lambda x: x + F.lit(0.0))).alias("v")), "lattice-rows")
    usable = rows.where("v is not null")
    size = V.longest(usable, "v")
    # Copies: one node per distinct vector. With the copies' number known, links are counted without meeting them.
    grouped = usable.groupBy("v").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    nodes = written(grouped.withColumn("place", F.monotonically_increasing_id()), "lattice-numbered")
    nodes = nodes.select(F.col("place").alias("node"), "v", "first", "copies")
    found = written(links(nodes.select("node", "v"), max(size, 1), cosine, tables, probes), "lattice-links")

    copies = nodes.select("node", "copies")
    ends = found.select(F.col("a").alias("at"), F.col("b").alias("node")).unionByName(found.select(F.col("b").alias("at"), F.col("a").alias("node")))
    linked = ends.join(copies, "node").groupBy(F.col("at").alias("node")).agg(F.sum("copies").alias("others"))
    member = components(found)
    described = nodes.join(linked, "node", "left").join(member, "node", "left")
    described = described.withColumn("component", F.coalesce("component", "node"))
    names = described.groupBy("component").agg(F.min("first").alias("component_id"))
    described = described.join(names, "component").select("v", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    joined = usable.join(described, "v").select("vec_id", "n_links", "component_id")
    alone = rows.where("v is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.unionByName(alone).select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
