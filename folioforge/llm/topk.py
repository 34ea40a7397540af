"""Exact top-k inner products over a bit-sliced index.

Vectors are quantised to integers. The rows of a block are stored as slices: bitmaps with one
bit per row, one for each bit of each component, made unsigned by an offset. A query's score
is a sum of weighted components, so its slices are added column by column with bitmap
arithmetic: a full adder turns three bitmaps of one column into one there and one in the
next. Negative weights add the inverted slices. The lowest slices of the components are left
out, which bounds what the sum may miss. From the most significant slice of the sum downward,
bitmaps and counts find the k-th largest value; the rows that can still reach it, the boundary
included, get their exact scores.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOP = 5
SCALE = 256
BLOCK_ROWS = 1 << 14
BLOCK_QUERIES = 64
#: Slices left out of the sum, from the lowest up.
LEFT_OUT = 3
#: Tasks that share the blocks of rows, at least; queries that a task holds at once.
LANES, LANE_QUERIES = 32, 1 << 13
#: What a task returns.
FOUND = ("query_id", "vec_id", "score")
#: Components reach no further, so that products of a thousand components can be summed exactly.
LARGEST = 1 << 26


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component. One of `LARGEST` or more stops the job, as scores must fit 64 bits."""
    wide = lambda x: x.cast("double") * scale
    refused = F.raise_error(F.lit(f"a component times {scale} is {LARGEST} or more")).cast("array<bigint>")
    whole = F.transform(vector, lambda x: F.floor(wide(x)).cast("long"))
    return F.when(F.exists(vector, lambda x: F.abs(wide(x)) >= LARGEST), refused).otherwise(whole)


def usable(vector: Column) -> Column:
    """No null vector and no null, NaN or infinite component."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, bad)


class Slices:
    """The bit slices of a block of rows."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.values = ids[order], values[order]
        n, self.dims = values.shape
        self.words = -(-n // 64)
        self.low = int(values.min()) if values.size else 0
        shifted = (self.values - self.low).astype(np.uint64)
        self.bits = max(1, int(shifted.max()).bit_length() if values.size else 1)
        self.left_out = min(LEFT_OUT, self.bits - 1)
        padded = np.zeros((self.words * 64, self.dims), np.uint64)
        padded[:n] = shifted
        rows = [self._pack((padded >> np.uint64(b)) & np.uint64(1)) for b in range(self.left_out, self.bits)]
        plain = np.stack(rows, axis=1)  # dimension, slice, word
        self.planes = np.stack([plain, ~plain])
        self.every = self._pack((np.arange(self.words * 64) < n)[:, None])[0]

    def _pack(self, bits: np.ndarray) -> np.ndarray:
        octets = np.packbits(bits.astype(np.uint8), axis=0, bitorder="little")
        return np.ascontiguousarray(octets.T).view(np.uint64)

    def sum_of(self, weights: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Slices of the weighted sum of the kept slices, lowest first, and what the left-out ones may add.

        The sum is the score without a constant that is the same for all rows.
        """
        size, sign = np.abs(weights), (weights < 0).astype(np.int64)
        columns: dict[int, list[np.ndarray]] = {}
        for b in range(int(size.max()).bit_length() if size.size else 0):
            dims = np.flatnonzero((size >> b) & 1)
            for j in range(self.planes.shape[2]):
                columns.setdefault(b + j, []).append(self.planes[sign[dims], dims, j])
        out, k = [], 0
        carried: list[np.ndarray] = []
        while k <= max(columns, default=-1) or carried:
            stack = [a for a in columns.get(k, []) + carried if len(a)]
            column = np.concatenate(stack) if stack else np.zeros((1, self.words), np.uint64)
            carried = []
            while len(column) > 1:
                third = len(column) // 3
                if third:
                    a, b, c = column[:third], column[third : 2 * third], column[2 * third : 3 * third]
                    half = a ^ b
                    carried.append((a & b) | (half & c))
                    column = np.concatenate([half ^ c, column[3 * third :]])
                else:
                    carried.append(column[:1] & column[1:2])
                    column = column[:1] ^ column[1:2]
            out.append(column[0])
            k += 1
        missed = int(size.sum()) * ((1 << self.left_out) - 1) >> self.left_out if self.left_out else 0
        return out, missed + (1 if self.left_out else 0)

    def candidates(self, weights: np.ndarray, among: np.ndarray, top: int) -> np.ndarray:
        """Rows of bitmap `among` that may be among its `top` best."""
        slices, missed = self.sum_of(weights)
        tied, above, level = among, 0, 0
        for k in range(len(slices) - 1, -1, -1):
            ones = tied & slices[k]
            count = int(np.bitwise_count(ones).sum())
            if above + count >= top:
                tied, level = ones, level | (1 << k)
            else:
                tied, above = tied & ~slices[k], above + count
        least = max(0, level - missed)
        more, same = np.zeros_like(among), among
        for k in range(len(slices) - 1, -1, -1):
            if least >> k & 1:
                same = same & slices[k]
            else:
                more, same = more | (same & slices[k]), same & ~slices[k]
        return np.flatnonzero(np.unpackbits((more | same).view(np.uint8), bitorder="little"))

    def best(self, query_id: int, weights: np.ndarray, top: int) -> list[tuple[int, int]]:
        """(id, score) of the `top` best rows but those of the query's own id, ties to smaller ids."""
        own = np.arange(*np.searchsorted(self.ids, [query_id, query_id + 1]))
        among = self.every.copy()
        for i in own:
            among[i // 64] &= ~(np.uint64(1) << np.uint64(i % 64))
        rows = self.candidates(weights, among, top)
        scores = self.values[rows] @ weights
        order = np.lexsort((self.ids[rows], -scores))[:top]
        return [(int(self.ids[rows[i]]), int(scores[i])) for i in order]


def _matrix(vectors: pa.ChunkedArray, dims: int) -> np.ndarray:
    """A row per vector, all of `dims` components; those without components get one of 0."""
    flat = [chunk.flatten().to_numpy(zero_copy_only=False) for chunk in vectors.chunks]
    return np.concatenate(flat).astype(np.int64).reshape(len(vectors), dims) if dims else np.zeros((len(vectors), 1), np.int64)


def _each_row(rows: DataFrame, top: int) -> DataFrame:
    """The rows with an id, of equal ones no more than `top`: more of them cannot reach any result."""
    equal = rows.where("vec_id is not null").groupBy("vec_id", "q").agg(F.count("*").alias("n"))
    copies = F.explode(F.sequence(F.lit(1), F.least("n", F.lit(top)).cast("int"))).alias("copy")
    return equal.select("vec_id", "q", copies).withColumn("dims", F.size("q"))


def top_inner_products(
    queries: DataFrame, vectors: DataFrame, top: int = TOP, block_rows: int = BLOCK_ROWS, lanes: int = LANES
) -> DataFrame:
    """Both have vec_id and q, an array of longs. Returns query_id, rank, vec_id, score.

    A query meets all vectors of its own number of components but those of its own id; with
    fewer than `top` of them it gets all. Rows that repeat an id are rows of their own, as vectors and
    as queries; the queries of one id are ranked together. Null ids take no part. Blocks of queries meet blocks of rows; a task returns no more
    than `top` rows for a query and a block. Empty tables give no rows.

    Rows travel one by one, so Spark's side never holds a block; a worker of Python holds one block and
    the queries of its lane, at most `LANE_QUERIES` or so. Lanes are only as many as that and `lanes` tasks need.
    """
    base, asked = _each_row(vectors, top), _each_row(queries, top)
    n_base, n_asked = base.count(), asked.count()
    blocks, groups = max(1, -(-n_base // block_rows)), max(1, -(-n_asked // BLOCK_QUERIES))
    lanes = min(groups, max(-(-lanes // blocks), -(-n_asked // LANE_QUERIES)))
    dealt = lambda n: F.pmod(F.xxhash64("vec_id", "q", "copy"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    known = ["dims", "vec_id", "q"]
    index = base.where("dims is not null").withColumn("block", dealt(blocks)).select(*known, "block", every(lanes).alias("lane"))
    each = asked.where("dims is not null").withColumn("lane", dealt(lanes)).select(*known, "lane", every(blocks).alias("block"))

    def best(rows: pa.Table, own: pa.Table) -> pa.Table:
        found = []
        if rows.num_rows and own.num_rows:
            dims = rows["dims"][0].as_py()
            slices = Slices(rows["vec_id"].to_numpy(), _matrix(rows["q"], dims))
            for query_id, weights in zip(own["vec_id"].to_pylist(), _matrix(own["q"], dims)):
                found += [(query_id, i, s) for i, s in slices.best(query_id, weights, top)]
        return pa.table([pa.array(c, pa.int64()) for c in zip(*found)] if found else [pa.array([], pa.int64())] * 3, names=FOUND)

    # dealt out by number: a block is few bytes and much work, so Spark would put several into one task
    key, tasks = ["dims", "block", "lane"], blocks * lanes
    met = index.repartition(tasks, *key).groupBy(*key).cogroup(each.repartition(tasks, *key).groupBy(*key))
    found = met.applyInArrow(best, ", ".join(f"{name} long" for name in FOUND))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")


def top_neighbours(
    embeddings: DataFrame, every: int = 50, top: int = TOP, scale: int = SCALE, column: str = "embedding"
) -> DataFrame:
    """`top_inner_products` of the rows whose vec_id is divisible by `every`, among all usable rows."""
    vectors = embeddings.where(usable(F.col(column))).select("vec_id", quantised(F.col(column), scale).alias("q"))
    return top_inner_products(vectors.where(F.col("vec_id") % every == 0), vectors, top)
