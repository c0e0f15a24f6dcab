"""Approximate nearest neighbours by cross-polytope hashing.

Vectors are scaled to unit length and turned by pseudo-random rotations (three
rounds of random signs and a fast Hadamard transform). In each of ``TABLES``
tables a vector lies in the cell of its nearest signed axes after two rotations, so
that a table has 4 * dim ** 2 cells. A query looks into the cells whose two axes
are nearest to it, ``PROBES`` of them in each table, and every vector found in
any of them is scored once, exactly, on the original numbers.

Queries are a stated set: they meet the vectors in blocks of at most about
``QUERY_BLOCK`` and ``BLOCK``. Both are dealt by digest, so that blocks are even
whatever vectors are common; in a block a query's candidates are the vectors whose
cells it probes, and it takes its best ``k``; a window with a group limit merges
the blocks. How many cells are probed never depends on the number of vectors, but
on what a query has found: the farther a neighbour, the more cells it may lie in.
A query whose ``k``-th found is so far away that ``PROBES`` cells a table hold a
vector that far away in fewer than ``FOUND`` of all cases looks into as many as
that takes (``probes_at``). A query that has found fewer than ``k`` is
compared with all vectors.

Defined results: vectors that are null, empty, zero or hold a null, infinite or
NaN component take no part, nor do rows with a null id; vectors of another
dimension never meet; equal ids are one vector, scored by its best row, and are
never their own neighbour; ties go to the smaller id; with fewer than ``k``
candidates all are returned; an empty table gives an empty result. Other columns
are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerkit.llm.tables import read_table, ship, stored

TABLES = 32
#: Cells that a query looks into first in each table.
PROBES = 114
#: Share of the vectors as far away as its ``k``-th found that a query's probes hold.
FOUND = 0.9
#: Pairs drawn to learn how many probes that takes, and steps of their cosine.
PAIRS, STEPS = 400, 20
ROUNDS = 3
#: A query with its probes takes more room than a vector, so that it should go to fewer blocks.
BLOCK, QUERY_BLOCK = 16384, 1024
#: Bytes of the probes of a block of queries; probes of a table that are found at once.
ASK_BYTES, WIDE = 1 << 26, 1 << 16


def _hadamard(x: np.ndarray) -> np.ndarray:
    n, h = x.shape[1], 1
    while h < n:
        pairs = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def rotated(unit: np.ndarray, number: int) -> np.ndarray:
    """``unit`` rows, padded to a power of two, after a rotation."""
    dim = 1 << max(unit.shape[1] - 1, 0).bit_length()
    x = np.zeros((len(unit), dim))
    x[:, : unit.shape[1]] = unit
    signs = np.random.Generator(np.random.PCG64([2015, number, dim]))
    for _ in range(ROUNDS):
        x = _hadamard(x * signs.choice([-1.0, 1.0], size=dim))
    return x


def _signed(x: np.ndarray) -> np.ndarray:
    """Nearness to each of the 2 x dim signed axes."""
    return np.stack([x, -x], axis=2).reshape(len(x), 2 * x.shape[1])


def n_cells(dim: int) -> int:
    return (2 << max(dim - 1, 0).bit_length()) ** 2


def cell_type(dim: int) -> type:
    """In which cells are stored."""
    return np.uint16 if n_cells(dim) <= 1 << 16 else np.int32


def cells(unit: np.ndarray, tables: int = TABLES) -> np.ndarray:
    """Cell of each row in each table: its nearest signed axis after either of the
    table's two rotations."""
    out = np.zeros((len(unit), tables), dtype=np.int32)
    for t in range(tables):
        a, b = (_signed(rotated(unit, 2 * t + k)) for k in (0, 1))
        out[:, t] = a.argmax(axis=1) * a.shape[1] + b.argmax(axis=1)
    return out


def probes_for(rows: int, dim: int) -> int:
    """How many cells of a table a query looks into first: the same among any
    number of ``rows``."""
    return min(PROBES, n_cells(dim))


@lru_cache
def probes_at(cosine: float, dim: int, tables: int = TABLES) -> int:
    """How many cells of each table a query looks into to find ``FOUND`` of the
    vectors at a cosine to it: learnt from drawn pairs, so that it depends on the
    cosine and the dimension alone."""
    rng = np.random.Generator(np.random.PCG64([2015, dim]))
    x, y = (rng.standard_normal((PAIRS, dim)) for _ in range(2))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y /= np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-300)
    other = cosine * x + np.sqrt(1 - cosine * cosine) * y
    first = np.full(PAIRS, n_cells(dim))
    for t in range(tables):
        a, b = (_signed(rotated(x, 2 * t + k)) for k in (0, 1))
        at_a, at_b = (_signed(rotated(other, 2 * t + k)).argmax(axis=1) for k in (0, 1))
        by_b = np.sort(b, axis=1)
        for r in range(PAIRS):
            # Cells that are nearer to the query than the one that holds the other vector.
            nearer = by_b.shape[1] - np.searchsorted(by_b[r], a[r, at_a[r]] + b[r, at_b[r]] - a[r], side="right")
            first[r] = min(first[r], 1 + nearer.sum())
    return max(int(np.sort(first)[int(np.ceil(FOUND * PAIRS)) - 1]), probes_for(1, dim))


def probes(unit: np.ndarray, n: int, tables: int = TABLES) -> np.ndarray:
    """The ``n`` nearest cells of each row in each table."""
    out = np.zeros((len(unit), tables, n), dtype=np.int32)
    for t in range(tables):
        a, b = (_signed(rotated(unit, 2 * t + k)) for k in (0, 1))
        axes = a.shape[1]
        # Of the pairs of axes that are i-th and j-th nearest, i * j pairs are at least as near.
        i = np.arange(1, axes + 1)
        first, second = np.nonzero(i[:, None] * i[None, :] <= n)
        by_a, by_b = (np.argsort(-x, axis=1, kind="stable") for x in (a, b))
        near = np.take_along_axis(a, by_a, 1)[:, first] + np.take_along_axis(b, by_b, 1)[:, second]
        best = np.argsort(-near, axis=1, kind="stable")[:, :n]
        out[:, t] = np.take_along_axis(by_a, first[best], 1) * axes + np.take_along_axis(by_b, second[best], 1)
    return out


HASHED = "vec_id bigint, dim int, vector binary, query boolean, cell binary, probe binary"


def _unit(x: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(axis=1, keepdims=True)  # first, so that squares neither overflow nor vanish
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _hash_batches(batches: Iterator[pa.RecordBatch], tables: int, n_probes: int | None) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for i in range(0, whole.num_rows, 1000):
            b = whole.slice(i, 1000)
            vectors = b.column(1)
            at = vectors.offsets.to_numpy()
            flat = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64)
            rows = [flat[a:z] for a, z in zip(at[:-1], at[1:])]
            for dim in sorted({len(r) for r in rows}):
                pick = [k for k, r in enumerate(rows) if len(r) == dim]
                x = np.stack([rows[k] for k in pick])
                unit = _unit(x)
                asked = min(n_probes, n_cells(dim)) if n_probes else probes_for(b.num_rows, dim)
                query = b.column(2).to_numpy(zero_copy_only=False)[pick]
                probe = iter(probes(unit[query], asked, tables).astype(cell_type(dim)))
                yield pa.RecordBatch.from_arrays([
                    b.column(0).take(pa.array(pick)),
                    pa.array(np.full(len(pick), dim), pa.int32()),
                    pa.array([r.tobytes() for r in x], pa.binary()),
                    pa.array(query),
                    pa.array([r.tobytes() for r in cells(unit, tables).astype(cell_type(dim))], pa.binary()),
                    pa.array([next(probe).tobytes() if q else None for q in query], pa.binary()),
                ], names=["vec_id", "dim", "vector", "query", "cell", "probe"])


ASKS = "query_id bigint, dim int, vector binary, probe binary"


def _wider(batches: Iterator[pa.RecordBatch], tables: int) -> Iterator[pa.RecordBatch]:
    """The queries whose ``k``-th found is so far away that it takes more probes
    (``query_id``, ``dim``, ``vector``, cosine of the ``k``-th), with these probes."""
    for b in batches:
        dims = b.column(1).to_numpy()
        steps = np.clip(np.floor(b.column(3).to_numpy() * STEPS), 0, STEPS - 1).astype(int)
        for dim, step in sorted(set(zip(dims.tolist(), steps.tolist()))):
            needed = probes_at(step / STEPS, dim, tables)
            if needed == probes_for(b.num_rows, dim):
                continue
            pick, size = np.flatnonzero((dims == dim) & (steps == step)), max(1, WIDE // needed)
            for i in range(0, len(pick), size):
                some = b.take(pa.array(pick[i:i + size]))
                more = probes(_unit(_numbers(some, "vector", np.float64)), needed, tables).astype(cell_type(dim))
                probe = pa.array([p.tobytes() for p in more], pa.binary())
                yield pa.RecordBatch.from_arrays([*some.columns[:3], probe], names=["query_id", "dim", "vector", "probe"])


def _usable(vector: Column) -> Column:
    value = vector.cast("array<double>")
    fine = F.forall(value, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return vector.isNotNull() & fine & F.exists(value, lambda v: v != 0)


def _numbers(t: pa.Table | pa.RecordBatch, name: str, kind: type) -> np.ndarray:
    rows = t.column(name).to_pylist()
    return np.frombuffer(b"".join(rows), dtype=kind).reshape(len(rows), -1)


def _best_of(q: np.ndarray, v: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best ids of some vectors, their scores and the rows they have here,
    ties to the smaller id."""
    at = np.arange(len(ids))
    with np.errstate(over="ignore", invalid="ignore"):
        if len(ids) > 4 * k and len(np.unique(ids)) == len(ids):
            # Products of a matrix may differ in the last bits for equal vectors,
            # so all that come near the k-th are scored anew.
            rough = v @ q
            kth = np.partition(rough, len(ids) - k)[len(ids) - k]
            size = np.sqrt((q * q).sum() * (v * v).sum(axis=1).max())
            near = rough >= kth - 4 * len(q) * np.finfo(float).eps * size
            if np.isfinite(kth) and np.isfinite(size):
                at = np.flatnonzero(near)
        score = (v[at] * q).sum(axis=1)
    order = np.lexsort((ids[at], -score))
    order = order[np.sort(np.unique(ids[at][order], return_index=True)[1])][:k]
    return ids[at][order], score[order], at[order]


class _Lists:
    """The vectors of a block by table and cell."""

    def __init__(self, cell: np.ndarray, n: int) -> None:
        self.n, self.offset = len(cell), np.arange(cell.shape[1], dtype=np.int64) * n
        key = (cell + self.offset).T.ravel()
        order = np.argsort(key, kind="stable")
        self.rows = order % self.n
        self.key, self.start = np.unique(key[order], return_index=True)
        self.end = np.append(self.start[1:], len(order))

    def held(self, probed: np.ndarray) -> np.ndarray:
        """Which vectors lie in any of the cells: ``probed`` by table."""
        asked = np.sort((probed + self.offset[:, None]).ravel())
        at = np.searchsorted(self.key, asked)
        at = at[self.key[np.minimum(at, len(self.key) - 1)] == asked]
        lengths = self.end[at] - self.start[at]
        ends = np.cumsum(lengths)
        out = np.zeros(self.n, dtype=bool)
        out[self.rows[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.start[at] - ends + lengths, lengths)]] = True
        return out


BEST = "query_id bigint, vec_id bigint, score double, cosine double"


def _block(queries: pa.Table, index: pa.Table, k: int, tables: int, every: bool) -> pa.Table:
    """Each query's best ``k`` among its candidates in one block; with ``every``
    all vectors are candidates."""
    q_id, v_id = queries.column("query_id").to_numpy(), index.column("vec_id").to_numpy()
    found: list[tuple] = []
    if len(q_id) and len(v_id):
        q, v = _numbers(queries, "vector", np.float64), _numbers(index, "vector", np.float64)
        q_unit, v_unit = _unit(q), _unit(v)
        if not every:
            kind = cell_type(q.shape[1])
            lists, probed = _Lists(_numbers(index, "cell", kind), n_cells(q.shape[1])), queries.column("probe")
        for r, one in enumerate(q_id):
            candidate = v_id != one
            if not every:
                candidate &= lists.held(np.frombuffer(probed[r].as_py(), dtype=kind).reshape(tables, -1))
            pick = np.flatnonzero(candidate)
            ids, score, at = _best_of(q[r], v[pick], v_id[pick], k)
            found.append((np.full(len(ids), one), ids, score, v_unit[pick[at]] @ q_unit[r]))
    columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0)] * 4
    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
    return pa.table({n: pa.array(c, t) for n, c, t in zip(("query_id", "vec_id", "score", "cosine"), columns, kinds)})


def _search(asks: DataFrame, index: DataFrame, k: int, tables: int, every: bool) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``, ``cosine`` over all blocks."""
    def blocks(rows: DataFrame, size: Column, name: str) -> DataFrame:  # one row per dimension
        return F.broadcast(rows.groupBy("dim").agg(F.ceil(size).cast("int").alias(name)))

    def dealt(n: str) -> Column:
        return F.pmod(F.xxhash64("id", "vector"), F.col(n)).cast("int")

    def spread(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    held, asked = blocks(index, F.count(F.lit(1)) / BLOCK, "n_blocks"), blocks(
        asks, F.greatest(F.count(F.lit(1)) / QUERY_BLOCK, F.sum(F.length("probe")) / ASK_BYTES), "n_ask_blocks")
    key = ["dim", "block", "ask_block"]
    right = index.withColumnRenamed("vec_id", "id").join(held, "dim").join(asked, "dim").withColumn("block", dealt("n_blocks"))
    right = right.withColumn("ask_block", spread("n_ask_blocks")).select(*key, F.col("id").alias("vec_id"), "vector", "cell")
    left = asks.withColumnRenamed("query_id", "id").join(held, "dim").join(asked, "dim").withColumn("ask_block", dealt("n_ask_blocks"))
    left = left.withColumn("block", spread("n_blocks")).select(*key, F.col("id").alias("query_id"), "vector", "probe")
    # Both sides stem from one table: new names of its columns tell them apart.
    right = right.select(*(F.col(c).alias(c) for c in right.columns))
    best = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        lambda q, v: _block(q, v, k, tables, every), BEST)
    once = best.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"), F.min("cosine").alias("cosine"))
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score", "cosine")


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            tables: int = TABLES, n_probes: int | None = None) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` vectors with the
    largest inner product found for each row where ``is_query`` holds.
    ``n_probes``: cells that a query looks into in each table, instead of those that
    its nearest found ask for."""
    ship(vectors.sparkSession)
    rows = vectors.where(F.col(id_col).isNotNull() & _usable(F.col(vector_col))).select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("query"))
    # Copies of a row are one.
    hashed = stored(rows.mapInArrow(lambda b: _hash_batches(b, tables, n_probes), HASHED).dropDuplicates(["vec_id", "vector", "query"]), "hashed-vectors")
    index = hashed.select("vec_id", "dim", "vector", "cell")
    asks = hashed.where("query").select(F.col("vec_id").alias("query_id"), "dim", "vector", "probe")
    found = stored(_search(asks, index, k, tables, every=False), "nearest-found")
    result = ["query_id", "rank", "vec_id", "score"]
    farthest = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("cosine").alias("cosine"))
    enough = farthest.where(F.col("n") == k)
    out, short = found, asks.join(enough, "query_id", "left_anti")
    if not short.isEmpty():
        out = out.join(enough, "query_id", "left_semi").unionByName(_search(short, index, k, tables, every=True))
    if n_probes:
        return out.select(result)
    far = asks.join(enough, "query_id").select("query_id", "dim", "vector", "cosine")
    wide = stored(far.mapInArrow(lambda b: _wider(b, tables), ASKS), "wider-probes")
    if wide.isEmpty():
        return out.select(result)
    again = _search(wide, index, k, tables, every=False)
    return out.join(wide.select("query_id").distinct(), "query_id", "left_anti").unionByName(again).select(result)


def op2_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
