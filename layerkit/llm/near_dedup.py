"""Near-duplicate documents: MinHash, banding, verification, components.

1. Each text becomes its set of distinct word shingles (64-bit hashes), a digest
   of that set, 128 universal-hash minima and 32 band keys of 4 minima each. At
   a similarity of 0.8 a pair misses all bands with probability 5e-8.
2. Documents with equal sets are one class, named by its smallest doc_id; only
   classes go on, so thousands of copies cost one row per partition.
3. Classes that share a band key hang on the smallest class of that key: edges of
   a star, never all pairs. Components of this graph are the clusters inside
   which links can be.
4. A cluster of more than ``BLOCK`` classes is dealt into blocks by hash, and each
   pair of blocks is a cell of its own, so that no task holds a whole cluster.
   In a cell, pairs that share a band, whose sizes allow the similarity and whose
   signatures agree well enough are confirmed on their full sets. Links that
   join what the cell has already joined aren't looked at: components need only
   a spanning forest.
5. Components of the confirmed links give each document its component.

Defined results: null and empty texts, and texts without words, have an empty
set and are linked with nothing; rows with a null id have no component and are
kept; repeated rows give one result each; equal ids with different texts are
judged by their own text; an empty table gives an empty result. Other columns
are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerkit.llm.components import components
from layerkit.llm.tables import free_name, read_table, ship, stored
from layerkit.llm.words import mix, slices, split_words, windows, word_hashes
from layerkit.session import TEXT_BATCH, batches_within

BANDS, ROWS = 32, 4
MINIMA = BANDS * ROWS
#: Classes of a cluster that one task holds of either side of a cell.
BLOCK = 500

_rng = np.random.Generator(np.random.PCG64(8))
_FACTORS = _rng.integers(1, 2**64, size=MINIMA, dtype=np.uint64, endpoint=False) | np.uint64(1)
_SHIFTS = _rng.integers(0, 2**64, size=MINIMA, dtype=np.uint64, endpoint=False)

SIGNATURES = "doc_id bigint, n_shingles bigint, set_key binary, minima binary, bands array<bigint>"


def least_agreement(percent: int) -> int:
    """Agreeing minima that a confirmed pair has at least: six standard
    deviations below the mean at ``percent`` similarity."""
    p = percent / 100
    return int(MINIMA * p - 6 * (MINIMA * p * (1 - p)) ** 0.5)


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    w = split_words(texts, lower=True)
    runs, first = windows(w, word_hashes(w), size, short=True)
    for a, b in zip(first[:-1], first[1:]):
        yield np.unique(runs[a:b])


def _sign(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Minima (sets by MINIMA, 32 bits each) and band keys of non-empty sets."""
    flat = np.concatenate(sets)
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets[:-1]], dtype=np.int64)])
    minima = np.empty((len(sets), MINIMA), dtype=np.uint32)
    hashed = np.empty_like(flat)
    for k in range(MINIMA):
        np.multiply(flat, _FACTORS[k], out=hashed)
        np.add(hashed, _SHIFTS[k], out=hashed)
        minima[:, k] = np.minimum.reduceat(hashed, first) >> np.uint64(32)
    return minima, band_keys(minima)


def band_keys(minima: np.ndarray) -> np.ndarray:
    """One key for each band of ``ROWS`` minima, different bands' keys apart."""
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(minima), BANDS)).copy()
    for k in range(ROWS):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + minima[:, k::ROWS])
    return keys.view(np.int64)


def _signature_batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "_text"):
        sets = list(shingle_sets(b.column(1), size))
        full = [s for s in sets if len(s)]
        minima, bands = _sign(full) if full else (np.zeros((0, MINIMA), np.uint32), np.zeros((0, BANDS), np.int64))
        at = iter(range(len(full)))
        rows = [next(at) if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays([
            b.column(0),
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
            pa.array([None if r is None else minima[r].tobytes() for r in rows], pa.binary()),
            pa.array([None if r is None else bands[r] for r in rows], pa.list_(pa.int64())),
        ], names=["doc_id", "n_shingles", "set_key", "minima", "bands"])


def signatures(docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = 4) -> DataFrame:
    """One row per document: set size, set digest, minima and band keys."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("_text"))
    return rows.mapInArrow(lambda batches: _signature_batches(batches, size), SIGNATURES)


def _clusters(nodes: DataFrame) -> DataFrame:
    """``node``, ``cluster``, ``blocks`` of the classes that share a band key
    with another class, directly or through others."""
    banded = nodes.select(F.explode("bands").alias("band"), "node")
    shared = banded.groupBy("band").agg(F.min("node").alias("lead"), F.max("node").alias("last")).where("lead <> last")
    stars = banded.join(shared.select("band", "lead"), "band").where("node <> lead").select("node", "lead").distinct()
    found = components(stars, "node", "lead")
    members = found.select("node", F.col("root").alias("cluster"))
    members = members.unionByName(found.select(F.col("root").alias("node"), F.col("root").alias("cluster")).distinct())
    sizes = members.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks"))
    return members.join(sizes, "cluster")


def _cells(docs: DataFrame, nodes: DataFrame, clusters: DataFrame, id_col: str, text: str, size: int) -> DataFrame:
    """Every class of a cluster with its set, once for each cell it is part of."""
    members = clusters.join(nodes.select("node", "minima"), "node")
    rows = docs.select(F.col(id_col).cast("bigint").alias("node"), F.col(text).cast("string").alias("_text")).join(members, "node")
    rows = rows.select("node", "_text", "cluster", "blocks", "minima")

    def with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_text"):
            sets = [s.tobytes() for s in shingle_sets(b.column(1), size)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.binary()), *b.columns[2:]],
                                             names=["node", "shingles", *b.schema.names[2:]])

    rows = rows.mapInArrow(with_sets, "node bigint, shingles binary, cluster bigint, blocks int, minima binary")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.withColumn("other", other)
    return rows.select("cluster", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                       "block", "node", "shingles", "minima")


def _confirm(cell: pa.Table, percent: int, agree: int) -> pa.Table:
    """A spanning forest of the links between the classes of one cell."""
    cell = cell.sort_by("node")
    node = cell.column("node").to_numpy()
    sets = [np.frombuffer(s, dtype=np.uint64) for s in cell.column("shingles").to_pylist()]
    minima = np.frombuffer(b"".join(cell.column("minima").to_pylist()), dtype=np.uint32).reshape(-1, MINIMA)
    bands = band_keys(minima)
    block = cell.column("block").to_numpy()
    low, high = cell.column("low")[0].as_py(), cell.column("high")[0].as_py()
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    m = len(node)

    left, right, like = [], [], []
    for i in range(m - 1):
        near = (bands[i + 1 :] == bands[i]).any(axis=1)
        if low != high:  # pairs inside a block are in that block's own cell
            near &= block[i + 1 :] != block[i]
        a, b = np.minimum(sizes[i], sizes[i + 1 :]), np.maximum(sizes[i], sizes[i + 1 :])
        near &= 100 * a >= percent * b
        j = np.flatnonzero(near) + i + 1
        if len(j):
            same = (minima[j] == minima[i]).sum(axis=1)
            j, same = j[same >= agree], same[same >= agree]
            left.append(np.full(len(j), i))
            right.append(j)
            like.append(same)
    out: list[tuple[int, int]] = []
    if left:
        left, right, like = np.concatenate(left), np.concatenate(right), np.concatenate(like)
        order = np.argsort(-like, kind="stable")
        top = list(range(m))

        def root(x: int) -> int:
            while top[x] != x:
                top[x] = top[top[x]]
                x = top[x]
            return x

        for i, j in zip(left[order].tolist(), right[order].tolist()):
            a, b = root(i), root(j)
            if a == b:
                continue
            shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * shared >= percent * (sizes[i] + sizes[j] - shared):
                top[max(a, b)] = min(a, b)
                if node[i] != node[j]:
                    out.append((int(node[i]), int(node[j])))
    return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = 4, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` for every row:
    documents whose shingle sets have ``100 * intersection >= percent * union``
    are linked, and ``component_id`` is the smallest id reachable."""
    spark = docs.sparkSession
    ship(spark)
    with batches_within(spark, *TEXT_BATCH):  # all of the work in Python is done inside
        signed = stored(signatures(docs, id_col, text, size), "signatures")
        known = signed.where("set_key is not null and doc_id is not null")
        classes = known.groupBy("set_key").agg(F.min("doc_id").alias("node"))
        nodes = known.join(classes.withColumnRenamed("node", "doc_id"), ["set_key", "doc_id"])
        nodes = nodes.dropDuplicates(["doc_id", "set_key"]).select(F.col("doc_id").alias("node"), "minima", "bands")
        cells = _cells(docs, nodes, _clusters(nodes), id_col, text, size)
        agree = least_agreement(percent)
        links = cells.groupBy("cluster", "low", "high").applyInArrow(lambda t: _confirm(t, percent, agree), "a bigint, b bigint")
        joined = components(links, "a", "b")
    found = classes.join(joined, "node", "left").select("set_key", F.coalesce("root", "node").alias("component"))
    out = signed.select("doc_id", "n_shingles", "set_key").join(found, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each near-duplicate group: the one with the
    smallest id. Documents without words and rows with a null id stay; rows that
    repeat an id with an equal text are one document."""
    judged = near_duplicates(docs.select(id_col, text), id_col, text, size, percent)
    gone_id, same = free_name(docs, "_id"), free_name(docs, "_same")
    ids = judged.groupBy(F.col("doc_id").alias(gone_id)).agg(F.max("kept").alias("_kept"))
    gone = ids.where("not _kept").select(gone_id)
    with_id = docs.where(F.col(id_col).isNotNull()).join(gone, F.col(id_col).cast("bigint") == F.col(gone_id), "left_anti")
    once = with_id.withColumn(same, F.xxhash64(text)).dropDuplicates([id_col, same]).drop(same)
    return once.unionByName(docs.where(F.col(id_col).isNull()))


#: DuckDB SQL of the query: every pair of different sets that share a shingle.
ORACLE = r"""
with recursive worded as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
    else list_sort(list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))) end as s from worded),
keyed as (select doc_id, s, len(s) as n, md5(array_to_string(s, chr(10))) as k from sets),
classes as (select k, min(doc_id) as node, any_value(s) as s, any_value(n) as n from keyed where n > 0 group by k),
pieces as (select node, n, unnest(s) as piece from classes),
shared as (
  select a.node as a, b.node as b, any_value(a.n) as na, any_value(b.n) as nb, count(*) as m
  from pieces a join pieces b on a.piece = b.piece and a.node < b.node group by a.node, b.node),
links as (select a, b from shared where 100 * m >= 80 * (na + nb - m)),
edges as (select a, b from links union all select b, a from links),
reach(node, root) as (select node, node from classes union select e.b, r.root from reach r join edges e on r.node = e.a),
roots as (select node, min(root) as root from reach group by node)
select d.doc_id, cast(d.n as bigint) as n_shingles, coalesce(r.root, d.doc_id) as component_id, coalesce(r.root, d.doc_id) = d.doc_id as kept
from keyed d left join classes c on d.n > 0 and c.k = d.k left join roots r on r.node = c.node
"""
