"""Mixing sources to target weights by Pfair scheduling.

Every source is a periodic task: with weight w its block j (from 0) may not come
before slot floor(j / w) and must be over by slot ceil((j + 1) / w). The released
block with the earliest deadline takes each slot, so at every slot each source
has had less than one block more or less than its weight's share, however long
the run and however many sources.

Windows come from the weights as they are, in whole numbers of any size, over the
whole run. The schedule is a sequence, so the driver makes it from the sources'
counts, with one entry in a heap for each source, and writes it in pieces of
``PIECE`` blocks; documents never go there. Documents are ranked inside their
source by a hash of their id. Ranks come from counts: documents are dealt by hash
range into buckets of about ``BUCKET_ROWS``, whatever their source, and a
document's rank is its place in the bucket plus its source's documents in the
buckets before. So a source with a third of all rows is spread like any other.
A bucket gets the slots of its blocks with its counts; documents move once.

No row is dropped or repeated. When a source has run out its slots stay empty and
the others keep their proportions.

With given weights, the sources that aren't named share ``other`` by the same
power of their counts as without weights; if that is 0 they follow after the
last block of the named ones.

Defined results: a null source is the source ''; rows with a null id are ranked by
their null's hash; equal ids stand side by side, in any order; an empty table
gives an empty result; a named source without documents leaves its slots empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from heapq import heapify, heappop, heappush
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerkit.llm.tables import read_table
from layerkit.session import scratch_path

BLOCK_ROWS = 16
BUCKET_ROWS = 4000
#: Blocks of the schedule that the driver holds at a time.
PIECE = 500_000
#: File lists up to this length (some 20 MB) are broadcast when rows learn their place.
MAX_FILES = 100_000
#: Without given weights a source's weight is its number of documents to this
#: power: small sources get more than their share, large ones less.
EXPONENT = 0.5
SEED = 20240229


def _check(weights: dict[str, float]) -> None:
    if any(w <= 0 for w in weights.values()):
        raise ValueError("weights must be positive")


def _earliest_deadline_first(shares: list[int], blocks: list[int]) -> Iterator[tuple[int, int, int, int, int]]:
    """Task, block, slot, release and deadline in the order of slots, for tasks of
    ``blocks`` and weights ``share`` / sum of shares, in whole numbers."""
    total = sum(shares)
    waiting: list[tuple[int, int, int]] = []
    ready = [(-(-total // s), k, 0, 0) for k, (s, n) in enumerate(zip(shares, blocks)) if n]
    heapify(ready)
    slot = 0
    while ready or waiting:
        while waiting and waiting[0][0] <= slot:
            release, k, j = heappop(waiting)
            heappush(ready, (-(-(j + 1) * total // shares[k]), k, j, release))
        if not ready:  # slots of sources that have run out
            slot = waiting[0][0]
            continue
        deadline, k, j, release = heappop(ready)
        yield k, j, slot, release, deadline
        if j + 1 < blocks[k]:
            heappush(waiting, ((j + 1) * total // shares[k], k, j + 1))
        slot += 1


def schedule(weights: list[float], blocks: list[int]) -> Iterator[tuple[int, int, int, int, int]]:
    """As above, for weights that need not add up to 1 and count exactly as the
    fractions that they are. Tasks of weight 0 follow after all others, by the
    root of their blocks."""
    end = 0
    for some in ([k for k, w in enumerate(weights) if w > 0], [k for k, w in enumerate(weights) if w <= 0]):
        exact = [Fraction(weights[k] if weights[k] > 0 else max(blocks[k], 1) ** EXPONENT) for k in some]
        scale = max((w.denominator for w in exact), default=1)  # powers of 2, as of any float
        begin = end
        for k, j, slot, release, deadline in _earliest_deadline_first([int(w * scale) for w in exact], [blocks[k] for k in some]):
            end = begin + slot + 1
            yield some[k], j, begin + slot, begin + release, begin + deadline


def _tasks(counts: dict[str, int], weights: dict[str, float] | None, other: float) -> tuple[list[str], list[float]]:
    """Sources and their weights; the source None stands for others that don't occur."""
    if weights is None:
        names = sorted(counts)
        return names, [counts[s] ** EXPONENT for s in names]
    _check(weights)
    rest = sorted(counts.keys() - weights.keys())
    whole = sum(counts[s] ** EXPONENT for s in rest)
    shared = [max(other, 0.0) * counts[s] ** EXPONENT / whole for s in rest]
    if not rest and other > 0:
        rest, shared = [None], [other]
    return [*weights, *rest], [*map(float, weights.values()), *shared]


SCHEDULE = pa.schema([("_source", pa.string()), ("class", pa.int32()), ("block", pa.int64()), ("slot", pa.int64()), ("release", pa.int64()), ("deadline", pa.int64())])


def _written_schedule(spark: SparkSession, counts: dict[str, int], weights: dict[str, float] | None, other: float, block_rows: int) -> DataFrame:
    """One row for each block, written in pieces under the shared folder."""
    names, shares = _tasks(counts, weights, other)
    number = {s: k for k, s in enumerate(sorted(s for s in names if s is not None))}
    labels = [number.get(s, len(number)) for s in names]
    all_slots = schedule(shares, [-(-counts.get(s, 0) // block_rows) for s in names])
    path = scratch_path(spark, "mixing-schedule")
    while True:
        piece = list(islice(all_slots, PIECE))
        rows = list(zip(*piece)) or [()] * 5
        columns = [[names[k] for k in rows[0]], [labels[k] for k in rows[0]], *rows[1:]]
        table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SCHEDULE)], schema=SCHEDULE)
        written = spark.createDataFrame(table)
        written.write.mode("append").parquet(path)
        if len(piece) < PIECE:
            return spark.read.schema(written.schema).parquet(path)


def mixed(docs: DataFrame, id_col: str = "doc_id", source: str = "source", weights: dict[str, float] | None = None, other: float = 0.0,
          block_rows: int = BLOCK_ROWS, seed: int = SEED) -> DataFrame:
    """``row`` (all columns of ``docs`` as a struct), ``class`` (its source's number
    by name), ``block`` (of its
    source), ``slot``, ``release``, ``deadline`` and ``position``, by which the
    rows are in mixed order."""
    named = F.coalesce(F.col(source).cast("string"), F.lit(""))
    sizes = {r["_source"]: r["n"] for r in docs.groupBy(named.alias("_source")).agg(F.count(F.lit(1)).alias("n")).toLocalIterator()}
    buckets = max(1, -(-sum(sizes.values()) // BUCKET_ROWS))
    slots = _written_schedule(docs.sparkSession, sizes, weights, other, block_rows)
    hashed = F.xxhash64(F.col(id_col), F.lit(seed))
    share = F.col("_hash").cast("double") / F.lit(2.0**64) + 0.5
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), named.alias("_source"), hashed.alias("_hash"))
    keyed = keyed.withColumn("_bucket", F.least(F.floor(share * buckets), F.lit(buckets - 1)).cast("int"))

    counts = keyed.groupBy("_source", "_bucket").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.withColumn("_before", F.coalesce(before, F.lit(0)))
    # A source's documents in a bucket have ranks, and so blocks, in sequence.
    first, last = F.floor(F.col("_before") / block_rows), F.floor((F.col("_before") + F.col("n") - 1) / block_rows)
    held = counts.select("_source", "_bucket", "_before", F.explode(F.sequence(first.cast("bigint"), last.cast("bigint"))).alias("block"))
    held = held.join(slots, ["_source", "block"]).groupBy("_source", "_bucket").agg(
        F.first("_before").alias("_before"), F.array_sort(F.collect_list(F.struct("block", "slot", "release", "deadline", "class"))).alias("_blocks"))

    # A bucket's slots go in with its documents, as one row for each source in it.
    kinds = keyed.schema["row"].dataType
    given = held.select(F.lit(None).cast(kinds).alias("row"), "_source", F.lit(None).cast("bigint").alias("_hash"), "_bucket", "_before", "_blocks")
    dealt = keyed.withColumn("_before", F.lit(None).cast("bigint")).withColumn("_blocks", F.lit(None).cast(given.schema["_blocks"].dataType))
    dealt = dealt.unionByName(given).repartition("_bucket")
    # Their row stands first (its hash is null) and its place is 0.
    inside = Window.partitionBy("_bucket", "_source").orderBy(F.asc_nulls_first("_hash"))
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = dealt.select("row", "_hash", (F.row_number().over(inside) - 2).alias("_place"),
                          F.first("_before", ignorenulls=True).over(so_far).alias("_before"), F.first("_blocks", ignorenulls=True).over(so_far).alias("_blocks"))
    ranked = ranked.where("_hash is not null").withColumn("_rank", F.col("_before") + F.col("_place"))
    at = (F.floor(F.col("_rank") / block_rows) - F.floor(F.col("_before") / block_rows) + 1).cast("int")
    out = ranked.select("row", "_rank", F.element_at("_blocks", at).alias("_b"))
    return out.select("row", "_b.class", "_b.block", "_b.slot", "_b.release", "_b.deadline",
                      (F.col("_b.slot") * block_rows + F.col("_rank") % block_rows).alias("position"))


def in_mixed_order(docs: DataFrame, id_col: str = "doc_id", source: str = "source", weights: dict[str, float] | None = None, other: float = 0.0) -> DataFrame:
    """All rows and columns of ``docs``, dealt by ranges of their position and
    sorted inside: written out, its files in order are the mixture."""
    out = mixed(docs, id_col, source, weights, other)
    return out.repartitionByRange("position").sortWithinPartitions("position").select("row.*")


def place_in_files(docs: DataFrame, name: str = "position") -> DataFrame:
    """``docs`` as read from files, with ``name``: a row's place, from 0, in the
    files in name order, whatever the order in which they are read."""
    given = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c != name), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    files = docs.select(F.col("_metadata.file_path").alias("_file")).groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    # One row for each file; part numbers of more digits make longer names.
    order = Window.partitionBy(F.lit(0)).orderBy(F.length("_file"), "_file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("_file", F.coalesce(F.sum("_n").over(order), F.lit(0)).alias("_before"))
    files = F.broadcast(files) if len(docs.inputFiles()) <= MAX_FILES else files
    placed = given.join(files, "_file").withColumn(name, F.col("_before") + F.col("_row"))
    return placed.drop("_file", "_row", "_before")


def op3_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixed(docs).select("row.doc_id", "row.source", "block", "slot", "release", "deadline", "position")
