"""CSV records whose quoted fields hold line breaks.

A physical line begins either a record or inside a quoted field. What a line makes
of either beginning is a function of two states, and these functions compose: each
file split is summed up as one function by the task that reads it, the splits'
functions are applied one after the other, and with its true beginning known each
split is cut into records by itself. A quote opens a field only where the field
begins, so that a stray quote inside a field doesn't turn the rest of the file
inside out. Records that go over the end of a split are put together from their
pieces; no task holds a file.

A field that is never closed takes in the rest of its file; it becomes one open
record, of which the first line is kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerkit.session import ship_package
from layerkit.sources.csv_lines import BLOCK, FILE, LINE, OPEN, read_tasks

_INSIDE = re.compile(r'(?:[^"]++|"")*+')
_LEFT_OPEN = re.compile(r'(?:(?:"(?:[^"]++|"")*+"[^,]*+|[^",][^,]*+|),)*+"(?:[^"]++|"")*+\Z')

SPLIT_SUM = f"{FILE} string, {BLOCK} bigint, lines bigint, from_start boolean, from_inside boolean, begins boolean"
PIECES = f"{FILE} string, {BLOCK} bigint, {LINE} bigint, value string, owner bigint, {OPEN} boolean"


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted field is open after a line, by whether one was before it."""
    if '"' not in line:
        return inside
    at = 0
    if inside:
        at = _INSIDE.match(line).end()
        if at == len(line):
            return True
        at = line.find(",", at + 1) + 1  # the rest of the field that ends here
        if not at:
            return False
    return _LEFT_OPEN.match(line, at) is not None


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.Array, np.ndarray, bool]]:
    """Stretches of lines of one split: file, block, lines, which of them hold a
    quote, whether the stretch begins the split."""
    before = None
    for b in batches:
        if not b.num_rows:
            continue
        names, blocks, lines = b.column(0), b.column(1).to_numpy(), b.column(2)
        change = np.ones(b.num_rows, dtype=bool)
        same = pc.equal(names.slice(1), names.slice(0, b.num_rows - 1)).to_numpy(zero_copy_only=False)
        change[1:] = ~same | (blocks[1:] != blocks[:-1])
        at = [*np.flatnonzero(change).tolist(), b.num_rows]
        quoted = pc.match_substring(lines, '"').to_numpy(zero_copy_only=False)
        for i, j in zip(at, at[1:]):
            key = (names[i].as_py(), int(blocks[i]))
            yield *key, lines.slice(i, j - i), np.flatnonzero(quoted[i:j]), key != before
            before = key


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split: its lines, what follows from either beginning, and
    whether a record begins in it if it begins inside a field."""
    rows: list[list] = []
    for name, block, lines, quoted, new in _runs(batches):
        if new:
            rows.append([name, block, 0, False, True, None])
        row = rows[-1]
        for i in quoted.tolist():
            line = lines[i].as_py()
            same = row[3] == row[4]
            row[3] = ends_inside(line, row[3])
            row[4] = row[3] if same else ends_inside(line, row[4])
            if not row[4] and row[5] is None:
                row[5] = row[2] + i + 1  # the line, from 0, that begins a record
        row[2] += len(lines)
    columns = list(zip(*([*r[:5], r[5] is not None and r[5] < r[2]] for r in rows))) or [[]] * 6
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_()))],
                                     names=[FILE, BLOCK, "lines", "from_start", "from_inside", "begins"])


def split_states(sums: Sequence) -> tuple[dict, bool]:
    """For each (file, block): whether it begins inside a field, the lines before
    it, the block in which the record that is open there began, and whether the
    record left open at its end is never closed. And whether any record goes over
    the end of a split."""
    states, pieces = {}, False
    by_file: dict[str, list] = {}
    for r in sums:
        by_file.setdefault(r[FILE], []).append(r)
    for name, rows in by_file.items():
        rows.sort(key=lambda r: r[BLOCK])
        inside, before, owner = False, 0, -1
        for r in rows:
            states[name, r[BLOCK]] = [inside, before, owner, False]
            begins, ends = (r["begins"], r["from_inside"]) if inside else (True, r["from_start"])
            if ends and begins:
                owner = r[BLOCK]
            before += r["lines"]
            inside = ends
        for r in rows:
            state = states[name, r[BLOCK]]
            if inside and r[BLOCK] == owner:
                state[3] = True
            if inside and state[0] and state[2] == owner:
                state[2] = -1  # a part of the record that is never closed
            pieces |= state[0] and state[2] >= 0
    return states, pieces


def _cut(batches: Iterator[pa.RecordBatch], states: dict, pieces: bool) -> Iterator[pa.RecordBatch]:
    """The records that lie within a split or, with ``pieces``, the parts of those
    that go over a split's end, with the block in which their record began."""
    out: list[tuple] = []
    open_lines: list[str] = []
    name, block, first, owner, broken = None, -1, 0, None, False

    def close(whole: bool) -> None:
        """The lines gathered are a whole record, or a part of one."""
        nonlocal open_lines
        if not open_lines:
            return
        if broken and not whole and owner == block:
            if not pieces:
                out.append((name, block, first, open_lines[0].removesuffix("\r"), None, True))
        elif whole and owner == block and not pieces:
            out.append((name, block, first, "\n".join(open_lines).removesuffix("\r"), None, False))
        elif pieces and owner >= 0 and not (whole and owner == block):
            out.append((name, block, first, "\n".join(open_lines), owner, False))
        open_lines = []

    def batch() -> pa.RecordBatch:
        columns = list(zip(*out)) or [[]] * 6
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.bool_()))],
                                          names=[FILE, BLOCK, LINE, "value", "owner", OPEN])

    inside, line = False, 0
    for file, at, lines, quoted, new in _runs(batches):
        if new:
            close(whole=not inside)
            name, block = file, at
            inside, line, owner, broken = states[name, block]
            first = line + 1
            if not inside:
                owner = block
        texts = lines.to_pylist()
        after = np.zeros(len(texts), dtype=bool)  # is a field open after this line?
        done = 0
        for i in quoted.tolist():
            after[done:i] = inside
            inside = ends_inside(texts[i], inside)
            after[i] = inside
            done = i + 1
        after[done:] = inside
        for text, more in zip(texts, after.tolist()):
            line += 1
            if owner >= 0:  # not a part of a record that is never closed
                open_lines.append(text)
            if not more:
                close(whole=True)
                owner, first = block, line + 1
        if len(out) >= 10_000:
            yield batch()
    close(whole=not inside)
    yield batch()


def read_records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Every CSV record as ``(_source_file, _line, value, _open)``: the 1-based
    number of its first physical line, its text with the line breaks of its quoted
    fields, and whether it is a record that is never closed (its first line).

    ``path`` goes to Spark's own reader as it is. The text is read twice, and a
    third time if records go over the ends of splits, small splits several by one
    task. One small row per split reaches the driver."""
    ship_package(spark)
    text = spark.read.option("lineSep", "\n").text(path if isinstance(path, str) else list(path))
    raw = text.select(F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK), "value")
    planned = text.rdd.getNumPartitions()
    tasks = read_tasks(spark, planned)
    raw = raw.coalesce(tasks) if tasks < planned else raw
    states, over = split_states(raw.mapInArrow(_sum_up, SPLIT_SUM).collect())
    shared = spark.sparkContext.broadcast(states)
    whole = raw.mapInArrow(lambda b: _cut(b, shared.value, False), PIECES).select(FILE, LINE, "value", OPEN)
    if not over:
        return whole
    parts = raw.mapInArrow(lambda b: _cut(b, shared.value, True), PIECES)
    parts = parts.groupBy(FILE, "owner").agg(F.min(LINE).alias(LINE), F.array_sort(F.collect_list(F.struct(BLOCK, "value"))).alias("parts"))
    joined = F.array_join(F.transform("parts", lambda p: p["value"]), "\n")
    return whole.unionByName(parts.select(FILE, LINE, F.regexp_replace(joined, r"\r\z", "").alias("value"), F.lit(False).alias(OPEN)))
