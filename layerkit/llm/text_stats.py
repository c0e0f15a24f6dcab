"""Per-document counts over whole texts, computed in Arrow batches.

One narrow pass: no shuffle, memory bounded by about a megabyte of text (or the
longest single text) and its word arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from layerkit.llm.tables import ship
from layerkit.llm.words import IS_SPACE, slices, span_hashes, split_words, windows, word_hashes

SYMBOLS = "#*$%&|<>"
REPEAT_WINDOW = 5
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_distinct_words", "n_stutters", "n_upper", "n_digits", "n_marks"]

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[ord(c) for c in "!?"]] = True
_CONTINUES = np.zeros(256, dtype=bool)
_CONTINUES[128:192] = True  # UTF-8 bytes that don't begin a code point


def _per_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = np.zeros(len(at) - 1, dtype=np.int64)
    full = np.diff(at) > 0
    if full.any():
        out[full] = np.add.reduceat(flags, at[:-1][full], dtype=np.int64)
    return out


def _repeats(keys: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: is it an equal key's later copy in the same text; does it
    stand there more than once."""
    order = np.lexsort((keys, doc))  # stable: earlier copies first
    k, d = keys[order], doc[order]
    same = np.zeros(len(keys) + 1, dtype=bool)
    same[1:-1] = (k[1:] == k[:-1]) & (d[1:] == d[:-1])
    later, many = np.empty(len(keys), bool), np.empty(len(keys), bool)
    later[order], many[order] = same[:-1], same[:-1] | same[1:]
    return later, many


def text_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """The ``COUNTS`` of each text (null: empty, all zero)."""
    w = split_words(texts)
    n = len(texts)
    hashes, doc = word_hashes(w), w.doc
    count = np.diff(w.first)

    # Lines: cut at \n and at text ends; those without a word don't count.
    breaks = np.flatnonzero(w.data == 10)
    start = np.union1d(w.at[:-1][np.diff(w.at) > 0], breaks + 1)
    start = start[start < len(w.data)]
    end = np.concatenate([start[1:], [len(w.data)]]) if len(start) else start
    end = np.where(np.isin(end - 1, breaks), end - 1, end)
    if len(start):
        worded = np.logical_or.reduceat(~IS_SPACE[w.data], start)
        start, end = start[worded], end[worded]
    line_doc = np.searchsorted(w.at, start, side="right") - 1
    line_later, _ = _repeats(span_hashes(w.data, start, end), line_doc)

    runs, first = windows(w, hashes, REPEAT_WINDOW, short=False)
    run_doc = np.repeat(np.arange(n), np.diff(first))
    _, many = _repeats(runs, run_doc)
    begin = np.flatnonzero(many) - first[run_doc[many]] + w.first[run_doc[many]]
    size = len(hashes) + 1
    cover = np.bincount(begin, minlength=size) - np.bincount(begin + REPEAT_WINDOW, minlength=size)
    covered = np.cumsum(cover[:-1]) > 0

    later, _ = _repeats(hashes, doc)
    stutter = np.zeros(len(hashes), dtype=bool)
    stutter[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])

    def tally(d: np.ndarray) -> np.ndarray:
        return np.bincount(d, minlength=n).astype(np.int64)

    return {
        "n_words": count.astype(np.int64),
        "word_chars": _per_text(~IS_SPACE[w.data] & ~_CONTINUES[w.data], w.at),
        "n_symbols": _per_text(_SYMBOL[w.data], w.at),
        "n_dup_lines": tally(line_doc[line_later]),
        "n_repeat_words": tally(doc[covered]),
        "n_lines": tally(line_doc),
        "n_distinct_words": count - tally(doc[later]),
        "n_stutters": tally(doc[stutter]),
        "n_upper": _per_text(_UPPER[w.data], w.at),
        "n_digits": _per_text(_DIGIT[w.data], w.at),
        "n_marks": _per_text(_MARK[w.data], w.at),
    }


def with_counts(docs: DataFrame, keep: list[str], text: str = "text", keep_text: bool = False) -> DataFrame:
    """``keep`` columns, the text as ``_text`` if asked for, and the ``COUNTS`` of
    each row's text. Any other column, whatever its name, is left out; names in
    ``keep`` must be neither ``_text`` nor ``COUNTS``."""
    ship(docs.sparkSession)
    rows = docs.select(*keep, F.col(text).cast("string").alias("_text"))
    n = len(rows.schema.fields) - (not keep_text)
    kinds = StructType([*rows.schema.fields[:n], *(StructField(c, LongType()) for c in COUNTS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_text"):
            counts = text_counts(b.column(b.num_columns - 1))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:n], *(pa.array(counts[c], pa.int64()) for c in COUNTS)],
                names=[*b.schema.names[:n], *COUNTS])

    return rows.mapInArrow(run, kinds)
