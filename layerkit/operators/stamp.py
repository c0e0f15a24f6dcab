"""Provenance stamp for raw (Bronze) tables."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerkit.functions._util import ntz_lit

INGESTED_AT = "_ingested_at"
SOURCE_FILE = "_source_file"
BATCH_ID = "_batch_id"
META_COLUMNS = (INGESTED_AT, SOURCE_FILE, BATCH_ID)


def new_batch_id(now: _dt.datetime | None = None) -> str:
    """``YYYYMMDD-HHMMSS-xxxxxx``: time of the run plus six random hex digits."""
    now = now or _dt.datetime.now()
    return f"{now:%Y%m%d-%H%M%S}-{uuid.uuid4().hex[:6]}"


def stamp(df: DataFrame, source: str | Column, batch_id: str, at: _dt.datetime) -> DataFrame:
    """Append ``_ingested_at``, ``_source_file``, ``_batch_id``.

    All three are literals fixed on the driver once per run, so every row of a
    run agrees and a retried task writes the same values. ``source`` may be a
    Column (e.g. ``_metadata.file_path``) for file sources.
    """
    src = source if isinstance(source, Column) else F.lit(source)
    return df.select(
        *[F.col(c) for c in df.columns if c not in META_COLUMNS],
        ntz_lit(at).alias(INGESTED_AT),
        src.cast("string").alias(SOURCE_FILE),
        F.lit(batch_id).alias(BATCH_ID),
    )
