"""Reading the given tables, naming shared work tables, shipping the package."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerkit.session import scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared folder and read it back: later steps
    reread the table, so a lost executor costs no recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ship(spark: SparkSession) -> None:
    """Send this library to the Python workers, once for each application, so
    that functions of its modules run there without an installation."""
    import layerkit

    sc = spark.sparkContext
    if getattr(sc, "_layerkit_shipped", False):
        return
    top = os.path.dirname(layerkit.__path__[0])
    name = os.path.join(tempfile.mkdtemp(prefix="layerkit-ship-"), "layerkit.zip")
    with zipfile.ZipFile(name, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(layerkit.__path__[0]):
            for f in sorted(files):
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    z.write(path, os.path.relpath(path, top))
    sc.addPyFile(name)
    sc._layerkit_shipped = True
