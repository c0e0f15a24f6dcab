"""Session builder and lineage helpers.

Operators never read the wall clock: ``as_of``, ``batch_id``, ``salt`` and
``seed`` are always passed in, so a rerun gives the same result.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(
    master: str | None = None,
    app_name: str = "layerkit",
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Return a session with the settings the operators assume.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` to
    the data (about 128-256 MB of shuffle data per partition); AQE then
    coalesces small partitions and splits skewed join partitions at runtime.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for checkpoints and scratch tables.

    Read from ``spark.checkpoint.dir``. Only when it is unset on a local master
    (one machine: tests, trials) a fresh folder is made and set on the session;
    on a cluster a machine-local folder would be another one on each executor,
    so an unset option raises.
    """
    d = spark.conf.get(CHECKPOINT_CONF, None)
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="layerkit-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, d)
    try:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(d)
    except Exception:  # Spark Connect has no SparkContext
        pass
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder (never machine-local on a cluster)."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Materialise ``df`` to the shared checkpoint folder (survives executor loss)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ship_package(spark: SparkSession) -> None:
    """Send this library to the Python workers, once for each application, so
    that functions of its modules run there without an installation."""
    import layerkit

    sc = spark.sparkContext
    if getattr(sc, "_layerkit_shipped", False):
        return
    top = os.path.dirname(layerkit.__path__[0])
    folder = tempfile.TemporaryDirectory(prefix="layerkit-ship-")  # goes when the driver ends
    name = os.path.join(folder.name, "layerkit.zip")
    with zipfile.ZipFile(name, "w", zipfile.ZIP_DEFLATED) as z:
        for at, _, files in os.walk(layerkit.__path__[0]):
            for f in sorted(files):
                if f.endswith(".py"):
                    path = os.path.join(at, f)
                    z.write(path, os.path.relpath(path, top))
    sc.addPyFile(name)
    sc._layerkit_shipped = folder


def least_tasks(spark: SparkSession) -> int:
    """Tasks that keep every core busy, the slower ones too."""
    return 4 * spark.sparkContext.defaultParallelism


def conf_bytes(spark: SparkSession, key: str) -> int:
    """A setting that is a number of bytes, with or without a unit."""
    number, unit = re.match(r"(-?\d+)([kmgtp]?)", spark.conf.get(key).strip().lower()).groups()
    return int(number) << 10 * (" kmgtp".index(unit) if unit else 0)


@contextmanager
def set_inside(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings of the session that hold inside; the former ones come back."""
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


BATCH_ROWS_CONF, BATCH_BYTES_CONF = (f"spark.sql.execution.arrow.max{x}PerBatch" for x in ("Records", "Bytes"))


def _batch_limits(spark: SparkSession, rows: int, size: int) -> dict[str, str]:
    now = int(spark.conf.get(BATCH_ROWS_CONF)), conf_bytes(spark, BATCH_BYTES_CONF)
    rows, size = (min(x, y) if x > 0 else y for x, y in zip(now, (rows, size)))
    return {BATCH_ROWS_CONF: str(rows), BATCH_BYTES_CONF: str(size)}


def batches_within(spark: SparkSession, rows: int, size: int):
    """Inside, Python workers get batches of at most about so many rows and bytes."""
    return set_inside(spark, _batch_limits(spark, rows, size))


#: Texts are worked on by about a megabyte: larger batches only take memory, of the
#: executor's buffers and several times over of each Python worker.
TEXT_BATCH = 10_000, 1 << 20


def small_text_batches(spark: SparkSession) -> None:
    """From now on, Python workers get at most ``TEXT_BATCH`` at a time: for
    applications whose frames are run after the function that made them has ended."""
    for k, v in _batch_limits(spark, *TEXT_BATCH).items():
        spark.conf.set(k, v)


LISTING_CONF = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def listed_in_few_tasks(spark: SparkSession):
    """Inside, files and folders are listed by ``least_tasks`` tasks at most, not by
    one for each path: every task sends the driver some KB besides what it lists."""
    return set_inside(spark, {LISTING_CONF: str(min(int(spark.conf.get(LISTING_CONF)), least_tasks(spark)))})


def env_secret(name: str) -> str:
    """A secret from the environment; raises when unset or empty."""
    value = os.environ.get(name, "")
    if not value:
        raise RuntimeError(f"environment variable {name} is not set")
    return value


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin ``df`` over at least ``min_partitions`` tasks (default: the
    cluster's default parallelism) *only* when it has fewer partitions — for
    small inputs feeding CPU-heavy text work. Large inputs already have many
    splits and are returned unchanged (no extra shuffle)."""
    spark = df.sparkSession
    try:
        target = min_partitions or spark.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:  # Spark Connect: no RDD access
        return df
    return df.repartition(target) if have < target else df
