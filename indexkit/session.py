"""Session construction and lineage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Defaults that matter for every job in the package.  AQE re-plans joins from
# runtime sizes (a shuffle stage that turns out small becomes a broadcast) and
# splits skewed shuffle partitions; the UI stays off (no server).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

#: Folders made by ``written``, by application.
_WRITTEN: dict[str, list[str]] = {}


def get_spark(app: str = "indexkit", master: str | None = None,
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with the package defaults.

    ``master`` and ``shuffle_partitions`` are only meant for local runs and
    tests; on a cluster they come from the submit configuration.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # noqa: BLE001
        pass
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """``spark.checkpoint.dir`` of the session: the shared folder a cluster
    names.  Only a session with a local master may do without; it gets a
    private scratch folder.  On a cluster without the setting this raises: a
    folder of one machine would be invisible to the others."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (no SparkContext in a Connect session)
        sc = None
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path and sc is not None:
        path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        path = fallback or _scratch(sc.master if sc is not None else "")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def _scratch(master: str) -> str:
    """A private folder, for a master that runs in this process only."""
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="indexkit-ckpt-")


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never a
    local checkpoint: executors may be lost)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


#: Session setting that fixes the time of a build (ISO text, UTC).
BUILD_TIME = "indexkit.build.time"


def build_time(spark: SparkSession) -> Column:
    """The build's clock as a literal: the session's ``indexkit.build.time`` or
    else now, fetched once, so all stamps of a build agree."""
    text = spark.conf.get(BUILD_TIME, None)
    at = datetime.fromisoformat(text) if text else datetime.now(timezone.utc)
    at = at if at.tzinfo else at.replace(tzinfo=timezone.utc)
    return F.timestamp_micros(F.lit(int(at.timestamp()) * 1_000_000 + at.microsecond))


#: Partition values that one writing task keeps a file open for.
OPEN_FILES = "64"


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def open_files(spark: SparkSession):
    """Writes with ``partitionBy`` keep up to ``OPEN_FILES`` files open in a task
    instead of sorting its rows by partition value, which holds them all in
    memory; rows of further values are sorted."""
    return _setting(spark, "spark.sql.maxConcurrentOutputFileWriters", OPEN_FILES)


#: Bytes of code beyond which the JVM interprets a method and never compiles it.
COMPILED = "8000"


def compiled(spark: SparkSession):
    """Stages that clean or hash many columns become one generated method too
    large for the JVM to compile; within this they run as projections of small
    methods instead.  Other stages stay as they are."""
    return _setting(spark, "spark.sql.codegen.hugeMethodLimit", COMPILED)


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` once as Parquet under the shared folder of
    ``spark.checkpoint.dir`` and read it back with its schema.  A lost executor
    then costs a re-read.  ``discard_written`` removes the folders."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/indexkit-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def discard_written(spark: SparkSession) -> int:
    """Remove every folder that ``written`` has made in this application; call
    it when the results that read them are stored.  Returns how many there were."""
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        remove(spark, path)
    return len(paths)


def remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def table_path(root: str, name: str) -> str:
    return os.path.join(root, f"{name}.parquet")
