"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
# Parts that tables are dealt into on reading; unset, they come as their files split.
SPREAD_KEY = "spark.posttags.spread"

_open_scopes: list[list[str]] = []


def local_session(cpus: int | str = "*", app: str = "posttags") -> SparkSession:
    """A single-machine session for tests and the bench; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8" if cpus == "*" else str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config(SPREAD_KEY, "8" if cpus == "*" else str(cpus))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` dealt into as many parts as the session asks for.

    For sessions whose tables are single files of one row group, which no scan can split.
    """
    parts = rows.sparkSession.conf.get(SPREAD_KEY, None)
    return rows.repartition(int(parts), *keys) if parts else rows


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, which
    has a single machine, may fall back to a temporary folder.
    """
    named = spark.conf.get(CHECKPOINT_KEY, None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="posttags-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; runs never overwrite each other's stages."""
    path = f"{shared_dir(spark)}/posttags/{name}-{uuid.uuid4().hex}"
    for made in _open_scopes:
        made.append(path)
    return path


@contextmanager
def stage_scope(spark: SparkSession) -> Iterator[None]:
    """Removes the stages made within it at its end; results must be written by then."""
    made: list[str] = []
    _open_scopes.append(made)
    try:
        yield
    finally:
        _open_scopes[:] = [scope for scope in _open_scopes if scope is not made]
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        for path in made:
            place = hadoop.Path(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts lineage so that a lost executor costs a re-read rather than a re-run, and
    gives Spark the real size of the table when it chooses a join.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
