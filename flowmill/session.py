"""Session defaults and the shared folder for tables that cut lineage."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def _half_of_memory() -> str:
    """Leaves the other half to the Python workers and the system."""
    return f"{os.sysconf('SC_PAGE_SIZE') * os.sysconf('SC_PHYS_PAGES') >> 21}m"


def local_session(cores: str | int = "*", app: str = "flowmill", memory: str | None = None) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    memory = memory or _half_of_memory()
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for name, value in DEFAULTS.items():
        builder = builder.config(name, value)
    builder = builder.config("spark.driver.memory", memory).config("spark.sql.shuffle.partitions", "8")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for intermediate tables.

    It is named by ``spark.checkpoint.dir``. Only a local session may do without: it gets a
    temporary folder, which would be wrong on a cluster because a lost machine takes it along.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):  # "local-cluster" has executors of its own
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _made:
        _made[application] = tempfile.mkdtemp(prefix="flowmill-")
    return _made[application]


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    for held in _scopes.get():
        held.append(path)
    return path


_made: dict[str, str] = {}  # temporary folders of local applications
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())  # of this thread only


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes at its end the intermediate tables that were written within it; results that read them are gone then."""
    made: list[str] = []
    before = _scopes.set((*_scopes.get(), made))
    try:
        yield
    finally:
        _scopes.reset(before)
        for path in made:
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Gives a setting a value for the jobs within, unless the session has one of its own."""
    if spark.conf.get(name, None) is not None:
        yield
        return
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name)


def materialize(df: DataFrame, name: str, **options: str | int) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; ``options`` are those of the writer.

    Used where several jobs read the same shuffled result. A parquet table survives lost
    executors and keeps column pruning for the jobs that follow.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
