"""Session settings, the shared scratch folder and the tables that plans leave in it.

Nothing here is needed when a cluster hands over its own session; the operators only read
``spark.checkpoint.dir`` from it.

Intermediate tables lie in a folder of their application. ``intermediates`` removes those of a
piece of work when it ends, ``remove_intermediates`` all of an application, also of one that is
gone.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from skyledger.folders import remove_folder

# Adaptive execution does the run-time part of the scaling work: it coalesces small shuffle
# partitions, picks broadcast joins by measured size and splits skewed join partitions.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app_name: str = "skyledger", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: there driver and executors are
    one process. Anywhere else an unset folder is an error.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="skyledger-"))
    return context.getCheckpointDir()


def application_dir(spark: SparkSession, application_id: str | None = None) -> str:
    """The folder of an application's intermediate tables, this one's by default."""
    return f"{shared_dir(spark)}/skyledger/{application_id or spark.sparkContext.applicationId}"


class Intermediates:
    """The paths that a piece of work was given, and those of them that outlive it."""

    def __init__(self) -> None:
        self.paths: list[str] = []

    def keep(self, df: DataFrame) -> DataFrame:
        """Leave the tables that ``df`` reads from this scope to the scope around it, or to the session."""
        read = [file.replace("///", "/") for file in df.inputFiles()]
        kept = [p for p in self.paths if any(f"{p.replace('///', '/')}/" in file for file in read)]
        self.paths = [p for p in self.paths if p not in kept]
        outer = _SCOPES.get()[:-1]
        if outer:
            outer[-1].paths += kept
        return df


_SCOPES: ContextVar[tuple[Intermediates, ...]] = ContextVar("scopes", default=())


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[Intermediates]:
    """Remove the tables that are written inside when the block ends, also by an error.

    Plans made inside must have run by then, or be handed to ``keep``. Blocks nest; each owns what
    was written in it and not in an inner one.
    """
    scope = Intermediates()
    token = _SCOPES.set((*_SCOPES.get(), scope))
    try:
        yield scope
    finally:
        _SCOPES.reset(token)
        for path in scope.paths:
            remove_folder(path)


def remove_intermediates(spark: SparkSession, application_id: str | None = None) -> None:
    """Remove all intermediate tables of an application; none of its plans may run after this."""
    remove_folder(application_dir(spark, application_id))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, owned by the innermost ``intermediates`` block if there is one."""
    path = f"{application_dir(spark)}/{name}-{uuid.uuid4().hex}"
    scopes = _SCOPES.get()
    if scopes:
        scopes[-1].paths.append(path)
    return path


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage and fixes every value, so that a value that depends on the physical
    layout (a partition number) cannot change when an executor is lost. Parquet rather than a
    raw checkpoint: later passes read only the columns they need.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
