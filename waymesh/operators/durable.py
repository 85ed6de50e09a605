"""Intermediate results that survive a lost executor: Parquet in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from waymesh.sources.files import filesystem


def shared_dir(spark: SparkSession) -> str:
    """URI of the shared folder, ``spark.checkpoint.dir`` of the session. Only where the session names none and runs on
    one machine (tests) a local folder is made and set; on a cluster that is an error, for other machines could not
    see what is written there."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is not set: a cluster needs a shared folder for intermediate results")
        own = tempfile.mkdtemp(prefix="waymesh-shared-")
        atexit.register(shutil.rmtree, own, True)
        named = "file://" + own
        sc.setCheckpointDir(named)
    return named if "://" in named or named.startswith("file:") else f"file://{os.path.abspath(named)}"


#: The paths of steps written inside ``settled``.
_STEPS: ContextVar[list[str] | None] = ContextVar("steps", default=None)
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def removed(path: str) -> None:
    """Remove a scratch folder; nothing happens where it has gone already."""
    try:
        files, at = filesystem(path)
        if files.get_file_info(at).type != fs.FileType.NotFound:
            files.delete_dir(at)
    except (OSError, ValueError):  # scratch space in a store that pyarrow can not open, or already gone
        return


def fresh_path(spark: SparkSession, kind: str) -> str:
    """A new path in the shared folder, removed when the driver ends, whether or not the session still runs then."""
    path = f"{shared_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"
    atexit.register(removed, path)
    return path


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside go when the write is done, not when the driver happens to collect garbage."""
    before = spark.conf.get(_SHUFFLES_GO, None)
    spark.conf.set(_SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.unset(_SHUFFLES_GO) if before is None else spark.conf.set(_SHUFFLES_GO, before)


def checkpointed(df: DataFrame, kind: str = "step") -> DataFrame:
    """Write a step as Parquet and read it back: lineage ends here, and its size is known to what follows."""
    path = fresh_path(df.sparkSession, kind)
    with _shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    if (steps := _STEPS.get()) is not None:
        steps.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` returns, checkpointed. The steps that it checkpointed on the way are removed then, so no other
    frame may read them."""
    token = _STEPS.set([])
    try:
        made, passed = make(), _STEPS.get()
    finally:
        _STEPS.reset(token)
    out = checkpointed(made)
    for path in passed:
        removed(path)
    return out
