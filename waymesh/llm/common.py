"""What the corpus operators share: tables, durable intermediate results, shared files."""

from __future__ import annotations

import atexit
import ctypes
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of df has them (case does not count)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def shared_dir(spark: SparkSession) -> str:
    """URI of the folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only where the session names none and runs on one machine (tests) a local folder is made and set; on a cluster
    that is an error, for other machines could not see what is written there.
    """
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


def fresh_path(spark: SparkSession, kind: str) -> str:
    """A new path in the shared folder, removed when the driver ends, whether or not the session still runs then."""
    path = f"{shared_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"

    def remove() -> None:
        from pyarrow import fs

        try:
            files, at = filesystem(path)
            if files.get_file_info(at).type != fs.FileType.NotFound:
                files.delete_dir(at)
        except (OSError, ValueError):  # scratch space in a store that pyarrow can not open, or already gone
            return

    atexit.register(remove)
    return path


def durable(df: DataFrame, kind: str = "step") -> DataFrame:
    """Write a step to the shared folder as Parquet and read it back: lineage ends here, and a lost
    executor costs no recomputation of what came before."""
    path = fresh_path(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Return memory that the allocators keep to the system: a Python worker lives on after its task, beside others."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def filesystem(uri: str):
    """(pyarrow filesystem, path in it) for a URI of the shared folder; works on executors too."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri)


def publish(uri: str, write) -> None:
    """Write a file under a name of this attempt, then rename it: readers see whole files only, and a
    repeated task replaces its own file with equal bytes."""
    files, path = filesystem(uri)
    parent = path.rsplit("/", 1)[0]
    files.create_dir(parent, recursive=True)
    own = f"{parent}/.{uuid.uuid4().hex}.part"
    with files.open_output_stream(own) as out:
        write(out)
    files.move(own, path)
