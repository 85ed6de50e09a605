"""Files that tasks write to shared storage."""

from __future__ import annotations

import uuid

from pyarrow import fs


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """(file system, path in it); a plain path is a local one."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = uri.replace("file:/", "file:///", 1)
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri.removeprefix("file:")


def write_whole(uri: str, parts) -> int:
    """Write byte strings to a file that appears, or is replaced, as a whole. Returns its size."""
    files, path = filesystem(uri)
    folder, _, name = path.rpartition("/")
    files.create_dir(folder, recursive=True)
    own, size = f"{folder}/.{name}.{uuid.uuid4().hex}", 0
    with files.open_output_stream(own) as out:
        for part in parts:
            out.write(part)
            size += len(part)
    files.move(own, path)
    return size
