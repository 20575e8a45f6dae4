"""Files in the shared folder, written and read by executors through its file system."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyarrow import fs


def at(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it of a URI or a plain path."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


@contextmanager
def committed(path: str):
    """A stream whose bytes appear under `path` only when all are written: an attempt that is
    lost leaves no part of a file, and one that is repeated replaces the file by its equal."""
    system, name = at(path)
    folder, _, base = name.rpartition("/")
    system.create_dir(folder, recursive=True)
    temporary = f"{folder}/.{base}.{uuid.uuid4().hex}"
    with system.open_output_stream(temporary, compression=None) as out:
        yield out
    system.move(temporary, name)
