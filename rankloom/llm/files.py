"""Files that tasks write and read in the folder the cluster shares.

Paths are URIs and are opened through Arrow, so the folder may be in any store
it knows. Nothing here is registered anywhere: a task that writes a file returns its
path, and only paths of tasks that succeeded are ever read. What a lost task left
goes with the folder.
"""

from __future__ import annotations

from uuid import uuid4

from pyarrow import fs


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    """Arrow's handle of a folder. Hadoop writes local ones as `file:/x` or without a scheme."""
    path = folder.removeprefix("file:")
    if path.startswith("/"):
        return fs.LocalFileSystem(), "/" + path.lstrip("/")
    return fs.FileSystem.from_uri(folder)


def new_file(folder: str, name: str) -> tuple[fs.FileSystem, str]:
    """The store, and the path in it of a file that no other task has."""
    store, root = _open(folder)
    return store, f"{root.rstrip('/')}/{uuid4().hex}-{name}"


def store_of(folder: str) -> fs.FileSystem:
    return _open(folder)[0]
