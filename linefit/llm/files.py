"""Files that tasks write to and read from the shared folder."""

from __future__ import annotations


def open_store(path: str):
    """File system and path in it, for a URI that pyarrow knows or an absolute local path."""
    from pyarrow import fs

    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)
