"""Files that tasks write and read below the session's shared folder."""

from __future__ import annotations

import os
import tempfile

import numpy as np


def filesystem(uri: str):
    """(pyarrow filesystem, path) of a shared folder: file:, hdfs:, s3: and the like."""
    from pyarrow import fs

    if ":/" not in uri:
        uri = f"file://{os.path.abspath(uri)}"
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


def memory_map(uri: str, name: str, dtype) -> np.ndarray:
    """File ``name`` of folder ``uri`` as a read-only memory-mapped array.

    On a mounted folder the file itself is mapped. Elsewhere it is copied to
    the worker's temporary folder first, whose name is removed once mapped, so
    nothing is left behind.
    """
    from pyarrow import fs

    store, path = filesystem(uri)
    path = f"{path}/{name}"
    if store.get_file_info(path).size == 0:
        return np.empty(0, dtype)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, dtype, "r")
    handle, local = tempfile.mkstemp()
    os.close(handle)
    try:
        fs.copy_files(path, local, source_filesystem=store,
                      destination_filesystem=fs.LocalFileSystem())
        return np.memmap(local, dtype, "r")
    finally:
        os.unlink(local)
