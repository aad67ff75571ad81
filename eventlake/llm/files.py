"""Files in shared folders, written and read inside Spark tasks.

Paths are those of spark.checkpoint.dir (any scheme that pyarrow.fs knows); a
file appears under its name only when it is complete, so a task that is lost
half-way or run twice does no harm.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

import numpy as np
from pyarrow import fs


def locate(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri("file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path)
    return fs.LocalFileSystem(), path


@contextmanager
def new_file(path: str):
    """An output stream whose content is found at `path` once the block has ended without an error."""
    store, name = locate(path)
    store.create_dir(name.rsplit("/", 1)[0], recursive=True)
    trial = f"{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(trial, compression=None) as out:
        yield out
    store.move(trial, name)


def open_file(path: str):
    """A seekable input file."""
    store, name = locate(path)
    return store.open_input_file(name)


def array(path: str, dtype) -> np.ndarray:
    """A whole file as an array: memory-mapped where the shared folder is mounted, else read once."""
    store, name = locate(path)
    if isinstance(store, fs.LocalFileSystem):
        if not store.get_file_info(name).size:
            return np.zeros(0, dtype)
        return np.memmap(name, dtype, "r")
    with store.open_input_file(name) as f:
        return np.frombuffer(f.read(), dtype)
