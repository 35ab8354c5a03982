"""Arrays in a folder that all machines share, written by tasks and memory-mapped by workers."""

from __future__ import annotations

import functools
import io
import re
import uuid

import numpy as np
from pyarrow import fs


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    uri = re.sub(r"^file:/+", "/", uri)
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


def write_array(folder: str, name: str, values: np.ndarray) -> None:
    """Writes an array whole: under a name of its own first, then moved, so that a task that is run
    twice, or lost half-way, leaves no broken file."""
    system, path = _place(folder)
    system.create_dir(path, recursive=True)
    raw = io.BytesIO()
    np.save(raw, np.ascontiguousarray(values))
    own = f"{path}/{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(own) as out:
        out.write(raw.getbuffer())
    system.move(own, f"{path}/{name}.npy")


@functools.lru_cache(maxsize=64)
def _fetched(folder: str, name: str) -> np.ndarray:
    system, path = _place(folder)
    with system.open_input_stream(f"{path}/{name}.npy") as raw:
        return np.load(io.BytesIO(raw.read()))


def map_array(folder: str, name: str) -> np.ndarray:
    """The array, memory-mapped from the shared folder where that is mounted.  From a store without
    files it is fetched into memory instead; a worker keeps a bounded number of such arrays and never
    writes copies to its own disk."""
    system, path = _place(folder)
    if isinstance(system, fs.LocalFileSystem):
        return np.load(f"{path}/{name}.npy", mmap_mode="r")
    return _fetched(folder, name)
