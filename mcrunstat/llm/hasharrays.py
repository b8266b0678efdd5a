"""Sorted hash arrays in the shared folder: written by tasks, memory-mapped by workers.

A set of arrays is a folder of ``<field>-<shard>.npy`` files.  Files are written under a
name of their own and then renamed, so a repeated task only replaces equal contents.
Where the folder is not a local path, workers fetch a copy of a file before mapping it.
"""

from __future__ import annotations

import io
import os
import tempfile
import uuid
from functools import lru_cache

import numpy as np
import pyarrow.fs as pafs


def _local(uri: str) -> str | None:
    if uri.startswith("file:"):
        return "/" + uri[5:].lstrip("/")
    return uri if uri.startswith("/") else None


def save(folder: str, field: str, shard: int, values: np.ndarray) -> None:
    path = _local(folder)
    name = f"{field}-{shard:06d}.npy"
    if path:
        os.makedirs(path, exist_ok=True)
        own = f"{path}/.{uuid.uuid4().hex}.npy"
        np.save(own, values)
        os.replace(own, f"{path}/{name}")
        return
    fs, base = pafs.FileSystem.from_uri(folder)
    fs.create_dir(base, recursive=True)
    buffer = io.BytesIO()
    np.save(buffer, values)
    own = f"{base}/.{uuid.uuid4().hex}.npy"
    with fs.open_output_stream(own) as f:
        f.write(buffer.getbuffer())
    fs.move(own, f"{base}/{name}")


@lru_cache(maxsize=4096)
def load(folder: str, field: str, shard: int) -> np.ndarray | None:
    """The mapped array, or None where the shard has no file."""
    path = _local(folder)
    name = f"{field}-{shard:06d}.npy"
    if path:
        file = f"{path}/{name}"
        return np.load(file, mmap_mode="r") if os.path.exists(file) else None
    fs, base = pafs.FileSystem.from_uri(folder)
    if fs.get_file_info(f"{base}/{name}").type == pafs.FileType.NotFound:
        return None
    with tempfile.NamedTemporaryFile(suffix=".npy") as copy:
        with fs.open_input_stream(f"{base}/{name}") as f:
            while block := f.read(1 << 22):
                copy.write(block)
        copy.flush()
        return np.load(copy.name, mmap_mode="r")  # the mapping outlives the name


def find(keys: np.ndarray | None, wanted: np.ndarray) -> np.ndarray:
    """Index of each wanted key in sorted ``keys``, -1 where absent."""
    if keys is None or not len(keys):
        return np.full(len(wanted), -1, np.int64)
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return np.where(keys[at] == wanted, at, -1)
