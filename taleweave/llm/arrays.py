"""Arrays in the shared folder: written by tasks, memory-mapped by workers."""

from __future__ import annotations

import os
import tempfile
import uuid
from urllib.parse import urlparse

import numpy as np
import zstandard


def _local(path: str) -> str | None:
    parts = urlparse(path)
    return parts.path if parts.scheme in ("", "file") else None


def write_array(path: str, values: np.ndarray) -> None:
    """Write under another name and rename, so a retried task does no harm."""
    if local := _local(path):
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(other := f"{local}.{uuid.uuid4().hex}", "wb") as f:
            np.save(f, values)
        os.replace(other, local)
        return
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path)
    other = f"{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(other) as f:
        np.save(f, values)
    store.move(other, name)


def open_array(path: str) -> np.ndarray:
    """Map an array. One in a store that cannot be mapped is copied first, to
    a file without a name that goes with the worker."""
    if local := _local(path):
        return np.load(local, mmap_mode="r")
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path)
    with store.open_input_stream(name) as f, tempfile.NamedTemporaryFile(suffix=".npy") as copy:
        while block := f.read(1 << 24):
            copy.write(block)
        copy.flush()
        return np.load(copy.name, mmap_mode="r")


def pack(columns: list[np.ndarray]) -> bytes:
    """Whole numbers as compressed byte planes. The first column ascends and is
    kept as differences."""
    first = columns[0].astype(np.uint64)
    parts = [np.diff(first, prepend=np.uint64(0)), *columns[1:]]
    planes = b"".join(c.astype(np.uint64).view(np.uint8).reshape(-1, 8).T.tobytes() for c in parts)
    return zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(payload: bytes, columns: int) -> list[np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload), np.uint8)
    parts = [np.ascontiguousarray(p.T).view(np.uint64).ravel() for p in planes.reshape(columns, 8, -1)]
    return [np.cumsum(parts[0], dtype=np.uint64), *parts[1:]]


def merge(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Rows of several ascending runs with equal first values added up."""
    columns = [np.concatenate(c) for c in zip(*parts)]
    order = np.argsort(columns[0], kind="stable")
    keys = columns[0][order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return [keys[first], *[np.add.reduceat(c[order], first) for c in columns[1:]]]
