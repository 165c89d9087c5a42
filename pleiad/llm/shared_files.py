"""Files in the folder that driver and executors share, written and memory-mapped by Python workers."""

from __future__ import annotations

import os
import tempfile
import uuid
from urllib.parse import unquote, urlparse

import numpy as np


def local(uri: str) -> str | None:
    """The path of a file: address or a plain path; None for other stores."""
    at = urlparse(uri)
    if at.scheme in ("", "file"):
        return unquote(at.path) if at.scheme else uri
    return None


def write(uri: str, data: bytes) -> None:
    """Whole or not at all, so that a task that runs again replaces what it left."""
    path = local(uri)
    if path is None:
        import pyarrow.fs as fs

        store, path = fs.FileSystem.from_uri(uri)
        with store.open_output_stream(path) as f:
            f.write(data)
        return
    os.makedirs(os.path.dirname(path), exist_ok=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "wb") as f:
        f.write(data)
    os.replace(part, path)


def mapped(uri: str) -> np.memmap | np.ndarray:
    """Bytes of a file, mapped.

    One in a store that can't be mapped is read through a file that this worker alone has and that has no name by the
    time it is mapped: a cache of what stays whole in the store, lost with the worker and read again by another. A
    missing file raises.
    """
    path = local(uri)
    if path is None:
        import pyarrow.fs as fs

        store, at = fs.FileSystem.from_uri(uri)
        with store.open_input_stream(at) as f, tempfile.NamedTemporaryFile(delete=False) as own:
            while block := f.read(1 << 24):
                own.write(block)
        data = np.memmap(own.name, np.uint8, "r") if os.path.getsize(own.name) else np.zeros(0, np.uint8)
        os.unlink(own.name)  # the mapping holds it
        return data
    return np.memmap(path, np.uint8, "r") if os.path.getsize(path) else np.zeros(0, np.uint8)
