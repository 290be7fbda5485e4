"""Flat array files in the shared folder, written by tasks and mapped by tasks.

A file holds named numpy arrays, each aligned to 64 bytes. On a folder that is
mounted (scheme file or none) readers map it into memory, so all workers of a
machine share its pages; from any other store the bytes are read through
Arrow's file systems.
"""

from __future__ import annotations

import json
import os
import uuid
from urllib.parse import unquote, urlparse

import numpy as np


def _local(uri: str) -> str | None:
    parts = urlparse(uri)
    return unquote(parts.path) if parts.scheme in ("", "file") else None


def save(uri: str, arrays: dict[str, np.ndarray]) -> None:
    """Write beside the target and rename: a task that is run twice, or lost
    half-way, never leaves a broken file under the final name."""
    head, at, parts = {}, 0, []
    for name, array in arrays.items():
        array = np.ascontiguousarray(array)
        head[name] = (array.dtype.str, array.shape, at)
        pad = -array.nbytes % 64
        parts += [array.ravel().view(np.uint8), b"\0" * pad]
        at += array.nbytes + pad
    text = json.dumps(head).encode()
    text += b" " * (-(len(text) + 8) % 64)
    parts = [len(text).to_bytes(8, "little"), text, *parts]
    path = _local(uri)
    if path is not None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        beside = f"{path}.{uuid.uuid4().hex}"
        with open(beside, "wb") as out:
            for part in parts:
                out.write(part)
        os.replace(beside, path)
        return
    from pyarrow import fs
    store, place = fs.FileSystem.from_uri(uri)
    store.create_dir(os.path.dirname(place), recursive=True)
    beside = f"{place}.{uuid.uuid4().hex}"
    with store.open_output_stream(beside) as out:
        for part in parts:
            out.write(part)
    store.move(beside, place)


def load(uri: str) -> dict[str, np.ndarray]:
    path = _local(uri)
    if path is not None:
        data = np.memmap(path, np.uint8, "r")
    else:
        from pyarrow import fs
        store, place = fs.FileSystem.from_uri(uri)
        with store.open_input_file(place) as source:
            data = np.frombuffer(source.read(), np.uint8)
    size = int.from_bytes(data[:8].tobytes(), "little")
    head = json.loads(data[8:8 + size].tobytes())
    out = {}
    for name, (kind, shape, at) in head.items():
        count = int(np.prod(shape)) * np.dtype(kind).itemsize
        out[name] = np.asarray(data[8 + size + at:8 + size + at + count]).view(kind).reshape(shape)
    return out


def pack_numbers(values: np.ndarray) -> bytes:
    """Ascending or small whole numbers as byte planes, upper empty ones left out."""
    planes = np.ascontiguousarray(values, dtype="<u8").view(np.uint8).reshape(-1, 8).T
    used = max((i + 1 for i in range(8) if planes[i].any()), default=0)
    return bytes([used]) + planes[:used].tobytes()


def unpack_numbers(data: bytes, count: int) -> np.ndarray:
    planes = np.zeros((8, count), np.uint8)
    used = data[0]
    planes[:used] = np.frombuffer(data, np.uint8, offset=1).reshape(used, count)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()
