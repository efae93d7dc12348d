"""Integer arrays as small binary values for shuffles."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def packed(values: np.ndarray) -> bytes:
    """``values`` as compressed byte planes; ascending ones, as their differences, become much smaller than random ones."""
    raw = np.ascontiguousarray(values).astype(values.dtype.newbyteorder("<"))
    planes = raw.view(np.uint8).reshape(-1, raw.itemsize).T.tobytes()
    head = np.array([len(planes)], dtype="<u8").tobytes() + raw.dtype.str.encode().ljust(8)
    return head + pa.compress(planes, codec="zstd", asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    size, kind = int(np.frombuffer(data, dtype="<u8", count=1)[0]), np.dtype(bytes(data[8:16]).strip().decode())
    planes = pa.decompress(data[16:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""
    return np.frombuffer(planes, dtype=np.uint8).reshape(kind.itemsize, -1).T.copy().view(kind).reshape(-1)


def packed_ascending(values: np.ndarray) -> bytes:
    return packed(np.diff(values, prepend=values.dtype.type(0)))


def unpacked_ascending(data: bytes) -> np.ndarray:
    differences = unpacked(data)
    return np.cumsum(differences, dtype=differences.dtype)
