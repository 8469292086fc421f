"""Vectors of numbers as whole multiples, stored in few bytes.

An entry c becomes floor(scale * c). A row is packed as a digit for the width
of its entries and the entries in that width, without trailing zeros: equal
vectors have equal bytes, and small entries take a byte or two.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# Entry types by the digit in front of a packed row. Floors that
# no 64-bit integer holds are kept as the doubles that they are.
_TYPES = ("<i1", "<i2", "<i4", "<i8", "<f8")
_BOUNDS = (2.0**7, 2.0**15, 2.0**31, 2.0**63)


def finite_rows(column: pa.Array, length: int | None = None) -> np.ndarray:
    """Which rows are vectors (of ``length``) without NULL, NaN or infinity."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    good = sizes >= 0 if length is None else sizes == length
    entries = column.flatten()
    values = entries.to_numpy(zero_copy_only=False).astype(np.float64)
    bad = ~np.isfinite(values) | entries.is_null().to_numpy(zero_copy_only=False)
    ends = np.cumsum(np.maximum(sizes, 0))
    faults = np.concatenate([[0], np.cumsum(bad)])
    return good & (faults[ends] == faults[ends - np.maximum(sizes, 0)])


def floors(column: pa.Array, scale: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """``(rows, floors)`` for each length that occurs: the numbers of the rows
    of that length, and floor(scale * entry) as a matrix of doubles. All rows
    have to be finite."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.cumsum(sizes) - sizes
    out = []
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        at = starts[rows][:, None] + np.arange(size)[None, :]
        # Adding 0 turns a negative zero into zero.
        out.append((rows, np.floor(values[at] * scale) + 0.0))
    return out


def as_longs(values: np.ndarray) -> np.ndarray:
    """Whole doubles as 64-bit integers; beyond their range, the nearest one."""
    inside = np.abs(values) < 2.0**63
    out = np.where(inside, values, 0.0).astype(np.int64)
    out[~inside & (values > 0)] = np.iinfo(np.int64).max
    out[~inside & (values < 0)] = np.iinfo(np.int64).min
    return out


def pack(column: pa.Array, scale: int, saturate: bool) -> list[bytes]:
    """Each row packed. Entries beyond 64 bits become the nearest 64-bit
    integer if ``saturate``, else they are kept."""
    out: list = [None] * len(column)
    for rows, values in floors(column, scale):
        width = values.shape[1]
        largest = np.abs(values).max(axis=1, initial=0.0)
        kinds = np.minimum(np.searchsorted(_BOUNDS, largest, side="right"), 3 if saturate else 4)
        used = width - np.argmax(values[:, ::-1] != 0, axis=1) if width else np.zeros(len(rows), int)
        used = np.where(largest > 0, used, 0)
        for kind in np.unique(kinds):
            chosen = np.flatnonzero(kinds == kind)
            whole = values[chosen] if kind == 4 else as_longs(values[chosen])
            size, data = np.dtype(_TYPES[kind]).itemsize, whole.astype(_TYPES[kind]).tobytes()
            head = b"%d" % kind
            for i, row in enumerate(chosen):
                start = i * width * size
                out[rows[row]] = head + data[start : start + int(used[row]) * size]
    return out


def packed_length(row: bytes) -> int:
    return (len(row) - 1) // np.dtype(_TYPES[row[0] - 48]).itemsize


def unpack(rows: list[bytes], width: int) -> np.ndarray:
    """Packed rows as a matrix, zeros at their ends restored: of 64-bit
    integers, or of Python's own integers if one of them needs it."""
    groups: dict = {}
    for i, row in enumerate(rows):
        groups.setdefault((row[0] - 48, len(row)), []).append(i)
    wide = any(kind == 4 for kind, _ in groups)
    out = np.zeros((len(rows), width), object if wide else np.int64)
    for (kind, _), at in groups.items():
        part = np.frombuffer(b"".join(rows[i][1:] for i in at), _TYPES[kind]).reshape(len(at), -1)
        if wide:
            part = np.array([[int(v) for v in row] for row in part.tolist()], object).reshape(part.shape)
        out[np.array(at)[:, None], np.arange(part.shape[1])[None, :]] = part
    return out
