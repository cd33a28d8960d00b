"""Integer arrays as compressed bytes, for rows that carry one array per block instead of one row per element."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import zstandard


def pack(values: np.ndarray, level: int = 1) -> bytes:
    """Unsigned integers as byte planes under zstandard; leading planes of zeros cost next to nothing."""
    values = np.ascontiguousarray(values, dtype="<u8")
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = values.view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + zstandard.ZstdCompressor(level=level).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes) -> np.ndarray:
    """The integers of `pack`, as unsigned 64-bit."""
    width = data[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), dtype=np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, :width] = planes.T
    return out.reshape(-1).view("<u8")


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned integers, as differences."""
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def pack_strings(items: list[bytes]) -> bytes:
    """Byte strings as their lengths and one compressed body."""
    lengths = pack(np.fromiter(map(len, items), np.uint64, len(items)))
    body = zstandard.ZstdCompressor(level=1).compress(b"".join(items))
    return len(lengths).to_bytes(8, "little") + lengths + body


def unpack_strings(data: bytes) -> list[bytes]:
    cut = 8 + int.from_bytes(data[:8], "little")
    ends = np.cumsum(unpack(data[8:cut])).tolist()
    body = zstandard.ZstdDecompressor().decompress(data[cut:])
    return [body[start:end] for start, end in zip([0, *ends], ends)]


def flat(parts: list[np.ndarray], dtype=np.uint64) -> np.ndarray:
    """One array of many, also of none."""
    return np.concatenate(parts) if parts else np.empty(0, dtype=dtype)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All indexes of the given slices, one slice after the other."""
    starts, lengths = starts.astype(np.int64), lengths.astype(np.int64)
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def whole_groups(frames: Iterable[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Frames cut so that rows with equal keys, which must follow each other, stand in one frame."""
    rest: pd.DataFrame | None = None
    for frame in frames:
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        if frame.empty:
            continue
        last = np.ones(len(frame), dtype=bool)
        for key in keys:
            last &= (frame[key] == frame[key].iloc[-1]).to_numpy()
        cut = int(len(frame) - last.sum())
        rest = frame.iloc[cut:]
        if cut:
            yield frame.iloc[:cut].reset_index(drop=True)
    if rest is not None and len(rest):
        yield rest.reset_index(drop=True)
