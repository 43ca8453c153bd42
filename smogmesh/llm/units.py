"""Texts of a batch cut into units, each distinct unit worked on once.

The bytes of many texts are cut at marked positions; Arrow's dictionary
encoding then gives the distinct units and a code per occurrence, so that the
per-unit work (token counts, token ids) is done per distinct unit and spread
over the occurrences with array operations.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

#: Letters for cuts: ASCII letters and the two-byte letters U+00C0 to U+00FF.
_LETTER = np.zeros(256, dtype=bool)
_LETTER[list(range(65, 91)) + list(range(97, 123))] = True


def after_letter(data: np.ndarray) -> np.ndarray:
    """Mask of the positions whose previous character is a letter of ASCII or of U+00C0..U+00FF."""
    out = np.zeros(len(data), dtype=bool)
    out[1:] = _LETTER[data[:-1]]
    # C3 80..BF are U+00C0..U+00FF; C3 97 and C3 B7 are the two signs among them.
    two = data[:-2] == 0xC3
    out[2:] |= two & (data[1:-1] != 0x97) & (data[1:-1] != 0xB7)
    return out


class Store:
    """Results per unit in two generations of at most half of ``size``: what is in use stays."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def get(self, keys: list[bytes], make: Callable[[list[bytes]], list[bytes]]) -> list[bytes]:
        """The results of all ``keys``, in order; ``make`` gives those not held."""
        new, old = self.new, self.old
        out = [new.get(k) for k in keys]
        left = [i for i, v in enumerate(out) if v is None]
        missing = []
        for i in left:
            v = old.get(keys[i])
            if v is None:
                missing.append(i)
            else:
                out[i] = v
        if missing:
            for i, v in zip(missing, make([keys[i] for i in missing])):
                out[i] = v
        for i in left:
            if len(keys[i]) <= 64:
                new[keys[i]] = out[i]
        if len(new) >= self.size // 2:
            self.old, self.new = new, {}
        return out


class Units:
    """Units of ``data`` (texts one after the other) that begin at the true positions of ``cut``.

    ``bounds`` holds the texts' start positions and the end of the last; every
    text begins a unit.  ``values`` gets the bytes of each distinct unit and
    returns its results as bytes of ``dtype`` numbers.
    """

    def __init__(self, data: np.ndarray, cut: np.ndarray, bounds: np.ndarray, values, dtype: str):
        starts = bounds[:-1]
        cut[starts[starts < len(data)]] = True
        at = np.flatnonzero(cut).astype(np.int32)
        offsets = np.append(at, np.int32(len(data)))
        units = pa.Array.from_buffers(
            pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
        ).dictionary_encode()
        self.codes = units.indices.to_numpy()
        found = values(units.dictionary.to_pylist())
        step = np.dtype(dtype).itemsize
        self.lens = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // step
        self.pool = np.frombuffer(b"".join(found), dtype=dtype)
        self.pool_at = np.cumsum(self.lens) - self.lens
        #: First unit of each text, and the end of the last.
        self.text_at = np.searchsorted(at, bounds)
        self.sizes = self.lens[self.codes]
        ends = np.zeros(len(self.codes) + 1, dtype=np.int64)
        np.cumsum(self.sizes, out=ends[1:])
        #: Results before each unit; of each text.
        self.ends = ends
        self.text_ends = ends[self.text_at]

    def spread(self) -> np.ndarray:
        """The results of all units one after the other."""
        shift = self.pool_at[self.codes] - self.ends[:-1]
        return self.pool[np.repeat(shift, self.sizes) + np.arange(self.ends[-1])]


def joined(texts: list[str], lead: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of the texts one after the other, ``lead`` before each that is not empty; bounds."""
    rows = [lead + t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    bounds = np.zeros(len(rows) + 1, dtype=np.int64)
    np.cumsum(np.fromiter(map(len, rows), dtype=np.int64, count=len(rows)), out=bounds[1:])
    return np.frombuffer(b"".join(rows), dtype=np.uint8), bounds
