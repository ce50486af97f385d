"""Numpy views of a batch of texts: characters or bytes, words, hashes.

All functions work on whole texts; a batch is a run of documents of about
``size`` characters, so that a task's memory is bounded by that and by the
longest single text.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

import numpy as np

#: Odd multiplier of the polynomial hash modulo 2**64, and its inverse.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Characters of a batch.
BATCH_CHARS = 2_000_000


_KEPT: dict[str, np.ndarray] = {}


def kept(name: str, make: Callable[[], np.ndarray]) -> np.ndarray:
    """A table over code points, made once per task."""
    if name not in _KEPT:
        _KEPT[name] = make()
    return _KEPT[name]


def give_back() -> None:
    """Return freed memory to the system: a worker waits for its next task with what it holds."""
    import ctypes

    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def batches(frames, columns: list[str], size: int = BATCH_CHARS, text: str = "text") -> Iterator[dict[str, list]]:
    """Columns of runs of rows of Arrow batches, cut to about ``size``
    characters of ``text`` (null: empty); only one run at a time is made into Python values."""
    import pyarrow.compute as pc
    for frame in frames:
        lengths = pc.fill_null(pc.utf8_length(frame[text]), 0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(lengths.astype(np.int64) + 1), 0
        while at < len(ends):
            before = ends[at - 1] if at else 0
            to = min(int(np.searchsorted(ends, before + size, "left")) + 1, len(ends))
            part = frame.slice(at, to - at)
            got = {c: part[c].to_pylist() for c in columns}
            got[text] = [t if t is not None else "" for t in got[text]]
            yield got
            at = to
    give_back()


def characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, a newline after each, and where each text starts."""
    joined = "\n".join(texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    return codes, starts_of([len(t) for t in texts])


def octets(texts: list[str], after: bytes = b"\n") -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 of all texts, ``after`` following each, and where each text starts."""
    coded = [t.encode("utf-8", "surrogatepass") for t in texts]
    return np.frombuffer(after.join(coded) + after, np.uint8), starts_of([len(c) for c in coded])


def starts_of(lengths: list[int]) -> np.ndarray:
    """Starts of texts of these lengths with one separator after each, and the end of all."""
    return np.concatenate(([0], np.cumsum(np.asarray(lengths, np.int64) + 1)))


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
    return edge[::2], edge[1::2]


def is_space(codes: np.ndarray) -> np.ndarray:
    """ASCII white space: blank, and tab to carriage return."""
    return (codes == 32) | ((codes >= 9) & (codes <= 13))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's values."""
    n = len(codes)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * powers(BASE, n)[:n], out=total[1:])
    return mixed((total[ends] - total[starts]) * powers(INVERSE, n)[starts])


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k values (len(h) - k + 1 of them)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = h[:n].copy()
    for j in range(1, k):
        out *= np.uint64(BASE)
        out += h[j:j + n]
    return mixed(out)


def sliding_min(values: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each run of w values."""
    out, have = values, 1
    while have < w:
        step = min(have, w - have)
        out = np.minimum(out[:len(out) - step], out[step:])
        have += step
    return out


def letters(codes: np.ndarray) -> np.ndarray:
    """Which code points are letters."""
    table = kept("letters", lambda: np.fromiter((chr(c).isalpha() for c in range(0x10000)), bool, 0x10000))
    out = table[np.minimum(codes, 0xFFFF)]
    beyond = np.flatnonzero(codes > 0xFFFF)
    if len(beyond):
        values, where = np.unique(codes[beyond], return_inverse=True)
        out[beyond] = np.array([chr(c).isalpha() for c in values])[where]
    return out
