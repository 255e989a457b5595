"""Text columns as numpy bytes: slices of bounded size, spans of bytes and their hashes.

Hashes are 64-bit polynomials over mixed byte weights, so that the hash of any span follows from
two prefix sums. All constants come from one mixing rule.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit scrambling (two multiply-xorshift rounds)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_GOLDEN = 0x9E3779B97F4A7C15
_WEIGHTS = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_GOLDEN))
_INVERSE = pow(_GOLDEN, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, SLICE_BYTES + 4096), base, dtype=np.uint64)
        have[0] = 1
        _powers[base] = have = np.cumprod(have, dtype=np.uint64)
    return have[:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all values and their offsets; null counts as empty."""
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with about `limit` bytes of text; a longer text stands alone."""
    sizes = np.diff(text_bytes(batch.column(column))[1])
    ends = np.cumsum(sizes)
    start, total = 0, len(sizes)
    while start < total:
        base = ends[start] - sizes[start]
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running sums whose differences give the hash of any span."""
    sums = np.zeros(len(data) + 1, np.uint64)
    weighed = _WEIGHTS[data]
    weighed *= _power(_GOLDEN, len(data))
    np.cumsum(weighed, out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of data[start:end], mixed with its length; alike wherever the span stands."""
    value = (sums[ends] - sums[starts]) * _power(_INVERSE, len(sums))[starts]
    return mixed(value ^ ((ends - starts).astype(np.uint64) * np.uint64(_GOLDEN)))


def _words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on as one number; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", padded.tobytes(), strides=(1,))


def _same_bytes(data: np.ndarray, starts: np.ndarray, others: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether data[s:s+n] equals data[o:o+n], for every (s, o, n), eight bytes at a time."""
    words = _words_at(data)
    steps = (lengths + 7) // 8
    ends = np.cumsum(steps)
    shift = 8 * (np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - steps, steps))
    left = np.minimum(np.repeat(lengths, steps) - shift, 8).astype(np.uint64)
    differ = words[np.repeat(starts, steps) + shift] ^ words[np.repeat(others, steps) + shift]
    differ <<= np.uint64(64) - np.uint64(8) * left
    wrong = np.concatenate([[0], np.cumsum(differ != 0)])
    return wrong[ends] == wrong[ends - steps]


def distinct_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, back): one span of each content, and the content of each span.

    Hashes only propose: every span is compared, byte for byte, with the one that stands for it, and
    those that differ are told apart by their bytes.
    """
    _, first, back = np.unique(span_hash(prefix_hash(data), starts, ends), return_index=True, return_inverse=True)
    lengths, chosen = ends - starts, first[back]
    same = lengths == lengths[chosen]
    at = np.flatnonzero(same & (chosen != np.arange(len(starts))))
    same[at] = _same_bytes(data, starts[at], starts[chosen[at]], lengths[at])
    if not same.all():
        raw, known, extra = data.tobytes(), {}, []
        for i in np.flatnonzero(~same).tolist():
            content = raw[starts[i] : ends[i]]
            if content not in known:
                known[content] = len(first) + len(extra)
                extra.append(i)
            back[i] = known[content]
        first = np.concatenate([first, np.array(extra, first.dtype)])
    return first, back


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of `inside` that do not cross texts: starts, ends, and the text of each."""
    n = len(inside)
    if not n:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | first[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:n]
    begin = np.flatnonzero(starts)
    return begin, np.flatnonzero(ends) + 1, np.searchsorted(offsets, begin, side="right") - 1


def pick(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """flat[s:s+n] of every (s, n), one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A 256-entry table, true within the given inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]` once A-Z is lower-cased.
WORD = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
SPACE = byte_class((0x09, 0x0D), (0x20, 0x20))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
