"""XXH64 of many byte spans at once, for numpy."""

from __future__ import annotations

import numpy as np
import xxhash

# The five primes of XXH64.
_P1 = np.uint64(0x9E3779B185EBCA87)
_P2 = np.uint64(0xC2B2AE3D27D4EB4F)
_P3 = np.uint64(0x165667B19E3779F9)
_P4 = np.uint64(0x85EBCA77C2B2AE63)
_P5 = np.uint64(0x27D4EB2F165667C5)

#: Longer spans go to the library one by one; few are.
_LONG = 256


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def _round(state: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _turn(state + lane * _P2, 31) * _P1


def _same_length(data: np.ndarray, eights: np.ndarray, fours: np.ndarray, at: np.ndarray, size: int, seed: int) -> np.ndarray:
    zero = np.zeros(len(at), np.uint64)
    start, done = np.uint64(seed), 0
    with np.errstate(over="ignore"):
        if size >= 32:
            states = [zero + (start + _P1 + _P2), zero + (start + _P2), zero + start, zero + (start - _P1)]
            while size - done >= 32:
                states = [_round(s, eights[at + (done + 8 * k)]) for k, s in enumerate(states)]
                done += 32
            h = _turn(states[0], 1) + _turn(states[1], 7) + _turn(states[2], 12) + _turn(states[3], 18)
            for s in states:
                h = (h ^ _round(zero, s)) * _P1 + _P4
        else:
            h = zero + (start + _P5)
        h = h + np.uint64(size)
        while size - done >= 8:
            h = _turn(h ^ _round(zero, eights[at + done]), 27) * _P1 + _P4
            done += 8
        if size - done >= 4:
            h = _turn(h ^ (fours[at + done].astype(np.uint64) * _P1), 23) * _P2 + _P3
            done += 4
        while done < size:
            h = _turn(h ^ (data[at + done].astype(np.uint64) * _P5), 11) * _P1
            done += 1
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        return h ^ (h >> np.uint64(32))


def xxh64(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of data[s:s+n] for every (s, n)."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    fours = np.ndarray((len(data) + 5,), "<u4", padded, strides=(1,))
    out = np.zeros(len(starts), np.uint64)
    order = np.argsort(lengths, kind="stable")
    ordered = lengths[order]
    edges = np.flatnonzero(np.diff(ordered)) + 1
    for part in np.split(order, edges) if len(order) else ():
        size = int(lengths[part[0]])
        if size > _LONG:
            raw = padded.data
            out[part] = [xxhash.xxh64_intdigest(raw[s : s + size], seed) for s in starts[part].tolist()]
        else:
            out[part] = _same_length(padded, eights, fours, starts[part], size, seed)
    return out
