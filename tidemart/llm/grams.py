"""Words, word hashes and shingles of many texts at once, straight from their UTF-8 bytes.

Words are runs without ASCII white space (0x09-0x0D, 0x20). Hashes are 64-bit and the same in
every process. All work is numpy over a slice of some hundred documents.
"""

from __future__ import annotations

import hashlib

import numpy as np

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, other bytes as they are
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_STEP = np.uint64(0xD6E8FEB86659FD93)
#: the first k bytes of eight
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: spans longer than this are hashed one by one
_LONG = 1024


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit depends on every bit (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes data[start:end] of each span; equal contents give equal hashes anywhere.

    Eight bytes at a time are taken in, each time with a full mix, so that no pattern of bytes makes
    different contents meet; a sum of powers would let some (Thue-Morse words) do so.
    """
    size = (ends - starts).astype(np.int64)
    out = mix(size.astype(np.uint64) + _STEP)
    eights = np.lib.stride_tricks.sliding_window_view(np.concatenate([data, np.zeros(8, np.uint8)]), 8)
    on, at = np.flatnonzero(size <= _LONG), 0
    on = on[size[on] > 0]
    while len(on):
        part = np.ascontiguousarray(eights[starts[on] + at]).view("<u8").ravel()
        part &= _FIRST[np.minimum(size[on] - at, 8)]
        out[on] = mix((out[on] ^ part) * _STEP)
        at += 8
        on = on[size[on] > at]
    for i in np.flatnonzero(size > _LONG):
        digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        out[i] = np.frombuffer(digest, "<u8")[0]
    return out


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of each run of true bytes; runs never cross documents."""
    n = len(inside)
    begin = np.zeros(n + 1, bool)
    begin[:n] = inside
    begin[1:n] &= ~inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < n]
    begin[firsts] = inside[firsts]
    finish = np.zeros(n + 1, bool)
    finish[1:] = inside
    finish[1:n] &= ~inside[1:]
    lasts = offsets[1:][offsets[1:] > 0]
    finish[lasts] = inside[lasts - 1]
    starts, ends = np.flatnonzero(begin[:n]), np.flatnonzero(finish)
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def words(data: np.ndarray, offsets: np.ndarray):
    """(start, end, document, hash) of each word."""
    starts, ends, doc = runs(~SPACE[data], offsets)
    return starts, ends, doc, span_hashes(data, starts, ends)


def windows(hashes: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position of the first word) of each run of n words inside one document."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(doc[n - 1 :] == doc[: len(doc) - n + 1])
    out = np.zeros(len(at), np.uint64)
    for k in range(n):
        out = out * _STEP + hashes[at + k]
    return mix(out), at


def shingle_sets(
    data: np.ndarray, offsets: np.ndarray, n: int = 5
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-word shingles of each document, ascending: (hashes, n_docs + 1 offsets).

    A document with fewer words has its whole word sequence as its one shingle; one without
    words has none. A-Z are lower-cased.
    """
    n_docs = len(offsets) - 1
    _, _, doc, hashes = words(LOWER[data], offsets)
    found, at = windows(hashes, doc, n)
    owner = doc[at]
    counts = np.bincount(doc, minlength=n_docs)
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        begins = np.concatenate([[0], np.cumsum(counts)])
        extra = np.zeros(len(short), np.uint64)
        for i, d in enumerate(short):
            h = 0
            for w in hashes[begins[d] : begins[d + 1]]:
                h = (h * int(_STEP) + int(w)) & (1 << 64) - 1
            extra[i] = h ^ int(counts[d])
        found = np.concatenate([found, mix(extra)])
        owner = np.concatenate([owner, short])
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    if len(found):
        fresh = np.ones(len(found), bool)
        fresh[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
        found, owner = found[fresh], owner[fresh]
    return found, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n_docs))])
