"""Sorted runs of keys with counts, compressed in blocks, and their merge."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import zstandard

BLOCK = 1 << 15  # keys of a run that are unpacked at once


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays behind one another, each with its length, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.int64(x.nbytes).tobytes() + x.tobytes() for x in arrays))


def unpacked(data: bytes, *kinds: type) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    for kind in kinds:
        size = int(np.frombuffer(raw, np.int64, 1, at)[0])
        out.append(np.frombuffer(raw, kind, size // np.dtype(kind).itemsize, at + 8))
        at += 8 + size
    return out


def head_of(keys: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """A sorted run of keys with their counts, in blocks; keys as differences."""
    steps = np.diff(keys, prepend=0)
    return [packed(keys[i:i + 1], steps[i + 1:i + BLOCK], counts[i:i + BLOCK]) for i in range(0, len(keys), BLOCK)]


def blocks(head: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for block in head:
        first, steps, counts = unpacked(block, np.int64, np.int64, np.int64)
        yield np.cumsum(np.concatenate([first, steps])), counts


def merged(heads: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(keys, counts) of several sorted runs, summed by key, in order. At most a block of each run is unpacked."""
    sources = [blocks(h) for h in heads]
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    heap: list[tuple[int, int]] = []  # the last key of each run's block

    def load(i: int) -> None:
        block = next(sources[i], None)
        held.pop(i, None)
        if block is not None:
            held[i] = block
            heapq.heappush(heap, (int(block[0][-1]), i))

    for i in range(len(sources)):
        load(i)
    while heap:
        bound = heap[0][0]  # all keys up to here are unpacked
        keys, counts = [], []
        for i, (p, c) in held.items():
            to = int(np.searchsorted(p, bound, "right"))
            keys.append(p[:to])
            counts.append(c[:to])
            held[i] = p[to:], c[to:]
        while heap and heap[0][0] == bound:
            load(heapq.heappop(heap)[1])
        every = np.concatenate(keys)
        found, place = np.unique(every, return_inverse=True)
        yield found, np.bincount(place, np.concatenate(counts), len(found)).astype(np.int64)
