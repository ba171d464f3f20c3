"""Distances of many 64-bit fingerprints at once, from vertical bit planes.

A block is 64 fingerprints turned into 64 words: word ``b`` holds bit ``b`` of
all of them. One exclusive-or of a plane with a query's bit tells for 64
candidates whether they differ there; carry-save adders sum these bits into
three counter planes and a sticky overflow. After every eight planes a block in
which all distances are beyond the radius is abandoned.
"""

from __future__ import annotations

import numpy as np

LANES = 64
#: Pairs of a query and a block handled together; bounds the memory of a step.
CHUNK = 1 << 15
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def planes_of(prints: np.ndarray) -> np.ndarray:
    """(64, blocks): bit planes of (blocks, 64) fingerprints."""
    out = np.empty((64, len(prints)), np.uint64)
    for bit in range(64):
        column = ((prints >> np.uint64(bit)) & np.uint64(1)).astype(np.uint8)
        out[bit] = np.packbits(column, axis=1, bitorder="little").view("<u8").ravel()
    return out


def _add(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Carry-save adder: sum and carry planes of three planes."""
    half = a ^ b
    return half ^ c, (a & b) | (half & c)


def _beyond(ones: np.ndarray, twos: np.ndarray, fours: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose three-bit count is over the radius."""
    over, same = np.zeros_like(ones), np.full_like(ones, ONES)
    for bit, plane in ((4, fours), (2, twos), (1, ones)):
        if radius & bit:
            same &= plane
        else:
            over |= same & plane
            same &= ~plane
    return over


def near_lanes(planes: np.ndarray, queries: np.ndarray, blocks: np.ndarray, valid: np.ndarray, radius: int):
    """For pairs (query, block): the lanes within the radius, as a word per pair."""
    near = np.zeros(len(queries), np.uint64)
    at = np.arange(len(queries))
    ones, twos, fours, dead = (np.zeros(len(at), np.uint64) for _ in range(4))
    for first in range(0, 64, 8):
        for start in (first, first + 4):
            x = [
                planes[bit, blocks] ^ (np.uint64(0) - ((queries >> np.uint64(bit)) & np.uint64(1)))
                for bit in range(start, start + 4)
            ]
            ones, two_a = _add(ones, x[0], x[1])
            ones, two_b = _add(ones, x[2], x[3])
            twos, four = _add(twos, two_a, two_b)
            dead |= fours & four
            fours ^= four
        dead |= _beyond(ones, twos, fours, radius)
        alive = (dead | ~valid[blocks]) != ONES
        if not alive.all():  # whole blocks beyond the radius are abandoned
            at, queries, blocks = at[alive], queries[alive], blocks[alive]
            ones, twos, fours, dead = ones[alive], twos[alive], fours[alive], dead[alive]
        if not len(at):
            return near
    near[at] = ~dead & valid[blocks]
    return near


def roots_of(parent: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    up = parent[nodes]
    while True:
        higher = parent[up]
        if (higher == up).all():
            return up
        up = higher


def unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the trees of all pairs at once; the smaller root wins."""
    while len(a):
        a, b = roots_of(parent, a), roots_of(parent, b)
        differ = a != b
        a, b = a[differ], b[differ]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def linked(cells: np.ndarray, slots: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (row, root) that join all rows of a cell within the radius.

    A cell with one slot is compared with itself, a cell with two slots only
    across them. Links come back as a forest, at most one per row, so a group of
    near copies costs as many rows as it has members.
    """
    if not 0 <= radius <= 6:
        raise ValueError("three counter planes hold a radius of 0 to 6")
    order = np.lexsort((slots, cells))
    cells, slots, prints = cells[order], slots[order], prints[order]
    n = len(cells)
    parent = np.arange(n)
    if not n:
        return order, order
    starts = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
    ends = np.r_[starts[1:], n]
    # Lanes are a cell's rows of its last slot; queries are those of its first.
    last = slots[ends - 1]
    two = slots[starts] != last
    lane_from = starts + np.array(
        [np.searchsorted(slots[s:e], slots[e - 1]) if t else 0 for s, e, t in zip(starts, ends, two)]
    )
    lanes, queries = ends - lane_from, np.where(two, lane_from, ends) - starts
    blocks = -(-lanes // LANES)
    block_at = np.r_[0, np.cumsum(blocks)]
    row = np.full(block_at[-1] * LANES, -1)
    for first, size, block in zip(lane_from, lanes, block_at[:-1]):
        row[block * LANES : block * LANES + size] = np.arange(first, first + size)
    row = row.reshape(-1, LANES)
    valid = np.packbits(row >= 0, axis=1, bitorder="little").view("<u8").ravel()
    planes = planes_of(prints[row])
    # One entry per (query row, block): in a cell of one slot, blocks from the row's own on.
    cell_of = np.repeat(np.arange(len(starts)), queries)
    query = np.concatenate([np.arange(s, s + q) for s, q in zip(starts, queries)])
    skip = np.where(two[cell_of], 0, (query - starts[cell_of]) // LANES)
    todo = blocks[cell_of] - skip
    ends_at = np.cumsum(todo)
    low = 0
    while low < len(query):
        high = max(low + 1, int(np.searchsorted(ends_at, (ends_at[low - 1] if low else 0) + CHUNK, "right")))
        q = np.repeat(np.arange(low, high), todo[low:high])
        offset = np.arange(len(q)) - np.repeat(ends_at[low:high] - todo[low:high] - (ends_at[low - 1] if low else 0), todo[low:high])
        block = block_at[cell_of[q]] + skip[q] + offset
        near = near_lanes(planes, prints[query[q]], block, valid, radius)
        hit = np.flatnonzero(near)
        bits = np.unpackbits(near[hit].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        pair, lane = np.nonzero(bits)
        unite(parent, query[q[hit[pair]]], row[block[hit[pair]], lane])
        low = high
    root = roots_of(parent, np.arange(n))
    moved = root != np.arange(n)
    return order[moved], order[root[moved]]
