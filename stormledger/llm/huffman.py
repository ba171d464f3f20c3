"""Canonical length-limited Huffman codes: lengths, bit packing, table-driven decoding."""

from __future__ import annotations

import numpy as np

#: Longest code in bits. A decoding table has 2 ** LIMIT entries.
LIMIT = 20


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Bits per symbol by package-merge: the best prefix code with no code beyond the limit.

    Symbols that never occur get 0; a single symbol gets 1.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError("more symbols than codes of that length")
    used = used[np.argsort(counts[used], kind="stable")]
    weight = counts[used].astype(np.int64)
    merged, takes = weight, []
    for _ in range(limit - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.r_[weight, pairs]
        order = np.argsort(both, kind="stable")
        takes.append(order < len(weight))  # which places of the list are symbols, not packages
        merged = both[order]
    need, out = 2 * len(used) - 2, np.zeros(len(used), np.int64)
    for is_symbol in reversed(takes):
        symbols = int(is_symbol[:need].sum())
        out[:symbols] += 1
        need = 2 * (need - symbols)
    out[:need] += 1
    lengths[used] = out
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, symbol)."""
    codes = np.zeros(len(lengths), np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    # The value of a code as a share of all codes is the sum of the shares before it.
    shares = np.uint64(1) << (np.uint64(LIMIT) - lengths[order].astype(np.uint64))
    before = np.cumsum(shares) - shares
    codes[order] = before >> (np.uint64(LIMIT) - lengths[order].astype(np.uint64))
    return codes


def decoding_table(lengths: np.ndarray) -> np.ndarray:
    """For each LIMIT bits that may come next: symbol << 8 | length of its code."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    table = np.zeros(1 << LIMIT, np.uint32)
    entry = order.astype(np.uint32) << np.uint32(8) | lengths[order]
    filled = np.repeat(entry, 1 << (LIMIT - lengths[order].astype(np.int64)))
    table[: len(filled)] = filled
    return table


def pack_bits(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The codes one after another, and the bit at which each ends."""
    if not len(ids):
        return b"", np.zeros(0, np.int64)
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    at = ends - size
    word, shift = at >> 6, (at & 63).astype(np.uint64)
    left = codes[ids] << (np.uint64(64) - size.astype(np.uint64))
    out = np.zeros((int(ends[-1]) + 63 >> 6) + 1, np.uint64)
    first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    out[word[first]] = np.bitwise_or.reduceat(left >> shift, first)
    over = np.flatnonzero((at & 63) + size > 64)  # one code at most straddles the end of a word
    out[word[over] + 1] |= left[over] << (np.uint64(64) - shift[over])
    return out.astype(">u8").tobytes()[: (int(ends[-1]) + 7) // 8], ends


def unpack_segments(payload: bytes, starts: np.ndarray, counts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Ids of independent segments, given the bit at which each starts and its number of ids.

    All segments advance in step, one id at a time, so the work is a few array
    operations for each place in the longest segment.
    """
    out = np.empty(int(counts.sum()), np.uint16)
    if not len(out):
        return out
    data = np.frombuffer(payload + b"\0" * 8, np.uint8)
    window = np.ndarray((len(data) - 3,), ">u4", data, strides=(1,))
    order = np.argsort(-counts, kind="stable")
    bit, target = starts[order].astype(np.int64), (np.cumsum(counts) - counts)[order]
    lanes = np.searchsorted(-counts[order], -np.arange(1, int(counts.max()) + 1), "right")
    for step, n in enumerate(lanes.tolist()):
        now = bit[:n]
        entry = table[(window[now >> 3] << (now & 7).astype(np.uint32)) >> np.uint32(32 - LIMIT)]
        out[target[:n] + step] = entry >> np.uint32(8)
        now += entry & np.uint32(255)
    return out
