"""Length-limited canonical Huffman codes over integer symbols."""

from __future__ import annotations

import numpy as np

#: Longest code in bits; the decoding table has two to this power entries.
MAX_BITS = 18
#: Symbols between two checkpoints.
BLOCK = 256


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` by package-merge; 0 for symbols that do not occur."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) > 1 << max_bits:
        raise ValueError(f"{len(used)} symbols do not fit codes of {max_bits} bits")
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    merged, kinds = leaves, []
    for _ in range(max_bits - 1):
        kinds.append(None)
        even = len(merged) // 2 * 2
        both = np.concatenate([leaves, merged[:even:2] + merged[1:even:2]])
        place = np.argsort(both, kind="stable")
        kinds[-1] = place < len(leaves)
        merged = both[place]
    take = 2 * len(leaves) - 2
    for leaf in reversed(kinds):
        chosen = int(np.count_nonzero(leaf[:take]))
        lengths[order[:chosen]] += 1
        take = 2 * (take - chosen)
    lengths[order[:take]] += 1
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then symbol."""
    codes = np.zeros(len(lengths), np.uint64)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    if len(order):
        size = lengths[order].astype(np.int64)
        longest = int(size[-1])
        room = np.left_shift(np.int64(1), longest - size)
        codes[order] = ((np.cumsum(room) - room) >> (longest - size)).astype(np.uint64)
    return codes


def encode(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bits of ``ids`` and the bit at which every block of ``BLOCK`` ids begins."""
    if not len(ids):
        return b"", np.zeros(0, np.int64)
    size = lengths[ids].astype(np.int64)
    end = np.cumsum(size)
    start = end - size
    word, free = start >> 6, 64 - (start & 63) - size
    code = codes[ids]
    high = np.where(free >= 0, code << np.maximum(free, 0).astype(np.uint64), code >> np.maximum(-free, 0).astype(np.uint64))
    words = np.zeros((int(end[-1]) >> 6) + 2, np.uint64)
    heads = np.flatnonzero(np.diff(word, prepend=-1))
    words[word[heads]] = np.bitwise_or.reduceat(high, heads)
    over = np.flatnonzero(free < 0)
    words[word[over] + 1] |= code[over] << (64 + free[over]).astype(np.uint64)
    return words.astype(">u8").tobytes()[: (int(end[-1]) + 7) // 8], start[::BLOCK]


def decoding_table(lengths: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """Longest code, and symbol and length for every bit string of that many bits."""
    longest = max(1, int(lengths.max(initial=1)))
    symbols, sizes = np.zeros(1 << longest, np.uint32), np.zeros(1 << longest, np.uint8)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    room = np.left_shift(1, longest - lengths[order].astype(np.int64))
    filled = int(room.sum())
    symbols[:filled] = np.repeat(order, room)
    sizes[:filled] = np.repeat(lengths[order], room)
    return longest, symbols, sizes


def decode(bits: bytes, checkpoints: np.ndarray, count: int, table) -> np.ndarray:
    """All blocks at once, each from its checkpoint, one table look-up per block and step."""
    if not count:
        return np.zeros(0, np.uint32)
    longest, symbols, sizes = table
    data = np.frombuffer(bits + bytes(BLOCK * longest // 8 + 8), np.uint8).astype(np.uint32)
    window = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
    at = checkpoints.astype(np.int64).copy()
    out = np.empty((BLOCK, len(at)), np.uint32)
    for step in range(min(BLOCK, count)):
        code = (window[at >> 3] << (at & 7).astype(np.uint32)) >> np.uint32(32 - longest)
        out[step] = symbols[code]
        at += sizes[code]
    return np.ascontiguousarray(out.T).reshape(-1)[:count]
